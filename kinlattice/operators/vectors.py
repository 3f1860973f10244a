"""Nearest neighbours by cosine (ER-08, MTH-02, TOP-01)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

if TYPE_CHECKING:
    import pyarrow as pa

#: Queries per pass over the entities: what is broadcast is at most so many vectors.
BLOCK_QUERIES = 20_000
#: Products that a worker holds at once.
CELLS = 4_000_000


def _units(vectors: list[list[float]]) -> np.ndarray:
    """Vectors of length 1; of those without a direction (zero) all components are 0."""
    m = np.array(vectors, np.float64)
    norm = np.sqrt((m * m).sum(1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


class _Best:
    """The ``k`` most similar entities of each query so far, ties by id."""

    def __init__(self, ids: list, tags: np.ndarray | None, vectors: np.ndarray, k: int, floor: float | None):
        self.ids, self.tags, self.vectors, self.k, self.floor = np.array(ids, object), tags, vectors, k, floor
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, object), np.zeros(0))] * len(ids)

    def see(self, ids: np.ndarray, tags: np.ndarray | None, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, vectors, tags = ids[order], vectors[order], tags[order] if tags is not None else None
        score = np.round(self.vectors @ vectors.T, 6)
        for i, s in enumerate(score):
            may = (ids != self.ids[i]) & (s >= self.floor if self.floor is not None else True)
            if tags is not None:
                may &= tags == self.tags[i]
            near, sim = ids[may], s[may]
            if len(sim) > self.k:
                enough = sim >= np.partition(sim, len(sim) - self.k)[len(sim) - self.k]
                near, sim = near[enough], sim[enough]
            near, sim = np.r_[self.found[i][0], near], np.r_[self.found[i][1], sim]
            first = np.lexsort((near, -sim))[: self.k]
            self.found[i] = near[first], sim[first]


def top_k(queries: DataFrame, entities: DataFrame, k: int, vector: str = "embedding", tag: str | None = None, floor: float | None = None) -> DataFrame:
    """``(query_id, entity_id, similarity, rank)``: the ``k`` most similar entities of each query, exactly.

    ``queries``: query_id, vector and tag; ``entities``: entity_id, vector and tag. The
    queries are a stated set: they go to the entities in blocks of BLOCK_QUERIES, each one
    broadcast of known size, and every task multiplies matrices and keeps its own best
    ``k`` of each query, so that what is shuffled does not grow with the entities of a
    task. With ``tag`` only entities of the same model are compared. Similarities are
    rounded to six digits, ties go by id. Zero and null vectors have no direction and are
    dropped; so are vectors of another length than the query's.
    """
    spark = entities.sparkSession
    kinds = {**dict(queries.dtypes), **dict(entities.dtypes)}
    schema = StructType([StructField("query_id", queries.schema["query_id"].dataType), StructField("entity_id", entities.schema["entity_id"].dataType), StructField("similarity", DoubleType())])
    extra = [tag] if tag else []
    given = entities.select("entity_id", F.col(vector).cast("array<double>").alias("_v"), *extra).where("entity_id is not null and size(_v) > 0")
    asked = queries.select("query_id", F.col(vector).cast("array<double>").alias("_v"), *extra).where("query_id is not null and size(_v) > 0").toLocalIterator()
    found = spark.createDataFrame([], schema)
    while block := list(islice(asked, BLOCK_QUERIES)):
        for size in sorted({len(r["_v"]) for r in block}):
            some = [r for r in block if len(r["_v"]) == size]
            unit = _units([r["_v"] for r in some])
            use = np.flatnonzero(np.abs(unit).sum(1) > 0)
            tags = np.array([some[i][tag] for i in use], object) if tag else None
            sent = spark.sparkContext.broadcast(([some[i]["query_id"] for i in use], tags, unit[use]))

            def run(batches: Iterator[pa.RecordBatch], sent=sent, size=size) -> Iterator[pa.RecordBatch]:
                import pyarrow as pa
                import pyarrow.compute as pc

                best = _Best(*sent.value, k, floor)
                step = max(1, CELLS // max(len(best.ids), 1))
                for whole in batches:
                    whole = whole.filter(pc.equal(pc.list_value_length(whole.column("_v")), size))
                    for at in range(0, whole.num_rows, step):
                        b = whole.slice(at, step)
                        flat = pc.list_flatten(b.column("_v"))
                        m = _units(flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(b.num_rows, size))
                        fine = np.abs(m).sum(1) > 0
                        ids = np.array(b.column("entity_id").to_pylist(), object)[fine]
                        best.see(ids, np.array(b.column(tag).to_pylist(), object)[fine] if tag else None, m[fine])
                rows = [(q, e, s) for q, (near, sim) in zip(best.ids, best.found) for e, s in zip(near, sim)]
                types = pa.schema([(f.name, _arrow(kinds[f.name]) if f.name != "similarity" else pa.float64()) for f in schema.fields])
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t.type) for i, t in enumerate(types)], schema=types)

            found = found.unionByName(given.mapInArrow(run, schema))
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "entity_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _arrow(kind: str) -> pa.DataType:
    import pyarrow as pa

    return {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[kind]


def embed(df: DataFrame, text: str, provider, vector: str = "embedding") -> DataFrame:
    """ER-13: ``df`` with vectors of a provider (list of texts to list of vectors), asked once per batch; null text is ''."""
    import pandas as pd

    def run(texts):
        return pd.Series(provider(texts.fillna("").tolist()))

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return df.withColumn(vector, F.pandas_udf(run, "array<float>")(F.col(text)))


def zero_provider(size: int):
    """The stub: zero vectors, which have no direction and therefore no neighbours."""
    return lambda texts: [[0.0] * size for _ in texts]
