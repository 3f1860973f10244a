"""Matching entities across sources without keys (problem 4).

Candidates are rows of two sources at one location. Many heuristic matching
functions vote on each of them: for, against, or not at all. A generative model
learns from the votes alone, without labels, how accurate each function is and which
functions repeat each other, and gives every candidate its posterior confidence.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kinlattice.functions.text import blank_to_null
from kinlattice.llm.addresses import ADDRESS, locate
from kinlattice.llm.postal import names
from kinlattice.runtime import adaptive, stage

if TYPE_CHECKING:
    import pyarrow as pa

#: The matching functions, in the order of the vote vector.
FUNCTIONS = ("whole", "spelling", "head", "kind", "alias", "sibling", "known")


def with_names(rows: DataFrame, name: str, towns: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and ``own``: the names a row goes by, ``whole|head|rest``, joined by ``;``; without any it is ''."""
    schema = StructType([*rows.select(*keep).schema.fields, StructField("own", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for b in batches:
            columns = [b.column(i).to_pylist() for i in range(len(keep), b.num_columns)]
            own = [";".join("|".join(n) for n in names(*x)) for x in zip(*columns)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(own, pa.string())], [*keep, "own"])

    return rows.select(*keep, F.col(name).alias("_name"), *[F.col(t).alias(f"_town{i}") for i, t in enumerate(towns)]).mapInArrow(run, schema)


def _each(df: DataFrame, *keep: str | Column) -> DataFrame:
    """One row per name."""
    return df.select(*keep, F.explode(F.split("own", ";")).alias("n")).where("n != ''")


def _part(c: str, i: int) -> Column:
    return F.get(F.split(c, r"\|"), F.lit(i))


def aliases(owners: DataFrame) -> DataFrame:
    """``(whole, also)``: each legal or trade name and every name, itself too, of an owner who has it."""
    texts = owners.select(F.xxhash64("name", "trade_name").alias("o"), F.explode(F.array("name", "trade_name")).alias("name"))
    each = _each(with_names(texts, "name", keep=("o",)), "o").distinct()
    return each.join(each.withColumnRenamed("n", "also"), "o").select(_part("n", 0).alias("whole"), "also").distinct()


def _votes(pairs: DataFrame) -> DataFrame:
    """``(location, reg, c_name, votes)``: the vote vector of each candidate; of several names the better counts.

    1 is for, -1 against, 0 silent.
    """
    near = lambda a, b, most: F.levenshtein(a, b, most) >= 0
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    n, z = ((F.col(f"{x}_whole"), F.col(f"{x}_head"), F.col(f"{x}_rest")) for x in "nz")
    same = n[0] == z[0]
    by_name = [
        vote(same, ~near(n[0], z[0], 6)),
        vote(near(n[0], z[0], 2) & (F.length(n[0]) > 7), ~near(n[0], z[0], 4)),
        vote((n[1] == z[1]) | same, ~near(n[1], z[1], 2)),
        vote((n[2] == z[2]) & (n[2] != ""), ~near(n[2], z[2], 3) & ~near(n[0], z[0], 4)),
    ]
    cand = pairs.groupBy("location", "reg", "c_name", "c_known").agg(
        *[F.max(v).alias(f"v{i}") for i, v in enumerate(by_name)],
        F.max(F.col("alias") & same).alias("aliased"), F.max("alias").alias("s_known"), F.max(F.col("written") & same).alias("exact"),
    )
    elsewhere = cand.where("exact").groupBy("location", "reg").agg(F.lit(True).alias("named"))
    sibling = vote(F.col("exact"), F.col("named"))
    known = vote(F.col("aliased") & F.col("s_known"), F.col("s_known") & F.col("c_known") & ~F.col("aliased"))
    vector = [*[F.col(f"v{i}") for i in range(4)], vote(F.col("aliased"), F.lit(False)), sibling, known]
    return cand.join(elsewhere, ["location", "reg"], "left").select("location", "reg", "c_name", F.concat_ws(",", *[v.cast("string") for v in vector]).alias("votes"))


def fit_label_model(patterns: list[tuple[list[int], int]], rounds: int = 60, dependent: float = 0.02) -> dict[tuple[int, ...], float]:
    """Posterior of a match for each vote pattern.

    Expectation-maximisation of a latent-class model over ``(votes, count)``. The
    first fit takes the functions as independent given the truth and yields their
    accuracies; what they still share given the truth (conditional mutual information)
    gives a maximum spanning forest of dependent pairs, and the second fit learns each
    function's votes given the truth and the function it hangs on. Both start from the
    majority: functions that copy each other must not be half of all (choosing among
    starts by likelihood instead was tried, and took the class for a well-known name).
    """
    if not patterns:
        return {}
    votes = np.array([p for p, _ in patterns]) + 1
    weight = np.array([n for _, n in patterns], float)
    m = votes.shape[1]
    post = 1 / (1 + np.exp(-1.5 * (votes - 1).sum(1)))

    def fit(post: np.ndarray, parent: list[int | None]) -> np.ndarray:
        for _ in range(rounds):
            logs = np.zeros((len(votes), 2))
            for y, p in enumerate((1 - post, post)):
                w = weight * p
                logs[:, y] = np.log((w.sum() + 1) / (weight.sum() + 2))
                for i in range(m):
                    above = votes[:, parent[i]] if parent[i] is not None else np.zeros(len(votes), int)
                    t = np.full((3, 3), 0.1)
                    np.add.at(t, (above, votes[:, i]), w)
                    t /= t.sum(1, keepdims=True)
                    logs[:, y] += np.log(t[above, votes[:, i]])
            post = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -60, 60)))
        return post

    post = fit(post, [None] * m)
    shared = []
    for i in range(m):
        for j in range(i):
            info = 0.0
            for p in (1 - post, post):
                w = weight * p
                t = np.full((3, 3), 1e-9)
                np.add.at(t, (votes[:, i], votes[:, j]), w)
                share, t = w.sum() / weight.sum(), t / t.sum()
                info += share * float((t * np.log(t / (t.sum(1, keepdims=True) * t.sum(0, keepdims=True)))).sum())
            shared.append((info, i, j))
    parent: list[int | None] = [None] * m
    tree = list(range(m))
    edges: dict[int, list[int]] = {i: [] for i in range(m)}
    for info, i, j in sorted(shared, reverse=True):
        if info > dependent and tree[i] != tree[j]:
            old, new = tree[i], tree[j]
            tree = [new if t == old else t for t in tree]
            edges[i].append(j)
            edges[j].append(i)
    seen: set[int] = set()
    for root in range(m):
        todo = [] if root in seen else [(root, None)]
        while todo:
            i, above = todo.pop()
            seen.add(i)
            parent[i] = above
            todo += [(j, i) for j in edges[i] if j not in seen]
    post = fit(post, parent)
    return {tuple(int(v) - 1 for v in vs): float(p) for vs, p in zip(votes, post)}


def link(staged: DataFrame, centers: DataFrame, owners: DataFrame) -> DataFrame:
    """``(staging_id, center_id, confidence)`` for every candidate: rows at one location.

    ``staged``: id, name, npi and the address columns; ``centers``: id, name and the
    address columns; ``owners``: name, trade_name. Rows without an address that has a
    number and a street, or without a name, are no candidates. Rows of one registry
    number at one location are one registrant, who goes by all names they write there
    and by the other names, legal or trade, of the owners who have those. Copies are
    compared once: votes are cast on distinct names at a location and spread to the
    rows at the end. The model sees the counts of vote patterns, at most 3 ** 7 of them
    whatever the input, and nothing else is collected. An empty side gives no rows; ties
    and repeated rows get one confidence. Work at a location is its distinct staged names
    times its distinct center names.
    """
    adaptive(staged.sparkSession)
    s = staged.select(F.lit("s").alias("side"), "id", "name", blank_to_null(F.col("npi")).alias("npi"), *ADDRESS)
    c = centers.select(F.lit("c").alias("side"), "id", "name", F.lit(None).cast("string").alias("npi"), *ADDRESS)
    placed = locate(s.unionByName(c), F.coalesce("npi", F.lower("name")), ("side", "id", "name", "npi"))
    placed = placed.withColumn("town", _part("form", 2))
    # The town that most rows of the location write stands for towns that are missing or misspelt.
    main = placed.where("town != ''").groupBy("location", "town").agg(F.count("*").alias("n")).groupBy("location").agg(F.max_by("town", F.struct("n", "town")).alias("main"))
    named = with_names(placed.join(main, "location", "left"), "name", ("main", "town"), ("side", "id", "location", "npi"))
    reg = F.when(F.col("npi").isNotNull(), F.concat(F.lit("n"), "npi")).otherwise(F.concat(F.lit("o"), "own"))
    rows = stage(named.where("own != ''").select("side", "id", "location", reg.alias("reg"), "own"), "named")
    also = stage(aliases(owners), "aliases")
    left, right = rows.where("side = 's'"), _each(rows.where("side = 'c'"), F.col("id").alias("center_id"), "location").withColumnRenamed("n", "c_name")
    written = _each(left, "location", "reg").distinct().withColumn("whole", _part("n", 0))
    others = written.join(also, "whole").select("location", "reg", F.col("also").alias("n"))
    goes_by = (
        written.select("location", "reg", "n", F.lit(True).alias("written"), F.lit(False).alias("alias"))
        .unionByName(others.select("location", "reg", "n", F.lit(False).alias("written"), F.lit(True).alias("alias")))
        .groupBy("location", "reg", "n").agg(F.max("written").alias("written"), F.max("alias").alias("alias"))
    )
    known = also.select("whole", F.lit(True).alias("c_known")).distinct()
    theirs = right.select("location", "c_name").distinct().withColumn("whole", _part("c_name", 0)).join(known, "whole", "left").select("location", "c_name", F.coalesce("c_known", F.lit(False)).alias("c_known"))
    pairs = goes_by.join(theirs, "location").select("*", *[_part(x, i).alias(f"{k}_{p}") for k, x in (("n", "n"), ("z", "c_name")) for i, p in enumerate(("whole", "head", "rest"))])
    voted = stage(_votes(pairs), "votes")
    counts = [([int(v) for v in r["votes"].split(",")], r["n"]) for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()]
    model = fit_label_model(counts)
    said = json.dumps({",".join(map(str, v)): p for v, p in model.items()})
    posterior = staged.sparkSession.range(1).select(F.explode(F.from_json(F.lit(said), "map<string,double>")).alias("votes", "confidence"))
    scored = voted.join(F.broadcast(posterior), "votes").select("location", "reg", "c_name", "confidence")
    return (
        left.select(F.col("id").alias("staging_id"), "location", "reg")
        .join(scored, ["location", "reg"])
        .join(right, ["location", "c_name"])
        .groupBy("staging_id", "center_id")
        .agg(F.max("confidence").alias("confidence"))
    )
