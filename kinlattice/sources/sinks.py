"""Sinks (SNK-01 to SNK-14)."""

from __future__ import annotations

import datetime as dt
import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlattice.runtime import hadoop, write_bytes


def put_blob(spark: SparkSession, root: str, content: bytes, suffix: str = "") -> str:
    """SNK-01: content-addressed, below its first two digits; written once."""
    digest = hashlib.sha256(content).hexdigest()
    path = f"{root}/{digest[:2]}/{digest}{suffix}"
    fs, p = hadoop(spark, path)
    if not fs.exists(p):
        write_bytes(spark, path, content)
    return path


def stringified(df: DataFrame) -> DataFrame:
    """SNK-03: every column as text, nested ones as JSON; an empty table keeps its columns."""
    nested = lambda kind: kind.startswith(("array", "struct", "map"))
    return df.select(*[(F.to_json(c) if nested(kind) else F.col(c).cast("string")).alias(c) for c, kind in df.dtypes])


def append_new(df: DataFrame, path: str, keys: list[str]) -> None:
    """SNK-02, IDM-04: appends rows whose key is not in the table yet.

    A lock file, which only one run can create, keeps two runs from reading the same
    state; a run that fails leaves the table as it was, because Spark commits an append whole.
    """
    spark = df.sparkSession
    lock = f"{path}.lock"
    write_bytes(spark, lock, b"")  # fails if another run holds it
    try:
        fs, table = hadoop(spark, path)
        if fs.exists(table):
            df = df.join(spark.read.parquet(path).select(*keys), keys, "left_anti")
        df.dropDuplicates(keys).write.mode("append").parquet(path)
    finally:
        fs, p = hadoop(spark, lock)
        fs.delete(p, False)


def write_ndjson(df: DataFrame, path: str) -> None:
    """SNK-04, SNK-10."""
    df.write.mode("errorifexists").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """SNK-11: quoted CSV with header."""
    df.write.mode("errorifexists").options(header=True, quoteAll=True, escape='"').csv(path)


def release_version(spark: SparkSession, root: str, day: dt.date) -> str:
    """DAT-07, SNK-06: ``YYYY.MM.DD``, with ``-2``, ``-3`` … for further releases of the day."""
    base = day.strftime("%Y.%m.%d")
    fs, pattern = hadoop(spark, f"{root}/{base}*")
    taken = {f.getPath().getName() for f in (fs.globStatus(pattern) or [])}
    return base if base not in taken else next(v for n in range(2, len(taken) + 3) if (v := f"{base}-{n}") not in taken)


def data_card(title: str, versions: dict[str, str], rows: dict[str, int], text: str = "") -> str:
    """SNK-05: a README whose front matter pins the versions the data was made with."""
    front = "\n".join(f'{k}: "{v}"' for k, v in versions.items())
    listed = "\n".join(f"| {k} | {n} |" for k, n in sorted(rows.items()))
    return f"---\n{front}\n---\n\n# {title}\n\n{text}\n\n| Table | Rows |\n|-|-|\n{listed}\n"


def release(tables: dict[str, DataFrame], root: str, day: dt.date, versions: dict[str, str], title: str = "Release") -> str:
    """SNK-05/06/07, MET-11, IDM-04: tables as text Parquet with a manifest and a data card.

    Everything is written beside the releases and moved to its place in one step, so a
    release is there whole or not at all; one that exists is never overwritten.
    """
    spark = next(iter(tables.values())).sparkSession
    version = release_version(spark, root, day)
    work = f"{root}/_work-{version}"
    fs, folder = hadoop(spark, work)
    fs.delete(folder, True)
    rows = {}
    for name, df in tables.items():
        stringified(df).write.mode("errorifexists").parquet(f"{work}/{name}")
        rows[name] = spark.read.parquet(f"{work}/{name}").count()
    pinned = {"dataset_version": version, **versions}
    write_bytes(spark, f"{work}/manifest.json", json.dumps({**pinned, "rows": rows}, indent=2, sort_keys=True).encode())
    write_bytes(spark, f"{work}/README.md", data_card(title, pinned, rows).encode())
    target = hadoop(spark, f"{root}/{version}")[1]
    if fs.exists(target) or not fs.rename(folder, target):
        raise FileExistsError(f"release {version} is there already")
    return version


def packet(figures: dict[str, DataFrame], most: int = 10_000) -> str:
    """SNK-07..09: small figures as one JSON document; more than ``most`` rows of one are refused."""
    out = {}
    for name, df in figures.items():
        rows = df.limit(most + 1).toJSON().collect()
        if len(rows) > most:
            raise ValueError(f"{name} has more than {most} rows")
        out[name] = [json.loads(r) for r in rows]
    return json.dumps(out, sort_keys=True)


def views(spark: SparkSession, named: dict[str, DataFrame]) -> None:
    """SNK-14."""
    for name, df in named.items():
        df.createOrReplaceTempView(name)
