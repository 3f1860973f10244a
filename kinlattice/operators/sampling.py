"""Seeded sampling (SMP-01 to SMP-03): the order key is a hash of id and seed, so every engine draws the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw_key(row: Column, seed: int) -> Column:
    return F.md5(F.concat(row.cast("string"), F.lit(f"|{seed}")))


def quotas(sizes: dict[str, int], n: int) -> dict[str, int]:
    """SMP-01, MTH-05: shares rounded half to even, at least 1 each; the largest is lowered until they fit."""
    total = sum(sizes.values())
    out = {k: max(1, round(n * v / total)) for k, v in sorted(sizes.items())} if total else {}
    while sum(out.values()) > n and max(out.values()) > 0:
        top = max(out, key=lambda k: out[k])
        out[top] -= 1
    return {k: min(v, sizes[k]) for k, v in out.items()}


def stratified(rows: DataFrame, stratum: Column, n: int, row: str, seed: int, most_strata: int = 10_000) -> DataFrame:
    """SMP-01/02: about ``n`` rows, each stratum in proportion; null strata are "unknown".

    Only the sizes of strata come to the driver, and more than ``most_strata`` of them
    are refused: a column with more values is no stratum. Ranking has a group limit, so a
    stratum with most of the rows sends at most ``n`` of them from each task.
    """
    named = rows.withColumn("stratum", F.coalesce(stratum, F.lit("unknown")))
    sizes = {r["stratum"]: r["n"] for r in named.groupBy("stratum").agg(F.count("*").alias("n")).limit(most_strata + 1).collect()}
    if len(sizes) > most_strata:
        raise ValueError(f"more than {most_strata} strata")
    quota = quotas(sizes, n)
    most = F.lit(0)
    for k, v in quota.items():
        most = F.when(F.col("stratum") == k, v).otherwise(most)
    w = Window.partitionBy("stratum").orderBy(draw_key(F.col(row), seed), row)
    return named.withColumn("_r", F.row_number().over(w)).where((F.col("_r") <= n) & (F.col("_r") <= most)).drop("_r")


def reservoir(rows: DataFrame, n: int, row: str, seed: int) -> DataFrame:
    """SMP-03: ``n`` rows, uniformly, in one pass; each task keeps its ``n`` least keys."""
    return rows.orderBy(draw_key(F.col(row), seed), row).limit(n)


def two_level(rows: DataFrame, kind: Column, source: Column, n: int, row: str, seed: int) -> DataFrame:
    """SMP-02: strata of two levels, in proportion, in a seeded order."""
    both = F.concat_ws("|", F.coalesce(kind, F.lit("unknown")), F.coalesce(source, F.lit("unknown")))
    return stratified(rows, both, n, row, seed).orderBy(draw_key(F.col(row), seed + 1), row)
