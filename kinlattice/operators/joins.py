"""Joins that are more than an equi-join (J-05 to J-29)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlattice.functions.text import canonical_id


def bridge(df: DataFrame, row: str, array: str, key: str = "key") -> DataFrame:
    """``(row, key)``: distinct pairs of a row and an element of its array.

    The equi-joinable form of ``x = ANY(array)`` (J-06 to J-14): joining on the
    array itself would be a nested loop. Null arrays and blank elements give none.
    """
    return df.select(row, F.explode(array).alias(key)).withColumn(key, canonical_id(F.col(key))).where(F.col(key).isNotNull()).distinct()


def with_any(df: DataFrame, row: str, array: str, keys: DataFrame, key: str = "key", how: str = "left_semi") -> DataFrame:
    """J-13 / J-14: rows whose array holds one of ``keys`` (``left_semi``) or none (``left_anti``)."""
    hit = bridge(df, row, array, key).join(keys.select(key).distinct(), key, "left_semi").select(row).distinct()
    return df.join(hit, row, how)


def collected(df: DataFrame, row: str, array: str, side: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """J-07, J-28, ARR-02/03: ``df`` with the sorted distinct ``value`` of its array's elements; none: empty."""
    values = bridge(df, row, array, key).join(side.select(key, value), key).groupBy(row).agg(F.sort_array(F.collect_set(value)).alias(name))
    return df.join(values, row, "left").withColumn(name, F.coalesce(name, F.array().cast("array<string>")))


def longest_prefix(rows: DataFrame, text: str, brands: DataFrame, brand: str, owner: str, least: int = 6) -> DataFrame:
    """ER-02, J-08: ``rows`` with the owner of the longest brand that ``text`` begins with; rows without are dropped.

    ``text`` and ``brand`` are canonical. Every distinct brand length (some dozens)
    gives one prefix of the text, and prefixes meet brands in a hash join, so work grows
    with rows and lengths and not with rows times brands. Two owners of one brand: the
    least owner. Brands shorter than ``least`` are not linkable (FLT-09).
    """
    named = brands.where(F.length(brand) >= least).groupBy(brand).agg(F.min(owner).alias(owner))
    sizes = sorted(r[0] for r in named.select(F.length(brand)).distinct().collect())  # no more than the letters of the longest brand
    known = F.array(*[F.lit(n) for n in sizes]).cast("array<int>")
    probes = rows.select("*", F.explode(F.filter(known, lambda n: n <= F.length(text))).alias("_n")).withColumn(brand, F.expr(f"substring({text}, 1, _n)"))
    met = probes.join(named, brand)
    return met.groupBy(*rows.columns).agg(F.max_by(F.struct(brand, owner), "_n").alias("_b")).select(*rows.columns, F.col(f"_b.{brand}").alias(brand), F.col(f"_b.{owner}").alias(owner))


def two_tier(rows: DataFrame, universe: DataFrame, exact: Sequence[str], coarse: Sequence[str]) -> DataFrame:
    """J-18: ``rows`` with ``tier`` and the matched exact key of ``universe``.

    The exact key where the universe has it, else the one universe key that shares the
    coarse key, else nothing: where two share it, none is guessed.
    """
    keys = universe.select(*exact, *coarse).distinct()
    first = keys.select(*exact, F.lit("exact").alias("_exact")).distinct()
    lone = keys.groupBy(*coarse).agg(F.count_distinct(*exact).alias("_n"), F.first(F.struct(*exact)).alias("_k")).where("_n = 1").drop("_n")
    joined = rows.join(first, list(exact), "left").join(lone, list(coarse), "left")
    tier = F.coalesce("_exact", F.when(F.col("_k").isNotNull(), "building"), F.lit("none"))
    matched = F.when(F.col("_exact").isNotNull(), F.struct(*exact)).otherwise(F.col("_k"))
    return joined.select(*rows.columns, tier.alias("tier"), *[matched[c].alias(f"matched_{c}") for c in exact])


def only_twin(broken: DataFrame, sound: DataFrame, keys: Sequence[str], broken_id: str, sound_id: str) -> DataFrame:
    """COR-05, J-20: ``(broken_id, twin_id, n_twins)``: the one sound row of the same key.

    ``twin_id`` is null unless there is exactly one; whoever must not go on with
    unpaired rows asserts that with :func:`kinlattice.operators.guards.require_none`.
    """
    twins = sound.groupBy(*keys).agg(F.count("*").alias("n_twins"), F.min(sound_id).alias("_twin"))
    out = broken.join(twins, list(keys), "left").withColumn("n_twins", F.coalesce("n_twins", F.lit(0)))
    return out.select(broken_id, F.when(F.col("n_twins") == 1, F.col("_twin")).alias("twin_id"), "n_twins")


def best(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in a total order (WIN-01 to WIN-09).

    ``row_number() = 1`` is planned with a group limit before the shuffle, so a hot
    key sends one row from each task.
    """
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def lookup_or_area(rows: DataFrame, points: DataFrame, zip_: str = "zip5", digits: int = 5) -> DataFrame:
    """J-22, AGG-19: ``lat, lng`` of the ZIP, else the mean of the ZIPs with the same first three digits."""
    area = points.groupBy(F.substring(zip_, 1, 3).alias("_z3")).agg(F.round(F.avg("lat"), digits).alias("_lat"), F.round(F.avg("lng"), digits).alias("_lng"))
    met = rows.join(points.select(zip_, "lat", "lng"), zip_, "left").join(area, F.substring(F.col(zip_), 1, 3) == F.col("_z3"), "left")
    return met.select(*rows.columns, F.coalesce("lat", "_lat").alias("lat"), F.coalesce("lng", "_lng").alias("lng"))


def prefix_within(rows: DataFrame, held: DataFrame, equi: Sequence[str], typed: str, stored: str, least: int = 10) -> DataFrame:
    """J-21, VAL-08: pairs of equal ``equi`` keys whose typed text begins with the stored one of at least ``least`` letters.

    The prefix is a residual of an equi-join, so only rows of one key are compared.
    """
    return rows.join(held.where(F.length(stored) >= least), list(equi)).where(F.col(typed).startswith(F.col(stored)))
