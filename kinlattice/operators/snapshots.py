"""What changed between consecutive full snapshots (problem 2).

Each snapshot is reduced to one row per key, all of them are range-partitioned
and sorted by key and delivery, and one streaming pass per range walks the
snapshots of a key side by side: a row is compared with the row of the delivery
before and after it, exactly as two pointers over sorted files would meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def deliveries(rows: DataFrame, snapshot: str = "snapshot") -> DataFrame:
    """``(snapshot, ord, next_snapshot)``: the deliveries present, in order.

    As many rows as there are deliveries, which is what makes it safe to broadcast.
    """
    w = Window.orderBy(snapshot)
    return (
        rows.select(snapshot)
        .where(F.col(snapshot).isNotNull())
        .distinct()
        .select(snapshot, F.row_number().over(w).alias("ord"), F.lead(snapshot).over(w).alias("next_snapshot"))
    )


def one_per_key(rows: DataFrame, snapshot: str, key: str, latest: Column, values: Sequence[str]) -> DataFrame:
    """One row per key and delivery: the one with the greatest ``latest``.

    Null counts as oldest; among equals the greatest values win, so repeated rows
    and any order of rows give one result. ``max`` combines before the shuffle: a
    key that holds a third of all rows leaves each map task as one row a delivery.
    """
    return (
        rows.where(F.col(key).isNotNull() & F.col(snapshot).isNotNull())
        .groupBy(key, snapshot)
        .agg(F.max(F.struct(latest.alias("_latest"), *values)).alias("_v"))
        .select(key, snapshot, F.struct(*[F.col("_v")[v].alias(v) for v in values]).alias("_v"))
    )


def range_sorted(reduced: DataFrame, key: str, order: str) -> DataFrame:
    """Range-partitioned and sorted by key, deliveries of a key side by side."""
    return reduced.repartitionByRange(F.col(key)).sortWithinPartitions(key, order)


def keep(reduced: DataFrame, key: str, path: str) -> None:
    """Writes one delivery (see :func:`one_per_key`), range-partitioned and sorted by key, to stay for the next one."""
    range_sorted(reduced, key, key).write.mode("errorifexists").parquet(path)


def between(old: DataFrame, new: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """``(key, change_kind, changed_columns)`` of two kept deliveries, read alone, whatever came before.

    A full outer merge join walks both sides in key order with two pointers; keys are
    unique in a delivery, so no key is hot. The same as :func:`changes` says of the later one.
    """
    met = old.select(key, F.col("_v").alias("_old")).hint("merge").join(new.select(key, F.col("_v").alias("_new")), key, "full")
    differs = _differing(values, "_new", "_old")
    kind = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.size(differs) > 0, "changed")
    return met.select(key, kind.alias("change_kind"), F.when(kind == "changed", differs).otherwise(F.array().cast("array<string>")).alias("changed_columns")).where("change_kind is not null")


def _differing(values: Sequence[str], a: str, b: str) -> Column:
    """Names of the values that differ; null and null are equal."""
    return F.filter(F.array(*[F.when(~F.col(f"{a}.{v}").eqNullSafe(F.col(f"{b}.{v}")), F.lit(v)) for v in values]), lambda x: x.isNotNull())


def changes(rows: DataFrame, snapshot: str, key: str, latest: Column, values: Sequence[str]) -> DataFrame:
    """``(snapshot, key, change_kind, changed_columns)`` between consecutive deliveries.

    ``rows`` holds full snapshots with values already in comparable form. Kinds are
    added, removed and changed; the snapshot is the later of the two, and the first
    delivery has no rows. ``changed_columns`` lists what differs (null and null are
    equal) and is empty for added and removed. Rows without key or snapshot are
    no records. No rows, or one delivery, give an empty result.
    """
    at = deliveries(rows, snapshot)
    reduced = one_per_key(rows, snapshot, key, latest, values)
    merged = range_sorted(reduced.join(F.broadcast(at), snapshot), key, "ord")
    w = Window.partitionBy(key).orderBy("ord")
    seen = merged.select(
        key, snapshot, "next_snapshot", "ord", "_v",
        F.lag("ord").over(w).alias("_before"), F.lag("_v").over(w).alias("_old"), F.lead("ord").over(w).alias("_after"),
    )
    differs = _differing(values, "_v", "_old")
    none = F.array().cast("array<string>")
    event = lambda when, kind, columns: F.struct(when.alias(snapshot), F.lit(kind).alias("change_kind"), columns.alias("changed_columns"))
    events = F.array(
        F.when((F.col("ord") > 1) & (F.col("_before").isNull() | (F.col("_before") < F.col("ord") - 1)), event(F.col(snapshot), "added", none)),
        F.when((F.col("_before") == F.col("ord") - 1) & (F.size(differs) > 0), event(F.col(snapshot), "changed", differs)),
        F.when(F.col("next_snapshot").isNotNull() & (F.col("_after").isNull() | (F.col("_after") > F.col("ord") + 1)), event(F.col("next_snapshot"), "removed", none)),
    )
    return (
        seen.select(key, F.explode(F.filter(events, lambda x: x.isNotNull())).alias("e"))
        .select(F.col(f"e.{snapshot}").alias(snapshot), key, "e.change_kind", "e.changed_columns")
    )
