"""Deduplication and corrections as side tables (COR-01 to COR-13).

Nothing is updated in place: an operator returns which row gives way to which, or
which row is contradicted, and "current" is an anti-join against that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlattice.functions.dates import years_between
from kinlattice.operators.joins import best


def superseded(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], row: str = "id") -> DataFrame:
    """COR-01, WIN-02..04: ``(id, survivor_id)`` for every row that is not the first of its key in ``order``.

    Two aggregable steps: the survivor of each key is found with a group limit, and
    the rows then meet it in a join; no group is gathered in a window. Rows with a null key have no duplicates.
    """
    whole = rows.where(" and ".join(f"{k} is not null" for k in keys))
    first = best(whole, keys, order).select(*keys, F.col(row).alias("survivor_id"))
    return whole.join(first, list(keys)).where(F.col(row) != F.col("survivor_id")).select(F.col(row).alias("id"), "survivor_id")


def spread_over(rows: DataFrame, keys: Sequence[str], by: str, least: int = 2) -> DataFrame:
    """COR-02: rows of keys under which at least ``least`` different ``by`` occur."""
    many = rows.groupBy(*keys).agg(F.count_distinct(by).alias("_n")).where(F.col("_n") >= least).select(*keys)
    return rows.join(many, list(keys), "left_semi")


def ghosts(rows: DataFrame, keys: Sequence[str], parent: str, day: str, years: float = 2.0, row: str = "id") -> DataFrame:
    """COR-03, J-19, WIN-06: ``(keys, stale_id, live_id, gap_years)``, at most one per key.

    Keys with two parents or more and two dated rows or more, whose oldest and newest
    row have different parents and lie at least ``years`` apart. Ties go by parent and id.
    """
    dated = rows.where(F.col(day).isNotNull() & F.col(parent).isNotNull())
    ends = dated.groupBy(*keys).agg(F.min(F.struct(day, parent, row)).alias("o"), F.max(F.struct(day, parent, row)).alias("n"), F.count("*").alias("c"))
    gap = years_between(F.col(f"n.{day}"), F.col(f"o.{day}"))
    return ends.where((F.col("c") > 1) & (F.col(f"o.{parent}") != F.col(f"n.{parent}")) & (gap >= years)).select(*keys, F.col(f"o.{row}").alias("stale_id"), F.col(f"n.{row}").alias("live_id"), F.round(gap, 4).alias("gap_years"))


def building_collapse(rows: DataFrame, listed: DataFrame, order: Sequence[Column], row: str = "id") -> DataFrame:
    """COR-04: ``(id, survivor_id)`` at building grain, with a directory as authority.

    ``rows``: id, owner, street, building, zip5 and what ``order`` needs; ``listed``:
    street, building, zip5. A building that the directory lists once collapses to one
    row; listed more often, only equal streets collapse, and a row without a unit
    into its owner's only row with one; not listed, nothing. The first rule that
    names a row counts, and a survivor of the first is never folded away by it.
    """
    at = ["building", "zip5"]
    centers = listed.groupBy(*at).agg(F.count_distinct("street").alias("n_listed"))
    known = rows.join(centers, at)
    one = superseded(known.where("n_listed = 1"), at, order, row)
    more = known.where("n_listed > 1")
    equal = superseded(more, ["street", "zip5"], order, row)
    left = more.join(equal.select(F.col("id").alias(row)), row, "left_anti")
    suited = left.where("street != building").groupBy("owner", *at).agg(F.count("*").alias("n"), F.min(row).alias("survivor_id")).where("n = 1").drop("n")
    folded = left.where("street = building").join(suited, ["owner", *at]).select(F.col(row).alias("id"), "survivor_id")
    return one.unionByName(equal).unionByName(folded)


def contradicted(rows: DataFrame, listed: DataFrame, keys: Sequence[str], least_listed: int = 1) -> DataFrame:
    """COR-06/07, J-16/17: rows whose key the list does not have; refuses a list of fewer than ``least_listed`` keys."""
    from kinlattice.operators.guards import require_at_least

    known = listed.select(*keys).distinct()
    if least_listed > 1:
        require_at_least(known, least_listed, "listed places")
    return rows.join(known, list(keys), "left_anti")


def corroborated(rows: DataFrame, evidence: DataFrame, keys: Sequence[str], array: str, source: str, order: Sequence[str]) -> DataFrame:
    """COR-11, WIN-09, ARR-01: ``rows`` with the first source of matching evidence appended to their array."""
    from kinlattice.functions.arrays import append_absent

    first = best(evidence.where(F.col(source).isNotNull()), keys, [F.col(c) for c in order]).select(*keys, F.col(source).alias("_s"))
    return rows.join(first, list(keys), "left").withColumn(array, append_absent(F.col(array), F.col("_s"))).drop("_s")


def freshened(rows: DataFrame, evidence: DataFrame, key: str, day: str, extra: Sequence[str] = ()) -> DataFrame:
    """COR-13, AGG-18: ``rows`` with the newest evidence of their key filled in where it is newer or theirs is null."""
    top = evidence.where(F.col(key).isNotNull() & F.col(day).isNotNull()).groupBy(key).agg(F.max(F.struct(day, *extra)).alias("_e"))
    out = rows.join(top, key, "left")
    newer = F.col("_e").isNotNull() & (F.col(day).isNull() | (F.col(f"_e.{day}") >= F.col(day)))
    return out.select(*[F.when(newer, F.col(f"_e.{c}")).otherwise(F.col(c)).alias(c) if c in (day, *extra) else F.col(c) for c in rows.columns])


def owner_moves(edges: DataFrame, moves: DataFrame, row: str = "id") -> DataFrame:
    """COR-10: ``edges`` with ``old_owner`` replaced by ``new_owner`` where ``moves`` says so and the new owner has edges of its own."""
    there = edges.select(F.col("owner").alias("new_owner")).distinct()
    sure = moves.join(there, "new_owner", "left_semi").select(F.col("old_owner").alias("owner"), "new_owner")
    return edges.join(sure, "owner", "left").withColumn("moved", F.col("new_owner").isNotNull()).withColumn("owner", F.coalesce("new_owner", "owner")).drop("new_owner")


def running_first(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, name: str) -> DataFrame:
    """WIN-08: the first non-null ``value`` of a key in ``order``, with every row of it."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumn(name, F.first(value, ignorenulls=True).over(w))


def known_and_new(listed: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """COR-12: ``listed`` with ``known``: whether a row of the same key is there already."""
    there = rows.select(*keys).distinct().withColumn("known", F.lit(True))
    return listed.join(there, list(keys), "left").withColumn("known", F.coalesce("known", F.lit(False)))


def ruled(rows: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """COR-08: rows that a rule takes out, with the first rule that holds; null predicates do not hold."""
    rule = F.coalesce(*[F.when(F.coalesce(p, F.lit(False)), F.lit(n)) for n, p in rules])
    return rows.withColumn("rule", rule).where("rule is not null")
