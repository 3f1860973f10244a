"""Assertions and idempotence (VAL-09 to VAL-11, IDM-01 to IDM-07, SET-03/04)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_none(df: DataFrame, what: str, show: int = 5) -> None:
    """Raises if ``df`` has rows, naming a few; reads no more than those."""
    rows = df.limit(show).collect()
    if rows:
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in rows))


def require_at_least(df: DataFrame, n: int, what: str) -> DataFrame:
    """IDM-07: refuses partial input; stops reading once ``n`` rows are there."""
    got = df.limit(n).count()
    if got < n:
        raise ValueError(f"{what}: {got} rows, at least {n} expected")
    return df


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> DataFrame:
    """VAL-11, SET-04."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks {', '.join(missing)}")
    return df


def missing_keys(wanted: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SET-03: distinct wanted keys that are not present."""
    return wanted.select(*keys).distinct().join(present.select(*keys), list(keys), "left_anti")


def raise_on_null(df: DataFrame, column: str, what: str) -> DataFrame:
    """J-25: the job fails on the first row whose ``column`` is null; the check runs inside the plan."""
    return df.withColumn(column, F.coalesce(F.col(column), F.raise_error(F.lit(what)).cast(df.schema[column].dataType)))


def fresh(incoming: DataFrame, held: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """IDM-01/02: incoming rows whose key is neither held nor repeated in the batch; the first in ``order`` stays.

    Rows with a null in the key are always fresh, as under a partial unique index.
    """
    from kinlattice.operators.joins import best

    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    keyed = best(incoming.where(whole), keys, [F.col(c) for c in order])
    return keyed.join(held.select(*keys), list(keys), "left_anti").unionByName(incoming.where(~whole))


def upsert_missing(wanted: DataFrame, held: DataFrame, name: str) -> DataFrame:
    """ER-06, FLT-03: wanted names that are not held, whatever their case; one spelling each, the least."""
    one = wanted.where(F.trim(name) != "").groupBy(F.lower(F.trim(name)).alias("_k")).agg(F.min(F.trim(name)).alias(name))
    return one.join(held.select(F.lower(F.trim(name)).alias("_k")).distinct(), "_k", "left_anti").drop("_k")


def require_covered(platforms: DataFrame, owners: DataFrame, name: str, status: str, listed: str, owner: str) -> DataFrame:
    """VAL-09: every platform that counts as covered names operators, and every operator it names exists; else raises with a few."""
    covered = platforms.where(F.col(status) == "covered")
    require_none(covered.where(F.coalesce(F.size(listed), F.lit(0)) <= 0).select(name), "covered without operators")
    named = covered.select(name, F.explode(listed).alias(owner))
    require_none(named.join(owners.select(owner).distinct(), owner, "left_anti"), "operators that do not exist")
    return platforms
