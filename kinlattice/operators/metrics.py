"""Published figures (AGG-01 to AGG-30, MET-04 to MET-10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlattice.functions.stats import share, wilson


def union_count(rows: DataFrame, by: Sequence[str], site: Sequence[str], name: str) -> DataFrame:
    """AGG-14: distinct sites per group, counted over the union and never as a sum of sets."""
    return rows.groupBy(*by).agg(F.count_distinct(*site).alias(name))


def size_buckets(rows: DataFrame, operator: str, site: Sequence[str], edges: Sequence[int] = (1, 2, 5, 10, 25)) -> DataFrame:
    """AGG-15: operators and distinct sites by size of operator.

    Operators are in one bucket each; a site that operators of two buckets share counts in both.
    """
    named = [f"{a}" if b == a + 1 else f"{a}-{b - 1}" for a, b in zip(edges, edges[1:])] + [f"{edges[-1]}+"]
    per = union_count(rows, [operator], site, "n")
    bucket = F.lit(None).cast("string")
    for least, label in zip(edges, named):
        bucket = F.when(F.col("n") >= least, label).otherwise(bucket)
    sized = rows.select(operator, *site).distinct().join(per.select(operator, bucket.alias("bucket")), operator)
    return sized.groupBy("bucket").agg(F.count_distinct(operator).alias("operators"), F.count_distinct(*site).alias("sites"))


def market_share(universe: DataFrame, seen: DataFrame, by: str, site: Sequence[str], least: int = 25) -> DataFrame:
    """MET-04, AGG-16/17, FLT-16: per area the sites of the universe, how many are tracked and their share.

    ``seen`` has the sites found of tracked owners, with ``is_private``. Areas with
    fewer than ``least`` sites are left out.
    """
    flags = seen.groupBy(*site).agg(F.bool_or("is_private").alias("is_private"))
    area = universe.where(F.col(by).isNotNull()).groupBy(*site).agg(F.min(by).alias(by))
    met = area.join(flags.withColumn("tracked", F.lit(True)), list(site), "left")
    out = met.groupBy(by).agg(F.count("*").alias("sites"), F.count_if("tracked").alias("tracked"), F.count_if("is_private").alias("private"))
    return out.where(F.col("sites") >= least).withColumns({"tracked_share": share(F.col("tracked"), F.col("sites")), "private_share": share(F.col("private"), F.col("sites"))})


def counts_or_zero(groups: DataFrame, rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """AGG-28, J-24: rows per group; groups without rows are kept with 0."""
    return groups.join(rows.groupBy(*keys).agg(F.count("*").alias(name)), list(keys), "left").withColumn(name, F.coalesce(name, F.lit(0)))


def breakdown(rows: DataFrame, by: Column, name: str, digits: int = 4) -> DataFrame:
    """AGG-01/04/20: count and fraction by value; null is "unknown"."""
    counted = rows.groupBy(F.coalesce(by, F.lit("unknown")).alias(name)).agg(F.count("*").alias("n"))
    return counted.withColumn("fraction", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), digits))


def compared(rows: DataFrame, ours: str, theirs: str) -> DataFrame:
    """AGG-24: totals of two counts that are both there, their ratio, and how often ours is higher, lower, equal."""
    both = rows.where(F.col(ours).isNotNull() & F.col(theirs).isNotNull())
    o, t = F.col(ours), F.col(theirs)
    return both.agg(
        F.count("*").alias("pairs"), F.count_if(o > 0).alias("measured"), F.sum(F.when(o > 0, o)).alias("ours"), F.sum(F.when(o > 0, t)).alias("theirs"),
        F.count_if((o > 0) & (o > t)).alias("higher"), F.count_if((o > 0) & (o < t)).alias("lower"), F.count_if((o > 0) & (o == t)).alias("equal"),
    ).withColumn("ratio", F.round(F.try_divide(F.col("ours").cast("double"), F.col("theirs").cast("double")), 2))


def spread(rows: DataFrame, part: str, whole: str, least: int = 10) -> DataFrame:
    """AGG-25: least and greatest ratio over rows with at least ``least`` in ``part``; those without a ratio counted."""
    big = rows.where(F.col(part) >= least).withColumn("_r", F.round(F.try_divide(F.col(part).cast("double"), F.nullif(F.col(whole).cast("double"), F.lit(0.0))), 1))
    return big.agg(F.count("*").alias("n"), F.min("_r").alias("least_ratio"), F.max("_r").alias("greatest_ratio"), F.count_if(F.col("_r").isNull()).alias("without_ratio"))


def tallies(rows: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """AGG-06, VAL-05: agree, disagree, unclear, and agree / (agree + disagree), null without either."""
    n = lambda v: F.count_if(F.lower(F.trim(label)) == v)
    out = rows.groupBy(*by).agg(F.count("*").alias("n"), n("agree").alias("agree"), n("disagree").alias("disagree"), n("unclear").alias("unclear"))
    return out.withColumn("accuracy", F.round(F.try_divide(F.col("agree").cast("double"), (F.col("agree") + F.col("disagree")).cast("double")), 4))


def rates(rows: DataFrame, by: Sequence[str], hit: Column, digits: int = 6) -> DataFrame:
    """VAL-06/07: hits among all rows of a stratum, with the Wilson interval; unknown is no hit but counts."""
    out = rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.coalesce(hit, F.lit(False))).alias("k"))
    ci = wilson(F.col("k"), F.col("n"))
    return out.withColumns({"rate": F.round(F.col("k") / F.col("n"), digits), "low": F.round(ci["low"], digits), "high": F.round(ci["high"], digits)})


def release_diff(before: DataFrame, after: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Q-11: what one release has that the other has not, by key: added, removed, changed."""
    b, a = (d.select(F.col(key).alias("k"), F.struct(*values).alias("v")) for d in (before, after))
    met = b.alias("b").join(a.alias("a"), F.col("a.k") == F.col("b.k"), "full")
    kind = F.when(F.col("b.k").isNull(), "added").when(F.col("a.k").isNull(), "removed").when(~F.col("a.v").eqNullSafe(F.col("b.v")), "changed")
    return met.select(F.coalesce("a.k", "b.k").alias(key), kind.alias("change_kind")).where("change_kind is not null")


def grade(directory: Column, in_home: Column, updated: Column, as_of: Column) -> Column:
    """MET-08, DAT-05: grade of a site by evidence and age; ``as_of`` instead of today."""
    years = F.datediff(as_of, updated) / F.lit(365.25)
    return F.when(directory, "owner_verified").when(in_home, "in_home").when(updated.isNull(), "registry_undated").when(years < 3, "registry_current").when(years < 6, "registry_aging").otherwise("registry_stale")


def status_rollup(rows: DataFrame, status: str, in_scope: Sequence[str], size: str) -> DataFrame:
    """AGG-22: rows by status, those in scope, and the size of what is in scope but not covered, in one aggregation."""
    n = lambda *v: F.count_if(F.col(status).isin(*v))
    covered = in_scope[0]
    return rows.agg(F.count("*").alias("listed"), n(*in_scope).alias("in_scope"), *[n(s).alias(f"n_{s}") for s in in_scope], F.coalesce(F.sum(F.when(F.col(status).isin(*in_scope) & (F.col(status) != covered), F.col(size))), F.lit(0)).alias("uncovered_size"))


def totals_where(rows: DataFrame, sure: Column, amounts: Sequence[str], names: str) -> DataFrame:
    """AGG-23: totals of each amount over the rows that are sure, never of two amounts together, with the sorted names."""
    return rows.where(F.coalesce(sure, F.lit(False))).agg(F.count("*").alias("n"), *[F.sum(a).alias(a) for a in amounts], F.sort_array(F.collect_set(names)).alias("names"))


def most_common(rows: DataFrame, by: str, n: int) -> DataFrame:
    """AGG-21, TOP-03: the ``n`` values with most rows and their place, ties by value."""
    counted = rows.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), by).limit(n)
    return counted.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), by)))  # over n rows


def intake(rows: DataFrame, source: str, failed: Column, same: Sequence[str]) -> DataFrame:
    """AGG-30: seen, staged, skipped (a repeat within its source) and failed rows by source, and over all as ``all``.

    Repeats are counted, not numbered: of equal rows that did not fail one is staged.
    """
    alike = rows.groupBy(F.col(source).alias("source"), failed.alias("_f"), *same).agg(F.count("*").alias("n"))
    per = alike.groupBy("source").agg(F.sum("n").alias("seen"), F.count_if(~F.col("_f")).alias("staged"), F.sum(F.when(F.col("_f"), 0).otherwise(F.col("n") - 1)).alias("skipped"), F.sum(F.when(F.col("_f"), F.col("n")).otherwise(0)).alias("failed"))
    return per.unionByName(per.agg(*[F.sum(c).alias(c) for c in ("seen", "staged", "skipped", "failed")]).withColumn("source", F.lit("all")))


def recall(cases: DataFrame, found: DataFrame, keys: Sequence[str], by: str, digits: int = 6) -> DataFrame:
    """VAL-07: of all distinct ``cases``, how many each ``by`` found, with the Wilson interval; the number of cases comes in one row."""
    n = cases.select(*keys).distinct().count()
    out = found.join(cases.select(*keys).distinct(), list(keys), "left_semi").groupBy(by).agg(F.count_distinct(*keys).alias("k")).withColumn("n", F.lit(n).cast("bigint"))
    ci = wilson(F.col("k"), F.col("n"))
    return out.select(by, "n", "k", F.round(F.col("k") / F.col("n"), digits).alias("rate"), F.round(ci["low"], digits).alias("low"), F.round(ci["high"], digits).alias("high"))
