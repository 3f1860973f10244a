"""Best representative of each duplicate group (problem 6).

Records are unpivoted into long rows: every non-blank field is a vote for its
normalised value, with the weight source trust times recency decay. Summed per value,
the votes build a record field by field; summed per record, they name the record that
stands for its group. Winners are taken with ``max_by`` and pivoted back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlattice.functions.text import canonical

#: Measures of a record: votes cast (non-blank fields), recency, trust.
MEASURES = ("filled", "day", "trust")


def _day(c: Column) -> Column:
    """Days of a date, null the oldest."""
    return F.coalesce(F.datediff(c, F.lit("0001-01-01").cast("date")), F.lit(-1_000_000))


def votes(members: DataFrame, fields: Sequence[str], trust: str, updated: str, newest: dt.date | None, half_life_days: float = 365.0) -> DataFrame:
    """``(group_id, id, field, norm, value, weight, day, trust)``: one row per record and non-blank field.

    Weight is trust (null or negative: 0) times 2 ** -(age / half-life), age counted from
    ``newest``; a record without a date has the age of ten half-lives. Every record also
    casts an empty vote under the null field, so that none is lost.
    """
    age = F.coalesce(F.datediff(F.lit(newest).cast("date"), F.col(updated)), F.lit(10 * half_life_days)) / F.lit(half_life_days)
    given = F.col(trust).cast("double")
    standing = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields], F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value")))
    return members.select(
        "group_id", "id", (F.greatest(F.coalesce(given, F.lit(0.0)), F.lit(0.0)) * F.pow(F.lit(2.0), -age)).alias("weight"),
        _day(F.col(updated)).alias("day"), F.coalesce(given, F.lit(float("-inf"))).alias("trust"), F.explode(standing).alias("f"),
    ).select("group_id", "id", "f.field", canonical(F.col("f.value")).alias("norm"), "f.value", "weight", "day", "trust").where("field is null or norm is not null")


def golden(cast: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``(group_id, <fields>)``: per group the record built from ``cast`` (see :func:`votes`).

    Sums of votes are rounded to nine digits, so that the order in which parts arrive
    decides nothing; ties go to the most trusted, then the newest, then the greatest
    value, written as the least of its spellings. A field blank in all records is null.
    Two combinable aggregations, by value and by field: a group with a third of all
    records is never gathered.
    """
    per_value = cast.groupBy("group_id", "field", "norm").agg(
        F.round(F.sum(F.when(F.col("field").isNotNull(), F.col("weight"))), 9).alias("weight"), F.max("trust").alias("trust"), F.max("day").alias("day"), F.min("value").alias("value")
    )
    winners = per_value.groupBy("group_id", "field").agg(F.max_by("value", F.struct("weight", "trust", "day", "norm", "value")).alias("value"))
    return winners.groupBy("group_id").pivot("field", list(fields)).agg(F.first("value"))


def representatives(cast: DataFrame, completeness: Sequence[str]) -> DataFrame:
    """``(group_id, id, n_records, undisputed)``: the record that stands for its group.

    A record's votes under ``completeness`` fields are counted and their weights summed;
    the record with the most weight stands for the group (ties: most votes, newest, most
    trusted, then greatest id). Its three measures are unpivoted next to the best of each
    in the group: it is undisputed if it reaches all of them and no other record has the
    same three. Nothing that is undisputed can lose the vote, since weight grows with
    each measure. Groups of one are undisputed. Records alike in all measures are counted
    before groups are formed, so everything combines map-side and no group is gathered.
    """
    counted = F.when(F.col("field").isin(*completeness), 1).otherwise(0)
    record = cast.groupBy("group_id", "id").agg(F.sum(counted).alias("filled"), F.max("day").alias("day"), F.max("trust").alias("trust"), F.max("weight").alias("weight"))
    alike = record.groupBy("group_id", *MEASURES).agg(F.round(F.max("weight") * F.col("filled"), 9).alias("votes"), F.count("*").alias("n"), F.max("id").alias("id"))
    won = F.struct("votes", *MEASURES, "id")
    long = alike.select("group_id", "id", *MEASURES, "n", "votes", F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in MEASURES])).alias("m"))
    per_measure = long.groupBy("group_id", "m.measure").agg(
        F.max("m.value").alias("best"), F.max_by("m.value", won).alias("own"), F.max_by(F.struct("id", "n"), won).alias("chosen"), F.sum("n").alias("n_records")
    )
    wide = per_measure.groupBy("group_id").pivot("measure", list(MEASURES)).agg(*[F.first(c).alias(c) for c in ("best", "own", "chosen", "n_records")])
    alone = F.col("filled_chosen.n") == 1
    for m in MEASURES:
        alone = alone & (F.col(f"{m}_own") == F.col(f"{m}_best"))
    return wide.select("group_id", F.col("filled_chosen.id").alias("id"), F.col("filled_n_records").alias("n_records"), alone.alias("undisputed"))
