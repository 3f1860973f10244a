"""References to records that do not exist (problem 3).

Keys are dictionary-encoded as integers. Per parent table the codes become
bitmaps: 64 neighbouring codes are one word, a word of zeros is not stored, and
every word carries the period it speaks of. Reference AND-NOT parent leaves the
bits of keys that are missing; only those are decoded back to keys and records.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlattice.functions.text import canonical_id
from kinlattice.runtime import adaptive, drop_stage, stage

#: Bits of one stored word.
WORD = 64


def references(df: DataFrame, table_name: str, fields: dict[str, str], record: str = "id", at: str = "extracted_at") -> DataFrame:
    """``(table_name, period, record_id, ref_field, ref_key, parent, at)``, one row per reference made.

    ``fields`` maps a reference column (text or array of text) to its parent table.
    Keys are trimmed and lower case; null, blank and null elements are no references.
    ``period`` is ``yyyy-MM`` of ``at``, null where that is null.
    """
    kinds = dict(df.dtypes)

    def made(field: str, parent: str) -> Column:
        keys = F.col(field) if kinds[field].startswith("array") else F.array(F.col(field))
        return F.transform(keys, lambda k: F.struct(F.lit(field).alias("ref_field"), canonical_id(k).alias("ref_key"), F.lit(parent).alias("parent")))

    refs = [made(f, p) for f, p in fields.items()]
    none = F.array().cast("array<struct<ref_field:string,ref_key:string,parent:string>>")
    return (
        df.select(F.col(record).alias("record_id"), F.col(at).alias("at"), F.explode(F.concat(*[F.coalesce(r, none) for r in refs])).alias("r"))
        .where(F.col("r.ref_key").isNotNull())
        .select(F.lit(table_name).alias("table_name"), F.date_format("at", "yyyy-MM").alias("period"), "record_id", "r.ref_field", "r.ref_key", "r.parent", "at")
    )


def parents(df: DataFrame, name: str, key: str = "id", created: str = "created_at") -> DataFrame:
    """``(parent, ref_key, created)`` of a parent table."""
    return df.select(F.lit(name).alias("parent"), canonical_id(F.col(key)).alias("ref_key"), F.col(created).alias("created")).where("ref_key is not null")


def orphans(refs: DataFrame, held: DataFrame) -> DataFrame:
    """Distinct references whose parent is missing or was created after the reference.

    ``refs`` as of :func:`references`, ``held`` as of :func:`parents`, each the union
    over all tables. A parent listed twice counts from its earliest creation, one
    without a creation time has always existed; a reference without a time is an
    orphan only if its parent does not exist at all. Without references the result is
    empty; without parents every reference is an orphan.

    Distinct (parent, key, period) are taken before anything is encoded, so a key
    that a third of all rows refer to is one row per period from there on. The rows
    themselves meet only the decoded orphans, in a join that AQE broadcasts or splits.
    """
    adaptive(refs.sparkSession)
    # Exploded and made canonical once; the distinct keys read three of its columns, the report all.
    refs = stage(refs, "references")
    ever = F.lit("0000-00")
    cited = refs.select("parent", "ref_key", F.coalesce("period", F.lit("9999-99")).alias("period")).distinct()
    by_key = cited.select("parent", "ref_key", F.lit(False).alias("held"), F.lit(None).cast("timestamp_ntz").alias("created")).unionByName(
        held.select("parent", "ref_key", F.lit(True).alias("held"), F.coalesce(F.col("created").cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz")).alias("created"))
    )
    # Dense runs of codes per task: written before use, so that no retry can renumber it.
    dictionary = stage(
        by_key.groupBy("parent", "ref_key").agg(F.max("held").alias("held"), F.min("created").alias("created")).withColumn("code", F.monotonically_increasing_id()),
        "dictionary",
    )
    word, bit = F.shiftright("code", 6).alias("word"), F.expr(f"shiftleft(1L, cast(code % {WORD} as int))")
    cited_words = cited.join(dictionary.select("parent", "ref_key", "code"), ["parent", "ref_key"]).groupBy("parent", "period", word).agg(F.bit_or(bit).alias("cited"))
    month = F.when(F.col("created") < F.lit("0002-01-01").cast("timestamp_ntz"), ever).otherwise(F.date_format("created", "yyyy-MM"))
    held_words = (
        dictionary.where("held")
        .groupBy("parent", word, month.alias("month"))
        .agg(F.bit_or(bit).alias("bits"))
        .groupBy("parent", "word")
        .agg(F.collect_list(F.struct("month", "bits")).alias("months"))  # at most one entry per code of the word
    )
    zero = F.lit(0).cast("bigint")
    union_of = lambda keep: F.aggregate(F.coalesce(F.filter("months", keep), F.array().cast("array<struct<month:string,bits:bigint>>")), zero, lambda a, m: a.bitwiseOR(m.bits))
    left = cited_words.join(held_words, ["parent", "word"], "left").select(
        "parent", "period", "word",
        # missing, or created in a later month
        F.col("cited").bitwiseAND(F.bitwise_not(union_of(lambda m: m.month <= F.col("period")))).alias("lost"),
        # created in the very month: the clock decides, reference by reference
        F.col("cited").bitwiseAND(union_of(lambda m: m.month == F.col("period"))).alias("close"),
    ).where("lost != 0 or close != 0")
    at_bit = lambda bits, i: F.expr(f"shiftrightunsigned({bits}, {i}) & 1L") == 1
    decoded = left.select("parent", "period", "word", "lost", "close", F.explode(F.sequence(F.lit(0), F.lit(WORD - 1))).alias("i")).where(at_bit("lost | close", "i")).select(
        "parent", "period", (F.col("word") * WORD + F.col("i")).alias("code"), at_bit("lost", "i").alias("lost")
    )
    found = decoded.join(dictionary.select("parent", "ref_key", "code", "created"), ["parent", "code"]).select("parent", "ref_key", F.nullif("period", F.lit("9999-99")).alias("period"), "lost", "created")
    suspects = stage(found, "suspects")
    drop_stage(dictionary)
    same = (F.col("r.parent") == F.col("s.parent")) & (F.col("r.ref_key") == F.col("s.ref_key")) & F.col("r.period").eqNullSafe(F.col("s.period"))
    return (
        refs.alias("r")
        .join(suspects.alias("s"), same)
        .where(F.col("s.lost") | (F.col("s.created") > F.col("r.at").cast("timestamp_ntz")))
        .select("r.table_name", "r.period", "r.record_id", "r.ref_field", "r.ref_key")
        .distinct()
    )


def orphan_report(found: DataFrame) -> DataFrame:
    """``(table_name, period, ref_field, n_references, n_keys)`` of orphans."""
    return found.groupBy("table_name", "period", "ref_field").agg(F.count("*").alias("n_references"), F.countDistinct("ref_key").alias("n_keys"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    """All parts, by name."""
    return reduce(DataFrame.unionByName, parts)
