"""Queries of the training-data problems."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlattice.functions.text import blank_to_null, canonical, canonical_id
from kinlattice.llm import addresses, components, leaks, linkage, mixture, subjects, survivor
from kinlattice.runtime import stage, table

COMPLETENESS = ("address_line1", "city", "state", "zip", "npi", "owner_entity_id", "registry_status")
GOLDEN = ("name", *COMPLETENESS)


def _clinic_groups(spark: SparkSession, root: str) -> DataFrame:
    return components.record_groups(table(spark, root, "clinic"), table(spark, root, "match_pair"))


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return _clinic_groups(spark, root).select(F.col("id").alias("clinic_id"), "group_id")


def _cast(spark: SparkSession, root: str) -> DataFrame:
    """The votes of clinic records of groups of two or more; recency counts from the newest date of the table."""
    clinics = table(spark, root, "clinic").withColumn("id", canonical_id(F.col("id")))
    newest = clinics.agg(F.max("registry_last_updated")).first()[0]
    members = clinics.select("id", *GOLDEN, "confidence_score", "registry_last_updated").join(_clinic_groups(spark, root), "id")
    return survivor.votes(members, GOLDEN, "confidence_score", "registry_last_updated", newest)


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    chosen = survivor.representatives(_cast(spark, root), COMPLETENESS)
    return chosen.where("undisputed and n_records > 1").select("group_id", F.col("id").alias("clinic_id"))


def p6_golden_records(spark: SparkSession, root: str) -> DataFrame:
    """The record built for each group, field by field, with the record that stands for it."""
    cast = stage(_cast(spark, root), "votes")
    return survivor.golden(cast, GOLDEN).join(survivor.representatives(cast, COMPLETENESS).withColumnRenamed("id", "survivor_id"), "group_id")


def p4_confidences(spark: SparkSession, root: str) -> DataFrame:
    """Every staged row and center at one location, with the confidence that they are one operator."""
    address = ("address_line1", "city", "state", "zip")
    staged = table(spark, root, "staging_bacb_provider").select(canonical_id(F.col("id")).alias("id"), F.col("raw_name").alias("name"), "npi", *address)
    centers = table(spark, root, "roster_center").select(canonical_id(F.col("center_id")).alias("id"), F.col("owner_name").alias("name"), *address)
    return linkage.link(staged, centers, table(spark, root, "owner_entity").select("name", "trade_name"))


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return p4_confidences(spark, root).where("confidence >= 0.5").select("staging_id", "center_id")


def _located_staging(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "staging_bacb_provider").select(canonical_id(F.col("id")).alias("id"), "raw_name", "npi", *addresses.ADDRESS)
    return addresses.locate(rows, F.coalesce(blank_to_null(F.col("npi")), canonical(F.col("raw_name"))))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return addresses.location_pairs(_located_staging(spark, root)).select(F.col("a").alias("staging_id_a"), F.col("b").alias("staging_id_b"))


def p5_premises(spark: SparkSession, root: str) -> DataFrame:
    """The location of each staged row that has an address."""
    return addresses.premises(_located_staging(spark, root))


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    return leaks.leaks(table(spark, root, "documents"), table(spark, root, "eval_item")).select("doc_id", "item_id")


def p7_leaked_items(spark: SparkSession, root: str) -> DataFrame:
    """Per test item, in how many documents it leaked and how much of it at most."""
    found = leaks.leaks(table(spark, root, "documents"), table(spark, root, "eval_item"))
    return found.groupBy("item_id").agg(F.count("*").alias("n_documents"), F.max("n_words").alias("most_words"))


#: Folder of the public tokenizers' vocabularies; never copied into the repository.
TOKENIZERS = os.environ.get("TOKENIZERS", "/opt/tokenizers")


def _mixture(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, root, "documents").select("doc_id", "source", "text")
    return mixture.mix(mixture.count_tokens(docs, f"{TOKENIZERS}/byte_bpe_50k.json"), table(spark, root, "mix_target"))


def p8_mixture(spark: SparkSession, root: str) -> DataFrame:
    """Each document of the mixture and how often it is used."""
    return _mixture(spark, root)[0]


def p8_shares(spark: SparkSession, root: str) -> DataFrame:
    """Target and reached share of each source."""
    return _mixture(spark, root)[1]


def _subjects(spark: SparkSession, root: str) -> DataFrame:
    return subjects.subjects(table(spark, root, "documents"), table(spark, root, "subject_seed"), table(spark, root, "subject_area"))


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    return _subjects(spark, root).select("doc_id", "subject")


def p9_composition(spark: SparkSession, root: str) -> DataFrame:
    """The corpus by subject: documents and sentences."""
    return _subjects(spark, root).groupBy("subject").agg(F.count("*").alias("n_documents"), F.sum("n_sentences").alias("n_sentences"))


_MATCH = "lower(trim(verdict)) = 'match'"
_GROUPS = f"""
with recursive ids as (select distinct lower(trim(id)) as id from clinic),
e as (select lower(trim(id)) as a, lower(trim(superseded_by)) as b from clinic where trim(superseded_by) != ''
  union select lower(trim(left_id)), lower(trim(right_id)) from match_pair where {_MATCH}),
v as (select a, b from e where a != b and a in (select id from ids) and b in (select id from ids)),
s as (select a, b from v union select b, a from v),
r as (select a as id, a as g from s union select s.a, r.g from r join s on s.b = r.id),
groups as (select id, min(g) as group_id from r group by 1)
"""
_TEXT = "nullif(lower(trim(regexp_replace(value, '[\\s\u00a0]+', ' ', 'g'))), '')"
_FILLED = " + ".join(f"(coalesce(trim({c}), '') != '')::int" for c in COMPLETENESS)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p4_found": p4_found,
    "p4_confidences": p4_confidences,
    "p5_found": p5_found,
    "p5_premises": p5_premises,
    "p6_found": p6_found,
    "p6_golden_records": p6_golden_records,
    "p7_found": p7_found,
    "p7_leaked_items": p7_leaked_items,
    "p8_mixture": p8_mixture,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_composition": p9_composition,
}

ORACLE: dict[str, str] = {
    "p1_found": _GROUPS + "select id as clinic_id, group_id from groups",
    "p6_found": _GROUPS + f""", m as (
  select g.group_id, c.id, {_FILLED} as n, coalesce(registry_last_updated, date '0001-01-01') as d, coalesce(confidence_score, -1) as s
  from clinic c join groups g on g.id = c.id)
select group_id, id as clinic_id from m x where not exists (
  select 1 from m y where y.group_id = x.group_id and y.id != x.id
  and not (x.n >= y.n and x.d >= y.d and x.s >= y.s and (x.n > y.n or x.d > y.d or x.s > y.s)))""",
    "p6_golden_records": _GROUPS + f""", m as (
  select g.group_id, lower(trim(c.id)) as id, {", ".join(GOLDEN)}, {_FILLED} as filled, coalesce(registry_last_updated - date '0001-01-01', -1000000) as day, coalesce(confidence_score, '-infinity'::double) as trust,
    greatest(coalesce(confidence_score, 0), 0) * pow(2.0, -coalesce(((select max(registry_last_updated) from clinic) - registry_last_updated)::double, 3650.0) / 365.0) as w
  from clinic c join groups g on g.id = lower(trim(c.id))),
w as ({" union all ".join(f"select group_id, '{f}' as field, cast({f} as varchar) as value, w, day, trust from m" for f in GOLDEN)}),
p as (select group_id, field, {_TEXT} as norm, round(sum(w), 9) as w, max(trust) as trust, max(day) as day, min(value) as value from w where {_TEXT} is not null group by all),
b as (select group_id, field, value from p qualify row_number() over (partition by group_id, field order by w desc, trust desc, day desc, norm desc, value desc) = 1),
x as (select *, max(w) over (partition by group_id, filled, day, trust) as most from m),
z as (
  select group_id, id as survivor_id, count(*) over g as n_records,
    filled = max(filled) over g and day = max(day) over g and trust = max(trust) over g and count(*) over (partition by group_id, filled, day, trust) = 1 as undisputed,
    row_number() over (partition by group_id order by round(most * filled, 9) desc, filled desc, day desc, trust desc, id desc) as r
  from x window g as (partition by group_id))
select group_id, {", ".join(f"max(value) filter (where field = '{f}') as {f}" for f in GOLDEN)}, any_value(survivor_id) as survivor_id, any_value(n_records) as n_records, any_value(undisputed) as undisputed
from (select * from z where r = 1) join m using (group_id) left join b using (group_id) group by group_id""",
}
