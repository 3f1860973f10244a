"""Queries of the general data-pipeline problems (2 and 3)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlattice.functions.dates import iso_text
from kinlattice.functions.text import blank_to_null, canonical, canonical_id
from kinlattice.operators import orphans, snapshots
from kinlattice.runtime import table

CONTENT = ("raw_name", "address_line1", "city", "state", "zip", "registry_status", "registry_last_updated")
REFERS = {"source_record_ids": "source_record", "owner_entity_id": "owner_entity", "parent_pe_firm_id": "parent_pe_firm"}
REFERRING = ("clinic", "resolution_claim", "owner_entity", "parent_pe_firm")


def registry_changes(spark: SparkSession, root: str) -> DataFrame:
    """Changes of the registered content of primary rows, with the columns that differ."""
    reg = table(spark, root, "registry_snapshot")
    rows = reg.where(F.lower(F.trim("location_kind")) == "primary").select(
        F.trim("snapshot_id").alias("snapshot_id"),
        blank_to_null(F.col("npi")).alias("npi"),
        *[(iso_text if c == "registry_last_updated" else canonical)(F.col(c)).alias(c) for c in CONTENT],
    )
    return snapshots.changes(rows, "snapshot_id", "npi", F.col("registry_last_updated"), CONTENT)


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    return registry_changes(spark, root).select("snapshot_id", "npi", "change_kind")


def p2_changed_columns(spark: SparkSession, root: str) -> DataFrame:
    """How often each column changed, by delivery."""
    return registry_changes(spark, root).where("change_kind = 'changed'").select("snapshot_id", F.explode("changed_columns").alias("column_name")).groupBy("snapshot_id", "column_name").agg(F.count("*").alias("n_changed"))


def reference_orphans(spark: SparkSession, root: str) -> DataFrame:
    refs = []
    for name in REFERRING:
        df = table(spark, root, name)
        refs.append(orphans.references(df.withColumn("id", canonical_id(F.col("id"))), name, {f: p for f, p in REFERS.items() if f in df.columns}))
    held = [orphans.parents(table(spark, root, p), p) for p in REFERS.values()]
    return orphans.orphans(orphans.union_all(refs), orphans.union_all(held))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return reference_orphans(spark, root)


def p3_orphans_by_period(spark: SparkSession, root: str) -> DataFrame:
    return orphans.orphan_report(reference_orphans(spark, root))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found,
    "p2_changed_columns": p2_changed_columns,
    "p3_found": p3_found,
    "p3_orphans_by_period": p3_orphans_by_period,
}

_TEXT = "nullif(lower(trim(regexp_replace({0}, '[\\s ]+', ' ', 'g'))), '')"
_DATE = (
    "case when trim({0}) = '' then null"
    " when regexp_matches(trim({0}), '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') then split_part(trim({0}), '/', 3)[1:4] || '-' || lpad(split_part(trim({0}), '/', 1), 2, '0') || '-' || lpad(split_part(trim({0}), '/', 2), 2, '0')"
    " when regexp_matches(trim({0}), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') then trim({0})[1:10] else lower(trim({0})) end"
)
_COLUMNS = ", ".join(f"{(_DATE if c == 'registry_last_updated' else _TEXT).format(c)} as {c}" for c in CONTENT)
_CHANGES = f"""
with r as (
  select trim(snapshot_id) as snapshot_id, nullif(trim(npi), '') as npi, {_COLUMNS}
  from registry_snapshot where lower(trim(location_kind)) = 'primary'),
s as (select snapshot_id, row_number() over (order by snapshot_id) as ord from (select distinct snapshot_id from r where snapshot_id is not null)),
k as (
  select * from r join s using (snapshot_id) where npi is not null
  qualify row_number() over (partition by npi, ord order by registry_last_updated desc nulls last, {", ".join(f"{c} desc nulls last" for c in CONTENT)}) = 1),
c as (
  select coalesce(n.ord, o.ord + 1) as ord, coalesce(n.npi, o.npi) as npi, o.npi is null as is_new, n.npi is null as is_gone, n, o
  from k n full outer join k o on n.npi = o.npi and n.ord = o.ord + 1)
"""
_DIFFERS = " or ".join(f"n.{c} is distinct from o.{c}" for c in CONTENT)
_CANON = "nullif(lower(trim({0})), '')"


def _references(name: str) -> str:
    parts = ["select id, extracted_at, 'source_record_ids' as ref_field, unnest(source_record_ids) as k, 'source_record' as parent from " + name]
    if name in ("clinic", "resolution_claim"):
        parts.append(f"select id, extracted_at, 'owner_entity_id', owner_entity_id, 'owner_entity' from {name}")
    if name in ("resolution_claim", "owner_entity"):
        parts.append(f"select id, extracted_at, 'parent_pe_firm_id', parent_pe_firm_id, 'parent_pe_firm' from {name}")
    return " union all ".join(f"select '{name}' as table_name, * from ({p})" for p in parts)


_ORPHANS = f"""
select distinct r.table_name, strftime(r.extracted_at, '%Y-%m') as period, {_CANON.format('r.id')} as record_id, r.ref_field, {_CANON.format('r.k')} as ref_key
from ({' union all '.join(_references(n) for n in REFERRING)}) r
left join (select parent, {_CANON.format('id')} as id, min(coalesce(created_at, timestamp '0001-01-01')) as created from (
  {' union all '.join(f"select '{p}' as parent, id, created_at from {p}" for p in REFERS.values())}) group by all) h
on h.parent = r.parent and h.id = {_CANON.format('r.k')}
where {_CANON.format('r.k')} is not null and (h.id is null or h.created > r.extracted_at)
"""

ORACLE: dict[str, str] = {
    "p2_found": _CHANGES + f"""
select s.snapshot_id, c.npi, case when is_new then 'added' when is_gone then 'removed' else 'changed' end as change_kind
from c join s using (ord) where s.ord > 1 and (is_new or is_gone or {_DIFFERS})""",
    "p2_changed_columns": _CHANGES + " union all ".join(
        f"select s.snapshot_id, '{c}' as column_name, count(*) as n_changed from c join s using (ord) where s.ord > 1 and not is_new and not is_gone and n.{c} is distinct from o.{c} group by 1" for c in CONTENT
    ),
    "p3_found": _ORPHANS,
    "p3_orphans_by_period": f"select table_name, period, ref_field, count(*) as n_references, count(distinct ref_key) as n_keys from ({_ORPHANS}) group by all",
}
