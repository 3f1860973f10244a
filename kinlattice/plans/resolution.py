"""Queries of the canonicalisers, joins, matching, deduplication and claims, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlattice.functions import address, arrays, dates, text
from kinlattice.operators import claims, dedup, guards, joins
from kinlattice.runtime import table

FLOORS = {"clinic_to_owner": 0.80, "owner_to_pe_firm": 0.85}


def keyed_clinics(spark: SparkSession, root: str) -> DataFrame:
    c = table(spark, root, "clinic")
    street = address.street_key(F.col("address_line1"))
    return c.select(
        text.canonical_id(F.col("id")).alias("id"), text.canonical_id(F.col("owner_entity_id")).alias("owner"), "name", "npi", "state", "registry_last_updated", "extracted_at",
        street.alias("street"), address.building_key(street).alias("building"), address.zip5(F.col("zip")).alias("zip5"), "city", "superseded_by", "source_record_ids", "address_line1", "zip",
    )


def keyed_roster(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "roster_center")
    street = address.street_key(F.col("address_line1"))
    return r.select("center_id", "owner_name", "roster_kind", "fetched_at", street.alias("street"), address.building_key(street).alias("building"), address.zip5(F.col("zip")).alias("zip5"), "detail_url")


def norm_names(spark, root):
    """STR-01/02/03: canonical name, ZIP and chain stem of staged rows."""
    s = table(spark, root, "staging_bacb_provider")
    return s.select("id", text.blankless(F.col("raw_name")).alias("norm"), address.zip5(F.col("zip")).alias("zip5"), text.chain_stem(F.col("raw_name")).alias("stem"))


def norm_streets(spark, root):
    """ADR-01, STR-04/05: street key, building key and whether there is a unit."""
    return keyed_clinics(spark, root).select("id", "street", "building", address.has_unit(F.col("street")).alias("has_unit"))


def site_keys(spark, root):
    """ADR-02/03: site key of clinics with its fallbacks."""
    c = keyed_clinics(spark, root)
    k = address.site_key(F.col("owner"), F.col("address_line1"), F.col("zip"), F.col("city"), F.col("state"), F.col("npi"))
    return c.select("id", k.alias("k")).where("k is not null").select("id", "k.owner", "k.place", "k.area")


def _brands(spark, root) -> DataFrame:
    o = table(spark, root, "owner_entity")
    both = F.explode(F.array("name", "trade_name"))
    return o.select(text.canonical_id(F.col("id")).alias("owner_id"), both.alias("n")).select("owner_id", text.blankless(text.without_suffix(F.col("n"), r"[,\s]+(?:llc|inc|corp|pllc|pc|lp)\.?")).alias("brand"))


def brand_prefix_match(spark, root):
    """ER-01/02, J-08, FLT-09: staged rows with the longest owner brand that their name begins with."""
    s = table(spark, root, "staging_bacb_provider").select("id", text.blankless(F.col("raw_name")).alias("norm"))
    return joins.longest_prefix(s, "norm", _brands(spark, root), "brand", "owner_id")


def link_first_wins(spark, root):
    """ER-03, J-15, WIN-01: staged rows that would become new sites."""
    s = table(spark, root, "staging_bacb_provider")
    met = brand_prefix_match(spark, root).select("id", F.col("owner_id").alias("owner"))
    rows = s.select("id", "raw_name", "address_line1", "zip", "city", "state", "npi").join(met, "id")
    k = address.site_key(F.col("owner"), F.col("address_line1"), F.col("zip"), F.col("city"), F.col("state"), F.col("npi"))
    staged = rows.select("id", "raw_name", k.alias("k")).select("id", "raw_name", "k.owner", "k.place", "k.area")
    return claims.link_sites(staged, site_keys(spark, root), None, ["raw_name", "id"]).select("id", "owner", "place", "area")


def duplicate_sites(spark, root):
    """COR-01, WIN-02: live clinics of one owner at one address; the one with a registry number, the least, stays."""
    c = keyed_clinics(spark, root).where("superseded_by is null and street != '' and owner is not null")
    npi = F.nullif(F.trim("npi"), F.lit(""))
    return dedup.superseded(c, ["owner", "street", "zip5"], [npi.isNull().cast("int"), npi, F.col("id")])


def _parented(spark, root) -> DataFrame:
    o = table(spark, root, "owner_entity").select(text.canonical_id(F.col("id")).alias("owner"), text.canonical_id(F.col("parent_pe_firm_id")).alias("parent"))
    p = table(spark, root, "parent_pe_firm").select(text.canonical_id(F.col("id")).alias("parent"))
    return keyed_clinics(spark, root).where("street != ''").join(o, "owner").join(p, "parent")


def cross_brand_sites(spark, root):
    """COR-02, WIN-03: clinics of different brands of one parent at one address; the freshest stays."""
    keys = ["parent", "street", "zip5"]
    rows = dedup.spread_over(_parented(spark, root), keys, "owner")
    return dedup.superseded(rows, keys, [F.col("registry_last_updated").desc_nulls_last(), F.col("id")])


def ghost_sites(spark, root):
    """COR-03: addresses that passed from one parent to another two years apart or more."""
    return dedup.ghosts(_parented(spark, root), ["street", "zip5"], "parent", "registry_last_updated")


def building_collapse(spark, root):
    """COR-04: clinics collapsed at building grain with the centers' own lists as authority."""
    rows = keyed_clinics(spark, root).where("superseded_by is null and street != '' and owner is not null")
    order = [(F.col("street") == F.col("building")).cast("int"), F.col("registry_last_updated").desc_nulls_last(), F.col("id")]
    return dedup.building_collapse(rows, keyed_roster(spark, root).where("street != ''"), order)


def directory_contradicted(spark, root):
    """COR-06, J-16, FLT-12: clinics with a registry number at places that no center lists."""
    c = keyed_clinics(spark, root).where("street != '' and trim(npi) != ''")
    return dedup.contradicted(c, keyed_roster(spark, root), ["street", "zip5"]).select("id", "street", "zip5")


def corroborated(spark, root):
    """COR-11, WIN-09, ARR-01: clinics with the first center's page at their address added to their sources."""
    c = keyed_clinics(spark, root).where("street != ''").select("id", "street", "zip5", "source_record_ids")
    out = dedup.corroborated(c, keyed_roster(spark, root), ["street", "zip5"], "source_record_ids", "detail_url", ["center_id"])
    return out.select("id", F.size("source_record_ids").alias("n_sources"), F.get(F.filter("source_record_ids", lambda x: x.startswith("http")), F.lit(0)).alias("page")).where("page is not null")


def two_tier_visibility(spark, root):
    """J-18: clinics seen in the registry by exact place, else by the only unit of the building."""
    lines = table(spark, root, "registry_snapshot").where(F.col("address_line1").rlike("[A-Za-z0-9]")).select("address_line1", "zip").distinct()
    reg = lines.select(address.street_key(F.col("address_line1")).alias("street"), address.zip5(F.col("zip")).alias("zip5"))
    universe = reg.withColumn("building", address.building_key(F.col("street")))
    rows = keyed_clinics(spark, root).where("street != ''").select("id", "street", "zip5", "building")
    return joins.two_tier(rows, universe, ["street", "zip5"], ["building", "zip5"]).select("id", "tier", "matched_street")


def unique_twin(spark, root):
    """COR-05, J-20: clinics without a city and the one clinic with a city at the same place."""
    c = keyed_clinics(spark, root).where("street != '' and owner is not null")
    lost, sound = c.where("coalesce(trim(city), '') = ''").select(F.col("id").alias("broken_id"), "owner", "street", "zip5"), c.where("trim(city) != ''")
    return joins.only_twin(lost, sound, ["owner", "street", "zip5"], "broken_id", "id")


def _claims(spark, root) -> DataFrame:
    """Each claim once: of rows with one id the earliest, ties by what they say."""
    c = table(spark, root, "resolution_claim").withColumn("id", text.canonical_id(F.col("id")))
    return joins.best(c, ["id"], [F.col("created_at"), F.to_json(F.struct(*c.columns))])


def claim_decisions(spark, root):
    """VAL-01..03, ARR-08: each claim's decision, rule and trust."""
    flagged = arrays.filled(F.col("llm_flags"))
    return claims.decisions(_claims(spark, root), FLOORS, [("llm_flag", flagged)]).select("id", "claim_type", "decision", "deciding_rule", "trust")


def run_summary(spark, root):
    """VAL-04, AGG-26."""
    return claims.run_summary(claim_decisions(spark, root))


def published_claims(spark, root):
    """MET-01, J-01/11, FLT-01/02."""
    return claims.published(_claims(spark, root), claim_decisions(spark, root)).select("id", "claim_type", text.canonical_id(F.col("clinic_id")).alias("clinic_id"), text.canonical_id(F.col("owner_entity_id")).alias("owner_id"), text.canonical_id(F.col("parent_pe_firm_id")).alias("parent_id"))


def published_sites(spark, root):
    """MET-02, J-12, AGG-29: live clinics with a published claim."""
    c = table(spark, root, "clinic").where("superseded_by is null").select(text.canonical_id(F.col("id")).alias("clinic_id"), "name", "state")
    return c.join(published_claims(spark, root).where("claim_type = 'clinic_to_owner'").select("clinic_id"), "clinic_id", "left_semi").distinct()


def parent_links(spark, root):
    """MET-03, J-03, PRJ-02: published links of operators to parents, by display name."""
    o = table(spark, root, "owner_entity").select(text.canonical_id(F.col("id")).alias("owner_id"), text.display_name(F.col("name"), F.col("trade_name")).alias("operator"))
    p = table(spark, root, "parent_pe_firm").select(text.canonical_id(F.col("id")).alias("parent_id"), F.col("name").alias("parent"))
    links = published_claims(spark, root).where("claim_type = 'owner_to_pe_firm'").select("owner_id", "parent_id").distinct()
    return links.join(o, "owner_id").join(p, "parent_id").select("owner_id", "parent_id", "operator", "parent")


def _edges(spark, root) -> DataFrame:
    """``kind, far, owner, c``: live and trusted claims with the end that is not the owner. Both kinds have one plan, so the exchange of the claims is reused."""
    live = _claims(spark, root).where(F.col("superseded_by").isNull() & F.col("confidence_method").isin(*claims.TRUSTED))
    far = F.when(F.col("claim_type") == "clinic_to_owner", F.col("clinic_id")).when(F.col("claim_type") == "owner_to_pe_firm", F.col("parent_pe_firm_id"))
    return live.select(F.col("claim_type").alias("kind"), text.canonical_id(far).alias("far"), text.canonical_id(F.col("owner_entity_id")).alias("owner"), F.coalesce("confidence_score", F.lit(0.0)).alias("c")).dropna(subset=["far", "owner"])


def best_chains(spark, root):
    """ER-12, AGG-27, WIN-05, Q-13: the best chain of each clinic."""
    edges = _edges(spark, root)
    first = edges.where("kind = 'clinic_to_owner'").select(F.col("far").alias("site"), "owner", F.col("c").alias("c1"))
    second = edges.where("kind = 'owner_to_pe_firm'").select("owner", F.col("far").alias("parent"), F.col("c").alias("c2"))
    return claims.chains(first, second)


def source_bridge(spark, root):
    """J-06/07, AGG-07, ARR-02/03: claims with the sorted types of their sources."""
    s = table(spark, root, "source_record").select(text.canonical_id(F.col("id")).alias("key"), F.lower(F.trim("source_type")).alias("kind"))
    return joins.collected(_claims(spark, root).select("id", "source_record_ids"), "id", "source_record_ids", s, "key", "kind", "kinds").select("id", F.array_join("kinds", ",").alias("kinds"))


def sites_with_directory(spark, root):
    """J-13: clinics with a directory-typed source."""
    s = table(spark, root, "source_record").where("lower(trim(source_type)) like '%director%'").select(text.canonical_id(F.col("id")).alias("key"))
    return joins.with_any(keyed_clinics(spark, root), "id", "source_record_ids", s).select("id")


def sites_without_directory(spark, root):
    """J-14."""
    s = table(spark, root, "source_record").where("lower(trim(source_type)) like '%director%'").select(text.canonical_id(F.col("id")).alias("key"))
    return joins.with_any(keyed_clinics(spark, root), "id", "source_record_ids", s, how="left_anti").select("id")


def content_dedup(spark, root):
    """IDM-01, HSH-01, WIN-01: documents whose content is seen for the first time."""
    d = table(spark, root, "documents").where("text is not null").select("doc_id", F.sha2("text", 256).alias("content_hash"))
    return joins.best(d, ["content_hash"], [F.col("doc_id")])


def source_guard(spark, root):
    """IDM-01: source records other than directories that a unique (url, hash) would let in beside the directories held."""
    s = table(spark, root, "source_record").select(text.canonical_id(F.col("id")).alias("id"), "source_url", "content_hash", "created_at", F.lower(F.trim("source_type")).like("%director%").alias("listed"))
    listed = F.lower(F.trim("source_type")).like("%director%")
    held = table(spark, root, "source_record").where(listed)
    return guards.fresh(s.where(~F.coalesce("listed", F.lit(False))), held, ["source_url", "content_hash"], ["created_at", "id"]).select("id")


def upsert_names(spark, root):
    """ER-06, FLT-03: operator names of the rosters that no owner has, whatever the case."""
    o = table(spark, root, "owner_entity")
    return guards.upsert_missing(table(spark, root, "roster_center").select(F.col("owner_name").alias("name")), o.select("name").unionByName(o.select(F.col("trade_name").alias("name"))), "name")


def missing_sources(spark, root):
    """SET-03: sources cited by clinics that are not there."""
    cited = joins.bridge(keyed_clinics(spark, root), "id", "source_record_ids").select("key")
    return guards.missing_keys(cited, table(spark, root, "source_record").select(text.canonical_id(F.col("id")).alias("key")), ["key"])


def latest_by_source(spark, root):
    """WIN-07: the latest fetch of each page."""
    s = table(spark, root, "source_record").select(text.canonical_id(F.col("id")).alias("id"), "source_url", "fetched_at")
    return s.groupBy("source_url").agg(F.max(F.struct("fetched_at", "id")).alias("m")).select("source_url", F.col("m.id").alias("id"))


def freshest_by_npi(spark, root):
    """AGG-18, COR-13, DAT-01..03: clinics' freshness date brought up to the registry's newest."""
    r = table(spark, root, "registry_snapshot").select(F.trim("npi").alias("npi"), dates.iso_date(F.col("registry_last_updated")).alias("registry_last_updated"))
    c = keyed_clinics(spark, root).select("id", F.nullif(F.trim("npi"), F.lit("")).alias("npi"), "registry_last_updated")
    return dedup.freshened(c, r, "npi", "registry_last_updated")


_STREET_MAP = "MAP {" + ", ".join(f"'{w}': '{k}'" for k, ws in address.STREET_WORDS.items() for w in ws.split()) + "}"


def street_sql(source: str, columns: str, line: str = "address_line1") -> str:
    """SQL of ``columns`` with ``street`` and ``building`` of the given line."""
    words = f"list_filter(string_split(regexp_replace(regexp_replace(lower(coalesce({line}, '')), '#\\s*([a-z0-9])', 'ste \\1', 'g'), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"
    return (
        f"select *, regexp_replace(street, '(ste|bldg|flr).*$', '') as building from (select * exclude (_k), array_to_string(list_filter(_k, lambda w, i: i = 1 or w <> _k[i - 1]), '') as street"
        f" from (select {columns}, list_transform({words}, lambda w: coalesce(map_extract({_STREET_MAP}, w)[1], w)) as _k from {source}))"
    )


_ZIP5 = "case when length(regexp_replace(coalesce(zip, ''), '[^0-9]', '', 'g')) >= 5 then regexp_replace(coalesce(zip, ''), '[^0-9]', '', 'g')[1:5] else '' end"
_ID = "nullif(lower(trim({0})), '')"
_CLINICS = street_sql("clinic", f"{_ID.format('id')} as id, {_ID.format('owner_entity_id')} as owner, name, npi, state, registry_last_updated, {_ZIP5} as zip5, city, superseded_by, source_record_ids")
_ROSTER = street_sql("roster_center", f"center_id, owner_name, {_ZIP5} as zip5, detail_url")
_NORM = "regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', '', 'g')"
_PLACED = (
    f"select *, case when street <> '' then street when {_NORM.format('city')} <> '' then 'city:' || {_NORM.format('city')} when coalesce(trim(npi), '') <> '' then 'npi:' || trim(npi) end as place,"
    f" case when street <> '' then zip5 when {_NORM.format('city')} <> '' then upper(trim(coalesce(state, ''))) when coalesce(trim(npi), '') <> '' then '' end as area from "
)
_STRIPPED = "trim(regexp_replace(n, '(?i)(?:[,\\s]+(?:llc|inc|corp|pllc|pc|lp)\\.?)$', ''))"
_BRANDS = (
    f"select min(owner_id) as owner_id, brand from (select {_ID.format('id')} as owner_id, {_NORM.format(_STRIPPED)} as brand"
    " from (select id, unnest([name, trade_name]) as n from owner_entity)) where length(brand) >= 6 group by brand"
)
_MATCHED = (
    f"select s.id, s.norm, b.brand, b.owner_id from (select id, {_NORM.format('raw_name')} as norm from staging_bacb_provider) s"
    f" join ({_BRANDS}) b on starts_with(s.norm, b.brand) qualify row_number() over (partition by s.id order by length(b.brand) desc) = 1"
)
_STEM = "trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(raw_name, '')), '[^a-z0-9 ]', ' ', 'g'), '\\b(?:" + text.STEM_WORDS + ")\\b', ' ', 'g'), '\\s+', ' ', 'g'))[1:40]"
_PARENTED = f"select c.*, o.parent from ({_CLINICS}) c join (select {_ID.format('id')} as owner, {_ID.format('parent_pe_firm_id')} as parent from owner_entity) o using (owner) join (select {_ID.format('id')} as parent from parent_pe_firm) p using (parent) where street <> ''"
_CLAIMS = f"select * replace ({_ID.format('id')} as id) from resolution_claim qualify row_number() over (partition by {_ID.format('id')} order by created_at) = 1"
_DECIDED = (
    "select id, claim_type, case when flagged then 'quarantined' when floor is not null and coalesce(confidence_score, 0) >= floor then 'passed' else 'failed' end as decision,"
    " case when flagged then 'llm_flag' when floor is null then 'unknown_type' else claim_type || ':floor=' || printf('%.2f', floor) end as deciding_rule from ("
    " select *, coalesce(len(llm_flags), 0) > 0 as flagged, case claim_type when 'clinic_to_owner' then 0.80 when 'owner_to_pe_firm' then 0.85 end as floor from (" + _CLAIMS + "))"
)
_PUBLISHED = f"select c.id, c.claim_type, {_ID.format('clinic_id')} as clinic_id, {_ID.format('owner_entity_id')} as owner_id, {_ID.format('parent_pe_firm_id')} as parent_id from ({_CLAIMS}) c where superseded_by is null and len(source_record_ids) > 0 and exists (select 1 from ({_DECIDED}) d where d.id = c.id and decision = 'passed') and not exists (select 1 from ({_DECIDED}) d where d.id = c.id and decision = 'quarantined')"
_TRUSTED = ", ".join(f"'{m}'" for m in claims.TRUSTED)
_LIVE = f"from ({_CLAIMS}) where superseded_by is null and confidence_method in ({_TRUSTED})"
_BRIDGE = f"select distinct id, {_ID.format('k')} as key from (select {{0}} as id, unnest(source_record_ids) as k from {{1}}) where {_ID.format('k')} is not null"
_DIRECTORY = f"select {_ID.format('id')} as key from source_record where lower(trim(source_type)) like '%director%'"
_REG_DATE = (
    "try_cast(case when regexp_matches(trim(registry_last_updated), '^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}') then split_part(trim(registry_last_updated), '/', 3)[1:4] || '-' || lpad(split_part(trim(registry_last_updated), '/', 1), 2, '0') || '-' || lpad(split_part(trim(registry_last_updated), '/', 2), 2, '0')"
    " else trim(registry_last_updated)[1:10] end as date)"
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        norm_names, norm_streets, site_keys, brand_prefix_match, link_first_wins, duplicate_sites, cross_brand_sites, ghost_sites, building_collapse, directory_contradicted, corroborated,
        two_tier_visibility, unique_twin, claim_decisions, run_summary, published_claims, published_sites, parent_links, best_chains, source_bridge, sites_with_directory,
        sites_without_directory, content_dedup, source_guard, upsert_names, missing_sources, latest_by_source, freshest_by_npi,
    )
}

ORACLE: dict[str, str] = {
    "norm_names": f"select id, {_NORM.format('raw_name')} as norm, {_ZIP5} as zip5, {_STEM} as stem from staging_bacb_provider",
    "norm_streets": f"select id, street, building, street <> building as has_unit from ({_CLINICS})",
    "site_keys": f"select id, owner, place, area from ({_PLACED} ({_CLINICS})) where place is not null",
    "brand_prefix_match": _MATCHED,
    "link_first_wins": f"""
with held as (select distinct owner, place, area from ({_PLACED} ({_CLINICS})) where place is not null and owner is not null),
s as (select s.id, raw_name, owner_id as owner, place, area from ({_PLACED} ({street_sql("staging_bacb_provider", f"id, raw_name, npi, state, city, {_ZIP5} as zip5")})) s join ({_MATCHED}) m on m.id = s.id where place is not null)
select id, owner, place, area from s where not exists (select 1 from held h where h.owner = s.owner and h.place = s.place and h.area = s.area)
qualify row_number() over (partition by owner, place, area order by raw_name, id) = 1""",
    "duplicate_sites": f"""
with c as (select *, first_value(id) over (partition by owner, street, zip5 order by (nullif(trim(npi), '') is null)::int, nullif(trim(npi), ''), id) as survivor_id
  from ({_CLINICS}) where superseded_by is null and street <> '' and owner is not null)
select id, survivor_id from c where id <> survivor_id""",
    "cross_brand_sites": f"""
with c as (select * from ({_PARENTED})), k as (select parent, street, zip5 from c group by all having count(distinct owner) > 1),
w as (select c.*, first_value(id) over (partition by parent, street, zip5 order by registry_last_updated desc nulls last, id) as survivor_id from c join k using (parent, street, zip5))
select id, survivor_id from w where id <> survivor_id""",
    "ghost_sites": f"""
with c as (select * from ({_PARENTED}) where registry_last_updated is not null),
w as (select street, zip5, count(*) as n, arg_min(struct_pack(p := parent, i := id, d := registry_last_updated), (registry_last_updated, parent, id)) as o,
  arg_max(struct_pack(p := parent, i := id, d := registry_last_updated), (registry_last_updated, parent, id)) as x from c group by all)
select street, zip5, o.i as stale_id, x.i as live_id, round((x.d - o.d) / 365.25, 4) as gap_years from w where n > 1 and o.p <> x.p and (x.d - o.d) / 365.25 >= 2.0""",
    "building_collapse": f"""
with l as (select building, zip5, count(distinct street) as n_listed from ({_ROSTER}) where street <> '' group by all),
c as (select c.*, n_listed from ({_CLINICS}) c join l using (building, zip5) where superseded_by is null and street <> '' and owner is not null),
a as (select id, first_value(id) over (partition by building, zip5 order by (street = building)::int, registry_last_updated desc nulls last, id) as survivor_id from c where n_listed = 1),
b as (select id, first_value(id) over (partition by street, zip5 order by (street = building)::int, registry_last_updated desc nulls last, id) as survivor_id from c where n_listed > 1),
r as (select * from c where n_listed > 1 and id not in (select id from b where id <> survivor_id)),
s as (select owner, building, zip5, min(id) as survivor_id from r where street <> building group by all having count(*) = 1)
select id, survivor_id from a where id <> survivor_id union all select id, survivor_id from b where id <> survivor_id
union all select r.id, s.survivor_id from r join s using (owner, building, zip5) where r.street = r.building""",
    "directory_contradicted": f"select id, street, zip5 from ({_CLINICS}) c where street <> '' and trim(npi) <> '' and not exists (select 1 from ({_ROSTER}) r where r.street = c.street and r.zip5 = c.zip5)",
    "corroborated": f"""
with f as (select street, zip5, arg_min(detail_url, center_id) as page from ({_ROSTER}) where detail_url is not null group by all)
select c.id, (len(coalesce(source_record_ids, [])) + (not list_contains(coalesce(source_record_ids, []), page))::int)::int as n_sources, page from ({_CLINICS}) c join f using (street, zip5) where street <> ''""",
    "two_tier_visibility": f"""
with u as (select distinct street, zip5, building from ({street_sql("registry_snapshot", f"{_ZIP5} as zip5")}) where street <> ''),
b as (select building, zip5, min(street) as only from u group by all having count(*) = 1)
select c.id, case when u.street is not null then 'exact' when b.only is not null then 'building' else 'none' end as tier, coalesce(u.street, b.only) as matched_street
from ({_CLINICS}) c left join u on u.street = c.street and u.zip5 = c.zip5 left join b on b.building = c.building and b.zip5 = c.zip5 where c.street <> ''""",
    "unique_twin": f"""
with c as (select * from ({_CLINICS}) where street <> '' and owner is not null)
select b.id as broken_id, case when count(s.id) = 1 then min(s.id) end as twin_id, count(s.id) as n_twins from c b left join c s on s.owner = b.owner and s.street = b.street and s.zip5 = b.zip5 and trim(s.city) <> ''
where coalesce(trim(b.city), '') = '' group by b.id""",
    "claim_decisions": f"select *, case decision when 'passed' then 'verified' else 'unverified' end as trust from ({_DECIDED})",
    "run_summary": f"select count(*) as evaluated, count(*) filter (decision = 'passed') as passed, count(*) filter (decision = 'failed') as failed, count(*) filter (decision = 'quarantined') as quarantined, count(*) filter (decision = 'failed') = 0 and count(*) > 0 as gate_passed from ({_DECIDED})",
    "published_claims": _PUBLISHED,
    "published_sites": f"select distinct {_ID.format('id')} as clinic_id, name, state from clinic c where superseded_by is null and exists (select 1 from ({_PUBLISHED}) p where p.claim_type = 'clinic_to_owner' and p.clinic_id = {_ID.format('c.id')})",
    "parent_links": f"select distinct owner_id, parent_id, coalesce(o.trade_name, o.name) as operator, p.name as parent from ({_PUBLISHED}) l join owner_entity o on {_ID.format('o.id')} = l.owner_id join parent_pe_firm p on {_ID.format('p.id')} = l.parent_id where l.claim_type = 'owner_to_pe_firm'",
    "best_chains": f"""
with a as (select id as claim1, {_ID.format('clinic_id')} as site, {_ID.format('owner_entity_id')} as owner, coalesce(confidence_score, 0) as c1 {_LIVE} and claim_type = 'clinic_to_owner'),
b as (select id as claim2, {_ID.format('owner_entity_id')} as owner, {_ID.format('parent_pe_firm_id')} as parent, coalesce(confidence_score, 0) as c2 {_LIVE} and claim_type = 'owner_to_pe_firm')
select site, a.owner, parent, round(least(c1, coalesce(c2, c1)), 6) as confidence, parent is not null as complete from (select * from a where site is not null and owner is not null) a left join (select * from b where owner is not null and parent is not null) b on b.owner = a.owner
qualify row_number() over (partition by site order by least(c1, coalesce(c2, c1)) desc, c1 desc, c2 desc nulls last, a.owner, parent asc nulls last, claim1, claim2 asc nulls last) = 1""",
    "source_bridge": f"""
select c.id, coalesce(string_agg(distinct s.kind, ',' order by s.kind), '') as kinds from ({_CLAIMS}) c left join ({_BRIDGE.format('id', f'({_CLAIMS})')}) b on b.id = c.id
left join (select {_ID.format('id')} as key, lower(trim(source_type)) as kind from source_record) s on s.key = b.key group by c.id""",
    "sites_with_directory": f"select {_ID.format('id')} as id from clinic where {_ID.format('id')} in (select b.id from ({_BRIDGE.format(_ID.format('id'), 'clinic')}) b join ({_DIRECTORY}) d using (key))",
    "sites_without_directory": f"select {_ID.format('id')} as id from clinic where {_ID.format('id')} not in (select b.id from ({_BRIDGE.format(_ID.format('id'), 'clinic')}) b join ({_DIRECTORY}) d using (key))",
    "content_dedup": "select min(doc_id) as doc_id, sha256(text) as content_hash from documents where text is not null group by 2",
    "source_guard": f"""
with s as (select {_ID.format('id')} as id, source_url, content_hash, created_at, coalesce(lower(trim(source_type)) like '%director%', false) as listed from source_record)
select id from s where not listed and (source_url is null or content_hash is null or not exists (select 1 from s h where h.listed and h.source_url = s.source_url and h.content_hash = s.content_hash))
qualify source_url is null or content_hash is null or row_number() over (partition by source_url, content_hash order by created_at, id) = 1""",
    "upsert_names": "select min(trim(owner_name)) as name from roster_center where trim(owner_name) <> '' and lower(trim(owner_name)) not in (select lower(trim(n)) from (select unnest([name, trade_name]) as n from owner_entity) where n is not null) group by lower(trim(owner_name))",
    "missing_sources": f"select distinct key from ({_BRIDGE.format(_ID.format('id'), 'clinic')}) where key not in (select {_ID.format('id')} from source_record)",
    "latest_by_source": f"select source_url, arg_max({_ID.format('id')}, (fetched_at, {_ID.format('id')})) as id from source_record group by 1",
    "freshest_by_npi": f"""
with r as (select trim(npi) as npi, max({_REG_DATE}) as d from registry_snapshot where npi is not null group by 1)
select c.id, c.npi, case when r.d is not null and (c.registry_last_updated is null or r.d >= c.registry_last_updated) then r.d else c.registry_last_updated end as registry_last_updated
from (select {_ID.format('id')} as id, nullif(trim(npi), '') as npi, registry_last_updated from clinic) c left join r on r.npi = c.npi""",
}
