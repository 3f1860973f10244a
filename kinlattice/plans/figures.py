"""Queries of the published figures, sampling, vectors and text projections, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlattice.functions import address, text
from kinlattice.operators import dedup, joins, metrics, sampling, vectors
from kinlattice.plans import resolution as r
from kinlattice.runtime import table

AS_OF, SEED, LEAST_SITES = "2025-10-01", 42, 3


def _universe(spark, root) -> DataFrame:
    """Registry sites: stem, street, ZIP and state.

    Deliveries repeat most rows; they are made distinct before any text is canonicalised.
    The stem depends on the count, which keeps the optimiser from moving its filter, and
    with it the work of canonicalising, to the rows before they are distinct.
    """
    keys = ["raw_name", "address_line1", "zip", "state"]
    reg = table(spark, root, "registry_snapshot").where(F.col("address_line1").rlike("[A-Za-z0-9]")).groupBy(*keys).agg(F.count("*").alias("n"))
    return reg.select(
        F.when(F.col("n") > 0, text.chain_stem(F.col("raw_name"))).alias("stem"), address.street_key(F.col("address_line1")).alias("street"), address.zip5(F.col("zip")).alias("zip5"),
        F.nullif(F.upper(F.substring(F.trim("state"), 1, 2)), F.lit("")).alias("state"),
    ).where("length(stem) >= 6")  # a line with a letter or digit has a street key, so no filter repeats that expression


def _tracked(spark, root) -> DataFrame:
    """Sites of clinics whose operator has a parent."""
    o = table(spark, root, "owner_entity").select(text.canonical_id(F.col("id")).alias("owner"), text.canonical_id(F.col("parent_pe_firm_id")).alias("parent"))
    p = table(spark, root, "parent_pe_firm").select(text.canonical_id(F.col("id")).alias("parent"), (F.lower("firm_type") == "private_equity").alias("is_private"))
    return r.keyed_clinics(spark, root).where("street != ''").join(o, "owner").join(p, "parent").select("owner", "parent", "street", "zip5", F.coalesce("is_private", F.lit(False)).alias("is_private"))


def market_share_by_state(spark, root):
    """AGG-14/16/17, FLT-16: registry sites by state, tracked and private ones at the very place; the figure over buildings too is ``market_share_visible``."""
    return metrics.market_share(_universe(spark, root), _tracked(spark, root), "state", ["street", "zip5"], LEAST_SITES)


def size_distribution(spark, root):
    """AGG-15: operators and sites by size."""
    return metrics.size_buckets(_universe(spark, root), "stem", ["street", "zip5"])


def owner_visibility(spark, root):
    """AGG-28: sites that the registry shows of each owner; owners without any stay with 0."""
    o = table(spark, root, "owner_entity").select(text.canonical_id(F.col("id")).alias("owner"))
    seen = r.keyed_clinics(spark, root).where("street != ''").select("owner", "street", "zip5").distinct().join(_universe(spark, root).select("street", "zip5").distinct(), ["street", "zip5"], "left_semi")
    return metrics.counts_or_zero(o, seen, ["owner"], "visible")


def owners_per_parent(spark, root):
    """AGG-02, J-02."""
    o = table(spark, root, "owner_entity").select(text.canonical_id(F.col("id")).alias("owner"), text.canonical_id(F.col("parent_pe_firm_id")).alias("parent_id"))
    p = table(spark, root, "parent_pe_firm").select(text.canonical_id(F.col("id")).alias("parent_id"), F.col("name").alias("parent"))
    return o.join(p, "parent_id").groupBy("parent").agg(F.count_distinct("owner").alias("n_owners"))


def sites_by_state(spark, root):
    """AGG-01: clinics by state, null as unknown, with their fraction."""
    return metrics.breakdown(table(spark, root, "clinic"), F.nullif(F.upper(F.trim("state")), F.lit("")), "state")


def method_breakdown(spark, root):
    """AGG-04."""
    return metrics.breakdown(table(spark, root, "clinic"), F.col("confidence_method"), "method")


def state_counts(spark, root):
    """J-24, AGG-28: parents' sites by state of the universe, states without any with 0."""
    states = _universe(spark, root).where("state is not null").select("state").distinct()
    tracked = table(spark, root, "clinic").select(F.upper(F.trim("state")).alias("state"), text.canonical_id(F.col("owner_entity_id")).alias("owner"))
    o = table(spark, root, "owner_entity").where("parent_pe_firm_id is not null").select(text.canonical_id(F.col("id")).alias("owner"))
    return metrics.counts_or_zero(states, tracked.join(o, "owner", "left_semi"), ["state"], "n_sites")


def _counts(spark, root) -> DataFrame:
    """Per trade name what we hold and what the rosters list."""
    o = table(spark, root, "owner_entity").select(text.canonical_id(F.col("id")).alias("owner"), text.blankless(text.display_name(F.col("name"), F.col("trade_name"))).alias("brand"))
    ours = r.keyed_clinics(spark, root).join(o, "owner").groupBy("brand").agg(F.count("*").alias("ours"))
    theirs = table(spark, root, "roster_center").groupBy(text.blankless(F.col("owner_name")).alias("brand")).agg(F.count("*").alias("theirs"))
    return o.select("brand").distinct().join(ours, "brand", "left").join(theirs, "brand", "left").select("brand", F.coalesce("ours", F.lit(0)).alias("ours"), "theirs")


def roster_compared(spark, root):
    """AGG-24, MTH-04."""
    return metrics.compared(_counts(spark, root), "ours", "theirs")


def roster_spread(spark, root):
    """AGG-25."""
    return metrics.spread(_counts(spark, root), "ours", "theirs", 3)


def confidence_grades(spark, root):
    """MET-08, DAT-05, AGG-20: clinics by grade as of a fixed day."""
    o = table(spark, root, "owner_entity").select(text.canonical_id(F.col("id")).alias("owner"), (F.col("service_model") == "in_home").alias("in_home"))
    listed = r.keyed_roster(spark, root).select("street", "zip5").distinct().withColumn("listed", F.lit(True))
    c = r.keyed_clinics(spark, root).join(o, "owner", "left").join(listed, ["street", "zip5"], "left")
    g = metrics.grade(F.coalesce("listed", F.lit(False)), F.coalesce("in_home", F.lit(False)), F.col("registry_last_updated"), F.lit(AS_OF).cast("date"))
    return c.groupBy(g.alias("grade")).agg(F.count("*").alias("n"))


def acquirers(spark, root):
    """MET-09, AGG-02/09: parents with operators, sites and states; those without sites stay."""
    p = table(spark, root, "parent_pe_firm").select(text.canonical_id(F.col("id")).alias("parent"), F.col("name").alias("parent_name"))
    o = table(spark, root, "owner_entity").select(text.canonical_id(F.col("id")).alias("owner"), text.canonical_id(F.col("parent_pe_firm_id")).alias("parent"))
    c = r.keyed_clinics(spark, root).select("id", "owner", F.upper(F.trim("state")).alias("state"))
    met = p.join(o, "parent", "left").join(c, "owner", "left")
    return met.groupBy("parent", "parent_name").agg(F.count("id").alias("sites"), F.count_distinct(F.when(F.col("id").isNotNull(), F.col("owner"))).alias("brands"), F.count_distinct("state").alias("states"))


def release_diff(spark, root):
    """Q-11: clinics of resolver 0.5 against earlier ones, by registry number."""
    base = table(spark, root, "clinic").select(F.nullif(F.trim("npi"), F.lit("")).alias("npi"), "resolver_version", F.coalesce(text.canonical_id(F.col("owner_entity_id")), F.lit("")).alias("owner")).where("npi is not null")
    old, new = (base.where(w).groupBy("npi").agg(F.min("owner").alias("owner")) for w in ("resolver_version < '0.5'", "resolver_version >= '0.5'"))
    return metrics.release_diff(old, new, "npi", ["owner"])


def review_accuracy(spark, root):
    """AGG-06, VAL-05: verdicts of each matcher as agree, disagree, unclear."""
    v = F.lower(F.trim("verdict"))
    label = F.when(v == "match", "agree").when(v == "no_match", "disagree").otherwise("unclear")
    m = table(spark, root, "match_pair").select(F.coalesce("matcher", F.lit("unknown")).alias("matcher"), label.alias("label"))
    return metrics.tallies(m, ["matcher"], "label")


def match_rates(spark, root):
    """VAL-06, MTH-01: rate of matches with its Wilson interval."""
    m = table(spark, root, "match_pair").select(F.coalesce("matcher", F.lit("unknown")).alias("matcher"), "verdict")
    return metrics.rates(m, ["matcher"], F.lower(F.trim("verdict")) == "match")


def stratified_sample(spark, root):
    """SMP-01."""
    c = table(spark, root, "clinic").select("id", "confidence_method")
    return sampling.stratified(c, F.col("confidence_method"), 60, "id", SEED).select("id", "stratum")


def reservoir_sample(spark, root):
    """SMP-03, TOP-02."""
    return sampling.reservoir(table(spark, root, "staging_bacb_provider").where("npi is not null").select("id"), 40, "id", SEED)


def vector_topk(spark, root):
    """ER-08, MTH-02, TOP-01: the ten most similar vectors of every fiftieth vector."""
    e = table(spark, root, "embeddings")
    return vectors.top_k(e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), e.select(F.col("vec_id").alias("entity_id"), "embedding"), 10)


def vector_topk_tagged(spark, root):
    """ER-08 with a model tag: only vectors of the same label are compared."""
    e = table(spark, root, "embeddings")
    return vectors.top_k(e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "label", "embedding"), e.select(F.col("vec_id").alias("entity_id"), "label", "embedding"), 10, tag="label")


def page_texts(spark, root):
    """STR-07..10: texts without markup."""
    d = table(spark, root, "documents").where("text is not null")
    return d.select("doc_id", text.fragment_text(F.col("text")).alias("plain")).select("doc_id", F.length("plain").alias("n_chars"), F.md5("plain").alias("digest"))


def keyword_relevance(spark, root):
    """FLT-15."""
    d = table(spark, root, "documents")
    return d.select("doc_id", text.mentions(["covenant", "recoup", "statut"], F.col("source"), F.col("text")).alias("relevant"))


def event_props(spark, root):
    """JSN-01: events by type and by the number in their JSON properties."""
    e = table(spark, root, "events").select("event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count("k").alias("with_k"), F.sum("k").alias("sum_k"))


def roster_paths(spark, root):
    """FLT-06/18, STR-11/12: host, depth and place name of the centers' pages."""
    c = table(spark, root, "roster_center").where("detail_url is not null")
    path = F.parse_url("detail_url", F.lit("PATH"))
    last = F.element_at(F.split(path, "/"), -1)
    return c.select("center_id", F.parse_url("detail_url", F.lit("HOST")).alias("host"), (F.size(F.split(path, "/")) - 1).alias("depth"), text.slug_title(F.regexp_replace(last, r"-\d+$", "")).alias("place"))


def fetch_lag(spark, root):
    """Days from fetch to row, by source type."""
    s = table(spark, root, "source_record").select(F.lower(F.trim("source_type")).alias("kind"), F.datediff("created_at", "fetched_at").alias("lag"))
    return s.groupBy("kind").agg(F.count("*").alias("n"), F.min("lag").alias("least"), F.max("lag").alias("most"), F.sum("lag").alias("days"))


def order_priorities(spark, root):
    """J-02: orders and their lines by segment and priority, a scan, two joins and one aggregation."""
    o = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, root, "customer").select("c_custkey", "c_mktsegment")
    line = table(spark, root, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    met = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return met.groupBy("c_mktsegment", "o_orderpriority").agg(F.count("*").alias("n_orders"), F.sum(F.coalesce("n", F.lit(0))).alias("n_lines"))


def distinct_lines(spark, root):
    """AGG-14, WIN-01: lines of an order counted once, by return flag."""
    li = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return li.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_distinct("l_orderkey", "l_linenumber").alias("n_distinct"))


def listed_and_new(spark, root):
    """COR-12: centers' own lists by whether a clinic at the building is there already."""
    listed = r.keyed_roster(spark, root).where("street != ''")
    return dedup.known_and_new(listed, r.keyed_clinics(spark, root), ["building", "zip5"]).groupBy("known").agg(F.count("*").alias("n"))


def status_rollup(spark, root):
    """AGG-22: registry rows by status; platforms are rolled up in ``coverage_rollup``."""
    reg = table(spark, root, "registry_snapshot").select(F.lower(F.trim("registry_status")).alias("status"), F.length("raw_name").alias("size"))
    return metrics.status_rollup(reg, "status", ["a", "s"], "size")


def typed_prefixes(spark, root):
    """J-21: clinics whose street key begins with one that a center of the same ZIP lists."""
    rows = r.keyed_clinics(spark, root).select("id", "street", "zip5").where("zip5 != ''")
    held = r.keyed_roster(spark, root).select(F.col("street").alias("listed"), "zip5").distinct()
    return joins.prefix_within(rows, held, ["zip5"], "street", "listed").groupBy("id").agg(F.count("*").alias("n"))


def two_level_sample(spark, root):
    """SMP-02: claims by type and method."""
    c = r._claims(spark, root).select("id", "claim_type", "confidence_method")
    return sampling.two_level(c, F.col("claim_type"), F.col("confidence_method"), 80, "id", SEED).select("id", "stratum")


def ruled_sites(spark, root):
    """COR-08: clinics taken out by the first rule that holds."""
    o = table(spark, root, "owner_entity").select(text.canonical_id(F.col("id")).alias("owner"), (F.col("service_model") == "in_home").alias("in_home"), (~F.col("is_aba")).alias("other"))
    rows = r.keyed_clinics(spark, root).join(o, "owner")
    return dedup.ruled(rows, [("in_home", F.col("in_home")), ("other_service", F.col("other")), ("no_street", F.col("street") == "")]).select("id", "rule")


_ID = r._ID
_STEM = r._STEM
_UNIVERSE = f"select * from ({r.street_sql('registry_snapshot', f'{_STEM} as stem, {r._ZIP5} as zip5, nullif(upper(trim(state)[1:2]), {chr(39)}{chr(39)}) as state')}) where street <> '' and length(stem) >= 6"
_TRACKED = f"select c.owner, c.street, c.zip5, coalesce(p.t = 'private_equity', false) as is_private from ({r._CLINICS}) c join (select {_ID.format('id')} as owner, {_ID.format('parent_pe_firm_id')} as parent from owner_entity) o using (owner) join (select {_ID.format('id')} as parent, lower(firm_type) as t from parent_pe_firm) p using (parent) where street <> ''"
_COUNTS = f"""
with o as (select {_ID.format('id')} as owner, {r._NORM.format('coalesce(trade_name, name)')} as brand from owner_entity),
a as (select brand, count(*) as ours from ({r._CLINICS}) c join o using (owner) group by 1), b as (select {r._NORM.format('owner_name')} as brand, count(*) as theirs from roster_center group by 1),
n as (select distinct o.brand, coalesce(ours, 0) as ours, theirs from o left join a using (brand) left join b using (brand))
"""
_RATE = "count(*) filter (lower(trim(verdict)) = 'match')"
_Z = "1.96 * 1.96"
_P = f"({_RATE} * 1.0 / count(*))"
_TOPK = """
select q.vec_id as query_id, e.vec_id as entity_id, round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 6) as similarity,
cast(row_number() over (partition by q.vec_id order by round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 6) desc, e.vec_id) as int) as rank
from embeddings q join embeddings e on e.vec_id <> q.vec_id {0} where q.vec_id % 50 = 0 qualify rank <= 10"""

_PLAIN = "regexp_replace(regexp_replace(text, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g')"
for _k, _v in text.ENTITIES.items():
    _PLAIN = "replace({0}, '{1}', '{2}')".format(_PLAIN, _k, _v.replace("'", "''"))


def _sampled(source: str, stratum: str, n: int) -> str:
    """SQL of a stratified sample: quotas are made of units, and surplus units go from the highest down, by stratum."""
    return f"""
with q as (select {stratum} as stratum, greatest(1, cast(round_even({n}.0 * count(*) / sum(count(*)) over (), 0) as int)) as quota from {source} group by 1),
u as (select stratum, unnest(range(1, quota + 1)) as level, sum(quota) over () - {n} as surplus from q),
f as (select stratum, count(*) as quota from (select *, row_number() over (order by level desc, stratum) as gone from u) where gone > surplus group by 1),
c as (select id, {stratum} as stratum, row_number() over (partition by {stratum} order by md5(id || '|{SEED}'), id) as n from {source})
select id, stratum from c join f using (stratum) where n <= quota"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        market_share_by_state, size_distribution, owner_visibility, owners_per_parent, sites_by_state, method_breakdown, state_counts, roster_compared, roster_spread, confidence_grades,
        acquirers, release_diff, review_accuracy, match_rates, stratified_sample, reservoir_sample, vector_topk, vector_topk_tagged, page_texts, keyword_relevance, event_props, roster_paths,
        fetch_lag, order_priorities, distinct_lines, listed_and_new, status_rollup, typed_prefixes, two_level_sample, ruled_sites,
    )
}

ORACLE: dict[str, str] = {
    "market_share_by_state": f"""
with u as (select street, zip5, min(state) as state from ({_UNIVERSE}) where state is not null group by all), t as (select street, zip5, bool_or(is_private) as is_private from ({_TRACKED}) group by all)
select state, count(*) as sites, count(t.street) as tracked, count(*) filter (t.is_private) as private, round(count(t.street) * 100.0::double / count(*), 1) as tracked_share, round(count(*) filter (t.is_private) * 100.0::double / count(*), 1) as private_share
from u left join t using (street, zip5) group by state having count(*) >= {LEAST_SITES}""",
    "size_distribution": f"""
with u as (select distinct stem, street, zip5 from ({_UNIVERSE})), n as (select stem, count(*) as n from u group by 1)
select case when n >= 25 then '25+' when n >= 10 then '10-24' when n >= 5 then '5-9' when n >= 2 then '2-4' else '1' end as bucket, count(distinct stem) as operators, count(distinct (street, zip5)) as sites from u join n using (stem) group by 1""",
    "owner_visibility": f"""
select o.owner, count(s.owner) as visible from (select {_ID.format('id')} as owner from owner_entity) o left join (
  select distinct owner, street, zip5 from ({r._CLINICS}) c where street <> '' and exists (select 1 from ({_UNIVERSE}) u where u.street = c.street and u.zip5 = c.zip5)) s on s.owner = o.owner group by 1""",
    "owners_per_parent": f"select p.name as parent, count(distinct {_ID.format('o.id')}) as n_owners from owner_entity o join parent_pe_firm p on {_ID.format('p.id')} = {_ID.format('o.parent_pe_firm_id')} group by 1",
    "sites_by_state": "select coalesce(nullif(upper(trim(state)), ''), 'unknown') as state, count(*) as n, round(count(*) / sum(count(*)) over (), 4) as fraction from clinic group by 1",
    "method_breakdown": "select coalesce(confidence_method, 'unknown') as method, count(*) as n, round(count(*) / sum(count(*)) over (), 4) as fraction from clinic group by 1",
    "state_counts": f"""
select s.state, count(c.state) as n_sites from (select distinct state from ({_UNIVERSE}) where state is not null) s left join (
  select upper(trim(state)) as state from clinic where {_ID.format('owner_entity_id')} in (select {_ID.format('id')} from owner_entity where parent_pe_firm_id is not null)) c on c.state = s.state group by 1""",
    "roster_compared": _COUNTS + """
select *, round(ours::double / nullif(theirs, 0), 2) as ratio from (select count(*) as pairs, count(*) filter (ours > 0) as measured, cast(sum(ours) filter (ours > 0) as bigint) as ours, cast(sum(theirs) filter (ours > 0) as bigint) as theirs,
count(*) filter (ours > 0 and ours > theirs) as higher, count(*) filter (ours > 0 and ours < theirs) as lower, count(*) filter (ours > 0 and ours = theirs) as equal from n where theirs is not null)""",
    "roster_spread": _COUNTS + "select count(*) as n, min(x) as least_ratio, max(x) as greatest_ratio, count(*) filter (x is null) as without_ratio from (select round(ours::double / nullif(theirs, 0), 1) as x from n where ours >= 3)",
    "confidence_grades": f"""
with c as (select c.*, o.m = 'in_home' as in_home, l.street is not null as listed from ({r._CLINICS}) c left join (select {_ID.format('id')} as owner, service_model as m from owner_entity) o using (owner) left join (select distinct street, zip5 from ({r._ROSTER})) l on l.street = c.street and l.zip5 = c.zip5)
select case when listed then 'owner_verified' when in_home then 'in_home' when registry_last_updated is null then 'registry_undated' when (date '{AS_OF}' - registry_last_updated) / 365.25 < 3 then 'registry_current'
  when (date '{AS_OF}' - registry_last_updated) / 365.25 < 6 then 'registry_aging' else 'registry_stale' end as grade, count(*) as n from c group by 1""",
    "acquirers": f"""
select {_ID.format('p.id')} as parent, p.name as parent_name, count(c.id) as sites, count(distinct case when c.id is not null then {_ID.format('o.id')} end) as brands, count(distinct upper(trim(c.state))) as states
from parent_pe_firm p left join owner_entity o on {_ID.format('o.parent_pe_firm_id')} = {_ID.format('p.id')} left join clinic c on {_ID.format('c.owner_entity_id')} = {_ID.format('o.id')} group by 1, 2""",
    "release_diff": f"""
with b as (select nullif(trim(npi), '') as npi, resolver_version as v, coalesce({_ID.format('owner_entity_id')}, '') as owner from clinic where nullif(trim(npi), '') is not null),
o as (select npi, min(owner) as owner from b where v < '0.5' group by 1), n as (select npi, min(owner) as owner from b where v >= '0.5' group by 1)
select coalesce(o.npi, n.npi) as npi, case when o.npi is null then 'added' when n.npi is null then 'removed' else 'changed' end as change_kind from o full join n on o.npi = n.npi where o.owner is distinct from n.owner""",
    "review_accuracy": """
select *, round(agree::double / nullif(agree + disagree, 0), 4) as accuracy from (select coalesce(matcher, 'unknown') as matcher, count(*) as n, count(*) filter (lower(trim(verdict)) = 'match') as agree, count(*) filter (lower(trim(verdict)) = 'no_match') as disagree,
count(*) filter (lower(trim(verdict)) not in ('match', 'no_match') or verdict is null) as unclear from match_pair group by 1)""",
    "match_rates": f"""
select coalesce(matcher, 'unknown') as matcher, count(*) as n, {_RATE} as k, round({_RATE}::double / count(*), 6) as rate,
round(greatest(0, ({_P} + {_Z} / (2 * count(*)) - 1.96 * sqrt({_P} * (1 - {_P}) / count(*) + {_Z} / (4.0 * count(*) * count(*)))) / (1 + {_Z} / count(*))), 6) as low,
round(least(1, ({_P} + {_Z} / (2 * count(*)) + 1.96 * sqrt({_P} * (1 - {_P}) / count(*) + {_Z} / (4.0 * count(*) * count(*)))) / (1 + {_Z} / count(*))), 6) as high from match_pair group by 1""",
    "stratified_sample": _sampled("clinic", "coalesce(confidence_method, 'unknown')", 60),
    "two_level_sample": _sampled(f"({r._CLAIMS})", "coalesce(claim_type, 'unknown') || '|' || coalesce(confidence_method, 'unknown')", 80),
    "page_texts": f"select doc_id, length(plain) as n_chars, md5(plain) as digest from (select doc_id, trim(regexp_replace({_PLAIN}, '[ \\t\\n\\x0B\\f\\r\u00a0]+', ' ', 'g')) as plain from documents where text is not null)",
    "roster_paths": """
with p as (select center_id, regexp_extract(detail_url, '^[a-z]+://([^/?#]+)', 1) as host, regexp_extract(detail_url, '^[a-z]+://[^/?#]+([^?#]*)', 1) as path from roster_center where detail_url is not null)
select center_id, host, len(string_split(path, '/')) - 1 as depth, array_to_string(list_transform(string_split(replace(regexp_replace(string_split(path, '/')[-1], '-[0-9]+$', ''), '-', ' '), ' '), lambda w: upper(w[1:1]) || lower(w[2:])), ' ') as place from p""",
    "reservoir_sample": f"select id from staging_bacb_provider where npi is not null order by md5(id || '|{SEED}'), id limit 40",
    "vector_topk": _TOPK.format(""),
    "vector_topk_tagged": _TOPK.format("and e.label = q.label"),
    "keyword_relevance": "select doc_id, regexp_matches(lower(concat_ws(' ', source, text)), 'covenant|recoup|statut') as relevant from documents",
    "event_props": "select event_type, count(*) as n, count(k) as with_k, cast(sum(k) as bigint) as sum_k from (select event_type, cast(json_extract_string(props, '$.k') as int) as k from events) group by 1",
    "fetch_lag": "select lower(trim(source_type)) as kind, count(*) as n, cast(min(l) as int) as least, cast(max(l) as int) as most, cast(sum(l) as bigint) as days from (select source_type, cast(created_at as date) - cast(fetched_at as date) as l from source_record) group by 1",
    "order_priorities": """
select c_mktsegment, o_orderpriority, count(*) as n_orders, cast(sum(coalesce(n, 0)) as bigint) as n_lines from orders join customer on o_custkey = c_custkey
left join (select l_orderkey, count(*) as n from lineitem group by 1) on l_orderkey = o_orderkey group by all""",
    "distinct_lines": "select l_returnflag, count(*) as n, count(distinct (l_orderkey, l_linenumber)) as n_distinct from lineitem group by 1",
    "listed_and_new": f"select exists (select 1 from ({r._CLINICS}) c where c.building = l.building and c.zip5 = l.zip5) as known, count(*) as n from ({r._ROSTER}) l where street <> '' group by 1",
    "status_rollup": "select count(*) as listed, count(*) filter (s in ('a', 's')) as in_scope, count(*) filter (s = 'a') as n_a, count(*) filter (s = 's') as n_s, cast(coalesce(sum(length(raw_name)) filter (s = 's'), 0) as bigint) as uncovered_size from (select *, lower(trim(registry_status)) as s from registry_snapshot)",
    "typed_prefixes": f"select c.id, count(*) as n from ({r._CLINICS}) c join (select distinct street as listed, zip5 from ({r._ROSTER}) where length(street) >= 10) l on l.zip5 = c.zip5 and starts_with(c.street, l.listed) where c.zip5 <> '' group by 1",
    "ruled_sites": f"select c.id, case when o.service_model = 'in_home' then 'in_home' when not o.is_aba then 'other_service' when street = '' then 'no_street' end as rule from ({r._CLINICS}) c join owner_entity o on {_ID.format('o.id')} = c.owner where rule is not null",
}
