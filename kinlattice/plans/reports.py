"""Queries of coverage, reconciliation, state files, packets, events and corrections, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinlattice.functions import address, arrays, text
from kinlattice.operators import claims, dedup, guards, joins, metrics, vectors
from kinlattice.plans import figures as g
from kinlattice.plans import resolution as r
from kinlattice.runtime import table

ID = text.canonical_id
#: Inline relations (SRC-27): estimates by state, and audits by state with their status.
ESTIMATES = [("first", {"OH": 12, "TX": 30, "ZZ": 4}), ("second", {"CA": 9}), ("empty", {})]
AUDITS = [("OH", "published", 120, 300, "North review"), ("OH", "blocked", 50, None, "Second review"), ("TX", "published", 75, None, "Plains review"), ("ZZ", "published", 10, 20, "Nowhere review")]


def _owners(spark, root) -> DataFrame:
    o = table(spark, root, "owner_entity")
    return o.select(ID(F.col("id")).alias("owner"), text.display_name(F.col("name"), F.col("trade_name")).alias("brand"), ID(F.col("parent_pe_firm_id")).alias("parent"), "name", "trade_name", "service_model", "is_aba")


def _parents(spark, root) -> DataFrame:
    return table(spark, root, "parent_pe_firm").select(ID(F.col("id")).alias("parent"), F.col("name").alias("firm"), F.lower("firm_type").alias("firm_type"))


def _live(spark, root) -> DataFrame:
    c = table(spark, root, "clinic").where("superseded_by is null")
    return c.select(ID(F.col("id")).alias("clinic"), ID(F.col("owner_entity_id")).alias("owner"), F.nullif(F.upper(F.trim("state")), F.lit("")).alias("state"), "extracted_at")


def named_owners(spark, root):
    """FLT-04: operators with a name or trade name on the rosters' list of names, whatever the case."""
    listed = table(spark, root, "roster_center").select(F.lower(F.trim("owner_name")).alias("n")).distinct()
    return _owners(spark, root).select("owner", F.explode(F.array("name", "trade_name")).alias("n")).select("owner", F.lower(F.trim("n")).alias("n")).join(listed, "n", "left_semi").select("owner").distinct()


def page_kinds(spark, root):
    """FLT-13/14, STR-18: marks and class of each document."""
    d = table(spark, root, "documents")
    return d.select(
        "doc_id", text.only_about(F.col("text"), "audit", ["therapy", "statut"]).alias("audit_only"), text.announced_only(F.col("text"), "READ MORE").alias("teaser"),
        text.source_class(F.array("host", "source"), {"filing": "filing", "news": "news", "press": "news"}).alias("kind"),
    )


def acquisition_events(spark, root):
    """COR-15, J-04: dated events that are not held yet, once per (parent, operator, kind, day), with both names."""
    c = table(spark, root, "resolution_claim").where("claim_type = 'owner_to_pe_firm'").select(
        ID(F.col("id")).alias("id"), ID(F.col("parent_pe_firm_id")).alias("parent"), ID(F.col("owner_entity_id")).alias("owner"), F.lit("acquired").alias("kind"), F.to_date("extracted_at").alias("day"), "superseded_by"
    ).where("parent is not null and owner is not null")
    keys = ["parent", "owner", "kind", "day"]
    new = guards.fresh(c.where("superseded_by is null"), c.where("superseded_by is not null"), keys, ["id"])
    return new.join(_parents(spark, root), "parent", "left").join(_owners(spark, root).select("owner", "brand"), "owner", "left").select("id", *keys, "firm", "brand")


def event_timeline(spark, root):
    """MET-09: events by month, with how many parents and operators."""
    return acquisition_events(spark, root).groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.count_distinct("parent").alias("parents"), F.count_distinct("owner").alias("owners"))


def estimated_states(spark, root):
    """J-26, SRC-27: estimates by state against live clinics; states without any stay with 0."""
    e = spark.createDataFrame(ESTIMATES, "estimate string, states map<string,int>").select("estimate", F.explode("states").alias("state", "estimated"))
    held = _live(spark, root).where("state is not null").groupBy("state").agg(F.count("*").alias("held"))
    return e.join(held, "state", "left").select("estimate", "state", "estimated", F.coalesce("held", F.lit(0)).alias("held"))


def claim_texts(spark, root):
    """J-27, STR-16, PRJ-04: what each claim asserts, by names from three tables in one literal-tagged union."""
    named = lambda t, name: table(spark, root, t).select(F.lit(t).alias("target"), ID(F.col("id")).alias("key"), name.alias("title"))
    names = reduce(DataFrame.unionByName, [named("clinic", F.col("name")), named("owner_entity", text.display_name(F.col("name"), F.col("trade_name"))), named("parent_pe_firm", F.col("name"))])
    out = r._claims(spark, root).select("id", "claim_type", *[ID(F.col(c)).alias(c) for c in ("clinic_id", "owner_entity_id", "parent_pe_firm_id")])
    for t, c, as_ in (("clinic", "clinic_id", "site"), ("owner_entity", "owner_entity_id", "owner"), ("parent_pe_firm", "parent_pe_firm_id", "parent")):
        out = out.join(names.where(F.col("target") == t).select(F.col("key").alias(c), F.col("title").alias(as_)), c, "left")
    return out.select("id", "claim_type", text.assertion(F.col("claim_type"), site=F.col("site"), owner=F.col("owner"), parent=F.col("parent")).alias("assertion"))


def table_counts(spark, root):
    """AGG-03/05: rows of three tables in one row, by one conditional aggregation."""
    names = ("clinic", "owner_entity", "resolution_claim")
    tagged = reduce(DataFrame.unionByName, [table(spark, root, n).select(F.lit(n).alias("t")) for n in names])
    return tagged.agg(*[F.count_if(F.col("t") == n).alias(n) for n in names])


def directory_owners(spark, root):
    """AGG-08, FLT-06: operators and whether any source of their clinics is directory-typed."""
    s = table(spark, root, "source_record").select(ID(F.col("id")).alias("key"), F.lower(F.trim("source_type")).like("%director%").alias("listed"))
    c = table(spark, root, "clinic").select(ID(F.col("id")).alias("id"), ID(F.col("owner_entity_id")).alias("owner"), "source_record_ids").where("owner is not null")
    met = joins.bridge(c, "id", "source_record_ids").join(s, "key").join(c.select("id", "owner"), "id")
    return met.groupBy("owner").agg(F.bool_or(F.coalesce("listed", F.lit(False))).alias("listed"))


def owner_site_counts(spark, root):
    """AGG-10: live clinics by operator, brand, firm and firm type."""
    return _live(spark, root).join(_owners(spark, root), "owner").join(_parents(spark, root), "parent").groupBy("owner", "brand", "firm", "firm_type").agg(F.count("*").alias("n"))


def state_brand_counts(spark, root):
    """AGG-11: live clinics of private equity by state, brand and firm."""
    met = _live(spark, root).join(_owners(spark, root), "owner").join(_parents(spark, root).where("firm_type = 'private_equity'"), "parent")
    return met.groupBy("state", "brand", "firm").agg(F.count("*").alias("n"))


def private_by_state(spark, root):
    """AGG-12: live clinics of private equity by state, where it is known."""
    met = _live(spark, root).where("state is not null").join(_owners(spark, root), "owner").join(_parents(spark, root).where("firm_type = 'private_equity'"), "parent", "left_semi")
    return met.groupBy("state").agg(F.count("*").alias("n"))


def most_common_states(spark, root):
    """AGG-21, TOP-03: the ten states with most live clinics, ties by name."""
    return metrics.most_common(_live(spark, root).where("state is not null"), "state", 10)


def ranked_states(spark, root):
    """TOP-05: states by share, then sites, then name."""
    shares = g.market_share_by_state(spark, root)
    w = Window.orderBy(F.desc("tracked_share"), F.desc("sites"), "state")  # over one row per state
    return shares.select("state", "tracked_share", "sites", F.row_number().over(w).alias("place"))


def relevant_first(spark, root):
    """TOP-06: the first hundred documents, relevant ones before the others, each in their own order."""
    return g.keyword_relevance(spark, root).orderBy(F.desc("relevant"), "doc_id").limit(100)


def keyword_hits(spark, root):
    """SET-05: documents that some keyword finds, once each, with the first keyword of the list."""
    d = table(spark, root, "documents").where("text is not null").select("doc_id", F.lower("text").alias("t"))
    found = reduce(DataFrame.unionByName, [d.where(F.contains("t", F.lit(w))).select("doc_id", F.lit(i).alias("i"), F.lit(w).alias("word")) for i, w in enumerate(("lease", "audit", "bench"))])
    return found.groupBy("doc_id").agg(F.min_by("word", "i").alias("word"))


def intake_counters(spark, root):
    """AGG-30: what staging saw, staged, skipped and failed, by source and summed over sources."""
    s = table(spark, root, "staging_bacb_provider")
    failed = F.coalesce(F.trim("address_line1"), F.lit("")) == ""
    return metrics.intake(s, "source_record_id", failed, ["raw_name", "address_line1", "zip"])


def _platforms(spark, root) -> DataFrame:
    """Per parent a status, its operators, and how many facilities the rosters list for them."""
    o = _owners(spark, root).where("parent is not null")
    listed = table(spark, root, "roster_center").groupBy(text.blankless(F.col("owner_name")).alias("b")).agg(F.count("*").alias("facilities"))
    own = o.withColumn("b", text.blankless(F.col("brand"))).join(listed, "b", "left").groupBy("parent").agg(F.sort_array(F.collect_set("owner")).alias("owners"), F.sum("facilities").alias("facilities"))
    status = F.when(F.col("firm_type") == "other", "excluded").when(F.col("owners").isNull(), "not_started").when(F.col("firm_type") == "private_equity", "covered").otherwise("blocked")
    return _parents(spark, root).join(own, "parent", "left").select("parent", "firm", status.alias("status"), "owners", "facilities")


def platform_counts(spark, root):
    """J-23, TOP-07, AGG-13: published clinics of each platform's operators, and its place within its status, the largest first."""
    p = _platforms(spark, root)
    per_owner = _live(spark, root).where("owner is not null").groupBy("owner").agg(F.count("*").alias("n"))
    summed = p.select("parent", F.explode("owners").alias("owner")).join(per_owner, "owner", "left").groupBy("parent").agg(F.sum(F.coalesce("n", F.lit(0))).alias("published"))
    w = Window.partitionBy("status").orderBy(F.coalesce("facilities", F.lit(0)).desc(), "parent")
    return p.join(summed, "parent", "left").select("parent", "status", F.coalesce("published", F.lit(0)).alias("published"), F.coalesce("facilities", F.lit(0)).alias("facilities"), F.row_number().over(w).alias("place"))


def coverage_rollup(spark, root):
    """MET-05, AGG-22, VAL-09: platforms by status, after the check that every covered one has operators that exist."""
    p = _platforms(spark, root)
    guards.require_covered(p, _owners(spark, root), "parent", "status", "owners", "owner")
    return metrics.status_rollup(p, "status", ["covered", "not_started", "blocked"], "facilities")


def _visibility(spark, root) -> DataFrame:
    c = r.keyed_clinics(spark, root).where("superseded_by is null and street != '' and owner is not null").select("id", "owner", "street", "zip5", "building")
    universe = g._universe(spark, root).select("street", "zip5").distinct().withColumn("building", address.building_key(F.col("street")))
    return joins.two_tier(c, universe, ["street", "zip5"], ["building", "zip5"])


def reconciliation(spark, root):
    """MET-06, J-25, AGG-24/25: published against registry-visible sites over operators; a missing operator fails the job."""
    v = _visibility(spark, root).groupBy("owner").agg(F.count("*").alias("published"), F.count_if(F.col("tier") != "none").alias("visible"))
    known = _owners(spark, root).select("owner", "brand")
    owners = v.join(known.select("owner").distinct(), "owner", "left_semi").join(known, "owner", "left")
    sure = guards.raise_on_null(owners, "brand", "operator without a name")
    ratio = F.round(F.try_divide(F.col("published").cast("double"), F.nullif("visible", F.lit(0))), 1)
    return sure.agg(
        F.sum("published").alias("published"), F.sum("visible").alias("visible"), (F.sum("published") - F.sum("visible")).alias("directory_only"),
        F.round(F.try_divide(F.sum("published").cast("double"), F.sum("visible").cast("double")), 2).alias("ratio"), F.count_if(F.col("visible") == 0).alias("invisible"),
        F.min(F.when(F.col("published") >= 3, ratio)).alias("least_ratio"), F.max(F.when(F.col("published") >= 3, ratio)).alias("greatest_ratio"),
    )


def market_share_visible(spark, root):
    """MET-04, J-18, WIN-08, AGG-14/16/17: registry sites and the tracked ones among them, by state.

    A tracked clinic counts where the registry shows it, at its own place or as the only
    unit of its building, so the numerator lies within the denominator; a site's state is
    the one written first, primary rows before secondary ones.
    """
    reg = table(spark, root, "registry_snapshot").where(F.col("address_line1").rlike("[A-Za-z0-9]"))
    written = reg.select("raw_name", "address_line1", "zip", "state", F.lower(F.trim("location_kind")).alias("kind"), F.trim("snapshot_id").alias("snapshot_id")).groupBy("raw_name", "address_line1", "zip", "state", "kind").agg(F.min("snapshot_id").alias("first"), F.count("*").alias("n"))
    rows = written.select(
        F.when(F.col("n") > 0, text.chain_stem(F.col("raw_name"))).alias("stem"), address.street_key(F.col("address_line1")).alias("street"), address.zip5(F.col("zip")).alias("zip5"),
        F.nullif(F.upper(F.substring(F.trim("state"), 1, 2)), F.lit("")).alias("state"), (F.col("kind") != "primary").alias("later"), "first",
    ).where("length(stem) >= 6 and state is not null")  # after the count, see _universe
    sites = rows.groupBy("street", "zip5").agg(F.min(F.struct("later", "first", "state"))["state"].alias("state")).withColumn("building", address.building_key(F.col("street")))
    tracked = g._tracked(spark, root).withColumn("building", address.building_key(F.col("street")))
    seen = joins.two_tier(tracked, sites, ["street", "zip5"], ["building", "zip5"]).where("tier != 'none'").select(F.col("matched_street").alias("street"), F.col("matched_zip5").alias("zip5"), "is_private")
    return metrics.market_share(sites, seen, "state", ["street", "zip5"], g.LEAST_SITES)


def state_files(spark, root):
    """MET-07, J-24, PRJ-05, AGG-23, VAL-10: footprint and audit figures of each state; figures of blocked audits are left out, not null."""
    audits = spark.createDataFrame(AUDITS, "state string, status string, improper int, potential int, title string")
    guards.require_none(audits.where("status not in ('published', 'blocked')"), "audits of unknown status")
    known = audits.where("status = 'published'").groupBy("state").agg(F.count("*").alias("audits"), F.sum("improper").alias("improper"), F.sum("potential").alias("potential"))
    foot = state_brand_counts(spark, root).where("state is not null").groupBy("state").agg(F.sum("n").alias("sites"), F.count_distinct("brand").alias("brands"))
    states = g._universe(spark, root).where("state is not null").select("state").unionByName(audits.select("state")).distinct()
    out = states.join(foot, "state", "left").join(known, "state", "left").select("state", F.coalesce("sites", F.lit(0)).alias("sites"), F.coalesce("brands", F.lit(0)).alias("brands"), F.coalesce("audits", F.lit(0)).alias("audits"), "improper", "potential")
    return out.select("state", "sites", "brands", "audits", arrays.dropping_nulls(state=F.col("state"), sites=F.col("sites"), improper=F.col("improper"), potential=F.col("potential")).alias("figures"))


def audit_totals(spark, root):
    """AGG-23: totals over published audits only, the two amounts never together."""
    audits = spark.createDataFrame(AUDITS, "state string, status string, improper int, potential int, title string")
    out = metrics.totals_where(audits, F.col("status") == "published", ["improper", "potential"], "title")
    return out.withColumn("names", F.array_join("names", "; "))


def parent_flags(spark, root):
    """MET-09, SET-02: parents with their live clinics, whether all links to them are superseded, and whether they have in-home operators."""
    o = _owners(spark, root)
    links = table(spark, root, "resolution_claim").where("claim_type = 'owner_to_pe_firm'").select(ID(F.col("parent_pe_firm_id")).alias("parent"), F.col("superseded_by").isNull().alias("current")).groupBy("parent").agg(F.bool_or("current").alias("current"))
    sites = _live(spark, root).join(o.select("owner", "parent"), "owner").groupBy("parent").agg(F.count("*").alias("sites"))
    in_home = o.where("service_model = 'in_home'").select("parent", F.lit(True).alias("in_home")).distinct()
    met = _parents(spark, root).join(links, "parent", "left").join(sites, "parent", "left").join(in_home, "parent", "left")
    return met.select("parent", "firm", F.coalesce("sites", F.lit(0)).alias("sites"), (~F.coalesce("current", F.lit(True))).alias("former"), F.coalesce("in_home", F.lit(False)).alias("in_home"))


def brand_table(spark, root):
    """MET-09: brands with live clinics, states and firm."""
    met = _live(spark, root).join(_owners(spark, root), "owner").join(_parents(spark, root), "parent", "left")
    return met.groupBy("brand", "firm").agg(F.count("*").alias("sites"), F.count_distinct("state").alias("states"))


def audit_packet(spark, root):
    """MET-10, AGG-01..06: a release's figures in long form: states, firms, methods, review labels and the difference to the one before."""
    part = lambda name, df, key, n="n": df.select(F.lit(name).alias("section"), F.coalesce(F.col(key), F.lit("unknown")).alias("key"), F.col(n).cast("bigint").alias("n"))
    labels = g.review_accuracy(spark, root).agg(*[F.sum(c).alias(c) for c in ("agree", "disagree", "unclear")])
    long = labels.select(F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("n")) for c in ("agree", "disagree", "unclear")])).alias("x")).select("x.*")
    parts = [
        part("state", g.sites_by_state(spark, root), "state"), part("firm", g.owners_per_parent(spark, root), "parent", "n_owners"), part("method", g.method_breakdown(spark, root), "method"),
        part("review", long, "key"), part("diff", g.release_diff(spark, root).groupBy("change_kind").agg(F.count("*").alias("n")), "change_kind"),
    ]
    return reduce(DataFrame.unionByName, parts)


def claim_quarantine(spark, root):
    """VAL-02: all four rules in order: contradicting sources, a flag, an unclear review, a challenge from outside."""
    c = r._claims(spark, root)
    site = ID(F.col("clinic_id"))
    two = c.where("claim_type = 'clinic_to_owner'").groupBy(site.alias("site")).agg((F.count_distinct(ID(F.col("owner_entity_id"))) > 1).alias("contradict"))
    unsure = table(spark, root, "match_pair").where("coalesce(lower(trim(verdict)), '') not in ('match', 'no_match')").select(ID(F.col("left_id")).alias("site"), F.lit("unclear").alias("label")).distinct()
    ctx = c.withColumn("site", site).join(two, "site", "left").join(unsure, "site", "left").withColumn("challenged", F.col("superseded_by").isNotNull())
    return claims.decisions(ctx, r.FLOORS, claims.quarantine_rules("contradict", "llm_flags", "label", "challenged")).select("id", "decision", "deciding_rule")


def matcher_recall(spark, root):
    """VAL-07: of the pairs that any matcher matched, how many each one did, with its interval, apart by kind of matcher."""
    m = table(spark, root, "match_pair").select(F.coalesce("matcher", F.lit("unknown")).alias("matcher"), F.least(ID(F.col("left_id")), ID(F.col("right_id"))).alias("a"), F.greatest(ID(F.col("left_id")), ID(F.col("right_id"))).alias("b"), (F.lower(F.trim("verdict")) == "match").alias("hit"))
    pairs = m.where("a != b and hit").select("a", "b").distinct()
    by = m.where("a != b and hit").select("matcher", "a", "b").distinct()
    return metrics.recall(pairs, by, ["a", "b"], "matcher")


def typed_collisions(spark, root):
    """VAL-08, J-21: staged rows whose typed street begins with one that their operator already holds."""
    met = r.brand_prefix_match(spark, root).select("id", F.col("owner_id").alias("owner"))
    rows = table(spark, root, "staging_bacb_provider").select("id", address.street_key(F.col("address_line1")).alias("street")).join(met, "id")
    held = r.keyed_clinics(spark, root).where("owner is not null").select("owner", F.col("street").alias("held")).distinct()
    return joins.prefix_within(rows, held, ["owner"], "street", "held").groupBy("id", "owner").agg(F.count("*").alias("n"))


def undecided_claims(spark, root):
    """J-09/10: claims that a log of passes does not know."""
    return claims.undecided(r._claims(spark, root), r.claim_decisions(spark, root).where("decision = 'passed'")).select("id")


def made_claims(spark, root):
    """ER-05, IDM-03: a claim for each new site, with ids that follow from its key."""
    return claims.site_claims(r.link_first_wins(spark, root))[1].select("claim_id", "site_id", "owner", "confidence_score", "confidence_method")


def roster_links(spark, root):
    """ER-04, FLT-11: new sites from the operators' own lists, one explicit operator a row; places that list no page are kept out."""
    rows = table(spark, root, "roster_center").withColumn("owner", text.blankless(F.col("owner_name")))
    k = address.site_key(F.col("owner"), F.col("address_line1"), F.col("zip"), F.col("city"), F.col("state"))
    keyed = rows.select("center_id", "detail_url", k.alias("k")).where("k is not null").select("center_id", "detail_url", "k.owner", "k.place", "k.area")
    return claims.link_sites(keyed, r.site_keys(spark, root), keyed.where("detail_url is null"), ["center_id"]).select("center_id", "owner", "place", "area")


def street_contradicted(spark, root):
    """COR-07, J-17: clinics at streets that no roster lists, whatever the ZIP; refuses a list of fewer than eight."""
    c = r.keyed_clinics(spark, root).where("street != ''")
    return dedup.contradicted(c, r.keyed_roster(spark, root).where("street != ''"), ["street"], 8).select("id", "street")


def scope_quarantine(spark, root):
    """COR-09, COR-14: claims of operators that are not of the trade, quarantined unless they are already."""
    other = _owners(spark, root).where("not is_aba").select("owner")
    c = r._claims(spark, root)
    taken = c.withColumn("owner", ID(F.col("owner_entity_id"))).join(other, "owner", "left_semi")
    return claims.quarantine(c, taken, "out_of_scope", r.claim_decisions(spark, root)).select("id", "decision", "deciding_rule", "trust")


def moved_owners(spark, root):
    """COR-10: clinics whose operator was superseded by one that has clinics of its own."""
    edges = table(spark, root, "clinic").select(ID(F.col("id")).alias("id"), ID(F.col("owner_entity_id")).alias("owner")).where("owner is not null")
    moves = table(spark, root, "owner_entity").select(ID(F.col("id")).alias("old_owner"), ID(F.col("superseded_by")).alias("new_owner")).where("new_owner is not null")
    return dedup.owner_moves(edges, moves).select("id", "owner", "moved")


def vector_claims(spark, root):
    """ER-08..11, FLT-17: claims for the candidates above a floor that a scorer confirms."""
    e = table(spark, root, "embeddings")
    kind = F.when(F.col("label") % 3 == 0, "owner").when(F.col("label") % 3 == 1, "parent").otherwise("site")
    entities = e.select(F.col("vec_id").alias("entity_id"), kind.alias("kind"), "embedding")
    scorer = lambda c: c.select("query_id", "entity_id", (F.col("similarity") >= 0.25).alias("link"), F.col("similarity").alias("confidence"), F.when(F.col("entity_id") % 7 != 0, F.array(F.lit("seen"))).alias("snippets"), F.lit(None).cast("array<string>").alias("flags"))
    made = claims.resolve(e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), entities, scorer, 10, 0.2)
    return made.select("claim_id", "claim_type", "query_id", "entity_id", F.round("confidence_score", 4).alias("confidence_score"))


def coordinates(spark, root):
    """J-22, AGG-19, ADR-14: clinics placed by ZIP, else by the mean of the ZIPs with the same first three digits."""
    points = r.keyed_roster(spark, root).where("zip5 != ''").select("zip5").distinct().select("zip5", (F.col("zip5").cast("int") / 1024).alias("lat"), (F.col("zip5").cast("int") % 100 / -8).alias("lng"))
    return joins.lookup_or_area(r.keyed_clinics(spark, root).select("id", "zip5"), points).select("id", "lat", "lng")


def clinic_titles(spark, root):
    """PRJ-01/03, STR-15/17/19: shown columns of live clinics: title, place, confidence in per cent, detail."""
    c = table(spark, root, "clinic").where("superseded_by is null")
    o = _owners(spark, root).select("owner", "trade_name", "brand")
    met = c.withColumn("owner", ID(F.col("owner_entity_id"))).join(o, "owner", "left")
    return met.select(
        ID(F.col("id")).alias("id"), text.title(F.col("name"), F.lit(None).cast("string"), F.col("brand")).alias("title"), text.locality(F.col("city"), F.col("state"), F.col("zip")).alias("place"),
        text.percent(F.col("confidence_score")).alias("confidence"), text.detail(F.col("confidence_method"), F.col("resolver_version"), most=20).alias("detail"),
    )


def wide_columns(spark, root):
    """ARR-05/06, FLT-07: the first filled of several columns, and whether one of them holds a code."""
    s = table(spark, root, "staging_bacb_provider")
    return s.select("id", arrays.first_filled(F.col("npi"), F.col("credential_type"), F.col("registry_status")).alias("first"), F.coalesce(arrays.any_of([F.coalesce("credential_type", F.lit("")), F.coalesce("registry_status", F.lit(""))], ["RBT", "A"]), F.lit(False)).alias("coded"))


def json_forms(spark, root):
    """JSN-02/03: clinics as JSON with nulls kept and with nulls left out."""
    c = table(spark, root, "clinic")
    parts = {"id": ID(F.col("id")), "npi": F.col("npi"), "zip": F.col("zip")}
    return c.select(ID(F.col("id")).alias("id"), arrays.as_json(**parts).alias("whole"), arrays.dropping_nulls(**parts).alias("short"))


_ID = r._ID
_OWN = f"select {_ID.format('id')} as owner, coalesce(trade_name, name) as brand, {_ID.format('parent_pe_firm_id')} as parent, name, trade_name, service_model, is_aba from owner_entity"
_PAR = f"select {_ID.format('id')} as parent, name as firm, lower(firm_type) as firm_type from parent_pe_firm"
_LIVE = f"select {_ID.format('id')} as clinic, {_ID.format('owner_entity_id')} as owner, nullif(upper(trim(state)), '') as state from clinic where superseded_by is null"
_EVENTS = f"""
with c as (select {_ID.format('id')} as id, {_ID.format('parent_pe_firm_id')} as parent, {_ID.format('owner_entity_id')} as owner, 'acquired' as kind, cast(extracted_at as date) as day, superseded_by from resolution_claim where claim_type = 'owner_to_pe_firm'),
k as (select * from c where parent is not null and owner is not null),
n as (select * from k where superseded_by is null and not exists (select 1 from k h where h.superseded_by is not null and h.parent = k.parent and h.owner = k.owner and h.day is not distinct from k.day and k.day is not null)
  qualify day is null or row_number() over (partition by parent, owner, kind, day order by id) = 1),
e as (select n.id, n.parent, n.owner, kind, day, firm, brand from n left join ({_PAR}) p on p.parent = n.parent left join ({_OWN}) o on o.owner = n.owner)
"""
_AUDITS = "(values " + ", ".join(f"('{s}', '{t}', {i}, {'null' if p is None else p}, '{n}')" for s, t, i, p, n in AUDITS) + ") a(state, status, improper, potential, title)"
_PLATFORMS = f"""
with l as (select {r._NORM.format('owner_name')} as b, count(*) as facilities from roster_center group by 1),
w as (select parent, list_sort(list(distinct owner)) as owners, sum(facilities) as facilities from (select *, {r._NORM.format('brand')} as b from ({_OWN}) where parent is not null) left join l using (b) group by 1),
p as (select parent, firm, case when firm_type = 'other' then 'excluded' when owners is null then 'not_started' when firm_type = 'private_equity' then 'covered' else 'blocked' end as status, owners, facilities from ({_PAR}) left join w using (parent))
"""
_VISIBLE = f"""
with u as (select distinct street, zip5, regexp_replace(street, '(ste|bldg|flr).*$', '') as building from ({g._UNIVERSE})),
b as (select building, zip5 from u group by all having count(*) = 1),
v as (select c.owner, count(*) as published, count(*) filter (u.street is not null or b.building is not null) as visible from (select * from ({r._CLINICS}) where superseded_by is null and street <> '' and owner is not null) c
  left join u on u.street = c.street and u.zip5 = c.zip5 left join b on b.building = c.building and b.zip5 = c.zip5 group by 1),
o as (select v.* from v where owner in (select owner from ({_OWN}))),
x as (select *, round(published::double / nullif(visible, 0), 1) as ratio from o)
"""
_FIRST = f"select stem, street, zip5, nullif(upper(trim(state)[1:2]), '') as state, later, first from ({r.street_sql('registry_snapshot', f'{r._STEM} as stem, {r._ZIP5} as zip5, state, lower(trim(location_kind)) <> {chr(39)}primary{chr(39)} as later, trim(snapshot_id) as first')}) where street <> '' and length(stem) >= 6"
_WILSON = (
    "round(greatest(0.0, (k::double / n + 1.96 * 1.96 / (2 * n) - 1.96 * sqrt(k::double / n * (1 - k::double / n) / n + 1.96 * 1.96 / (4.0 * n * n))) / (1 + 1.96 * 1.96 / n)), 6) as low,"
    " round(least(1.0, (k::double / n + 1.96 * 1.96 / (2 * n) + 1.96 * sqrt(k::double / n * (1 - k::double / n) / n + 1.96 * 1.96 / (4.0 * n * n))) / (1 + 1.96 * 1.96 / n)), 6) as high"
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        named_owners, page_kinds, acquisition_events, event_timeline, estimated_states, claim_texts, table_counts, directory_owners, owner_site_counts, state_brand_counts, private_by_state,
        most_common_states, ranked_states, relevant_first, keyword_hits, intake_counters, platform_counts, coverage_rollup, reconciliation, market_share_visible, state_files, audit_totals,
        parent_flags, brand_table, audit_packet, claim_quarantine, matcher_recall, typed_collisions, undecided_claims, made_claims, roster_links, street_contradicted, scope_quarantine,
        moved_owners, vector_claims, coordinates, clinic_titles, wide_columns, json_forms,
    )
}

ORACLE: dict[str, str] = {
    "named_owners": f"select distinct owner from (select owner, unnest([name, trade_name]) as n from ({_OWN})) where lower(trim(n)) in (select lower(trim(owner_name)) from roster_center)",
    "page_kinds": """select doc_id, contains(lower(coalesce(text, '')), 'audit') and not regexp_matches(lower(coalesce(text, '')), 'therapy|statut') as audit_only, contains(upper(coalesce(text, '')), 'READ MORE') as teaser,
case when contains(concat_ws(' ', host, source), 'filing') then 'filing' when contains(concat_ws(' ', host, source), 'news') then 'news' when contains(concat_ws(' ', host, source), 'press') then 'news' else 'other' end as kind from documents""",
    "acquisition_events": _EVENTS + "select * from e",
    "event_timeline": _EVENTS + "select strftime(day, '%Y-%m') as month, count(*) as n, count(distinct parent) as parents, count(distinct owner) as owners from e group by 1",
    "estimated_states": f"select estimate, s.state, estimated::int as estimated, coalesce(n, 0) as held from (values ('first', 'OH', 12), ('first', 'TX', 30), ('first', 'ZZ', 4), ('second', 'CA', 9)) s(estimate, state, estimated) left join (select state, count(*) as n from ({_LIVE}) group by 1) h on h.state = s.state",
    "claim_texts": f"""select c.id, claim_type, case claim_type when 'clinic_to_owner' then coalesce(nullif(trim(s.name), ''), '?') || ' -> ' || coalesce(nullif(trim(o.brand), ''), '?') when 'owner_to_pe_firm' then coalesce(nullif(trim(o.brand), ''), '?') || ' -> ' || coalesce(nullif(trim(p.firm), ''), '?') end as assertion
from ({r._CLAIMS}) c left join (select {_ID.format('id')} as id, name from clinic) s on s.id = {_ID.format('c.clinic_id')} left join ({_OWN}) o on o.owner = {_ID.format('c.owner_entity_id')} left join ({_PAR}) p on p.parent = {_ID.format('c.parent_pe_firm_id')}""",
    "table_counts": "select (select count(*) from clinic) as clinic, (select count(*) from owner_entity) as owner_entity, (select count(*) from resolution_claim) as resolution_claim",
    "directory_owners": f"select c.owner, bool_or(coalesce(s.listed, false)) as listed from (select distinct {_ID.format('id')} as id, {_ID.format('owner_entity_id')} as owner from clinic) c join ({r._BRIDGE.format(_ID.format('id'), 'clinic')}) b on b.id = c.id join (select {_ID.format('id')} as key, lower(trim(source_type)) like '%director%' as listed from source_record) s using (key) where c.owner is not null group by 1",
    "owner_site_counts": f"select owner, brand, firm, firm_type, count(*) as n from ({_LIVE}) join ({_OWN}) using (owner) join ({_PAR}) using (parent) group by all",
    "state_brand_counts": f"select state, brand, firm, count(*) as n from ({_LIVE}) join ({_OWN}) using (owner) join ({_PAR}) using (parent) where firm_type = 'private_equity' group by all",
    "private_by_state": f"select state, count(*) as n from ({_LIVE}) join ({_OWN}) using (owner) where state is not null and parent in (select parent from ({_PAR}) where firm_type = 'private_equity') group by 1",
    "most_common_states": f"select state, count(*) as n, cast(row_number() over (order by count(*) desc, state) as int) as place from ({_LIVE}) where state is not null group by 1 order by n desc, state limit 10",
    "ranked_states": f"select state, tracked_share, sites, cast(row_number() over (order by tracked_share desc, sites desc, state) as int) as place from ({g.ORACLE['market_share_by_state']})",
    "relevant_first": f"select * from ({g.ORACLE['keyword_relevance']}) order by relevant desc, doc_id limit 100",
    "keyword_hits": "select doc_id, case when contains(lower(text), 'lease') then 'lease' when contains(lower(text), 'audit') then 'audit' else 'bench' end as word from documents where regexp_matches(lower(text), 'lease|audit|bench')",
    "intake_counters": """with s as (select coalesce(trim(address_line1), '') = '' as failed, source_record_id, row_number() over (partition by source_record_id, raw_name, address_line1, zip) as n from staging_bacb_provider),
c as (select source_record_id as source, count(*) as seen, count(*) filter (not failed and n = 1) as staged, count(*) filter (not failed and n > 1) as skipped, count(*) filter (failed) as failed from s group by 1)
select * from c union all select 'all', cast(sum(seen) as bigint), cast(sum(staged) as bigint), cast(sum(skipped) as bigint), cast(sum(failed) as bigint) from c""",
    "platform_counts": _PLATFORMS + f""", n as (select owner, count(*) as n from ({_LIVE}) group by 1), s as (select parent, cast(sum(coalesce(n, 0)) as bigint) as published from (select parent, unnest(owners) as owner from p) left join n using (owner) group by 1)
select parent, status, coalesce(published, 0) as published, cast(coalesce(facilities, 0) as bigint) as facilities, cast(row_number() over (partition by status order by coalesce(facilities, 0) desc, parent) as int) as place from p left join s using (parent)""",
    "coverage_rollup": _PLATFORMS + """select count(*) as listed, count(*) filter (status <> 'excluded') as in_scope, count(*) filter (status = 'covered') as n_covered, count(*) filter (status = 'not_started') as n_not_started, count(*) filter (status = 'blocked') as n_blocked,
cast(coalesce(sum(facilities) filter (status in ('not_started', 'blocked')), 0) as bigint) as uncovered_size from p""",
    "reconciliation": _VISIBLE + """select cast(sum(published) as bigint) as published, cast(sum(visible) as bigint) as visible, cast(sum(published) - sum(visible) as bigint) as directory_only, round(sum(published)::double / nullif(sum(visible), 0), 2) as ratio, count(*) filter (visible = 0) as invisible,
min(ratio) filter (published >= 3) as least_ratio, max(ratio) filter (published >= 3) as greatest_ratio from x""",
    "market_share_visible": f"""
with s as (select street, zip5, arg_min(state, (later, first, state)) as state, regexp_replace(street, '(ste|bldg|flr).*$', '') as building from ({_FIRST}) where state is not null group by street, zip5),
b as (select building, zip5, min(street) as only from s group by all having count(*) = 1),
t as (select coalesce(s.street, b.only) as street, t.zip5, bool_or(is_private) as is_private from (select *, regexp_replace(street, '(ste|bldg|flr).*$', '') as building from ({g._TRACKED})) t
  left join s on s.street = t.street and s.zip5 = t.zip5 left join b on b.building = t.building and b.zip5 = t.zip5 group by all)
select state, count(*) as sites, count(t.street) as tracked, count(*) filter (t.is_private) as private, round(count(t.street) * 100.0::double / count(*), 1) as tracked_share, round(count(*) filter (t.is_private) * 100.0::double / count(*), 1) as private_share
from s left join t on t.street = s.street and t.zip5 = s.zip5 group by state having count(*) >= {g.LEAST_SITES}""",
    "state_files": f"""
with f as (select state, sum(n) as sites, count(distinct brand) as brands from (select state, brand, firm, count(*) as n from ({_LIVE}) join ({_OWN}) using (owner) join ({_PAR}) using (parent) where firm_type = 'private_equity' and state is not null group by all) group by 1),
k as (select state, count(*) as audits, sum(improper) as improper, sum(potential) as potential from {_AUDITS} where status = 'published' group by 1),
s as (select distinct state from ({g._UNIVERSE}) where state is not null union select state from {_AUDITS})
select state, cast(coalesce(sites, 0) as bigint) as sites, coalesce(brands, 0) as brands, coalesce(audits, 0) as audits,
'{{"state":"' || state || '","sites":' || cast(coalesce(sites, 0) as bigint) || coalesce(',"improper":' || cast(improper as bigint), '') || coalesce(',"potential":' || cast(potential as bigint), '') || '}}' as figures from s left join f using (state) left join k using (state)""",
    "audit_totals": f"select count(*) as n, cast(sum(improper) as bigint) as improper, cast(sum(potential) as bigint) as potential, string_agg(title, '; ' order by title) as names from {_AUDITS} where status = 'published'",
    "parent_flags": f"""select p.parent, firm, coalesce(sites, 0) as sites, not coalesce(current, true) as former, p.parent in (select parent from ({_OWN}) where service_model = 'in_home' and parent is not null) as in_home from ({_PAR}) p
left join (select {_ID.format('parent_pe_firm_id')} as parent, bool_or(superseded_by is null) as current from resolution_claim where claim_type = 'owner_to_pe_firm' group by 1) l using (parent) left join (select parent, count(*) as sites from ({_LIVE}) join ({_OWN}) using (owner) group by 1) s using (parent)""",
    "brand_table": f"select brand, firm, count(*) as sites, count(distinct state) as states from ({_LIVE}) join ({_OWN}) using (owner) left join ({_PAR}) using (parent) group by all",
    "audit_packet": f"""select 'state' as section, state as key, n from ({g.ORACLE['sites_by_state']}) union all select 'firm', coalesce(parent, 'unknown'), n_owners from ({g.ORACLE['owners_per_parent']}) union all select 'method', method, n from ({g.ORACLE['method_breakdown']})
union all select 'review', unnest(['agree', 'disagree', 'unclear']), cast(unnest([sum(agree), sum(disagree), sum(unclear)]) as bigint) from ({g.ORACLE['review_accuracy']}) union all select 'diff', change_kind, count(*) from ({g.ORACLE['release_diff']}) group by all""",
    "claim_quarantine": f"""
with c as (select *, {_ID.format('clinic_id')} as site from ({r._CLAIMS})), t as (select site from c where claim_type = 'clinic_to_owner' group by 1 having count(distinct {_ID.format('owner_entity_id')}) > 1),
u as (select {_ID.format('left_id')} as site from match_pair where coalesce(lower(trim(verdict)), '') not in ('match', 'no_match')),
d as (select id, claim_type, coalesce(confidence_score, 0) as s, case claim_type when 'clinic_to_owner' then 0.80 when 'owner_to_pe_firm' then 0.85 end as floor,
  case when site in (select site from t where site is not null) then 'sources_contradict' when coalesce(len(llm_flags), 0) > 0 then 'llm_flag' when site in (select site from u where site is not null) then 'reviewer_unclear' when superseded_by is not null then 'external_challenge' end as why from c)
select id, case when why is not null then 'quarantined' when s >= floor then 'passed' else 'failed' end as decision, coalesce(why, case when floor is null then 'unknown_type' else claim_type || ':floor=' || printf('%.2f', floor) end) as deciding_rule from d""",
    "matcher_recall": f"""
with m as (select coalesce(matcher, 'unknown') as matcher, least({_ID.format('left_id')}, {_ID.format('right_id')}) as a, greatest({_ID.format('left_id')}, {_ID.format('right_id')}) as b from match_pair where lower(trim(verdict)) = 'match' and {_ID.format('left_id')} <> {_ID.format('right_id')}),
c as (select matcher, count(distinct (a, b)) as k, (select count(distinct (a, b)) from m) as n from m group by 1)
select matcher, n, k, round(k::double / n, 6) as rate, {_WILSON} from c""",
    "typed_collisions": f"select s.id, m.owner_id as owner, count(*) as n from ({r.street_sql('staging_bacb_provider', 'id')}) s join ({r._MATCHED}) m using (id) join (select distinct owner, street as held from ({r._CLINICS}) where length(street) >= 10) h on h.owner = m.owner_id and starts_with(s.street, h.held) group by all",
    "undecided_claims": f"select id from ({r._CLAIMS}) where id not in (select id from ({r._DECIDED}) where decision = 'passed')",
    "made_claims": f"select sha256(concat_ws('|', 'clinic_to_owner', sha256(concat_ws('|', owner, place, area)), '1')) as claim_id, sha256(concat_ws('|', owner, place, area)) as site_id, owner, 0.88::double as confidence_score, 'fuzzy_high' as confidence_method from ({r.ORACLE['link_first_wins']})",
    "roster_links": f"""
with k as (select center_id, detail_url, {r._NORM.format('owner_name')} as owner, place, area from (select *, case when street <> '' then street when {r._NORM.format('city')} <> '' then 'city:' || {r._NORM.format('city')} end as place,
  case when street <> '' then zip5 when {r._NORM.format('city')} <> '' then upper(trim(coalesce(state, ''))) end as area from ({r.street_sql('roster_center', f'center_id, detail_url, owner_name, city, state, {r._ZIP5} as zip5')})) where place is not null)
select center_id, owner, place, area from k where not exists (select 1 from k x where x.detail_url is null and x.owner = k.owner and x.place = k.place)
and not exists (select 1 from ({r._PLACED} ({r._CLINICS})) h where h.owner = k.owner and h.place = k.place and h.area = k.area) qualify row_number() over (partition by owner, place, area order by center_id) = 1""",
    "street_contradicted": f"select id, street from ({r._CLINICS}) where street <> '' and street not in (select street from ({r._ROSTER}))",
    "scope_quarantine": f"select id, 'quarantined' as decision, 'out_of_scope' as deciding_rule, 'unverified' as trust from ({r._CLAIMS}) where {_ID.format('owner_entity_id')} in (select owner from ({_OWN}) where not is_aba) and id not in (select id from ({r._DECIDED}) where decision = 'quarantined')",
    "moved_owners": f"""
with e as (select {_ID.format('id')} as id, {_ID.format('owner_entity_id')} as owner from clinic where {_ID.format('owner_entity_id')} is not null), m as (select {_ID.format('id')} as owner, {_ID.format('superseded_by')} as n from owner_entity where {_ID.format('superseded_by')} in (select owner from e))
select id, coalesce(n, e.owner) as owner, n is not null as moved from e left join m using (owner)""",
    "vector_claims": f"""
with c as (select query_id, entity_id, similarity from ({g.ORACLE['vector_topk']}) where similarity >= 0.25 and entity_id % 7 <> 0),
t as (select c.*, case when label % 3 = 0 then 'clinic_to_owner' when label % 3 = 1 then 'owner_to_pe_firm' end as claim_type from c join embeddings on vec_id = entity_id)
select sha256(concat_ws('|', claim_type, query_id, entity_id, '1')) as claim_id, claim_type, query_id, entity_id, round(similarity, 4) as confidence_score from t where claim_type is not null""",
    "coordinates": f"""
with p as (select distinct zip5, cast(zip5 as int) / 1024 as lat, cast(zip5 as int) % 100 / -8 as lng from ({r._ROSTER}) where zip5 <> ''), a as (select zip5[1:3] as z, round(avg(lat), 5) as lat, round(avg(lng), 5) as lng from p group by 1)
select c.id, coalesce(p.lat, a.lat) as lat, coalesce(p.lng, a.lng) as lng from ({r._CLINICS}) c left join p on p.zip5 = c.zip5 left join a on a.z = c.zip5[1:3]""",
    "clinic_titles": f"""select {_ID.format('c.id')} as id, coalesce(case when not (c.name = upper(c.name) and regexp_matches(c.name, '[A-Za-z]')) then c.name end, brand, c.name) as title,
concat_ws(' ', nullif(trim(city), ''), nullif(trim(state), ''), nullif(trim(zip), '')) as place, printf('%.1f%%', confidence_score * 100) as confidence, concat_ws('; ', confidence_method, resolver_version)[1:20] as detail
from clinic c left join ({_OWN}) o on o.owner = {_ID.format('c.owner_entity_id')} where superseded_by is null""",
    "wide_columns": "select id, coalesce(nullif(trim(npi), ''), nullif(trim(credential_type), ''), nullif(trim(registry_status), '')) as first, coalesce(credential_type in ('RBT', 'A'), false) or coalesce(registry_status in ('RBT', 'A'), false) as coded from staging_bacb_provider",
    "json_forms": f"select i as id, cast(to_json({{'id': i, 'npi': npi, 'zip': zip}}) as varchar) as whole, '{{\"id\":\"' || i || '\"' || coalesce(',\"npi\":\"' || npi || '\"', '') || coalesce(',\"zip\":\"' || zip || '\"', '') || '}}' as short from (select {_ID.format('id')} as i, npi, zip from clinic)",
}
