"""Operators on small fixtures: nulls, ties, empty tables, clashing columns."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kinlattice.functions.dates import iso_text
from kinlattice.operators import claims, dedup, guards, joins, metrics, orphans, sampling, snapshots, vectors


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


SNAP = "s string, k string, d string, v string, ord int"


def test_changes(spark):
    df = spark.createDataFrame([
        ("1", "a", "2020-01-01", "x", 9), ("2", "a", "2020-01-01", "x", 9), ("3", "a", "2020-02-01", "y", 9),
        ("1", "b", None, None, 9), ("3", "b", None, None, 9), ("2", "c", "2020-01-01", "x", 9), ("2", "c", "2019-01-01", "old", 9), (None, "z", None, None, 1), ("1", None, None, None, 1),
    ], SNAP)
    got = snapshots.changes(df, "s", "k", F.col("d"), ["v", "d"])
    assert rows(got.select("s", "k", "change_kind")) == [("2", "b", "removed"), ("2", "c", "added"), ("3", "a", "changed"), ("3", "b", "added"), ("3", "c", "removed")]
    assert got.where("change_kind = 'changed'").first()["changed_columns"] == ["v", "d"]
    assert snapshots.changes(df.limit(0), "s", "k", F.col("d"), ["v"]).count() == 0
    assert snapshots.changes(df.where("s = '1'"), "s", "k", F.col("d"), ["v"]).count() == 0


def test_changes_against_brute_force(spark):
    rnd = random.Random(3)
    data = [(str(s), f"k{rnd.randrange(30)}", rnd.choice([None, "2020-01-01", "1/1/2020", "2/2/2021"]), rnd.choice(["x", "y", None])) for s in (1, 2, 4, 5) for _ in range(60)]
    df = spark.createDataFrame(data, "s string, k string, d string, v string").withColumn("d", iso_text(F.col("d")))
    got = {(r[0], r[1], r[2]) for r in snapshots.changes(df, "s", "k", F.col("d"), ["v", "d"]).select("s", "k", "change_kind").collect()}
    best = {}
    for s, k, d, v in [tuple(r) for r in df.collect()]:
        best[s, k] = max(best.get((s, k), ("", "", "")), (d or "", v or "", d or ""))
    want = set()
    for a, b in (("1", "2"), ("2", "4"), ("4", "5")):
        for k in {x for s, x in best if s in (a, b)}:
            o, n = best.get((a, k)), best.get((b, k))
            if o != n:
                want.add((b, k, "added" if o is None else "removed" if n is None else "changed"))
    assert got == want


def test_change_plan_has_one_range_exchange(spark):
    df = spark.createDataFrame([("1", "a", "x")], "s string, k string, v string")
    plan = snapshots.changes(df, "s", "k", F.lit("1"), ["v"])._jdf.queryExecution().toString()
    assert plan.count("RepartitionByExpression") >= 1 and "rangepartitioning(k" in plan


def test_orphans(spark):
    t = lambda *x: dt.datetime(*x)
    df = spark.createDataFrame([
        ("r1", [" P1 ", None, "", "gone"], "p2", t(2024, 5, 10), "clash"), ("r2", None, "p2", t(2024, 5, 2), "clash"), ("r3", ["p3"], None, t(2024, 5, 1), "clash"), ("r3", ["p3"], None, t(2024, 5, 1), "clash"), ("r4", ["p1"], "nope", None, "clash"),
    ], "id string, ids array<string>, one string, extracted_at timestamp_ntz, created string")
    held = spark.createDataFrame([("p1", t(2020, 1, 1)), ("p2", t(2024, 5, 5)), ("p3", t(2024, 6, 1)), ("p3", None)], "id string, created_at timestamp_ntz")
    refs = orphans.references(df, "t", {"ids": "P", "one": "P"})
    got = rows(orphans.orphans(refs, orphans.parents(held, "P")))
    assert got == sorted([("t", "2024-05", "r1", "ids", "gone"), ("t", "2024-05", "r2", "one", "p2"), ("t", None, "r4", "one", "nope")], key=repr)
    assert orphans.orphans(refs.limit(0), orphans.parents(held, "P")).count() == 0
    assert orphans.orphans(refs, orphans.parents(held.limit(0), "P")).count() == 7  # p1 twice, gone, p2 twice, p3, nope


def test_longest_prefix(spark):
    names = spark.createDataFrame([(1, "bluesprigpediatricshouston"), (2, "acmetherapy"), (3, ""), (4, None), (5, "bluesprig")], "id int, norm string")
    brands = spark.createDataFrame([("bluesprigpediatrics", "specific"), ("bluesprig", "generic"), ("bluesprig", "zz"), ("april", "short"), (None, "n")], "brand string, owner string")
    assert rows(joins.longest_prefix(names, "norm", brands, "brand", "owner").select("id", "owner")) == [(1, "specific"), (5, "generic")]


def test_two_tier(spark):
    u = spark.createDataFrame([("1mainste1", "1main", "1"), ("1mainste2", "1main", "1"), ("2elmste9", "2elm", "1")], "street string, building string, zip5 string")
    r = spark.createDataFrame([("a", "1mainste1", "1main", "1"), ("b", "1mainste7", "1main", "1"), ("c", "2elm", "2elm", "1")], "id string, street string, building string, zip5 string")
    assert rows(joins.two_tier(r, u, ["street", "zip5"], ["building", "zip5"]).select("id", "tier", "matched_street")) == [("a", "exact", "1mainste1"), ("b", "none", None), ("c", "building", "2elmste9")]


def test_survivor_order(spark):
    d = dt.date
    df = spark.createDataFrame([("b", d(2020, 1, 1), False), ("a", None, True), ("c", d(2024, 1, 1), False)], "id string, day date, listed boolean").withColumn("k", F.lit(1))
    order = [F.desc("listed"), F.col("day").desc_nulls_last(), F.col("id")]
    assert rows(dedup.superseded(df, ["k"], order)) == [("b", "a"), ("c", "a")]
    assert rows(dedup.superseded(df.where("not listed"), ["k"], order)) == [("b", "c")]
    assert rows(dedup.superseded(df.repartition(3).orderBy("id"), ["k"], order)) == [("b", "a"), ("c", "a")]


def test_ghosts(spark):
    d = dt.date
    df = spark.createDataFrame([("x", "p1", d(2018, 1, 1), "s"), ("y", "p2", d(2022, 1, 1), "s"), ("z", "p1", d(2021, 6, 1), "t"), ("w", "p2", d(2022, 1, 1), "t"), ("n", None, None, "s")], "id string, parent string, day date, street string")
    assert [(r["stale_id"], r["live_id"]) for r in dedup.ghosts(df, ["street"], "parent", "day").collect()] == [("x", "y")]


CHAINS = [
    ([("o1", 0.95)], [("o1", "pe1", 0.60)], (0.60, True)),
    ([("o1", 0.50)], [("o1", "pe1", 0.90)], (0.50, True)),
    ([("o1", 0.80)], [], (0.80, False)),
    ([("a", 0.90), ("b", 0.70)], [("a", "pe1", 0.60), ("b", "pe2", 0.80)], (0.70, True)),
    ([("inc", 0.95), ("comp", 0.85)], [("comp", "pe1", 0.65)], (0.95, False)),
    ([("o1", 0.90)], [("o1", "weak", 0.55), ("o1", "strong", 0.80)], (0.80, True)),
]


@pytest.mark.parametrize("first, second, want", CHAINS)
def test_chains(spark, first, second, want):
    a = spark.createDataFrame([(f"c{i}", "site", o, c) for i, (o, c) in enumerate(first)], "claim1 string, site string, owner string, c1 double")
    b = spark.createDataFrame([(f"d{i}", o, p, c) for i, (o, p, c) in enumerate(second)], "claim2 string, owner string, parent string, c2 double")
    (r,) = claims.chains(a, b).collect()
    assert (r["confidence"], r["complete"]) == want


def joined_rows(plan) -> int:
    """Most rows that a join of an executed plan gave."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return joined_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return joined_rows(plan.plan())
    below = [joined_rows(plan.children().apply(i)) for i in range(plan.children().size())]
    return max([0, *below, *([plan.metrics().apply("numOutputRows").value()] if "Join" in kind else [])])


def test_chains_of_a_hot_owner(spark):
    """Every chain of an owner compared in plain Python; the join gives two rows a first hop at most."""
    first = [(f"s{i % 40}", "hot" if i % 7 else "other", None if i % 31 == 3 else i * 37 % 10 / 10) for i in range(400)] + [("lone", "none", 0.4)]
    second = [("hot", f"p{i * 13 % 50:02}", i * 7 % 8 / 10) for i in range(300)] + [("hot", "p99", None), ("hot", "p98", None), ("other", "p1", None), ("other", "p0", 0.35)]
    low = lambda x: -1.0 if x is None else x
    walked = {}
    for site, owner, c1 in first:
        for parent, c2 in [(p, c) for o, p, c in second if o == owner] or [(None, None)]:
            sure = min((c for c in (c1, c1 if c2 is None else c2) if c is not None), default=None)
            walked.setdefault(site, []).append(((-low(sure), -low(c1), -low(c2), owner, parent or "~"), (owner, parent, sure, parent is not None)))
    a = spark.createDataFrame([(f"c{i}", *x) for i, x in enumerate(first)], "claim1 string, site string, owner string, c1 double")
    b = spark.createDataFrame([(f"d{i}", *x) for i, x in enumerate(second)], "claim2 string, owner string, parent string, c2 double")
    df = claims.chains(a, b)
    assert {r["site"]: tuple(r)[1:] for r in df.collect()} == {k: min(v, key=lambda x: x[0])[1] for k, v in walked.items()}
    assert 0 < joined_rows(df._jdf.queryExecution().executedPlan()) <= 2 * len(first)


def test_best_chains_of_odd_claims(spark, tmp_path):
    """Claims without an id and without a number count as in SQL; the claims are read once."""
    import duckdb

    from kinlattice.plans import resolution
    from tests.conftest import same_rows

    day = dt.datetime(2025, 1, 1)
    made = [
        (None, "clinic_to_owner", "S1", " o1", None, 0.9, "exact_match", None, day), ("a", "clinic_to_owner", "s2", "o1", None, float("nan"), "exact_match", None, day),
        ("b", "clinic_to_owner", "s3", "o2", None, None, "fuzzy_high", None, day), ("c", "owner_to_pe_firm", None, "O1", "p2", 0.8, "exact_match", None, day),
        ("d", "owner_to_pe_firm", None, "o1", "p1", 0.8, "exact_match", None, day), ("e", "owner_to_pe_firm", None, "o1", "p0", 0.9, "fuzzy_low", None, day),
        ("f", "clinic_to_owner", "s4", "o1", None, 0.7, "exact_match", "x", day), (" F", "clinic_to_owner", "s4", "o1", None, 0.7, "exact_match", None, day + dt.timedelta(1)),
        ("g", "clinic_to_owner", "s5", "", None, 0.7, "exact_match", None, day), ("h", "owner_to_pe_firm", "s6", "o1", " ", 1.0, "exact_match", None, day),
    ]
    schema = "id string, claim_type string, clinic_id string, owner_entity_id string, parent_pe_firm_id string, confidence_score double, confidence_method string, superseded_by string, created_at timestamp"
    path = f"{tmp_path}/resolution_claim.parquet"
    spark.createDataFrame(made, schema).coalesce(1).write.parquet(path)
    duck = duckdb.connect()
    duck.execute(f"create view resolution_claim as select * from read_parquet('{path}/*.parquet')")
    df = resolution.best_chains(spark, str(tmp_path))
    same_rows(df, duck.execute(resolution.ORACLE["best_chains"]).df())
    df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan") == 1


def test_decisions(spark):
    df = spark.createDataFrame([("a", "x", 0.80, None), ("b", "x", 0.79, []), ("c", "x", 0.99, ["f"]), ("d", "other", 0.99, None), ("e", "x", None, None)], "id string, claim_type string, confidence_score double, flags array<string>")
    got = claims.decisions(df, {"x": 0.8}, [("flagged", F.size("flags") > 0)])
    assert [(r["id"], r["decision"], r["deciding_rule"]) for r in got.orderBy("id").collect()] == [("a", "passed", "x:floor=0.80"), ("b", "failed", "x:floor=0.80"), ("c", "quarantined", "flagged"), ("d", "failed", "unknown_type"), ("e", "failed", "x:floor=0.80")]


def test_verified(spark):
    s = "link boolean, confidence double, snippets array<string>, flags array<string>"
    r = claims.verified(spark.createDataFrame([(True, 0.9, [], None)], s)).first()
    assert (r["link"], r["confidence"], r["flags"]) == (False, 0.0, ["no_supporting_snippet"])
    with pytest.raises(Exception, match="confidence outside"):
        claims.verified(spark.createDataFrame([(True, 1.5, ["s"], None)], s)).collect()


@pytest.mark.parametrize("sizes, n, want", [({"a": 10}, 5, {"a": 5}), ({"a": 20, "b": 20, "c": 20}, 30, {"a": 10, "b": 10, "c": 10}), ({}, 5, {}), ({"a": 5}, 100, {"a": 5}), ({"a": 98, "b": 1, "c": 1}, 10, {"a": 8, "b": 1, "c": 1})])
def test_quotas(sizes, n, want):
    assert sampling.quotas(sizes, n) == want


def test_sample_is_seeded(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit("m").alias("m"))
    draw = lambda seed: rows(sampling.stratified(df, F.col("m"), 20, "id", seed).select("id"))
    assert draw(1) == draw(1) != draw(2) and len(draw(1)) == 20
    assert sampling.stratified(df.limit(0), F.col("m"), 20, "id", 1).count() == 0


def test_size_buckets(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("b", 2)], "op string, site int")
    assert rows(metrics.size_buckets(df, "op", ["site"])) == [("1", 1, 1), ("2-4", 1, 2)]


def test_guards(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        guards.require_at_least(df, 4, "rows")
    with pytest.raises(ValueError):
        guards.require_none(df, "found")
    held = spark.createDataFrame([("u1", "h1")], "u string, h string")
    new = spark.createDataFrame([("u1", "h1", 1), ("u2", "h2", 2), ("u2", "h2", 3), ("u3", None, 4), ("u3", None, 5)], "u string, h string, n int")
    assert [r["n"] for r in guards.fresh(new, held, ["u", "h"], ["n"]).orderBy("n").collect()] == [2, 4, 5]
    have = spark.createDataFrame([("ACME",), (None,)], "name string")
    assert rows(guards.upsert_missing(spark.createDataFrame([("acme",), ("New",), ("NEW",), (None,), (" ",)], "name string"), have, "name")) == [("NEW",)]


def test_top_k(spark):
    e = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None)], "entity_id int, embedding array<double>")
    q = e.withColumnRenamed("entity_id", "query_id").where("query_id = 1")
    assert rows(vectors.top_k(q, e, 5).select("entity_id", "similarity", "rank")) == [(2, 1.0, 1), (3, 0.0, 2)]


def test_resolve(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, embedding array<double>")
    e = spark.createDataFrame([(10, "owner", [1.0, 0.1]), (11, "parent", [1.0, 0.2]), (12, "owner", [0.0, 1.0])], "entity_id int, kind string, embedding array<double>")
    score = lambda c: c.withColumns({"link": F.lit(True), "confidence": F.lit(0.9), "snippets": F.when(F.col("entity_id") == 10, F.array(F.lit("s"))), "flags": F.lit(None).cast("array<string>")})
    got = claims.resolve(q, e, score).collect()
    assert [(r["entity_id"], r["claim_type"], r["confidence_score"]) for r in got] == [(10, "clinic_to_owner", 0.9)]  # 12 is below the floor, 11 has no snippet


def test_quarantine_and_totals(spark):
    c = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    log = spark.createDataFrame([("a", "quarantined"), ("b", "passed")], "id string, decision string")
    assert [r["id"] for r in claims.quarantine(c, c.where("id != 'c'"), "r", log).collect()] == ["b"]
    t = spark.createDataFrame([("x", 1, 2, True), ("y", 5, 5, False), ("z", 5, 5, None)], "n string, p int, q int, ok boolean")
    assert tuple(metrics.totals_where(t, F.col("ok"), ["p", "q"], "n").first()) == (1, 1, 2, ["x"])


def test_stub_vectors_have_no_neighbours(spark):
    df = vectors.embed(spark.createDataFrame([(1, "a"), (2, None)], "entity_id int, t string"), "t", vectors.zero_provider(3))
    assert df.first()["embedding"] == [0.0, 0.0, 0.0]
    assert vectors.top_k(df.withColumnRenamed("entity_id", "query_id"), df, 3).count() == 0


def test_zip_lookup(spark):
    points = spark.createDataFrame([("10001", 1.0, 2.0), ("10002", 3.0, 4.0)], "zip5 string, lat double, lng double")
    assert rows(joins.lookup_or_area(spark.createDataFrame([("10001",), ("10099",), ("99999",), (None,)], "zip5 string"), points)) == sorted([("10001", 1.0, 2.0), ("10099", 2.0, 3.0), ("99999", None, None), (None, None, None)], key=repr)


def test_top_k_of_text_ids_ties_floors_and_lengths(spark):
    e = [("b", [1.0, 0.0]), ("a", [2.0, 0.0]), ("c", [0.0, 1.0]), ("z", [0.0, 0.0]), ("n", None), ("l", [1.0, 0.0, 0.0]), (None, [1.0, 0.0])]
    ents = spark.createDataFrame([(i, v, "x", "clash") for i, v in e], "entity_id string, embedding array<float>, tag string, _v string").drop("_v")
    q = spark.createDataFrame([("a", [1.0, 0.0], "x"), ("q", [1.0, 1.0], "y"), ("o", None, "x"), ("zero", [0.0, 0.0], "x")], "query_id string, embedding array<float>, tag string")
    got = [tuple(r) for r in vectors.top_k(q, ents, 2).orderBy("query_id", "rank").collect()]
    assert got == [("a", "b", 1.0, 1), ("a", "c", 0.0, 2), ("q", "a", 0.707107, 1), ("q", "b", 0.707107, 2)]
    assert [r["entity_id"] for r in vectors.top_k(q, ents, 2, floor=0.5).where("query_id = 'a'").collect()] == ["b"]
    assert {r["query_id"] for r in vectors.top_k(q, ents, 2, tag="tag").collect()} == {"a"}
    assert vectors.top_k(q.limit(0), ents, 2).count() == 0 and vectors.top_k(q, ents.limit(0), 2).count() == 0


def test_top_k_against_brute_force_in_blocks(spark, monkeypatch):
    import random

    rnd = random.Random(3)
    v = {i: [rnd.choice([-1.0, 0.0, 1.0, 2.0]) for _ in range(4)] for i in range(120)}
    monkeypatch.setattr(vectors, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(vectors, "CELLS", 50)
    ents = spark.createDataFrame(list(v.items()), "entity_id long, embedding array<double>").repartition(5)
    got = {}
    for r in vectors.top_k(spark.createDataFrame([(i, v[i]) for i in range(20)], "query_id long, embedding array<double>"), ents, 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["entity_id"], r["similarity"]))
    size = lambda a: sum(x * x for x in a) ** 0.5
    for q in range(20):
        if size(v[q]) == 0:
            assert q not in got
            continue
        want = sorted((-round(sum(a * b for a, b in zip(v[q], w)) / size(v[q]) / size(w), 6), i) for i, w in v.items() if i != q and size(w) > 0)[:5]
        assert [(-s, i) for _, i, s in sorted(got[q])] == [(s, i) for s, i in want]


def test_intake_counts_every_row_once(spark):
    df = spark.createDataFrame([("s", "a", None), ("s", "a", None), ("s", "b", "x"), ("t", None, None), (None, "a", "x")], "source string, name string, line string")
    got = {r["source"]: tuple(r)[1:] for r in metrics.intake(df.withColumnRenamed("source", "src"), "src", F.col("name").isNull(), ["name", "line"]).collect()}
    assert got == {"s": (3, 2, 1, 0), "t": (1, 0, 0, 1), None: (1, 1, 0, 0), "all": (5, 3, 1, 1)}


def test_recall_and_most_common(spark):
    cases = spark.createDataFrame([("a", "b"), ("a", "b"), ("c", "d")], "a string, b string")
    found = spark.createDataFrame([("m", "a", "b"), ("m", "x", "y"), ("n", "c", "d"), ("n", "a", "b")], "matcher string, a string, b string")
    assert {r["matcher"]: (r["n"], r["k"]) for r in metrics.recall(cases, found, ["a", "b"], "matcher").collect()} == {"m": (2, 1), "n": (2, 2)}
    assert metrics.recall(cases.limit(0), found, ["a", "b"], "matcher").count() == 0
    df = spark.createDataFrame([("x",), ("y",), ("y",), ("a",), (None,)], "v string")
    assert [(r["v"], r["place"]) for r in metrics.most_common(df.where("v is not null"), "v", 2).orderBy("place").collect()] == [("y", 1), ("a", 2)]


def test_covered_platforms_need_operators(spark):
    owners = spark.createDataFrame([("o1",)], "owner string")
    p = lambda *rows: spark.createDataFrame(list(rows), "name string, status string, owners array<string>")
    guards.require_covered(p(("a", "covered", ["o1"]), ("b", "blocked", None)), owners, "name", "status", "owners", "owner")
    for bad in (("a", "covered", None), ("a", "covered", []), ("a", "covered", ["gone"])):
        with pytest.raises(ValueError):
            guards.require_covered(p(bad), owners, "name", "status", "owners", "owner")


def test_quarantine_rules_in_order(spark):
    rows = [("1", True, ["f"], "unclear", True), ("2", False, ["f"], "unclear", True), ("3", None, [], " UNCLEAR ", True), ("4", None, None, "disagree", True), ("5", None, None, "disagree", None), ("6", None, None, None, None)]
    df = spark.createDataFrame([(*r, "clinic_to_owner", 0.9) for r in rows], "id string, c boolean, flags array<string>, label string, x boolean, claim_type string, confidence_score double")
    got = {r["id"]: r["deciding_rule"] for r in claims.decisions(df, {"clinic_to_owner": 0.8}, claims.quarantine_rules("c", "flags", "label", "x")).collect()}
    assert got == {"1": "sources_contradict", "2": "llm_flag", "3": "reviewer_unclear", "4": "external_challenge", "5": "clinic_to_owner:floor=0.80", "6": "clinic_to_owner:floor=0.80"}


def test_kept_deliveries_give_the_same_changes(spark, tmp_path):
    rnd = random.Random(8)
    data = [(str(n), f"k{rnd.randrange(40):02d}", rnd.choice([None, "2020-01-01", "2021-01-01"]), rnd.choice([None, "x", "y"]), 0) for n in (1, 2) for _ in range(60)]
    df = spark.createDataFrame(data, SNAP)
    for n in ("1", "2"):
        snapshots.keep(snapshots.one_per_key(df.where(F.col("s") == n), "s", "k", F.col("d"), ["v", "d"]), "k", str(tmp_path / n))
    old, new = (spark.read.parquet(str(tmp_path / n)) for n in ("1", "2"))
    got = snapshots.between(old, new, "k", ["v", "d"])
    assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == rows(snapshots.changes(df, "s", "k", F.col("d"), ["v", "d"]).drop("s"))
    assert rows(snapshots.between(old.limit(0), new, "k", ["v", "d"]).select("change_kind").distinct()) == [("added",)]


def test_too_many_strata_are_refused(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("id"))
    with pytest.raises(ValueError):
        sampling.stratified(df, F.col("id"), 5, "id", 1, most_strata=20)
    assert sampling.stratified(df, F.lit("a"), 5, "id", 1, most_strata=20).count() == 5
