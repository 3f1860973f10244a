"""Sites, claims and chains (ER-03 to ER-12, MET-01 to MET-03, VAL-01 to VAL-05)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlattice.operators.joins import best

#: Methods that a chain may rest on.
TRUSTED = ("exact_match", "fuzzy_high", "llm_inferred", "human_verified")


def link_sites(staged: DataFrame, held_keys: DataFrame, excluded: DataFrame | None, order: Sequence[str]) -> DataFrame:
    """ER-03/04, J-15, WIN-01, FLT-11: staged rows that become new sites.

    ``staged`` has owner, place, area (ADR-03) besides its own columns; rows without a
    place are dropped, so are those at an excluded (owner, place), those whose key was
    ever held, and all but the first of a key in ``order``, which must be total.
    """
    rows = staged.where("place is not null")
    if excluded is not None:
        rows = rows.join(excluded.select("owner", "place").distinct(), ["owner", "place"], "left_anti")
    keys = ["owner", "place", "area"]
    return best(rows.join(held_keys.select(*keys).distinct(), keys, "left_anti"), keys, [F.col(c) for c in order])


def site_claims(sites: DataFrame, confidence: float = 0.88, method: str = "fuzzy_high", version: str = "1") -> tuple[DataFrame, DataFrame]:
    """ER-05, IDM-03: the sites with ids that follow from their key, and a claim site to owner for each."""
    ids = sites.withColumn("site_id", F.sha2(F.concat_ws("|", "owner", "place", "area"), 256))
    claims = ids.select(
        F.sha2(F.concat_ws("|", F.lit("clinic_to_owner"), "site_id", F.lit(version)), 256).alias("claim_id"), F.lit("clinic_to_owner").alias("claim_type"), "site_id", "owner",
        F.lit(confidence).alias("confidence_score"), F.lit(method).alias("confidence_method"), F.lit(version).alias("resolver_version"),
    )
    return ids, claims


def verified(scored: DataFrame) -> DataFrame:
    """ER-09: a scorer's answer without a supporting snippet is no link; a confidence outside [0, 1] fails the job."""
    bare = ~F.coalesce(F.size(F.filter("snippets", lambda s: F.trim(s) != "")) > 0, F.lit(False))
    bad = (F.col("confidence") < 0) | (F.col("confidence") > 1)
    flags = F.coalesce("flags", F.array().cast("array<string>"))
    return scored.withColumns({
        "link": F.when(bare, False).otherwise(F.col("link")),
        "confidence": F.when(bad, F.raise_error(F.lit("confidence outside [0, 1]")).cast("double")).when(bare, 0.0).otherwise(F.col("confidence")),
        "flags": F.when(bare, F.array_append(flags, F.lit("no_supporting_snippet"))).otherwise(flags),
    })


def chains(first: DataFrame, second: DataFrame) -> DataFrame:
    """ER-12, AGG-27, WIN-05: the best chain of each site.

    ``first``: site, owner, c1; ``second``: owner, parent, c2; live and
    trusted edges only. A chain is as sure as its weakest link, the surest wins, an
    incomplete one too if it is surer; an owner with a second hop gives complete
    chains only. Ties: the surer first hop, then second hop, then the least ids; claims
    that still tie say the same chain, so theirs are not carried along.

    Which second hop suits a first one best doesn't depend on it: the surest of the
    owner, or one of unknown confidence. So an owner keeps two at most before the join,
    and rows grow with the first hops, not with first times second hops of an owner.
    """
    hops = best(second.select("owner", "parent", "c2", F.col("c2").isNull().alias("_unknown")), ["owner", "_unknown"], [F.desc("c2"), F.col("parent").asc_nulls_last()])
    walked = first.select("site", "owner", "c1").join(hops.drop("_unknown"), "owner", "left").withColumns({"confidence": F.least("c1", F.coalesce("c2", "c1")), "complete": F.col("parent").isNotNull()})
    order = [F.desc("confidence"), F.desc("c1"), F.col("c2").desc_nulls_last(), F.col("owner"), F.col("parent").asc_nulls_last()]
    return best(walked, ["site"], order).select("site", "owner", "parent", F.round("confidence", 6).alias("confidence"), "complete")


def decisions(claims: DataFrame, floors: dict[str, float], rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """VAL-01..03: ``decision, trust, deciding_rule`` for each claim.

    ``rules`` are named predicates in order; the first that holds quarantines. Else the
    floor of the claim's type decides, at or above passes; an unknown type fails, a
    null confidence is 0.
    """
    reason = F.coalesce(*[F.when(F.coalesce(p, F.lit(False)), F.lit(n)) for n, p in rules]) if rules else F.lit(None).cast("string")
    floor = F.lit(None).cast("double")
    for kind, least in floors.items():
        floor = F.when(F.col("claim_type") == kind, F.lit(least)).otherwise(floor)
    score = F.coalesce(F.col("confidence_score"), F.lit(0.0))
    decision = F.when(reason.isNotNull(), "quarantined").when(F.coalesce(score >= floor, F.lit(False)), "passed").otherwise("failed")
    rule = F.coalesce(reason, F.when(floor.isNotNull(), F.concat(F.col("claim_type"), F.lit(":floor="), F.format_string("%.2f", floor))), F.lit("unknown_type"))
    return claims.withColumns({"decision": decision, "deciding_rule": rule}).withColumn("trust", F.when(F.col("decision") == "passed", "verified").otherwise("unverified"))


def quarantine_rules(contradict: str, flags: str, label: str, challenged: str) -> list[tuple[str, Column]]:
    """VAL-02: the rules in their order: sources contradict, a flag was raised, the reviewer could not tell, someone objects.

    Columns: contradict and challenged are boolean, flags is an array, label a reviewer's
    word; nulls never hold. A label that disagrees does not quarantine.
    """
    from kinlattice.functions.arrays import filled

    return [("sources_contradict", F.col(contradict)), ("llm_flag", filled(F.col(flags))), ("reviewer_unclear", F.lower(F.trim(label)) == "unclear"), ("external_challenge", F.col(challenged))]


def undecided(claims: DataFrame, log: DataFrame, claim: str = "id") -> DataFrame:
    """J-09/10: claims that the log does not know yet."""
    return claims.join(log.select(claim).distinct(), claim, "left_anti")


def run_summary(decided: DataFrame) -> DataFrame:
    """VAL-04, AGG-26: counters of a run and its gate: no failure and something evaluated."""
    n = lambda d: F.count_if(F.col("decision") == d)
    return decided.agg(F.count("*").alias("evaluated"), n("passed").alias("passed"), n("failed").alias("failed"), n("quarantined").alias("quarantined"), ((n("failed") == 0) & (F.count("*") > 0)).alias("gate_passed"))


def published(claims: DataFrame, log: DataFrame, claim: str = "id") -> DataFrame:
    """MET-01, J-01/11, FLT-01/02: live claims with sources whose log has a pass and no quarantine."""
    live = claims.where("superseded_by is null and size(source_record_ids) > 0")
    passed, held = (log.where(F.col("decision") == d).select(claim).distinct() for d in ("passed", "quarantined"))
    return live.join(passed, claim, "left_semi").join(held, claim, "left_anti")


def quarantine(claims: DataFrame, taken: DataFrame, rule: str, log: DataFrame, claim: str = "id") -> DataFrame:
    """COR-09, COR-14: decisions that quarantine the claims of ``taken``, those already quarantined left alone."""
    held = log.where("decision = 'quarantined'").select(claim).distinct()
    return claims.join(taken.select(claim).distinct(), claim, "left_semi").join(held, claim, "left_anti").select(claim, F.lit("quarantined").alias("decision"), F.lit(rule).alias("deciding_rule"), F.lit("unverified").alias("trust"))


def resolve(queries: DataFrame, entities: DataFrame, scorer, k: int = 10, floor: float = 0.7, version: str = "1") -> DataFrame:
    """ER-08 to ER-11: claims for the candidates that a scorer confirms.

    ``queries``: query_id, embedding; ``entities``: entity_id, kind, embedding; ``scorer``
    maps candidates (query_id, entity_id, similarity) to the same with link, confidence,
    snippets and flags. Candidates below ``floor`` are never scored. The claim's type
    follows the kind of the entity, and its id from both ends and the version.
    """
    from kinlattice.operators.vectors import top_k

    candidates = top_k(queries, entities.select("entity_id", "embedding"), k, floor=floor)
    yes = verified(scorer(candidates.select("query_id", "entity_id", "similarity"))).where("link")
    kind = F.when(F.col("kind") == "owner", "clinic_to_owner").when(F.col("kind") == "parent", "owner_to_pe_firm")
    typed = yes.join(entities.select("entity_id", "kind"), "entity_id").withColumn("claim_type", kind).where("claim_type is not null")
    return typed.select(
        F.sha2(F.concat_ws("|", "claim_type", F.col("query_id").cast("string"), F.col("entity_id").cast("string"), F.lit(version)), 256).alias("claim_id"),
        "claim_type", "query_id", "entity_id", F.col("confidence").alias("confidence_score"), F.lit("llm_inferred").alias("confidence_method"), "flags", F.lit(version).alias("resolver_version"),
    )
