"""Consolidating pairwise matches into groups (problem 1).

Alternating large-star and small-star rewrites of the edge list, each one an
aggregation and a join, until nothing changes. An edge is stored once, from the
larger id to the smaller; in that form the two rewrites are

* large-star: (v, u) becomes (v, m) with m the least neighbour of u, or u itself,
* small-star: (v, w) becomes (w, m) and (v, m) with m the least neighbour of v.

Every vertex ends with one edge, to the least id of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlattice.functions.text import canonical_id
from kinlattice.runtime import adaptive, drop_stage, held_by, stage


def _oriented(pairs: DataFrame) -> DataFrame:
    """Distinct edges from the larger id to the smaller, without loops and nulls."""
    return pairs.where("a != b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()


def _least(edges: DataFrame) -> DataFrame:
    """Per vertex with a smaller neighbour, the least one; partial minima combine before the shuffle."""
    return edges.groupBy(F.col("v").alias("x")).agg(F.min("u").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    # u's least neighbour is below u or does not exist: then u itself is the least.
    return edges.join(_least(edges), F.col("u") == F.col("x"), "left").select("v", F.coalesce("m", "u").alias("u")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowered = edges.join(_least(edges), F.col("v") == F.col("x"))
    return lowered.select(F.explode(F.array(F.struct("v", F.col("m").alias("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e")).select("e.v", "e.u").where("v != u").distinct()


def _print_of(edges: DataFrame) -> tuple:
    """Count and order-independent fingerprint of the edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u")), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected(pairs: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(id, group_id)`` for every id in a pair of two different ids.

    ``group_id`` is the least id connected with ``id``. Null ends and self pairs
    link nothing; repeated and reversed pairs count once; no pairs give no rows.
    Each round is written to the shared folder, so lineage stays one round deep and
    no component is ever gathered in a task: a hub with a third of all edges is
    combined map-side for its minimum, and its edges meet that one row in a join
    that AQE broadcasts or splits. Rounds grow with the logarithm of the longest
    chain; should ``max_rounds`` not suffice, this raises.
    """
    adaptive(pairs.sparkSession)
    edges = stage(_oriented(pairs.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")), "edges")
    seen = _print_of(edges)
    for _ in range(max_rounds):
        after = stage(_small_star(_large_star(edges)), "edges")
        now = _print_of(after)
        drop_stage(edges)
        edges = after
        if now == seen:
            roots = edges.select(F.col("u").alias("id")).distinct()
            return held_by(edges, edges.select(F.col("v").alias("id"), F.col("u").alias("group_id")).unionByName(roots.select("id", F.col("id").alias("group_id"))))
        seen = now
    raise RuntimeError(f"components not settled after {max_rounds} rounds")


def record_links(records: DataFrame, match_pairs: DataFrame) -> DataFrame:
    """``(a, b)``: links between records that exist.

    A record's ``superseded_by`` links it to the record named; a pair whose verdict
    is "match" (case and blanks aside) links both of its ids. Untidy ids are made
    canonical, and a pair with an end that is no record links nothing.
    """
    ids = records.select(canonical_id(F.col("id")).alias("id")).where("id is not null").distinct()
    named = records.select(canonical_id(F.col("id")).alias("a"), canonical_id(F.col("superseded_by")).alias("b"))
    said = match_pairs.where(F.lower(F.trim("verdict")) == "match").select(canonical_id(F.col("left_id")).alias("a"), canonical_id(F.col("right_id")).alias("b"))
    edges = _oriented(named.unionByName(said).where("a is not null and b is not null"))
    there = lambda end: F.col(end) == F.col("id")
    return edges.join(ids, there("v"), "left_semi").join(ids, there("u"), "left_semi").select(F.col("v").alias("a"), F.col("u").alias("b"))


def record_groups(records: DataFrame, match_pairs: DataFrame) -> DataFrame:
    """``(id, group_id)`` of records that are linked to another one."""
    return connected(record_links(records, match_pairs))
