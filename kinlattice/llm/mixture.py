"""Mixing sources to target weights (problem 8).

Every document gets a random key from a hash of its id; documents are sorted by key
within their source, distributed prefix sums of token counts run over that order, and
each source is cut where its budget is used up, after as many whole passes as fit.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinlattice.runtime import adaptive, stage

if TYPE_CHECKING:
    import pandas as pd  # loaded by the workers that need it

#: Documents per range of a source's key order; ranges are summed in parallel.
RANGE_DOCS = 50_000


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True  # their strings in a text are ordinary text
    return tok


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_tokens``: whole texts, counted with a public tokenizer.

    ``tokenizer`` is the path of a ``tokenizer.json`` that every executor can read; null
    and empty texts have no tokens.
    """
    keep = [c for c in docs.columns if c not in (text, "n_tokens")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        tok = _tokenizer(tokenizer)
        for b in batches:
            texts = b[text].fillna("").tolist()
            counts: list[int] = []
            for at in range(0, len(texts), 256):
                counts += [len(e.ids) for e in tok.encode_batch(texts[at : at + 256], add_special_tokens=False)]
            yield b[keep].assign(n_tokens=pd.Series(counts, index=b.index, dtype="int64"))

    kinds = dict(docs.dtypes)
    return docs.mapInPandas(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", n_tokens bigint")


def mix(counted: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 1, range_docs: int = RANGE_DOCS) -> tuple[DataFrame, DataFrame]:
    """The mixture ``(doc_id, source, n_tokens, copies)`` and its report by source.

    ``counted``: doc_id, source, n_tokens; ``targets``: source, target_share, max_repeats.
    The mixture is to have ``total_tokens`` tokens, as many as all documents together if
    not given. A source's budget is its share of them, at most all its documents
    ``max_repeats`` times. Whole passes over a source come first; the rest is the longest
    run of documents in key order that the budget holds, so a source ends below its
    budget by less than the document at the cut. Documents without tokens, of sources
    without a target, and null sources are not used; a target without documents, a null
    or negative share and a ``max_repeats`` below one give no documents but are
    reported. The report holds target, budget, tokens, the share reached of the mixture
    and of the budget, repeats, and whether the cap kept a source below its target.
    Keys are uniform, so ranges of keys are even: a source that holds a third of all
    rows is spread over as many ranges as it needs.
    """
    spark = adaptive(counted.sparkSession)
    docs = stage(counted.where("source is not null and n_tokens > 0").select("doc_id", "source", "n_tokens", F.xxhash64(F.lit(seed), "doc_id").alias("key")), "counted")
    want = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    held = docs.groupBy("source").agg(F.sum("n_tokens").alias("held_tokens"), F.count("*").alias("held_docs"))
    total = total_tokens if total_tokens is not None else (docs.agg(F.sum("n_tokens")).first()[0] or 0)
    cap = F.coalesce("held_tokens", F.lit(0)) * F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0))
    wish = F.floor(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0)) * F.lit(total)).cast("bigint")
    plan = want.join(held, "source", "left").select("source", "target_share", "max_repeats", F.coalesce("held_tokens", F.lit(0)).alias("held_tokens"), F.coalesce("held_docs", F.lit(0)).alias("held_docs"), wish.alias("wish"), F.least(wish, cap).alias("budget"))
    plan = plan.withColumn("passes", F.when(F.col("held_tokens") > 0, F.floor(F.col("budget") / F.col("held_tokens"))).otherwise(0).cast("bigint"))
    plan = stage(plan.withColumns({"rest": F.col("budget") - F.col("passes") * F.col("held_tokens"), "ranges": F.ceil(F.col("held_docs") / range_docs).cast("bigint")}), "plan")  # one row per target
    # The range of a key among equal parts of the key space.
    unit = F.shiftrightunsigned("key", 11).cast("double") / F.lit(float(1 << 53))
    ranged = docs.join(F.broadcast(plan.select("source", "budget", "passes", "rest", "ranges")), "source").where("budget > 0").withColumn("range", F.least(F.floor(unit * F.col("ranges")), F.col("ranges") - 1))
    order = F.shiftrightunsigned("key", 11)
    sums = ranged.groupBy("source", "range").agg(F.sum("n_tokens").alias("in_range"))
    before = sums.select("source", "range", (F.sum("in_range").over(Window.partitionBy("source").orderBy("range")) - F.col("in_range")).alias("before"))
    within = Window.partitionBy("source", "range").orderBy(order, "key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("upto", F.sum("n_tokens").over(within)).join(before, ["source", "range"])
    copies = F.col("passes") + F.when(F.col("before") + F.col("upto") <= F.col("rest"), 1).otherwise(0)
    mixture = stage(summed.select("doc_id", "source", "n_tokens", copies.cast("int").alias("copies")).where("copies > 0"), "mixture")
    used = mixture.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    report = plan.join(used, "source", "left").na.fill(0, ["tokens", "documents", "most_copies"])
    all_used = F.sum("tokens").over(Window.partitionBy())  # over one row per target
    report = report.select(
        "source", "target_share", "max_repeats", "held_docs", "held_tokens", F.col("wish").alias("target_tokens"), "tokens", "documents", "most_copies",
        F.round(F.try_divide(F.col("tokens").cast("double"), F.lit(float(total))), 6).alias("share_of_total"),
        F.round(F.try_divide(F.col("tokens").cast("double"), all_used.cast("double")), 6).alias("share_of_mixture"),
        (F.col("budget") < F.col("wish")).alias("capped"),
    )
    return mixture, report
