"""Evaluation texts leaking into training text (problem 7).

Spaced-seed hashing: fixed masks pick some of a few neighbouring words and ignore
the others, so that an altered word spoils only the seeds that pick it. Seeds of all
documents are joined with the seeds of the test items; around the hits, a comparison
that tolerates altered words measures what really overlaps.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlattice.llm.texts import slices, word_hashes
from kinlattice.runtime import adaptive

if TYPE_CHECKING:
    import pyarrow as pa

#: Positions that a mask picks, of the words after its start; the rest is ignored.
MASKS = ((0, 1, 2, 3), (0, 1, 3, 4), (0, 2, 3, 5), (0, 1, 4, 6))
#: Odd numbers by which the words that a mask picks are mixed.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
#: Item words per pass over the documents: what is broadcast stays under 100 MB, whatever the number of items.
BLOCK_WORDS = 500_000


def seeds(h: np.ndarray, rows: np.ndarray, usable: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(mask, starts, seeds)``: for each mask its seeds within one row, where all picked words are ``usable``."""
    for m, mask in enumerate(MASKS):
        n = max(0, len(h) - mask[-1])
        fine = rows[:n] == rows[mask[-1] : mask[-1] + n]
        if usable is not None:
            for o in mask:
                fine &= usable[o : o + n]
        at = np.flatnonzero(fine)
        seed = np.full(len(at), m, np.uint64)
        for o, k in zip(mask, MIX):
            seed = (seed ^ h[at + o]) * k
            seed ^= seed >> np.uint64(29)
        yield m, at, seed


class Planted:
    """Some test items: their words, and their seeds in order, each with the item it is of."""

    def __init__(self, ids: list[int], texts: list[str]):
        import pyarrow as pa

        self.ids = np.array(ids, np.int64)
        h, rows = word_hashes(pa.array(texts, pa.string()))
        self.words = np.split(h, np.searchsorted(rows, np.arange(1, len(ids))))
        self.vocabulary = np.unique(h)
        sown = [np.stack([seed, rows[at].astype(np.uint64)], 1) for _, at, seed in seeds(h, rows)]
        each = np.unique(np.concatenate(sown), axis=0)
        self.seed, self.item = each[:, 0].copy(), each[:, 1].astype(np.int64)

    def hits(self, h: np.ndarray, rows: np.ndarray, covered: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """``(row, item, word positions)`` where shared seeds cover at least ``covered`` words of a row."""
        if not len(self.vocabulary) or not len(h):
            return
        near = np.searchsorted(self.vocabulary, h)
        usable = self.vocabulary[np.minimum(near, len(self.vocabulary) - 1)] == h
        met = []
        for m, at, seed in seeds(h, rows, usable):
            lo, hi = np.searchsorted(self.seed, seed), np.searchsorted(self.seed, seed, side="right")
            n = hi - lo
            entry = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()) if len(n) else np.zeros(0, int)
            start = np.repeat(at, n)
            met += [np.stack([self.item[entry], start + o], 1) for o in MASKS[m]]
        pairs = np.unique(np.concatenate(met), axis=0)
        # A word belongs to one row, so (item, row) groups are runs of equal (item, row).
        key = np.stack([pairs[:, 0], rows[pairs[:, 1]]], 1)
        cut = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)]) if len(key) else np.zeros(0, int)
        for a, b in zip(cut, np.r_[cut[1:], len(key)]):
            if b - a >= covered:
                yield int(key[a, 1]), int(key[a, 0]), pairs[a:b, 1]


def overlap(doc: Iterable[tuple[int, int]], item: list[int], gap: int = 1, least: int = 5, density: float = 0.7) -> int:
    """Most words of ``item`` that a document repeats in order in one or two stretches.

    ``doc`` holds (position, word) in order. Within a stretch up to ``gap`` words may be
    altered, left out or put in between two that agree; at least ``least`` words and the
    share ``density`` of the words it spans in the item must agree.
    """
    at: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(item):
        at[w].append(i)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    runs: dict[tuple[int, int], tuple[int, int, int]] = {}
    for j, w in doc:
        for i in at.get(w, ()):
            top = (1, j, i)
            for dj in range(1, gap + 2):
                for di in range(1, gap + 2):
                    p = best.get((j - dj, i - di))
                    if p and p[0] + 1 > top[0]:
                        top = (p[0] + 1, p[1], p[2])
            best[j, i] = top
            n, j0, i0 = top
            if n >= least and n >= density * (i - i0 + 1) and n > runs.get((j0, i0), (0, 0, 0))[0]:
                runs[j0, i0] = (n, j, i)
    # Of two stretches the second begins behind the first in both texts: stretches in the
    # order of their starts meet the best one that has ended before, by item position.
    starts = sorted((j0, j, i0, i, n) for (j0, i0), (n, j, i) in runs.items())
    ends = sorted(starts, key=lambda r: r[1])
    before = np.zeros(len(item) + 1, np.int64)
    most, done = 0, 0
    for j0, _, i0, _, n in starts:
        while done < len(ends) and ends[done][1] < j0:
            i, n_ended = ends[done][3], ends[done][4]
            np.maximum(before[i + 1 :], n_ended, out=before[i + 1 :])
            done += 1
        most = max(most, n + int(before[i0]))
    return most


def _around(h: np.ndarray, rows: np.ndarray, at: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """The words within ``reach`` of hits, in order, each once, inside the row of the hits."""
    row = rows[at[0]]
    lo, hi = np.searchsorted(rows, row), np.searchsorted(rows, row, side="right")
    edge = np.zeros(hi - lo + 1, np.int64)
    np.add.at(edge, np.maximum(at - reach, lo) - lo, 1)
    np.add.at(edge, np.minimum(at + reach + 1, hi) - lo, -1)
    near = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    return list(zip(near.tolist(), h[lo:hi][near].tolist()))


def _blocks(items: Iterable[tuple[int, str]]) -> Iterator[Planted]:
    """The items in blocks of about BLOCK_WORDS words."""
    ids, texts, size = [], [], 0
    for item_id, text in items:
        ids.append(item_id)
        texts.append(text)
        size += text.count(" ") + 1
        if size >= BLOCK_WORDS:
            yield Planted(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Planted(ids, texts)


def leaks(docs: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text", least: int = 16) -> DataFrame:
    """``(doc_id, item_id, n_words)``: documents that repeat at least ``least`` words of an item.

    The words come in the item's order, in one or two stretches; single words between
    them may have been altered. Null, empty and shorter texts leak nothing, no items or
    no documents give no rows, several texts under one id count as one. Whole texts are
    read, whatever their length, in one pass without a shuffle: the items, a stated set
    of queries, go to the documents in blocks of bounded size. Seeds that meet must cover
    half of ``least`` words before the words around them are compared.
    """
    spark = adaptive(docs.sparkSession)
    given = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("_text")).where("_text is not null")
    schema = "doc_id bigint, item_id bigint, n_words int"
    held = items.select(F.col(item).cast("bigint").alias("i"), F.col(text).alias("t")).where("i is not null and t is not null").distinct()
    found = spark.createDataFrame([], schema)
    for planted in _blocks((r["i"], r["t"]) for r in held.toLocalIterator()):
        block = spark.sparkContext.broadcast(planted)

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            import pyarrow as pa

            p = block.value
            for b in slices(batches, "_text"):
                h, rows = word_hashes(b.column("_text"))
                ids = b.column("doc_id").to_numpy(zero_copy_only=False)
                out = [(ids[row], p.ids[i], overlap(_around(h, rows, at, len(p.words[i])), p.words[i].tolist())) for row, i, at in p.hits(h, rows, least // 2)]
                got = [r for r in out if r[2] >= least]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in got], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32()))], ["doc_id", "item_id", "n_words"])

        found = found.unionByName(given.mapInArrow(run, schema))
    return found.groupBy("doc_id", "item_id").agg(F.max("n_words").alias("n_words"))
