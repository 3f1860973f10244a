"""Texts as words, in Arrow batches: whole batches at a time, no limit on any text's length."""

from __future__ import annotations

import hashlib
import html
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np

if TYPE_CHECKING:
    import pyarrow as pa

#: Bytes of text handled at once, so that a worker's memory does not follow its input.
SLICE_BYTES = 8 << 20
#: Linear-time patterns: comments and tags of any length, signs inside words, combining marks.
WORD_GAP = r"[^\p{L}\p{N}]+"
COMMENT, TAG = r"(?s)<!--.*?-->", r"</?[A-Za-z][^<>]*>|<[!?][^<>]*>"
SILENT = "['’‘`´­​-‍⁠﻿]"
#: Letters that do not come apart into a plain one and a mark.
WHOLE = {"ø": "o", "æ": "ae", "œ": "oe", "ß": "ss", "ł": "l", "đ": "d"}


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about SLICE_BYTES of ``text``; a longer text is a part of its own."""
    import pyarrow.compute as pc

    for b in batches:
        size = np.cumsum(pc.binary_length(b.column(text)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            done = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, done + SLICE_BYTES, side="right")))
            yield b.slice(at, end - at)
            at = end


def without_markup(t: pa.Array, blocks: str | None = None) -> pa.Array:
    """Text without comments, tags and entities; tags that match ``blocks`` become paragraph ends."""
    import pyarrow as pa
    import pyarrow.compute as pc

    t = pc.replace_substring_regex(t, COMMENT, " ")
    if blocks:
        t = pc.replace_substring_regex(t, blocks, "\n\n")
    t = pc.replace_substring_regex(t, TAG, " ")
    coded = pc.match_substring(t, "&").fill_null(False)
    if pc.any(coded).as_py():
        t = pc.replace_with_mask(t, coded, pa.array([html.unescape(s) for s in t.filter(coded).to_pylist()], t.type))
    return t


def plain(t: pa.Array) -> pa.Array:
    """Lower case without accents and signs inside words; punctuation stays."""
    import pyarrow.compute as pc

    t = pc.utf8_normalize(pc.replace_substring_regex(t, SILENT, ""), form="NFKD")
    t = pc.utf8_lower(pc.replace_substring_regex(t, r"\p{M}+", ""))
    for letter, instead in WHOLE.items():
        t = pc.replace_substring(t, letter, instead)
    return t


def flat_words(t: pa.Array, pattern: str, least: int = 1) -> tuple[pa.Array, np.ndarray]:
    """Words between what matches ``pattern``, of ``least`` letters or more, in one array, and the row of each."""
    import pyarrow as pa
    import pyarrow.compute as pc

    parts = pc.split_pattern_regex(t, pattern)
    rows = pc.list_parent_indices(parts).to_numpy()
    flat = pc.list_flatten(parts)
    keep = pc.greater_equal(pc.utf8_length(flat), least)
    if isinstance(flat, pa.ChunkedArray):
        flat, keep = flat.combine_chunks(), keep.combine_chunks()
    return flat.filter(keep), rows[keep.to_numpy(zero_copy_only=False)]


def hashed(flat: pa.Array) -> np.ndarray:
    """A 64-bit number per word, the same on every machine."""
    coded = flat.dictionary_encode()
    each = np.fromiter((int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return each[coded.indices.to_numpy()] if len(flat) else np.zeros(0, np.uint64)


def word_hashes(t: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the row of each; case, punctuation, accents and markup aside."""
    flat, rows = flat_words(plain(without_markup(t)), WORD_GAP)
    return hashed(flat), rows
