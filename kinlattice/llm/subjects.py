"""Subject areas of each document (problem 9).

Documents are embedded by term weighting and truncated singular value decomposition;
sentences are placed in that space, compared by cosine with one centroid per subject,
and centroids that start from hand-labelled documents are refined over all of them.
Terms, weights and decomposition are computed over all documents; every language has
its own part of the space.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinlattice.llm.texts import flat_words, hashed, plain, slices, without_markup
from kinlattice.runtime import adaptive, drop_stage, stage

if TYPE_CHECKING:
    import pandas as pd
    import pyarrow as pa

#: Language codes that say nothing.
NO_LANGUAGE = ("", "und", "mul", "zxx", "mis")
#: Languages, the most frequent codes, and the terms by which they are told apart: the most
#: widespread ones of each. Documents of other codes are told to be in the likeliest of these.
LANGUAGES, LANGUAGE_TERMS = 32, 1000
#: Columns of a language's space: one for each of its most widespread terms that are in at
#: least MIN_DF documents; all other terms share the hashed columns, so that none is left out.
TERMS, MIN_DF, SHARED = 4096, 5, 1024
DIMENSIONS, POWER_ROUNDS, REFINEMENTS, BINS = 64, 2, 2, 200
#: Words of a document that are worked on at once; a longer one is taken in parts of whole sentences.
PART_WORDS = 20_000
#: Entries and documents of the matrices that a worker holds at once, and slots in which sums of tasks are added up.
BLOCK, BLOCK_DOCS, SLOTS = 200_000, 2000, 8

#: Tags that end a paragraph, ends of sentences, and what parts words.
BLOCKS = r"(?i)</?(?:p|br|li|div|h[1-6]|tr|td)\b[^<>]*>"
SENTENCE_END = r'[.!?]+["”“»)]*(?:\s|$)|\n\s*[-*•]\s|\n\s*\n'
GAP = r"[^\p{L}]+"


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as hashes of their words of three letters and more, with the words of each sentence counted."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for b in slices(batches, "_text"):
        t = pc.replace_substring_regex(plain(without_markup(b.column("_text"), BLOCKS)), SENTENCE_END, "\x00")
        parts = pc.split_pattern(t, "\x00")
        flat, of = flat_words(pc.list_flatten(parts), GAP, 3)
        doc_of = pc.list_parent_indices(parts).to_numpy()
        n = np.bincount(of, minlength=len(doc_of))
        doc_of, n = doc_of[n > 0], n[n > 0]
        if not len(n):
            continue
        upto = np.cumsum(n)
        first = np.flatnonzero(np.r_[True, doc_of[1:] != doc_of[:-1]])
        inside = upto - n - np.repeat((upto - n)[first], np.diff(np.r_[first, len(n)]))
        part = inside // PART_WORDS
        start = np.flatnonzero(np.r_[True, (doc_of[1:] != doc_of[:-1]) | (part[1:] != part[:-1])])
        at_sentence, at_word = np.r_[start, len(n)], np.r_[0, upto][np.r_[start, len(n)]]
        words = pa.ListArray.from_arrays(pa.array(at_word, pa.int32()), pa.array(hashed(flat).view(np.int64)))
        lens = pa.ListArray.from_arrays(pa.array(at_sentence, pa.int32()), pa.array(n.astype(np.int32)))
        rows = pa.array(doc_of[start])
        yield pa.RecordBatch.from_arrays([b.column("doc_id").take(rows), b.column("label").take(rows), words, lens], ["doc_id", "label", "words", "lens"])


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each, without a Python object per value."""
    import pyarrow.compute as pc

    return pc.list_flatten(column).to_numpy(zero_copy_only=False), pc.list_parent_indices(column).to_numpy()


class Languages:
    """Tells languages by the shares of documents that have their most widespread terms."""

    def __init__(self, names: list[str], counts: dict[str, dict[int, int]], sizes: dict[str, int]):
        self.names = names
        self.terms = np.array(sorted({t for c in counts.values() for t in c}), np.int64)
        rates = np.array([[(counts[k].get(int(t), 0) + 0.5) / (sizes[k] + 1) for k in names] for t in self.terms]).reshape(len(self.terms), len(names))
        self.log = np.log(rates)
        self.most = max(range(len(names)), key=lambda i: sizes[names[i]])

    def tell(self, words: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """Number of each row's language; that of most documents where nothing tells."""
        if len(self.names) == 1 or not len(self.terms):
            return np.full(n, self.most)
        near = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        known = self.terms[near] == words
        score = np.stack([np.bincount(rows[known], self.log[near[known], i], n) for i in range(len(self.names))], 1)
        return np.where((score == score[:, :1]).all(1), self.most, score.argmax(1))


def _document_counts(told: DataFrame, language: Callable[[pa.RecordBatch], list]) -> DataFrame:
    """``(lang, term, n)``: documents that have each term; those of a language altogether under the null term.

    Counted per batch first, so that what is shuffled are sums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for b in batches:
            words, rows = _lists(b.column("words"))
            lang = np.array(language(b), object)
            names, code = np.unique(lang, return_inverse=True)
            terms, at = np.unique(words, return_inverse=True)
            pairs = np.unique(rows.astype(np.int64) * max(len(terms), 1) + at)
            keys, n = np.unique(code[pairs // max(len(terms), 1)] * max(len(terms), 1) + pairs % max(len(terms), 1), return_counts=True)
            whole = np.bincount(code, minlength=len(names))
            out = [
                pa.array([*names[keys // max(len(terms), 1)], *names], pa.string()),
                pa.concat_arrays([pa.array(terms[keys % max(len(terms), 1)], pa.int64()), pa.nulls(len(names), pa.int64())]),
                pa.array(np.r_[n, whole], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(out, ["lang", "term", "n"])

    return told.mapInArrow(run, "lang string, term bigint, n bigint").groupBy("lang", "term").agg(F.sum("n").alias("n"))


def _widespread(df: DataFrame, most: int) -> DataFrame:
    """The ``most`` most widespread terms of each language, with their rank; ties by term."""
    return df.where("term is not null").withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "term"))).where(F.col("r") <= most)


class Space:
    """Columns of all languages side by side, with their weights."""

    def __init__(self, languages: Languages, sizes: dict[str, int]):
        self.languages, self.sizes = languages, sizes
        self.width = TERMS + SHARED
        self.own: list[np.ndarray] = [np.zeros(0, np.int64)] * len(languages.names)
        self.rank: list[np.ndarray] = [np.zeros(0, np.int64)] * len(languages.names)
        self.weight = np.zeros(len(languages.names) * self.width)

    def fill(self, name: str, terms: np.ndarray, n: np.ndarray, shared: dict[int, int]) -> None:
        i = self.languages.names.index(name)
        order = np.argsort(terms)
        self.own[i], self.rank[i] = terms[order], order
        size, at = self.sizes[name], i * self.width
        self.weight[at : at + len(n)] = np.log(size / n)
        for bucket, many in shared.items():
            self.weight[at + TERMS + bucket] = np.log(size / min(many, size))

    def columns(self, words: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Column of each word in the language of its document."""
        out = TERMS + (words % SHARED + SHARED) % SHARED
        for i, own in enumerate(self.own):
            mine = lang == i
            if len(own) and mine.any():
                near = np.minimum(np.searchsorted(own, words[mine]), len(own) - 1)
                out[mine] = np.where(own[near] == words[mine], self.rank[i][near], out[mine])
        return out + lang * self.width


def _encode(space: Space) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sentences as sorted distinct columns, flat, with their lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        total = len(space.weight)
        for b in batches:
            words, rows = _lists(b.column("words"))
            lang = space.languages.tell(words, rows, b.num_rows)
            lens, doc_of = _lists(b.column("lens"))
            sentence = np.repeat(np.arange(len(lens)), lens)
            column = space.columns(words, lang[rows])
            useful = space.weight[column] > 0
            key = np.unique(sentence[useful].astype(np.int64) * total + column[useful])
            per = np.bincount(key // total, minlength=len(lens)).astype(np.int32)
            at = np.r_[0, np.cumsum(np.bincount(doc_of, per, b.num_rows))]
            per_doc = np.r_[0, np.cumsum(np.bincount(doc_of, minlength=b.num_rows))]
            ids = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array((key % total).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.int32()), ids, pa.ListArray.from_arrays(pa.array(per_doc, pa.int32()), pa.array(per))], ["doc_id", "lang", "ids", "lens"])

    return run


class _Block:
    """Some documents: flat columns and where sentences and documents start."""

    def __init__(self, b: pa.RecordBatch, weight: np.ndarray):
        self.docs, self.lang = b.column("doc_id").to_numpy(zero_copy_only=False), b.column("lang").to_numpy(zero_copy_only=False)
        self.labels = b.column("labels").to_pylist() if "labels" in b.schema.names else None
        self.flat, self.doc_of = _lists(b.column("ids"))
        self.lens, self.sent_doc = _lists(b.column("lens"))
        self.sent_of = np.repeat(np.arange(len(self.lens)), self.lens)
        w = weight[self.flat] ** 2
        self.doc_norm = (np.sqrt(np.bincount(self.doc_of, w, len(self.docs))) + 1e-12).astype(np.float32)
        self.sent_norm = (np.sqrt(np.bincount(self.sent_of, w, len(self.lens))) + 1e-12).astype(np.float32)

    def documents(self, weighted: np.ndarray) -> np.ndarray:
        """Rows of the weighted document-term matrix, of unit length, times a matrix whose rows are weighted."""
        return _gathered(weighted, self.flat, self.doc_of, len(self.docs)) / self.doc_norm[:, None]

    def back(self, s: np.ndarray, width: int, languages: int) -> np.ndarray:
        """The transposed matrix, not yet weighted, times ``s``: a dense product for each language's documents."""
        s = s / self.doc_norm[:, None]
        out = np.zeros((width * languages, s.shape[1]), np.float32)
        cell, n = np.unique(self.doc_of.astype(np.int64) * width + self.flat % width, return_counts=True)
        for i in np.unique(self.lang):
            own = self.lang == i
            mine = own[cell // width]
            dense = np.zeros((int(own.sum()), width), np.float32)
            dense[(np.cumsum(own) - 1)[cell[mine] // width], cell[mine] % width] = n[mine]
            out[i * width : (i + 1) * width] = dense.T @ s[own]
        return out

    def sentences(self, weighted: np.ndarray) -> np.ndarray:
        return _gathered(weighted, self.flat, self.sent_of, len(self.lens)) / self.sent_norm[:, None]


def _gathered(m: np.ndarray, index: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """For each owner the sum of the rows of ``m`` at its indexes; owners are in order.

    The first index of every owner, then the second of those that have one, and so on:
    few large steps instead of one small sum per owner.
    """
    count = np.bincount(owner, minlength=n)
    order = np.argsort(-count, kind="stable")
    start, count = (np.cumsum(count) - count)[order], count[order]
    out = np.zeros((n, m.shape[1]), m.dtype)
    for k in range(int(count[0]) if n else 0):
        longer = int(np.searchsorted(-count, -k))
        out[:longer] += m[index[start[:longer] + k]]
    back = np.empty_like(out)
    back[order] = out
    return back


def _blocks(batches: Iterator[pa.RecordBatch], weight: np.ndarray) -> Iterator[_Block]:
    import pyarrow.compute as pc

    for b in batches:
        size = np.cumsum(pc.list_value_length(b.column("ids")).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            end = min(at + BLOCK_DOCS, max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BLOCK, side="right"))))
            yield _Block(b.slice(at, end - at), weight)
            at = end


def _total(df: DataFrame, run: Callable) -> dict[str, np.ndarray]:
    """Sums over all documents of what ``run`` returns per task, as arrays by name.

    A task sends one array per name, whose size the model gives; tasks are added up in
    a few slots before the driver adds the slots.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        sums: dict[str, np.ndarray] = {}
        for name, x in run(batches):
            sums[name] = sums[name] + x if name in sums else np.array(x, np.float64)
        for name, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([list(x.shape)], pa.list_(pa.int32())), pa.array([x.tobytes()], pa.binary())], ["name", "shape", "data"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        import pandas as pd

        total = sum(np.frombuffer(d, np.float64) for d in pdf["data"])
        return pd.DataFrame({"name": pdf["name"][:1], "shape": pdf["shape"][:1], "data": [total.tobytes()]})

    schema = "name string, shape array<int>, data binary"
    slots = df.mapInArrow(parts, schema).withColumn("slot", F.spark_partition_id() % SLOTS).groupBy("name", "slot").applyInPandas(add, schema)
    out: dict[str, np.ndarray] = {}
    for r in slots.toLocalIterator():
        x = np.frombuffer(bytes(r["data"]), np.float64).reshape(r["shape"])
        out[r["name"]] = out[r["name"]] + x if r["name"] in out else x
    return out


def _decompose(coded: DataFrame, space: Space, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading right singular vectors of each language's document-term matrix, by a randomised
    range finder, and the mean of each language's sentences in them."""
    weight, width = space.weight, space.width
    parts = [slice(i * width, (i + 1) * width) for i in range(len(space.languages.names))]

    def gram(m: np.ndarray, mean: bool = False) -> dict[str, np.ndarray]:
        weighted = (m * weight[:, None]).astype(np.float32)

        def run(batches):
            for b in _blocks(batches, weight):
                yield "y", b.back(b.documents(weighted), width, len(parts))
                if mean:
                    yield "sentences", np.bincount(b.flat, (1 / b.sent_norm)[b.sent_of], len(weight)) * weight
                    yield "n", np.bincount(b.lang[b.sent_doc], minlength=len(parts))

        got = _total(coded, run)
        return {"y": got.get("y", np.zeros_like(m)) * weight[:, None], **{k: got.get(k, np.zeros(size)) for k, size in (("sentences", len(weight)), ("n", len(parts)))}}

    rng = np.random.default_rng(seed)
    q = np.zeros((len(weight), DIMENSIONS))
    for p in parts:
        used = weight[p] > 0
        q[p][used] = rng.standard_normal((int(used.sum()), DIMENSIONS))
    mean = np.zeros((len(parts), DIMENSIONS))
    for i in range(POWER_ROUNDS):
        got = gram(q, mean=i == 0)
        if i == 0:
            sums, n = got["sentences"], got["n"]
        for p in parts:
            q[p] = np.linalg.qr(got["y"][p])[0]
    z = gram(q)["y"]
    out = np.zeros_like(q)
    for p in parts:
        t = q[p].T @ z[p]
        values, u = np.linalg.eigh((t + t.T) / 2)
        out[p] = q[p] @ u[:, np.argsort(-values)]
    for i, p in enumerate(parts):
        mean[i] = sums[p] @ out[p] / max(n[i], 1)
    return out, mean


def _cut(histogram: np.ndarray) -> float:
    """Otsu's threshold: parts the best cosines of on-subject sentences from those of all others."""
    p = histogram / max(histogram.sum(), 1)
    mid = (np.arange(BINS) + 0.5) * 2 / BINS - 1
    w, m = np.cumsum(p), np.cumsum(p * mid)
    return float(mid[np.argmax((m[-1] * w - m) ** 2 / (w * (1 - w) + 1e-12))])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / (np.linalg.norm(x, axis=-1, keepdims=True) + 1e-12)


def subject_sentences(docs: DataFrame, seeds: DataFrame, areas: DataFrame, doc: str = "doc_id", text: str = "text", lang: str | None = "lang", seed: int = 7) -> DataFrame:
    """``(doc_id, subject, n_sentences, cosine)``: sentences of a document on a subject.

    ``seeds``: doc_id and subject by hand, in any case, some of them wrong; ``areas``:
    the subjects there are; ``lang`` names a column of language codes (null or wrong in
    places; None for one language), of which the most frequent LANGUAGES are learned and
    told anew for every document. Centroids begin at the mean of a subject's labelled documents, first
    learn from the sentences of labelled documents that agree with a label, then from
    all sentences nearest to them, and end as they are after REFINEMENTS rounds over all
    documents. A sentence is on its nearest subject if their cosine passes a threshold
    found anew each round in the distribution of all best cosines. Null, empty and stub
    texts give no rows; a language without labelled documents gives none.
    """
    spark = adaptive(docs.sparkSession)
    result = "doc_id bigint, subject string, n_sentences int, cosine double"
    code = F.lower(F.trim(F.regexp_extract(F.col(lang).cast("string"), r"^\s*([A-Za-z]*)", 1))) if lang else F.lit("")
    raw = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.when(~code.isin(*NO_LANGUAGE), code).otherwise("").alias("label"), F.col(text).alias("_text")).where("_text is not null")
    told = stage(raw.mapInArrow(_split, "doc_id bigint, label string, words array<bigint>, lens array<int>"), "told")

    by_label = stage(_document_counts(told, lambda b: b.column("label").to_pylist()).where("lang != ''"), "by_label")
    sizes = {r["lang"]: r["n"] for r in by_label.where("term is null").orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    counts: dict[str, dict[int, int]] = {k: {} for k in sizes}
    for r in _widespread(by_label.where(F.col("lang").isin(*sizes)), LANGUAGE_TERMS).collect():  # LANGUAGE_TERMS a language
        counts[r["lang"]][r["term"]] = r["n"]
    drop_stage(by_label)
    languages = Languages(sorted(sizes) or [""], counts or {"": {}}, sizes or {"": 1})

    def name_each(b: pa.RecordBatch) -> list:
        return [languages.names[i] for i in languages.tell(*_lists(b.column("words")), b.num_rows)]

    df = stage(_document_counts(told, name_each), "df")
    sizes = {r["lang"]: r["n"] for r in df.where("term is null").collect()}
    space = Space(languages, sizes)
    top = _widespread(df.where(F.col("n") >= MIN_DF), TERMS).select("lang", "term", "n", "r")
    own = top.collect()  # TERMS a language
    kept = spark.createDataFrame([(r["lang"], r["term"]) for r in own], "lang string, term bigint")
    rest = df.where("term is not null").join(F.broadcast(kept), ["lang", "term"], "left_anti").groupBy("lang", F.pmod("term", F.lit(SHARED)).alias("bucket")).agg(F.sum("n").alias("n"))
    shared: dict[str, dict[int, int]] = {}
    for r in rest.collect():  # SHARED a language
        shared.setdefault(r["lang"], {})[r["bucket"]] = r["n"]
    for name in sizes:
        rows = sorted((r for r in own if r["lang"] == name), key=lambda r: r["r"])
        space.fill(name, np.array([r["term"] for r in rows], np.int64), np.array([r["n"] for r in rows], float), shared.get(name, {}))
    drop_stage(df)
    names = sorted({r[0] for r in areas.select(F.lower(F.trim("subject"))).where("subject is not null").distinct().collect()})
    if not sizes or not names:
        return spark.createDataFrame([], result)
    coded = stage(told.mapInArrow(_encode(space), "doc_id bigint, lang int, ids array<int>, lens array<int>"), "coded")
    drop_stage(told)
    weight, n, many = space.weight, len(names), len(languages.names)
    v, mean = _decompose(coded, space, seed)
    weighted, mean = (v * weight[:, None]).astype(np.float32), mean.astype(np.float32)

    labels = seeds.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lower(F.trim("subject")).alias("s")).where(F.col("s").isin(*names)).groupBy("doc_id").agg(F.collect_set("s").alias("labels"))
    labelled = stage(coded.join(labels, "doc_id"), "labelled")
    at = {s: j for j, s in enumerate(names)}

    def flags(some: list) -> np.ndarray:
        y = np.zeros((len(some), n), bool)
        for i, ls in enumerate(some):
            y[i, [at[s] for s in ls]] = True
        return y

    def placed(b: _Block) -> np.ndarray:
        return b.sentences(weighted) - mean[b.lang[b.sent_doc]]

    def first(batches):
        for b in _blocks(batches, weight):
            d = _gathered(placed(b), np.arange(len(b.lens)), b.sent_doc, len(b.docs))
            y = flags(b.labels).astype(np.float32)
            seen = np.zeros((many, n + 1, d.shape[1] + 1))
            for i in range(many):
                own = b.lang == i
                seen[i, :n] = np.c_[y[own].T @ d[own], y[own].sum(0)]
                seen[i, n] = np.r_[d[own].sum(0), own.sum()]
            yield "seed", seen

    got = _total(labelled, first).get("seed")
    if got is None:
        return spark.createDataFrame([], result)
    per = got[:, :, :-1] / np.maximum(got[:, :, -1:], 1)
    centroid = np.where(got[:, :n, -1:] > 0, _unit(per[:, :n] - per[:, n:]), 0)

    def scored(b: _Block, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        e = _unit(placed(b))
        of = b.lang[b.sent_doc]
        cos = np.full((len(e), n), -1.0, np.float32)
        for i in range(many):
            own = of == i
            cos[own] = np.where(np.abs(c[i]).sum(1) > 0, e[own] @ c[i].T.astype(np.float32), -1.0)
        return e, cos.argmax(1), cos.max(1)

    def round_over(df: DataFrame, c: np.ndarray, cut: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """New centroids (the old ones without ``cut``) and thresholds."""

        def run(batches):
            for b in _blocks(batches, weight):
                e, best, cos = scored(b, c)
                of = b.lang[b.sent_doc]
                bin_ = np.minimum(((np.clip(cos, -1, 1) + 1) / 2 * BINS).astype(int), BINS - 1)
                yield "histogram", np.bincount(of * BINS + bin_, minlength=many * BINS).reshape(many, BINS)
                if cut is not None:
                    use = cos > cut[of]
                    if b.labels is not None:
                        use &= flags(b.labels)[b.sent_doc, best]
                    key = (of * n + best)[use]
                    new = np.stack([np.bincount(key, x, many * n) for x in np.c_[e, np.ones(len(e), np.float32)][use].T], 1)
                    yield "centroid", new.reshape(many, n, -1)

        got = _total(df, run)
        cuts = np.array([_cut(h) for h in got["histogram"]]) if "histogram" in got else np.ones(many)
        if cut is None or "centroid" not in got:
            return c, cuts
        # A subject that nothing was assigned to keeps its centroid.
        new = got["centroid"]
        return np.where(new[:, :, -1:] > 0, _unit(new[:, :, :-1]), c), cuts

    _, cut = round_over(labelled, centroid, None)
    centroid, cut = round_over(labelled, centroid, cut)
    for _ in range(REFINEMENTS):
        centroid, cut = round_over(coded, centroid, cut)
    drop_stage(labelled)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for b in _blocks(batches, weight):
            _, best, cos = scored(b, centroid)
            on = cos > cut[b.lang[b.sent_doc]]
            key = b.sent_doc[on] * n + best[on]
            count, total = np.bincount(key, minlength=len(b.docs) * n), np.bincount(key, cos[on], len(b.docs) * n)
            hit = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.docs[hit // n], pa.int64()), pa.array([names[j] for j in hit % n], pa.string()), pa.array(count[hit], pa.int32()), pa.array(total[hit], pa.float64())],
                ["doc_id", "subject", "n_sentences", "cosine"],
            )

    each = coded.mapInArrow(assign, result).groupBy("doc_id", "subject").agg(F.sum("n_sentences").cast("int").alias("n_sentences"), F.sum("cosine").alias("cosine"))
    return each.withColumn("cosine", F.col("cosine") / F.col("n_sentences"))


def subjects(docs: DataFrame, seeds: DataFrame, areas: DataFrame, least: int = 3, **kw) -> DataFrame:
    """``(doc_id, subject, n_sentences, cosine)`` where at least ``least`` sentences are on the subject."""
    return subject_sentences(docs, seeds, areas, **kw).where(F.col("n_sentences") >= least)
