import random

from kinlattice.llm import subjects

THEMES = {"sport": "goal league trophy coach whistle referee sprint match stadium jersey".split(), "law": "statute court appeal judge verdict injunction plaintiff clause decree subpoena".split(), "food": "soup bread oven recipe butter garlic pasta kitchen chef dough".split()}


def corpus():
    rnd = random.Random(4)
    filler = [f"filler{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)]
    docs, truth = [], {}
    for d in range(400):
        n = {t: rnd.choice([0, 0, 1, 4]) for t in THEMES}
        sents = [f"The {rnd.choice(w)} and the {rnd.choice(w)} of {rnd.choice(filler)} was {rnd.choice(w)}." for t, w in THEMES.items() for _ in range(n[t])]
        sents += [f"The {rnd.choice(filler)} was {rnd.choice(filler)} for the {rnd.choice(filler)}." for _ in range(4)]
        rnd.shuffle(sents)
        docs.append((d, " ".join(sents), "", "clash"))
        truth[d] = {t for t in THEMES if n[t] >= 3}
    return docs, truth


def test_subjects(spark):
    docs, truth = corpus()
    df = spark.createDataFrame(docs + [(900, None, "", ""), (901, "", "", ""), (902, "word " * 30_000, "", "")], "doc_id long, text string, lang string, labels string")
    seeds = [(d, t.upper()) for d in range(60) for t in truth[d]] + [(5, None), (6, "nonsense"), (None, "law"), (7, "food")]
    areas = spark.createDataFrame([(t, "") for t in THEMES], "subject string, description string")
    got = {}
    for r in subjects.subjects(df, spark.createDataFrame(seeds, "doc_id long, subject string"), areas).collect():
        got.setdefault(r["doc_id"], set()).add(r["subject"])
    hits = sum(len(got.get(d, set()) & t) for d, t in truth.items())
    assert hits / sum(map(len, truth.values())) > 0.95 and hits / sum(map(len, got.values())) > 0.95
    assert not {900, 901, 902} & set(got)
    none = spark.createDataFrame([], "doc_id long, subject string")
    assert subjects.subjects(df, none, areas).count() == 0 and subjects.subjects(df.limit(0), none, areas).count() == 0


def test_languages_are_learned_from_untidy_codes(spark, monkeypatch):
    """Three languages, a tenth of the codes wrong, missing or of no language: every document gets the subjects of its own."""
    monkeypatch.setattr(subjects, "LANGUAGES", 3)
    rnd = random.Random(6)
    said = {"en": ("the", "was", "with"), "xx": ("zal", "mir", "oko"), "yy": ("teh", "pun", "wak")}
    docs, truth, seeds = [], {}, []
    for d in range(900):
        own = rnd.choice(sorted(said))
        a, b, c = said[own]
        n = {t: rnd.choice([0, 4]) for t in THEMES}
        sents = [f"{a} {rnd.choice(w)}{own} {b} {rnd.choice(w)}{own} {c} {rnd.choice(w)}{own}." for t, w in THEMES.items() for _ in range(n[t])]
        sents += [f"{a} filler{chr(97 + rnd.randrange(26))} {b} filler{chr(97 + rnd.randrange(26))} {c} other." for _ in range(4)]
        rnd.shuffle(sents)
        code = rnd.choice([None, "und", "en", "yy", f"junk{chr(97 + d % 26)}"]) if rnd.random() < 0.1 else rnd.choice([own, own.upper(), f" {own}-AB"])
        docs.append((d, " ".join(sents), code))
        truth[d] = {t for t in THEMES if n[t]}
        seeds += [(d, t) for t in truth[d] if d < 200]
    got = {}
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    for r in subjects.subjects(df, spark.createDataFrame(seeds, "doc_id long, subject string"), spark.createDataFrame([(t, "") for t in THEMES], "subject string, description string")).collect():
        got.setdefault(r["doc_id"], set()).add(r["subject"])
    hits = sum(len(got.get(d, set()) & t) for d, t in truth.items())
    assert hits / sum(map(len, truth.values())) > 0.97 and hits / sum(map(len, got.values())) > 0.97


def test_long_documents_in_parts(spark, monkeypatch):
    docs, truth = corpus()
    areas = spark.createDataFrame([(t, "") for t in THEMES], "subject string, description string")
    seeds = spark.createDataFrame([(d, t) for d in range(60) for t in truth[d]], "doc_id long, subject string")
    monkeypatch.setattr(subjects, "PART_WORDS", 25)
    monkeypatch.setattr(subjects, "BLOCK", 40)
    got = {(r["doc_id"], r["subject"]): r["n_sentences"] for r in subjects.subjects(spark.createDataFrame(docs, "doc_id long, text string, lang string, labels string"), seeds, areas).collect()}
    want = {(d, t) for d, ts in truth.items() for t in ts}
    assert len(want & set(got)) > 0.95 * max(len(want), len(got)) and max(got.values()) == 4
