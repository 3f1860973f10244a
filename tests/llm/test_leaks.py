import random

from kinlattice.llm import leaks


def texts(seed=2):
    rnd = random.Random(seed)
    vocab = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    items = {i: [rnd.choice(vocab) for _ in range(40)] for i in range(12)}
    docs, want = {}, set()
    for d in range(60):
        body, i = [rnd.choice(vocab) for _ in range(60)], rnd.randrange(12)
        part = list(items[i])
        kind = d % 6
        if kind == 0:
            docs[d] = body[:30] + part[5:30] + body[30:]
        elif kind == 1:  # altered words
            for k in range(6, 40, 7):
                part[k] = "changed"
            docs[d] = body[:10] + part + body[10:]
        elif kind == 2:  # two stretches
            docs[d] = body[:10] + part[:10] + body[10:40] + part[20:30] + body[40:]
        elif kind == 3:  # too short
            docs[d] = body[:30] + part[:8] + body[30:]
            continue
        elif kind == 4:  # another order
            rnd.shuffle(part)
            docs[d] = body[:30] + part + body[30:]
            continue
        else:
            docs[d] = body
            continue
        want.add((d, i))
        docs[d] = docs[d]
    return items, docs, want


def test_leaks(spark):
    items, docs, want = texts()
    markup = lambda d, ws: [" ".join(ws), " ".join(ws).upper(), "<p>" + ", ".join(ws) + ".</p>", "\n".join(ws), "​ ".join(ws)][d % 5]
    df = spark.createDataFrame([(d, markup(d, ws), 0, "x") for d, ws in docs.items()] + [(900, None, 0, ""), (901, "", 0, ""), (902, "ab " * 50_000, 0, "")], "doc_id long, text string, pos int, h string")
    it = spark.createDataFrame([(i, " ".join(ws), "x") for i, ws in items.items()] + [(99, None, "x"), (98, "short", "x")], "item_id long, text string, seed string")
    got = {(r["doc_id"], r["item_id"]): r["n_words"] for r in leaks.leaks(df, it).collect()}
    brute = {(d, i) for d, ws in docs.items() for i, iw in items.items() if leaks.overlap(enumerate(ws), iw) >= 16}
    assert set(got) == want == brute
    assert leaks.leaks(df.limit(0), it).count() == 0 and leaks.leaks(df, it.limit(0)).count() == 0


def test_blocks_of_items(spark, monkeypatch):
    items, docs, want = texts(5)
    monkeypatch.setattr(leaks, "BLOCK_WORDS", 100)
    df = spark.createDataFrame([(d, " ".join(ws)) for d, ws in docs.items()], "doc_id long, text string")
    it = spark.createDataFrame([(i, " ".join(ws)) for i, ws in items.items()], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in leaks.leaks(df, it).collect()} == want


def test_markup_of_any_length(spark):
    ws = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40)]
    tagged = [f'<i data-s="{"x" * 5000}">{w}</i>' if i % 3 == 0 else w for i, w in enumerate(ws)]
    named = [w + ("&CounterClockwiseContourIntegral;" if i % 4 == 0 else "&#0000000000032;") for i, w in enumerate(ws)]
    compared = "if a < b then " + " ".join(ws) + " until c > d"
    it = spark.createDataFrame([(1, " ".join(ws))], "item_id long, text string")
    df = spark.createDataFrame([(1, " ".join(tagged)), (2, " ".join(named)), (3, compared), (4, "<!-- " + " ".join(ws) + " -->")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_words"] for r in leaks.leaks(df, it).collect()} == {1: 40, 2: 40, 3: 40}


def test_two_stretches_of_many_repeats():
    item = list(range(40))
    doc = list(range(20, 30)) * 2000 + [99] * 50 + list(range(10)) + [99] * 9 + list(range(20, 30)) * 2000
    assert leaks.overlap(enumerate(doc), item) == 20


def test_accents(spark):
    a = "el sastre escondió la mochila luego el faro pesó a quillan bellquist cuando quillan olvidó la veleta"
    b = a.replace("ó", "o").replace("faro", "<b>f&aacute;ro</b>".replace("&aacute;", "a"))
    it, df = spark.createDataFrame([(1, a)], "item_id long, text string"), spark.createDataFrame([(1, b)], "doc_id long, text string")
    assert leaks.leaks(df, it).count() == 1
