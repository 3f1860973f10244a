import os

import pytest

from kinlattice.llm import mixture

TOKENIZER = os.environ.get("TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.json"


def test_mix(spark):
    docs = [(i, s, n) for i, (s, n) in enumerate([("a", 10)] * 300 + [("b", 7)] * 10 + [("c", 5)] * 40 + [("d", 0)] + [(None, 5)] + [("x", 9)] * 5)]
    want = [("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 4), ("empty", 0.1, 2), ("n", None, None)]
    df = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long")
    mix, report = mixture.mix(df, spark.createDataFrame(want, "source string, target_share double, max_repeats int"), total_tokens=1000, range_docs=16)
    got = {}
    for r in mix.collect():
        got.setdefault(r["source"], []).append((r["n_tokens"], r["copies"]))
    assert {s: sum(n * c for n, c in x) for s, x in got.items()} == {"a": 500, "b": 210, "c": 200}
    assert max(c for _, c in got["b"]) == 3 and max(c for _, c in got["a"]) == 1
    rep = {r["source"]: r for r in report.collect()}
    assert rep["b"]["capped"] and not rep["a"]["capped"] and rep["empty"]["tokens"] == 0 and rep["n"]["tokens"] == 0
    assert rep["a"]["share_of_mixture"] == pytest.approx(500 / 910, abs=1e-6)
    # The same whatever the ranges and the order of rows.
    again, _ = mixture.mix(df.repartition(5), spark.createDataFrame(want, "source string, target_share double, max_repeats int"), total_tokens=1000, range_docs=1000)
    assert sorted(map(tuple, mix.collect())) == sorted(map(tuple, again.collect()))


def test_cut_is_the_longest_prefix(spark):
    df = spark.createDataFrame([(i, "a", 1 + i % 9) for i in range(500)], "doc_id long, source string, n_tokens long")
    mix, report = mixture.mix(df, spark.createDataFrame([("a", 0.6, 1)], "source string, target_share double, max_repeats int"), range_docs=20)
    r = report.first()
    assert r["target_tokens"] - 9 < r["tokens"] <= r["target_tokens"]
    empty, rep = mixture.mix(df.limit(0), spark.createDataFrame([("a", 0.6, 1)], "source string, target_share double, max_repeats int"))
    assert empty.count() == 0 and rep.first()["tokens"] == 0


@pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer files")
def test_tokens(spark):
    df = spark.createDataFrame([(1, "Hello there", 5), (2, "", 5), (3, None, 5), (4, "word " * 20_000, 5)], "doc_id long, text string, n_tokens int")
    got = {r["doc_id"]: r["n_tokens"] for r in mixture.count_tokens(df, TOKENIZER).collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] >= 20_000
