import random

from kinlattice.llm import components


def brute(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def test_random_graphs(spark):
    rnd = random.Random(1)
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    hub = [("h", f"x{i}") for i in range(50)]
    noise = [(f"n{rnd.randrange(40)}", f"n{rnd.randrange(40)}") for _ in range(30)]
    pairs = chain + hub + noise + [(b, a) for a, b in hub] + [("s", "s"), (None, "q"), ("q", None)]
    rnd.shuffle(pairs)
    df = spark.createDataFrame(pairs, "a string, b string").selectExpr("a", "b", "'clash' as v", "'clash' as group_id")
    assert {r["id"]: r["group_id"] for r in components.connected(df).collect()} == brute(pairs)


def test_empty(spark):
    assert components.connected(spark.createDataFrame([], "a string, b string")).count() == 0


def test_record_links(spark):
    rec = spark.createDataFrame([("a", " B "), ("b", None), ("c", "gone"), ("d", ""), ("e", "e")], "id string, superseded_by string")
    pairs = spark.createDataFrame([("C", "d ", " MATCH "), ("a", "e", "no_match"), ("zz", "e", "match"), (None, "e", "match"), ("d", "c", None)], "left_id string, right_id string, verdict string")
    got = {r["id"]: r["group_id"] for r in components.record_groups(rec, pairs).collect()}
    assert got == {"a": "a", "b": "a", "c": "c", "d": "c"}
