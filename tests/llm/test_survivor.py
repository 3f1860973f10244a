import datetime as dt
import random

from kinlattice.llm import survivor

SCHEMA = "group_id string, id string, name string, city string, day date, trust double, field string, norm string"


def cast_of(df):
    return survivor.votes(df, ["name", "city"], "trust", "day", dt.date(2024, 1, 1))


def test_golden_and_representative(spark):
    d = dt.date
    df = spark.createDataFrame([
        ("g", "1", "Acme", "Rome", d(2020, 1, 1), 0.2, "x", "y"), ("g", "2", "ACME ", None, d(2024, 1, 1), 0.9, "x", "y"), ("g", "3", "Other", " ", d(2024, 1, 1), 0.8, "x", "y"),
        ("h", "4", None, None, None, None, None, None), ("t", "5", "A", "B", d(2020, 1, 1), 0.5, "", ""), ("t", "6", "A", "B", d(2020, 1, 1), 0.5, "", ""),
    ], SCHEMA)
    cast = cast_of(df)
    built = {r["group_id"]: r for r in survivor.golden(cast, ["name", "city"]).collect()}
    assert built["g"]["name"] == "ACME " and built["g"]["city"] == "Rome" and built["h"]["name"] is None and built["t"]["name"] == "A"
    rep = {r["group_id"]: r for r in survivor.representatives(cast, ["name", "city"]).collect()}
    assert rep["g"]["undisputed"] is False and rep["h"]["undisputed"] is True and rep["t"]["undisputed"] is False and rep["t"]["id"] == "6"
    assert rep["g"]["id"] == "2" and rep["g"]["n_records"] == 3
    assert survivor.golden(cast.limit(0), ["name"]).count() == 0 and survivor.representatives(cast.limit(0), ["name"]).count() == 0


def test_votes_add_up(spark):
    """Two older, less trusted records that agree outvote one that does not; decay turns it around."""
    d = dt.date
    rows = [("g", "1", "Acme", None, d(2023, 6, 1), 0.5, "", ""), ("g", "2", "acme", None, d(2023, 6, 1), 0.5, "", ""), ("g", "3", "Other", None, d(2024, 1, 1), 0.6, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    build = lambda half: survivor.golden(survivor.votes(df, ["name"], "trust", "day", d(2024, 1, 1), half), ["name"]).first()["name"]
    assert build(3650) == "Acme" and build(30) == "Other"


def test_undisputed_against_brute_force(spark):
    rnd = random.Random(5)
    data = [(f"g{rnd.randrange(40)}", str(i), rnd.choice([None, "n"]), rnd.choice(["", "c"]), rnd.choice([None, dt.date(2020, 1, 1), dt.date(2021, 1, 1)]), rnd.choice([None, 0.1, 0.9]), None, None) for i in range(120)]
    got = {r["group_id"]: r["id"] for r in survivor.representatives(cast_of(spark.createDataFrame(data, SCHEMA)), ["name", "city"]).where("undisputed").collect()}
    m = lambda r: (bool(r[2]) + bool(r[3]), r[4] or dt.date.min, -1 if r[5] is None else r[5])
    want = {}
    for a in data:
        others = [b for b in data if b[0] == a[0] and b[1] != a[1]]
        if all(all(x >= y for x, y in zip(m(a), m(b))) and m(a) != m(b) for b in others):
            want[a[0]] = a[1]
    assert got == want
