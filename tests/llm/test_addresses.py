import itertools
import random

import pytest
from pyspark.sql import functions as F

from kinlattice.llm import addresses, postal

SCHEMA = "id string, who string, address_line1 string, city string, state string, zip string, num string, street string, form string"


def located(spark, lines):
    rows = [(f"{i:02d}", f"w{i}" if who is None else who, a, c, s, z, "clash", "clash", "clash") for i, (who, a, c, s, z) in enumerate(lines)]
    df = addresses.locate(spark.createDataFrame(rows, SCHEMA), F.col("who"))
    return {r["id"]: r["location"] for r in df.collect()}


@pytest.mark.parametrize("line, want", [
    ("SUITE 248, 87 HIDDEN BASIN STREET, GARLEYVILLE, MO 08019", ("87", "hiddenbasin", "garleyville", "08019", "mo", "", "st", "ste248")),
    ("c/o Front Desk, 41 tall hammer bld d", ("41", "tallhammer", "", "", "", "", "", "bldgd")),
    ("8 Fallen Raven Ln, 4th Fl, Ingen Hill, NV 64639", ("8", "fallenraven", "ingenhill", "64639", "nv", "", "ln", "fl4")),
    ("793 NORTH EIGHTH STREET", ("793", "8", "", "", "", "n", "st", "")),
    ("1420 Hidden Heron Rd. N # 10", ("1420", "hiddenheron", "", "", "", "n", "rd", "ste10")),
    ("64 NORTH BITTER QUARRY DRIVE MORAWELL KS 22994", ("64", "bitterquarry", "morawell", "22994", "ks", "n", "dr", "")),
    ("SUITE G 7 MISTY HAMMER STREET", ("7", "mistyhammer", "", "", "", "", "st", "steg")),
    ("", ("", "", "", "", "", "", "", "")),
    (None, ("", "", "", "", "", "", "", "")),
    ("x" * 100_000, ("", "", "", "", "", "", "", "")),
])
def test_first_reading(line, want):
    got = postal.readings(line, None, None, None)
    assert (got[0] if got else ("",) * 8) == postal.Form(*want)


@pytest.mark.parametrize("line, also", [
    ("22 Northshore Dr", ("shore", "n", "dr", "")), ("10 Park Place", ("parkplace", "", "", "")), ("7 Elm St 5", ("elmst5", "", "", "")),
])
def test_other_readings(line, also):
    street, pre, kind, unit = also
    assert postal.Form(line.split()[0], street, "", "", "", pre, kind, unit) in postal.readings(line, None, None, None)[1:]


def test_same_premises(spark):
    t = ("Gara City", "AL", "98088")
    lines = [
        (None, "2594 E Narrow Jasmine Rd Bldg F", *t), (None, "BUILDING F, 2594 EAST NARROWJASMINE ROAD", *t), (None, "2594 E Narrow Jasmnie Rd, Bldg F", "Gara Ctiy", "AL", None),
        (None, "2594 E Narrow Jasmine Rd., Bldg. F, Gara City, AL 98088-1234", None, None, None), (None, "2594 E Narrow Jasmine Bldg F", *t),
        (None, "2594 E Narrow Jasmine Dr Bldg F", *t), (None, "2549 E Narrow Jasmine Rd Bldg F", *t), (None, "2594 W Narrow Jasmine Rd Bldg F", *t), (None, "2594 E Narrow Jasmine Rd Bldg G", *t),
        (None, "2594 E Narrow Jasmine Rd Bldg F", "Oskvermoor", "KS", "59248"), (None, None, *t), (None, "no number", *t), (None, " ", *t),
    ]
    got = located(spark, lines)
    assert len({got[i] for i in ("00", "01", "02", "03")}) == 1
    assert len({got[i] for i in ("00", "05", "06", "07", "08", "09")}) == 6
    assert got["04"] not in (got["00"], got["05"])  # its type is missing and two fit
    assert not {"10", "11", "12"} & set(got)


def test_links_do_not_depend_on_other_spellings(spark):
    two = [(None, "100 Elm St", "Springford", "AZ", None), (None, "100 Elm St", "Springfrod", "AZ", None)]
    more = [(None, "100 Elm St", "Quillanton", "AZ", "85999")] * 3
    for lines in (two, two + more):
        got = located(spark, lines)
        assert got["00"] == got["01"] and len(set(got.values())) == len({x[2] for x in lines}) - 1


def test_readings_settle_by_support(spark):
    t = ("Oskvermoor", "AZ", "44620")
    got = located(spark, [(None, "22 Northshore Dr", *t), (None, "22 N Shore Dr", *t), (None, "22 North Shore Drive", *t), (None, "9 Park Place", *t), (None, "9 Park Place Rd", *t), (None, "9 Park Place Road Ste 4", *t)])
    assert got["00"] == got["01"] == got["02"] and got["03"] == got["04"]


def near(x, y):
    """Exact comparison of two readings: what two spellings of one street number may differ in."""

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, p in enumerate(a, 1):
            row, last = [i], row
            for j, q in enumerate(b, 1):
                row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (p != q)))
        return row[-1]

    streets = x.street == y.street if x.street[0].isdigit() or y.street[0].isdigit() else edits(x.street, y.street) <= 1
    same_zip = x.zip5 and x.zip5 == y.zip5 and (not x.town or not y.town or edits(x.town, y.town) <= 1)
    return x.num == y.num and streets and (same_zip or (x.town == y.town != "" and x.st == y.st))


@pytest.mark.parametrize("n", [100, 400, 1600])
def test_recall_against_exact_comparison(spark, n):
    """Every pair that the exact comparison finds is found, whatever the size."""
    rnd = random.Random(n)
    slip = lambda w: w if rnd.random() < 0.7 else (lambda i: w[:i] + w[i + 1 :])(rnd.randrange(1, len(w) - 1))
    names, towns = ["Hollow", "Lantern", "Meadowlark", "Saddle", "8th", "18th"], [("Springford", "AZ", "85001"), ("Quillanton", "AZ", "85002"), ("Oskvermoor", "KS", "59248")]
    lines = []
    for _ in range(n):
        name, (town, st, z) = rnd.choice(names), rnd.choice(towns)
        name = name if name[0].isdigit() else slip(name)
        zip_, town_ = rnd.choice([(z, slip(town)), (None, town), (z, None), (z, town)])
        lines.append((None, f"{rnd.randrange(1, 3 + n // 50)} {name} St", town_, st, zip_))
    got = located(spark, lines)
    forms = [postal.readings(*x[1:])[0] for x in lines]
    of = {}
    for i, f in enumerate(forms):
        of.setdefault(f.num, []).append(i)
    for group in of.values():
        assert all(got[f"{i:02d}"] == got[f"{j:02d}"] for i in group for j in group if i < j and near(forms[i], forms[j]))


def test_missing_part_joins_the_only_fit(spark):
    t = ("Oskvermoor", "AZ", "44620")
    got = located(spark, [(None, "10 N Elm Street Ste 5", *t), (None, "10 Elm", *t), (None, "10 N Elm St Ste 5", *t), ("a", "12 Oak St", *t), ("b", "12 Oak Street", *t), ("c", "12 N Oak St", *t)])
    assert got["00"] == got["01"] == got["02"]
    assert got["03"] == got["04"] != got["05"]  # written twice without a direction, by others: a place of its own


def test_copies_count_once_and_pairs(spark):
    t = ("Oskvermoor", "AZ", "44620")
    rows = [(f"{i}", "w", "12 Oak St", *t, "", "", "") for i in range(6)]
    df = addresses.locate(spark.createDataFrame(rows, SCHEMA), F.col("who"))
    assert {(r["a"], r["b"]) for r in addresses.location_pairs(df).collect()} == set(itertools.combinations("012345", 2))
    assert {(r["location_id"], r["n_rows"]) for r in addresses.premises(df).collect()} == {("0", 6)}
    assert addresses.locate(spark.createDataFrame([], SCHEMA), F.col("who")).count() == 0
