"""Scalar functions by example."""

import pytest
from pyspark.sql import functions as F

from kinlattice.functions import address, arrays, dates, stats, text


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("given, want", [("Quill Harbor", "quillharbor"), ("QuillHarbor", "quillharbor"), ("VELDRA CARE OF OHIO, P.C.", "veldracareofohiopc"), (None, "")])
def test_blankless(spark, given, want):
    assert one(spark, text.blankless(F.col("a")), a=given) == want


@pytest.mark.parametrize("given, want", [("441071234", "44107"), ("44107-1234", "44107"), ("441", ""), (None, "")])
def test_zip5(spark, given, want):
    assert one(spark, address.zip5(F.col("a")), a=given) == want


@pytest.mark.parametrize("a, b, equal", [
    ("7702 W 31ST AVE, BUILDING C STE 9", "7702 w 31st Avenue, Building C, Suite 9", True),
    ("58 S. Larkspur Hollow Rd Suite 4", "58 S LARKSPUR HOLLOW RD STE 4", True),
    ("9 NE Tamarack St", "9 NE TAMARACK STREET", True),
    ("66 E 2nd Avenue #7", "66 E 2ND AVE STE 7", True),
    ("12 Juniper St Ste 1", "12 Juniper St Ste 2", False),
    ("12 Juniper St Bldg A Ste 1", "12 Juniper St Bldg B Ste 1", False),
    ("12 Juniper St", "12 Juniper Ave", False),
    ("12 N Juniper St", "12 S Juniper St", False),
])
def test_street_key(spark, a, b, equal):
    row = spark.createDataFrame([(a, b)], "a string, b string").select(address.street_key(F.col("a")).alias("x"), address.street_key(F.col("b")).alias("y")).first()
    assert (row["x"] == row["y"]) is equal


def test_street_key_of_nothing(spark):
    assert one(spark, address.street_key(F.col("a")), a=None) == "" and one(spark, address.street_key(F.col("a")), a="   ") == ""


def test_building(spark):
    assert one(spark, address.building_key(address.street_key(F.col("a"))), a="100 Western Ave Ste 4") == "100we"
    assert one(spark, address.building_of(F.col("a")), a="100 Western Ave Ste 4") == "100westernav"
    assert one(spark, address.building_of(F.col("a")), a="100 Western Ave") == "100westernav"


@pytest.mark.parametrize("given, want", [
    ("14 W Tamarack Blvd., Larkspur, AZ 85001", ("14 W Tamarack Blvd.", "Larkspur", "AZ", "85001")),
    ("77 N Ring Road 9, Suite 5 San Quillan, TX 78001", ("77 N Ring Road 9, Suite 5", "San Quillan", "TX", "78001")),
    ("3 Heron Street, San Veldra, CA 94001, USA", ("3 Heron Street", "San Veldra", "CA", "94001")),
    ("3 Heron Street, Veldra, New Mexico 87001-1234, United States of America", ("3 Heron Street", "Veldra", "NM", "87001")),
    ("<b>8 Heron St</b> Ste B Veldra Park NM 87001", ("8 Heron St Ste B", "Veldra Park", "NM", "87001")),
    ("3 Heron Street, Somewhere", None),
    ("Heron Street, Somewhere, CA 94001", None),
    ("12, Veldra, CA 94001", None),
    ("3 Heron Street, Veldra, ZZ 94001", None),
    ("", None),
    (None, None),
])
def test_us_address(spark, given, want):
    got = one(spark, address.parse_us_address(F.col("a")), a=given)
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize("given, city, state, want", [
    ("8 Airfield Park Road Suite 10 Glen Veldra, MD 21001", "Glen Veldra", "MD", ("8 Airfield Park Road Suite 10", "Glen Veldra", "MD", "21001")),
    ("31 Tamarack Avenue St. Quillan Shores, MI 48001", "St. Quillan Shores", "MI", ("31 Tamarack Avenue", "St. Quillan Shores", "MI", "48001")),
    ("42 Heron Road Suite 1 Larkspur Township  MI 48002", "Larkspur Township", "MI", ("42 Heron Road Suite 1", "Larkspur Township", "MI", "48002")),
    ("1 Heron St Elsewhere, TX 70000", "Veldra", "MI", None),
    (None, "Veldra", "MI", None),
])
def test_known_locality(spark, given, city, state, want):
    got = one(spark, address.parse_known_locality(F.col("a"), F.col("b"), F.col("c")), a=given, b=city, c=state)
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize("given, want", [
    ("9 Heron St, Larkspur, IL 60001", ("9 Heron St", "Larkspur", "IL", "60001")),
    ("9 Heron St Suite 4, Oak Larkspur, IL 60001-1234", ("9 Heron St Suite 4", "Oak Larkspur", "IL", "60001-1234")),
    ("Remote", ("Remote", None, None, None)),
    (None, (None, None, None, None)),
])
def test_practitioner_address(spark, given, want):
    assert tuple(one(spark, address.split_practitioner_address(F.col("a")), a=given)) == want


def test_titles_pages_and_listed_streets(spark):
    assert tuple(one(spark, address.place_in_title(F.col("a")), a="Therapy in Oak Larkspur, il | Veldra")) == ("Oak Larkspur", "IL")
    assert one(spark, address.place_in_title(F.col("a")), a="About us") is None and one(spark, address.place_in_title(F.col("a")), a=None) is None
    got = one(spark, address.parse_with_page_city(F.col("a"), F.col("b")), a="9 Heron St Oak Larkspur, IL 60001", b="https://x.example/places/oak-larkspur-il/")
    assert tuple(got) == ("9 Heron St", "Oak Larkspur", "IL", "60001")
    assert one(spark, address.listed_street(F.col("a")), a="9 Heron St, Ste 2, Larkspur, Illinois") == "9 Heron St, Ste 2"
    assert one(spark, address.listed_street(F.col("a")), a="9 Heron St, Larkspur, IL 60001") == "9 Heron St"
    assert one(spark, address.is_street(F.col("a")), a=None) is False


def test_span_address(spark):
    page = '<p class="address"><span class="address-line1">29 Heron Blvd. NW</span><span class="address-line2">Suite 1</span><span class="locality">Veldra</span> <span class="administrative-area">NM</span><span class="postal-code">87001</span></p>'
    assert tuple(one(spark, address.span_address(F.col("a")), a=page)) == ("29 Heron Blvd. NW Suite 1", "Veldra", "NM", "87001")
    assert one(spark, address.span_address(F.col("a")), a="<p>no</p>") is None


def test_marks_and_classes(spark):
    assert one(spark, text.redacted(F.col("a")), a="postgresql://me:secret@db.example:5432/x") == "postgresql://me:***@db.example:5432/x"
    assert one(spark, text.assertion(F.lit("clinic_to_owner"), site=F.col("a"), owner=F.lit("O"), parent=F.lit("P")), a=" ") == "? -> O"
    assert one(spark, text.only_about(F.col("a"), "diagnosis", ["therapy"]), a="Diagnosis only") and not one(spark, text.only_about(F.col("a"), "diagnosis", ["therapy"]), a="Diagnosis and THERAPY")
    assert one(spark, text.announced_only(F.col("a")), a="Veldra (coming soon)") and not one(spark, text.announced_only(F.col("a")), a=None)
    df = spark.createDataFrame([(["https://news.example/a", "https://x.example"],), ([],)], "u array<string>")
    assert [r[0] for r in df.select(text.source_class(F.col("u"), {"filings.": "filing", "news.": "news"})).collect()] == ["news", "other"]


def test_embedded_json(spark):
    page = 'x; var markers = [{"t": "A", "z": 1}, {"t": "B"}]; more'
    assert [r["t"] for r in one(spark, arrays.embedded_json(F.col("a"), "markers", "array<struct<t string, z int>>"), a=page)] == ["A", "B"]
    assert one(spark, arrays.embedded_json(F.col("a"), "markers", "array<struct<t string>>"), a="var markers = [broken;") is None
    assert one(spark, arrays.as_json(x=F.col("a"), y=F.lit(1)), a=None) == '{"x":null,"y":1}'


@pytest.mark.parametrize("given, want", [("1/5/2020", "2020-01-05"), ("2020-01-05T00:00:00", "2020-01-05"), (" 2020-01-05 ", "2020-01-05"), ("", None), (None, None), ("Soon", "soon"), ("13/45/2020", "2020-13-45")])
def test_iso_text(spark, given, want):
    assert one(spark, dates.iso_text(F.col("a")), a=given) == want


def test_impossible_day_is_null(spark):
    assert one(spark, dates.iso_date(F.col("a")), a="13/45/2020") is None


@pytest.mark.parametrize("k, n, low, high", [(0, 0, 0.0, 0.0), (10, 10, 0.722467, 1.0), (5, 10, 0.236593, 0.763407)])
def test_wilson(spark, k, n, low, high):
    got = spark.createDataFrame([(k, n)], "k int, n int").select(stats.wilson(F.col("k"), F.col("n")).alias("x")).first()["x"]
    assert got["low"] == pytest.approx(low, abs=1e-5) and got["high"] == pytest.approx(high, abs=1e-5)


def test_cosine_of_zero_vector_is_null(spark):
    assert spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>").select(stats.cosine(F.col("a"), F.col("b"))).first()[0] is None


def test_arrays(spark):
    df = spark.createDataFrame([(["a"], "b"), (None, "b"), (["b"], "b"), (["a"], None)], "x array<string>, y string")
    assert [r[0] for r in df.select(arrays.append_absent(F.col("x"), F.col("y"))).collect()] == [["a", "b"], ["b"], ["b"], ["a"]]
    assert [r[0] for r in df.select(arrays.filled(F.col("x"))).collect()] == [True, False, True, True]


@pytest.mark.parametrize("f, given, want", [
    (lambda c: text.fragment_text(c), "<p>A &amp; B<script>x</script> &lt;c&gt;</p>", "A & B <c>"),
    (lambda c: text.without_registry_mark(c), "Acme Fund (CIK 0001234567)", "Acme Fund"),
    (lambda c: text.absolute_url(c, F.lit("https://x.example/a/b")), "/p/q", "https://x.example/p/q"),
    (lambda c: text.absolute_url(c, F.lit("https://x.example/a/b")), "y.example", "https://y.example"),
    (lambda c: text.slug_title(c, "-aba-therapy"), "oak-park-aba-therapy", "Oak Park"),
    (lambda c: text.chain_stem(c), "The Acme Therapy Group, LLC", "acme"),
    (lambda c: address.state_code(c), "new york", "NY"),
    (lambda c: address.expand_state(c), "1 A St, Reno, Nevada 89501", "1 A St, Reno, NV 89501"),
])
def test_text(spark, f, given, want):
    assert one(spark, f(F.col("a")), a=given) == want
