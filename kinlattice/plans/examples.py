"""Parsers and scalar rules applied to small stated relations; the SQL twins state what must come out."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlattice.functions import address, arrays, dates, text
from kinlattice.operators import claims
from kinlattice.sources import documents, files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _literal(v: object) -> str:
    return "null" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v)


def expect(columns: str, *rows: tuple) -> Callable[[Query], Query]:
    """Registers a query with the rows that must come out of it."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = f"select * from (values {', '.join('(' + ', '.join(map(_literal, r)) + ')' for r in rows)}) x({columns})"
        return f

    return register


def _lines(spark: SparkSession, *lines: str | None) -> DataFrame:
    return spark.createDataFrame(list(enumerate(lines)), "id int, line string")


def _parts(df: DataFrame, parsed: Column) -> DataFrame:
    return df.select("id", parsed.alias("p")).select("id", "p.street", "p.city", "p.state", "p.zip")


@expect("id, street, city, state, zip", (0, "14 W Tamarack Blvd.", "Larkspur", "AZ", "85001"), (1, "77 N Ring Road 9, Suite 5", "San Quillan", "TX", "78001"), (2, "3 Heron Street", "Veldra", "NM", "87001"),
        (3, "8 Heron St Ste B", "Veldra Park", "NM", "87001"), (4, None, None, None, None), (5, None, None, None, None), (6, None, None, None, None))
def one_line_addresses(spark, root):
    """ADR-04/06/07."""
    df = _lines(spark, "14 W Tamarack Blvd., Larkspur, AZ 85001", "77 N Ring Road 9, Suite 5 San Quillan, TX 78001", "3 Heron Street, Veldra, New Mexico 87001-1234, United States of America",
                "<b>8 Heron St</b> Ste B Veldra Park NM 87001", "Heron Street, Somewhere, CA 94001", "", None)
    return _parts(df, address.parse_us_address(F.col("line")))


@expect("id, street, city, state, zip", (0, "8 Airfield Park Road Suite 10", "Glen Veldra", "MD", "21001"), (1, None, None, None, None), (2, "9 Heron St", "Oak Larkspur", "IL", "60001"))
def known_towns(spark, root):
    """ADR-05, ADR-13: the town given, or named by the page's address."""
    rows = [(0, "8 Airfield Park Road Suite 10 Glen Veldra, MD 21001", "Glen Veldra", "MD", None), (1, "1 Heron St Elsewhere, TX 70000", "Veldra", "MI", None), (2, "9 Heron St Oak Larkspur, IL 60001", None, None, "https://x.example/places/oak-larkspur-il/")]
    df = spark.createDataFrame(rows, "id int, line string, city string, state string, url string")
    return _parts(df, F.coalesce(address.parse_known_locality(F.col("line"), F.col("city"), F.col("state")), address.parse_with_page_city(F.col("line"), F.col("url"))))


@expect("id, street, city, state, zip", (0, "9 Heron St", "Larkspur", "IL", "60001"), (1, "Remote", None, None, None), (2, None, None, None, None))
def practitioner_lines(spark, root):
    """ADR-09."""
    return _parts(_lines(spark, "9 Heron St, Larkspur, IL 60001", "Remote", None), address.split_practitioner_address(F.col("line")))


@expect("id, street, city, state, zip", (0, "29 Heron Blvd. NW Suite 1", "Veldra", "NM", "87001"), (1, "4 Fern St", "Veldra", "NM", "87001"), (2, None, None, None, None))
def marked_up_addresses(spark, root):
    """ADR-08, ADR-10: classed spans, else a block of lines."""
    spans = '<p><span class="address-line1">29 Heron Blvd. NW</span><span class="address-line2">Suite 1</span><span class="locality">Veldra</span><span class="administrative-area">NM</span><span class="postal-code">87001</span></p>'
    df = _lines(spark, spans, "4 Fern St<br/>Veldra, NM 87001", "<p>no place</p>")
    return _parts(df, F.coalesce(address.span_address(F.col("line")), address.break_block(F.col("line"))))


@expect("id, city, state, street, code", (0, "Oak Larkspur", "IL", None, "IN"), (1, None, None, "9 Heron St, Ste 2", "NY"), (2, None, None, None, None))
def titles_and_lists(spark, root):
    """ADR-11, ADR-12, ADR-15: a town in a title, a state's code, the street of a listed address."""
    df = spark.createDataFrame([(0, "Therapy in Oak Larkspur, il | Veldra", None, "Indiana"), (1, "About us", "9 Heron St, Ste 2, Larkspur, Illinois", "new york"), (2, None, None, None)], "id int, title string, line string, state string")
    return df.select("id", address.place_in_title(F.col("title")).alias("p"), address.listed_street(F.col("line")).alias("street"), address.state_code(F.col("state")).alias("code")).select("id", "p.city", "p.state", "street", "code")


@expect("npi, raw_name, city, state, credential_type, updated", ("1", "QUILLAN HARBOR", "L", "NJ", "y", None), ("2", "ANN LEE", None, None, None, "2025-02-02"))
def registry_documents(spark, root):
    """SRC-07, ARR-04: registry documents, one row per number; a broken one gives none."""
    doc = {"results": [{"number": 1, "basic": {"organization_name": "QUILLAN HARBOR"}, "addresses": [{"address_purpose": "MAILING", "city": "M"}, {"address_purpose": "LOCATION", "city": "L", "state": "njx"}], "taxonomies": [{"desc": "x"}, {"desc": "y", "primary": True}]},
                       {"number": 2, "basic": {"first_name": "ANN", "last_name": "LEE", "last_updated": "2024-01-01", "certification_date": "2025-02-02"}}]}
    df = spark.createDataFrame([(json.dumps(doc),), (json.dumps(doc),), ("{broken",), (None,)], "content string")
    return documents.registry_rows(df).select("npi", "raw_name", "city", "state", "credential_type", F.col("registry_last_updated").cast("string").alias("updated"))


@expect("accession_number, filer_name, form_type", ("1", "Fund", "D"))
def filing_documents(spark, root):
    """SRC-08/09, STR-06, IDM-02: filings of a search, once each, names without the registry's mark."""
    doc = {"hits": {"hits": [{"_id": "1:x", "_source": {"form": "D", "display_names": ["Fund (CIK 0000000001)"], "file_date": "2024-03-15"}}, {"_id": "z", "_source": {"accession_no": "1", "form_type": "D", "entity_name": "Fund"}}]}}
    return documents.filing_rows(spark.createDataFrame([(json.dumps(doc),)], "content string")).select("accession_number", "filer_name", "form_type")


@expect("portfolio_name, tags", ("A & B", "Health"))
def feed_documents(spark, root):
    """SRC-11/12."""
    feed = {"results": [{"id": "1", "title": "A &amp; B", "sectors": ["7"]}, {"id": "2", "title": "C", "sectors": ["8"]}], "taxonomy": {"7": "Health", "8": "Oil"}}
    return documents.feed_rows(spark.createDataFrame([(json.dumps(feed),)], "content string"), ["Health"]).select("portfolio_name", F.array_join("sector_tags", ",").alias("tags"))


@expect("owner_name, address_line1, city, state, zip", ("Quillan", "1 Fern St", "Veldra", "OH", "44101"))
def store_documents(spark, root):
    """SRC-18, J-29: a store locator's list; unknown labels and rows without a street are dropped."""
    stores = [{"store": "Q", "address": "1 Fern St", "city": "Veldra", "state": "ohio", "zip": "44101"}, {"store": "HQ", "address": "2 Fern St"}, {"store": "Q", "address": ""}]
    return documents.store_rows(spark.createDataFrame([(json.dumps(stores),)], "content string"), {"Q": "Quillan"}).select("owner_name", "address_line1", "city", "state", "zip")


@expect("id, street, city, state, zip", (0, "41 Tamarack Ct.", "Veldra", "OR", "97001"), (1, "5 Heron Dr.", "Larkspur", "TX", "79001"), (2, "86 Fern Blvd", "Fernley", "CA", "94002"), (3, None, None, None, None), (4, None, None, None, None))
def linked_data_pages(spark, root):
    """SRC-23/24/26, JSN-01: the first place of a page's JSON-LD, in a graph too, field by field where it is malformed."""
    ld = '<script type="application/ld+json">{}</script>'
    df = _lines(
        spark, ld.format('{"@type":"MedicalClinic","address":{"streetAddress":"41 Tamarack Ct.","addressLocality":"Veldra","addressRegion":"or","postalCode":"97001"}}'),
        ld.format('[{"@graph":[{"@type":"WebPage"},{"@type":["Place","MedicalClinic"],"address":[{"streetAddress":"5 Heron Dr.","addressLocality":"Larkspur","addressRegion":"TX","postalCode":"79001-2222"}]}]}]'),
        ld.format('{"@type":"MedicalClinic","note": not quoted,"address":{"streetAddress":"86 Fern Blvd","addressLocality":"Fernley","addressRegion":"CA","postalCode":"94002"}}'),
        ld.format('{"@type":"MedicalClinic","address":{"streetAddress":"At your home"}}'), None,
    )
    return _parts(df, documents.jsonld_location(F.col("line")))


@expect("id, street, markers", (0, "1 Deep St", "A,B"), (1, None, None))
def nested_documents(spark, root):
    """SRC-25, JSN-04: an address at any depth of a document, and markers assigned in a script."""
    df = spark.createDataFrame([(0, '{"a": [{"b": {"streetAddress": "1 Deep St"}}]}', 'var markers = [{"t": "A"}, {"t": "B"}];'), (1, "{broken", "var markers = [broken;")], "id int, doc string, script string")
    marks = arrays.embedded_json(F.col("script"), "markers", "array<struct<t string>>")
    return df.select("id", F.get_json_object(documents.postal_node(F.col("doc")), "$.streetAddress").alias("street"), F.array_join(F.transform(marks, lambda m: m["t"]), ",").alias("markers"))


@expect("portfolio_name, portfolio_url, tags", ("A & B", "https://x.example/p/a", "H,I"), ("C", None, ""))
def portfolio_pages(spark, root):
    """SRC-10/14, STR-10/11: companies of a page by selectors."""
    page = '<div class="portfolio-company"><h3 class="company-name">A &amp; B</h3><a href="/p/a">x</a><span class="sector">H</span><span class="sector">I</span></div><div class="portfolio-company"><h3 class="company-name">C</h3></div>'
    return documents.portfolio_rows(spark.createDataFrame([("https://x.example/l", page), ("u", None)], "url string, content string")).select("portfolio_name", "portfolio_url", F.array_join("sector_tags", ",").alias("tags"))


@expect("raw_name, credential_type, city, state, npi", ("Lee, Ann", "BCBA", "Larkspur", "IL", "1234567890"))
def practitioner_pages(spark, root):
    """SRC-15, ADR-09."""
    table = '<table><tr class="provider-row"><td>Lee, Ann</td><td>BCBA</td><td>9 Heron St, Larkspur, IL 60001</td><td>1234567890</td></tr></table>'
    return documents.practitioner_rows(spark.createDataFrame([("u", table)], "url string, content string")).select("raw_name", "credential_type", "city", "state", "npi")


@expect("page", ("https://x.example/location/veldra-tx/",))
def sitemap_leaves(spark, root):
    """SRC-16, FLT-18."""
    xml = "<urlset><url><loc>https://x.example/location/</loc></url><url><loc>https://x.example/location/veldra-tx/</loc></url><url><loc>https://x.example/es/location/veldra-tx/</loc></url></urlset>"
    return _lines(spark, xml).select(F.explode(documents.sitemap_pages(F.col("line"), r"example/location/[^/]+/$")).alias("page"))


@expect("street, location_kind, updated", ("14 HERON ST", "primary", "2025-03-09"), ("21 FERN CT", "secondary", "2025-03-09"))
def bulk_locations(spark, root):
    """ER-07, J-05, SRC-01/03, DAT-01: locations of active organisations that a brand matches, in both files."""
    main = spark.createDataFrame([("501", "2", "QUILLAN HARBOR, LLC", "14 HERON ST", "03/09/2025", ""), ("502", "2", "QUILLAN HARBOR, LLC", "88 CLOSED RD", "06/01/2018", "07/08/2023"), ("503", "1", "", "5 SOLO LN", "03/09/2025", ""), ("504", "2", "OPTICS", "6 LENS AVE", "03/09/2025", "")],
                                 "npi string, entity string, legal_name string, street string, updated string, deactivated string").withColumns({c: F.lit("x") for c in ("city", "state", "zip")})
    second = spark.createDataFrame([("501", "21 FERN CT"), ("502", "89 CLOSED RD"), ("504", "7 LENS AVE")], "npi string, street string").withColumns({c: F.lit("x") for c in ("city", "state", "zip")})
    found = files.registry_locations(main, second, main.where("lower(legal_name) like 'quillan%'"))
    return found.select("street", "location_kind", F.col("updated").cast("string").alias("updated"))


@expect("id, link, confidence, flags", (0, True, 0.9, ""), (1, False, 0.0, "no_supporting_snippet"), (2, False, 0.0, "odd,no_supporting_snippet"))
def verified_answers(spark, root):
    """ER-09: answers without a supporting snippet are no links."""
    df = spark.createDataFrame([(0, True, 0.9, ["seen"], None), (1, True, 0.8, [" "], None), (2, True, 0.7, None, ["odd"])], "id int, link boolean, confidence double, snippets array<string>, flags array<string>")
    return claims.verified(df).select("id", "link", "confidence", F.array_join("flags", ",").alias("flags"))


@expect("id, shown, place, stamped, name", (0, "postgresql://me:***@db.example/x", "Oak Park", "2020-01-05", "Acme Fund"), (1, "plain", "Veldra", "soon", None), (2, None, None, None, None))
def text_marks(spark, root):
    """STR-06, STR-12, STR-14, DAT-01."""
    df = spark.createDataFrame([(0, "postgresql://me:secret@db.example/x", "oak-park-aba-therapy", "1/5/2020", "Acme Fund (CIK 0001234567)"), (1, "plain", "veldra", "Soon", "(CIK 1)"), (2, None, None, None, None)], "id int, dsn string, slug string, day string, name string")
    return df.select("id", text.redacted(F.col("dsn")).alias("shown"), text.slug_title(F.col("slug"), "-aba-therapy").alias("place"), dates.iso_text(F.col("day")).alias("stamped"), text.without_registry_mark(F.col("name")).alias("name"))
