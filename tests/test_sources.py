"""Readers, parsers, sinks and streaming on small inputs."""

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from kinlattice.sources import documents, files, sinks
from kinlattice.streaming import ingest

MAIN = [files.MAIN[k] for k in ("npi", "entity", "legal_name", "other_name", "street", "city", "state", "zip", "updated", "deactivated")] + [files.TAXONOMY + "1"]


def test_registry_archive(spark, tmp_path):
    q = lambda r: ",".join(f'"{x}"' for x in r)
    main = [MAIN, ["501", "2", "QUILLAN HARBOR, LLC", "", "14 HERON ST", "VELDRA", "OH", "44101", "03/09/2025", "", "X1"], ["502", "2", "QUILLAN HARBOR, LLC", "", "88 CLOSED RD", "VELDRA", "OH", "44102", "06/01/2018", "07/08/2023", "X1"],
            ["503", "1", "", "", "5 SOLO LN", "VELDRA", "OH", "44101", "03/09/2025", "", "X1"], ["504", "2", "BRIGHT OPTICS", "", "6 LENS AVE", "LARKSPUR", "ME", "04001", "03/09/2025", "", "Z9"]]
    second = [list(files.SECONDARY.values()), ["501", "21 FERN CT", "LARKSPUR", "OH", "44103"], ["502", "89 CLOSED RD", "VELDRA", "OH", "44102"], ["504", "7 LENS AVE", "LARKSPUR", "ME", "04001"]]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("npidata_pfile_x_fileheader.csv", "no")
        z.writestr("npidata_pfile_x.csv", "\n".join(map(q, main)))
        z.writestr("pl_pfile_x.csv", "\n".join(map(q, second)))
    m = files.registry_main(spark, files.unpack(spark, str(tmp_path / "a.zip"), str(tmp_path / "out"), "npidata_pfile"))
    s = files.registry_secondary(spark, files.unpack(spark, str(tmp_path / "a.zip"), str(tmp_path / "out"), "pl_pfile"))
    hit = m.where("lower(legal_name) like 'quillan%'").select("npi")
    assert sorted((r["street"], r["location_kind"]) for r in files.registry_locations(m, s, hit).collect()) == [("14 HERON ST", "primary"), ("21 FERN CT", "secondary")]
    assert tuple(files.registry_counters(m, hit).first()) == (4, 3, 1, 1)
    with pytest.raises(FileNotFoundError):
        files.unpack(spark, str(tmp_path / "a.zip"), str(tmp_path / "out"), "other")


def test_registry_json(spark):
    doc = {"results": [{"number": 1, "basic": {"organization_name": "ACME"}, "addresses": [{"address_purpose": "MAILING", "city": "M"}, {"address_purpose": "LOCATION", "city": "L", "state": "njx"}], "taxonomies": [{"desc": "x"}, {"desc": "y", "primary": True}]},
                       {"number": 2, "basic": {"first_name": "ANN", "last_name": "LEE", "last_updated": "2024-01-01", "certification_date": "2025-02-02"}}]}
    df = spark.createDataFrame([(json.dumps(doc),), (json.dumps(doc),), ("{broken",), (None,)], "content string")
    got = {r["npi"]: r for r in documents.registry_rows(df).collect()}
    assert set(got) == {"1", "2"} and got["1"]["city"] == "L" and got["1"]["state"] == "NJ" and got["1"]["credential_type"] == "y"
    assert got["2"]["raw_name"] == "ANN LEE" and got["2"]["registry_last_updated"] == dt.date(2025, 2, 2)


def test_filings(spark):
    doc = {"hits": {"hits": [{"_id": "1:x", "_source": {"form": "D", "display_names": ["Fund (CIK 0000000001)"], "file_date": "2024-03-15"}}, {"_id": "z", "_source": {"accession_no": "1", "form_type": "D", "entity_name": "Fund"}}]}}
    (r,) = documents.filing_rows(spark.createDataFrame([(json.dumps(doc),)], "content string")).collect()
    assert (r["accession_number"], r["filer_name"], r["form_type"]) == ("1", "Fund", "D")


def test_feed_and_stores(spark):
    feed = {"results": [{"id": "1", "title": "A &amp; B", "sectors": ["7"]}, {"id": "2", "title": "C", "sectors": ["8"]}], "taxonomy": {"7": "Health", "8": "Oil"}}
    assert [r["portfolio_name"] for r in documents.feed_rows(spark.createDataFrame([(json.dumps(feed),)], "content string"), ["Health"]).collect()] == ["A & B"]
    stores = [{"store": "X", "address": "1 A St"}, {"store": "HQ", "address": "2 B St"}, {"store": "X", "address": ""}]
    assert documents.store_rows(spark.createDataFrame([(json.dumps(stores),)], "content string"), {"X": "Owner X"}).count() == 1


LD = '<script type="application/ld+json">{}</script>'


@pytest.mark.parametrize("page, want", [
    (LD.format('{"@type":"MedicalClinic","name":"N","address":{"streetAddress":"41 Tamarack Ct.","addressLocality":"Veldra","addressRegion":"or","postalCode":"97001"}}'), ("41 Tamarack Ct.", "Veldra", "OR", "97001")),
    (LD.format('[{"@type":"WebSite"},{"@graph":[{"@type":"WebPage"},{"@type":["Place","MedicalClinic"],"address":[{"streetAddress":"5 Heron Dr.","addressLocality":"Larkspur","addressRegion":"TX","postalCode":"79001-2222"}]}]}]'), ("5 Heron Dr.", "Larkspur", "TX", "79001")),
    (LD.format('{"@type":"LocalBusiness","address":"3 Heron Street, San Veldra, CA 94001"}'), ("3 Heron Street, San Veldra, CA 94001", None, None, None)),
    (LD.format('{"@type":"MedicalClinic","note": not quoted,"address":{"streetAddress":"86 Fern Blvd","addressLocality":"Fernley","addressRegion":"CA","postalCode":"94002"}}'), ("86 Fern Blvd", "Fernley", "CA", "94002")),
    (LD.format('{"@type":"MedicalClinic","address":{"streetAddress":"At your home","addressLocality":"Veldra"}}'), None),
    (LD.format('{"@type":"WebPage","name":"Contact"}'), None),
    ("<html>nothing</html>", None),
    (None, None),
])
def test_jsonld(spark, page, want):
    got = spark.createDataFrame([(page,)], "p string").select(documents.jsonld_location(F.col("p")).alias("x")).first()["x"]
    assert (tuple(got)[1:] if got else None) == want


@pytest.mark.parametrize("doc, street", [
    ({"a": [{"b": {"c": {"streetAddress": "1 Deep St"}}}]}, "1 Deep St"), ({"streetAddress": "2 Top St"}, "2 Top St"), ({"a": {"b": "c"}}, None),
])
def test_postal_node(spark, doc, street):
    got = spark.createDataFrame([(json.dumps(doc),)], "x string").select(documents.postal_node(F.col("x")).alias("n")).first()["n"]
    assert (json.loads(got)["streetAddress"] if got else None) == street
    assert spark.createDataFrame([("{broken",), (None,)], "x string").select(documents.postal_node(F.col("x")).alias("n")).where("n is not null").count() == 0


def test_sitemap(spark):
    xml = "<urlset><url><loc>https://x.example/location/</loc></url><url><loc>https://x.example/location/austin-tx/</loc></url><url><loc>https://x.example/es/location/austin-tx/</loc></url></urlset>"
    got = spark.createDataFrame([(xml,)], "x string").select(documents.sitemap_pages(F.col("x"), r"example/location/[^/]+/$")).first()[0]
    assert got == ["https://x.example/location/austin-tx/"]


def test_html_items(spark):
    page = '<div class="portfolio-company"><h3 class="company-name">A &amp; B</h3><p class="description">d<br>e</p><a href="/p/a">x</a><span class="sector">H</span><span class="sector">I</span></div><div class="portfolio-company"><h3 class="company-name">C</h3></div>'
    df = spark.createDataFrame([("https://x.example/l", page), ("https://y.example", None)], "url string, content string")
    a, b = sorted(documents.portfolio_rows(df).collect(), key=lambda r: r["portfolio_name"])
    assert (a["portfolio_name"], a["portfolio_url"], a["sector_tags"]) == ("A & B", "https://x.example/p/a", ["H", "I"]) and b["sector_tags"] == []
    table = '<table><tr class="provider-row"><td>Smith, Jane</td><td>BCBA</td><td>9 Heron St, Larkspur, IL 60001</td><td>1234567890</td></tr></table>'
    (p,) = documents.practitioner_rows(spark.createDataFrame([("u", table)], "url string, content string")).collect()
    assert (p["city"], p["state"], p["npi"]) == ("Larkspur", "IL", "1234567890")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a"], None)], "n int, xs array<string>, z double")
    assert tuple(sinks.stringified(df).first()) == ("1", '["a"]', None)
    day = dt.date(2026, 1, 2)
    assert sinks.release({"t": df}, str(tmp_path), day, {"schema": "1"}) == "2026.01.02"
    assert sinks.release({"t": df}, str(tmp_path), day, {"schema": "1"}) == "2026.01.02-2"
    assert json.loads((tmp_path / "2026.01.02" / "manifest.json").read_text())["rows"] == {"t": 1}
    assert "schema: \"1\"" in (tmp_path / "2026.01.02-2" / "README.md").read_text() and not list(tmp_path.glob("_work*"))
    assert sinks.put_blob(spark, str(tmp_path), b"x", ".txt") == sinks.put_blob(spark, str(tmp_path), b"x", ".txt")
    (tmp_path / "new.lock").write_text("held")
    with pytest.raises(Exception, match="exists"):
        sinks.append_new(df, str(tmp_path / "new"), ["n"])
    (tmp_path / "new.lock").unlink()
    for _ in range(2):
        sinks.append_new(df, str(tmp_path / "new"), ["n"])
    assert spark.read.parquet(str(tmp_path / "new")).count() == 1
    assert json.loads(sinks.packet({"f": df})) == {"f": [{"n": 1, "xs": ["a"]}]}


def test_stream_once_each(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t), (1, t), (2, t)], "event_id long, ts timestamp")
    df.write.parquet(str(tmp_path / "in"))
    run = lambda: ingest.land(ingest.once_each(ingest.stream(spark, str(tmp_path / "in"), df.schema), "event_id", "ts"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    run()
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
