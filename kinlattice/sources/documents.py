"""Parsers of landed documents (SRC-05 to SRC-18, SRC-23 to SRC-26).

JSON and JSON-LD are parsed by built-in functions; only class-based HTML needs Python,
in batches, with the standard library's parser.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlattice.functions import arrays, text
from kinlattice.functions.dates import iso_date

_ADDRESS = "array<struct<address_purpose:string,address_1:string,city:string,state:string,postal_code:string>>"
REGISTRY = (
    "struct<results:array<struct<number:string,basic:struct<organization_name:string,first_name:string,last_name:string,last_updated:string,certification_date:string,enumeration_date:string,status:string>,"
    f"addresses:{_ADDRESS},taxonomies:array<struct<desc:string,code:string,primary:boolean>>>>>"
)
FILINGS = "struct<hits:struct<hits:array<struct<_id:string,_source:struct<adsh:string,accession_no:string,accession_number:string,form_type:string,form:string,entity_name:string,display_names:array<string>,file_date:string,inc_states:string,biz_states:string>>>>>"
FEED = "struct<results:array<struct<id:string,title:string,link:string,content:string,sectors:array<string>>>,taxonomy:map<string,string>>"
STORES = "array<struct<store:string,address:string,city:string,state:string,zip:string,url:string>>"
#: Schema.org types that are places.
PLACE_TYPES = "MedicalBusiness|MedicalClinic|LocalBusiness|Physician|MedicalOrganization|Organization"


def registry_rows(docs: DataFrame, content: str = "content") -> DataFrame:
    """SRC-06/07: providers of the registry's JSON answers; the first row of a number stays.

    Organisation name, else first and last name; the location's address, else the first;
    the primary taxonomy, else the first; the later of two dates. Malformed documents give none.
    """
    p = docs.select(F.monotonically_increasing_id().alias("_d"), F.posexplode(F.from_json(content, REGISTRY)["results"]).alias("_i", "p"))
    place = arrays.first_where(F.col("p.addresses"), lambda a: a["address_purpose"] == "LOCATION")
    skill = arrays.first_where(F.col("p.taxonomies"), lambda t: t["primary"])
    b = F.col("p.basic")
    rows = p.select(
        "_d", "_i", F.col("p.number").alias("npi"), F.coalesce(text.blank_to_null(b["organization_name"]), text.blank_to_null(F.concat_ws(" ", b["first_name"], b["last_name"]))).alias("raw_name"),
        place["address_1"].alias("address_line1"), place["city"].alias("city"), F.upper(F.substring(place["state"], 1, 2)).alias("state"), place["postal_code"].alias("zip"), skill["desc"].alias("credential_type"),
        F.greatest(iso_date(b["last_updated"]), iso_date(b["certification_date"])).alias("registry_last_updated"), iso_date(b["enumeration_date"]).alias("registry_enumerated_on"), b["status"].alias("registry_status"),
    ).where("npi is not null and raw_name is not null")
    first = rows.groupBy("npi").agg(F.min(F.struct("_d", "_i", *[c for c in rows.columns if c not in ("_d", "_i", "npi")])).alias("m"))
    return first.select("npi", *[F.col(f"m.{c}").alias(c) for c in rows.columns if c not in ("_d", "_i", "npi")])


def filing_rows(docs: DataFrame, content: str = "content") -> DataFrame:
    """SRC-08/09, SET-05, STR-06: filings of search answers, one per accession number."""
    h = docs.select(F.explode(F.from_json(content, FILINGS)["hits"]["hits"]).alias("h"))
    s = F.col("h._source")
    rows = h.select(
        arrays.first_filled(s["adsh"], s["accession_no"], s["accession_number"], F.split_part(F.col("h._id"), F.lit(":"), F.lit(1))).alias("accession_number"), F.coalesce(s["form_type"], s["form"]).alias("form_type"),
        text.without_registry_mark(F.coalesce(s["entity_name"], F.get(s["display_names"], F.lit(0)))).alias("filer_name"), iso_date(s["file_date"]).alias("filing_date"), F.coalesce(s["biz_states"], s["inc_states"]).alias("biz_state"), s["inc_states"].alias("inc_state"),
    )
    return rows.where("accession_number is not null").groupBy("accession_number").agg(*[F.min(c).alias(c) for c in rows.columns if c != "accession_number"])


def feed_rows(docs: DataFrame, allowed: list[str] | None = None, content: str = "content") -> DataFrame:
    """SRC-11/12: companies of a feed; sector ids become names, and only allowed sectors stay."""
    d = docs.select(F.from_json(content, FEED).alias("f")).select("f.taxonomy", F.explode("f.results").alias("x"))
    named = F.transform("x.sectors", lambda i: F.coalesce(F.col("taxonomy")[i], i))
    rows = d.select(text.fragment_text(F.col("x.title")).alias("portfolio_name"), F.col("x.link").alias("portfolio_url"), text.fragment_text(F.col("x.content")).alias("description"), named.alias("sector_tags"))
    rows = rows.where("portfolio_name != ''")
    return rows.where(F.arrays_overlap("sector_tags", F.array(*[F.lit(a) for a in allowed]))) if allowed else rows


def store_rows(docs: DataFrame, owners: dict[str, str], content: str = "content") -> DataFrame:
    """SRC-18, J-29: centers of a store-locator list; labels that no owner is known for, and rows without a street, are dropped."""
    of = F.create_map(*[F.lit(x) for kv in owners.items() for x in kv])
    d = docs.select(F.explode(F.from_json(content, STORES)).alias("x")).select(of[F.trim("x.store")].alias("owner_name"), F.trim("x.address").alias("address_line1"), "x.city", F.upper(F.substring("x.state", 1, 2)).alias("state"), "x.zip", F.col("x.url").alias("detail_url"))
    return d.where("owner_name is not null and address_line1 != ''")


def jsonld_nodes(html: Column) -> Column:
    """SRC-23: all JSON-LD nodes of a page as JSON text, lists and graphs flattened; malformed blobs are skipped."""
    blobs = F.regexp_extract_all(html, F.lit(r'(?is)<script[^>]*type=["\']application/ld\+json["\'][^>]*>(.*?)</script>'), F.lit(1))
    listed = F.transform(blobs, lambda b: F.coalesce(F.when(F.trim(b).startswith("["), F.from_json(F.trim(b), "array<string>")), F.array(F.trim(b))))
    whole = F.filter(F.flatten(listed), lambda n: F.try_parse_json(n).isNotNull())
    graphs = F.flatten(F.transform(whole, lambda n: F.coalesce(F.from_json(F.get_json_object(n, "$.@graph"), "array<string>"), F.array().cast("array<string>"))))
    return F.concat(whole, graphs)


def jsonld_location(html: Column) -> Column:
    """SRC-24/26: ``struct(name, street, city, state, zip)`` of the page's first place, null without one.

    The address may be an object, a list or plain text; where the JSON is malformed, its
    fields are read one by one; a street without a digit ("In Home Services") is none.
    """
    typed = F.filter(jsonld_nodes(html), lambda n: F.get_json_object(n, "$.@type").rlike(PLACE_TYPES) & F.get_json_object(n, "$.address").isNotNull())
    node = F.get(typed, F.lit(0))
    raw = F.get_json_object(node, "$.address")
    one = F.when(raw.startswith("["), F.get(F.from_json(raw, "array<string>"), F.lit(0))).otherwise(raw)
    field = lambda name: F.nullif(F.trim(F.get_json_object(one, f"$.{name}")), F.lit(""))
    found = lambda name: F.nullif(F.regexp_extract(html, rf'"{name}"\s*:\s*"([^"]*)"', 1), F.lit(""))
    plain = F.when(~one.startswith("{"), one)
    street = F.when(node.isNotNull(), F.coalesce(plain, field("streetAddress"))).otherwise(found("streetAddress"))
    pick = lambda name: F.when(node.isNotNull(), field(name)).otherwise(found(name))
    place = F.struct(F.get_json_object(node, "$.name").alias("name"), street.alias("street"), pick("addressLocality").alias("city"), F.upper(F.substring(pick("addressRegion"), 1, 2)).alias("state"), F.substring(pick("postalCode"), 1, 5).alias("zip"))
    return F.when(street.rlike("[0-9]"), place)


def postal_node(c: Column, depth: int = 4) -> Column:
    """SRC-25: the first object of JSON text that has a street address, searched depth first down to ``depth`` levels; null without one."""
    level = F.filter(F.array(c), lambda n: F.try_parse_json(n).isNotNull())
    seen = level
    for _ in range(depth):
        level = F.flatten(F.transform(level, _children))
        seen = F.concat(seen, level)
    return F.get(F.filter(seen, lambda n: F.get_json_object(n, "$.streetAddress").isNotNull()), F.lit(0))


def _children(n: Column) -> Column:
    """Objects and lists directly inside a JSON object or list, as text."""
    inside = F.when(n.startswith("["), F.from_json(n, "array<string>")).when(n.startswith("{"), F.map_values(F.from_json(n, "map<string,string>")))
    return F.coalesce(F.filter(inside, lambda x: F.coalesce(x.startswith("{") | x.startswith("["), F.lit(False))), F.array().cast("array<string>"))


def sitemap_pages(xml: Column, keep: str, depth: int | None = None) -> Column:
    """FLT-18: page addresses of a sitemap that match ``keep``, of one depth if given."""
    urls = F.regexp_extract_all(xml, F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))
    kept = F.filter(urls, lambda u: u.rlike(keep))
    return F.filter(kept, lambda u: F.size(F.split(F.regexp_replace(u, "/$", ""), "/")) == depth) if depth else kept


class _Items(HTMLParser):
    """Text and links of elements by class, grouped by the enclosing item."""

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self, item: str, fields: dict[str, str]):
        super().__init__()
        self.item, self.fields, self.depth, self.items = item, fields, 0, []
        self.open: list[tuple[int, str]] = []
        self.at: int | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        names = {tag, *(f"{tag}.{c}" for c in (a.get("class") or "").split()), *(f".{c}" for c in (a.get("class") or "").split())}
        if tag in self.VOID:
            return
        self.depth += 1
        if self.at is None and self.item in names:
            self.at = self.depth
            self.items.append({k: [] for k in self.fields} | {"href": []})
        elif self.at is not None:
            for k, selector in self.fields.items():
                if selector in names:
                    self.items[-1][k].append("")
                    self.open.append((self.depth, k))
            if tag == "a" and a.get("href"):
                self.items[-1]["href"].append(a["href"])

    def handle_endtag(self, tag: str) -> None:
        if tag in self.VOID:
            return
        self.open = [(d, k) for d, k in self.open if d < self.depth]
        if self.at == self.depth:
            self.at = None
        self.depth -= 1

    def handle_data(self, data: str) -> None:
        for _, k in self.open:
            self.items[-1][k][-1] += data


def select_items(docs: DataFrame, item: str, fields: dict[str, str], key: str = "url", content: str = "content") -> DataFrame:
    """SRC-10, SRC-15, SRC-16: one row per element ``item`` of a page, an array of texts per field, and its links.

    Selectors are ``tag``, ``.class`` or ``tag.class``. Null and broken pages give what could be read.
    """
    names = [*fields, "href"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, page in zip(b[key], b[content]):
                p = _Items(item, fields)
                p.feed(page or "")
                rows += [(k, *[[" ".join(t.split()) for t in i[n]] for n in names]) for i in p.items]
            yield pd.DataFrame(rows, columns=[key, *names])

    return docs.select(key, content).mapInPandas(run, f"{key} string, " + ", ".join(f"`{n}` array<string>" for n in names))


def portfolio_rows(docs: DataFrame, item: str = ".portfolio-company", name: str = "h3.company-name", description: str = "p.description", sector: str = "span.sector") -> DataFrame:
    """SRC-10/14, STR-11: companies of a portfolio page; relative links become absolute."""
    x = select_items(docs, item, {"name": name, "description": description, "sectors": sector})
    first = lambda c: F.get(c, F.lit(0))
    return x.where(first("name") != "").select("url", first("name").alias("portfolio_name"), text.absolute_url(first("href"), F.col("url")).alias("portfolio_url"), first("description").alias("description"), F.col("sectors").alias("sector_tags"))


def practitioner_rows(docs: DataFrame) -> DataFrame:
    """SRC-15, ADR-09: practitioners of a directory table: name, credential, address, ten-digit number."""
    from kinlattice.functions.address import split_practitioner_address

    x = select_items(docs, "tr.provider-row", {"cells": "td"}).where(F.size("cells") > 2)
    cell = lambda i: F.get("cells", F.lit(i))
    npi = F.get(F.filter("cells", lambda c: c.rlike(r"^\d{10}$")), F.lit(0))
    return x.select(cell(0).alias("raw_name"), cell(1).alias("credential_type"), split_practitioner_address(cell(2)).alias("a"), npi.alias("npi")).select("raw_name", "credential_type", F.col("a.street").alias("address_line1"), "a.city", "a.state", "a.zip", "npi")
