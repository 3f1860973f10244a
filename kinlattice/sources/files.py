"""Readers (SRC-01 to SRC-03, SRC-21, SRC-28 to SRC-30)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlattice.functions.dates import iso_date
from kinlattice.runtime import hadoop

#: Columns of the registry's two files, by our name.
MAIN = {
    "npi": "NPI", "entity": "Entity Type Code", "legal_name": "Provider Organization Name (Legal Business Name)", "other_name": "Provider Other Organization Name",
    "street": "Provider First Line Business Practice Location Address", "city": "Provider Business Practice Location Address City Name",
    "state": "Provider Business Practice Location Address State Name", "zip": "Provider Business Practice Location Address Postal Code",
    "updated": "Last Update Date", "deactivated": "NPI Deactivation Date",
}
SECONDARY = {
    "npi": "NPI", "street": "Provider Secondary Practice Location Address- Address Line 1", "city": "Provider Secondary Practice Location Address - City Name",
    "state": "Provider Secondary Practice Location Address - State Name", "zip": "Provider Secondary Practice Location Address - Postal Code",
}
TAXONOMY = "Healthcare Provider Taxonomy Code_"


def unpack(spark: SparkSession, archive: str, folder: str, prefix: str) -> str:
    """SRC-01/02: unpacks the CSV member whose name begins with ``prefix``; a file-header member is none.

    ZIP is no codec that splits, so the member is written once, streaming, to a folder
    that executors share, and read in parallel afterwards. Any store will do for both.
    """
    jvm = spark._jvm
    fs, source = hadoop(spark, archive)
    members = jvm.java.util.zip.ZipInputStream(fs.open(source))
    try:
        while entry := members.getNextEntry():
            name = entry.getName().rsplit("/", 1)[-1]
            if name.startswith(prefix) and name.lower().endswith(".csv") and "fileheader" not in name.lower():
                to, target = hadoop(spark, f"{folder}/{name}")
                out = to.create(target, True)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(members, out, 1 << 20, False)
                finally:
                    out.close()
                return f"{folder}/{name}"
    finally:
        members.close()
    raise FileNotFoundError(f"no member {prefix}*.csv in {archive}")


def csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """SRC-29: a CSV with header, all text, quotes doubled within quotes."""
    return spark.read.options(header=True, escape='"', multiLine=False, **options).csv(path)


def registry_main(spark: SparkSession, path: str) -> DataFrame:
    """SRC-01: the main file by our names, with ``taxonomies`` from its numbered columns; only these columns are read."""
    raw = csv(spark, path)
    codes = [c for c in raw.columns if c.startswith(TAXONOMY)]
    have = {k: v for k, v in MAIN.items() if v in raw.columns}
    return raw.select(*[F.col(f"`{v}`").alias(k) for k, v in have.items()], *[F.lit(None).cast("string").alias(k) for k in MAIN if k not in have], F.filter(F.array(*[F.col(f"`{c}`") for c in codes]), lambda x: F.trim(x) != "").alias("taxonomies"))


def registry_secondary(spark: SparkSession, path: str) -> DataFrame:
    """SRC-03."""
    raw = csv(spark, path)
    squeezed = {"".join(c.split()): c for c in raw.columns}
    find = lambda k: squeezed.get("".join(SECONDARY[k].split())) or next(c for c in raw.columns if c.endswith(SECONDARY[k].split("-", 1)[-1].strip()))
    return raw.select(*[F.col(f"`{find(k)}`").alias(k) for k in SECONDARY])


def registry_locations(main: DataFrame, secondary: DataFrame, matched: DataFrame) -> DataFrame:
    """ER-07, J-05: primary and secondary locations of active organisations whose number is in ``matched``."""
    live = main.where("entity = '2' and coalesce(trim(deactivated), '') = ''").join(matched.select("npi").distinct(), "npi", "left_semi")
    first = live.select("npi", "legal_name", "street", "city", "state", "zip", iso_date(F.col("updated")).alias("updated"), F.lit("primary").alias("location_kind"))
    more = secondary.join(first.select("npi", "legal_name", "updated"), "npi").select("npi", "legal_name", "street", "city", "state", "zip", "updated", F.lit("secondary").alias("location_kind"))
    return first.unionByName(more)


def registry_counters(main: DataFrame, matched: DataFrame) -> DataFrame:
    """ER-07: what pass one saw, in one aggregation."""
    gone = F.coalesce(F.trim("deactivated"), F.lit("")) != ""
    m = main.join(matched.select("npi", F.lit(True).alias("hit")).distinct(), "npi", "left")
    org = F.col("entity") == "2"
    return m.agg(F.count("*").alias("npis_scanned"), F.count_if(org).alias("orgs_scanned"), F.count_if(org & gone).alias("deactivated_skipped"), F.count_if(org & ~gone & F.col("hit")).alias("matched_npis"))


def gazetteer(spark: SparkSession, path: str, least: int = 30_000) -> DataFrame:
    """SRC-21: ZIP, latitude and longitude of a tab-separated file with padded headers; refuses a partial one."""
    from kinlattice.operators.guards import require_at_least

    raw = csv(spark, path, sep="\t")
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    out = raw.select(F.trim("GEOID").alias("zip5"), F.round(F.trim("INTPTLAT").cast("double"), 5).alias("lat"), F.round(F.trim("INTPTLONG").cast("double"), 5).alias("lng"))
    return require_at_least(out, least, "gazetteer")


def blobs(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SRC-30, HSH-01: files below ``path`` with their SHA-256."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).withColumn("content_hash", F.sha2("content", 256))


def jdbc(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int = 16) -> DataFrame:
    """SRC-28: a table of a database, read in ranges of a numeric column."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts).load()


#: SRC-20, SRC-27: small relations stated in code.
FACTS = T.StructType([T.StructField(n, T.StringType()) for n in ("firm", "company", "url", "description")])


def facts(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, FACTS).withColumn("fact_id", F.sha2(F.concat_ws("|", "firm", "company"), 256))
