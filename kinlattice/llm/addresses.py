"""Same postal address written differently (problem 5).

Every line is expanded into all its plausible readings; combinations of their parts
are hashed, exploded, and readings that share any hash and the house number are
spellings of one street number. Each hash is sufficient: what it leaves out (a
letter, the vowels, the town where the ZIP names it) is what one place may differ in.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kinlattice.llm.components import connected
from kinlattice.llm.postal import Form, readings
from kinlattice.runtime import adaptive, drop_stage, stage

if TYPE_CHECKING:
    import pyarrow as pa

#: Columns of an address, parts that name the street number, and parts that tell locations on it apart.
ADDRESS = ("address_line1", "city", "state", "zip")
CORE, FINE = ("num", "street", "town", "zip5", "st"), ("pre", "kind", "unit")


def read(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and ``form`` of the rows whose address has a house number and a street.

    ``form`` holds all readings of the address in one text, parts joined by ``|`` and
    readings by ``;``: addresses that read alike have one form. A line that many rows
    repeat is read once per worker.
    """
    kept = rows.select(*keep)
    schema = StructType([*kept.schema.fields, StructField("form", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for b in batches:
            columns = [b.column(f"_{c}").to_pylist() for c in ADDRESS]
            forms = pa.array([";".join("|".join(f) for f in readings(*x)) for x in zip(*columns)], pa.string())
            out = pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], forms], [*keep, "form"])
            yield out.filter(pa.array([f != "" for f in forms.to_pylist()], pa.bool_()))

    return rows.select(*keep, *[F.col(c).cast("string").alias(f"_{c}") for c in ADDRESS]).mapInArrow(run, schema)


def _parts(lines: DataFrame) -> DataFrame:
    """``(form, rank, <parts>)``: one row per reading of each form."""
    each = lines.select("form", F.posexplode(F.split("form", ";")).alias("rank", "r")).select("form", "rank", F.split("r", r"\|").alias("p"))
    return each.select("form", "rank", *[F.get("p", F.lit(i)).alias(c) for i, c in enumerate(Form._fields)])


def _shorter(c: Column) -> Column:
    """The text whole and with each one of its letters left out."""
    left_out = F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c))))
    return F.when(F.length(c) < 4, F.array(c)).otherwise(F.array_append(left_out, c))


def _bones(c: Column, least: int = 4) -> Column:
    """Consonants, repeated ones once: what vowels and doubled letters cannot change; null where few are left."""
    b = F.regexp_replace(F.regexp_replace(c, "[aeiouy]", ""), r"(.)\1+", "$1")
    return F.when((F.length(b) >= least) & ~c.rlike("^[0-9]"), F.concat(F.lit("~"), b))


def _hashes() -> Column:
    """Every hash that makes a reading the same street number as another one with it.

    Number and ZIP with the street (whole, one letter left out, or its bones), where
    the towns are alike; number, state and town with the street; number, state and
    street with the town (likewise); number, state and the bones of both. Names that
    begin with a number ("8th", "18th") count only whole: there one changed character
    is another street.
    """
    num, street, town, zip_, st, area = (F.col(c) for c in (*CORE, "area"))
    none = F.array().cast("array<bigint>")
    with_bones = lambda c: F.array_compact(F.array_append(F.when(c.rlike("^[0-9]"), F.array(c)).otherwise(_shorter(c)), _bones(c)))
    streets, towns = with_bones(street), with_bones(town)
    by_zip = F.when(zip_ != "", F.transform(streets, lambda v: F.xxhash64(F.lit("zip"), num, zip_, area, v)))
    by_town = F.when(town != "", F.transform(streets, lambda v: F.xxhash64(F.lit("town"), num, st, town, v)))
    near_town = F.when((town != "") & (st != ""), F.transform(towns, lambda v: F.xxhash64(F.lit("near"), num, st, street, v)))
    both = F.concat(_bones(street, 2), _bones(town, 2))
    bones = F.when((st != "") & (F.length(both) > 9), F.array(F.xxhash64(F.lit("bones"), num, st, both)))
    return F.array_distinct(F.concat(*[F.coalesce(h, none) for h in (by_zip, by_town, near_town, bones)]))


def _cores(parts: DataFrame) -> DataFrame:
    """Distinct street numbers as read, with an id and ``area``: the town as its ZIP tells it.

    A town within three letters of the one that most lines give for the ZIP is that
    town, and so is a missing one; any other town stands for itself.
    """
    per_zip = parts.where("zip5 != '' and town != ''").groupBy("zip5", "town").agg(F.count("*").alias("n")).groupBy("zip5").agg(F.max_by("town", F.struct("n", "town")).alias("main"))
    near = (F.col("town") == "") | (F.levenshtein("town", "main", 3) >= 0)
    cores = parts.select(*CORE).distinct().join(per_zip, "zip5", "left").select(*CORE, F.coalesce(F.when(near, F.col("main")).otherwise(F.col("town")), "town").alias("area"))
    return cores.withColumn("core", F.monotonically_increasing_id())


def _streets(parts: DataFrame) -> DataFrame:
    """``(<core parts>, cluster)``: readings of one street number in one town share a cluster.

    Readings under one hash are tied to the first of them while they stream by in
    order, so work is linear in hashes, no pairs are made and no link is left out;
    the ties are closed by the star rewrites of :mod:`components`.
    """
    core = stage(_cores(parts), "core")
    keyed = core.select("core", "num", F.explode(_hashes()).alias("h"))
    in_order = Window.partitionBy("h", "num").orderBy("core")  # the house number itself, whatever the hash
    tied = keyed.select("core", F.first("core").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("least")).where("core != least").distinct()
    groups = connected(tied, "core", "least")
    clusters = stage(core.join(groups, F.col("core") == F.col("id"), "left").select(*CORE, "area", F.coalesce("group_id", "core").alias("cluster")), "clusters")
    drop_stage(core, groups)
    lone = connected(_only_fits(clusters).unionByName(_two_letters(clusters)))
    closed = stage(clusters.join(lone, F.col("cluster") == F.col("id"), "left").select(*CORE, F.coalesce("group_id", "cluster").alias("cluster")), "closed")
    drop_stage(clusters, lone)
    return closed


def _only_fits(clusters: DataFrame) -> DataFrame:
    """``(a, b)``: two clusters of one street number of which one lacks what would tell them apart.

    Under number, street and town: the state is missing in one. Under number, street
    and state: the town is missing in one, and no two ZIPs speak against it. Only where
    no third cluster has that number and street there.
    """
    facts = clusters.groupBy("cluster").agg(*[F.max(c).alias(f"any_{c}") for c in ("town", "zip5", "st")])
    keys = F.array_compact(F.array(*[F.when(F.col(c) != "", F.struct(F.lit(c).alias("by"), F.xxhash64("num", "street", c).alias("k"))) for c in ("town", "st")]))
    under = clusters.select("cluster", "num", F.explode(keys).alias("key")).select("cluster", "num", "key.by", "key.k").distinct()
    two = under.join(facts, "cluster").groupBy("by", "k", "num").agg(F.count("*").alias("n"), F.min(F.struct("cluster", "any_town", "any_zip5", "any_st")).alias("p"), F.max(F.struct("cluster", "any_town", "any_zip5", "any_st")).alias("q")).where("n = 2")
    lacks = lambda c: (F.col(f"p.any_{c}") == "") | (F.col(f"q.any_{c}") == "")
    fits = F.when(F.col("by") == "town", lacks("st")).otherwise(lacks("town") & (lacks("zip5") | (F.col("p.any_zip5") == F.col("q.any_zip5"))))
    return two.where(fits).select(F.col("p.cluster").alias("a"), F.col("q.cluster").alias("b"))


def _two_letters(clusters: DataFrame) -> DataFrame:
    """``(a, b)``: clusters whose streets, of eight letters or more, differ in two letters.

    They meet under number, place and the first or the last four letters of the
    street; only spellings that nothing has tied yet are compared.
    """
    street = F.col("street")
    ends = F.array(F.concat(F.lit("^"), F.substring(street, 1, 4)), F.concat(F.lit("$"), F.right(street, F.lit(4))))
    places = F.array_compact(F.array(F.when(F.col("zip5") != "", F.concat_ws("|", "zip5", "area")), F.when((F.col("town") != "") & (F.col("st") != ""), F.concat_ws("|", "st", "town"))))
    long = clusters.where((F.length(street) > 7) & ~street.rlike("^[0-9]")).select("cluster", "num", "street", F.explode(places).alias("place"), ends.alias("ends"))
    under = long.select("cluster", "num", "street", F.explode(F.transform("ends", lambda e: F.xxhash64("place", e))).alias("k")).distinct()
    mixed = under.groupBy("num", "k").agg((F.min("cluster") != F.max("cluster")).alias("mixed")).where("mixed")
    x = under.join(mixed, ["num", "k"], "left_semi")
    y = x.select("num", "k", F.col("cluster").alias("b"), F.col("street").alias("other"))
    return x.withColumnRenamed("cluster", "a").join(y.hint("merge"), ["num", "k"]).where((F.col("a") < F.col("b")) & (F.levenshtein("street", "other", 2) >= 0)).select("a", "b").distinct()


def _settled(placed: DataFrame) -> DataFrame:
    """``(form, cluster, pre, kind, unit)``: of several readings, the one that most other lines support.

    Support are other lines whose likeliest reading has the same street number and
    direction; ties go to the likelier reading.
    """
    support = placed.where("rank = 0").groupBy("cluster", "pre").agg(F.count("*").alias("n"))
    several = placed.where(F.col("form").contains(";")).join(support, ["cluster", "pre"], "left")
    others = F.coalesce("n", F.lit(0)) - F.when(F.col("rank") == 0, 1).otherwise(0)
    won = several.groupBy("form").agg(F.max_by(F.struct("cluster", *FINE), F.struct(others.alias("n"), -F.col("rank"))).alias("w"))
    one = placed.where(~F.col("form").contains(";")).select("form", "cluster", *FINE)
    return one.unionByName(won.select("form", "w.*"))


def _fit(triples: DataFrame) -> DataFrame:
    """``(cluster, pre, kind, unit, location)``: missing parts filled where only one location fits.

    A location is a combination that no other combination of the cluster completes.
    Every location is masked in all ways; a combination with missing parts finds the
    locations it fits under its own parts, and joins one if it is the only one.
    """
    masks = [[c for i, c in enumerate(FINE) if m >> i & 1] for m in range(1, 2 ** len(FINE))]

    def masked(df: DataFrame) -> DataFrame:
        some = [F.when(F.array_max(F.array(*[F.col(c) for c in m])) == "", None).when(sum((F.col(c) == "").cast("int") for c in m) > 0, None).otherwise(F.struct(*[(F.lit("") if c in m else F.col(c)).alias(c) for c in FINE])) for m in masks]
        return df.select("cluster", F.struct(*FINE).alias("full"), F.explode(F.filter(F.array(*some), lambda x: x.isNotNull())).alias("g")).select("cluster", "full", *[F.col(f"g.{c}").alias(c) for c in FINE])

    keys = ["cluster", *FINE]
    complete = triples.join(masked(triples).select(*keys).distinct(), keys, "left_anti")
    fits = masked(complete).groupBy(*keys).agg(F.count("*").alias("n"), F.min("full").alias("only")).where("n = 1")
    # Two that each lack what the other has, and nobody else in the cluster, are one.
    lone = complete.groupBy("cluster").agg(F.count("*").alias("n"), F.min(F.struct(*FINE)).alias("p"), F.max(F.struct(*FINE)).alias("q")).where("n = 2")
    agree = reduce(and_, [(F.col(f"p.{c}") == "") | (F.col(f"q.{c}") == "") | (F.col(f"p.{c}") == F.col(f"q.{c}")) for c in FINE])
    one = lone.where(agree).select("cluster", F.lit(True).alias("one"))
    chosen = triples.join(fits, keys, "left").join(one, "cluster", "left").withColumn("_f", F.coalesce("only", F.struct(*FINE)))
    own = F.concat_ws("|", F.col("cluster").cast("string"), *[F.col(f"_f.{c}") for c in FINE])
    return chosen.select(*keys, F.when(F.col("one"), F.col("cluster").cast("string")).otherwise(own).alias("location"))


def _directed(settled: DataFrame, wrote: DataFrame, attested: int) -> DataFrame:
    """``settled`` with ``-`` as direction where a street without one is a place of its own.

    A street always has a type, and a unit may go unsaid, but many streets have no
    direction: beside the same street with one, "no direction" is a value if at least
    ``attested`` writers say so independently, none of whom also writes a direction.
    """
    says = settled.join(wrote, "form").groupBy("cluster", "writer").agg(F.max(F.col("pre") == "").alias("without"), F.max(F.col("pre") != "").alias("with_"))
    own = says.groupBy("cluster").agg(((F.count_if("without") >= attested) & ~F.max(F.col("without") & F.col("with_"))).alias("own")).where("own")
    none = (F.col("pre") == "") & F.coalesce("own", F.lit(False))
    return settled.join(own, "cluster", "left").withColumn("pre", F.when(none, "-").otherwise(F.col("pre"))).drop("own")


def locate(rows: DataFrame, writer: Column, keep: Sequence[str] = ("id",), attested: int = 2) -> DataFrame:
    """``keep`` columns of rows whose address has a house number and a street, their ``form`` and ``location``.

    ``rows`` has address_line1, city, state and zip; other columns are not looked at.
    Rows share a location if street, number, town and unit agree. A part that is
    missing or misspelt does not part a row from the location that it otherwise
    fits, as long as only one fits; a row that fits several stays with rows of its own
    form. A street without a direction beside the same one with a direction is a place
    of its own if ``attested`` writers have it so (``writer`` says who wrote a row; a
    null one is nobody). House numbers must be equal. Rows whose line is null or has no
    number or no street have no location and are left out. Addresses that read alike
    count once.
    """
    adaptive(rows.sparkSession)
    # Read once, written, and used by all that follows.
    formed = stage(read(rows.withColumn("writer", writer), [*keep, "writer"]), "formed")
    lines = stage(formed.select("form").distinct(), "lines")
    clusters = _streets(_parts(lines))
    placed = stage(_parts(lines).join(clusters, [*CORE]).select("form", "rank", "cluster", *FINE), "placed")
    wrote = formed.select("form", "writer").where("writer is not null").distinct()
    settled = stage(_directed(_settled(placed), wrote, attested), "settled")
    drop_stage(lines, clusters, placed)
    fitted = _fit(settled.select("cluster", *FINE).distinct())
    of_form = stage(settled.join(fitted, ["cluster", *FINE]).select("form", "location"), "locations")
    drop_stage(settled)
    return formed.drop("writer").join(of_form, "form")


def location_pairs(located: DataFrame, key: str = "id") -> DataFrame:
    """``(a, b)`` with a < b for rows of one location; as many as the result is to hold."""
    x = located.select("location", F.col(key).alias("a"))
    y = located.select("location", F.col(key).alias("b"))
    return x.join(y, "location").where("a < b").select("a", "b")


def premises(located: DataFrame, key: str = "id") -> DataFrame:
    """``(id, location_id, n_rows)``: one row per record; the location's id is its least record id."""
    named = located.groupBy("location").agg(F.min(key).alias("location_id"), F.count("*").alias("n_rows"))
    return located.select(F.col(key).alias("id"), "location").join(named, "location").select("id", "location_id", "n_rows")
