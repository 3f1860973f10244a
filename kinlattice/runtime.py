"""What operators need of the session: tables, shared folder, adaptive plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Runtime re-planning that the operators count on: AQE splits partitions that
#: one hot key has made large, and turns joins with a side that proved small
#: into broadcasts.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``root``."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def adaptive(spark: SparkSession) -> SparkSession:
    """The session with AQE and its skew-join splitting switched on."""
    for key, value in ADAPTIVE.items():
        if spark.conf.get(key, value) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share.

    It is ``spark.checkpoint.dir`` of the session. Only where that is unset and
    the session runs in one process is a temporary folder made and remembered.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="kinlattice-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and
    the size of what was written is known to the planner.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._kinlattice_path = path  # noqa: SLF001
    return staged


def held_by(staged: DataFrame, df: DataFrame) -> DataFrame:
    """``df``, which reads ``staged``: dropping it drops what was staged."""
    df._kinlattice_path = staged._kinlattice_path  # noqa: SLF001
    return df


def drop_stage(*staged: DataFrame) -> None:
    """Deletes what :func:`stage` wrote for them; nothing may read it any more."""
    for df in staged:
        path = getattr(df, "_kinlattice_path", None)
        if path:
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def hadoop(spark: SparkSession, path: str):
    """``(file system, path)`` of the JVM for any store the session can reach."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_bytes(spark: SparkSession, path: str, content: bytes, overwrite: bool = False) -> None:
    """A small file; one that exists is an error unless ``overwrite``."""
    fs, p = hadoop(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
