import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    import glob

    import duckdb

    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


def same_rows(got, want) -> None:
    """Rows of a Spark DataFrame and a pandas frame, in any order."""
    a = got.toPandas()
    assert sorted(a.columns) == sorted(want.columns)
    cols = sorted(a.columns)
    for frame in (a, want):  # one engine gives dates, the other timestamps at midnight
        for c in cols:
            if str(frame[c].dtype).startswith("datetime64"):
                frame[c] = frame[c].dt.date
    plain = lambda x: sorted(map(repr, x[cols].astype(object).where(x[cols].notna(), None).itertuples(index=False, name=None)))
    assert plain(a) == plain(want)
