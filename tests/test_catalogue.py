"""Every query of the core against its SQL twin, and plans without Python."""

import pytest

from kinlattice.plans import examples, figures, pipeline, reports, resolution
from tests.conftest import DATA, same_rows

QUERIES = {k: (f, c.ORACLE.get(k)) for c in (examples, figures, resolution, pipeline, reports) for k, f in c.QUERIES.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    query, sql = QUERIES[name]
    df = query(spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"))
    if sql:
        same_rows(df, duck.execute(sql).df())
    else:
        assert df.count() > 0


def test_entry_point(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns
    assert set(e.oracle_sql()) <= set(e.queries())
