"""The queries of the subpackage on the smallest tables; SQL twins where there are any."""

import pytest

from kinlattice.llm import queries
from tests.conftest import DATA, same_rows


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    if name in queries.ORACLE:
        same_rows(df, duck.execute(queries.ORACLE[name]).df())
    else:
        assert df.count() > 0 and len(set(df.columns)) == len(df.columns)
