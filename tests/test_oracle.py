"""Every registered query against its DuckDB oracle on the smallest tables."""
import os

import pytest

from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def _names():
    import __spark_entry__ as E
    return list(E.queries())


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    res = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert res["status"] in ("ok", "rows-only"), res


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["product_category", "review_count", "avg_rating"]
    assert df.count() >= 0
