"""Every registered query against its SQL twin."""
import pytest

import __spark_entry__ as entry
import oracle

SF = "/root/testdata/sf0.01"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, con):
    status, n, _, note = oracle.compare(name, spark, SF, con, QUERIES, ORACLES)
    assert status in ("ok", "rows"), note


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["region", "month", "rank", "lines", "revenue"]
