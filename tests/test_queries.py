import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.check_oracles import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    ok, message = compare(spark, duck, name, queries()[name], oracle_sql().get(name), SF)
    assert ok, message


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["id", "fid", "label", "overlap_area"] and df.count() > 0
