import pytest

import __spark_entry__ as entry
from compare import difference, duck

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["split"] for r in rows} == {"train", "valid", "test"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = con.execute(ORACLE[name]).fetchdf()
    assert len(want) > 0
    assert difference(got, want) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
