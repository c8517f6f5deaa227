"""Every registered query next to its SQL, on the small tables."""

import pytest

import __spark_entry__ as entry
from tools.check import compare, judge

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def db(small):
    return judge(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, small, name):
    df = QUERIES[name](spark, small)
    if name in SQL:
        assert compare(df, db.sql(SQL[name])) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 3
    assert set(SQL) <= set(QUERIES)
