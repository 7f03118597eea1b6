"""Every registered query against the same question asked in SQL."""

import pytest

import __spark_entry__ as entry
import oracle_sql
from tests.compare import difference, duck, duck_table, spark_table
from tests.conftest import SF_SMALL

QUERIES, ORACLES = entry.trade_queries(), oracle_sql.all_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = spark_table(QUERIES[name](spark, SF_SMALL))
    assert difference(got, duck_table(con, ORACLES[name])) is None


@pytest.mark.parametrize("scale", ["0.001", "0.01", "0.1"])
def test_fixture_dimensions_are_complete(scale):
    """The adapter leaves out joins nobody needs; that rests on complete, unique keys."""
    con = duck(f"/root/testdata/sf{scale}")
    joined = con.execute(
        """select count(*) from lineitem join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey
        join part on l_partkey = p_partkey join nation rn on s_nationkey = rn.n_nationkey
        join nation pn on c_nationkey = pn.n_nationkey"""
    ).fetchone()
    assert joined == con.execute("select count(*) from lineitem").fetchone()
