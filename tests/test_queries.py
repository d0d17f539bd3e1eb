"""Every registered query against its SQL oracle, on whole tables."""

import pytest

import __spark_entry__ as entry_point
import oracle

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert oracle.differences(result, duck, ORACLES[name]) == []
    else:
        assert result.count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["town", "total_customer"]


def test_no_oracle_without_query():
    assert set(ORACLES) <= set(QUERIES)


def test_foreign_keys_of_the_test_tables(sf_dir, duck):
    """The derived sales skip joins that add no column: each must match exactly once."""
    links = {
        "lineitem": [("l_partkey", "part", "p_partkey"), ("l_orderkey", "orders", "o_orderkey")],
        "orders": [("o_custkey", "customer", "c_custkey")],
        "customer": [("c_nationkey", "nation", "n_nationkey")],
    }
    for child, keys in links.items():
        (rows,) = duck.execute(f"SELECT count(*) FROM {child}").fetchone()
        for key, parent, parent_key in keys:
            joined = duck.execute(f"SELECT count(*) FROM {child} JOIN {parent} ON {key} = {parent_key}")
            assert joined.fetchone() == (rows,)
