"""Every query against its SQL oracle, on plain and on skewed tables."""

import pytest

import __spark_entry__ as entry
from milepost.checks import oracle as registered_sql
from milepost.checks import queries as registered
from milepost.checks.compare import difference, oracle_connection

QUERIES = registered.queries()
ORACLE = registered_sql.oracle_sql()

# queries whose keys the skewed tables below make hot
SKEWED = [
    name for name in QUERIES
    if name.startswith(("mv_", "v_", "dedup_", "topk", "join_", "agg_", "dq_", "trips_inc", "unpivot"))
]


@pytest.fixture(scope="module")
def oracle(small):
    return oracle_connection(small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) == 83
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLE.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, small, oracle, name):
    assert difference(QUERIES[name](spark, small), oracle, ORACLE[name]) is None


@pytest.fixture(scope="module")
def skewed_dir(spark, small, tmp_path_factory):
    """A third of all trips by one driver and vehicle, a third of all events in one trip."""
    import shutil

    import duckdb

    folder = tmp_path_factory.mktemp("skewed")
    for name in ("region", "nation", "customer", "supplier", "part", "events", "documents"):
        shutil.copy(f"{small}/{name}.parquet", folder)
    con = duckdb.connect()
    con.execute(f"""
        COPY (SELECT * REPLACE (
                CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey,
                CASE WHEN o_orderkey % 3 = 0 THEN 1000000004 + o_orderkey * 1000 ELSE o_orderkey END AS o_orderkey)
              FROM '{small}/orders.parquet') TO '{folder}/orders.parquet'""")
    con.execute(f"""
        COPY (SELECT * REPLACE (
                CASE WHEN l_partkey % 3 = 0 THEN 1000006004 WHEN l_orderkey % 3 = 0
                     THEN 1000000004 + l_orderkey * 1000 ELSE l_orderkey END AS l_orderkey,
                CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey)
              FROM '{small}/lineitem.parquet') TO '{folder}/lineitem.parquet'""")
    return str(folder)


@pytest.mark.parametrize("name", SKEWED)
def test_matches_oracle_with_hot_keys(spark, skewed_dir, name):
    con = oracle_connection(skewed_dir)
    assert difference(QUERIES[name](spark, skewed_dir), con, ORACLE[name]) is None
