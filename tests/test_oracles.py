"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

from loomgrain.queries import QUERIES, runner

TABLES = "region nation customer supplier part orders lineitem events documents labels".split()


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def in_order(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(r[i] for i in order) for r in records]
    return sorted(picked, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_same_rows_as_sql(key, spark, folder, duck):
    query = QUERIES[key]
    assert query.sql is not None
    result = runner(query.build)(spark, folder)
    cursor = duck.execute(query.sql)
    names = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(names)
    expected = in_order(names, cursor.fetchall())
    assert in_order(result.columns, [tuple(r) for r in result.collect()]) == expected
    assert expected, "the query should have rows on the test data"
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert key == "zip_csv_scan" or not ("Python" in plan or "InPandas" in plan)


ORDERS = {
    "order_asc": lambda r: (r["c_acctbal"], r["c_custkey"]),
    "order_desc": lambda r: (-r["p_retailprice"], -r["p_partkey"]),
    "order_multi": lambda r: ([-ord(x) for x in r["o_orderpriority"]], r["o_totalprice"], r["o_orderkey"]),
    "limit": lambda r: r["c_custkey"],
    "top_k": lambda r: (-r["o_totalprice"], r["o_orderkey"]),
}


@pytest.mark.parametrize("key", ORDERS)
def test_rows_come_in_order(key, spark, folder):
    found = runner(QUERIES[key].build)(spark, folder).collect()
    assert found == sorted(found, key=ORDERS[key])
