"""What the physical plans must and must not contain (test_oracles checks every plan for all-pairs joins)."""

import pytest

from loomgrain.queries import QUERIES, runner


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def built(key, spark, folder):
    return runner(QUERIES[key].build)(spark, folder)


@pytest.mark.parametrize(
    "key, pushed, columns",
    [
        ("where_ge", "GreaterThanOrEqual(c_acctbal,3000.0)", "struct<c_custkey:bigint,c_acctbal:double>"),
        ("eq", "EqualTo(c_mktsegment,BUILDING)", "struct<c_custkey:bigint,c_name:string,c_mktsegment:string>"),
        ("like", "StringStartsWith(p_name,s)", "struct<p_partkey:bigint,p_name:string>"),
        ("date_compare", "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)", "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>"),
        ("filter_then_join", "GreaterThanOrEqual(p_retailprice,910.0)", "struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>"),
    ],
)
def test_filters_and_columns_reach_the_scan(key, pushed, columns, spark, folder):
    text = plan(built(key, spark, folder))
    assert pushed in text and f"ReadSchema: {columns}" in text


@pytest.mark.parametrize("key", ["column_pruning", "sum_total", "bridge_fact_join", "count_star"])
def test_no_scan_reads_all_columns(key, spark, folder):
    text = plan(built(key, spark, folder))
    assert "l_shipdate" not in text and "o_orderpriority" not in text


@pytest.mark.parametrize("key", ["ntile_global", "lag", "lead", "row_number", "rank", "dense_rank"])
def test_no_window_pulls_the_table_into_one_task(key, spark, folder):
    text = plan(built(key, spark, folder))
    # a single-task exchange may only carry the summary, which is aggregated per part
    for block in text.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate" in block or "SortAggregate" in block or "ObjectHashAggregate" in block


@pytest.mark.parametrize("key", ["latest_per_key", "top_n_per_group"])
def test_groups_are_cut_before_the_shuffle(key, spark, folder):
    assert "WindowGroupLimit" in plan(built(key, spark, folder))


@pytest.mark.parametrize("key", ["top_k", "first_row", "limit", "show_rows"])
def test_limits_do_not_sort_the_whole_table(key, spark, folder):
    assert "TakeOrderedAndProject" in plan(built(key, spark, folder))


@pytest.mark.parametrize("key", ["exists_semi", "distinct_keys"])
def test_semi_join(key, spark, folder):
    assert "LeftSemi" in plan(built(key, spark, folder))
