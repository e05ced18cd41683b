"""The DataFrame form and the same question as SQL text in Spark give the same rows."""

import pytest

from conftest import rows
from loomgrain.queries import QUERIES, runner

# SQL texts that use no function or literal spelling of one engine only
PORTABLE = """
select_cols where_ge eq neq in_list not_in_list like not_like between gt ge lt le is_null is_not_null bool_logic
sql_predicate add_column literal_column drop_column alias_column case_when distinct_rows dedup_rows project_contract
apply_by_type expr_column sql_query inner_join left_join right_join full_join multi_join exists_semi not_exists_anti
broadcast_join lookup_left_broadcast bridge_fact_join orphan_check filter_then_join skew_join count_star count_col
sum_total avg_round sum_coalesce max_min_num group_by group_by_join having row_count preagg_join distinct_keys
row_number first_value last_value ntile_global lag lead latest_per_key top_n_per_group order_asc order_desc
order_multi limit top_k union_distinct union_all intersect except substring concat concat_ws lower upper trim ltrim
rtrim charindex left right reverse replace length coalesce round upper_trim lower_trim duplicate_key_check
repartition_by_key temp_view cdc_apply
""".split()


@pytest.mark.parametrize("key", PORTABLE)
def test_frame_and_sql_agree(key, spark, folder, tables):
    tables.view("nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")
    frame = runner(QUERIES[key].build)(spark, folder)
    text = spark.sql(QUERIES[key].sql)
    assert sorted(frame.columns) == sorted(text.columns)
    assert rows(frame) == rows(text)
