"""Physical plans: what must reach the scan, and what must not happen."""

import pytest

from tallyhouse.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_plan_pairs_everything_or_leaves_the_jvm(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name, pushed", [
    ("flt_gt", "GreaterThan(o_totalprice,300000.0)"),
    ("flt_sql_string", "GreaterThan(p_size,21)"),
    ("flt_range_like", "StringStartsWith(p_name,h)"),
    ("flt_eq", "EqualTo(n_name,NATION_3)"),
    ("flt_isin", "In(c_mktsegment, [AUTOMOBILE,FURNITURE])"),
    ("job_recent", "GreaterThanOrEqual(o_orderdate,2001-07-03T00:00)"),
])
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan_of(spark, name)


@pytest.mark.parametrize("name, columns", [
    ("job_word_count", "struct<text:string>"),
    ("agg_count_by_key", "struct<event_type:string>"),
    ("agg_count_by", "struct<o_custkey:bigint>"),
    ("join_kv_inner", "struct<l_orderkey:bigint,l_quantity:double>"),
])
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: {columns}" in plan_of(spark, name)


@pytest.mark.parametrize("name", ["win_first_per_key", "agg_drop_duplicates"])
def test_rows_per_key_are_limited_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


@pytest.mark.parametrize("name", ["top_largest", "top_smallest", "top_take", "job_top_words"])
def test_top_rows_need_no_full_sort(spark, name):
    plan = plan_of(spark, name)
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("name", [
    "win_surrogate_id", "srt_by_key", "srt_expr", "srt_two_cols", "srt_city_rows", "srt_desc_count", "agg_group_values",
])
def test_numbering_never_gathers_the_rows(spark, name):
    """Numbers come from the ranges' counts: no window runs in a single task, and each is inside a range or key."""
    plan = plan_of(spark, name)
    assert "SinglePartition" not in plan and ("Window [row_number()" in plan or "Window [sum(_n" in plan)


def test_rejects_need_no_category_or_place(spark):
    plan = QUERIES["src_transaction_rejects"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "reason" in plan
    assert not any(word in plan for word in ("categoria", "geolocalizacion", "momento", "seguros", "make_dt_interval"))


def test_a_line_is_split_once(spark):
    plan = QUERIES["src_delimited"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


@pytest.mark.parametrize("name", ["job_card_mean", "agg_count_by", "job_word_count", "set_intersect", "job_suspicious_same_city"])
def test_groups_are_combined_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    bottom = plan[plan.rindex("hashpartitioning"):] if "hashpartitioning" in plan else plan
    assert "HashAggregate" in bottom
