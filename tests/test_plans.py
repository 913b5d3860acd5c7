"""Plan-shape checks: pushdown, no unexpected products, partial aggregation."""

from conftest import SF_SMALL
from insight.plans.registry import load_all


def plan_of(spark, name):
    plans, _ = load_all()
    df = plans[name](spark, SF_SMALL)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark):
    p = plan_of(spark, "guest_origin_top5_numeric")
    assert "CartesianProduct" not in p
    # only the columns the plan reads are scanned
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double" in p
    # and cancelled lines are left out there
    assert "Not(EqualTo(l_returnflag,R))" in p


def test_nation_filter_reaches_the_scan(spark):
    assert "EqualTo(c_nationkey,7)" in plan_of(spark, "count_country_7")


def test_year_filter_is_a_pushed_date_range(spark):
    p = plan_of(spark, "year_price_by_month")
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01" in p and "LessThan(o_orderdate,1" in p


def test_column_pruning_on_fact_scan(spark):
    p = plan_of(spark, "avg_rate")
    scans = [line for line in p.splitlines() if "lineitem.parquet" in line]
    assert scans and all("l_comment" not in s and "l_suppkey" not in s for s in scans)


def test_top_n_per_group_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in plan_of(spark, "stay_length_top5_per_group")


def test_no_cartesian_products_anywhere(spark):
    plans, _ = load_all()
    for name in plans:
        p = plans[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in p, name
