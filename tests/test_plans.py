"""Plan assertions: pushdown, pruning, no Python in the hot path, no
single-task or cross-product shapes where the data can grow."""

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from triplake.operators import analytics, gold
from triplake.plans.inspect import plan_text
from triplake.plans.materialize import materialize

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas")
CROSS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def test_silver_pushes_bounds_and_prunes(spark):
    plan = plan_text(entry._l_silver(spark, SF_SMALL))
    scan = plan.split("Scan parquet")[-1].split("\n\n")[0]
    assert "GreaterThanOrEqual(l_shipdate,1995-01-01T00:00)" in scan
    assert "LessThan(l_extendedprice,100000.0)" in scan
    assert "l_comment" not in scan and "l_returnflag" not in scan  # unused columns pruned


def test_gold_is_partial_aggregation_without_python(spark):
    for build in (gold.trips_by_month, gold.trips_by_zone, gold.time_patterns):
        df = build(entry._l_silver(spark, SF_SMALL))
        df.collect()  # AQE shows the final (codegen) plan after execution
        plan = plan_text(df)
        assert "partial_count" in plan and "partial_sum" in plan
        assert not any(n in plan for n in PY_NODES)
        assert "isFinalPlan=true" in plan and "[codegen id : 1]" in plan


def test_pareto_window_is_partitioned_by_slice(spark):
    plan = plan_text(analytics.pareto_curve(entry._l_zone(spark, SF_SMALL)), "extended")
    assert "windowspecdefinition(_slice" in plan
    assert not any(n in plan for n in CROSS)


def test_report_analytics_have_no_cross_products(spark):
    month, tp = entry._gm(spark, SF_SMALL), materialize(entry._e_time(spark, SF_SMALL))
    for df in (
        analytics.insights(month, tp),
        analytics.recovery(month),
        analytics.month_extremes(month),
        analytics.cell_extremes(tp),
        analytics.first_latest_change(month),
    ):
        plan = plan_text(df)
        assert not any(n in plan for n in CROSS), plan[:2000]
        assert not any(n in plan for n in PY_NODES)


def test_events_filter_stays_cheap(spark):
    plan = plan_text(entry._e_silver(spark, SF_SMALL), "simple")
    assert "get_json_object" not in plan and "from_json" not in plan


def test_materialize_all_matches_sequential_and_keeps_job_group(spark):
    from triplake.plans.materialize import materialize_all

    month, time_gold = entry._l_month(spark, SF_SMALL), entry._e_time(spark, SF_SMALL)
    sc = spark.sparkContext
    sc.setJobGroup("triplake-test-group", "concurrent materialize")
    tracker = sc.statusTracker()
    try:
        before = set(tracker.getJobIdsForGroup("triplake-test-group"))
        got = materialize_all(month, time_gold)
        after = set(tracker.getJobIdsForGroup("triplake-test-group"))
    finally:
        sc.setJobGroup("", "")
    assert len(after - before) >= 2  # the threads' jobs carry the caller's group
    for g, df in zip(got, (month, time_gold)):
        assert sorted(g.collect()) == sorted(materialize(df).collect())
