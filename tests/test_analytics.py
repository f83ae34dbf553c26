"""Report analytics on tiny gold tables (FIXTURES.md section 6)."""

import pytest
from pyspark.sql import functions as F

from triplake.operators import analytics

MONTH_SCHEMA = (
    "pickup_year int, pickup_month int, trip_count bigint, total_revenue double, avg_fare double, "
    "avg_distance_miles double, avg_duration_min double, avg_passengers double"
)
COUNTS = [(2019, 11, 90), (2019, 12, 100), (2020, 1, 95), (2020, 2, 90), (2020, 3, 50),
          (2020, 4, 10), (2020, 5, 60), (2020, 6, 79), (2020, 7, 80)]


def months(spark, counts=COUNTS):
    rows = [(y, m, n, n * 20.0, 20.0 + m, 3.0 + y - 2019, 15.5, 1.5) for y, m, n in counts]
    return spark.createDataFrame(rows, MONTH_SCHEMA)


def zones(spark, revenues):
    rows = [(i + 1, 10 * (len(revenues) - i), float(r), 1.0, 1.0) for i, r in enumerate(revenues)]
    return spark.createDataFrame(
        rows, "zone_id bigint, pickups bigint, total_revenue double, avg_fare double, avg_distance_miles double"
    )


def test_recovery_found(spark):
    r = analytics.recovery(months(spark)).first()
    assert r.pre_peak == 100 and r.threshold == 80.0
    assert r.trough_label == "April 2020" and r.trough_trips == 10
    assert r.recovery_label == "July 2020"
    assert r.trough_drop_pct == 90


def test_not_yet_recovered(spark):
    r = analytics.recovery(months(spark, COUNTS[:-1])).first()
    assert r.recovery_label is None and r.recovery_text == "Not yet recovered"


def test_no_pre_period(spark):
    r = analytics.recovery(months(spark, [c for c in COUNTS if c[0] >= 2020])).first()
    assert r.pre_peak is None and r.recovery_label is None


@pytest.mark.parametrize(
    "revenues,within,pct",
    [([50, 30, 15, 5], 2, 50.0), ([50, 29, 16, 5], 2, 50.0), ([50, 31, 14, 5], 1, 25.0)],
)
def test_pareto_80(spark, revenues, within, pct):
    curve = analytics.pareto_curve(zones(spark, revenues))
    rows = sorted(curve.collect(), key=lambda r: r.zone_rank)
    assert rows[-1].cum_pct == pytest.approx(100.0)
    assert [r.zone_rank for r in rows] == [1, 2, 3, 4]
    assert rows[0].zone_pct == 25.0
    r = analytics.pareto_80(curve).first()
    assert (r.zones, r.zones_within, r.pct_zones_for_share) == (4, within, pct)


def test_pareto_80_share_rounds_like_python(spark):
    # one zone of sixteen within 80 %: 6.25 % is a tie, Python's round gives 6.2
    out = analytics.pareto_80(analytics.pareto_curve(zones(spark, [160] + [3] * 12 + [2, 1, 1]))).first()
    assert (out.zones_within, out.pct_zones_for_share) == (1, round(1 / 16 * 100, 1)) == (1, 6.2)


def test_pareto_many_slices(spark):
    # more zones than partitions: offsets across slices must chain correctly
    revenues = [1000 - i for i in range(500)]
    rows = sorted(analytics.pareto_curve(zones(spark, revenues).repartition(7)).collect(), key=lambda r: r.zone_rank)
    total = sum(revenues)
    running = 0
    for i, r in enumerate(rows):
        running += revenues[i]
        assert r.zone_rank == i + 1
        assert r.cum_pct == pytest.approx(running / total * 100)


def test_top_zones_tie_break(spark):
    rows = [(z, 100 - z if z < 14 else 80, 1.0, 1.0, 1.0) for z in range(1, 20)]
    df = spark.createDataFrame(rows, "zone_id bigint, pickups bigint, total_revenue double, avg_fare double, avg_distance_miles double")
    top = analytics.top_zones(df, 15).collect()
    assert len(top) == 15
    assert [r.zone_id for r in top][-2:] == [14, 15]  # equal pickups: lower id first


def test_top_zones_plan_is_take_ordered(spark):
    df = zones(spark, [5, 4, 3])
    plan = analytics.top_zones(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_month_extremes_ties_take_earliest(spark):
    m = months(spark, [(2019, 1, 5), (2019, 2, 9), (2019, 3, 9), (2019, 4, 1), (2019, 5, 1)])
    r = {x.metric: x for x in analytics.month_extremes(m).collect()}
    assert (r["peak"].pickup_month, r["trough"].pickup_month) == (2, 4)
    assert r["peak"].period_label == "February 2019"


def test_month_series_bounds_and_order(spark):
    m = months(spark)
    out = analytics.month_series(m, min_year=2020, last_month="2020-05").collect()
    assert [(r.pickup_year, r.pickup_month) for r in out] == [(2020, i) for i in range(1, 6)]
    assert out[0].period_label == "2020-01"


def test_month_window_keeps_the_series_rows_without_a_sort(spark):
    m = months(spark)
    window = analytics.month_window(m, min_year=2020, last_month="2020-05")
    assert sorted(window.collect()) == sorted(analytics.month_series(m, min_year=2020, last_month="2020-05").collect())
    from triplake.plans.inspect import plan_text

    assert "Sort" not in plan_text(window) and "Sort" in plan_text(analytics.month_series(m))


def test_yearly_means_are_unweighted(spark):
    m = months(spark)
    fares = {r.year: r.avg_fare for r in analytics.yearly_fare(m).collect()}
    assert fares[2019] == pytest.approx((20 + 11 + 20 + 12) / 2)
    w = analytics.weighted_avg_fare(m).first()
    expect = sum((20.0 + mm) * n for _, mm, n in COUNTS) / sum(n for *_, n in COUNTS)
    assert w.avg_fare_overall == pytest.approx(expect)


def test_first_latest_change(spark):
    r = analytics.first_latest_change(months(spark)).first()
    assert (r.first_year, r.latest_year) == (2019, 2020)
    assert r.dist_change == 1.0 and r.dist_trend == "+1.0 mi"


def time_gold(spark):
    rows = [(h, d, (h + 1) * d, 10.0, 20.0) for h in range(24) for d in range(1, 8)]
    return spark.createDataFrame(
        rows, "pickup_hour int, pickup_day_of_week int, trip_count bigint, avg_duration_min double, avg_fare double"
    )


def test_heatmap_pivot(spark):
    rows = {r.pickup_hour: r for r in analytics.demand_heatmap(time_gold(spark)).collect()}
    assert len(rows) == 24
    assert rows[5].Sun == 6 and rows[5].Sat == 42 and rows[5].hour_label == "05:00"


def test_weekday_weekend(spark):
    out = {(r.pickup_hour, r.is_weekend): r.trip_count for r in analytics.weekday_weekend_by_hour(time_gold(spark)).collect()}
    assert out[(0, True)] == 1 + 7 and out[(0, False)] == 2 + 3 + 4 + 5 + 6


def test_cell_extremes(spark):
    r = {x.metric: x for x in analytics.cell_extremes(time_gold(spark)).collect()}
    assert (r["busiest"].pickup_hour, r["busiest"].day_name) == (23, "Sat")
    assert (r["quietest"].pickup_hour, r["quietest"].day_name) == (0, "Sun")
    assert r["weekday_peak_hour"].hour_label == "23:00"


def test_insights_table(spark):
    out = analytics.insights(months(spark), time_gold(spark)).orderBy("position").collect()
    assert len(out) == 10
    assert out[0].value == "December 2019 — 100 trips"
    assert out[1].value == "April 2020 — 10 trips (−90% vs pre-COVID peak)"
    assert out[2].value.startswith("July 2020")
    assert out[7].value == "00:00 on Sun"
    assert out[9].metric == "Avg trip distance change (2019→2020)"


def test_insights_without_weekend_trips(spark):
    weekdays = time_gold(spark).where(~F.col("pickup_day_of_week").isin(1, 7))
    out = analytics.insights(months(spark), weekdays).orderBy("position").collect()
    assert len(out) == 10 and out[0].value == "December 2019 — 100 trips"
    assert out[5].value is not None and out[6].value is None  # no weekend: no weekend peak hour
    assert not out[7].value.endswith("Sun") and not out[7].value.endswith("Sat")


def test_fixed_decimals_round_like_python(spark):
    from triplake.functions.labels import fixed

    values = [2.675, 0.125, 0.625, 10.125, 1.005, 2.345, 1234567.125, -2.675, 0.0, 38123.455]
    got = [r.t for r in spark.createDataFrame([(v,) for v in values], "x double").select(fixed("x", 2).alias("t")).collect()]
    assert got == [f"{v:.2f}" for v in values]


def test_python_round_matches_python_on_ties(spark):
    from triplake.functions.measures import python_round

    values = [0.15, 0.25, 0.35, 2.675, 1.005, -0.15, 12.345, -2.25, 0.05, 7.45, -3.55, 123456.75, 87.5, 88.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for n in (0, 1, 2):
        got = [r.y for r in df.select(python_round("x", n).alias("y")).collect()]
        assert got == [float(round(v, n)) for v in values]


def test_numpy_round_matches_numpy_on_ties(spark):
    import numpy as np
    from triplake.functions.measures import numpy_round

    values = [0.15, 0.25, 0.35, 2.675, 1.005, -0.15, 12.345, -2.25, 0.05, 7.45, -3.55, 123456.75]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for n in (1, 2):
        got = [r.y for r in df.select(numpy_round("x", n).alias("y")).collect()]
        assert got == [float(round(np.float64(v), n)) for v in values]


def test_display_orders_and_chart(spark):
    top = analytics.top_zones(zones(spark, [5, 9, 7, 1]), 3, ascending_for_display=True).collect()
    assert [r.pickups for r in top] == sorted(r.pickups for r in top)
    cells = analytics.cells_in_week_order(time_gold(spark)).collect()
    assert (cells[0].pickup_day_of_week, cells[0].pickup_hour, cells[1].pickup_hour) == (1, 0, 1)
    chart = analytics.monthly_chart(analytics.month_series(months(spark))).collect()
    assert chart[0].period_label == "2019-11" and chart[0].trips_millions == 90 / 1e6
