"""Report figures on random month series against a direct reading of the
report's rules (first row wins ties, search only after the trough)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from triplake.operators import analytics

MONTH_SCHEMA = (
    "pickup_year int, pickup_month int, trip_count bigint, total_revenue double, avg_fare double, "
    "avg_distance_miles double, avg_duration_min double, avg_passengers double"
)
PRE_PERIOD_END = 2020
CALENDAR = [(y, m) for y in range(2018, 2022) for m in range(1, 13)]

# a subset of 2018-2021 months, each with a small trip count (ties are common)
series = st.lists(
    st.tuples(st.sampled_from(CALENDAR), st.integers(1, 12), st.integers(1, 5)),
    min_size=1,
    max_size=30,
    unique_by=lambda t: t[0],
)


def _label(year, month):
    return dt.date(year, month, 1).strftime("%B %Y")


def _expected(rows):
    """rows: [(year, month, trips, revenue)] in month order."""
    first_max = lambda key: max(range(len(rows)), key=lambda i: (key(rows[i]), -i))
    first_min = lambda key: min(range(len(rows)), key=lambda i: (key(rows[i]), i))
    peak, trough, best = first_max(lambda r: r[2]), first_min(lambda r: r[2]), first_max(lambda r: r[3])
    pre = [r[2] for r in rows if r[0] < PRE_PERIOD_END]
    pre_peak = max(pre) if pre else None
    recovered = None
    if pre_peak is not None:
        later = [r for r in rows[trough + 1 :] if r[2] >= pre_peak * 0.8]
        recovered = _label(later[0][0], later[0][1]) if later else None
    drop = None if pre_peak is None else round((1 - rows[trough][2] / pre_peak) * 100)
    return {
        "extremes": {name: rows[i][:2] for name, i in (("peak", peak), ("trough", trough), ("best_revenue", best))},
        "recovery": (pre_peak, _label(*rows[trough][:2]), rows[trough][2], drop, recovered,
                     recovered or "Not yet recovered"),
    }


@settings(max_examples=6, deadline=None)
@given(series)
def test_extremes_and_recovery_match_the_report_rules(spark, picks):
    rows = sorted((y, m, trips, float(rev * 100)) for (y, m), trips, rev in picks)
    gold = spark.createDataFrame(
        [(y, m, n, rev, 10.0, 2.0, 15.0, 1.5) for y, m, n, rev in rows], MONTH_SCHEMA
    ).repartition(3)
    want = _expected(rows)
    got = {r.metric: (r.pickup_year, r.pickup_month) for r in analytics.month_extremes(gold).collect()}
    assert got == want["extremes"]
    r = analytics.recovery(gold, PRE_PERIOD_END, materialize_input=False).first()
    assert (r.pre_peak, r.trough_label, r.trough_trips, r.trough_drop_pct, r.recovery_label, r.recovery_text) == (
        want["recovery"]
    )


TIME_SCHEMA = "pickup_hour int, pickup_day_of_week int, trip_count bigint, avg_duration_min double, avg_fare double"
CELLS = [(h, d) for d in range(1, 8) for h in range(24)]

time_series = st.lists(
    st.tuples(st.sampled_from(CELLS), st.integers(1, 4)), min_size=1, max_size=60, unique_by=lambda t: t[0]
)


@settings(max_examples=6, deadline=None)
@given(time_series)
def test_cell_extremes_match_the_report_rules(spark, picks):
    # the report reads cells in (day of week, hour) order and sums hours per weekday/weekend, by hour
    cells = sorted(((d, h), n) for (h, d), n in picks)
    busiest = max(range(len(cells)), key=lambda i: (cells[i][1], -i))
    quietest = min(range(len(cells)), key=lambda i: (cells[i][1], i))
    hours = {True: {}, False: {}}
    for (d, h), n in cells:
        side = hours[d in (1, 7)]
        side[h] = side.get(h, 0) + n
    want = {
        "busiest": (cells[busiest][0][1], cells[busiest][0][0], cells[busiest][1]),
        "quietest": (cells[quietest][0][1], cells[quietest][0][0], cells[quietest][1]),
    }
    for weekend, name in ((False, "weekday_peak_hour"), (True, "weekend_peak_hour")):
        if hours[weekend]:
            h = max(sorted(hours[weekend]), key=lambda k: (hours[weekend][k], -k))
            want[name] = (h, None, hours[weekend][h])
    gold = spark.createDataFrame([(h, d, n, 10.0, 15.0) for (d, h), n in cells], TIME_SCHEMA).repartition(3)
    got = {r.metric: (r.pickup_hour, r.pickup_day_of_week, r.trip_count) for r in analytics.cell_extremes(gold).collect()}
    assert got == want
