"""Report analytics over the gold tables.

Gold is small next to silver (one row per month, zone or hour x weekday
cell), but nothing here assumes it fits one task: single-row results are
global aggregations (partial per task, tiny final merge), per-row context is
attached through scalar subqueries, and the cumulative Pareto share is a
distributed prefix sum (``triplake.functions.ordered.running_totals``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplake.config import next_month, parse_month
from triplake.functions.labels import DAY_NAMES, day_name, fixed, hour_label, is_weekend, millions
from triplake.functions.measures import mean_of_quanta, numpy_round, python_round, quanta, ratio
from triplake.functions.ordered import argmax_row, argmin_row, running_totals
from triplake.functions.timecols import long_month_label, month_key, month_label, month_start
from triplake.plans.materialize import materialize, materialize_all


def with_period(month_gold: DataFrame) -> DataFrame:
    """Add ``period`` (first day of month), ``period_label`` (yyyy-MM) and a sortable ``month_key``."""
    period = month_start("pickup_year", "pickup_month")
    return month_gold.withColumns(
        {
            "period": period,
            "period_label": month_label(period),
            "month_key": month_key("pickup_year", "pickup_month"),
        }
    )


def month_window(month_gold: DataFrame, min_year: int = 2019, last_month: str | None = None) -> DataFrame:
    """Months from ``min_year`` through ``last_month`` (inclusive) with their
    period columns, in no particular order (the input of the analytics)."""
    out = month_gold.where(F.col("pickup_year") >= min_year)
    if last_month is not None:
        y, m = next_month(*parse_month(last_month))
        out = out.where(month_key("pickup_year", "pickup_month") < y * 12 + m - 1)
    return with_period(out).drop("month_key")


def month_series(month_gold: DataFrame, min_year: int = 2019, last_month: str | None = None) -> DataFrame:
    """Monthly series from ``min_year`` through ``last_month`` (inclusive), in month order."""
    return month_window(month_gold, min_year, last_month).orderBy("pickup_year", "pickup_month")


def top_zones(zone_gold: DataFrame, k: int = 15, ascending_for_display: bool = False) -> DataFrame:
    """The ``k`` busiest pickup zones (ties: lower zone id first).

    ``orderBy().limit()`` plans as TakeOrderedAndProject: a top-k per task,
    then a merge of k rows per task.  ``ascending_for_display`` re-sorts
    the k rows by pickups ascending (bar-chart order).
    """
    top = zone_gold.orderBy(F.col("pickups").desc(), F.col("zone_id").asc()).limit(k)
    return top.orderBy(F.col("pickups").asc(), F.col("zone_id").desc()) if ascending_for_display else top


def cells_in_week_order(time_gold: DataFrame) -> DataFrame:
    """Hour x weekday cells ordered by day of week, then hour."""
    return time_gold.orderBy("pickup_day_of_week", "pickup_hour")


def monthly_chart(series: DataFrame) -> DataFrame:
    """Chart frame of a month series: label, trips and revenue in millions."""
    return series.select(
        "period_label",
        millions("trip_count").alias("trips_millions"),
        millions("total_revenue").alias("revenue_millions"),
    )


def demand_heatmap(time_gold: DataFrame) -> DataFrame:
    """Hour rows x weekday columns (Sun..Sat) of trip counts; missing cells NULL.

    The pivot values are listed, so Spark does not run a distinct pre-pass.
    """
    wide = time_gold.groupBy("pickup_hour").pivot("pickup_day_of_week", list(range(1, 8))).agg(
        F.sum("trip_count")
    )
    return wide.select(
        "pickup_hour",
        hour_label("pickup_hour").alias("hour_label"),
        *[F.col(str(i + 1)).alias(name) for i, name in enumerate(DAY_NAMES)],
    )


def weekday_weekend_by_hour(time_gold: DataFrame) -> DataFrame:
    """Trips per hour, split into weekday and weekend (Sat/Sun)."""
    return (
        time_gold.groupBy("pickup_hour", is_weekend("pickup_day_of_week").alias("is_weekend"))
        .agg(F.sum("trip_count").alias("trip_count"))
    )


def yearly_stats(month_gold: DataFrame) -> DataFrame:
    """Per year, unweighted means of the monthly averages (fare, distance,
    duration) in one aggregation."""

    def mean(c: str, per_unit: int) -> Column:
        return mean_of_quanta(F.sum(quanta(c, per_unit)), F.count(c), per_unit)

    return month_gold.groupBy(F.col("pickup_year").alias("year")).agg(
        mean("avg_fare", 100).alias("avg_fare"),
        mean("avg_distance_miles", 100).alias("avg_distance"),
        mean("avg_duration_min", 10).alias("avg_duration"),
    )


def yearly_fare(month_gold: DataFrame) -> DataFrame:
    """Per year, the unweighted mean of the monthly average fares."""
    return yearly_stats(month_gold).select("year", "avg_fare")


def yearly_distance_duration(month_gold: DataFrame) -> DataFrame:
    """Per year, unweighted means of monthly average distance and duration."""
    return yearly_stats(month_gold).select("year", "avg_distance", "avg_duration")


def _weighted_fare() -> Column:
    return mean_of_quanta(F.sum(quanta("avg_fare", 100) * F.col("trip_count")), F.sum("trip_count"), 100)


def weighted_avg_fare(month_gold: DataFrame) -> DataFrame:
    """Trip-weighted overall average fare: sum(avg_fare * trips) / sum(trips)."""
    return month_gold.agg(
        _weighted_fare().alias("avg_fare_overall"),
        F.sum("trip_count").alias("trip_count"),
    )


def pareto_curve(zone_gold: DataFrame, value: str = "total_revenue", per_unit: int = 100) -> DataFrame:
    """Zones by ``value`` descending with cumulative share ``cum_pct`` and
    zone rank share ``zone_pct`` (both in percent)."""
    order = [F.col(value).desc(), F.col("zone_id").asc()]
    run = running_totals(
        zone_gold.select("zone_id", value),
        order,
        {"value": quanta(value, per_unit)},
        position="zone_rank",
    )
    return run.select(
        "zone_id",
        value,
        "zone_rank",
        (ratio(F.col("cum_value"), F.col("total_value")) * 100).alias("cum_pct"),
        (ratio(F.col("zone_rank"), F.col("total_rows")) * 100).alias("zone_pct"),
    )


def pareto_80(curve: DataFrame, share: float = 80.0) -> DataFrame:
    """How many zones stay within ``share`` % of cumulative value (the zone
    that crosses the line is not counted) and their share of all zones."""
    within = F.count_if(F.col("cum_pct") <= share)
    return curve.agg(
        F.count(F.lit(1)).alias("zones"),
        within.alias("zones_within"),
        python_round(ratio(within, F.count(F.lit(1))) * 100, 1).alias("pct_zones_for_share"),
    )


_MONTH_FIELDS = ["pickup_year", "pickup_month", "trip_count", "total_revenue"]


def month_extremes(month_gold: DataFrame) -> DataFrame:
    """Peak month, trough month and best revenue month (earliest wins ties),
    one row per metric."""
    g = month_gold.withColumn("month_key", month_key("pickup_year", "pickup_month"))
    agg = g.agg(
        argmax_row(_MONTH_FIELDS, "trip_count", "month_key").alias("peak"),
        argmin_row(_MONTH_FIELDS, "trip_count", "month_key").alias("trough"),
        argmax_row(_MONTH_FIELDS, "total_revenue", "month_key").alias("best_revenue"),
    )
    long = agg.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("metric"), F.col(name).alias("row"))
                    for name in ("peak", "trough", "best_revenue")
                ]
            )
        ).alias("m")
    )
    period = month_start("m.row.pickup_year", "m.row.pickup_month")
    return long.select(
        F.col("m.metric").alias("metric"),
        F.col("m.row.pickup_year").alias("pickup_year"),
        F.col("m.row.pickup_month").alias("pickup_month"),
        long_month_label(period).alias("period_label"),
        F.col("m.row.trip_count").alias("trip_count"),
        F.col("m.row.total_revenue").alias("total_revenue"),
    )


_CELL_METRICS = ("busiest", "quietest", "weekday_peak_hour", "weekend_peak_hour")


def _cell_figures(time_gold: DataFrame) -> DataFrame:
    """One row with a struct per cell metric, in one aggregation.  The hour
    totals come from a window over (hour, weekend): at most 48 groups of at
    most 5 cells."""
    hour_cells = Window.partitionBy("pickup_hour", is_weekend("pickup_day_of_week"))
    cells = time_gold.withColumns(
        {
            "cell_key": F.col("pickup_day_of_week") * 24 + F.col("pickup_hour"),
            "hour_trips": F.sum("trip_count").over(hour_cells),
        }
    )
    fields = ["pickup_hour", "pickup_day_of_week", "trip_count"]
    peak = F.struct(
        F.col("pickup_hour"), F.lit(None).cast("int").alias("pickup_day_of_week"), F.col("hour_trips").alias("trip_count")
    )
    rank = F.struct(F.col("hour_trips"), -F.col("pickup_hour"))
    weekend = is_weekend("pickup_day_of_week")
    return cells.agg(
        argmax_row(fields, "trip_count", "cell_key").alias("busiest"),
        argmin_row(fields, "trip_count", "cell_key").alias("quietest"),
        F.max_by(peak, F.when(~weekend, rank)).alias("weekday_peak_hour"),
        F.max_by(peak, F.when(weekend, rank)).alias("weekend_peak_hour"),
    )


def cell_extremes(time_gold: DataFrame) -> DataFrame:
    """Busiest and quietest hour x weekday cells, and the busiest hour of
    weekdays and of weekends (hour totals).  Ties go to the first cell in
    (day_of_week, hour) order, the first hour respectively.  A peak hour
    without cells has no row."""
    entries = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("row")) for m in _CELL_METRICS])
    long = _cell_figures(time_gold).select(F.explode(entries).alias("m")).where(
        F.col("m.row").isNotNull() | F.col("m.metric").isin("busiest", "quietest")
    )
    return long.select("m.metric", "m.row.pickup_hour", "m.row.pickup_day_of_week", "m.row.trip_count").withColumns(
        {"hour_label": hour_label("pickup_hour"), "day_name": day_name("pickup_day_of_week")}
    )


def recovery(
    month_gold: DataFrame, pre_period_end_year: int = 2020, share: float = 0.8, materialize_input: bool = True
) -> DataFrame:
    """Recovery after the trough (one row).

    ``pre_peak`` is the most trips in a month before ``pre_period_end_year``;
    the trough is the month with the fewest trips (earliest on ties); the
    recovery month is the first month after the trough with at least
    ``share * pre_peak`` trips (NULL: not yet recovered, or no pre-period).
    ``trough_drop_pct`` is the trough's fall below the pre-period peak in
    whole percent, rounded as Python's ``round`` does.

    The month table is read by several subqueries; unless the caller passes
    stored gold (``materialize_input=False``) it is written once to the
    shared checkpoint folder first, so silver is never re-aggregated per
    subquery.
    """
    if materialize_input:
        month_gold = materialize(month_gold)
    stats = _keyed(month_gold).agg(*_recovery_stats(pre_period_end_year))
    # one scalar subquery (referenced twice, planned once) carries both bounds
    bounds = stats.select(F.struct("pre_peak", "trough")).scalar()
    recovered = _recovery_key(month_gold, bounds, share)
    return stats.select(*_recovery_columns(F.col("pre_peak"), F.col("trough"), recovered, share))


def _keyed(month_gold: DataFrame) -> DataFrame:
    return month_gold.withColumn("month_key", month_key("pickup_year", "pickup_month"))


def _recovery_stats(pre_period_end_year: int) -> list[Column]:
    """Aggregates over keyed months: pre-period peak and trough."""
    return [
        F.max(F.when(F.col("pickup_year") < pre_period_end_year, F.col("trip_count"))).alias("pre_peak"),
        argmin_row([*_MONTH_FIELDS, "month_key"], "trip_count", "month_key").alias("trough"),
    ]


def _recovery_key(month_gold: DataFrame, stats: Column, share: float) -> Column:
    """First month after the trough that reaches the share (scalar subquery)."""
    later = (F.col("month_key") > stats["trough"]["month_key"]) & (F.col("trip_count") >= stats["pre_peak"] * F.lit(share))
    return _keyed(month_gold).where(later).agg(F.min("month_key")).scalar()


def _recovery_columns(pre_peak: Column, trough: Column, recovered: Column, share: float) -> list[Column]:
    def label(key: Column) -> Column:
        return long_month_label(F.make_date(F.floor(key / 12).cast("int"), (key % 12 + 1).cast("int"), F.lit(1)))

    drop = python_round((1 - ratio(trough["trip_count"], pre_peak)) * 100, 0).cast("long")
    return [
        pre_peak.alias("pre_peak"),
        (pre_peak * F.lit(share)).alias("threshold"),
        label(trough["month_key"]).alias("trough_label"),
        trough["trip_count"].alias("trough_trips"),
        drop.alias("trough_drop_pct"),
        label(recovered).alias("recovery_label"),
        F.coalesce(label(recovered), F.lit("Not yet recovered")).alias("recovery_text"),
    ]


def first_latest_change(month_gold: DataFrame) -> DataFrame:
    """First vs latest year: yearly fare means with % change (1 dp) and the
    change in yearly mean distance (2 dp, signed text)."""
    agg = yearly_stats(month_gold).agg(
        F.min_by("avg_fare", "year").alias("fare_first"),
        F.max_by("avg_fare", "year").alias("fare_latest"),
        F.min_by("avg_distance", "year").alias("dist_first"),
        F.max_by("avg_distance", "year").alias("dist_latest"),
        F.min("year").alias("first_year"),
        F.max("year").alias("latest_year"),
    )
    # the report rounds these numpy figures with numpy's rule
    dist_change = numpy_round(F.col("dist_latest") - F.col("dist_first"), 2)
    return agg.select(
        "first_year",
        "latest_year",
        "fare_first",
        "fare_latest",
        numpy_round(ratio(F.col("fare_latest") - F.col("fare_first"), F.col("fare_first")) * 100, 1).alias(
            "fare_change_pct"
        ),
        dist_change.alias("dist_change"),
        F.concat(F.when(dist_change >= 0, "+").otherwise(""), dist_change.cast("string"), F.lit(" mi")).alias(
            "dist_trend"
        ),
    )


_RECOVERY_FIELDS = (
    "pre_peak", "threshold", "trough_label", "trough_trips", "trough_drop_pct", "recovery_label", "recovery_text",
)

# Insight categories and metric labels of the report.
INSIGHT_ROWS = (
    ("Volume", "Peak month"),
    ("Volume", "COVID trough"),
    ("Volume", "80% recovery after COVID"),
    ("Revenue", "Best revenue month"),
    ("Revenue", "Average fare ({first}–now)"),
    ("Demand patterns", "Busiest hour (weekday)"),
    ("Demand patterns", "Busiest hour (weekend)"),
    ("Demand patterns", "Quietest hour"),
    ("Trip characteristics", "Avg fare increase since {first}"),
    ("Trip characteristics", "Avg trip distance change ({first}→{latest})"),
)


def insights(
    month_gold: DataFrame,
    time_gold: DataFrame,
    pre_period_end_year: int = 2020,
    share: float = 0.8,
    materialize_inputs: bool = True,
) -> DataFrame:
    """The report's key-insight table: ``(category, metric, value)``, ten rows.

    Every figure is a field of one of four scalar subqueries, so the result
    needs no join and no driver round trip.
    The gold inputs are read by every subquery: unless they are stored
    tables already (``materialize_inputs=False``) they are written once to
    the shared checkpoint folder first, as two concurrent jobs.
    """
    if materialize_inputs:
        month_gold, time_gold = materialize_all(month_gold, time_gold)
    # All plain figures of the month table in one aggregation; the recovery
    # month needs them; the yearly means and the cells are one each.
    months = _keyed(month_gold).agg(
        argmax_row(_MONTH_FIELDS, "trip_count", "month_key").alias("peak"),
        argmax_row(_MONTH_FIELDS, "total_revenue", "month_key").alias("best"),
        *_recovery_stats(pre_period_end_year),
        _weighted_fare().alias("avg_fare_overall"),
    )
    change = first_latest_change(month_gold)
    m = months.select(F.struct(*months.columns)).scalar()
    c = change.select(F.struct(*change.columns)).scalar()
    cells = _cell_figures(time_gold).select(F.struct(*_CELL_METRICS)).scalar()
    recovered = _recovery_key(month_gold, m, share)
    figures = {x: v for x, v in zip(_RECOVERY_FIELDS, _recovery_columns(m["pre_peak"], m["trough"], recovered, share))}

    def label(row: Column) -> Column:
        return long_month_label(F.make_date(row["pickup_year"], row["pickup_month"], F.lit(1)))

    peak, trough, best = m["peak"], m["trough"], m["best"]
    weekday, weekend, quiet = cells["weekday_peak_hour"], cells["weekend_peak_hour"], cells["quietest"]

    def money0(v: Column) -> Column:
        return F.concat(F.lit("$"), F.format_number(v, 0))

    def money2(v: Column) -> Column:
        return F.concat(F.lit("$"), fixed(v, 2))

    pct = c["fare_change_pct"]
    values = [
        F.concat(label(peak), F.lit(" — "), F.format_number(peak["trip_count"], 0), F.lit(" trips")),
        F.concat(label(trough), F.lit(" — "), F.format_number(trough["trip_count"], 0),
                 F.lit(" trips (−"), figures["trough_drop_pct"].cast("string"), F.lit("% vs pre-COVID peak)")),
        F.concat(figures["recovery_text"], F.lit(" (≥"), F.lit(str(round(share * 100))),
                 F.lit("% of pre-COVID peak)")),
        F.concat(label(best), F.lit(" — "), money0(best["total_revenue"])),
        money2(m["avg_fare_overall"]),
        hour_label(weekday["pickup_hour"]),
        hour_label(weekend["pickup_hour"]),
        F.concat(hour_label(quiet["pickup_hour"]), F.lit(" on "), day_name(quiet["pickup_day_of_week"])),
        F.concat(money2(c["fare_first"]), F.lit(" → "), money2(c["fare_latest"]),
                 F.lit(" ("), F.when(pct >= 0, "+").otherwise(""), pct.cast("string"), F.lit("%)")),
        c["dist_trend"],
    ]
    first = c["first_year"].cast("string")
    latest = c["latest_year"].cast("string")

    def metric_text(template: str) -> Column:
        parts: list[Column] = []
        rest = template
        while rest:
            i = rest.find("{")
            if i < 0:
                parts.append(F.lit(rest))
                break
            j = rest.index("}", i)
            if i:
                parts.append(F.lit(rest[:i]))
            parts.append({"first": first, "latest": latest}[rest[i + 1 : j]])
            rest = rest[j + 1 :]
        return F.concat(*parts)

    rows = [
        F.struct(F.lit(i + 1).alias("position"), F.lit(cat).alias("category"),
                 metric_text(metric).alias("metric"), v.alias("value"))
        for i, ((cat, metric), v) in enumerate(zip(INSIGHT_ROWS, values))
    ]
    return (
        month_gold.sparkSession.range(1)
        .select(F.explode(F.array(*rows)).alias("r"))
        .select("r.position", "r.category", "r.metric", "r.value")
    )
