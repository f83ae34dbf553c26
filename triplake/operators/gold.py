"""Gold: monthly, pickup-zone and hour x weekday aggregates of silver.

All gold measures derive from additive sums and counts, so one aggregation
with map-side partial aggregation feeds every table: a hot key (a busy month
or zone) is collapsed inside every task before the shuffle, and only (#tasks x
#groups) partial rows cross the network.  Several tables share one scan by
grouping sets.  Sums are exact (``triplake.functions.measures``), which makes
gold identical on any cluster layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.config import GoldOptions
from triplake.contracts import GOLD_KEYS, ZONE
from triplake.functions.measures import decimal_count, decimal_sum, mean_of_quanta, quanta_sum, ratio

# Grouping columns of all tables, in grouping-id order (first: highest bit).
_ALL_KEYS = [k for keys in GOLD_KEYS.values() for k in keys]


ADDITIVE = (
    "trips", "amount_sum", "amount_n", "distance_sum", "distance_n", "passengers_sum", "passengers_n",
    "duration_seconds", "duration_units", "duration_n",
)


def _additive() -> list[Column]:
    """Sums and counts from which every gold measure is finished.  The
    duration is summed both as whole seconds and as hundred-thousandths of a
    minute, for unrounded and rounded silver."""
    duration = F.col("trip_duration_min")
    return [
        F.count(F.lit(1)).alias("trips"),
        decimal_sum("total_amount").alias("amount_sum"),
        decimal_count("total_amount").alias("amount_n"),
        decimal_sum("trip_distance").alias("distance_sum"),
        decimal_count("trip_distance").alias("distance_n"),
        decimal_sum("passenger_count").alias("passengers_sum"),
        decimal_count("passenger_count").alias("passengers_n"),
        quanta_sum(duration, 60).alias("duration_seconds"),
        quanta_sum(duration, 100_000).alias("duration_units"),
        F.count(duration).alias("duration_n"),
    ]


def _table_id(name: str) -> int:
    """Grouping id of a table's rows: a bit is set for each key not in it."""
    own = GOLD_KEYS[name]
    return sum(1 << (len(_ALL_KEYS) - 1 - i) for i, k in enumerate(_ALL_KEYS) if k not in own)


def additive_cells(silver: DataFrame, tables: Sequence[str] = tuple(GOLD_KEYS), by: Sequence[str] = ()) -> DataFrame:
    """The additive measures of ``tables`` in one pass over silver: all keys
    (NULL where a table doesn't group by them), ``table_id`` and the sums.
    The grouping id tells a NULL zone from a row without zone.  ``by`` keeps
    the cells of its columns' values apart (every set groups by them, so as
    the first columns they leave the grouping ids as they are)."""
    sets = [[F.col(k) for k in (*by, *GOLD_KEYS[name])] for name in tables]
    return silver.groupingSets(sets, *by, *_ALL_KEYS).agg(F.grouping_id().alias("table_id"), *_additive())


def merged_cells(cells: DataFrame) -> DataFrame:
    """One cell for each table and key from the cells of several increments:
    sums and counts add up, so nothing is read again."""
    keys = [*_ALL_KEYS, "table_id"]
    measures = [c for c in cells.columns if c in ADDITIVE]
    return cells.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in measures))


def _cells_of(cells: DataFrame, name: str) -> DataFrame:
    return cells.where(F.col("table_id") == _table_id(name))


def _single(silver: DataFrame, name: str) -> DataFrame:
    """The additive measures of one table, by a plain aggregation."""
    return silver.groupBy(*GOLD_KEYS[name]).agg(F.lit(_table_id(name)).cast("long").alias("table_id"), *_additive())


def _mean(name: str, decimals: int = 2) -> Column:
    return F.round(ratio(F.col(f"{name}_sum"), F.col(f"{name}_n")), decimals)


def _mean_duration(opts: GoldOptions) -> Column:
    if opts.duration_scale is None:
        mean = mean_of_quanta(F.col("duration_seconds"), F.col("duration_n"), 60)
    else:
        mean = mean_of_quanta(F.col("duration_units"), F.col("duration_n"), 100_000)
    return F.round(mean, 1)


def _revenue() -> Column:
    return F.round(F.col("amount_sum").cast("double"), 2)


def finish_months(cells: DataFrame, opts: GoldOptions = GoldOptions()) -> DataFrame:
    return _cells_of(cells, "trips_by_month").select(
        "pickup_year",
        "pickup_month",
        F.col("trips").alias("trip_count"),
        _revenue().alias("total_revenue"),
        _mean("amount").alias("avg_fare"),
        _mean("distance").alias("avg_distance_miles"),
        _mean_duration(opts).alias("avg_duration_min"),
        _mean("passengers").alias("avg_passengers"),
    )


def finish_zones(cells: DataFrame, opts: GoldOptions = GoldOptions()) -> DataFrame:
    own = _cells_of(cells, "trips_by_zone")
    own = own.where(F.col(ZONE).isNotNull()) if opts.drop_null_zone else own
    return own.select(
        F.col(ZONE).alias("zone_id"),
        F.col("trips").alias("pickups"),
        _revenue().alias("total_revenue"),
        _mean("amount").alias("avg_fare"),
        _mean("distance").alias("avg_distance_miles"),
    )


def finish_times(cells: DataFrame, opts: GoldOptions = GoldOptions()) -> DataFrame:
    return _cells_of(cells, "time_patterns").select(
        "pickup_hour",
        "pickup_day_of_week",
        F.col("trips").alias("trip_count"),
        _mean_duration(opts).alias("avg_duration_min"),
        _mean("amount").alias("avg_fare"),
    )


def trips_by_month(silver: DataFrame, opts: GoldOptions = GoldOptions()) -> DataFrame:
    """Trips, revenue and means per pickup (year, month)."""
    return finish_months(_single(silver, "trips_by_month"), opts)


def trips_by_zone(silver: DataFrame, opts: GoldOptions = GoldOptions()) -> DataFrame:
    """Pickups, revenue and means per pickup zone (NULL zone dropped by default)."""
    return finish_zones(_single(silver, "trips_by_zone"), opts)


def time_patterns(silver: DataFrame, opts: GoldOptions = GoldOptions()) -> DataFrame:
    """Trips and means per (pickup hour, day of week)."""
    return finish_times(_single(silver, "time_patterns"), opts)


GOLD_BUILDERS = {
    "trips_by_month": trips_by_month,
    "trips_by_zone": trips_by_zone,
    "time_patterns": time_patterns,
}

GOLD_FINISHERS = {
    "trips_by_month": finish_months,
    "trips_by_zone": finish_zones,
    "time_patterns": finish_times,
}
