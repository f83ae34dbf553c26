"""Every data frame of the trip report, built from the stored lake layers.

The report's figures all read the written gold tables (one row per month,
zone or hour x weekday cell); bronze and silver are only counted, which
Parquet answers from file footers.  Each frame is small and bounded by the
calendar or the zone count, so a caller may ``fetch`` them all.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from triplake.config import Lake
from triplake.contracts import GOLD_TABLES, RAW_FILE_GLOB
from triplake.operators import analytics, audit
from triplake.plans.inspect import fetch
from triplake.plans.materialize import materialize
from triplake.plans.pipeline import read_layer
from triplake.sources.files import file_inventory, inventory_summary, list_files

# Table names shown in the layer row-count table.
BRONZE_TABLE = "tlc_trips_raw"
SILVER_TABLE = "tlc_trips"


def report_frames(
    spark: SparkSession,
    lake: Lake,
    min_year: int = 2019,
    last_month: str | None = None,
    top: int = 15,
    pre_period_end_year: int = 2020,
    raw: str | None = None,
    glob: str = RAW_FILE_GLOB,
) -> dict[str, DataFrame]:
    """``name -> DataFrame`` for every table and chart of the report.

    ``min_year``/``last_month`` bound the monthly series and everything built
    on it; ``raw`` adds the inventory of the raw landing folder.
    """
    bronze = read_layer(spark, lake, "bronze")
    silver = read_layer(spark, lake, "silver")
    month = read_layer(spark, lake, "gold", "trips_by_month")
    zones = read_layer(spark, lake, "gold", "trips_by_zone")
    cells = read_layer(spark, lake, "gold", "time_patterns")

    window = analytics.month_window(month, min_year, last_month)
    series = window.orderBy("pickup_year", "pickup_month")
    curve = materialize(analytics.pareto_curve(zones), "pareto-curve")  # read by two frames
    frames: dict[str, DataFrame] = {
        "layer_counts": audit.layer_counts(
            {
                ("Bronze", BRONZE_TABLE): bronze,
                ("Silver", SILVER_TABLE): silver,
                **{("Gold", name): read_layer(spark, lake, "gold", name) for name in GOLD_TABLES},
            }
        ),
        "retention": audit.retention(bronze, silver),
        "month_series": series,
        "monthly_chart": analytics.monthly_chart(series),
        "top_zones": analytics.top_zones(zones, top, ascending_for_display=True),
        "demand_heatmap": analytics.demand_heatmap(cells).orderBy("pickup_hour"),
        "cells_in_week_order": analytics.cells_in_week_order(cells),
        "weekday_weekend_by_hour": analytics.weekday_weekend_by_hour(cells).orderBy("pickup_hour", "is_weekend"),
        "yearly_fare": analytics.yearly_fare(window).orderBy("year"),
        "yearly_distance_duration": analytics.yearly_distance_duration(window).orderBy("year"),
        "pareto_curve": curve.orderBy("zone_rank"),
        "pareto_80": analytics.pareto_80(curve),
        "insights": analytics.insights(window, cells, pre_period_end_year, materialize_inputs=False).orderBy(
            "position"
        ),
    }
    if raw is not None:
        listing = list_files(spark, raw, glob)
        frames["file_inventory"] = file_inventory(listing)
        frames["file_inventory_summary"] = inventory_summary(listing)
    return frames


def fetch_report(frames: dict[str, DataFrame], page_rows: int = 50_000) -> dict[str, list[dict]]:
    """Fetch every report frame as records, whatever its size, by pages.

    The frames are independent, so they run as concurrent jobs from driver
    threads that inherit the caller's job group and tags.
    """
    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession
    task = inheritable_thread_target(spark)(lambda df: fetch(df, page_rows).to_dict("records"))
    with ThreadPoolExecutor(max_workers=min(len(frames), 8)) as pool:
        results = list(pool.map(task, frames.values()))
    return dict(zip(frames, results))
