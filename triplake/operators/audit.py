"""Load audits: row counts per layer, retention, load validation and month coverage."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.contracts import PICKUP
from triplake.functions.measures import numpy_round, ratio
from triplake.functions.timecols import ntz

# Fixed value: months between a month's end and its file being published.
PUBLICATION_LAG_MONTHS = 2


def layer_counts(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """``(layer, table, rows)`` for each ``(layer, table) -> DataFrame``.

    Each count is a global aggregate (partial counts per task); on Parquet
    tables without filters Spark answers it from footers.
    """
    frames = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table"), "rows"
        )
        for (layer, name), df in tables.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def retention(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Silver rows as a share of bronze rows, in percent (1 dp, rounded as
    the report rounds its numpy figure)."""
    b = bronze.agg(F.count(F.lit(1))).scalar()
    s = silver.agg(F.count(F.lit(1))).scalar()
    return bronze.sparkSession.range(1).select(
        b.alias("bronze_rows"),
        s.alias("silver_rows"),
        numpy_round(ratio(s, b) * 100, 1).alias("retention_pct"),
    )


def retention_of(report: DataFrame) -> DataFrame:
    """The same from a rule report (one row), whose counts come from one pass."""
    return report.select(
        "bronze_rows",
        "silver_rows",
        numpy_round(ratio(F.col("silver_rows"), F.col("bronze_rows")) * 100, 1).alias("retention_pct"),
    )


def load_validation(bronze: DataFrame) -> DataFrame:
    """Row count, earliest/latest pickup and the exact number of distinct pickup months."""
    return bronze.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(PICKUP).alias("earliest_pickup"),
        F.max(PICKUP).alias("latest_pickup"),
        F.count_distinct(F.date_trunc("month", F.col(PICKUP))).alias("months_loaded"),
    )


def expected_months(
    spark: SparkSession, start_year: int, as_of: dt.date, lag_months: int = PUBLICATION_LAG_MONTHS
) -> DataFrame:
    """Calendar of months that should have been published by ``as_of``:
    every month of past years, and months up to ``max(month - lag, 1)`` of
    the ``as_of`` year.  Size is 12 per year: a proven small bound."""
    last = max(as_of.month - lag_months, 1)
    months = (as_of.year - start_year) * 12 + last
    return spark.range(max(months, 0)).select(
        (F.lit(start_year) + F.floor(F.col("id") / 12)).cast("int").alias("year"),
        (F.col("id") % 12 + 1).cast("int").alias("month"),
    )


def loaded_months(bronze: DataFrame, start_year: int | None = None, end: dt.date | None = None) -> DataFrame:
    """Trips per pickup (year, month) present in bronze (partial aggregation first).

    With a window ``[start_year, end)`` the pickup range is pushed to the scan
    and the result has at most 12 rows per year of the window.
    """
    pick = F.col(PICKUP)
    rows = bronze.where(pick.isNotNull())
    if start_year is not None:
        rows = rows.where(pick >= ntz(start_year))
    if end is not None:
        rows = rows.where(pick < ntz(end.year, end.month, end.day))
    return rows.groupBy(F.year(pick).alias("year"), F.month(pick).alias("month")).agg(
        F.count(F.lit(1)).alias("trips")
    )


def _calendar_end(as_of: dt.date, lag_months: int = PUBLICATION_LAG_MONTHS) -> dt.date:
    last = max(as_of.month - lag_months, 1)
    return dt.date(as_of.year + (last == 12), last % 12 + 1, 1)


def month_coverage(bronze: DataFrame, start_year: int, as_of: dt.date) -> DataFrame:
    """Every expected month with its bronze trip count (0 when missing).

    Both sides are bounded by the calendar (12 rows per year): the loaded
    months are aggregated only inside the calendar window, whose bounds also
    reach the scan.  Spark broadcasts the small side; no hint is needed.
    """
    cal = expected_months(bronze.sparkSession, start_year, as_of)
    loaded = loaded_months(bronze, start_year, _calendar_end(as_of))
    return (
        cal.join(loaded, ["year", "month"], "left")
        .select("year", "month", F.coalesce("trips", F.lit(0)).alias("trips"))
        .withColumn("missing", F.col("trips") == 0)
    )


def missing_months(bronze: DataFrame, start_year: int, as_of: dt.date) -> DataFrame:
    """Expected months with no bronze rows (anti join against the loaded months)."""
    cal = expected_months(bronze.sparkSession, start_year, as_of)
    loaded = loaded_months(bronze, start_year, _calendar_end(as_of)).select("year", "month")
    return cal.join(loaded, ["year", "month"], "left_anti")
