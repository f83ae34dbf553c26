"""

``entry(spark)`` runs the flagship query (gold ``time_patterns`` over the
events adapter) at sf0.001.  ``queries()`` registers one callable per
SQL over the same parquet tables.  Both sides alias every computed column to
the same name.  ``_ingested_at`` is non-deterministic and never compared.

Adapters (see ``triplake.sources.adapters``): E maps ``events`` onto raw
trips (January 2024, all hours), L maps ``lineitem`` (1995-2001, monthly
analytics, rules with ``min_year=1995, max_amount=100000``).
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from triplake.config import GoldOptions, Lake, QualityRules  # noqa: E402
from triplake.contracts import DROPOFF, INGESTED_AT, PICKUP  # noqa: E402
from triplake.operators import analytics, audit, gold  # noqa: E402
from triplake.operators.bronze import bronze  # noqa: E402
from triplake.operators.silver import rule_report, silver  # noqa: E402
from triplake.plans.materialize import materialize, materialize_all  # noqa: E402
from triplake.plans import sinks  # noqa: E402
from triplake.plans.pipeline import read_layer, run_pipeline, write_bronze  # noqa: E402
from triplake.session import scratch_path  # noqa: E402
from triplake.sources.files import file_inventory, inventory_summary, list_files, rows_per_file  # noqa: E402
from triplake.sources.adapters import (  # noqa: E402
    EVENTS_RULES,
    LINEITEM_RULES,
    events_raw,
    lineitem_raw,
    table,
)
from triplake.streaming.incremental import ingest_reconciled, ingest_stream  # noqa: E402

# The training-data operators are an optional part: only their absence is
# tolerated here, any other import error is raised.
try:
    from triplake.llm import queries as _llm  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("triplake.llm", "triplake.llm.queries", "corpus_pipeline"):
        raise
    _llm = None
except ImportError:
    # a namespace left by deleted files: the package has no queries module
    if os.path.exists(os.path.join(os.path.dirname(os.path.abspath(__file__)), "triplake", "llm", "queries.py")):
        raise
    _llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
ORACLE_DIR = "/root/testdata/sf0.01"

# Parameters of the registered queries (shared by Spark and the oracle).
L_LAST_MONTH = "2001-10"  # the final lineitem month is partial
L_BOUNDED_LAST_MONTH = "1999-06"
L_PRE_PERIOD_END_YEAR = 1996
L_COVERAGE_START_YEAR = 1994
L_COVERAGE_AS_OF = dt.date(2001, 12, 15)
TOP_K = 15


# --------------------------------------------------------------------------- Spark side


def _e_bronze(spark: SparkSession, d: str) -> DataFrame:
    return bronze(events_raw(spark, d))


def _l_bronze(spark: SparkSession, d: str) -> DataFrame:
    return bronze(lineitem_raw(spark, d))


def _e_silver(spark: SparkSession, d: str) -> DataFrame:
    return silver(_e_bronze(spark, d), EVENTS_RULES)


def _l_silver(spark: SparkSession, d: str, rules: QualityRules = LINEITEM_RULES) -> DataFrame:
    return silver(_l_bronze(spark, d), rules)


def _l_month(spark: SparkSession, d: str) -> DataFrame:
    return gold.trips_by_month(_l_silver(spark, d))


def _l_month_bounded(spark: SparkSession, d: str) -> DataFrame:
    return analytics.month_series(_l_month(spark, d), min_year=1995, last_month=L_LAST_MONTH)


def _l_zone(spark: SparkSession, d: str) -> DataFrame:
    return gold.trips_by_zone(_l_silver(spark, d))


def _e_time(spark: SparkSession, d: str) -> DataFrame:
    return gold.time_patterns(_e_silver(spark, d))


def _l_month_window(spark: SparkSession, d: str) -> DataFrame:
    return analytics.month_window(_l_month(spark, d), min_year=1995, last_month=L_LAST_MONTH)


# Analytics that read the monthly gold more than once get it from a table that
# is written once in the shared checkpoint folder; all others read it directly.
def _gm(spark: SparkSession, d: str) -> DataFrame:
    return materialize(_l_month_window(spark, d))


def _gm_all(spark: SparkSession, d: str) -> DataFrame:
    return materialize(_l_month(spark, d))


def _no_ingest_time(df: DataFrame) -> DataFrame:
    return df.drop(INGESTED_AT)


# Landing folders derived from lineitem by Spark, written under the shared
# checkpoint folder (fresh per call).  Part files match LANDING_GLOB.
LANDING_GLOB = "*.parquet"

# Seconds this process has spent on writing landing folders: the inputs of
# queries, not their work (the bench reports them apart).
fixture_seconds = 0.0


def _write_landing(raw: DataFrame, folder: str, drift: bool) -> None:
    global fixture_seconds
    began = time.perf_counter()
    _write_landing_files(raw, folder, drift)
    fixture_seconds += time.perf_counter() - began


def _spread(raw: DataFrame) -> DataFrame:
    """Rows for several files per landing, like a real raw folder, without
    skew.  By the hash of the row id (stable for a file scan): a round-robin
    repartition would sort all rows of a task in memory first."""
    n = raw.sparkSession.sparkContext.defaultParallelism
    return raw.withColumn("_row", F.monotonically_increasing_id()).repartition(n, "_row").drop("_row")


def _write_landing_files(raw: DataFrame, folder: str, drift: bool) -> None:
    """Write raw trips as Parquet files; with ``drift`` the files of three
    eras carry different physical schemas (as the yearly raw files do):
    up to 1996 integer party/vendor and a lower-case airport fee, 1997-1998
    without the two newest fee columns, from 1999 zoned timestamps."""
    year = F.year(PICKUP)
    if not drift:
        _spread(raw).write.mode("append").parquet(folder)
        return
    early = (
        raw.where(year <= 1996)
        .withColumn("passenger_count", F.col("passenger_count").cast("long"))
        .withColumn("VendorID", F.col("VendorID").cast("int"))
        .withColumnRenamed("Airport_fee", "airport_fee")
    )
    middle = raw.where((year >= 1997) & (year <= 1998)).drop("congestion_surcharge", "Airport_fee")
    late = raw.where(year >= 1999).withColumns(
        {PICKUP: F.col(PICKUP).cast("timestamp"), DROPOFF: F.col(DROPOFF).cast("timestamp")}
    )
    for part in (early, middle, late):
        _spread(part).write.mode("append").parquet(folder)


def _schema_drift_union(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_path(spark, "landing-drift")
    _write_landing(lineitem_raw(spark, d), f"{root}/landing", drift=True)
    lake = Lake(f"{root}/lake")
    write_bronze(spark, f"{root}/landing", lake, glob=LANDING_GLOB, files_per_batch=16)
    return read_layer(spark, lake, "bronze").drop(INGESTED_AT)


def _age_files(spark: SparkSession, folder: str, days: int) -> None:
    """Give the files of a landing folder an older modification time, as a
    copy that keeps time stamps does (a fixture; stores without settable times
    leave them as they are)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    then = int((time.time() - days * 86400) * 1000)
    for status in fs.listStatus(path):
        fs.setTimes(status.getPath(), then, -1)


def _incremental(spark: SparkSession, d: str, ingest: Callable, split_year: int, drift: bool) -> DataFrame:
    """Two landings, the second with older time stamps, and a repeated run."""
    root = scratch_path(spark, "incremental")
    landing, out, ckpt = f"{root}/landing", Lake(f"{root}/lake"), f"{root}/_checkpoint"
    raw = lineitem_raw(spark, d)
    _write_landing(raw.where(F.year(PICKUP) > split_year), landing, drift)
    first = ingest(spark, landing, out, ckpt, glob=LANDING_GLOB)
    late = f"{root}/late"
    _write_landing(raw.where(F.year(PICKUP) <= split_year), late, drift)
    _age_files(spark, late, 30)
    # the late files join the landing by a glob over both folders
    both = f"{root}/{{landing,late}}"
    second = ingest(spark, both, out, f"{root}/_checkpoint2", glob=LANDING_GLOB)
    again = ingest(spark, both, out, f"{root}/_checkpoint3", glob=LANDING_GLOB)
    if not first.rows or not second.rows or again.rows or again.files:
        raise AssertionError(f"incremental ingest added {first}, {second}, {again}")
    return read_layer(spark, out, "bronze").drop(INGESTED_AT)


def _bronze_rebuild_then_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Ingest, full rebuild from the same landing, late files, ingest again."""
    root = scratch_path(spark, "rebuild")
    landing, lake = f"{root}/landing", Lake(f"{root}/lake")
    raw = lineitem_raw(spark, d)
    run = lambda: ingest_reconciled(spark, landing, lake, lake.checkpoint("ingest"), glob=LANDING_GLOB)
    _write_landing(raw.where(F.year(PICKUP) > 1997), landing, drift=True)
    run()
    write_bronze(spark, landing, lake, glob=LANDING_GLOB)
    _write_landing(raw.where(F.year(PICKUP) <= 1997), landing, drift=True)
    _age_files(spark, landing, 30)
    run()
    return read_layer(spark, lake, "bronze").drop(INGESTED_AT)


def _managed_tables(spark: SparkSession, d: str) -> DataFrame:
    """A schema under its catalog's name with its folder in the shared store;
    a declared table filled by INSERT, replaced once; a partitioned CTAS of it."""
    name = f"triplake_{uuid.uuid4().hex[:12]}"
    sinks.ensure_namespace(spark, f"spark_catalog.{name}", scratch_path(spark, "schema"))
    silver_rows = _l_silver(spark, d).select("pickup_year", "pickup_month", "PULocationID", "total_amount")
    for _ in range(2):
        sinks.create_table(spark, f"{name}.trips", silver_rows.schema)
    sinks.insert_into(silver_rows, f"{name}.trips")
    by_zone = spark.table(f"{name}.trips").groupBy("pickup_year", "PULocationID").agg(F.count(F.lit(1)).alias("trips"))
    sinks.save_as_table(by_zone, f"{name}.zone_years", partition_by=["pickup_year"])
    sinks.require_tables(spark, [f"{name}.trips", f"{name}.zone_years"])
    return spark.table(f"{name}.zone_years").select("pickup_year", "PULocationID", "trips")


def _positions(ordered: DataFrame) -> DataFrame:
    """An ordered (small) frame with the position of each row: the order that
    the frame itself has, not one that is asked for again."""
    return ordered.withColumn("_id", F.monotonically_increasing_id()).withColumn(
        "position", F.row_number().over(Window.orderBy("_id")).cast("long")
    ).drop("_id")


def _inventory(spark: SparkSession, d: str) -> DataFrame:
    """File inventory beside the rows that each file holds, from one scan of
    all files that reads no column."""
    files = rows_per_file(spark, d, "*.parquet")
    return file_inventory(files.select(F.col("file").alias("name"), "length")).join(files.select("file", "rows"), "file")


def _copy_files(spark: SparkSession, source: str, target: str) -> None:
    """The files of a landing folder under another one, byte by byte (a fixture)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf)


def _incremental_copies(spark: SparkSession, d: str) -> DataFrame:
    """A landing, its copy under another path with later files: the copies are
    known by name and contents and add nothing."""
    root = scratch_path(spark, "copies")
    lake, raw = Lake(f"{root}/lake"), lineitem_raw(spark, d)
    _write_landing(raw.where(F.year(PICKUP) > 1997), f"{root}/landing", drift=False)
    first = ingest_stream(spark, f"{root}/landing", lake, f"{root}/ck1", glob=LANDING_GLOB)
    _copy_files(spark, f"{root}/landing", f"{root}/moved")
    _write_landing(raw.where(F.year(PICKUP) <= 1997), f"{root}/moved", drift=False)
    second = ingest_stream(spark, f"{root}/moved", lake, f"{root}/ck2", glob=LANDING_GLOB)
    if second.skipped != first.files or not second.rows:
        raise AssertionError(f"ingest of copies added {first}, {second}")
    return read_layer(spark, lake, "bronze").drop(INGESTED_AT)


def _rescued_values(spark: SparkSession, d: str) -> DataFrame:
    """Raw rows of text, some of it malformed: the values that bronze's casts
    lose, each with its row."""
    key = F.col("l_orderkey") % 10
    raw = table(spark, d, "lineitem").select(
        F.col("l_linenumber").cast("string").alias("VendorID"),
        F.when(key == 3, F.concat(F.lit("x"), F.col("l_linenumber"))).when(key == 4, "").otherwise(F.col("l_linenumber").cast("string")).alias("passenger_count"),
        F.when(F.col("l_partkey") % 7 == 2, F.concat(F.col("l_suppkey"), F.lit(" USD"))).otherwise(F.col("l_suppkey").cast("string")).alias("total_amount"),
        F.when(F.col("l_suppkey") % 5 == 0, "N/A").otherwise(F.col("l_suppkey").cast("string")).alias("PULocationID"),
    )
    lake = Lake(f"{scratch_path(spark, 'rescue')}/lake")
    write_bronze(spark, raw, lake, rescue=True)
    return spark.table(lake.table("bronze") + "_rejected").select(
        "rejected_column", "rejected_value", "VendorID", "passenger_count", "total_amount", "PULocationID"
    )


def _lake_after_increment(spark: SparkSession, d: str) -> Lake:
    """A full run over some files, then an increment of the others."""
    root = scratch_path(spark, "increment")
    lake, raw = Lake(f"{root}/lake"), lineitem_raw(spark, d)
    run = lambda resume: run_pipeline(
        spark, f"{root}/landing", lake, LINEITEM_RULES, glob=LANDING_GLOB, reconcile=False, resume=resume
    )
    _write_landing(raw.where(F.year(PICKUP) != 1997), f"{root}/landing", drift=False)
    run(False)
    _write_landing(raw.where(F.year(PICKUP) == 1997), f"{root}/landing", drift=False)
    run(True)
    return lake


def _stored_runs(spark: SparkSession, d: str) -> DataFrame:
    """The stored reports of a full run and an increment: one row per step."""
    return read_layer(spark, _lake_after_increment(spark, d), "gold", "run_report").select("step", "state", "rows")


def _net_amounts(spark: SparkSession, d: str) -> DataFrame:
    """Trips whose amount is the discounted price: more than two decimals."""
    return _l_silver(spark, d).withColumn("total_amount", F.col("fare_amount"))


# Fixture data is small: cluster silver in several tasks nevertheless.
PIPELINE_BYTES_PER_TASK = 2 * 1024 * 1024


def _pipeline_lake(spark: SparkSession, d: str, duration_scale: int | None = None) -> Lake:
    root = scratch_path(spark, "pipeline")
    landing = f"{root}/landing"
    _write_landing(lineitem_raw(spark, d), landing, drift=False)
    lake = Lake(f"{root}/lake")
    # lineitem rows are not month-clustered like monthly raw files: cluster silver
    run_pipeline(
        spark, landing, lake, LINEITEM_RULES, glob=LANDING_GLOB, cluster_silver=True, reconcile=False,
        duration_scale=duration_scale, cluster_bytes_per_task=PIPELINE_BYTES_PER_TASK,
    )
    return lake


def _pipeline_layer_counts(spark: SparkSession, d: str) -> DataFrame:
    lake = _pipeline_lake(spark, d)
    return audit.layer_counts(
        {
            ("Bronze", "tlc_trips_raw"): read_layer(spark, lake, "bronze"),
            ("Silver", "tlc_trips"): read_layer(spark, lake, "silver"),
            **{("Gold", n): read_layer(spark, lake, "gold", n) for n in gold.GOLD_BUILDERS},
        }
    )


def _layer_counts(spark: SparkSession, d: str) -> DataFrame:
    """Row counts of E's layers; silver and the gold cells are written once."""
    bronze_rows = _e_bronze(spark, d)
    silver_rows = materialize(silver(bronze_rows, EVENTS_RULES))
    cells = materialize(gold.additive_cells(silver_rows))
    return audit.layer_counts(
        {
            ("Bronze", "tlc_trips_raw"): bronze_rows,
            ("Silver", "tlc_trips"): silver_rows,
            **{("Gold", n): finish(cells) for n, finish in gold.GOLD_FINISHERS.items()},
        }
    )


def _retention(spark: SparkSession, d: str) -> DataFrame:
    """Both counts from one pass over bronze."""
    return audit.retention_of(rule_report(_e_bronze(spark, d), EVENTS_RULES))


def _insights(spark: SparkSession, d: str) -> DataFrame:
    # the two gold inputs are independent: written as concurrent jobs
    gm, gt = materialize_all(_l_month_window(spark, d), _e_time(spark, d))
    return analytics.insights(gm, gt, L_PRE_PERIOD_END_YEAR, materialize_inputs=False)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _e_time(spark, sf_dir)


def entry(spark: SparkSession) -> DataFrame:
    return flagship(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # bronze / silver
        "bronze_contract": lambda s, d: _no_ingest_time(_l_bronze(s, d)),
        "silver_trips": lambda s, d: _no_ingest_time(_e_silver(s, d)),
        "silver_bounded_month": lambda s, d: _no_ingest_time(
            _l_silver(s, d, QualityRules(min_year=1995, max_amount=100000.0, last_month=L_BOUNDED_LAST_MONTH))
        ),
        "silver_rule_report": lambda s, d: rule_report(_e_bronze(s, d), EVENTS_RULES),
        # warehouse variant: duration rounded to 2 decimals, gold means over hundredths
        "silver_rounded_duration": lambda s, d: _no_ingest_time(silver(_e_bronze(s, d), EVENTS_RULES, 2)),
        "trips_by_month_rounded_duration": lambda s, d: gold.trips_by_month(
            silver(_l_bronze(s, d), LINEITEM_RULES, 2), GoldOptions(duration_scale=2)
        ),
        # gold
        "trips_by_month": _l_month,
        "trips_by_zone": lambda s, d: gold.trips_by_zone(_e_silver(s, d)),
        "trips_by_zone_with_null": lambda s, d: gold.trips_by_zone(
            _e_silver(s, d), GoldOptions(drop_null_zone=False)
        ),
        "time_patterns": _e_time,
        # audits
        "load_validation": lambda s, d: audit.load_validation(_l_bronze(s, d)),
        "layer_counts": _layer_counts,
        "retention": _retention,
        "month_coverage": lambda s, d: audit.month_coverage(
            _l_bronze(s, d), L_COVERAGE_START_YEAR, L_COVERAGE_AS_OF
        ),
        "missing_months": lambda s, d: audit.missing_months(
            _l_bronze(s, d), L_COVERAGE_START_YEAR, L_COVERAGE_AS_OF
        ),
        # report analytics
        "month_series": _l_month_bounded,
        "top_zones": lambda s, d: analytics.top_zones(_l_zone(s, d), TOP_K),
        "monthly_chart": lambda s, d: analytics.monthly_chart(_l_month_bounded(s, d)),
        "demand_heatmap": lambda s, d: analytics.demand_heatmap(_e_time(s, d)),
        "weekday_weekend_by_hour": lambda s, d: analytics.weekday_weekend_by_hour(_e_time(s, d)),
        "yearly_fare": lambda s, d: analytics.yearly_fare(_l_month_window(s, d)),
        "yearly_distance_duration": lambda s, d: analytics.yearly_distance_duration(_l_month_window(s, d)),
        "weighted_avg_fare": lambda s, d: analytics.weighted_avg_fare(_l_month_window(s, d)),
        "pareto_curve": lambda s, d: analytics.pareto_curve(_l_zone(s, d)),
        "pareto_80": lambda s, d: analytics.pareto_80(analytics.pareto_curve(_l_zone(s, d))),
        "month_extremes": lambda s, d: analytics.month_extremes(_l_month_window(s, d)),
        "cell_extremes": lambda s, d: analytics.cell_extremes(_e_time(s, d)),
        "recovery_month": lambda s, d: analytics.recovery(_gm(s, d), L_PRE_PERIOD_END_YEAR, materialize_input=False),
        "recovery_month_unbounded": lambda s, d: analytics.recovery(
            _gm_all(s, d), L_PRE_PERIOD_END_YEAR, materialize_input=False
        ),
        "first_latest_change": lambda s, d: analytics.first_latest_change(_l_month_window(s, d)),
        "insights": _insights,
        # sources, sinks, pipeline, incremental ingest
        "file_inventory": _inventory,
        "file_inventory_summary": lambda s, d: inventory_summary(list_files(s, d, "*.parquet")).crossJoin(
            _inventory(s, d).agg(F.sum("rows").alias("rows"))  # one row each
        ),
        "schema_drift_union": _schema_drift_union,
        "incremental_stream": lambda s, d: _incremental(s, d, ingest_stream, 1997, drift=False),
        "incremental_reconciled": lambda s, d: _incremental(s, d, ingest_reconciled, 1998, drift=True),
        "bronze_rebuild_then_ingest": _bronze_rebuild_then_ingest,
        "incremental_copies": _incremental_copies,
        "rescued_values": _rescued_values,
        "silver_after_increment": lambda s, d: _no_ingest_time(read_layer(s, _lake_after_increment(s, d), "silver")),
        "gold_after_increment": lambda s, d: read_layer(s, _lake_after_increment(s, d), "gold", "trips_by_month"),
        "stored_runs": _stored_runs,
        "managed_tables": _managed_tables,
        "pipeline_rounded_duration": lambda s, d: read_layer(s, _pipeline_lake(s, d, 2), "gold", "trips_by_month"),
        # orders, with the position of each row
        "month_series_order": lambda s, d: _positions(_l_month_bounded(s, d)).select("pickup_year", "pickup_month", "position"),
        "top_zones_display_order": lambda s, d: _positions(analytics.top_zones(_l_zone(s, d), TOP_K, ascending_for_display=True)),
        "cells_in_week_order": lambda s, d: _positions(analytics.cells_in_week_order(_e_time(s, d))).select(
            "pickup_day_of_week", "pickup_hour", "position"
        ),
        "file_order": lambda s, d: _positions(
            file_inventory(rows_per_file(s, d, "*.parquet").withColumnRenamed("file", "name"))
        ).select("file", "position"),
        "trips_by_month_net_amount": lambda s, d: gold.trips_by_month(_net_amounts(s, d)),
        "trips_by_zone_net_amount": lambda s, d: gold.trips_by_zone(_net_amounts(s, d)),
        "pipeline_trips_by_month": lambda s, d: read_layer(s, _pipeline_lake(s, d), "gold", "trips_by_month"),
        "pipeline_layer_counts": _pipeline_layer_counts,
    }
    if _llm is not None:
        q.update(_llm.queries())
    return q


# --------------------------------------------------------------------------- DuckDB oracle


def _r(x: str, n: int) -> str:
    """Spark's ROUND(double, n): HALF_UP on the shortest decimal text."""
    return f"CAST(ROUND(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def _nr(x: str, n: int) -> str:
    """numpy's round(float64, n): scale by 10**n, round half to even, scale back."""
    return f"(round_even(CAST(({x}) AS DOUBLE) * {10.0 ** n}, 0) / {10.0 ** n})"


def _pr(x: str, n: int) -> str:
    """Python's round(float, n): half to even on the exact binary value
    (fmt's fixed formatting rounds the same way)."""
    return f"CAST(format('{{:.{n}f}}', CAST(({x}) AS DOUBLE)) AS DOUBLE)"


def _q(c: str, k: int) -> str:
    return f"CAST(ROUND(({c}) * {k}) AS BIGINT)"


def _sum_d(c: str) -> str:
    """Exact decimal sum of the stored values, as a double."""
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,6))) AS DOUBLE)"


def _mean_d(c: str) -> str:
    return f"{_sum_d(c)} / NULLIF(CAST(COUNT({c}) AS DOUBLE), 0)"


def _mean_q(c: str, k: int) -> str:
    return f"CAST(SUM({_q(c, k)}) AS DOUBLE) / NULLIF(CAST(COUNT({c}) * {k} AS DOUBLE), 0)"


_NULL_D = "CAST(NULL AS DOUBLE)"

_RAW_COLS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
    "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
    "congestion_surcharge", "Airport_fee",
]

_E_RAW = f"""
SELECT
  CAST(event_id % 2 + 1 AS BIGINT) AS VendorID,
  CASE WHEN event_id % 97 = 13 THEN NULL ELSE started END AS tpep_pickup_datetime,
  CASE WHEN event_type = 'error' AND k % 10 = 0 THEN NULL
       WHEN event_id % 79 = 3 THEN started + to_milliseconds(500)
       ELSE started + to_seconds((event_id * 7919 + k * 60) % 46800 - 1200) END AS tpep_dropoff_datetime,
  CAST(CASE WHEN k % 12 = 11 THEN NULL ELSE k % 12 END AS DOUBLE) AS passenger_count,
  CASE WHEN event_id % 89 = 7 THEN -value ELSE value END AS trip_distance,
  CAST(1.0 AS DOUBLE) AS RatecodeID,
  'N' AS store_and_fwd_flag,
  CASE WHEN event_type = 'signup' AND k % 10 = 0 THEN NULL ELSE user_id END AS PULocationID,
  CAST((user_id * 7 + k) % 263 + 1 AS BIGINT) AS DOLocationID,
  CAST(k % 4 + 1 AS BIGINT) AS payment_type,
  CAST(CAST(value AS DECIMAL(12,2)) * 2 + 1 AS DOUBLE) AS fare_amount,
  {_NULL_D} AS extra, {_NULL_D} AS mta_tax, {_NULL_D} AS tip_amount, {_NULL_D} AS tolls_amount,
  {_NULL_D} AS improvement_surcharge,
  CAST(CAST(value AS DECIMAL(12,2)) * 3 - 5 AS DOUBLE) AS total_amount,
  {_NULL_D} AS congestion_surcharge, {_NULL_D} AS Airport_fee
FROM (SELECT * REPLACE (CASE WHEN event_id % 79 = 3 THEN date_trunc('second', started) ELSE started END AS started)
      FROM (SELECT *, (event_id * 37 + user_id * 11) % 100 AS k,
                   CASE WHEN event_id % 83 = 5 THEN ts - INTERVAL 2190 DAY ELSE ts END AS started FROM events))
"""

_L_RAW = f"""
SELECT
  CAST(l_linenumber % 2 + 1 AS BIGINT) AS VendorID,
  l_shipdate AS tpep_pickup_datetime,
  l_shipdate + to_minutes(CAST(l_quantity AS BIGINT) * l_linenumber * 3) AS tpep_dropoff_datetime,
  CAST(NULLIF(l_linenumber + 3, 4) AS DOUBLE) AS passenger_count,
  l_quantity * 5 AS trip_distance,
  CAST(1.0 AS DOUBLE) AS RatecodeID,
  CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  l_suppkey AS PULocationID,
  CAST(l_partkey % 263 + 1 AS BIGINT) AS DOLocationID,
  CAST(l_linenumber % 4 + 1 AS BIGINT) AS payment_type,
  l_extendedprice * (1 - l_discount) AS fare_amount,
  {_NULL_D} AS extra, l_tax AS mta_tax, {_NULL_D} AS tip_amount, {_NULL_D} AS tolls_amount,
  {_NULL_D} AS improvement_surcharge,
  l_extendedprice AS total_amount,
  {_NULL_D} AS congestion_surcharge, {_NULL_D} AS Airport_fee
FROM lineitem
"""


def _bronze_sql(raw: str) -> str:
    return f"SELECT {', '.join(_RAW_COLS)}, 'nyc_tlc_yellow' AS _source FROM ({raw})"


def _silver_sql(
    bronze_sql: str,
    min_year: int = 2019,
    max_amount: float = 1000.0,
    upper: str | None = None,
    duration_scale: int | None = None,
) -> str:
    secs = (
        "CAST(epoch(date_trunc('second', tpep_dropoff_datetime)) AS BIGINT)"
        " - CAST(epoch(date_trunc('second', tpep_pickup_datetime)) AS BIGINT)"
    )
    bound = f"AND tpep_pickup_datetime < TIMESTAMP '{upper}'" if upper else ""
    duration = "_secs / 60" if duration_scale is None else _r("_secs / 60", duration_scale)
    return f"""
SELECT {', '.join(_RAW_COLS)}, _source,
  {duration} AS trip_duration_min,
  CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
  CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
  CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week,
  CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
  CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
  {_r("trip_distance / NULLIF((_secs / 60) / 60, 0)", 1)} AS avg_speed_mph
FROM (SELECT *, {secs} AS _secs FROM ({bronze_sql}))
WHERE tpep_pickup_datetime IS NOT NULL
  AND tpep_dropoff_datetime IS NOT NULL
  AND tpep_dropoff_datetime > tpep_pickup_datetime
  AND _secs / 60 < 720
  AND trip_distance >= 0 AND trip_distance < 200
  AND total_amount > 0 AND total_amount < {max_amount}
  AND (passenger_count IS NULL OR passenger_count BETWEEN 1 AND 9)
  AND tpep_pickup_datetime >= TIMESTAMP '{min_year}-01-01 00:00:00'
  {bound}
"""


def _rule_report_sql(bronze_sql: str) -> str:
    secs = (
        "(CAST(epoch(date_trunc('second', tpep_dropoff_datetime)) AS BIGINT)"
        " - CAST(epoch(date_trunc('second', tpep_pickup_datetime)) AS BIGINT))"
    )
    rules = [
        ("pickup_present", "tpep_pickup_datetime IS NOT NULL"),
        ("dropoff_present", "tpep_dropoff_datetime IS NOT NULL"),
        ("dropoff_after_pickup", "tpep_dropoff_datetime > tpep_pickup_datetime"),
        ("duration_below_max", f"{secs} / 60 < 720"),
        ("distance_at_least_min", "trip_distance >= 0"),
        ("distance_below_max", "trip_distance < 200"),
        ("amount_above_min", "total_amount > 0"),
        ("amount_below_max", "total_amount < 1000"),
        ("passengers_valid", "(passenger_count IS NULL OR passenger_count BETWEEN 1 AND 9)"),
        ("pickup_from_min_year", "tpep_pickup_datetime >= TIMESTAMP '2019-01-01 00:00:00'"),
    ]
    keep = " AND ".join(f"({p})" for _, p in rules)
    fails = ",\n  ".join(
        f"CAST(count_if(NOT COALESCE({p}, FALSE)) AS BIGINT) AS failed_{n}" for n, p in rules
    )
    return f"""
SELECT CAST(COUNT(*) AS BIGINT) AS bronze_rows,
  CAST(count_if({keep}) AS BIGINT) AS silver_rows,
  CAST(count_if(NOT COALESCE({keep}, FALSE)) AS BIGINT) AS removed_rows,
  {fails}
FROM ({bronze_sql})
"""


def _month_sql(silver_sql: str, duration_per_minute: int = 60) -> str:
    return f"""
SELECT pickup_year, pickup_month, CAST(COUNT(*) AS BIGINT) AS trip_count,
  {_r(_sum_d("total_amount"), 2)} AS total_revenue,
  {_r(_mean_d("total_amount"), 2)} AS avg_fare,
  {_r(_mean_d("trip_distance"), 2)} AS avg_distance_miles,
  {_r(_mean_q("trip_duration_min", duration_per_minute), 1)} AS avg_duration_min,
  {_r(_mean_d("passenger_count"), 2)} AS avg_passengers
FROM ({silver_sql}) GROUP BY pickup_year, pickup_month
"""


def _zone_sql(silver_sql: str, drop_null: bool = True) -> str:
    where = "WHERE PULocationID IS NOT NULL" if drop_null else ""
    return f"""
SELECT PULocationID AS zone_id, CAST(COUNT(*) AS BIGINT) AS pickups,
  {_r(_sum_d("total_amount"), 2)} AS total_revenue,
  {_r(_mean_d("total_amount"), 2)} AS avg_fare,
  {_r(_mean_d("trip_distance"), 2)} AS avg_distance_miles
FROM ({silver_sql}) {where} GROUP BY PULocationID
"""


def _time_sql(silver_sql: str) -> str:
    return f"""
SELECT pickup_hour, pickup_day_of_week, CAST(COUNT(*) AS BIGINT) AS trip_count,
  {_r(_mean_q("trip_duration_min", 60), 1)} AS avg_duration_min,
  {_r(_mean_d("total_amount"), 2)} AS avg_fare
FROM ({silver_sql}) GROUP BY pickup_hour, pickup_day_of_week
"""


_E_BRONZE = _bronze_sql(_E_RAW)
_L_BRONZE = _bronze_sql(_L_RAW)
_E_SILVER = _silver_sql(_E_BRONZE)
_L_SILVER = _silver_sql(_L_BRONZE, min_year=1995, max_amount=100000.0)
_L_MONTH = _month_sql(_L_SILVER)
_L_MONTH_BOUNDED = f"""
SELECT *, make_date(pickup_year, pickup_month, 1) AS period,
  strftime(make_date(pickup_year, pickup_month, 1), '%Y-%m') AS period_label
FROM ({_L_MONTH})
WHERE pickup_year >= 1995 AND pickup_year * 12 + pickup_month - 1 < {2001 * 12 + 10}
"""
_L_ZONE = _zone_sql(_L_SILVER)
_E_TIME = _time_sql(_E_SILVER)

_RESCUED_SQL = """
WITH raw AS (
  SELECT CAST(l_linenumber AS VARCHAR) AS v,
    CASE WHEN l_orderkey % 10 = 3 THEN 'x' || l_linenumber WHEN l_orderkey % 10 = 4 THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS p,
    CASE WHEN l_partkey % 7 = 2 THEN l_suppkey || ' USD' ELSE CAST(l_suppkey AS VARCHAR) END AS t,
    CASE WHEN l_suppkey % 5 = 0 THEN 'N/A' ELSE CAST(l_suppkey AS VARCHAR) END AS z
  FROM lineitem
), typed AS (
  SELECT *, TRY_CAST(v AS BIGINT) AS VendorID, TRY_CAST(p AS DOUBLE) AS passenger_count,
    TRY_CAST(t AS DOUBLE) AS total_amount, TRY_CAST(z AS BIGINT) AS PULocationID
  FROM raw
)
SELECT 'passenger_count' AS rejected_column, p AS rejected_value, VendorID, passenger_count, total_amount, PULocationID
FROM typed WHERE passenger_count IS NULL
UNION ALL SELECT 'total_amount', t, VendorID, passenger_count, total_amount, PULocationID FROM typed WHERE total_amount IS NULL
UNION ALL SELECT 'PULocationID', z, VendorID, passenger_count, total_amount, PULocationID FROM typed WHERE PULocationID IS NULL
"""

_TABLES = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation",
    "orders", "pages", "part", "region", "supplier",
)

_DAY_ARRAY = "['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat']"


def _long_label(year: str, month: str) -> str:
    return f"strftime(make_date(CAST({year} AS INTEGER), CAST({month} AS INTEGER), 1), '%B %Y')"


def _pareto_sql(zone_sql: str) -> str:
    return f"""
SELECT zone_id, total_revenue,
  CAST(ROW_NUMBER() OVER w AS BIGINT) AS zone_rank,
  CAST(SUM(q) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
    / NULLIF(CAST(SUM(q) OVER () AS DOUBLE), 0) * 100 AS cum_pct,
  CAST(ROW_NUMBER() OVER w AS DOUBLE) / CAST(COUNT(*) OVER () AS DOUBLE) * 100 AS zone_pct
FROM (SELECT *, {_q("total_revenue", 100)} AS q FROM ({zone_sql}))
WINDOW w AS (ORDER BY total_revenue DESC, zone_id ASC)
"""


def _yearly_sql(month_sql: str) -> str:
    return f"""
SELECT pickup_year AS year,
  {_mean_q("avg_fare", 100)} AS avg_fare,
  {_mean_q("avg_distance_miles", 100)} AS avg_distance,
  {_mean_q("avg_duration_min", 10)} AS avg_duration
FROM ({month_sql}) GROUP BY pickup_year
"""


def _month_extremes_sql(month_sql: str) -> str:
    def one(metric: str, order: str) -> str:
        return f"""
SELECT '{metric}' AS metric, pickup_year, pickup_month,
  {_long_label("pickup_year", "pickup_month")} AS period_label, trip_count, total_revenue
FROM (SELECT * FROM ({month_sql}) ORDER BY {order}, pickup_year, pickup_month LIMIT 1)"""

    return " UNION ALL ".join(
        [
            one("peak", "trip_count DESC"),
            one("trough", "trip_count ASC"),
            one("best_revenue", "total_revenue DESC"),
        ]
    )


def _cell_extremes_sql(time_sql: str) -> str:
    def cell(metric: str, order: str) -> str:
        return f"""
SELECT '{metric}' AS metric, pickup_hour, pickup_day_of_week, trip_count
FROM (SELECT * FROM ({time_sql}) ORDER BY {order}, pickup_day_of_week, pickup_hour LIMIT 1)"""

    def peak(metric: str, weekend: str) -> str:
        return f"""
SELECT '{metric}' AS metric, pickup_hour, CAST(NULL AS INTEGER) AS pickup_day_of_week, trip_count
FROM (SELECT pickup_hour, CAST(SUM(trip_count) AS BIGINT) AS trip_count FROM ({time_sql})
      WHERE pickup_day_of_week IN (1, 7) = {weekend} GROUP BY pickup_hour
      ORDER BY trip_count DESC, pickup_hour LIMIT 1)"""

    parts = " UNION ALL ".join(
        [
            cell("busiest", "trip_count DESC"),
            cell("quietest", "trip_count ASC"),
            peak("weekday_peak_hour", "FALSE"),
            peak("weekend_peak_hour", "TRUE"),
        ]
    )
    return f"""
SELECT *, format('{{:02d}}:00', pickup_hour) AS hour_label,
  {_DAY_ARRAY}[pickup_day_of_week] AS day_name
FROM ({parts})
"""


def _recovery_sql(month_sql: str, pre_end_year: int) -> str:
    return f"""
WITH g AS (SELECT *, pickup_year * 12 + pickup_month - 1 AS mk FROM ({month_sql})),
pre AS (SELECT MAX(CASE WHEN pickup_year < {pre_end_year} THEN trip_count END) AS pre_peak FROM g),
tr AS (SELECT mk, trip_count FROM g ORDER BY trip_count, mk LIMIT 1),
rec AS (SELECT MIN(g.mk) AS rk FROM g, tr, pre
        WHERE g.mk > tr.mk AND g.trip_count >= pre.pre_peak * CAST(0.8 AS DOUBLE))
SELECT pre.pre_peak AS pre_peak,
  pre.pre_peak * CAST(0.8 AS DOUBLE) AS threshold,
  {_long_label("tr.mk // 12", "tr.mk % 12 + 1")} AS trough_label,
  tr.trip_count AS trough_trips,
  CAST({_pr("(1 - CAST(tr.trip_count AS DOUBLE) / NULLIF(CAST(pre.pre_peak AS DOUBLE), 0)) * 100", 0)}
       AS BIGINT) AS trough_drop_pct,
  {_long_label("rec.rk // 12", "rec.rk % 12 + 1")} AS recovery_label,
  COALESCE({_long_label("rec.rk // 12", "rec.rk % 12 + 1")}, 'Not yet recovered') AS recovery_text
FROM pre, tr, rec
"""


def _first_latest_sql(month_sql: str) -> str:
    change = _nr("dist_latest - dist_first", 2)
    return f"""
WITH a AS (
  SELECT MIN(year) AS first_year, MAX(year) AS latest_year,
    arg_min(avg_fare, year) AS fare_first, arg_max(avg_fare, year) AS fare_latest,
    arg_min(avg_distance, year) AS dist_first, arg_max(avg_distance, year) AS dist_latest
  FROM ({_yearly_sql(month_sql)}))
SELECT first_year, latest_year, fare_first, fare_latest,
  {_nr("(fare_latest - fare_first) / NULLIF(fare_first, 0) * 100", 1)} AS fare_change_pct,
  {change} AS dist_change,
  CASE WHEN {change} >= 0 THEN '+' ELSE '' END || CAST({change} AS VARCHAR) || ' mi' AS dist_trend
FROM a
"""


def _insights_sql() -> str:
    ext = _month_extremes_sql(_L_MONTH_BOUNDED)
    rec = _recovery_sql(_L_MONTH_BOUNDED, L_PRE_PERIOD_END_YEAR)
    cells = _cell_extremes_sql(_E_TIME)
    chg = _first_latest_sql(_L_MONTH_BOUNDED)
    fare = f"""SELECT CAST(SUM({_q("avg_fare", 100)} * trip_count) AS DOUBLE)
         / NULLIF(CAST(SUM(trip_count) * 100 AS DOUBLE), 0) AS v FROM ({_L_MONTH_BOUNDED})"""

    def ex(metric: str, c: str) -> str:
        return f"(SELECT {c} FROM ext WHERE metric = '{metric}')"

    def cl(metric: str, c: str) -> str:
        return f"(SELECT {c} FROM cells WHERE metric = '{metric}')"

    def ch(c: str) -> str:
        return f"(SELECT {c} FROM chg)"

    def rc(c: str) -> str:
        return f"(SELECT {c} FROM rec)"

    def hour(h: str) -> str:
        return f"format('{{:02d}}:00', {h})"

    pct = ch("fare_change_pct")
    first, latest = f"CAST({ch('first_year')} AS VARCHAR)", f"CAST({ch('latest_year')} AS VARCHAR)"
    rows = [
        ("Volume", "'Peak month'",
         f"{ex('peak', 'period_label')} || ' — ' || format('{{:,}}', {ex('peak', 'trip_count')}) || ' trips'"),
        ("Volume", "'COVID trough'",
         f"{ex('trough', 'period_label')} || ' — ' || format('{{:,}}', {ex('trough', 'trip_count')})"
         f" || ' trips (−' || CAST({rc('trough_drop_pct')} AS VARCHAR) || '% vs pre-COVID peak)'"),
        ("Volume", "'80% recovery after COVID'", f"{rc('recovery_text')} || ' (≥80% of pre-COVID peak)'"),
        ("Revenue", "'Best revenue month'",
         f"{ex('best_revenue', 'period_label')} || ' — $' || format('{{:,.0f}}', {ex('best_revenue', 'total_revenue')})"),
        ("Revenue", f"'Average fare (' || {first} || '–now)'", "'$' || format('{:.2f}', (SELECT v FROM fare))"),
        ("Demand patterns", "'Busiest hour (weekday)'", hour(cl("weekday_peak_hour", "pickup_hour"))),
        ("Demand patterns", "'Busiest hour (weekend)'", hour(cl("weekend_peak_hour", "pickup_hour"))),
        ("Demand patterns", "'Quietest hour'",
         f"{hour(cl('quietest', 'pickup_hour'))} || ' on ' || {cl('quietest', 'day_name')}"),
        ("Trip characteristics", f"'Avg fare increase since ' || {first}",
         f"'$' || format('{{:.2f}}', {ch('fare_first')}) || ' → $' || format('{{:.2f}}', {ch('fare_latest')})"
         f" || ' (' || CASE WHEN {pct} >= 0 THEN '+' ELSE '' END || CAST({pct} AS VARCHAR) || '%)'"),
        ("Trip characteristics", f"'Avg trip distance change (' || {first} || '→' || {latest} || ')'",
         ch("dist_trend")),
    ]
    selects = " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS INTEGER) AS position, '{cat}' AS category, {metric} AS metric, {value} AS value"
        for i, (cat, metric, value) in enumerate(rows)
    )
    return f"""
WITH ext AS ({ext}), rec AS ({rec}), cells AS ({cells}), chg AS ({chg}), fare AS ({fare})
{selects}
"""


def oracle_sql() -> dict[str, str]:
    no_ts = ", ".join(_RAW_COLS + ["_source"])
    silver_cols = no_ts + (
        ", trip_duration_min, pickup_date, pickup_hour, pickup_day_of_week, pickup_month,"
        " pickup_year, avg_speed_mph"
    )
    e_silver_gold = {
        ("Bronze", "tlc_trips_raw"): _E_BRONZE,
        ("Silver", "tlc_trips"): _E_SILVER,
        ("Gold", "trips_by_month"): _month_sql(_E_SILVER),
        ("Gold", "trips_by_zone"): _zone_sql(_E_SILVER),
        ("Gold", "time_patterns"): _E_TIME,
    }
    layer_counts = " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS \"table\", CAST(COUNT(*) AS BIGINT) AS rows FROM ({sql})"
        for (layer, name), sql in e_silver_gold.items()
    )
    n_months = (L_COVERAGE_AS_OF.year - L_COVERAGE_START_YEAR) * 12 + max(L_COVERAGE_AS_OF.month - 2, 1)
    calendar = (
        f"SELECT CAST({L_COVERAGE_START_YEAR} + i // 12 AS INTEGER) AS year,"
        f" CAST(i % 12 + 1 AS INTEGER) AS month FROM range({n_months}) t(i)"
    )
    loaded = (
        "SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,"
        " CAST(month(tpep_pickup_datetime) AS INTEGER) AS month, COUNT(*) AS trips"
        f" FROM ({_L_BRONZE}) WHERE tpep_pickup_datetime IS NOT NULL GROUP BY 1, 2"
    )
    rows_per_file = " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file, CAST(COUNT(*) AS BIGINT) AS rows FROM {t}" for t in _TABLES
    )
    net_amounts = f"SELECT * REPLACE (fare_amount AS total_amount) FROM ({_L_SILVER})"
    rounded_month = _month_sql(
        _silver_sql(_L_BRONZE, min_year=1995, max_amount=100000.0, duration_scale=2), duration_per_minute=100
    )
    own: dict[str, str] = {
        "bronze_contract": _L_BRONZE,
        "silver_trips": f"SELECT {silver_cols} FROM ({_E_SILVER})",
        "silver_bounded_month": _silver_sql(
            _L_BRONZE, min_year=1995, max_amount=100000.0, upper="1999-07-01 00:00:00"
        ),
        "silver_rule_report": _rule_report_sql(_E_BRONZE),
        "silver_rounded_duration": f"SELECT {silver_cols} FROM ({_silver_sql(_E_BRONZE, duration_scale=2)})",
        "trips_by_month_rounded_duration": rounded_month,
        "trips_by_month": _L_MONTH,
        "trips_by_zone": _zone_sql(_E_SILVER),
        "trips_by_zone_with_null": _zone_sql(_E_SILVER, drop_null=False),
        "time_patterns": _E_TIME,
        "load_validation": f"""
SELECT CAST(COUNT(*) AS BIGINT) AS row_count,
  MIN(tpep_pickup_datetime) AS earliest_pickup, MAX(tpep_pickup_datetime) AS latest_pickup,
  CAST(COUNT(DISTINCT date_trunc('month', tpep_pickup_datetime)) AS BIGINT) AS months_loaded
FROM ({_L_BRONZE})""",
        "layer_counts": layer_counts,
        "retention": f"""
SELECT b AS bronze_rows, s AS silver_rows,
  {_nr("CAST(s AS DOUBLE) / NULLIF(CAST(b AS DOUBLE), 0) * 100", 1)} AS retention_pct
FROM (SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM ({_E_BRONZE})) AS b,
             (SELECT CAST(COUNT(*) AS BIGINT) FROM ({_E_SILVER})) AS s)""",
        "month_coverage": f"""
SELECT c.year, c.month, CAST(COALESCE(l.trips, 0) AS BIGINT) AS trips, COALESCE(l.trips, 0) = 0 AS missing
FROM ({calendar}) c LEFT JOIN ({loaded}) l ON c.year = l.year AND c.month = l.month""",
        "missing_months": f"""
SELECT c.year, c.month FROM ({calendar}) c
WHERE NOT EXISTS (SELECT 1 FROM ({loaded}) l WHERE l.year = c.year AND l.month = c.month)""",
        "month_series": _L_MONTH_BOUNDED,
        "top_zones": f"SELECT * FROM ({_L_ZONE}) ORDER BY pickups DESC, zone_id ASC LIMIT {TOP_K}",
        "monthly_chart": f"""
SELECT period_label, CAST(trip_count AS DOUBLE) / CAST(1000000 AS DOUBLE) AS trips_millions,
  total_revenue / CAST(1000000 AS DOUBLE) AS revenue_millions
FROM ({_L_MONTH_BOUNDED})""",
        "demand_heatmap": f"""
SELECT pickup_hour, format('{{:02d}}:00', pickup_hour) AS hour_label,
  {", ".join(
      f"CAST(SUM(CASE WHEN pickup_day_of_week = {i + 1} THEN trip_count END) AS BIGINT) AS {n}"
      for i, n in enumerate(["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"])
  )}
FROM ({_E_TIME}) GROUP BY pickup_hour""",
        "weekday_weekend_by_hour": f"""
SELECT pickup_hour, pickup_day_of_week IN (1, 7) AS is_weekend, CAST(SUM(trip_count) AS BIGINT) AS trip_count
FROM ({_E_TIME}) GROUP BY 1, 2""",
        "yearly_fare": f"SELECT year, avg_fare FROM ({_yearly_sql(_L_MONTH_BOUNDED)})",
        "yearly_distance_duration": f"SELECT year, avg_distance, avg_duration FROM ({_yearly_sql(_L_MONTH_BOUNDED)})",
        "weighted_avg_fare": f"""
SELECT CAST(SUM({_q("avg_fare", 100)} * trip_count) AS DOUBLE)
         / NULLIF(CAST(SUM(trip_count) * 100 AS DOUBLE), 0) AS avg_fare_overall,
       CAST(SUM(trip_count) AS BIGINT) AS trip_count
FROM ({_L_MONTH_BOUNDED})""",
        "pareto_curve": _pareto_sql(_L_ZONE),
        "pareto_80": f"""
SELECT CAST(COUNT(*) AS BIGINT) AS zones, CAST(count_if(cum_pct <= 80) AS BIGINT) AS zones_within,
  {_pr("CAST(count_if(cum_pct <= 80) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100", 1)} AS pct_zones_for_share
FROM ({_pareto_sql(_L_ZONE)})""",
        "month_extremes": _month_extremes_sql(_L_MONTH_BOUNDED),
        "cell_extremes": _cell_extremes_sql(_E_TIME),
        "recovery_month": _recovery_sql(_L_MONTH_BOUNDED, L_PRE_PERIOD_END_YEAR),
        "recovery_month_unbounded": _recovery_sql(_L_MONTH, L_PRE_PERIOD_END_YEAR),
        "first_latest_change": _first_latest_sql(_L_MONTH_BOUNDED),
        "insights": _insights_sql(),
        # The driver's oracle runs at sf0.01; a file listing needs its folder.
        "file_inventory": f"""
SELECT f.file, f.size_mb, r.rows FROM (
  SELECT parse_filename(filename) AS file, {_pr("CAST(size AS DOUBLE) / CAST(1048576 AS DOUBLE)", 1)} AS size_mb
  FROM read_blob('{ORACLE_DIR}/*.parquet')) f LEFT JOIN ({rows_per_file}) r ON f.file = r.file""",
        "file_inventory_summary": f"""
SELECT CAST(COUNT(*) AS BIGINT) AS files,
  CAST(SUM({_q(_pr("CAST(size AS DOUBLE) / CAST(1048576 AS DOUBLE)", 1), 10)}) AS DOUBLE)
    / CAST(10240 AS DOUBLE) AS total_gb,
  (SELECT CAST(SUM(rows) AS BIGINT) FROM ({rows_per_file})) AS rows
FROM read_blob('{ORACLE_DIR}/*.parquet')""",
        "bronze_rebuild_then_ingest": _L_BRONZE,
        "managed_tables": f"""
SELECT pickup_year, PULocationID, CAST(COUNT(*) AS BIGINT) AS trips FROM ({_L_SILVER}) GROUP BY ALL""",
        "pipeline_rounded_duration": rounded_month,
        "month_series_order": f"""
SELECT pickup_year, pickup_month, ROW_NUMBER() OVER (ORDER BY pickup_year, pickup_month) AS position
FROM ({_L_MONTH_BOUNDED})""",
        "top_zones_display_order": f"""
SELECT *, ROW_NUMBER() OVER (ORDER BY pickups, zone_id DESC) AS position
FROM (SELECT * FROM ({_L_ZONE}) ORDER BY pickups DESC, zone_id ASC LIMIT {TOP_K})""",
        "cells_in_week_order": f"""
SELECT pickup_day_of_week, pickup_hour, ROW_NUMBER() OVER (ORDER BY pickup_day_of_week, pickup_hour) AS position
FROM ({_E_TIME})""",
        "file_order": f"""
SELECT file, ROW_NUMBER() OVER (ORDER BY file) AS position
FROM (SELECT parse_filename(filename) AS file FROM read_blob('{ORACLE_DIR}/*.parquet'))""",
        "trips_by_month_net_amount": _month_sql(net_amounts),
        "trips_by_zone_net_amount": _zone_sql(net_amounts),
        "schema_drift_union": _L_BRONZE,
        "incremental_stream": _L_BRONZE,
        "incremental_reconciled": _L_BRONZE,
        "incremental_copies": _L_BRONZE,
        "rescued_values": _RESCUED_SQL,
        "silver_after_increment": _L_SILVER,
        "gold_after_increment": _L_MONTH,
        "stored_runs": f"""
WITH bronze AS (SELECT year(tpep_pickup_datetime) = 1997 AS late FROM ({_L_BRONZE})),
  silver AS (SELECT *, year(tpep_pickup_datetime) = 1997 AS late FROM ({_L_SILVER})),
  runs AS (SELECT false AS second UNION ALL SELECT true)
SELECT step, 'done' AS state, CAST(n AS BIGINT) AS rows FROM (
  SELECT 'bronze' AS step, COUNT(*) AS n FROM bronze GROUP BY late
  UNION ALL SELECT 'silver', COUNT(*) FROM silver GROUP BY late
  UNION ALL SELECT 'trips_by_month', (SELECT COUNT(DISTINCT (pickup_year, pickup_month)) FROM silver WHERE second OR NOT late) FROM runs
  UNION ALL SELECT 'trips_by_zone', (SELECT COUNT(DISTINCT PULocationID) FROM silver WHERE second OR NOT late) FROM runs
  UNION ALL SELECT 'time_patterns', (SELECT COUNT(DISTINCT (pickup_hour, pickup_day_of_week)) FROM silver WHERE second OR NOT late) FROM runs
)""",
        "pipeline_trips_by_month": _L_MONTH,
        "pipeline_layer_counts": " UNION ALL ".join(
            f"SELECT '{layer}' AS layer, '{name}' AS \"table\", CAST(COUNT(*) AS BIGINT) AS rows FROM ({sql})"
            for (layer, name), sql in {
                ("Bronze", "tlc_trips_raw"): _L_BRONZE,
                ("Silver", "tlc_trips"): _L_SILVER,
                ("Gold", "trips_by_month"): _L_MONTH,
                ("Gold", "trips_by_zone"): _L_ZONE,
                ("Gold", "time_patterns"): _time_sql(_L_SILVER),
            }.items()
        ),
    }
    if _llm is not None:
        own.update(_llm.oracle_sql())
    return own
