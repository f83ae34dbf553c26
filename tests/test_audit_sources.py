"""Audits, file listings, schema-drift reads, incremental ingest and the pipeline run."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.trips import frame, trip
from triplake.config import Lake
from triplake.contracts import GOLD_TABLES, INGESTED_AT
from triplake.operators import audit
from triplake.operators.bronze import bronze
from triplake.plans.pipeline import read_layer, run_pipeline, write_bronze
from triplake.plans import tables
from triplake.session import scratch_path
from triplake.sources.adapters import LINEITEM_RULES, lineitem_raw
from triplake.sources.files import file_inventory, list_files, require_files
from triplake.sources.parquet import read_reconciled
from triplake.streaming.incremental import Added, ingest_reconciled, ingest_stream


def test_expected_months_calendar(spark):
    cal = audit.expected_months(spark, 2019, dt.date(2020, 5, 10)).collect()
    assert len(cal) == 12 + 3
    assert (cal[-1].year, cal[-1].month) == (2020, 3)
    jan = audit.expected_months(spark, 2020, dt.date(2020, 1, 10)).collect()
    assert [(r.year, r.month) for r in jan] == [(2020, 1)]


def test_missing_months(spark):
    rows = [trip(tpep_pickup_datetime=dt.datetime(2019, m, 3), tpep_dropoff_datetime=dt.datetime(2019, m, 3, 1))
            for m in (1, 2, 4)]
    b = bronze(frame(spark, rows))
    missing = audit.missing_months(b, 2019, dt.date(2019, 7, 1)).collect()
    assert [(r.year, r.month) for r in missing] == [(2019, 3), (2019, 5)]


def test_require_files_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        require_files(spark, str(tmp_path))


def test_file_sizes_round_like_the_report(spark, tmp_path):
    # 0.25 MB and 0.75 MB are exact ties: Python's round gives 0.2 and 0.8
    sizes = {"a.parquet": 262_144, "b.parquet": 786_432, "c.parquet": 1_100_000}
    for name, n in sizes.items():
        (tmp_path / name).write_bytes(b"x" * n)
    inv = {r.file: r.size_mb for r in file_inventory(list_files(spark, str(tmp_path), "*.parquet")).collect()}
    assert inv == {name: round(n / 1_048_576, 1) for name, n in sizes.items()} == {
        "a.parquet": 0.2, "b.parquet": 0.8, "c.parquet": 1.0}


def test_retention_rounds_like_numpy(spark):
    import numpy as np
    from triplake.functions.measures import numpy_round

    pairs = [(1, 16), (1, 8), (3, 8), (5, 8), (7, 16), (2, 3), (123_457, 200_000), (87_450, 100_000), (1, 1)]
    df = spark.createDataFrame(pairs, "s long, b long").select(
        numpy_round(F.col("s").cast("double") / F.col("b").cast("double") * 100, 1).alias("pct"))
    got = [r.pct for r in df.collect()]
    assert got == [float(round(np.int64(s) / np.int64(b) * 100, 1)) for s, b in pairs]


def test_file_inventory_prunes_content(spark):
    listing = list_files(spark, SF_SMALL, "*.parquet")
    inv = file_inventory(listing).collect()
    assert [r.file for r in inv] == sorted(r.file for r in inv)
    assert {r.file for r in inv} >= {"lineitem.parquet", "events.parquet"}
    plan = file_inventory(listing)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].split("\n")[0]


def _landing(spark, drift):
    import __spark_entry__ as e

    folder = scratch_path(spark, "test-landing")
    e._write_landing(lineitem_raw(spark, SF_SMALL), folder, drift=drift)
    return folder


def test_schema_drift_reconciled(spark):
    folder = _landing(spark, drift=True)
    got = bronze(read_reconciled(spark, folder, glob="*.parquet")).drop(INGESTED_AT)
    want = bronze(lineitem_raw(spark, SF_SMALL)).drop(INGESTED_AT)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_incremental_stream_adds_only_new_files(spark):
    root = scratch_path(spark, "test-incr")
    raw = lineitem_raw(spark, SF_SMALL)
    raw.where(F.year("tpep_pickup_datetime") <= 1997).write.parquet(f"{root}/in")
    first = ingest_stream(spark, f"{root}/in", Lake(f"{root}/out"), f"{root}/ck", glob="*.parquet")
    assert ingest_stream(spark, f"{root}/in", Lake(f"{root}/out"), f"{root}/ck", glob="*.parquet") == Added()
    raw.where(F.year("tpep_pickup_datetime") > 1997).write.mode("append").parquet(f"{root}/in")
    second = ingest_stream(spark, f"{root}/in", Lake(f"{root}/out"), f"{root}/ck", glob="*.parquet")
    assert first.rows + second.rows == raw.count()
    assert read_layer(spark, Lake(f"{root}/out"), "bronze").count() == raw.count()


def test_incremental_reconciled(spark):
    folder = _landing(spark, drift=True)
    root = scratch_path(spark, "test-incr-drift")
    ingest_reconciled(spark, folder, Lake(f"{root}/out"), f"{root}/ck", glob="*.parquet", max_files_per_trigger=2)
    assert ingest_reconciled(spark, folder, Lake(f"{root}/out"), f"{root}/ck", glob="*.parquet") == Added()
    got = read_layer(spark, Lake(f"{root}/out"), "bronze")
    assert got.count() == lineitem_raw(spark, SF_SMALL).count()


def test_pipeline_run_report_and_invariants(spark):
    folder = _landing(spark, drift=False)
    lake = Lake(scratch_path(spark, "test-lake"))
    report = run_pipeline(spark, folder, lake, LINEITEM_RULES, glob="*.parquet")
    assert report.complete and report.bronze_rows == lineitem_raw(spark, SF_SMALL).count()
    silver = read_layer(spark, lake, "silver")
    assert silver.count() == report.silver_rows <= report.bronze_rows
    # every gold table accounts for every silver trip
    for name in ("trips_by_month", "time_patterns"):
        assert read_layer(spark, lake, "gold", name).agg(F.sum("trip_count")).first()[0] == report.silver_rows
    assert read_layer(spark, lake, "gold", "trips_by_zone").agg(F.sum("pickups")).first()[0] == report.silver_rows
    assert set(report.gold_rows) == set(GOLD_TABLES)
    # silver is partitioned by pickup year and month
    parts = spark.sql(f"SHOW PARTITIONS {tables.current(spark, lake.table('silver')).table}").collect()
    assert all(p[0].startswith("pickup_year=") and "/pickup_month=" in p[0] for p in parts)
    stored = {r["step"]: r for r in read_layer(spark, lake, "gold", "run_report").collect()}
    assert set(stored) == {"bronze", "silver", *GOLD_TABLES} and {r["state"] for r in stored.values()} == {"done"}
    assert stored["silver"]["rows"] == report.silver_rows and stored["trips_by_zone"]["inputs"]


def test_failed_gold_table_is_reported_and_others_are_written(spark, monkeypatch):
    from triplake.operators import gold as gold_ops

    folder = _landing(spark, drift=False)
    lake = Lake(scratch_path(spark, "test-lake-fail"))
    broken = dict(gold_ops.GOLD_FINISHERS)
    broken["trips_by_zone"] = lambda cells, opts: cells.select("no_such_column")
    monkeypatch.setattr("triplake.plans.pipeline.GOLD_FINISHERS", broken)
    report = run_pipeline(spark, folder, lake, LINEITEM_RULES, glob="*.parquet", raise_on_failure=False)
    assert set(report.failed) == {"trips_by_zone"} and not report.complete
    assert set(report.gold_rows) == {"trips_by_month", "time_patterns"}
    assert read_layer(spark, lake, "gold", "time_patterns").count() == report.gold_rows["time_patterns"]
    with pytest.raises(RuntimeError, match="trips_by_zone"):
        run_pipeline(spark, folder, Lake(scratch_path(spark, "test-lake-fail2")), LINEITEM_RULES, glob="*.parquet")


def test_command_line_steps(spark):
    from triplake.__main__ import main

    folder = _landing(spark, drift=True)
    lake = scratch_path(spark, "test-cli")
    common = ["--lake", lake, "--min-year", "1995", "--max-amount", "100000"]
    assert main(["bronze", "--raw", folder, "--glob", "*.parquet", "--reconcile", *common])["bronze_rows"] > 0
    silver_rows = main(["silver", "--cluster", *common])["silver_rows"]
    gold = main(["gold", *common])
    assert not gold["failed"] and set(gold["gold_rows"]) == set(GOLD_TABLES)
    rep = main(["report", "--last-month", "2001-10", "--pre-period-end-year", "1996", "--raw", folder,
                "--glob", "*.parquet", *common])
    assert len(rep["insights"]) == 10 and 0 < len(rep["top_zones"]) <= 15  # sf0.001 has 10 zones
    counts = {r["table"]: r["rows"] for r in rep["layer_counts"]}
    assert counts["tlc_trips"] == silver_rows == rep["retention"][0]["silver_rows"]
    assert sum(r["trip_count"] for r in rep["weekday_weekend_by_hour"]) == silver_rows
    series = [(r["pickup_year"], r["pickup_month"]) for r in rep["month_series"]]
    assert series == sorted(series) and series[-1] <= (2001, 10) and len(rep["monthly_chart"]) == len(series)
    assert rep["pareto_curve"][-1]["cum_pct"] == pytest.approx(100.0) and len(rep["pareto_80"]) == 1
    assert len(rep["demand_heatmap"]) <= 24 and [r["year"] for r in rep["yearly_fare"]] == list(range(1995, 2002))
    assert rep["file_inventory_summary"][0]["files"] == len(rep["file_inventory"]) > 0
    aud = main(["audit", "--start-year", "1994", "--as-of", "2001-12-15", *common])
    assert len(aud["missing_months"]) == 12 and silver_rows > 0


def test_incremental_counts_every_micro_batch(spark):
    root = scratch_path(spark, "test-incr-many")
    raw = lineitem_raw(spark, SF_SMALL)
    raw.repartition(6).write.parquet(f"{root}/in")
    n = ingest_stream(spark, f"{root}/in", Lake(f"{root}/out"), f"{root}/ck", glob="*.parquet", max_files_per_trigger=1)
    assert (n.files, n.rows) == (6, raw.count())


def _trips(spark, n, day=1):
    when = dt.datetime(2020, 1, day)
    return frame(spark, [trip(VendorID=i, tpep_pickup_datetime=when, tpep_dropoff_datetime=when + dt.timedelta(hours=1)) for i in range(n)])


def _land(spark, folder, n, name, day=1):
    """One raw file of ``n`` trips under a given name."""
    import glob
    import shutil

    part = scratch_path(spark, "part")
    _trips(spark, n, day).coalesce(1).write.parquet(part)
    local = folder.replace("file:", "")
    os.makedirs(local, exist_ok=True)
    shutil.copy(glob.glob(f"{part.replace('file:', '')}/*.parquet")[0], f"{local}/{name}")
    return f"{local}/{name}"


def test_rebuild_and_increments_share_bronze(spark):
    root = scratch_path(spark, "test-rebuild")
    landing, lake = f"{root}/in", Lake(f"{root}/lake")
    run = lambda ck: ingest_stream(spark, landing, lake, f"{root}/{ck}", glob="*.parquet")
    first = _land(spark, landing, 10, "a.parquet")
    assert run("ck") == Added(1, 10)
    assert write_bronze(spark, landing, lake, glob="*.parquet") == 10
    # a late file with an old time stamp, and the first one archived
    late = _land(spark, landing, 7, "b.parquet", 2)
    then = dt.datetime.now().timestamp() - 30 * 86400
    os.utime(late, (then, then))
    os.rename(first, first + ".archived")
    assert run("ck") == Added(1, 7)
    assert read_layer(spark, lake, "bronze").count() == 17
    # a new checkpoint and the file back under its name add nothing
    os.rename(first + ".archived", first)
    assert run("ck-new") == Added()
    assert read_layer(spark, lake, "bronze").count() == 17
    # a rebuild supersedes the increments
    assert write_bronze(spark, landing, lake, glob="*.parquet") == 17
    assert read_layer(spark, lake, "bronze").count() == 17 and run("ck-new") == Added()


def test_failed_rebuild_keeps_the_table(spark):
    root = scratch_path(spark, "test-failed")
    landing, lake = f"{root}/in", Lake(f"{root}/lake")
    _land(spark, landing, 10, "a.parquet")
    write_bronze(spark, landing, lake, glob="*.parquet")
    with open(f"{landing.replace('file:', '')}/b.parquet", "wb") as f:
        f.write(b"no parquet file")
    with pytest.raises(Exception):
        write_bronze(spark, landing, lake, glob="*.parquet", files_per_batch=1)
    assert read_layer(spark, lake, "bronze").count() == 10
    # the failed version and its list of files go, the table stays
    assert len(tables.drop_superseded(spark, lake.table("bronze"))) == 2
    assert read_layer(spark, lake, "bronze").count() == 10


def test_bronze_batches_and_drift_under_another_zone(spark):
    folder = _landing(spark, drift=True)
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    lake = Lake(scratch_path(spark, "test-zone"))
    assert write_bronze(other, folder, lake, glob="*.parquet", files_per_batch=3) == lineitem_raw(spark, SF_SMALL).count()
    got = read_layer(spark, lake, "bronze").drop(INGESTED_AT)
    want = bronze(lineitem_raw(spark, SF_SMALL)).drop(INGESTED_AT)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_nothing_published(spark):
    with pytest.raises(FileNotFoundError, match="nothing is published"):
        read_layer(spark, Lake(scratch_path(spark, "none")), "bronze")


def test_rules_all_fire(spark):
    import __spark_entry__ as e

    row = e.queries()["silver_rule_report"](spark, "/root/testdata/sf0.01").first().asDict()
    assert all(n > 0 for k, n in row.items() if k.startswith("failed_")), row
    assert e.queries()["silver_trips"](spark, "/root/testdata/sf0.01").where("avg_speed_mph is null").count() > 0
