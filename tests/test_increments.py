"""Increments: content identity of files, touched months, mergeable gold,
values that casts lose, runs that continue."""

import datetime as dt
import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tests.trips import frame, trip
from triplake.config import GoldOptions, Lake, QualityRules
from triplake.contracts import GOLD_TABLES, INGESTED_AT
from triplake.operators import gold as gold_ops
from triplake.plans import pipeline, tables
from triplake.plans.inspect import plan_text
from triplake.plans.pipeline import read_layer, run_pipeline, write_bronze, write_gold, write_silver
from triplake.session import scratch_path
from triplake.sources.files import ConflictingFiles, list_files, rows_per_file
from triplake.streaming.incremental import Added, ingest_reconciled, ingest_stream

RULES = QualityRules()


def land(spark, folder, name, n, month=1, **changes):
    """One raw file of ``n`` trips of a month of 2020 under a given name."""
    when = dt.datetime(2020, month, 5, 8)
    rows = [trip(VendorID=i, PULocationID=i % 4, tpep_pickup_datetime=when, tpep_dropoff_datetime=when + dt.timedelta(minutes=30), **changes) for i in range(n)]
    part = scratch_path(spark, "part").replace("file:", "")
    frame(spark, rows).coalesce(1).write.parquet(part)
    os.makedirs(folder, exist_ok=True)
    shutil.copy(glob.glob(f"{part}/*.parquet")[0], f"{folder}/{name}")
    return f"{folder}/{name}"


def files_by_month(spark, lake):
    """The data files of silver's months."""
    rows = spark.table(tables.current(spark, lake.table("silver")).table)
    found = rows.groupBy("pickup_month").agg(F.collect_set("_metadata.file_path").alias("files"))
    return {r["pickup_month"]: set(r["files"]) for r in found.collect()}


def everything(spark, lake):
    return {n: sorted(map(str, read_layer(spark, lake, "gold", n).collect())) for n in GOLD_TABLES}


@pytest.fixture
def place(spark):
    root = scratch_path(spark, "test-increments").replace("file:", "")
    return f"{root}/in", Lake(f"{root}/lake"), root


def test_different_files_of_one_name_stop_the_ingest(spark, place):
    landing, lake, root = place
    a = land(spark, f"{landing}/2023", "trips.parquet", 5)
    b = land(spark, f"{landing}/2024", "trips.parquet", 6)
    for add in (
        lambda: ingest_reconciled(spark, f"{landing}/*", lake, f"{root}/ck0", glob="*.parquet"),
        lambda: write_bronze(spark, f"{landing}/*", lake, glob="*.parquet"),
    ):
        with pytest.raises(Exception, match="different files of one name") as e:
            add()
        assert a in str(e.value) and b in str(e.value)
    assert tables.current(spark, lake.table("bronze")) is None


def test_changed_file_under_a_published_name_stops_the_ingest(spark, place):
    landing, lake, root = place
    path = land(spark, landing, "a.parquet", 5)
    assert ingest_stream(spark, landing, lake, f"{root}/ck", glob="*.parquet") == Added(1, 5)
    land(spark, landing, "b.parquet", 3)
    # the same number of bytes, other contents
    with open(path, "r+b") as f:
        f.seek(20)
        byte = f.read(1)
        f.seek(20)
        f.write(bytes([byte[0] ^ 1]))
    with pytest.raises(Exception, match="different files of one name: a.parquet"):
        ingest_stream(spark, landing, lake, f"{root}/ck2", glob="*.parquet")
    assert read_layer(spark, lake, "bronze").count() == 5
    with pytest.raises(ConflictingFiles):
        pipeline.add_to_bronze(spark, landing, lake, glob="*.parquet")


def test_copies_are_skipped_and_counted(spark, place):
    landing, lake, root = place
    a = land(spark, f"{landing}/x", "a.parquet", 5)
    os.makedirs(f"{landing}/y")
    shutil.copy(a, f"{landing}/y/a.parquet")
    first = ingest_stream(spark, f"{landing}/*", lake, f"{root}/ck", glob="*.parquet")
    assert first == Added(1, 5) and first.skipped == 1
    again = ingest_stream(spark, f"{landing}/*", lake, f"{root}/ck2", glob="*.parquet")
    assert again == Added() and again.skipped == 2
    assert write_bronze(spark, f"{landing}/*", lake, glob="*.parquet") == 5


def test_file_without_rows_is_published(spark, place):
    landing, lake, root = place
    land(spark, landing, "a.parquet", 2)
    land(spark, landing, "none.parquet", 1)
    empty = scratch_path(spark, "empty").replace("file:", "")
    frame(spark, []).coalesce(1).write.parquet(empty)
    shutil.copy(glob.glob(f"{empty}/*.parquet")[0], f"{landing}/none.parquet")
    assert ingest_stream(spark, landing, lake, f"{root}/ck", glob="*.parquet", max_files_per_trigger=1) == Added(2, 2)
    assert ingest_stream(spark, landing, lake, f"{root}/ck2", glob="*.parquet") == Added()


def test_failed_increment_can_be_repeated(spark, place, monkeypatch):
    landing, lake, root = place
    land(spark, landing, "a.parquet", 4)
    run_pipeline(spark, landing, lake, RULES, glob="*.parquet")
    land(spark, landing, "b.parquet", 3)
    from triplake.plans import bronze_files

    real = bronze_files.read_reconciled
    monkeypatch.setattr(bronze_files, "read_reconciled", lambda *a, **k: real(*a, **k).withColumn(INGESTED_AT, F.raise_error(F.lit("lost")).cast("timestamp_ntz")))
    with pytest.raises(Exception, match="lost"):
        pipeline.add_to_bronze(spark, landing, lake, glob="*.parquet")
    assert read_layer(spark, lake, "bronze").count() == 4
    monkeypatch.undo()
    assert pipeline.add_to_bronze(spark, landing, lake, glob="*.parquet") == Added(1, 3)
    assert read_layer(spark, lake, "bronze").count() == 7


def test_increment_touches_its_months_only_and_equals_a_rebuild(spark, place):
    landing, lake, _ = place
    for month in (1, 2, 3):
        land(spark, landing, f"m{month}.parquet", 10 + month, month)
    run_pipeline(spark, landing, lake, RULES, glob="*.parquet")
    before = files_by_month(spark, lake)
    land(spark, landing, "m2-late.parquet", 7, 2, total_amount=33.0)
    land(spark, landing, "m4.parquet", 5, 4)
    report = run_pipeline(spark, landing, lake, RULES, glob="*.parquet", resume=True)
    assert (report.bronze_rows, report.silver_rows) == (12, 12) and report.complete
    after = files_by_month(spark, lake)
    assert after[1] == before[1] and after[3] == before[3]
    assert after[2] > before[2] and after[4]
    rebuilt = Lake(scratch_path(spark, "test-rebuilt"))
    run_pipeline(spark, landing, rebuilt, RULES, glob="*.parquet")
    a, b = (read_layer(spark, at, "silver").drop(INGESTED_AT) for at in (lake, rebuilt))
    assert a.schema == b.schema and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert everything(spark, lake) == everything(spark, rebuilt)
    # nothing new: every layer is skipped
    report = run_pipeline(spark, landing, lake, RULES, glob="*.parquet", resume=True)
    assert report.complete and set(report.skipped) == {"bronze", "silver", *GOLD_TABLES} and not report.gold_rows


def test_gold_scans_the_increment_only(spark, place):
    landing, lake, _ = place
    land(spark, landing, "a.parquet", 20, 1)
    run_pipeline(spark, landing, lake, RULES, glob="*.parquet")
    assert pipeline.new_cells(spark, lake) is None
    land(spark, landing, "b.parquet", 6, 2)
    pipeline.add_to_bronze(spark, landing, lake, glob="*.parquet")
    pipeline.update_silver(spark, lake, RULES)
    new = pipeline.new_cells(spark, lake)
    assert new.where(gold_ops._cells_of(new, "trips_by_month").trips.isNotNull()).agg(F.sum("trips")).first()[0] == 3 * 6
    plan = plan_text(new, "simple")
    assert "PartitionFilters: [isnotnull(_batch" in plan or "PartitionFilters: [(_batch" in plan
    assert plan.count("FileScan") == 1 and len(new.inputFiles()) < len(spark.table(tables.current(spark, lake.table("silver")).table).inputFiles())
    write_gold(spark, lake)
    assert read_layer(spark, lake, "gold", "trips_by_month").agg(F.sum("trip_count")).first()[0] == 26


def test_other_rules_rebuild_silver_and_its_cells(spark, place):
    landing, lake, _ = place
    land(spark, landing, "a.parquet", 5, total_amount=15.0)
    land(spark, landing, "b.parquet", 3, total_amount=500.0)
    run_pipeline(spark, landing, lake, RULES, glob="*.parquet")
    strict = QualityRules(max_amount=100.0)
    report = run_pipeline(spark, landing, lake, strict, glob="*.parquet", resume=True)
    assert report.silver_rows == 5 and set(report.gold_rows) == set(GOLD_TABLES)
    assert read_layer(spark, lake, "gold", "trips_by_month").agg(F.sum("trip_count")).first()[0] == 5
    # a rebuilt bronze rebuilds silver too
    write_bronze(spark, landing, lake, glob="*.parquet")
    assert pipeline.update_silver(spark, lake, strict) == 5 and pipeline.update_silver(spark, lake, strict) is None


def test_cells_without_rows(spark, place):
    landing, lake, _ = place
    land(spark, landing, "a.parquet", 5, total_amount=-1.0)
    report = run_pipeline(spark, landing, lake, RULES, glob="*.parquet")
    assert report.complete and report.silver_rows == 0 and all(n == 0 for n in report.gold_rows.values())
    land(spark, landing, "b.parquet", 2)
    assert run_pipeline(spark, landing, lake, RULES, glob="*.parquet", resume=True).silver_rows == 2
    assert read_layer(spark, lake, "gold", "trips_by_month").first()["trip_count"] == 2


def test_rerun_writes_the_failed_table_alone(spark, place, monkeypatch):
    landing, lake, _ = place
    land(spark, landing, "a.parquet", 5)
    broken = dict(gold_ops.GOLD_FINISHERS)
    broken["trips_by_zone"] = lambda cells, opts: cells.select("no_such_column")
    monkeypatch.setattr("triplake.plans.pipeline.GOLD_FINISHERS", broken)
    report = run_pipeline(spark, landing, lake, RULES, glob="*.parquet", raise_on_failure=False)
    assert set(report.failed) == {"trips_by_zone"}
    monkeypatch.undo()
    versions = {n: tables.current(spark, lake.table("gold", n)) for n in GOLD_TABLES}
    assert versions["trips_by_zone"] is None
    layers = [tables.current(spark, lake.table(x)).table for x in ("bronze", "silver")]
    report = run_pipeline(spark, landing, lake, RULES, glob="*.parquet", resume=True)
    assert set(report.gold_rows) == {"trips_by_zone"} and report.complete
    assert set(report.skipped) == {"bronze", "silver", "trips_by_month", "time_patterns"}
    assert [tables.current(spark, lake.table(x)).table for x in ("bronze", "silver")] == layers
    for n in ("trips_by_month", "time_patterns"):
        assert tables.current(spark, lake.table("gold", n)).table == versions[n].table
    stored = read_layer(spark, lake, "gold", "run_report").where("step = 'trips_by_zone'").orderBy("at").collect()
    assert [r["state"] for r in stored] == ["failed", "done"] and "no_such_column" in stored[0]["error"]
    # other options are other inputs
    done, _, skipped = write_gold(spark, lake, GoldOptions(drop_null_zone=False), resume=True)
    assert set(done) == set(GOLD_TABLES) and not skipped


def test_readers_see_whole_layers_during_replacements(spark, place):
    import threading

    landing, lake, _ = place
    for month in (1, 2, 3):
        land(spark, landing, f"m{month}.parquet", 50, month)
    run_pipeline(spark, landing, lake, RULES, glob="*.parquet")
    counts, errors, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                counts.add(tuple(read_layer(spark, lake, layer).count() for layer in ("bronze", "silver")))
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for _ in range(2):
        write_bronze(spark, landing, lake, glob="*.parquet")
        write_silver(spark, lake, RULES)
    stop.set()
    reader.join()
    assert not errors and counts == {(150, 150)}
    for layer in ("bronze", "silver"):
        assert tables.drop_superseded(spark, lake.table(layer))
        assert read_layer(spark, lake, layer).count() == 150


def test_lost_values_are_counted_and_kept_with_their_rows(spark, place):
    landing, lake, root = place
    os.makedirs(landing)
    texts = spark.createDataFrame(
        [("1", "2.5", "7", "12.0"), ("x", "2.5", "", "12.0"), (None, "NaN?", "8", None), ("3", "1e2", "9", "$4")],
        "VendorID string, trip_distance string, PULocationID string, total_amount string")
    part = scratch_path(spark, "texts").replace("file:", "")
    texts.coalesce(1).write.parquet(part)
    shutil.copy(glob.glob(f"{part}/*.parquet")[0], f"{landing}/t.parquet")
    with pytest.raises(Exception):
        ingest_reconciled(spark, landing, lake, f"{root}/ck0", glob="*.parquet")
    added = ingest_reconciled(spark, landing, lake, f"{root}/ck", glob="*.parquet", rescue=True)
    assert added == Added(1, 4) and added.lost == {"VendorID": 1, "trip_distance": 1, "PULocationID": 1, "total_amount": 1}
    rejected = spark.table(lake.table("bronze") + "_rejected")
    got = {(r["rejected_column"], r["rejected_value"], r["total_amount"]) for r in rejected.collect()}
    assert got == {("VendorID", "x", 12.0), ("PULocationID", "", 12.0), ("trip_distance", "NaN?", None), ("total_amount", "$4", None)}
    assert "_rescued" not in read_layer(spark, lake, "bronze").columns
    assert write_bronze(spark, landing, lake, glob="*.parquet", rescue=True) == 4 and rejected.count() == 4


def test_rows_per_file_come_from_the_scan(spark, place):
    landing, _, _ = place
    for n in (3, 8):
        land(spark, landing, f"f{n}.parquet", n)
    spark.range(4).coalesce(1).write.parquet(f"{landing}/other")
    shutil.copy(glob.glob(f"{landing}/other/*.parquet")[0], f"{landing}/another.parquet")
    counted = rows_per_file(spark, landing, "*.parquet")
    assert {r["file"]: r["rows"] for r in counted.collect()} == {"f3.parquet": 3, "f8.parquet": 8, "another.parquet": 4}
    assert "ReadSchema: struct<>" in plan_text(counted, "simple")
    sizes = {r["name"]: r["length"] for r in list_files(spark, landing, "*.parquet").collect()}
    assert all(sizes[r["file"]] == r["length"] for r in counted.collect())


def test_command_line_resumes(spark, place):
    from triplake.__main__ import main

    landing, lake, _ = place
    land(spark, landing, "a.parquet", 5)
    common = ["--raw", landing, "--lake", lake.root, "--glob", "*.parquet"]
    assert main(["run", *common])["silver_rows"] == 5
    land(spark, landing, "b.parquet", 2, 3)
    out = main(["run", "--resume", *common])
    assert (out["bronze_rows"], out["silver_rows"]) == (2, 2) and out["gold_rows"]["trips_by_month"] == 2
    assert set(main(["run", "--resume", *common])["skipped"]) == {"bronze", "silver", *GOLD_TABLES}
