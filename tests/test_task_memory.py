"""Memory of one task, from the event log of a session of its own."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT

RUN = """
import sys
from pyspark.sql import functions as F
from triplake.config import Lake
from triplake.contracts import RAW_SCHEMA
from triplake.operators.bronze import to_contract
from triplake.plans import bronze_files, pipeline
from triplake.session import get_spark

out, sizes = sys.argv[1], [int(n) for n in sys.argv[2:]]
bronze_files.ROW_GROUP_BYTES = pipeline.READ_BYTES_PER_TASK = 256 * 1024
spark = get_spark("memory", master="local[2]", **{
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{out}/events", "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false", "spark.buffer.pageSize": "64k", "spark.sql.files.openCostInBytes": "1024",
    "spark.sql.warehouse.dir": f"{out}/tables", "spark.checkpoint.dir": f"{out}/kept", "spark.driver.host": "127.0.0.1",
    # as at scale: more partitions than a shuffle keeps files open for
    "spark.shuffle.sort.bypassMergeThreshold": "1",
})
for n in sizes:
    at = F.timestamp_add("SECOND", (F.col("id") * 7919 % 8_000_000).cast("int"), F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"))
    trips = spark.range(n).select(
        at.alias("tpep_pickup_datetime"), F.timestamp_add("MINUTE", F.lit(7), at).alias("tpep_dropoff_datetime"),
        F.rand(1).alias("trip_distance"), (F.rand(2) + 1).alias("total_amount"), F.rand(3).alias("tip_amount"), F.col("id").alias("PULocationID"))
    to_contract(trips, RAW_SCHEMA).coalesce(1).write.parquet(f"{out}/in-{n}")
    lake = Lake(f"{out}/lake-{n}")
    for step, run in (
        ("bronze", lambda: pipeline.write_bronze(spark, f"{out}/in-{n}", lake, reconcile=False, glob="*.parquet")),
        ("silver", lambda: pipeline.write_silver(spark, lake)),
        ("clustered", lambda: pipeline.write_silver(spark, lake, cluster=True, cluster_bytes_per_task=256 * 1024)),
    ):
        spark.sparkContext.setLocalProperty("step", f"{step} {n}")
        assert run() == n
spark.stop()
"""

INCREMENTS = RUN.split("for n in sizes:")[0] + """
for n in sizes:
    lake = Lake(f"{out}/lake-{n}")
    # a small first file, then an increment of one file of n rows
    for step, rows in (("full", 1_000), ("increment", n)):
        spark.sparkContext.setLocalProperty("step", "input")
        at = F.timestamp_add("SECOND", (F.col("id") * 7919 % 8_000_000).cast("int"), F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"))
        trips = spark.range(rows).select(
            at.alias("tpep_pickup_datetime"), F.timestamp_add("MINUTE", F.lit(7), at).alias("tpep_dropoff_datetime"),
            F.rand(1).alias("trip_distance"), (F.rand(2) + 1).alias("total_amount"), (F.col("id") % 50).alias("PULocationID"))
        to_contract(trips, RAW_SCHEMA).coalesce(1).write.mode("append").parquet(f"{out}/in-{n}")
        spark.sparkContext.setLocalProperty("step", f"{step} {n}")
        done = pipeline.run_pipeline(spark, f"{out}/in-{n}", lake, glob="*.parquet", reconcile=False, resume=step == "increment")
        assert (done.bronze_rows, done.silver_rows) == (rows, rows)
spark.stop()
"""


def peaks(folder, *args, script=RUN):
    """The largest execution memory of a task, by step."""
    os.makedirs(f"{folder}/events")
    env = {**os.environ, "PYTHONPATH": ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")}
    # another session than the one of the tests: it has its own event log
    env = {k: v for k, v in env.items() if not k.startswith("PYSPARK_GATEWAY")}
    done = subprocess.run([sys.executable, "-c", script, folder, *map(str, args)], cwd=folder, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    (log,) = os.listdir(f"{folder}/events")
    step, most = {}, {}
    with open(f"{folder}/events/{log}") as lines:
        for e in map(json.loads, lines):
            if e["Event"] == "SparkListenerJobStart":
                step |= {s: e["Properties"].get("step") for s in e["Stage IDs"]}
            elif e["Event"] == "SparkListenerTaskEnd":
                own = step[e["Stage ID"]]
                most[own] = max(most.get(own, 0), e["Task Metrics"]["Peak Execution Memory"])
    return most


def test_memory_of_a_task_does_not_follow_the_size_of_a_file(tmp_path):
    # the larger input has eight times the rows in one file
    most = peaks(str(tmp_path), 20_000, 160_000)
    # bronze streams its rows
    assert most["bronze 20000"] < 1024**2 and most["bronze 160000"] < 1024**2, most
    # silver sorts or shuffles a bounded part of them at a time
    assert most["silver 160000"] < 2 * most["silver 20000"], most
    assert most["clustered 160000"] < 2 * most["clustered 20000"], most


def test_memory_of_a_task_does_not_follow_the_size_of_an_increment(tmp_path):
    # bronze, silver, cells and gold of a run that continues
    most = peaks(str(tmp_path), 20_000, 160_000, script=INCREMENTS)
    assert most["increment 160000"] < 2 * most["increment 20000"], most
