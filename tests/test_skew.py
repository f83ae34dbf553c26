"""Hot keys: one zone, one month and one pickup second holding a third of all trips."""

import datetime as dt
from collections import defaultdict

from pyspark.sql import functions as F

from tests.trips import frame, trip
from triplake.config import Lake
from triplake.contracts import PICKUP, RAW_SCHEMA, ZONE
from triplake.operators import gold
from triplake.operators.bronze import bronze
from triplake.operators.silver import silver
from triplake.plans.pipeline import write_bronze, write_silver
from triplake.plans.tables import current
from triplake.session import scratch_path

N = 3000
HOT_ZONE = 7
HOT_SECOND = dt.datetime(2024, 3, 5, 8, 0, 0)


def _rows():
    """Every third trip starts in the hot second in the hot zone; the rest are
    spread over 2024.  All rows pass the default quality rules."""
    rows = []
    for i in range(N):
        hot = i % 3 == 0
        pick = HOT_SECOND if hot else dt.datetime(2024, 1 + i % 12, 1 + i % 28, i % 24, i % 60)
        rows.append(
            trip(
                tpep_pickup_datetime=pick,
                tpep_dropoff_datetime=pick + dt.timedelta(minutes=5 + i % 50),
                PULocationID=HOT_ZONE if hot else 100 + i % 50,
                total_amount=1 + (i % 997) / 100,
                trip_distance=(i % 300) / 10,
            )
        )
    return rows


def test_gold_with_a_hot_zone_and_month_matches_brute_force(spark):
    rows = _rows()
    cents, trips = defaultdict(int), defaultdict(int)
    month_trips = defaultdict(int)
    at = {f.name: i for i, f in enumerate(RAW_SCHEMA.fields)}
    for r in rows:
        zone, pick = r[at[ZONE]], r[at[PICKUP]]
        cents[zone] += round(r[at["total_amount"]] * 100)
        trips[zone] += 1
        month_trips[(pick.year, pick.month)] += 1
    assert trips[HOT_ZONE] == N // 3 and max(month_trips.values()) > N // 3
    for parts in (1, 7):
        s = silver(bronze(frame(spark, rows).repartition(parts)))
        zones = {r.zone_id: (r.pickups, r.total_revenue) for r in gold.trips_by_zone(s).collect()}
        assert zones == {z: (trips[z], round(cents[z] / 100, 2)) for z in trips}
        months = {(r.pickup_year, r.pickup_month): r.trip_count for r in gold.trips_by_month(s).collect()}
        assert months == dict(month_trips)


def test_clustered_silver_splits_a_hot_pickup_second(spark):
    lake = Lake(scratch_path(spark, "test-hot-second"))
    write_bronze(spark, frame(spark, _rows()).repartition(5), lake)
    # keep the four range partitions apart, as they would be at scale
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        kept = write_silver(spark, lake, cluster=True, cluster_bytes_per_task=4096)
    finally:
        spark.conf.set(key, before)
    assert kept == N
    hot = (
        spark.table(current(spark, lake.table("silver")).table)
        .where((F.col("pickup_year") == 2024) & (F.col("pickup_month") == 3) & (F.col(PICKUP) == HOT_SECOND))
        .groupBy(F.col("_metadata.file_path"))
        .count()
        .collect()
    )
    assert sum(r["count"] for r in hot) == N // 3
    # the hot second (a third of all rows) is written by several tasks, not one
    assert len(hot) >= 2 and max(r["count"] for r in hot) < N // 3


def test_range_shuffle_is_sized_by_the_input():
    from triplake.plans.pipeline import CLUSTER_BYTES_PER_TASK, range_partitions

    # the count follows the bytes at every size
    assert range_partitions(0, CLUSTER_BYTES_PER_TASK) == 1
    assert range_partitions(20 * 1024**2, 1024**2) == 20
    # 100 TB would be 500 GB per partition at 200
    assert range_partitions(100 * 1024**4, CLUSTER_BYTES_PER_TASK) == 819_200
