"""Map the bundled benchmark tables onto the raw trip contract.

The test data has no taxi table, so two adapters derive raw trips from it.
They are row-wise projections (no window, no join): their cost grows
linearly with the source table and they never gather a key into one task.
The engine itself only knows the trip columns.

Adapter E (``events``): one January of trips with varied hours and weekdays.
  pickup = ts; trip length in seconds = (event_id * 7919 + k * 60) mod 46800 - 1200,
  so some trips end before they start, exactly at pickup, or after 12 hours;
  error events with k divisible by 10 have no dropoff; signup events with
  k divisible by 10 have no pickup zone; distance = value;
  total = value * 3 - 5 (in cents); party = k mod 12 with 11 meaning unknown.
  k = (event_id * 37 + user_id * 11) mod 100, a cheap per-row pseudo-random
  digit pair (id arithmetic only: the quality filter is pushed below this
  projection and repeats it per rule, so it must stay cheap).
  So that every rule has rows that fail it, id arithmetic also gives: no
  pickup (event_id mod 97 = 13), a negative distance (mod 89 = 7), a pickup
  2,190 days earlier (mod 83 = 5) and a trip of half a second, which has no
  speed (mod 79 = 3).

Adapter L (``lineitem``): seven years of trips for monthly/yearly analytics.
  pickup = l_shipdate; dropoff = pickup + l_quantity * l_linenumber * 3 minutes;
  distance = 5 * l_quantity; total = l_extendedprice;
  party = l_linenumber + 3 with 4 meaning unknown; pickup zone = l_suppkey.
  Use ``LINEITEM_RULES`` (pickups from 1995, amounts below 100,000).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.config import QualityRules
from triplake.contracts import RAW_SCHEMA
from triplake.operators.bronze import to_contract

EVENTS_RULES = QualityRules()
LINEITEM_RULES = QualityRules(min_year=1995, max_amount=100000.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(c):
    return c.cast("decimal(12,2)")


def events_trips(events: DataFrame) -> DataFrame:
    """Raw trips (``RAW_SCHEMA``) from the ``events`` table."""
    k = (F.col("event_id") * 37 + F.col("user_id") * 11) % 100
    value = F.col("value")
    secs = (F.col("event_id") * 7919 + k * 60) % 46800 - 1200
    no_dropoff = (F.col("event_type") == "error") & (k % 10 == 0)
    no_zone = (F.col("event_type") == "signup") & (k % 10 == 0)
    party = k % 12

    def every(n: int, rest: int):
        return F.col("event_id") % n == rest

    start = F.when(every(83, 5), F.timestamp_add("DAY", F.lit(-2190), F.col("ts"))).otherwise(F.col("ts"))
    start = F.when(every(79, 3), F.date_trunc("second", start).cast("timestamp_ntz")).otherwise(start)
    end = F.when(every(79, 3), F.timestamp_add("MILLISECOND", F.lit(500), start)).otherwise(F.timestamp_add("SECOND", secs, start))
    trips = events.select(
        (F.col("event_id") % 2 + 1).alias("VendorID"),
        F.when(~every(97, 13), start).alias("tpep_pickup_datetime"),
        F.when(~no_dropoff, end).alias("tpep_dropoff_datetime"),
        F.when(party == 11, F.lit(None)).otherwise(party).cast("double").alias("passenger_count"),
        F.when(every(89, 7), -value).otherwise(value).alias("trip_distance"),
        F.lit(1.0).alias("RatecodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        F.when(no_zone, F.lit(None)).otherwise(F.col("user_id")).alias("PULocationID"),
        ((F.col("user_id") * 7 + k) % 263 + 1).alias("DOLocationID"),
        (k % 4 + 1).alias("payment_type"),
        (_cents(value) * 2 + 1).cast("double").alias("fare_amount"),
        (_cents(value) * 3 - 5).cast("double").alias("total_amount"),
    )
    return to_contract(trips, RAW_SCHEMA)


def lineitem_trips(lineitem: DataFrame) -> DataFrame:
    """Raw trips (``RAW_SCHEMA``) from the ``lineitem`` table."""
    minutes = F.col("l_quantity").cast("long") * F.col("l_linenumber") * 3
    trips = lineitem.select(
        (F.col("l_linenumber") % 2 + 1).alias("VendorID"),
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.timestamp_add("MINUTE", minutes, F.col("l_shipdate")).alias("tpep_dropoff_datetime"),
        F.nullif(F.col("l_linenumber") + 3, F.lit(4)).cast("double").alias("passenger_count"),
        (F.col("l_quantity") * 5).alias("trip_distance"),
        F.lit(1.0).alias("RatecodeID"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("store_and_fwd_flag"),
        F.col("l_suppkey").alias("PULocationID"),
        (F.col("l_partkey") % 263 + 1).alias("DOLocationID"),
        (F.col("l_linenumber") % 4 + 1).alias("payment_type"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("fare_amount"),
        F.col("l_tax").alias("mta_tax"),
        F.col("l_extendedprice").alias("total_amount"),
    )
    return to_contract(trips, RAW_SCHEMA)


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_trips(table(spark, sf_dir, "events"))


def lineitem_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_trips(table(spark, sf_dir, "lineitem"))
