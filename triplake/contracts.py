"""Column contracts for every layer.

The raw/bronze trip columns follow the public yellow-taxi data dictionary.
Timestamps are TIMESTAMP_NTZ end to end: the raw files carry wall-clock times
without a zone, and reading them as zoned instants would shift hours by the
session time zone.
"""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Raw trip file columns, in file order.
RAW_SCHEMA = StructType(
    [
        StructField("VendorID", LongType(), True),
        StructField("tpep_pickup_datetime", TimestampNTZType(), True),
        StructField("tpep_dropoff_datetime", TimestampNTZType(), True),
        StructField("passenger_count", DoubleType(), True),
        StructField("trip_distance", DoubleType(), True),
        StructField("RatecodeID", DoubleType(), True),
        StructField("store_and_fwd_flag", StringType(), True),
        StructField("PULocationID", LongType(), True),
        StructField("DOLocationID", LongType(), True),
        StructField("payment_type", LongType(), True),
        StructField("fare_amount", DoubleType(), True),
        StructField("extra", DoubleType(), True),
        StructField("mta_tax", DoubleType(), True),
        StructField("tip_amount", DoubleType(), True),
        StructField("tolls_amount", DoubleType(), True),
        StructField("improvement_surcharge", DoubleType(), True),
        StructField("total_amount", DoubleType(), True),
        StructField("congestion_surcharge", DoubleType(), True),
        StructField("Airport_fee", DoubleType(), True),
    ]
)

# Ingestion metadata appended by bronze.
INGESTED_AT = "_ingested_at"
SOURCE = "_source"
SOURCE_NAME = "nyc_tlc_yellow"
RAW_FILE_GLOB = "yellow_tripdata_*.parquet"

# Beside the bronze columns: values that a cast lost, with their column.
RESCUED = "_rescued"
RESCUED_TYPE = "array<struct<column:string,value:string>>"

BRONZE_SCHEMA = StructType(
    RAW_SCHEMA.fields
    + [
        StructField(INGESTED_AT, TimestampNTZType(), False),
        StructField(SOURCE, StringType(), False),
    ]
)

# Derived silver columns, in output order.
SILVER_DERIVED = StructType(
    [
        StructField("trip_duration_min", DoubleType(), True),
        StructField("pickup_date", DateType(), True),
        StructField("pickup_hour", IntegerType(), True),
        StructField("pickup_day_of_week", IntegerType(), True),
        StructField("pickup_month", IntegerType(), True),
        StructField("pickup_year", IntegerType(), True),
        StructField("avg_speed_mph", DoubleType(), True),
    ]
)
# Silver and its partitions.
SILVER_SCHEMA = StructType(BRONZE_SCHEMA.fields + SILVER_DERIVED.fields)
SILVER_PARTITION_COLUMNS = ("pickup_year", "pickup_month")

# Columns that the rules and the gold tables use.
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
ZONE = "PULocationID"

# The gold tables, their keys and their columns in order.
GOLD_TABLES = ("trips_by_month", "trips_by_zone", "time_patterns")
GOLD_KEYS = {
    "trips_by_month": ("pickup_year", "pickup_month"),
    "trips_by_zone": (ZONE,),
    "time_patterns": ("pickup_hour", "pickup_day_of_week"),
}
GOLD_COLUMNS = {
    "trips_by_month": (
        "pickup_year", "pickup_month", "trip_count", "total_revenue", "avg_fare", "avg_distance_miles",
        "avg_duration_min", "avg_passengers",
    ),
    "trips_by_zone": ("zone_id", "pickups", "total_revenue", "avg_fare", "avg_distance_miles"),
    "time_patterns": ("pickup_hour", "pickup_day_of_week", "trip_count", "avg_duration_min", "avg_fare"),
}
