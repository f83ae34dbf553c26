"""Hand-made raw trips for boundary tests (FIXTURES.md section 4)."""

import datetime as dt

from triplake.contracts import RAW_SCHEMA

BASE = {
    "VendorID": 1,
    "tpep_pickup_datetime": dt.datetime(2024, 3, 5, 8, 0, 0),
    "tpep_dropoff_datetime": dt.datetime(2024, 3, 5, 8, 20, 0),
    "passenger_count": 1.0,
    "trip_distance": 3.0,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 100,
    "DOLocationID": 200,
    "payment_type": 1,
    "fare_amount": 12.0,
    "extra": 0.0,
    "mta_tax": 0.5,
    "tip_amount": 1.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 15.0,
    "congestion_surcharge": 1.2,
    "Airport_fee": 0.0,
}


def trip(**changes):
    row = dict(BASE, **changes)
    return tuple(row[f.name] for f in RAW_SCHEMA.fields)


def frame(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)
