"""Boundary rows per silver rule (one change from a kept base row)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.trips import frame, trip
from triplake.config import QualityRules
from triplake.operators.bronze import bronze
from triplake.operators.silver import rule_report, silver

T = dt.datetime
P = T(2024, 3, 5, 8, 0, 0)

CASES = [
    ("base", {}, True),
    ("pickup null", {"tpep_pickup_datetime": None}, False),
    ("dropoff null", {"tpep_dropoff_datetime": None}, False),
    ("dropoff = pickup", {"tpep_dropoff_datetime": P}, False),
    ("dropoff before", {"tpep_dropoff_datetime": T(2024, 3, 5, 7, 59)}, False),
    (
        "sub-second",
        {"tpep_pickup_datetime": T(2024, 3, 5, 8, 0, 0, 200000), "tpep_dropoff_datetime": T(2024, 3, 5, 8, 0, 0, 900000)},
        True,
    ),
    ("719m59s", {"tpep_dropoff_datetime": P + dt.timedelta(minutes=719, seconds=59)}, True),
    ("720m", {"tpep_dropoff_datetime": P + dt.timedelta(minutes=720)}, False),
    ("distance 0", {"trip_distance": 0.0}, True),
    ("distance -0.1", {"trip_distance": -0.1}, False),
    ("distance null", {"trip_distance": None}, False),
    ("distance 199.99", {"trip_distance": 199.99}, True),
    ("distance 200", {"trip_distance": 200.0}, False),
    ("total 0", {"total_amount": 0.0}, False),
    ("total 0.01", {"total_amount": 0.01}, True),
    ("total null", {"total_amount": None}, False),
    ("total 999.99", {"total_amount": 999.99}, True),
    ("total 1000", {"total_amount": 1000.0}, False),
    ("flat rate", {"fare_amount": 0.0}, True),
    ("party null", {"passenger_count": None}, True),
    ("party 0", {"passenger_count": 0.0}, False),
    ("party 9", {"passenger_count": 9.0}, True),
    ("party 10", {"passenger_count": 10.0}, False),
    (
        "2018-12-31 23:59:59",
        {"tpep_pickup_datetime": T(2018, 12, 31, 23, 59, 59), "tpep_dropoff_datetime": T(2019, 1, 1, 0, 10)},
        False,
    ),
    ("2019-01-01 00:00", {"tpep_pickup_datetime": T(2019, 1, 1), "tpep_dropoff_datetime": T(2019, 1, 1, 0, 10)}, True),
    ("zone null", {"PULocationID": None}, True),
]


@pytest.fixture(scope="module")
def cases(spark):
    rows = [trip(**c, VendorID=i) for i, (_, c, _) in enumerate(CASES)]
    return silver(bronze(frame(spark, rows))).collect()


def test_each_boundary_row(cases):
    kept = {r.VendorID for r in cases}
    for i, (name, _, expect) in enumerate(CASES):
        assert (i in kept) == expect, name


def test_derived_columns(cases):
    base = next(r for r in cases if r.VendorID == 0)
    assert base.trip_duration_min == 20.0
    assert (base.pickup_hour, base.pickup_day_of_week, base.pickup_month, base.pickup_year) == (8, 3, 3, 2024)
    assert base.pickup_date == dt.date(2024, 3, 5)
    assert base.avg_speed_mph == 9.0
    sub = next(r for r in cases if r.VendorID == 5)
    assert sub.trip_duration_min == 0.0 and sub.avg_speed_mph is None
    zero = next(r for r in cases if r.VendorID == 8)
    assert zero.avg_speed_mph == 0.0


def test_last_month_bound(spark):
    rows = [
        trip(VendorID=1, tpep_pickup_datetime=T(2025, 11, 30, 23, 50), tpep_dropoff_datetime=T(2025, 12, 1, 0, 5)),
        trip(VendorID=2, tpep_pickup_datetime=T(2025, 12, 1), tpep_dropoff_datetime=T(2025, 12, 1, 0, 5)),
    ]
    out = silver(bronze(frame(spark, rows)), QualityRules(last_month="2025-11")).collect()
    assert [r.VendorID for r in out] == [1]


def test_rule_report_counts(spark):
    rows = [trip(**c, VendorID=i) for i, (_, c, _) in enumerate(CASES)]
    r = rule_report(bronze(frame(spark, rows))).first()
    assert r.bronze_rows == len(CASES)
    assert r.silver_rows == sum(1 for *_, keep in CASES if keep)
    assert r.removed_rows == r.bronze_rows - r.silver_rows
    assert r.failed_passengers_valid == 2
    assert r.failed_distance_below_max == 2  # 200 and NULL
    assert r.failed_distance_at_least_min == 2  # -0.1 and NULL


def test_duration_scale_variant(spark):
    rows = [trip(tpep_dropoff_datetime=P + dt.timedelta(seconds=61))]
    r = silver(bronze(frame(spark, rows)), duration_scale=2).first()
    assert r.trip_duration_min == 1.02


def test_silver_has_no_python_udf(spark):
    plan = silver(bronze(frame(spark, [trip()])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_ingest_metadata(spark):
    row = bronze(frame(spark, [trip()])).select("_source", F.col("_ingested_at").isNotNull().alias("t")).first()
    assert row._source == "nyc_tlc_yellow" and row.t
