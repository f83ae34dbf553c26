"""Silver: named quality rules and derived trip columns.

All rules are conjunctive and a NULL rule result drops the row, as a SQL
WHERE clause does.  The rules only touch columns of one row, so silver is a
narrow transformation: no shuffle, and the constant bounds on the pickup
timestamp reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.config import QualityRules
from triplake.contracts import DROPOFF, PICKUP
from triplake.functions.timecols import elapsed_seconds, ntz


def quality_rules(rules: QualityRules = QualityRules()) -> list[tuple[str, Column]]:
    """The silver rules as ``(name, predicate)`` pairs, in a fixed order."""
    pick, drop = F.col(PICKUP), F.col(DROPOFF)
    dist, amount, party = F.col("trip_distance"), F.col("total_amount"), F.col("passenger_count")
    out = [
        ("pickup_present", pick.isNotNull()),
        ("dropoff_present", drop.isNotNull()),
        ("dropoff_after_pickup", drop > pick),
        ("duration_below_max", elapsed_seconds(pick, drop) / 60 < F.lit(rules.max_minutes)),
        ("distance_at_least_min", dist >= F.lit(rules.min_distance)),
        ("distance_below_max", dist < F.lit(rules.max_distance)),
        ("amount_above_min", amount > F.lit(rules.min_amount)),
        ("amount_below_max", amount < F.lit(rules.max_amount)),
        (
            "passengers_valid",
            party.isNull() | party.between(F.lit(rules.min_passengers), F.lit(rules.max_passengers)),
        ),
        # year(pickup) >= min_year, written as a range so Parquet can skip row groups
        ("pickup_from_min_year", pick >= ntz(rules.min_year)),
    ]
    if rules.upper_bound is not None:
        out.append(("pickup_within_last_month", pick < ntz(*rules.upper_bound)))
    return out


def all_rules(rules: QualityRules = QualityRules()) -> Column:
    return reduce(lambda a, b: a & b, [p for _, p in quality_rules(rules)])


def apply_quality_rules(df: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    return df.where(all_rules(rules))


def derived_columns(duration_scale: int | None = None) -> dict[str, Column]:
    """Duration (minutes, from whole seconds), calendar parts and speed.

    ``duration_scale`` rounds the duration to that many decimals (the warehouse
    variant); ``None`` keeps it unrounded.  Speed uses the unrounded duration
    and is NULL for a trip shorter than one second instead of failing.
    """
    pick = F.col(PICKUP)
    minutes = elapsed_seconds(pick, F.col(DROPOFF)) / 60
    duration = minutes if duration_scale is None else F.round(minutes, duration_scale)
    return {
        "trip_duration_min": duration,
        "pickup_date": F.to_date(pick),
        "pickup_hour": F.hour(pick),
        "pickup_day_of_week": F.dayofweek(pick),
        "pickup_month": F.month(pick),
        "pickup_year": F.year(pick),
        "avg_speed_mph": F.round(F.try_divide(F.col("trip_distance"), minutes / 60), 1),
    }


def with_derived_columns(df: DataFrame, duration_scale: int | None = None) -> DataFrame:
    return df.withColumns(derived_columns(duration_scale))


def silver(
    bronze: DataFrame, rules: QualityRules = QualityRules(), duration_scale: int | None = None
) -> DataFrame:
    """Bronze -> silver: rules, then derived columns (one fused projection)."""
    return with_derived_columns(apply_quality_rules(bronze, rules), duration_scale)


def rule_report(bronze: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """One pass over bronze: rows in, rows kept, rows removed and, per rule,
    the rows failing it (a row can fail several rules)."""
    named = quality_rules(rules)
    keep = reduce(lambda a, b: a & b, [p for _, p in named])
    return bronze.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(keep).alias("silver_rows"),
        F.count_if(~F.coalesce(keep, F.lit(False))).alias("removed_rows"),
        *[F.count_if(~F.coalesce(p, F.lit(False))).alias(f"failed_{n}") for n, p in named],
    )
