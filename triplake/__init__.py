"""triplake: a Spark-native trip-record lakehouse.

Raw monthly trip files -> bronze (typed, reconciled) -> silver (quality rules,
derived columns, partitioned by pickup year/month) -> gold (monthly, zone and
hour x weekday aggregates) -> report analytics over gold.

Every transformation is a plain ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; I/O lives in ``triplake.sources``, ``triplake.plans``
and ``triplake.streaming``.
"""

from triplake.config import Lake, QualityRules, parse_month
from triplake.contracts import BRONZE_SCHEMA, RAW_SCHEMA

__all__ = ["BRONZE_SCHEMA", "RAW_SCHEMA", "Lake", "QualityRules", "parse_month"]
