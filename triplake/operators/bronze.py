"""Bronze: coerce raw trips to the contract and stamp ingestion metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType

from triplake.contracts import INGESTED_AT, RAW_SCHEMA, RESCUED, RESCUED_TYPE, SOURCE, SOURCE_NAME


def utc_wall_clock(instant: Column) -> Column:
    """The UTC wall-clock time of an instant.  A plain cast would use the
    session's time zone."""
    seconds = F.unix_micros(instant).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def contract_columns(df: DataFrame, schema: StructType = RAW_SCHEMA, safe: bool = False) -> list[Column]:
    """One typed column per contract field.

    Names match case-insensitively (``airport_fee`` feeds ``Airport_fee``);
    a field missing from ``df`` becomes a typed NULL.  ``safe=True`` uses
    ``try_cast`` so malformed values turn into NULL instead of failing the job.
    A zoned instant becomes its UTC wall-clock time, whatever zone the session
    has.
    """
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for field in schema.fields:
        src = by_lower.get(field.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            c = F.col(f"`{src}`")
            if isinstance(df.schema[src].dataType, TimestampType) and isinstance(field.dataType, TimestampNTZType):
                c = utc_wall_clock(c)
            cols.append((c.try_cast(field.dataType) if safe else c.cast(field.dataType)).alias(field.name))
    return cols


def to_contract(df: DataFrame, schema: StructType = RAW_SCHEMA, safe: bool = False) -> DataFrame:
    """Cast projection onto ``schema`` (narrow: no shuffle, prunes unused columns)."""
    return df.select(*contract_columns(df, schema, safe))


def lost_values(df: DataFrame, schema: StructType = RAW_SCHEMA) -> Column:
    """The values that a safe cast onto ``schema`` turns into NULL, each with
    its column, as they were: a list that is empty for almost every row."""
    by_lower = {c.lower(): c for c in df.columns}
    lost = []
    for field in schema.fields:
        src = by_lower.get(field.name.lower())
        if src is None or df.schema[src].dataType == field.dataType or isinstance(df.schema[src].dataType, TimestampType):
            continue
        value = F.col(f"`{src}`")
        entry = F.struct(F.lit(field.name).alias("column"), value.cast("string").alias("value"))
        lost.append(F.when(value.isNotNull() & value.try_cast(field.dataType).isNull(), entry))
    return (F.filter(F.array(*lost), lambda v: v.isNotNull()) if lost else F.array()).cast(RESCUED_TYPE)


def with_ingestion_metadata(df: DataFrame, source: str = SOURCE_NAME) -> DataFrame:
    """Append ``_ingested_at`` (wall clock, NTZ) and ``_source``."""
    return df.withColumns(
        {
            INGESTED_AT: F.current_timestamp().cast("timestamp_ntz"),
            SOURCE: F.lit(source),
        }
    )


def bronze(raw: DataFrame, source: str = SOURCE_NAME, safe: bool = False) -> DataFrame:
    """Raw trips -> bronze rows (19 typed trip columns + metadata)."""
    return with_ingestion_metadata(to_contract(raw, RAW_SCHEMA, safe), source)


def bronze_with_rescue(raw: DataFrame, source: str = SOURCE_NAME, rescue: bool = True) -> DataFrame:
    """Bronze rows and ``_rescued``: with ``rescue`` malformed values become
    NULL and are listed there; without, they fail the job as in ``bronze``."""
    values = lost_values(raw) if rescue else F.array().cast(RESCUED_TYPE)
    typed = raw.select(*contract_columns(raw, RAW_SCHEMA, rescue), values.alias(RESCUED))
    return with_ingestion_metadata(typed, source)
