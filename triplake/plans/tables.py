"""Tables whose replacement is one statement of the catalog.

A table of the lake is a view over its current version, a managed table with a
fresh name::

    schema.trips           view: the public columns of the current version
    schema.trips__<hex>    a version, partitioned by ``_batch`` last

A replacement fills a new version and then alters the view, so readers see
the old rows or the new ones, never none or some; a failed write leaves a
version that no view names.  An increment inserts its rows under a batch of
its own: Spark adds the batch's partitions to the catalog when the files are
committed, and a table without a batch's partitions does not have its rows.
Which batches a version holds is the catalog's list of partitions, so layers
are compared by batches: what one has and the next has not is its increment.

``drop_superseded`` drops the versions that no view names, with their files.
One writer per table at a time; any number of readers.  The catalog is the
session's own: sessions that run one after the other share tables through a
persistent one (as on a cluster), or attach a lake again by a full run.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BATCH = "_batch"
# Partitions of one insert become visible in one call of the catalog.
_ONE_CALL = ("spark.sql.addPartitionInBatch.size", "1000000")


def quoted(name: str) -> str:
    """A name of one or more levels, each level quoted."""
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def new_batch() -> str:
    return uuid.uuid4().hex


@dataclass(frozen=True)
class Version:
    """A version of a table, and what its writer noted of it."""

    table: str
    notes: Mapping[str, str]


def current(spark: SparkSession, name: str) -> Version | None:
    """The version that the view names; None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    properties = _properties(spark, name)
    if not properties:
        return None
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").where("col_name = 'View Text'").collect()
    found = re.search(r"__([0-9a-f]{32})`$", text[0]["data_type"]) if text else None
    own = f"triplake.{found[1]}." if found else "triplake."
    # a view of before the notes had the version in their names
    own = own if f"{own}version" in properties else "triplake."
    notes = {k.removeprefix(own): v for k, v in properties.items() if k.startswith(own)}
    return Version(notes.pop("version"), notes) if "version" in notes else None


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()
    return {r["key"]: r["value"] for r in rows if r["key"].startswith("triplake.")}


def new_version(
    spark: SparkSession, name: str, schema: StructType, partition_by: Sequence[str] = (), fmt: str = "parquet", batched: bool = False,
    options: Mapping[str, str] | None = None,
) -> str:
    """Creates an empty version of a table; returns its name.  ``batched``
    adds the batch as last partition column; ``options`` are those of the
    table's format, used by every write."""
    parts = [*partition_by, *([BATCH] if batched else [])]
    fields = [*schema.fields, *([StructField(BATCH, StringType())] if batched else [])]
    fields = [f for f in fields if f.name not in parts] + [f for p in parts for f in fields if f.name == p]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    partitioned = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
    listed = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in (options or {}).items())
    version = f"{name}__{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {quoted(version)} ({columns}) USING {fmt}{f' OPTIONS ({listed})' if listed else ''}{partitioned}")
    return version


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def insert_counted(
    df: DataFrame, version: str, observe: Mapping[str, Column] | None = None, batch: str | None = None
) -> dict[str, int]:
    """Inserts rows by column name; returns ``rows`` and what is observed,
    counted by the write itself.

    With ``batch`` all rows are of that batch, a constant of the statement:
    without other partition columns the tasks then stream their rows to one
    file.  For a column of batches each task sorts all its rows first."""
    spark, seen = df.sparkSession, Observation()
    counted = [F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in (observe or {}).items())]
    columns = [c for c in spark.table(version).columns if batch is None or c != BATCH]
    rows = df.observe(seen, *counted).select(*(F.col(f"`{c}`") for c in columns))
    with session_conf(spark, *_ONE_CALL):
        if batch is None:
            rows.write.insertInto(version)
        else:
            at = f"{quoted(version)} PARTITION (`{BATCH}` = {_text(batch)})"
            spark.sql(f"INSERT INTO {at} SELECT * FROM {{rows}}", rows=rows)
    return {k: int(v or 0) for k, v in seen.get.items()}


def switch(spark: SparkSession, name: str, version: str, columns: Sequence[str], notes: Mapping[str, str] | None = None) -> None:
    """Makes a version the current one, with ``columns`` as the public ones.

    A view that there is gets another query: ``CREATE OR REPLACE VIEW`` drops
    it first, so that a reader may find none.  The notes are stored before,
    under names of their version, so they take effect with it."""
    own = f"triplake.{version.rsplit('__', 1)[1]}."
    noted = {f"{own}{k}": v for k, v in {"version": version, **(notes or {})}.items()}
    listed = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in noted.items())
    query = f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {quoted(version)}"
    if current(spark, name) is None:
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} TBLPROPERTIES ({listed}) AS {query}")
        return
    spark.sql(f"ALTER VIEW {quoted(name)} SET TBLPROPERTIES ({listed})")
    spark.sql(f"ALTER VIEW {quoted(name)} AS {query}")
    if older := ", ".join(_text(k) for k in _properties(spark, name) if not k.startswith(own)):
        spark.sql(f"ALTER VIEW {quoted(name)} UNSET TBLPROPERTIES IF EXISTS ({older})")


def replace_table(
    df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] = (), notes: Mapping[str, str] | None = None
) -> int:
    """Replaces a table's rows and columns with those of ``df``; returns their
    number."""
    version = new_version(df.sparkSession, name, df.schema, partition_by, fmt)
    rows = insert_counted(df, version)["rows"]
    switch(df.sparkSession, name, version, df.columns, notes)
    return rows


def read_current(spark: SparkSession, name: str) -> DataFrame:
    """The public columns of a table."""
    if not spark.catalog.tableExists(name):
        raise FileNotFoundError(f"no table {name}: nothing is published")
    return spark.table(name)


def batches(spark: SparkSession, version: str | None) -> set[str]:
    """The batches of a version, from the catalog's partitions."""
    if version is None:
        return set()
    parts = spark.sql(f"SHOW PARTITIONS {quoted(version)}")
    own = F.regexp_extract("partition", f"{BATCH}=([^/]*)$", 1)
    return {r[0] for r in parts.select(own).distinct().collect()}


def stored_bytes(spark: SparkSession, version: str) -> int:
    """Bytes of a version's files, from their listing."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(version)}").where("col_name = 'Location'").collect()
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(rows[0]["data_type"])
    return listing.agg(F.sum("length")).first()[0] or 0


def drop_superseded(spark: SparkSession, name: str) -> list[str]:
    """Drops the versions that the view does not name, with their files; run
    it when no reader still uses them.  Returns their names."""
    live = current(spark, name)
    schema, _, table = name.rpartition(".")
    at = f" IN {quoted(schema)}" if schema else ""
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES{at} LIKE '{table}__*'").collect()]
    gone = [t for t in found if live is None or not f"{schema}.{t}".startswith(live.table)]
    for t in gone:
        spark.sql(f"DROP TABLE {quoted(f'{schema}.{t}' if schema else t)}")
    return sorted(gone)


def fingerprint(*parts: object) -> str:
    """A short text that tells inputs apart."""
    return uuid.uuid5(uuid.NAMESPACE_OID, json.dumps(parts, sort_keys=True, default=str)).hex
