"""Plain and managed table sinks, namespaces and catalog checks.

Catalog tables are views over versions (``triplake.plans.tables``), so create
or replace never leaves a moment without the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from triplake.plans import tables
from triplake.plans.tables import quoted


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
) -> None:
    """Write ``df`` to ``path`` (full overwrite replaces data and schema)."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a folder written by ``write_table``."""
    return spark.read.format(fmt).load(path)


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS``; ``name`` may carry its catalog
    (``catalog.schema``), ``location`` is the folder of its managed tables."""
    at = " LOCATION '{}'".format(location.replace("'", "\\'")) if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name)}{at}")


def namespace_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.databaseExists(name)


def catalogs(spark: SparkSession) -> list[str]:
    return [c.name for c in spark.catalog.listCatalogs()]


def require_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """Stop the step, naming every table that is not in the catalog."""
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise LookupError(f"tables not found: {', '.join(missing)}")


def create_table(spark: SparkSession, name: str, schema: StructType, fmt: str = "parquet",
                 replace: bool = True) -> None:
    """Create an empty table with declared columns.  ``replace`` puts it in the
    place of an older one by one statement: there is a table at all times."""
    if not replace and spark.catalog.tableExists(name):
        raise ValueError(f"table {name} exists")
    version = tables.new_version(spark, name, schema, fmt=fmt)
    tables.switch(spark, name, version, [f.name for f in schema.fields])


def save_as_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
) -> None:
    """Create or replace a table from a query (CTAS): readers see the old rows
    until all new ones are stored.  ``mode`` may also be ``append``."""
    if mode == "append" and tables.current(df.sparkSession, name):
        insert_into(df.select(*df.sparkSession.table(name).columns), name)
    else:
        tables.replace_table(df, name, fmt, partition_by or ())


def insert_into(df: DataFrame, name: str) -> None:
    """``INSERT INTO name SELECT ...`` by column position, as SQL does."""
    version = tables.current(df.sparkSession, name)
    if version is None:
        df.write.insertInto(name)
        return
    public = df.toDF(*df.sparkSession.table(name).columns)
    tables.insert_counted(public, version.table)
