"""Bronze from raw files: which are in it, and adding others.

Beside each version of bronze stands the list of its files (path, name, length,
checksum), partitioned by batch like the rows.  A batch's files are listed
before its rows are inserted, and a file counts as published if bronze has its
batch, so a failed or repeated increment neither loses nor repeats a file.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from triplake.config import Lake
from triplake.contracts import BRONZE_SCHEMA, RAW_SCHEMA, RESCUED
from triplake.operators.bronze import bronze_with_rescue
from triplake.plans import tables
from triplake.plans.materialize import materialize
from triplake.plans.sinks import ensure_namespace
from triplake.plans.tables import BATCH
from triplake.sources.files import content_keys, one_of_each_name, unseen
from triplake.sources.parquet import read_reconciled

# Raw files whose schemas are reconciled together; their paths are on the
# driver while they are read.
FILES_PER_BATCH = 1000
# Bytes of a row group of stored bronze: the least that a task of the next
# layer reads, so the most that it has to hold whatever a file's size.
ROW_GROUP_BYTES = 16 * 1024 * 1024
FILES_SCHEMA = StructType().add("path", "string").add("name", "string").add("length", "long").add("checksum", "string")


@dataclass(frozen=True)
class Added:
    """What a run added: files and rows; and the copies of published files it
    left out, and the values that casts lost, by column."""

    files: int = 0
    rows: int = 0
    skipped: int = field(default=0, compare=False)
    lost: dict[str, int] = field(default_factory=dict, compare=False)


def new_bronze(spark: SparkSession, lake: Lake) -> str:
    """An empty version of bronze and of its list of files."""
    ensure_namespace(spark, lake.schema("bronze"), lake.folder("bronze"))
    schema = StructType(list(BRONZE_SCHEMA.fields)).add(RESCUED, ArrayType(StructType().add("column", "string").add("value", "string")))
    options = {"parquet.block.size": str(ROW_GROUP_BYTES)}
    version = tables.new_version(spark, lake.table("bronze"), schema, fmt=lake.fmt, batched=True, options=options)
    parts = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in FILES_SCHEMA)
    spark.sql(f"CREATE TABLE {tables.quoted(version + '_files')} ({parts}, `{BATCH}` string) USING parquet PARTITIONED BY (`{BATCH}`)")
    return version


def switch_bronze(spark: SparkSession, lake: Lake, version: str) -> None:
    """Makes a version of bronze the current one, and its lost values a table
    of their own: one row per value, beside its whole row."""
    name = lake.table("bronze")
    tables.switch(spark, name, version, BRONZE_SCHEMA.names)
    columns = ", ".join(f"`{c}`" for c in BRONZE_SCHEMA.names)
    spark.sql(
        f"CREATE OR REPLACE VIEW {tables.quoted(name + '_rejected')} AS SELECT _lost.column AS rejected_column, "
        f"_lost.value AS rejected_value, {columns} FROM (SELECT *, explode({RESCUED}) AS _lost "
        f"FROM {tables.quoted(version)} WHERE size({RESCUED}) > 0)"
    )


def published_files(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """The raw files whose rows are in bronze; None without bronze."""
    now = tables.current(spark, lake.table("bronze"))
    if now is None:
        return None
    held = sorted(tables.batches(spark, now.table))
    return spark.table(f"{now.table}_files").where(F.col(BATCH).isin(held)).drop(BATCH)


def _lost_counts() -> dict[str, Column]:
    """Observed with the write: values that the casts lost, by column."""
    lost = lambda name: F.size(F.filter(RESCUED, lambda v: v["column"] == name))
    return {f"lost_{f.name}": F.sum(lost(f.name)) for f in RAW_SCHEMA.fields}


def insert_rows(raw: DataFrame, version: str, batch: str, rescue: bool = False, projected: bool = False) -> tuple[int, dict[str, int]]:
    """Inserts raw rows under a batch; returns their number and the values
    lost in their casts, by column."""
    rows = raw if projected else bronze_with_rescue(raw, rescue=rescue)
    counted = tables.insert_counted(rows, version, _lost_counts() if rescue else None, batch)
    total = counted.pop("rows")
    return total, {k.removeprefix("lost_"): n for k, n in counted.items() if n}


def _batches(paths: Iterator[str], size: int) -> Iterator[list[str]]:
    while batch := list(islice(paths, size)):
        yield batch


def insert_files(
    spark: SparkSession, files: DataFrame, version: str, reconcile: bool, rescue: bool = False,
    files_per_batch: int = FILES_PER_BATCH, schema: StructType = RAW_SCHEMA,
) -> Added:
    """Inserts the rows of listed files (path, name, length, checksum) into a
    version, as one batch.  With ``reconcile`` they may differ in schema."""
    batch = tables.new_batch()
    listed = tables.insert_counted(files.withColumn(BATCH, F.lit(batch)), f"{version}_files")["rows"]
    project = lambda df: bronze_with_rescue(df, rescue=rescue)
    rows, lost = 0, {}
    paths = (r["path"] for r in files.select("path").orderBy("path").toLocalIterator())
    for part in _batches(paths, files_per_batch):
        if reconcile:
            n, own = insert_rows(read_reconciled(spark, part, project=project), version, batch, rescue, projected=True)
        else:
            n, own = insert_rows(spark.read.schema(schema).parquet(*part), version, batch, rescue)
        rows += n
        lost = {k: lost.get(k, 0) + own.get(k, 0) for k in {**lost, **own}}
    # files without rows are published as well
    spark.sql(f"ALTER TABLE {tables.quoted(version)} ADD IF NOT EXISTS PARTITION (`{BATCH}` = '{batch}')")
    return Added(listed, rows, lost=lost)


def distinct_files(listing: DataFrame) -> tuple[DataFrame, int]:
    """One file of each name with its content key, and the number of copies
    left out; different files of one name raise."""
    files = materialize(one_of_each_name(materialize(content_keys(listing), "content-keys")), "raw-files")
    copies = files.agg(F.sum(F.col("copies") - 1)).first()[0] or 0
    return files.drop("copies"), int(copies)


def add_unseen(spark: SparkSession, lake: Lake, listing: DataFrame, reconcile: bool, rescue: bool = False, **options) -> Added:
    """Adds the listed files (path, name, length) that bronze does not have;
    identical copies are left out and counted, different files under a
    published name raise ``ConflictingFiles`` before anything is written."""
    files, copies = distinct_files(listing)
    seen = published_files(spark, lake)
    if seen is not None:
        new = materialize(unseen(files, seen), "unseen-files")
        copies += files.count() - new.count()
        files = new
    if files.isEmpty():
        return Added(skipped=copies)
    if seen is None:
        version = new_bronze(spark, lake)
        added = insert_files(spark, files, version, reconcile, rescue, **options)
        switch_bronze(spark, lake, version)
    else:
        added = insert_files(spark, files, tables.current(spark, lake.table("bronze")).table, reconcile, rescue, **options)
    return Added(added.files, added.rows, copies, added.lost)
