"""Load only raw files not seen before, safely re-runnable.

A Structured Streaming query over the *listing* of the landing folder, run
with ``trigger(availableNow=True)``: each run takes the files that landed since
the last one and stops.  A micro-batch of at most ``max_files_per_trigger``
files becomes one batch of bronze (``triplake.plans.bronze_files``).

A file is known by its name and its contents (length and checksum); neither
its path nor its time matters.  A file that arrives late with an old time stamp
is taken; a renamed landing folder, a new checkpoint, a copy under another path
or a batch that is replayed after a failure adds nothing twice and is counted
as skipped.  A different file of a published name, or two different files of
one name, stop the run with both paths named.  A full rebuild of bronze
supersedes the increments before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from triplake.config import Lake
from triplake.contracts import RAW_FILE_GLOB, RAW_SCHEMA
from triplake.plans.bronze_files import Added, add_unseen

_LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
# Files older than this behind the newest one would be skipped by the source:
# its default of a week would lose late files.
_ANY_AGE = "36500d"


def ingest(
    spark: SparkSession,
    raw_dir: str,
    lake: Lake,
    checkpoint: str,
    reconcile: bool = True,
    schema: StructType = RAW_SCHEMA,
    glob: str = RAW_FILE_GLOB,
    max_files_per_trigger: int = 1000,
    rescue: bool = False,
) -> Added:
    """Adds the rows of unseen files to the lake's bronze; ``reconcile`` allows
    files whose physical schemas differ, ``rescue`` malformed values."""
    listing = (
        spark.readStream.format("binaryFile")
        .schema(_LISTING_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("maxFileAge", _ANY_AGE)
        .load(raw_dir)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")
    )
    added: list[Added] = []

    def load_batch(batch: DataFrame, _: int) -> None:
        added.append(add_unseen(batch.sparkSession, lake, batch, reconcile, rescue, schema=schema))

    query = (
        listing.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    lost = {k: sum(a.lost.get(k, 0) for a in added) for a in added for k in a.lost}
    return Added(sum(a.files for a in added), sum(a.rows for a in added), sum(a.skipped for a in added), lost)


def ingest_stream(spark: SparkSession, raw_dir: str, lake: Lake, checkpoint: str, **options) -> Added:
    """``ingest`` of files that share the declared schema."""
    return ingest(spark, raw_dir, lake, checkpoint, reconcile=False, **options)


def ingest_reconciled(spark: SparkSession, raw_dir: str, lake: Lake, checkpoint: str, **options) -> Added:
    """``ingest`` of files whose physical schemas may differ."""
    return ingest(spark, raw_dir, lake, checkpoint, reconcile=True, **options)
