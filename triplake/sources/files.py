"""File listings of a raw landing folder, and what tells its files apart."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.contracts import RAW_FILE_GLOB
from triplake.functions.measures import python_round, quanta, ratio

_MB = 1_048_576


def list_files(spark: SparkSession, directory: str, glob: str = RAW_FILE_GLOB) -> DataFrame:
    """``(path, name, length, modified)`` of the files matching ``glob``.

    The binary-file source lists in parallel on large folders; selecting only
    metadata columns prunes ``content`` so no file body is read.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(directory)
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("name"),
            "length",
            F.col("modificationTime").alias("modified"),
        )
    )


def require_files(spark: SparkSession, directory: str, glob: str = RAW_FILE_GLOB) -> DataFrame:
    """Listing of ``directory``; raise ``FileNotFoundError`` when nothing matches."""
    try:
        listing = list_files(spark, directory, glob)
        empty = listing.isEmpty()
    except Exception as e:  # a missing folder fails at analysis time
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(f"no folder {directory}") from e
        raise
    if empty:
        raise FileNotFoundError(f"no files matching {glob} in {directory}")
    return listing


_PIECE = 4 << 20  # bytes of a file that a task holds at a time


def content_keys(listing: DataFrame) -> DataFrame:
    """``(path, name, length, checksum)``: the SHA-256 of each file, read on
    the executors piece by piece.

    Like the footer reader, the task function ships by value and opens files
    through pyarrow's file systems (file, hdfs, s3/s3a, gs, abfs)."""
    piece = _PIECE

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        from urllib.parse import unquote, urlparse

        from pyarrow import fs

        def checksum(uri: str) -> str:
            parsed = urlparse(uri)
            if parsed.scheme in ("", "file"):
                filesystem, path = fs.LocalFileSystem(), unquote(parsed.path)
            else:
                filesystem, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
            whole = hashlib.sha256()
            with filesystem.open_input_stream(path, compression=None) as f:
                while part := f.read(piece):
                    whole.update(part)
            return whole.hexdigest()

        for pdf in batches:
            yield pdf.assign(checksum=[checksum(u) for u in pdf["path"]])

    return listing.select("path", "name", "length").mapInPandas(keys, "path string, name string, length long, checksum string")


class ConflictingFiles(ValueError):
    """Two different files share a name."""


def one_of_each_name(keys: DataFrame) -> DataFrame:
    """One file of each name and the number of its ``copies``; raises
    ``ConflictingFiles`` with both paths if files of one name differ."""
    own = keys.groupBy("name").agg(
        F.min(F.struct("length", "checksum", "path")).alias("_a"),
        F.max(F.struct("length", "checksum", "path")).alias("_b"),
        F.min("path").alias("path"),
        F.count(F.lit(1)).alias("copies"),
    )
    _raise_conflicts(own, "_a", "_b")
    return own.select("path", "name", "_a.length", "_a.checksum", "copies")


def unseen(files: DataFrame, seen: DataFrame) -> DataFrame:
    """The files whose name is not among the published ones (path, name,
    length, checksum); raises ``ConflictingFiles`` if a published name has
    other contents now."""
    known = seen.select("name", F.struct("length", "checksum", "path").alias("_known"))
    both = files.withColumn("_own", F.struct("length", "checksum", "path")).join(known, "name", "left")
    _raise_conflicts(both.where("_known is not null"), "_known", "_own")
    return both.where("_known is null").drop("_known", "_own")


def _raise_conflicts(files: DataFrame, a: str, b: str) -> None:
    differ = (F.col(f"{a}.length") != F.col(f"{b}.length")) | (F.col(f"{a}.checksum") != F.col(f"{b}.checksum"))
    found = files.where(differ).select("name", F.col(f"{a}.path").alias("a"), F.col(f"{b}.path").alias("b")).take(3)
    if found:
        listed = "; ".join(f"{r['name']}: {r['a']} and {r['b']}" for r in found)
        raise ConflictingFiles(f"different files of one name: {listed}")


def rows_per_file(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """``(file, length, rows)`` of Parquet files, from a scan that reads no
    column: the rows come from the footers, names and sizes from the source's
    own metadata columns, whatever the files hold."""
    reader = spark.read.schema("_none int")
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    scanned = reader.parquet(*([paths] if isinstance(paths, str) else paths))
    own = scanned.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("length"))
    return own.groupBy("file", "length").agg(F.count(F.lit(1)).alias("rows"))


def file_inventory(listing: DataFrame) -> DataFrame:
    """Per file: name and size in MB (1 decimal, rounded as Python's
    ``round``), sorted by name."""
    return listing.select(
        F.col("name").alias("file"), python_round(F.col("length") / F.lit(_MB), 1).alias("size_mb")
    ).orderBy("file")


def inventory_summary(listing: DataFrame) -> DataFrame:
    """Number of files and total GB (sum of the rounded MB sizes / 1024)."""
    size_mb = python_round(F.col("length") / F.lit(_MB), 1)
    return listing.agg(
        F.count(F.lit(1)).alias("files"),
        ratio(F.sum(quanta(size_mb, 10)), F.lit(10 * 1024)).alias("total_gb"),
    )
