"""Raw Parquet readers.

``read_declared`` reads with the declared contract (fast path: one scan, no
inference).  It tolerates missing columns, case differences and integer
widening, but not a column whose physical type changed between files (for
example passenger counts stored as INT64 in one year and DOUBLE in another).

``read_reconciled`` handles that drift: file footers are read on the
executors (pyarrow, one small read per file), files are grouped by their
physical schema, each group is read once with its own schema and cast to the
contract, and the groups are unioned.  The number of scans equals the number
of distinct schemas, not the number of files.  Footers are read through
pyarrow's file systems (file, hdfs, s3/s3a, gs, abfs) with their own
credentials.  A large folder is read in batches of files
(``plans.pipeline.write_bronze``, ``streaming.incremental.ingest``), which
bounds the paths on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from triplake.contracts import RAW_FILE_GLOB, RAW_SCHEMA
from triplake.operators.bronze import to_contract
from triplake.sources.files import list_files


def read_declared(
    spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA, glob: str = RAW_FILE_GLOB
) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("mergeSchema", "false")
        .option("pathGlobFilter", glob)
        .parquet(path)
    )


def footer_signatures(listing: DataFrame) -> DataFrame:
    """``(path, signature)``: each file's physical schema, read on executors.

    The task function is self-contained (nested, imports inside) so it ships
    by value and workers need nothing but pyarrow.
    """

    def signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from urllib.parse import unquote, urlparse

        import pandas
        import pyarrow.parquet as pq
        from pyarrow import fs

        def footer(uri: str):
            parsed = urlparse(uri)
            if parsed.scheme in ("", "file"):
                return pq.read_schema(unquote(parsed.path))
            try:
                filesystem, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
            except Exception as e:
                raise ValueError(f"footers are read through pyarrow (file, hdfs, s3, s3a, gs, abfs), not from {uri}") from e
            with filesystem.open_input_file(path) as f:
                return pq.read_schema(f)

        for pdf in batches:
            sigs = ["|".join(sorted(f"{fld.name.lower()}:{fld.type}" for fld in footer(u))) for u in pdf["path"]]
            yield pandas.DataFrame({"path": pdf["path"], "signature": sigs})

    return listing.select("path").mapInPandas(signatures, "path string, signature string")


def read_reconciled(
    spark: SparkSession,
    source: str | Sequence[str],
    schema: StructType = RAW_SCHEMA,
    glob: str = RAW_FILE_GLOB,
    safe: bool = False,
    project: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Read raw files whose physical schemas differ, cast to ``schema`` (or by
    ``project``, which gets the rows of one physical schema at a time).

    ``source`` is a folder (files matching ``glob``) or a list of file paths.
    Only file paths and their schema signatures reach the driver (the same
    metadata a file scan plans with), never rows.
    """
    if isinstance(source, str):
        listing = list_files(spark, source, glob)
    else:
        listing = spark.createDataFrame([(p,) for p in source], "path string")
    # (signature, path) rows straight to the driver, which lists the paths
    # for the scans anyway: no task ever builds one array of all the paths of
    # a schema (usually there is a single schema for almost every file).
    groups: dict[str, list[str]] = {}
    for r in footer_signatures(listing).collect():
        groups.setdefault(r["signature"], []).append(r["path"])
    if not groups:
        raise FileNotFoundError(f"no raw files in {source!r}")
    project = project or (lambda df: to_contract(df, schema, safe))
    parts = [project(spark.read.parquet(*sorted(groups[sig]))) for sig in sorted(groups)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
