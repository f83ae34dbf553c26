"""Lineage cuts in the cluster-shared checkpoint folder."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from triplake.session import scratch_path


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder
    and continue from the stored rows.

    Use it for a result that several later queries read (gold before the
    report analytics, tagged rows before a prefix sum): every reader scans
    the stored rows instead of recomputing the whole lineage, and a lost
    executor does not force a recomputation from the raw files.

    A written table rather than ``Dataset.checkpoint``: it costs the same
    single job, but readers get a columnar scan with column pruning and
    row-group statistics, and the table stays readable from any later job
    or session.  The known schema is passed back to the reader, so no footer
    is inferred.  Each call writes to a fresh folder, so nothing is ever
    overwritten while it is being read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_all(*dfs: DataFrame, name: str = "materialized") -> list[DataFrame]:
    """``materialize`` several independent results as concurrent jobs.

    Each write is its own job submitted from a driver thread, so a small
    result does not wait for a large one and the scheduler fills the
    executors with the tasks of all of them.  The threads inherit the
    caller's local properties and job tags, so the jobs can
    be cancelled and accounted for together.
    """
    if len(dfs) <= 1:
        return [materialize(df, name) for df in dfs]
    with ThreadPoolExecutor(max_workers=len(dfs)) as pool:
        return list(pool.map(inheritable_thread_target(dfs[0].sparkSession)(lambda df: materialize(df, name)), dfs))
