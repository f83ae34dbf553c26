"""Session factory and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings of every triplake session.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(app_name: str = "triplake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above and ``conf``.

    Without an active session one is built.  An active one (cluster, notebook)
    is returned as it is if its settings agree; otherwise a sister session on
    the same context gets them, so that other users of the active session keep
    theirs.  Settings that are fixed for a running context stay as they are,
    with a warning if ``conf`` asked for them.

    Shuffle parallelism is left to AQE coalescing instead of a fixed small
    number, so the same code runs on a laptop and on a large cluster.
    """
    active = SparkSession.getActiveSession()
    if active is None:
        builder = SparkSession.builder.appName(app_name)
        if master:
            builder = builder.master(master)
        for k, v in {**DEFAULT_CONF, **conf}.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
        spark.sparkContext.setLogLevel("WARN")
        return spark
    differing = {k: v for k, v in {**DEFAULT_CONF, **conf}.items() if active.conf.get(k, None) != v}
    fixed = sorted(k for k in differing if not active.conf.isModifiable(k))
    if asked := [k for k in fixed if k in conf]:
        warnings.warn(f"fixed for the running Spark context, left as they are: {', '.join(asked)}", stacklevel=2)
    wanted = {k: v for k, v in differing.items() if k not in fixed}
    if not wanted:
        return active
    own = active.newSession()
    for k, v in wanted.items():
        own.conf.set(k, v)
    return own


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def shared_dir(spark: SparkSession) -> str:
    """The folder for lineage cuts and scratch tables that driver and
    executors share: ``spark.checkpoint.dir`` as the cluster configured it.

    Only a single-process session (``local[n]``, as in tests) may do without:
    it gets a private folder.  Anything else raises, since executors would
    write to their own disks.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="triplake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_scopes: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder."""
    base = "/".join([shared_dir(spark).rstrip("/"), "triplake", *_scopes])
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the scratch tables that were made inside it when it ends.  The
    frames that read them must not be used afterwards (the command line and
    the bench run each step in a scope)."""
    scope = scratch_path(spark, "scope")
    _scopes.append(scope.rsplit("/", 1)[1])
    try:
        yield
    finally:
        _scopes.pop()
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(scope)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
