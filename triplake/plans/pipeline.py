"""End to end: raw files -> bronze -> silver -> gold, with a run report.

Layers hand over through catalog tables (``triplake.plans.tables``): a layer
that fails leaves the table as it was, and a lost executor recomputes its own
layer only.  Every layer is kept by batch of raw files, so an increment costs
what it adds: silver takes the rows of batches it does not have, gold adds
their cells to the stored ones.  Row counts come from ``Observation`` on the
write jobs themselves: no extra scans.
"""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from triplake.config import GoldOptions, Lake, QualityRules
from triplake.contracts import GOLD_TABLES, PICKUP, RAW_FILE_GLOB, RESCUED, SILVER_PARTITION_COLUMNS, SILVER_SCHEMA
from triplake.operators.gold import GOLD_FINISHERS, additive_cells, merged_cells
from triplake.operators.silver import silver as to_silver
from triplake.plans import tables
from triplake.plans.bronze_files import (
    FILES_PER_BATCH,
    Added,
    add_unseen,
    distinct_files,
    insert_files,
    insert_rows,
    new_bronze,
    switch_bronze,
)
from triplake.plans.materialize import materialize
from triplake.plans.sinks import ensure_namespace
from triplake.plans.tables import BATCH
from triplake.sources.files import require_files

CELLS = "trip_cells"
RUNS = "run_report"
RUNS_SCHEMA = StructType()
for _name, _type in (("run", "string"), ("step", "string"), ("state", "string"), ("rows", "long"), ("inputs", "string"),
                     ("error", "string"), ("at", "timestamp")):
    RUNS_SCHEMA.add(_name, _type)


@dataclass
class RunReport:
    bronze_rows: int = 0
    silver_rows: int = 0
    gold_rows: dict[str, int] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)

    @property
    def removed_rows(self) -> int:
        return self.bronze_rows - self.silver_rows

    @property
    def complete(self) -> bool:
        return not self.failed and set(self.gold_rows) | set(self.skipped) >= set(GOLD_TABLES)


# --------------------------------------------------------------------- bronze


def write_bronze(spark: SparkSession, raw: str | DataFrame, lake: Lake, reconcile: bool = True,
                 glob: str = RAW_FILE_GLOB, files_per_batch: int = FILES_PER_BATCH, rescue: bool = False) -> int:
    """Rebuild bronze from a landing folder (or raw rows); supersedes what
    increments have added.

    With ``reconcile`` (the default) files may differ in physical schema.
    They are read ``files_per_batch`` at a time into one version, which
    becomes current when all are in.  Copies of one file are read once;
    different files of one name raise.  ``rescue`` keeps malformed values
    aside (table ``<bronze>_rejected``) instead of failing the job.
    """
    if not isinstance(raw, str):
        version = new_bronze(spark, lake)
        rows, _ = insert_rows(raw, version, tables.new_batch(), rescue)
    else:
        files, _ = distinct_files(require_files(spark, raw, glob))
        version = new_bronze(spark, lake)
        rows = insert_files(spark, files, version, reconcile, rescue, files_per_batch).rows
    switch_bronze(spark, lake, version)
    return rows


def add_to_bronze(spark: SparkSession, raw: str, lake: Lake, reconcile: bool = True, glob: str = RAW_FILE_GLOB,
                  rescue: bool = False) -> Added:
    """Adds the files of a landing folder that bronze does not have, as one
    batch (``streaming.incremental.ingest`` bounds the files of a batch)."""
    return add_unseen(spark, lake, require_files(spark, raw, glob), reconcile, rescue)


# --------------------------------------------------------------------- silver

# Bytes of stored bronze per task of the clustered silver shuffle (and so,
# roughly, per written silver file).
CLUSTER_BYTES_PER_TASK = 128 * 1024 * 1024
# Bytes of stored bronze that a task reads to write silver.  It holds all its
# rows, as many times larger in memory, to sort them by month or to shuffle
# them; so its memory follows this figure, not the size of bronze's files.
READ_BYTES_PER_TASK = 16 * 1024 * 1024


def range_partitions(source_bytes: int, bytes_per_task: int) -> int:
    """Partitions of a range shuffle of ``source_bytes``.  AQE can merge
    partitions but never split them, so the count follows the bytes at every
    size: 100 TB at 128 MB per task is 819,200 partitions, not 200."""
    return max(1, math.ceil(source_bytes / bytes_per_task))


def _bronze_batches(spark: SparkSession, lake: Lake, only: set[str] | None = None) -> DataFrame:
    now = tables.current(spark, lake.table("bronze"))
    if now is None:
        raise FileNotFoundError(f"no table {lake.table('bronze')}: nothing is published")
    rows = spark.table(now.table).drop(RESCUED)
    return rows if only is None else rows.where(F.col(BATCH).isin(sorted(only)))


def write_silver(spark: SparkSession, lake: Lake, rules: QualityRules = QualityRules(),
                 duration_scale: int | None = None, cluster: bool = False,
                 cluster_bytes_per_task: int = CLUSTER_BYTES_PER_TASK) -> int:
    """Silver partitioned by pickup year/month (and batch), from all of bronze.

    Default: no shuffle; each task writes the months it holds (raw files are
    monthly, so that is one or two).  ``cluster=True`` range-partitions on
    (year, month, pickup time, row id) first: fewer, sorted files per month,
    and a busy month - even a single pickup second holding a third of all
    trips - is still split across many tasks, because the row id (stable for
    a file scan) makes every range key unique.  The number of range
    partitions follows the stored bronze size (file listing only, see
    ``range_partitions``).
    """
    df = to_silver(_bronze_batches(spark, lake), rules, duration_scale)
    if cluster:
        keys = [*SILVER_PARTITION_COLUMNS, PICKUP, "_row"]
        source_bytes = tables.stored_bytes(spark, tables.current(spark, lake.table("bronze")).table)
        n = range_partitions(source_bytes, cluster_bytes_per_task)
        df = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(n, *keys).drop("_row")
    ensure_namespace(spark, lake.schema("silver"), lake.folder("silver"))
    version = tables.new_version(spark, lake.table("silver"), SILVER_SCHEMA, SILVER_PARTITION_COLUMNS, lake.fmt, batched=True)
    rows = _insert_silver(df, version)
    tables.switch(spark, lake.table("silver"), version, SILVER_SCHEMA.names, {"rules": _rules_note(rules, duration_scale)})
    return rows


def _insert_silver(df: DataFrame, version: str) -> int:
    """Inserts rows read from bronze, ``READ_BYTES_PER_TASK`` a task."""
    with tables.session_conf(df.sparkSession, "spark.sql.files.maxPartitionBytes", str(READ_BYTES_PER_TASK)):
        return tables.insert_counted(df, version)["rows"]


def _rules_note(rules: QualityRules, duration_scale: int | None) -> str:
    return tables.fingerprint(asdict(rules), duration_scale)


def update_silver(spark: SparkSession, lake: Lake, rules: QualityRules = QualityRules(),
                  duration_scale: int | None = None) -> int | None:
    """Adds the rows of bronze's new batches to silver, in new files of the
    months they are in; every other file stays as it is.  Returns the number
    of rows added, None if silver has all batches.  If bronze was rebuilt or
    the rules differ from those of silver, all of silver is rebuilt."""
    now = tables.current(spark, lake.table("silver"))
    source = tables.current(spark, lake.table("bronze"))
    have = tables.batches(spark, now.table) if now else set()
    want = tables.batches(spark, source.table) if source else set()
    if now is None or have - want or now.notes.get("rules") != _rules_note(rules, duration_scale):
        return write_silver(spark, lake, rules, duration_scale)
    if not want - have:
        return None
    new = to_silver(_bronze_batches(spark, lake, want - have), rules, duration_scale)
    return _insert_silver(new, now.table)


# ----------------------------------------------------------------------- gold


def new_cells(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """The additive cells, by batch, of the silver batches that the stored
    cells lack; None if they have all of them.  Only those batches are read."""
    have, want, source = _cells_state(spark, lake)
    if not want - have:
        return None
    rows = spark.table(source).where(F.col(BATCH).isin(sorted(want - have)))
    return additive_cells(rows, by=[BATCH])


def _cells_state(spark: SparkSession, lake: Lake) -> tuple[set[str], set[str], str]:
    """Batches of the stored cells that are still right, batches of silver,
    and silver's version."""
    source = tables.current(spark, lake.table("silver"))
    if source is None:
        raise FileNotFoundError(f"no table {lake.table('silver')}: nothing is published")
    now = tables.current(spark, lake.table("gold", CELLS))
    same = now is not None and now.notes.get("silver") == source.table
    have = tables.batches(spark, now.table) if same else set()
    return have, tables.batches(spark, source.table), source.table


def update_cells(spark: SparkSession, lake: Lake) -> str:
    """Brings the stored cells up to silver's batches; returns their version.
    After a rebuild of silver they are made anew."""
    have, _, source = _cells_state(spark, lake)
    cells, name = new_cells(spark, lake), lake.table("gold", CELLS)
    ensure_namespace(spark, lake.schema("gold"), lake.folder("gold"))
    now = tables.current(spark, name)
    if have or (now is not None and now.notes.get("silver") == source):
        if cells is not None:
            tables.insert_counted(cells, now.table)
        return now.table
    if cells is None:
        cells = additive_cells(spark.table(source), by=[BATCH])
    schema = StructType([f for f in cells.schema.fields if f.name != BATCH])
    version = tables.new_version(spark, name, schema, fmt=lake.fmt, batched=True)
    tables.insert_counted(cells, version)
    tables.switch(spark, name, version, schema.names, {"silver": source})
    return version


def write_gold(spark: SparkSession, lake: Lake, opts: GoldOptions = GoldOptions(), names: tuple[str, ...] = GOLD_TABLES,
               resume: bool = False) -> tuple[dict[str, int], dict[str, str], list[str]]:
    """Builds the gold tables from the stored cells; one failure does not
    stop the others.  Returns the rows of those written, the errors of those
    that failed and, with ``resume``, those that had the same inputs already.

    Silver's new batches are aggregated once for all tables (grouping sets)
    and added to the cells; a table is finished from the merged cells, a few
    rows, by its own job.  The jobs are submitted together from driver threads
    that inherit the caller's job group and tags.
    """
    version = update_cells(spark, lake)
    inputs = tables.fingerprint(version, sorted(tables.batches(spark, version)), asdict(opts))
    done = {n: tables.current(spark, lake.table("gold", n)) for n in names} if resume else {}
    skipped = [n for n in names if done.get(n) and done[n].notes.get("inputs") == inputs]
    left = [n for n in names if n not in skipped]
    if not left:
        return {}, {}, skipped
    cells = materialize(merged_cells(spark.table(version)), "gold-cells")

    def build(name: str) -> int:
        return tables.replace_table(GOLD_FINISHERS[name](cells, opts), lake.table("gold", name), lake.fmt, notes={"inputs": inputs})

    written: dict[str, int] = {}
    failed: dict[str, str] = {}
    with ThreadPoolExecutor(max_workers=len(left)) as pool:
        futures = {name: pool.submit(inheritable_thread_target(spark)(build), name) for name in left}
    for name, future in futures.items():
        try:
            written[name] = future.result()
        except Exception as e:  # noqa: BLE001 - reported per table, raised at the end
            failed[name] = f"{type(e).__name__}: {e}"
    return written, failed, skipped


# ------------------------------------------------------------------------ run


def _store_report(spark: SparkSession, lake: Lake, report: RunReport) -> None:
    """Adds the run to the lake's table of runs: one row per step."""
    run, name = uuid.uuid4().hex, lake.table("gold", RUNS)
    rows = [(run, "bronze", "skipped" if "bronze" in report.skipped else "done", report.bronze_rows, None)]
    rows.append((run, "silver", "skipped" if "silver" in report.skipped else "done", report.silver_rows, None))
    rows += [(run, n, "done", k, None) for n, k in report.gold_rows.items()]
    rows += [(run, n, "failed", None, e) for n, e in report.failed.items()]
    rows += [(run, n, "skipped", None, None) for n in report.skipped if n not in ("bronze", "silver")]
    made = spark.createDataFrame(rows, "run string, step string, state string, rows long, error string")
    noted = {n: now.notes.get("inputs") for n in GOLD_TABLES if (now := tables.current(spark, lake.table("gold", n)))}
    inputs = F.create_map(*(F.lit(x) for kv in noted.items() for x in kv))[F.col("step")] if noted else F.lit(None)
    made = made.withColumns({"inputs": inputs.cast("string"), "at": F.current_timestamp()})
    now = tables.current(spark, name)
    if now is None:
        version = tables.new_version(spark, name, RUNS_SCHEMA, fmt=lake.fmt)
        tables.switch(spark, name, version, RUNS_SCHEMA.names)
    tables.insert_counted(made.coalesce(1), (now or tables.current(spark, name)).table)


def run_pipeline(
    spark: SparkSession,
    raw: str | DataFrame,
    lake: Lake,
    rules: QualityRules = QualityRules(),
    gold_opts: GoldOptions = GoldOptions(),
    reconcile: bool = True,
    glob: str = RAW_FILE_GLOB,
    raise_on_failure: bool = True,
    cluster_silver: bool = False,
    duration_scale: int | None = None,
    cluster_bytes_per_task: int = CLUSTER_BYTES_PER_TASK,
    resume: bool = False,
    rescue: bool = False,
) -> RunReport:
    """Run bronze, silver and gold; raise at the end if any gold table failed.

    By default every layer is built anew from ``raw``.  With ``resume`` a run
    continues from the tables as they are: bronze takes the files it does not
    have, silver the batches, gold adds their cells and writes the tables
    whose inputs have changed or that failed; what is up to date is skipped.
    So the same call serves increments and repeats a run that failed.  Each
    run is added to the table ``run_report`` of the gold schema.

    ``cluster_silver`` range-partitions silver by pickup time before the
    partitioned write; use it when raw files are not already one month each.
    ``duration_scale`` rounds silver's duration to that many decimals, and
    gold's means follow it.
    """
    report = RunReport()
    if resume and isinstance(raw, str):
        added = add_to_bronze(spark, raw, lake, reconcile, glob, rescue)
        report.bronze_rows = added.rows
        if not added.files:
            report.skipped.append("bronze")
        silver_rows = update_silver(spark, lake, rules, duration_scale)
        report.silver_rows = silver_rows or 0
        if silver_rows is None:
            report.skipped.append("silver")
    else:
        report.bronze_rows = write_bronze(spark, raw, lake, reconcile, glob, rescue=rescue)
        report.silver_rows = write_silver(
            spark, lake, rules, duration_scale, cluster=cluster_silver, cluster_bytes_per_task=cluster_bytes_per_task
        )
    gold_opts = replace(gold_opts, duration_scale=duration_scale)
    report.gold_rows, report.failed, skipped = write_gold(spark, lake, gold_opts, resume=resume)
    report.skipped += skipped
    _store_report(spark, lake, report)
    if report.failed and raise_on_failure:
        raise RuntimeError(f"gold tables failed: {sorted(report.failed)}; report={report}")
    return report


def read_layer(spark: SparkSession, lake: Lake, layer: str, name: str | None = None) -> DataFrame:
    """The public rows of a layer's table (gold tables need a name)."""
    if layer == "gold" and name is None:
        raise ValueError("gold tables need a name")
    return tables.read_current(spark, lake.table(layer, name))
