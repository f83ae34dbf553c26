"""Order-dependent results without funnelling rows through one task.

``running_totals`` computes global running sums and 1-based positions over a
total order the way a distributed prefix sum is usually built:

1. a global sort range-partitions the rows, so every task holds one
   contiguous slice of the order;
2. each row is tagged with ``monotonically_increasing_id`` (slice index in the
   high bits, in-slice sequence in the low bits) and the tagged rows are
   written once as a table in the shared checkpoint folder, so every later
   branch (and every retried task) sees the same tags;
3. per-slice totals give one row per slice (bounded by the shuffle partition
   count, never by the data) -> exclusive prefix over slices -> broadcast;
4. in-slice running sums come from a window partitioned by slice.

No step holds more than one slice in a task, and the only broadcast is the
per-slice offset table.  The offsets come from a window over that table
(one row per slice, so the single-partition window Spark warns about is
bounded by the partition count).  The global sort takes the session's
shuffle partition count, which suits aggregated inputs such as the zone
table; a raw-sized input would need that count sized to the data first.

``arg_extremes`` picks whole rows at the max/min of a measure with explicit
tie-breaks in one global aggregation (partial per task, tiny final merge).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplake.plans.materialize import materialize

_SLICE = "_slice"
_RID = "_rid"
# Slice index lives above bit 33 of monotonically_increasing_id.
_SLICE_SHIFT = 33


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    sums: Mapping[str, Column],
    position: str = "position",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add global running sums ``cum_<name>``, totals ``total_<name>``,
    the 1-based ``position`` in ``order`` and ``total_rows``.

    ``sums`` maps a name to an integral (BIGINT) expression; integer running
    sums are exact, so the result does not depend on the slicing.  ``order``
    must be a total order (end it with a unique key).
    """
    keep = list(keep) if keep is not None else list(df.columns)
    values = {f"_v_{k}": v.cast("long") for k, v in sums.items()}
    tagged = materialize(
        df.select(*keep, *[v.alias(k) for k, v in values.items()])
        .orderBy(*order)
        .withColumn(_RID, F.monotonically_increasing_id()),
        "running-totals",
    ).withColumn(_SLICE, F.shiftright(F.col(_RID), _SLICE_SHIFT))

    per_slice = tagged.groupBy(_SLICE).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(k).alias(f"_s{k}") for k in values]
    )
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = per_slice.select(
        _SLICE,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        F.sum("_n").over(everything).alias("total_rows"),
        *[F.coalesce(F.sum(f"_s{k}").over(before), F.lit(0)).alias(f"_b{k}") for k in values],
        *[F.sum(f"_s{k}").over(everything).alias(f"total_{k[3:]}") for k in values],
    )

    in_slice = Window.partitionBy(_SLICE).orderBy(_RID)
    upto = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tagged.select(
        *keep,
        _SLICE,
        F.row_number().over(in_slice).alias("_pos"),
        *[F.sum(k).over(upto).alias(f"_c{k}") for k in values],
    )
    return local.join(F.broadcast(offsets), _SLICE).select(
        *keep,
        (F.col("_n_before") + F.col("_pos")).alias(position),
        F.col("total_rows"),
        *[(F.col(f"_b{k}") + F.col(f"_c{k}")).alias(f"cum_{k[3:]}") for k in values],
        *[F.col(f"total_{k[3:]}") for k in values],
    )


def argmax_row(fields: Sequence[str], value: Column | str, tiebreak: Column | str) -> Column:
    """Aggregate: struct of ``fields`` from the row with the largest ``value``;
    ties go to the smallest ``tiebreak`` (the first row in that order)."""
    v = F.col(value) if isinstance(value, str) else value
    t = F.col(tiebreak) if isinstance(tiebreak, str) else tiebreak
    return F.max_by(F.struct(*fields), F.struct(v, -t))


def argmin_row(fields: Sequence[str], value: Column | str, tiebreak: Column | str) -> Column:
    """Aggregate: struct of ``fields`` from the row with the smallest ``value``;
    ties go to the smallest ``tiebreak``."""
    v = F.col(value) if isinstance(value, str) else value
    t = F.col(tiebreak) if isinstance(tiebreak, str) else tiebreak
    return F.min_by(F.struct(*fields), F.struct(v, t))
