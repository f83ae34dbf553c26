"""Steps that move few texts and leave little behind."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.llm.names import fresh_name
from triplake.session import scratch_path, scratch_scope

FILTER_SLOTS = 1 << 18  # of 64 bits: the rows of the filter, at any size of the input


def texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose ``doc_id`` is in ``ids`` (distinct ids).

    A bit per id, in at most ``FILTER_SLOTS`` broadcast rows, lets most other
    texts go before they are shuffled; a merge join decides, as the texts are
    much larger than the ids.  Where ids fill the bits, all texts are shuffled,
    and the rows are the same.  A null id is in no list.
    """
    hashed = F.xxhash64("doc_id")
    slot = F.pmod(hashed, F.lit(FILTER_SLOTS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hashed, 58).cast("int"))
    at, bits = fresh_name(texts, "slot"), fresh_name(texts, "bits")
    filled = ids.select(slot.alias(at), bit.alias(bits)).groupBy(at).agg(F.bit_or(bits).alias(bits))
    maybe = texts.withColumn(at, slot).join(F.broadcast(filled), at).where(F.col(bits).bitwiseAND(bit) != 0)
    # inner: a semi join would be moved below the filter
    return maybe.select(texts.columns).join(ids.hint("merge"), "doc_id").select(texts.columns)


def written_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The frame of ``make``, written to the shared folder; all other scratch
    tables that ``make`` has written are deleted."""
    path = scratch_path(spark, name)
    with scratch_scope(spark):
        df = make()
        df.write.mode("errorifexists").parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path)
