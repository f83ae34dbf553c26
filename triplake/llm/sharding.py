"""Stable shards by jump consistent hashing, in DataFrame functions only.

The shard of a row depends on its key and the number of shards alone.  There
is no ring table: the key seeds a 64-bit linear congruential sequence, and the
shard is the last jump below the number of shards.  One more shard takes
1/(n+1) of the rows, all of them into itself.

A Spark long can't wrap around, so the generator runs on decimals modulo 2**64
(20 digits times 19 digits stays below the 38 that a decimal holds).

Defined results: a null key counts as the text ``null``; a null text has size 1
and the CRC of no bytes; equal rows get the same shard and different slots; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplake.plans.materialize import materialize

# Fixed values of the generator: multiplier, modulus 2**64, and 2**33.
MULTIPLIER = "2862933555777941757"
MODULUS = "18446744073709551616"
HIGH_BITS = "8589934592"


def stable_key(key: Column) -> Column:
    """A 60-bit seed from the key's text, so that runs of ids spread evenly."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, 15), 16, 10).cast("decimal(20,0)")


def jump_shard(seed: Column, shards: int) -> Column:
    """Jump consistent hash of a seed (decimal(20,0)) onto 0..shards-1.

    Each step moves to a higher candidate, so ``shards`` steps always reach
    the end; steps after that change nothing."""
    start = F.struct(seed.alias("k"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(at: Column, _: Column) -> Column:
        k = ((at["k"] * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1)) % F.lit(MODULUS).cast("decimal(20,0)")).cast("decimal(20,0)")
        unit = F.lit(HIGH_BITS).cast("decimal(10,0)")
        high = ((k - k % unit) / unit).cast("double") + F.lit(1.0)
        j = F.floor((at["j"] + 1).cast("double") * (F.lit(2147483648.0) / high)).cast("long")
        done = at["j"] >= shards
        return F.struct(
            F.when(done, at["k"]).otherwise(k).alias("k"),
            F.when(done, at["b"]).otherwise(at["j"]).alias("b"),
            F.when(done, at["j"]).otherwise(j).alias("j"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)["b"].cast("int")


def assign(rows: DataFrame, key: str, shards: int) -> DataFrame:
    """``rows`` with ``shard`` and ``grown_shard`` (with one more shard)."""
    seeded = rows.withColumn("_seed", stable_key(F.col(key)))
    return seeded.withColumn("shard", jump_shard(F.col("_seed"), shards)).withColumn(
        "grown_shard", jump_shard(F.col("_seed"), shards + 1)
    ).drop("_seed")


def with_slots(placed: DataFrame, shard: str = "shard") -> DataFrame:
    """``placed`` with ``slot``: 0, 1, ... without gaps within each shard.

    Rows are numbered within their (shard, input split), whose size the split
    bounds, and the splits of a shard are put one after the other by a prefix
    sum over their counts.  So no task holds a whole shard, nor all rows of a
    hot key.  The rows are written once first, which freezes split and order.
    """
    tagged = materialize(placed.withColumn("_split", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "slots")
    counts = tagged.groupBy(shard, "_split").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, "_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy(shard, "_split").orderBy("_at")
    numbered = tagged.withColumn("_own", F.row_number().over(own).cast("long") - 1)
    return numbered.join(offsets, [shard, "_split"]).withColumn("slot", F.col("_before") + F.col("_own")).drop("_split", "_at", "_own", "_before")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Documents in ``shards`` stable shards under the law ``key``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    placed = assign(rows, "doc_id", shards).withColumn("law", F.lit("key"))
    return with_slots(placed).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
