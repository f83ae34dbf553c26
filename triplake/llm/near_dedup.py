"""Near-duplicate documents by MinHash bands and odd sketches.

A document's set holds the 64-bit hashes of its distinct word shingles.

1. Documents with equal sets are one class; the smallest id represents it.
2. A MinHash signature of ``BANDS`` x ``ROWS`` samples gives the band keys, and
   is folded into an odd sketch: a parity bitmap in which every sample flips
   one bit.  The population count of the XOR of two sketches estimates the
   similarity closely where it is high.
3. In each band bucket, a task joins the members to a spanning forest along
   the smallest sketch distances: fewer candidates than members, and mostly
   pairs of nearest neighbours.  Full sets confirm them, and the confirmed
   links are joined to components.  Buckets of more than ``BLOCK`` members are
   dealt to chunks, twice and differently, so that chunks overlap.
4. Other pairs matter only where a bucket still holds members of different
   components.  There the members outside the bucket's largest component meet
   all others, block by block.  A first pass looks at sketches only and names
   the rows that need their full set; a second one compares those and returns
   links.  Pairs are never listed.
5. All links between representatives are joined to components.

Two documents of similarity 0.85 (0.8) miss all bands with probability 7.4e-8
(1.49e-5).  The sketch threshold lies ``SLACK`` below the similarity asked for
and loses another 3.2e-9 (1.5e-7), so the search as a whole misses 7.7e-8
(1.50e-5).

Defined results: null, empty and blank texts have an empty set, link with
nothing and are kept; a text with fewer words than a shingle has its whole
sequence as one; rows that repeat a doc_id count as one document per id for
links (any of its sets may link) and each row gets a result; a null doc_id
gets a null component and is kept; an empty table gives no rows; other
columns are ignored (``near_duplicates``) or kept (``drop_near_duplicates``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.components import components
from triplake.llm.groups import group_bounds, lists, matrix, whole_groups
from triplake.llm.names import fresh_name
from triplake.llm.textbytes import chunks, hash_words, mix64, shingle_hashes, word_bounds
from triplake.llm.steps import texts_of, written_alone
from triplake.plans.materialize import materialize

BANDS = 28
ROWS = 5
SKETCH_LONGS = 8  # 512 bits for 140 samples
SLACK = 0.22
BLOCK = 256  # members of a bucket that a task looks at together

_rng = np.random.Generator(np.random.PCG64(2024))
_XOR = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_MULTIPLY = _rng.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SAMPLES = 1 << 15  # shingles hashed at a time: fits the processor's cache


def minhash(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Signature (texts x samples) of texts with at least one shingle each."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    ends = np.cumsum(counts)
    out = np.empty((len(counts), len(_XOR)), np.uint32)
    lo = 0
    while lo < len(counts):
        base = int(ends[lo] - counts[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, base + _SAMPLES, side="right")))
        part, at = x[base : ends[hi - 1]], (ends[lo:hi] - counts[lo:hi] - base)
        for i in range(len(_XOR)):
            y = part ^ _XOR[i]
            y *= _MULTIPLY[i]
            y ^= y >> np.uint32(15)
            y *= np.uint32(0x2C1B3C6D)
            out[lo:hi, i] = np.minimum.reduceat(y, at)
        lo = hi
    return out


def odd_sketch(signature: np.ndarray) -> np.ndarray:
    """Parity bitmaps (texts x SKETCH_LONGS) of the samples of signatures."""
    bits = 64 * SKETCH_LONGS
    sample = np.arange(signature.shape[1], dtype=np.uint64) << np.uint64(32)
    place = (mix64(signature.astype(np.uint64) | sample) % np.uint64(bits)).astype(np.int64)
    at = place + bits * np.arange(len(place))[:, None]
    odd = (np.bincount(at.reshape(-1), minlength=bits * len(place)) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(place), bits), axis=1, bitorder="little").view("<i8")


def most_odd_bits(similarity: float) -> int:
    """The XOR population count up to which a pair's estimated similarity is
    at least ``similarity``: a sample that differs flips two random bits."""
    bits, samples = 64 * SKETCH_LONGS, BANDS * ROWS
    flips = 2 * samples * (1 - similarity)
    return int(np.ceil(bits / 2 * (1 - (1 - 2 / bits) ** flips)))


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band (texts x BANDS), different between bands."""
    key = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
    for r in range(ROWS):
        key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + signature[:, r::ROWS][:, :BANDS].astype(np.uint64))
    return key.view(np.int64)


def distinct_sets(column: pa.Array, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Per slice of a text column: first row and each row's sorted set."""
    for lo, _, buf, offsets in chunks(column):
        starts, ends, per_text = word_bounds(buf, offsets)
        shingles, counts = shingle_hashes(hash_words(buf, starts, ends), per_text, k)
        yield lo, [np.unique(s) for s in np.split(shingles, np.cumsum(counts)[:-1])]


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (digest of the set), bands, sketch."""
    schema = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, sets in distinct_sets(b.column(1), k):
                sizes = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(sizes)
                digest = np.zeros((len(sets), 2), np.int64)
                bands = np.zeros((len(sets), BANDS), np.int64)
                sketch = np.zeros((len(sets), SKETCH_LONGS), np.int64)
                if len(some):
                    signature = minhash(np.concatenate([sets[i] for i in some]), sizes[some])
                    bands[some], sketch[some] = band_keys(signature), odd_sketch(signature)
                    for i in some:
                        digest[i] = np.frombuffer(hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), np.int64)
                rows_of = lambda m: pa.ListArray.from_arrays(
                    np.arange(len(m) + 1, dtype=np.int32) * m.shape[1], pa.array(m.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(sets)), pa.array(sizes), pa.array(digest[:, 0]), pa.array(digest[:, 1]), rows_of(bands), rows_of(sketch)],
                    names=[f.split()[0] for f in schema.split(", ")],
                )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, shingles array<long>): the whole set of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, sets in distinct_sets(b.column(1), k):
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(sets)), pa.ListArray.from_arrays(ends, pa.array(flat))], names=["doc_id", "shingles"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, shingles array<long>")


def _reach(both: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * both >= percent * (a + b - both)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose full sets reach the similarity."""
    a = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return pairs.join(a, "u").join(b, "v").where(_reach(both, F.size("a"), F.size("b"), percent)).select("u", "v")


def odd_bits(sketches: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Bits in which each sketch differs from ``one``."""
    # unsigned: numpy counts the bits of a negative number's magnitude
    return np.bitwise_count((sketches ^ one).view(np.uint64)).sum(axis=1)


def spanning_forest(sketches: np.ndarray, near: int) -> list[tuple[int, int]]:
    """Edges of at most ``near`` odd bits that span a minimal forest (Prim)."""
    n = len(sketches)
    if n == 2:
        return [(0, 1)] if odd_bits(sketches[:1], sketches[1])[0] <= near else []
    out, best, source = [], np.full(n, 1 << 30), np.zeros(n, np.int64)
    left, at = np.ones(n, bool), 0
    left[0] = False
    for _ in range(n - 1):
        own = odd_bits(sketches, sketches[at])
        closer = left & (own < best)
        best[closer], source[closer] = own[closer], at
        at = int(np.where(left, best, 1 << 31).argmin())
        left[at] = False
        if best[at] <= near:
            out.append((int(source[at]), at))
    return out


def forest_pairs(members: DataFrame, sketches: DataFrame, near: int) -> DataFrame:
    """Pairs (u, v) of the spanning forests of all buckets."""
    chunks_ = F.ceil(F.col("n") / BLOCK).cast("int")
    first = F.pmod(F.xxhash64("doc_id", "band"), chunks_).cast("int")
    second = chunks_ + F.pmod(F.xxhash64("band", "doc_id", F.lit(1)), chunks_).cast("int")
    dealt = members.withColumn("chunk", F.explode(F.when(chunks_ == 1, F.array(F.lit(0))).otherwise(F.array(first, second))))
    keys = ["band", "chunk"]
    rows = dealt.join(sketches, "doc_id").select(*keys, "doc_id", "sketch").repartition(*keys).sortWithinPartitions(*keys, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 2):
            bounds, ids, own = group_bounds(table, 2), table.column("doc_id").to_numpy(), matrix(table.column("sketch"), SKETCH_LONGS)
            u, v = [], []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                for i, j in spanning_forest(own[lo:hi], near) if hi - lo > 1 else ():
                    u.append(ids[lo + i])
                    v.append(ids[lo + j])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    found = rows.mapInArrow(run, "u long, v long")
    return found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def meetings(placed: DataFrame) -> DataFrame:
    """Rows of buckets with several components, dealt so that every member
    outside the largest component meets every other member: band, block_a,
    block_b, side (0: outside, 1: all), doc_id, component, band_no."""
    parts = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("k"))
    largest = parts.groupBy("band").agg(
        F.max_by("component", F.struct("k", "component")).alias("largest"), F.sum("k").alias("all"), F.max("k").alias("inside"), F.count(F.lit(1)).alias("parts")
    )
    split = placed.join(largest.where("parts > 1").drop("parts"), "band")
    blocks_a = F.ceil((F.col("all") - F.col("inside")) / BLOCK).cast("int")
    blocks_b = F.ceil(F.col("all") / BLOCK).cast("int")
    hashed = F.xxhash64("doc_id", "band")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    rest = ["doc_id", "component", "band_no"]
    outside = split.where("component <> largest").select(
        "band", F.pmod(hashed, blocks_a).cast("int").alias("block_a"), every(blocks_b).alias("block_b"), F.lit(0).alias("side"), *rest
    )
    all_ = split.select("band", every(blocks_a).alias("block_a"), F.pmod(hashed, blocks_b).cast("int").alias("block_b"), F.lit(1).alias("side"), *rest)
    return outside.unionByName(all_)


KEYS = ["band", "block_a", "block_b"]


def worth_comparing(rows: DataFrame, reps: DataFrame, near: int) -> DataFrame:
    """The rows of ``meetings`` that have a partner whose sketch is near, in
    the first band that the two share."""
    data = rows.join(reps.select("doc_id", "bands", "sketch"), "doc_id")
    data = data.select(*KEYS, "side", "doc_id", "component", "band_no", "bands", "sketch").repartition(*KEYS).sortWithinPartitions(*KEYS, "side", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3):
            bounds = group_bounds(table, 3)
            side, ids, component, band_no = (table.column(c).to_numpy() for c in ("side", "doc_id", "component", "band_no"))
            bands, sketch = matrix(table.column("bands"), BANDS), matrix(table.column("sketch"), SKETCH_LONGS)
            wanted = np.zeros(table.num_rows, bool)
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                mid = lo + int(np.searchsorted(side[lo:hi], 1))
                other = np.arange(mid, hi)
                for i in range(lo, mid):
                    j = other[component[mid:hi] != component[i]]
                    j = j[odd_bits(sketch[j], sketch[i]) <= near]
                    if len(j):
                        j = j[(bands[j] == bands[i]).argmax(axis=1) == band_no[i]]
                        wanted[i] = len(j) > 0
                        wanted[j] = True
            yield from table.filter(pa.array(wanted)).select([*KEYS, "side", "doc_id", "component"]).to_batches()

    return data.mapInArrow(run, "band long, block_a int, block_b int, side int, doc_id long, component long")


def links_across(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between different components among the rows that meet,
    by their full sets."""
    data = rows.join(sets, "doc_id").select(*KEYS, "side", "doc_id", "component", "shingles").repartition(*KEYS).sortWithinPartitions(*KEYS, "side", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3):
            bounds = group_bounds(table, 3)
            side, ids, component = (table.column(c).to_numpy() for c in ("side", "doc_id", "component"))
            sets_ = lists(table.column("shingles"))
            u, v = [], []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                mid = lo + int(np.searchsorted(side[lo:hi], 1))
                if mid in (lo, hi):
                    continue
                sizes = np.array([len(s) for s in sets_[mid:hi]])
                known, at = np.unique(np.concatenate(sets_[mid:hi]), return_inverse=True)
                starts, mark = np.cumsum(sizes) - sizes, np.zeros(len(known), np.int64)
                for i in range(lo, mid):
                    own = np.minimum(np.searchsorted(known, sets_[i]), len(known) - 1)
                    own = own[known[own] == sets_[i]]
                    mark[own] = 1
                    both = np.add.reduceat(mark[at], starts)
                    mark[own] = 0
                    linked = (component[mid:hi] != component[i]) & (100 * both >= percent * (sizes + len(sets_[i]) - both))
                    # one link to each component is enough
                    for j in np.unique(component[mid:hi][linked], return_index=True)[1]:
                        u.append(ids[i])
                        v.append(ids[mid:hi][linked][j])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return data.mapInArrow(run, "u long, v long")


def representative_links(reps: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (u, v) whose components are those of all near-duplicate links
    between the class representatives ``reps``."""
    near = most_odd_bits(percent / 100 - SLACK)
    in_band = reps.select("doc_id", F.posexplode("bands").alias("band_no", "band"))
    buckets = in_band.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = materialize(in_band.join(buckets, "band"), "members")
    pairs = materialize(forest_pairs(members, reps.select("doc_id", "sketch"), near), "pairs")
    ends = pairs.select(F.col("u").alias("doc_id")).union(pairs.select(F.col("v").alias("doc_id"))).distinct()
    # the sets of documents that occur in a pair are made again from the texts
    sets = materialize(full_sets(texts_of(texts, materialize(ends, "ends")), k), "sets")
    links = materialize(confirmed(pairs, sets, percent), "links")

    component = components(links).select(F.col("node").alias("doc_id"), "component")
    placed = members.join(component, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    rows = materialize(worth_comparing(meetings(materialize(placed, "placed")), reps, near), "meetings")
    if rows.isEmpty():
        return links
    # A row of a chunked bucket may need its set for the first time now.
    missing = rows.select("doc_id").distinct().join(sets.select("doc_id"), "doc_id", "left_anti")
    missing = materialize(missing, "missing")
    if not missing.isEmpty():
        sets = sets.unionByName(materialize(full_sets(texts_of(texts, missing), k), "sets"))
    return links.unionByName(materialize(links_across(rows, sets, percent), "links"))


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents whose shingle sets
    have 100 x intersection >= percent x union are linked."""
    signed = materialize(signatures(docs, k), "signatures")
    classes = (
        signed.where("n_shingles > 0 and doc_id is not null")
        .groupBy("set_a", "set_b")
        .agg(F.min(F.struct("doc_id", "bands", "sketch")).alias("r"))
        .select("set_a", "set_b", "r.*")
    )
    reps = materialize(classes, "classes")
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    component = written_alone(
        docs.sparkSession,
        lambda: components(representative_links(reps, texts, k, percent)).select(F.col("node").alias("doc_id"), "component"),
        "near-components",
    )
    placed = reps.select("set_a", "set_b", "doc_id").join(component, "doc_id", "left")
    placed = placed.select("set_a", "set_b", F.coalesce("component", "doc_id").alias("_component"))
    found = signed.select("doc_id", "n_shingles", "set_a", "set_b").join(placed, ["set_a", "set_b"], "left")
    component_id = F.when(F.col("n_shingles") > 0, F.coalesce("_component", "doc_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component_id.alias("component_id"),
        F.coalesce(component_id == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document is kept, with all their columns."""
    name = fresh_name(docs, "dropped")
    dropped = near_duplicates(docs, k, percent).where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(dropped, docs["doc_id"].cast("long") == F.col(name), "left_anti")
