"""Near-duplicate vectors by binary codes of random rotations.

1. Equal vectors of a label are one class with a multiplicity.
2. Each vector is normalised and rotated at random; the signs are its binary
   code, and the inner product of the unit vector with its own code is stored
   as correction factor.  Divided by that factor, the product of a code with
   another vector is an unbiased estimate of their cosine, with a known bound.
3. Runs of 16 code bits, over several rotations, are the bucket keys (with
   label and dimension).  A pair is looked at in the first bucket it shares.
4. In a bucket, estimate and bound drop the pairs that can't reach the
   threshold; for all others the cosine is computed again in doubles.
5. A task returns, for each vector, how many vectors it links with there and
   one link to the smallest member of its local component.  Counts are summed
   and links joined to components, so pairs are never listed.

A bucket of more than ``BLOCK`` classes is cut into blocks, and every pair of
blocks is a task's work, so a label or bucket that holds a third of all
vectors is spread and still complete.  Two vectors at cosine 0.98 share no
bucket with probability 1e-6.

Defined results: vectors without label, null or empty vectors, zero vectors
and vectors with null or non-finite components link with nothing; vectors of
different dimension are not compared; rows that repeat a vec_id each get a
row; a component is named by its smallest vec_id, null if none has one, and a
null vec_id is kept only if its component has no other name; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.llm.components import components
from triplake.llm.groups import whole_groups
from triplake.llm.textbytes import mix64
from triplake.plans.materialize import materialize

BANDS = 32
BAND_BITS = 16
LEAST_DIMENSION = 64  # shorter vectors are padded with zeros
BLOCK = 512
EPSILON = 4.0  # the bound's width, in the method's notation
PAIR_CELLS = 1 << 21  # vector components of the pairs looked at together

_rotations: dict[tuple[int, int], np.ndarray] = {}


def padded_dimension(d: int) -> int:
    return max(LEAST_DIMENSION, -(-d // BAND_BITS) * BAND_BITS)


def rotation(d: int, i: int) -> np.ndarray:
    """The i-th random orthogonal matrix of dimension ``d``."""
    if (d, i) not in _rotations:
        q, r = np.linalg.qr(np.random.Generator(np.random.PCG64([d, i])).standard_normal((d, d)))
        _rotations[d, i] = q * np.sign(np.diag(r))
    return _rotations[d, i]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of finite, non-zero vectors at length 1, padded with zeros."""
    big = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / big  # so that squares neither overflow nor vanish
    scaled /= np.linalg.norm(scaled, axis=1, keepdims=True)
    return np.pad(scaled, ((0, 0), (0, padded_dimension(vectors.shape[1]) - vectors.shape[1])))


def codes(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each unit vector: BANDS runs of code bits (the first rotation's code
    comes first), and the correction factor of the first rotation."""
    d = units.shape[1]
    per_rotation = d // BAND_BITS
    runs, factor = [], None
    for i in range(-(-BANDS // per_rotation)):
        turned = units @ rotation(d, i)
        if factor is None:
            factor = np.abs(turned).sum(axis=1) / np.sqrt(d)
        runs.append(np.packbits(turned >= 0, axis=1, bitorder="little").view("<u2"))
    return np.concatenate(runs, axis=1)[:, : max(BANDS, per_rotation)], factor


def code_signs(runs: np.ndarray, d: int) -> np.ndarray:
    """The first rotation's codes as -1 and 1."""
    bits = np.unpackbits(np.ascontiguousarray(runs[:, : d // BAND_BITS]).view(np.uint8), axis=1, bitorder="little")
    return bits.astype(np.float32) * 2 - 1


def estimates(signs: np.ndarray, factor: np.ndarray, turned: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosine of the pairs (i, j) from the code of i and the rotated
    vector of j, and the half width of the confidence interval."""
    d = signs.shape[1]
    product = np.einsum("pk,pk->p", signs[i], turned[j]).astype(np.float64) / np.sqrt(d)
    width = np.sqrt(np.maximum(0, 1 - factor**2)) / factor * EPSILON / np.sqrt(d - 1)
    return product / factor[i], width[i]


def coded(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label, key_a, key_b (digest of label and vector; null if the
    vector links with nothing), vector, runs, factor, bands."""
    schema = "vec_id long, label string, key_a long, key_b long, vector array<double>, runs binary, factor double, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            labels = b.column(1).to_pylist()
            rows = [None if x.as_py() is None else x.values.to_numpy(zero_copy_only=False) for x in b.column(2)]
            n = len(rows)
            key = np.zeros((n, 2), np.int64)
            good = np.zeros(n, bool)
            runs: list[bytes | None] = [None] * n
            bands: list[np.ndarray | None] = [None] * n
            factor = np.zeros(n)
            by_size: dict[int, list[int]] = {}
            for i, (v, label) in enumerate(zip(rows, labels)):
                if v is not None and label is not None and len(v) and np.isfinite(v).all() and v.any():
                    by_size.setdefault(len(v), []).append(i)
            for size, at in by_size.items():
                own, f = codes(unit(np.stack([rows[i] for i in at])))
                good[at], factor[at] = True, f
                salt = mix64(np.arange(BANDS, dtype=np.uint64) + (np.uint64(size) << np.uint64(8)))
                for r, i in enumerate(at):
                    digest = hashlib.blake2b(labels[i].encode() + b"\0" + rows[i].tobytes(), digest_size=16).digest()
                    key[i] = np.frombuffer(digest, np.int64)
                    runs[i] = own[r].tobytes()
                    seed = np.frombuffer(hashlib.blake2b(labels[i].encode(), digest_size=8).digest(), np.uint64)[0]
                    bands[i] = mix64(mix64(own[r][:BANDS].astype(np.uint64) + salt) ^ seed).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array(key[:, 0], mask=~good),
                    pa.array(key[:, 1], mask=~good),
                    pa.array([v if g else None for v, g in zip(rows, good)], pa.list_(pa.float64())),
                    pa.array(runs, pa.binary()),
                    pa.array(factor, mask=~good),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=[f.split()[0] for f in schema.split(", ")],
            )

    own = vectors.select(
        vectors[id_col].cast("long").alias("vec_id"),
        vectors[label_col].cast("string").alias("label"),
        vectors[vector_col].cast("array<double>").alias("vector"),
    )
    return own.mapInArrow(run, schema)


def near_pairs(group: np.ndarray, pairs: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of the same group (sorted ids), about ``pairs`` at a time."""
    ends = np.searchsorted(group, group, side="right")
    i = np.arange(len(group))
    held_i, held_j, held = [], [], 0
    for step in range(1, int((ends - i).max(initial=1))):
        i = i[i + step < ends[i]]
        held_i.append(i)
        held_j.append(i + step)
        held += len(i)
        if held >= pairs:
            yield np.concatenate(held_i), np.concatenate(held_j)
            held_i, held_j, held = [], [], 0
    if held:
        yield np.concatenate(held_i), np.concatenate(held_j)


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row that links reach, for each of ``n`` rows."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], least)
        np.minimum.at(root, root[j], least)
        root = root[root]
        if (root == before).all():
            return root


def link_block(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class numbers, linked vectors and local roots of the whole groups in
    ``table`` (band, block_a, block_b, cid, block, band_no, n, vector, runs,
    factor)."""
    cols = {name: table.column(name) for name in table.column_names}
    band, a, b, cid, block, n = (cols[c].to_numpy() for c in ("band", "block_a", "block_b", "cid", "block", "n"))
    changed = np.concatenate([[0], (band[1:] != band[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    group = np.cumsum(changed)
    size = len(cols["runs"][0].as_py()) // 2
    runs = np.frombuffer(b"".join(cols["runs"].to_pylist()), "<u2").reshape(-1, size)
    factor = cols["factor"].to_numpy()
    vectors = np.concatenate([c.flatten().to_numpy() for c in cols["vector"].chunks]).reshape(len(cid), -1)
    units = unit(vectors)
    d = units.shape[1]
    signs, turned = code_signs(runs, d), (units @ rotation(d, 0)).astype(np.float32)
    band_no = cols["band_no"].to_numpy()
    linked, found_i, found_j = np.zeros(len(cid), np.int64), [], []
    for i, j in near_pairs(group, PAIR_CELLS // d):
        # blocks of one bucket meet each other here, each meets itself elsewhere
        across = (a[i] == b[i]) | (block[i] != block[j])
        # the first band in which the pair meets is the one that counts it
        first = (runs[i][:, :BANDS] == runs[j][:, :BANDS]).argmax(axis=1) == band_no[i]
        i, j = i[across & first], j[across & first]
        if not len(i):
            continue
        estimate, width = estimates(signs, factor, turned, i, j)
        open_ = estimate + width >= threshold
        i, j = i[open_], j[open_]
        cosine = np.einsum("pk,pk->p", units[i], units[j])
        i, j = i[cosine >= threshold], j[cosine >= threshold]
        np.add.at(linked, i, n[j])
        np.add.at(linked, j, n[i])
        found_i.append(i)
        found_j.append(j)
    root = np.arange(len(cid))
    if found_i:
        root = local_roots(len(cid), np.concatenate(found_i), np.concatenate(found_j))
    some = np.flatnonzero(linked)
    return cid[some], linked[some], cid[root[some]]


def near_duplicate_vectors(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    rows = materialize(coded(vectors, id_col, vector_col, label_col), "vector-codes")
    classes = (
        rows.where("key_a is not null")
        .groupBy("key_a", "key_b")
        .agg(
            F.min("vec_id").alias("least"),
            F.count(F.lit(1)).alias("n"),
            F.first("vector").alias("vector"),
            F.first("runs").alias("runs"),
            F.first("factor").alias("factor"),
            F.first("bands").alias("bands"),
        )
        .withColumn("cid", F.monotonically_increasing_id())
    )
    classes = materialize(classes, "vector-classes")
    in_band = classes.select("cid", F.posexplode("bands").alias("band_no", "band"))
    buckets = in_band.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = (
        in_band.join(buckets, "band")
        .withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "band",
            F.least("block", "other").cast("int").alias("block_a"),
            F.greatest("block", "other").cast("int").alias("block_b"),
            "cid",
            "block",
            "band_no",
        )
    )
    data = members.join(classes.select("cid", "n", "vector", "runs", "factor"), "cid")
    keys = ["band", "block_a", "block_b"]
    dealt = data.select(*keys, "cid", "block", "band_no", "n", "vector", "runs", "factor").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3):
            # vectors of one dimension at a time: a group has only one
            sizes = pc.list_value_length(table.column("vector")).to_numpy()
            for size in np.unique(sizes):
                cid, linked, root = link_block(table.filter(pa.array(sizes == size)), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(cid), pa.array(linked), pa.array(root)], names=["cid", "linked", "root"])

    found = materialize(dealt.mapInArrow(run, "cid long, linked long, root long"), "vector-links")
    links = found.groupBy("cid").agg(F.sum("linked").alias("linked"))
    component = components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    placed = classes.select("key_a", "key_b", "cid", "least", "n").join(component.withColumnRenamed("node", "cid"), "cid", "left").join(links, "cid", "left")
    placed = materialize(placed.withColumn("component", F.coalesce("component", "cid")), "vector-components")
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    by_key = placed.join(names, "component").select("key_a", "key_b", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    out = rows.select("vec_id", "key_a", "key_b").join(by_key, ["key_a", "key_b"], "left")
    component_id = F.when(F.col("key_a").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        F.col("vec_id").eqNullSafe(component_id).alias("kept"),
    )
