"""Token-id files: frequency-ranked ids, byte-aligned lengths, control bytes.

Ids are replaced by their frequency rank over the whole corpus, so that
frequent ids are small numbers.  Four ranks share a control byte that holds
their lengths (2 bits each, 1 to 4 bytes, first rank in the low bits); the
rank bytes (little endian) follow in a separate data stream.  Decoding looks
the control bytes up in a 256-row table and gathers the data bytes with numpy.

A file holds documents in ascending doc_id order as blocks:

    magic "TIDV1\\n"
    block*: four unsigned 64-bit counts (documents, ids, control bytes, data
            bytes), then per document: flag "id is null" (1 byte), doc_id
            (8 bytes), ids (8 bytes); control bytes; data bytes

The rank table is a Parquet table beside the files.  Files cover consecutive
ranges of doc_id, so a manifest row per file gives the place of its first id.

Defined results: null texts are empty (only the end id); a null doc_id comes
first; repeated rows are kept; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triplake.llm import shared_files
from triplake.llm.textbytes import CHUNK
from triplake.llm.tokens import encoder, vocabulary_path
from triplake.plans.materialize import materialize
from triplake.session import scratch_path

MAGIC = b"TIDV1\n"
BLOCK_IDS = 1 << 18  # ids after which a block is closed
ROW_BYTES = 8 << 20  # bytes of ids after which a batch of rows is closed

# Length table: for each control byte the lengths of its four ranks.
LENGTHS = np.array([[(c >> (2 * j) & 3) + 1 for j in range(4)] for c in range(256)], np.int64)


def encode_block(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of ranks."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = size - 1
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_block(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of a block, by table lookup."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(size) - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    out = np.zeros(n, np.uint32)
    for j in range(4):
        part = raw[starts + j].astype(np.uint32) << np.uint32(8 * j)
        out |= part if j == 0 else np.where(size > j, part, np.uint32(0))
    return out


def tokenized(docs: DataFrame, path: str, end_id: int, extra: list[str] | None = None) -> DataFrame:
    """(doc_id, n, ids[, extra columns]): the ids of each text and the end id
    as little-endian numbers of 2 bytes, or of 4 if the vocabulary needs it."""
    extra = extra or []
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text", *extra)
    schema = ", ".join(["doc_id long", "n long", "ids binary", *(f"{f.name} {f.dataType.simpleString()}" for f in own.schema if f.name in extra)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        kind = "<u2" if max(enc.size, end_id + 1) <= 1 << 16 else "<u4"
        names = ["doc_id", "n", "ids", *extra]
        for b in batches:
            lo, ids, n, held = 0, [], [], 0
            for i, text_ids in enumerate(enc.encode_all(text.as_py() for text in b.column(1))):
                own_ids = np.append(text_ids, np.uint32(end_id)).astype(kind)
                ids.append(own_ids.tobytes())
                n.append(len(own_ids))
                held += len(ids[-1])
                if held >= ROW_BYTES or i + 1 == b.num_rows:
                    part = b.slice(lo, i + 1 - lo)
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), *part.columns[2:]], names=names)
                    lo, ids, n, held = i + 1, [], [], 0

    return own.mapInArrow(run, schema)


def id_counts(tokens: DataFrame, size: int) -> DataFrame:
    """(id, n) over all ids; each task sends one row per id it met."""
    kind = "<u2" if size <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            ids = np.frombuffer(b"".join(b.column(0).to_pylist()), kind)
            for lo in range(0, len(ids), CHUNK):
                total += np.bincount(ids[lo : lo + CHUNK], minlength=size)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["id", "n"])

    counted = tokens.select("ids").mapInArrow(run, "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def write_files(docs: DataFrame, vocabulary: str, end_id: int, docs_per_file: int) -> tuple[str, DataFrame, np.ndarray]:
    """Writes the files; returns their folder, the manifest (file, first,
    docs, ids, start) and the ids by rank (one entry per vocabulary id)."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    size = max(encoder(vocabulary).size, end_id + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    tokens = materialize(tokenized(docs, vocabulary, end_id), "token-ids")
    # One number per vocabulary id: bounded by the tokenizer, not by the data.
    counts = np.zeros(size, np.int64)
    for r in id_counts(tokens, size).toLocalIterator():
        counts[r["id"]] = r["n"]
    by_rank = np.lexsort((np.arange(size), -counts)).astype(np.uint32)
    rank_of = np.empty(size, np.uint32)
    rank_of[by_rank] = np.arange(size, dtype=np.uint32)
    shared_rank = spark.sparkContext.broadcast(rank_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, first, docs_seen, ids_seen = None, "", None, 0, 0
        rows: list[tuple[int | None, int]] = []
        held: list[np.ndarray] = []

        def close_block() -> None:
            ranks = np.concatenate(held) if held else np.zeros(0, np.uint32)
            control, data = encode_block(ranks)
            out.write(np.array([len(rows), len(ranks), len(control), len(data)], "<u8").tobytes())
            out.write(bytes(i is None for i, _ in rows))
            out.write(np.array([i or 0 for i, _ in rows], "<i8").tobytes() + np.array([n for _, n in rows], "<u8").tobytes())
            out.write(control)
            out.write(data)
            rows.clear()
            held.clear()

        open_ids = 0
        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), b.column(1)):
                if out is None:
                    out, name = shared_files.new_file(folder, ".tid")
                    out.write(MAGIC)
                    first = doc_id
                ranks = shared_rank.value[np.frombuffer(ids.as_py(), kind)]
                rows.append((doc_id, len(ranks)))
                held.append(ranks)
                docs_seen, ids_seen, open_ids = docs_seen + 1, ids_seen + len(ranks), open_ids + len(ranks)
                if open_ids >= BLOCK_IDS:
                    close_block()
                    open_ids = 0
        if out is not None:
            if rows:
                close_block()
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([first], pa.int64()), pa.array([docs_seen], pa.int64()), pa.array([ids_seen], pa.int64())],
                names=["file", "first", "docs", "ids"],
            )

    n = max(1, -(-tokens.count() // docs_per_file))
    # the ids' hash splits a hot doc_id between files
    order = ["doc_id", F.xxhash64("ids")]
    ranged = tokens.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()).sortWithinPartitions(*order)
    written = materialize(
        ranged.select("doc_id", "ids").mapInArrow(run, "file string, first long, docs long, ids long").withColumn("_part", F.spark_partition_id()),
        "token-manifest",
    )
    # One row per file: bounded by the number of files.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = written.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0))).drop("_part")
    return folder, manifest, by_rank


def read_files(folder: str, manifest: DataFrame, by_rank: np.ndarray) -> DataFrame:
    """Reads the files back: doc_id, start, n_tokens, ids_crc32 per document."""
    shared = manifest.sparkSession.sparkContext.broadcast(by_rank)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with shared_files.read_file(folder, name) as f:
                    if f.read(len(MAGIC)) != MAGIC:
                        raise ValueError(f"{folder}/{name} is not a token file")
                    while head := f.read(32):
                        docs, n, control, data = np.frombuffer(head, "<u8").tolist()
                        null = np.frombuffer(f.read(docs), np.uint8).astype(bool)
                        doc_ids = np.frombuffer(f.read(8 * docs), "<i8")
                        sizes = np.frombuffer(f.read(8 * docs), "<u8").astype(np.int64)
                        ids = shared.value[decode_block(f.read(control), f.read(data), n)].astype("<u4")
                        ends = np.cumsum(sizes)
                        crc = [zlib.crc32(ids[e - k : e].tobytes()) for e, k in zip(ends.tolist(), sizes.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(doc_ids, pa.int64(), mask=null), pa.array(start + ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )
                        start += n

    # a file per task; without the number, adaptive execution would merge the
    # manifest's few rows into one task, which then reads every file
    spread = manifest.select("file", "start").repartitionByRange(max(1, manifest.count()), "file")
    return spread.mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary: str | None = None, end_id: int = 2, docs_per_file: int = 8192) -> DataFrame:
    """Writes the files of ``docs`` and returns what is read back from them."""
    folder, manifest, by_rank = write_files(docs, vocabulary or vocabulary_path(), end_id, docs_per_file)
    return read_files(folder, manifest, by_rank)
