"""Lexical retrieval packing of documents into training sequences.

Every full window of a long document is a sequence of its own.  What is left
of each document (its tail) is packed with lexically similar tails.  The
inverted index is sharded by term: a tail belongs to the list of its strongest
term (occurrences times inverse document frequency over all tails), there
among those that share its next strongest terms, whatever their ids are; a
term that no other tail has leads nowhere and is passed over.  Each shard
builds a BM25 inverted index over its tails (document frequencies and mean
length come from all documents), and each seed document asks it for unused
neighbours, best first, which greedily fill the seed's window.  A neighbour
that does not fit is cut; its rest stays unused and is packed later.

Windows are therefore full but for what remains at the end of a shard.  That
remainder is cut at powers of two, which need no padding.

A shard is a block of at most ``SHARD_DOCS`` consecutive tails of a Spark
partition, so its index has a fixed bound however large or uneven the
partitions are; copies of one text are split between shards like other rows.

Defined results: a null text is empty and packs its end id alone; repeated
rows are packed as often as they occur; an empty table gives no pieces; other
columns are ignored.
"""

from __future__ import annotations

import contextlib
import ctypes
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.llm.tokens import encoder, vocabulary_path
from triplake.plans.materialize import materialize

WINDOW = 2048
SHARD_DOCS = 2048
PARTITION_DOCS = 8192
ROUTE_TERMS = 4  # strongest terms that place a tail in the index
FIRST_NEIGHBOURS = 16  # ranked before the others, which few windows need
DENSE_SHARE = 8  # terms of over an eighth of a shard's tails are added up as dense rows
SLICE_TAILS = 1024  # tails whose terms are counted together
K1, B = 1.2, 0.75

PIECES_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _give_back_memory() -> None:
    """Returns what earlier stages of a reused worker have freed to the
    system, before the tokenizer's tables grow."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def tails(docs: DataFrame, vocabulary: str, end_id: int, window: int) -> DataFrame:
    """Per document: its token count, the checksums of its full windows and
    the ids of its tail."""
    schema = "doc_id long, n long, full array<long>, tail binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _give_back_memory()
        enc = encoder(vocabulary)
        kind = "<u2" if max(enc.size, end_id + 1) <= 1 << 16 else "<u4"
        for b in batches:
            n, full, tail = [], [], []
            for text_ids in enc.encode_all(text.as_py() for text in b.column(1)):
                ids = np.append(text_ids, np.uint32(end_id))
                whole = len(ids) // window * window
                n.append(len(ids))
                full.append([_crc(ids[i : i + window]) for i in range(0, whole, window)])
                tail.append(ids[whole:].astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(full, pa.list_(pa.int64())), pa.array(tail, pa.binary())],
                names=["doc_id", "n", "full", "tail"],
            )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def term_counts(column: pa.Array, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of slices of tails: their sizes; and the distinct terms of each tail,
    tail by tail: the tail's number, the term, its occurrences."""
    for lo in range(0, len(column), SLICE_TAILS):
        part = column.slice(lo, SLICE_TAILS).to_pylist()
        ids = np.frombuffer(b"".join(part), kind)
        sizes = np.fromiter(map(len, part), np.int64, len(part)) // np.dtype(kind).itemsize
        # 10 bits of a tail's number and 16 of a term fit 32, others need 64
        wide = np.uint32 if kind == "<u2" else np.uint64
        bits = wide(16 if kind == "<u2" else 32)
        key = np.sort(np.repeat(np.arange(len(part), dtype=wide), sizes) << bits | ids)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        times = np.diff(first, append=len(key))
        key = key[first]
        yield sizes, (key >> bits).astype(np.int64), (key & ((wide(1) << bits) - wide(1))).astype(np.int64), times


def document_frequencies(parts: DataFrame, size: int) -> tuple[np.ndarray, int, float]:
    """Of all tails: documents per id (one number per vocabulary id), their
    number and their mean length."""
    kind = "<u2" if size <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2, np.int64)
        for b in batches:
            for sizes, _, term, _ in term_counts(b.column(0), kind):
                total[:size] += np.bincount(term, minlength=size)
                total[size] += np.count_nonzero(sizes)
                total[size + 1] += sizes.sum()
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["id", "n"])

    counted = parts.select("tail").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    out = np.zeros(size + 2, np.int64)
    for r in counted.toLocalIterator():
        out[r["id"]] = r["n"]
    return out[:size], int(out[size]), float(out[size + 1]) / max(1, int(out[size]))


def strongest(tail: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, terms: int) -> np.ndarray:
    """Per tail (0 .. n - 1) its terms of greatest weight, strongest first,
    ties to the smallest term; -1 where no term of positive weight is left.
    The rows are sorted by tail and term."""
    out = np.full((n, terms), -1, np.int64)
    left = weight > 0
    for k in range(terms):
        tail, term, weight = tail[left], term[left], weight[left]
        if not len(tail):
            break
        first = np.flatnonzero(np.append(True, tail[1:] != tail[:-1]))
        best = np.repeat(np.maximum.reduceat(weight, first), np.diff(first, append=len(tail)))
        at = np.flatnonzero(weight == best)
        at = at[np.append(True, tail[at[1:]] != tail[at[:-1]])]
        out[tail[at], k] = term[at]
        left = np.ones(len(tail), bool)
        left[at] = False
    return out


def routed(parts: DataFrame, strength: Broadcast[np.ndarray], kind: str) -> DataFrame:
    """The tails with their route: the strongest terms, strongest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            routes = [np.zeros((0, ROUTE_TERMS), np.int64)]
            for sizes, tail, term, times in term_counts(b.column(3), kind):
                routes.append(strongest(tail, term, times * strength.value[term], len(sizes), ROUTE_TERMS))
            route = np.concatenate(routes)
            ends = np.arange(len(route) + 1, dtype=np.int32) * ROUTE_TERMS
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.ListArray.from_arrays(ends, pa.array(route.reshape(-1)))], names=["doc_id", "n", "full", "tail", "route"]
            )

    own = parts.select("doc_id", "n", "full", "tail")
    return own.mapInArrow(run, "doc_id long, n long, full array<long>, tail binary, route array<long>")


class Shard:
    """BM25 inverted index over the tails of one shard."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.n = len(ids)
        sizes = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate(ids).astype(np.int64)
        key, tf = np.unique(flat * self.n + np.repeat(np.arange(self.n), sizes), return_counts=True)
        terms, self.docs = key // self.n, key % self.n
        self.impact = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[self.docs] / mean_length))
        self.terms, first = np.unique(terms, return_index=True)
        self.bounds = np.append(first, len(terms))
        # frequent terms have dense rows; the others' are -1
        sizes = np.diff(self.bounds)
        often = np.flatnonzero(DENSE_SHARE * sizes > self.n)
        self.row = np.full(len(self.terms), -1)
        self.row[often] = np.arange(len(often))
        self.dense = np.zeros((len(often), self.n))
        place = np.repeat(self.row, sizes)
        self.dense[place[place >= 0], self.docs[place >= 0]] = self.impact[place >= 0]
        # the terms of each document
        order = np.argsort(self.docs, kind="stable")
        self.of_doc = np.searchsorted(self.terms, terms[order])
        self.doc_bounds = np.searchsorted(self.docs[order], np.arange(self.n + 1))

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents that share a term with the seed, by falling score
        over all its terms, ties by position."""
        query = self.of_doc[self.doc_bounds[seed] : self.doc_bounds[seed + 1]]
        row = self.row[query]
        query, row = query[row < 0], row[row >= 0]
        first, sizes = self.bounds[query], self.bounds[query + 1] - self.bounds[query]
        ends = np.cumsum(sizes)
        postings = np.repeat(first - (ends - sizes), sizes) + np.arange(sizes.sum())
        score = self.dense[row].sum(axis=0) + np.bincount(self.docs[postings], self.impact[postings], self.n)
        found = np.flatnonzero(unused & (score > 0))
        score = score[found]
        if len(found) > 2 * FIRST_NEIGHBOURS:
            # the best ones, with all that tie with the last of them
            best = score >= np.partition(score, -FIRST_NEIGHBOURS)[-FIRST_NEIGHBOURS]
            yield from found[best][np.argsort(-score[best], kind="stable")].tolist()
            found, score = found[~best], score[~best]
        yield from found[np.argsort(-score, kind="stable")].tolist()


def pack_shard(ids: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of pieces (document, start, end), all full but for
    the last ones, whose sizes are powers of two."""
    live = [i for i, x in enumerate(ids) if len(x)]
    if not live:
        return
    index = Shard([ids[i] for i in live], idf, mean_length)
    sizes = [len(ids[i]) for i in live]
    start = [0] * len(live)
    unused = np.ones(len(live), bool)
    first = 0

    def take(d: int, room: int, into: list[tuple[int, int, int]]) -> int:
        end = min(sizes[d], start[d] + room)
        into.append((live[d], start[d], end))
        got, start[d] = end - start[d], end
        unused[d] = end < sizes[d]
        return got

    while True:
        while first < len(live) and not unused[first]:
            first += 1
        if first == len(live):
            return
        pieces: list[tuple[int, int, int]] = []
        filled = take(first, window, pieces)
        if filled < window:
            for d in index.neighbours(first, unused):
                filled += take(d, window - filled, pieces)
                if filled == window:
                    break
        if filled < window:  # no lexical neighbour is left: the next in order
            for d in np.flatnonzero(unused):
                filled += take(int(d), window - filled, pieces)
                if filled == window:
                    break
        while filled:  # a full window, or the end of the shard by powers of two
            size, part = 1 << (filled.bit_length() - 1) if filled < window else window, []
            room = size
            while room:
                d, a, b = pieces.pop(0)
                part.append((d, a, min(b, a + room)))
                if b - a > room:
                    pieces.insert(0, (d, a + room, b))
                room -= part[-1][2] - a
            yield part
            filled -= size


def pack(
    docs: DataFrame, vocabulary: str | None = None, end_id: int = 1, window: int = WINDOW, partition_docs: int = PARTITION_DOCS
) -> DataFrame:
    """One row per piece: the document's ids from ``start`` on that stand at
    ``offset`` of sequence ``sequence_id``.  ``window`` is a power of two."""
    vocabulary = vocabulary or vocabulary_path()
    spark = docs.sparkSession
    size = max(encoder(vocabulary).size, end_id + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    parts = materialize(tails(docs, vocabulary, end_id, window), "tails")
    frequency, total, mean_length = document_frequencies(parts, size)
    # One number per vocabulary id: bounded by the tokenizer, not by the data.
    idf = np.log1p((total - frequency + 0.5) / (frequency + 0.5))
    shared_idf = spark.sparkContext.broadcast(idf)
    strength = spark.sparkContext.broadcast(np.where(frequency > 1, idf, 0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 32
        held: list[tuple[int | None, int, list[int], np.ndarray]] = []

        def shard() -> pa.RecordBatch:
            nonlocal sequence
            rows: list[tuple] = []
            for doc_id, n, full, _ in held:
                for i, crc in enumerate(full):
                    rows.append((doc_id, i * window, window, crc, n, sequence, 0))
                    sequence += 1
            ids = [x for *_, x in held]
            for pieces in pack_shard(ids, shared_idf.value, mean_length, window):
                offset = 0
                for d, a, b in pieces:
                    doc_id, n, full, _ = held[d]
                    rows.append((doc_id, len(full) * window + a, b - a, _crc(ids[d][a:b]), n, sequence, offset))
                    offset += b - a
                sequence += 1
            held.clear()
            names = [f.split()[0] for f in PIECES_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

        for b in batches:
            for doc_id, n, full, tail in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                held.append((doc_id, n, full, np.frombuffer(tail.as_py(), kind)))
                if len(held) == SHARD_DOCS:
                    yield shard()
        if held:
            yield shard()

    n = max(1, -(-parts.count() // partition_docs))
    order = ["route", "doc_id", F.xxhash64("tail")]
    ranged = routed(parts, strength, kind).repartitionByRange(n, *order).sortWithinPartitions(*order)
    return ranged.select("doc_id", "n", "full", "tail").mapInArrow(run, PIECES_SCHEMA)
