"""Best-two-fit packing of documents into as few sequences as possible.

A document that is longer than a sequence is cut into full pieces; what is
left over is its first piece.  Pieces are packed whole.  Sequences are filled
one after the other: greedily with the largest pieces that still fit; then, if
there is a gap, the smallest piece is replaced with the two unpacked pieces
that fit the expanded gap most tightly, if they fit it better.

There are as many sizes of pieces as tokens in a sequence, however many pieces
there are.  So the plan is made from the number of pieces of each size: a
sequence's sizes are chosen once and used for as many sequences as the pieces
suffice for, which is what filling them one by one would choose.  At least one
size falls below its use each time, so the plan has a few thousand rows at any
size of the input.  Pieces are numbered within their size (counts per slice of
the written table and their running sums, no global sort), and the plan tells
the place of every number.

Defined results: a null text is empty and packs its end id alone; repeated
rows are packed as often as they occur; a null id is kept; an empty table gives
no pieces; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triplake.llm.tokens import vocabulary_path
from triplake.plans.materialize import materialize

BYTE_BPE = "byte_bpe_50k.json"
BYTE_BPE_RANKS = "byte_bpe_50k.tiktoken"
WINDOW = 2048
END_ID = 0

PIECES_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, slice int, nth long"


# ----------------------------------------------------------------- tokenizing


class ByteEncoder:
    """Ids of ``Tokenizer.encode(text, add_special_tokens=False)``.

    The vocabulary file's ids are merge ranks, so texts are encoded from the
    same vocabulary as ranks; texts that hold a special token's string are
    left to the tokenizer itself, which gives those their own ids."""

    def __init__(self, vocabulary: str, ranks: str):
        import base64

        import public_tokenizers
        import tiktoken

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.asarray(self.fast.encode_ordinary(text), np.uint32)


_encoders: dict[tuple[str, str], ByteEncoder] = {}


def byte_encoder(vocabulary: str, ranks: str) -> ByteEncoder:
    """The worker's encoder for a vocabulary file and its ranks."""
    key = (vocabulary, ranks)
    if key not in _encoders:
        _encoders[key] = ByteEncoder(*key)
    return _encoders[key]


def cut(n: int, window: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    first = n % window or window
    return [(0, min(n, first)), *((a, window) for a in range(first, n, window))]


def pieces(docs: DataFrame, vocabulary: str, ranks: str, end_id: int, window: int) -> DataFrame:
    """One row per piece with the checksum of its ids, the task that cut it
    (``slice``) and its number among that task's pieces of the same length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(vocabulary, ranks)
        met = np.zeros(window + 1, np.int64)
        task = TaskContext.get().partitionId()
        names = [f.split()[0] for f in PIECES_SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(encoder.encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                for i, (start, length) in enumerate(cut(len(ids), window)):
                    rows.append((doc_id, i, start, length, zlib.crc32(ids[start : start + length]), task, int(met[length])))
                    met[length] += 1
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, PIECES_SCHEMA)


# ------------------------------------------------------------------- the plan


class Stock:
    """Sizes that are left, with the number of pieces of each."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.astype(np.int64).copy()

    def largest(self, room: int) -> int:
        """The largest size that is left and fits, 0 if there is none."""
        fitting = np.flatnonzero(self.counts[1 : room + 1])
        return int(fitting[-1]) + 1 if len(fitting) else 0

    def best_two(self, room: int) -> tuple[int, int]:
        """The two pieces left whose sizes come nearest to ``room`` from
        below, (0, 0) if no two fit; of equal ones those with the largest."""
        sizes = np.flatnonzero(self.counts[: room + 1])
        sizes = sizes[sizes > 0]
        if not len(sizes):
            return 0, 0
        at = np.searchsorted(sizes, room - sizes, side="right") - 1
        at = np.minimum(at, np.arange(len(sizes)))  # the partner is no larger
        alone = (at == np.arange(len(sizes))) & (self.counts[sizes] < 2)
        at = np.where(alone, at - 1, at)
        total = np.where(at >= 0, sizes + sizes[at], 0)
        total[total > room] = 0
        best = len(sizes) - 1 - int(np.argmax(total[::-1]))
        return (int(sizes[best]), int(sizes[at[best]])) if total[best] else (0, 0)


def fill(stock: Stock, window: int) -> list[int]:
    """Sizes of the next sequence's pieces, taken out of the stock."""
    chosen: list[int] = []
    gap = window
    while gap and (size := stock.largest(gap)):
        n = min(int(stock.counts[size]), gap // size)
        stock.counts[size] -= n
        chosen += [size] * n
        gap -= n * size
    if gap and len(chosen) > 1:
        smallest = chosen[-1]
        two = stock.best_two(gap + smallest)
        if sum(two) > smallest:
            stock.counts[smallest] += 1
            chosen[-1:] = two
            for size in two:
                stock.counts[size] -= 1
    return chosen


def plan(counts: np.ndarray, window: int) -> Iterator[tuple[list[int], int]]:
    """(sizes of a sequence, number of such sequences) until nothing is left;
    ``counts`` has the number of pieces of every length."""
    stock = Stock(counts)
    while stock.counts.any():
        chosen = fill(stock, window)
        sizes, uses = np.unique(chosen, return_counts=True)
        more = int((stock.counts[sizes] // uses).min())
        stock.counts[sizes] -= more * uses
        yield chosen, 1 + more


def places(chosen: Iterable[tuple[list[int], int]]) -> np.ndarray:
    """Rows (length, first number, uses, first offset, first sequence): from
    that number on, each sequence takes ``uses`` pieces of that length."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for sizes, times in chosen:
        offset = 0
        for size in sorted(set(sizes), reverse=True):
            uses = sizes.count(size)
            rows.append((size, used.get(size, 0), uses, offset, sequence))
            used[size] = used.get(size, 0) + uses * times
            offset += uses * size
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


# -------------------------------------------------------------------- packing


def pack(
    docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None, end_id: int = END_ID, window: int = WINDOW
) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    vocabulary = vocabulary or vocabulary_path(BYTE_BPE)
    ranks = ranks or vocabulary_path(BYTE_BPE_RANKS)
    cut_pieces = materialize(pieces(docs, vocabulary, ranks, end_id, window), "pieces")
    cells = materialize(cut_pieces.groupBy("slice", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = np.zeros(window + 1, np.int64)
    for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length
        counts[r["length"]] = r["n"]
    shared = docs.sparkSession.sparkContext.broadcast(places(plan(counts, window)))
    # One row per slice and length; what a window gathers grows with the slices.
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    first = cells.select("slice", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    numbered = cut_pieces.join(first, ["slice", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("number")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        length, begin, uses, offset, sequence = table.T if len(table) else np.zeros((5, 0), np.int64)
        bounds = np.searchsorted(length, np.arange(window + 2))
        for b in batches:
            own, number = (b.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            row = np.zeros(len(own), np.int64)
            for size in np.unique(own):
                at = np.flatnonzero(own == size)
                lo, hi = bounds[size], bounds[size + 1]
                row[at] = lo + np.searchsorted(begin[lo:hi], number[at], side="right") - 1
            within = number - begin[row]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(sequence[row] + within // uses[row]), pa.array(offset[row] + within % uses[row] * own)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return numbered.mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
