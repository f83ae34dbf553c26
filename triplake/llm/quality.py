"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its features: its words, the
character 3-, 4- and 5-grams of its words (with word borders), and a marker
wherever a word repeats the one before it.  Features are hashed into
``BUCKETS`` vectors of ``DIM`` numbers.  A linear layer and softmax give the
label.  Vectors and layer are trained together by stochastic gradient descent
in numpy.

Training uses a bounded sample of the labelled rows: up to ``sample_docs``
documents of each label, first in the order of a hash of their id, of at most
``SAMPLE_BYTES`` bytes each (longer ones are left out of the sample, never
cut).  Every document is scored on its whole text.  As the sample is balanced,
the label's log odds over all labelled training rows are put back into the
output bias.

Because the layer is linear, scoring needs one number per bucket: the bucket's
vector times the difference of the two output rows.  That table is bounded by
``BUCKETS``, and is all that is sent to the tasks.

Defined results: null, empty and blank texts have no features and get the
score of the bias; documents with several labels count once per label row;
labels other than 0 and 1 and null labels are not used; without labels of both
kinds every score is the share of label 1 (0.5 without any); repeated rows
each get their score; other columns are ignored (``score``) or kept
(``keep_good``).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.textbytes import LOWER, chunks, hash_words, mix64, word_bounds

BUCKETS = 1 << 18
DIM = 8
EPOCHS = 6
RATE = 0.5
NGRAMS = (3, 4, 5)
SAMPLE_DOCS = 1500
SAMPLE_BYTES = 1 << 16
THRESHOLD = 0.3
FOLDS = 5  # documents whose id hash leaves 0 are held out

_REPEAT = np.uint64(0xA5A5A5A5DEADBEEF)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of the texts, text by text, and their number
    per text.  Case matters: it tells prose from shouting."""
    n = len(offsets) - 1
    starts, ends, per_text = word_bounds(buf, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(n, np.int64)
    text = np.repeat(np.arange(n), per_text)
    words = hash_words(buf, starts, ends, lower=False)
    folded = hash_words(buf, starts, ends)
    again = np.flatnonzero((folded[1:] == folded[:-1]) & (text[1:] == text[:-1])) + 1
    keys, owners = [words, np.full(len(again), _REPEAT)], [text, text[again]]
    # word bytes between borders: one space before, one after each word
    size = ends - starts
    at = np.cumsum(size + 2) - (size + 2)
    line = np.full(int((size + 2).sum()), 0x20, np.uint64)
    inside = np.ones(len(line), bool)
    inside[at] = inside[at + size + 1] = False
    solid = np.zeros(len(buf), bool)
    edge = np.zeros(len(buf) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    solid = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    line[inside] = buf[solid]
    owner = np.repeat(text, size + 2)
    room = np.repeat(at + size + 2, size + 2) - np.arange(len(line))
    code = np.zeros(len(line), np.uint64)
    for k in range(min(max(NGRAMS), len(line))):
        code[: len(line) - k] = code[: len(line) - k] << np.uint64(8) | line[k:]
        if k + 1 in NGRAMS:
            full = np.flatnonzero(room > k)
            keys.append(mix64(code[full] + (np.uint64(k + 1) << np.uint64(56))))
            owners.append(owner[full])
    all_keys, all_owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(all_owners, kind="stable")
    return (all_keys[order] % np.uint64(BUCKETS)).astype(np.int64), np.bincount(all_owners, minlength=n)


class Model:
    """One weight per bucket and a bias: the log odds of label 1."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), self.bias)
        for lo, hi, buf, offsets in chunks(column, 1 << 18):
            buckets, counts = features(buf, offsets)
            some = np.flatnonzero(counts)
            if len(some):
                sums = np.add.reduceat(self.weights[buckets], np.cumsum(counts)[some] - counts[some])
                out[lo + some] += sums / counts[some]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def train(texts: list[str], labels: np.ndarray, log_odds: float, seed: int = 0) -> Model:
    """Fits vectors and output layer; ``log_odds`` is the label's in the
    population, whatever the sample's balance."""
    rng = np.random.Generator(np.random.PCG64(seed))
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    docs = []
    for lo, hi, buf, offsets in chunks(pa.array(texts, pa.string()), 1 << 18):
        buckets, counts = features(buf, offsets)
        for own, label in zip(np.split(buckets, np.cumsum(counts)[:-1]), labels[lo:hi]):
            if len(own):
                bucket, times = np.unique(own, return_counts=True)
                docs.append((bucket.astype(np.int32), (times / len(own)).astype(np.float32), int(label)))
    steps, done = max(1, EPOCHS * len(docs)), 0
    for _ in range(EPOCHS):
        for d in rng.permutation(len(docs)):
            bucket, share, label = docs[d]
            rate = RATE * (1 - done / steps)
            done += 1
            own = vectors[bucket]
            hidden = share @ own
            z = layer @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1  # gradient of the loss
            # the mean's gradient reaches each vector undivided, as is usual for this model
            vectors[bucket] = own - rate * np.minimum(1, share * len(bucket))[:, None] * (p @ layer)
            layer -= rate * np.outer(p, hidden)
            bias -= rate * p
    balance = float(np.log(max(1, (labels == 1).sum()) / max(1, (labels == 0).sum())))
    weights = vectors.astype(np.float64) @ (layer[1] - layer[0]).astype(np.float64)
    return Model(weights, float(bias[1] - bias[0]) - balance + log_odds)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = FOLDS, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Trains on labelled rows outside the held-out fold."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    own = own.where((fold(F.col("doc_id"), folds) != 0) & F.col("label").isin(0, 1))
    # Two rows: the label's counts.
    counts = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    if not (n0 and n1):
        return Model(np.zeros(BUCKETS), 0.0 if n0 == n1 else (-30.0 if n0 else 30.0))
    # Longer texts are not sampled; the sample is bounded by its documents and their bytes.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text") <= SAMPLE_BYTES)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [own.where(F.col("label") == v).orderBy(*order).limit(sample_docs) for v in (0, 1)]
    sample = rows.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id").orderBy(*order, "label", "text").limit(2 * sample_docs).collect()
    return train([r["text"] for r in sample], np.array([r["label"] for r in sample]), float(np.log(n1 / n0)))


def score(docs: DataFrame, model: Model, folds: int = FOLDS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.scores(b.column(1)))], names=["doc_id", "score"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), folds) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(shared.value.scores(b.column(at)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
