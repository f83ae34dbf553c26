"""Context-tree weighting over bytes.

A byte is eight binary decisions, one at each node of the tree of its bits.
Every node has a context tree over the bytes before.  A context of d bytes,
d = 0 .. DEPTH, has Krichevsky-Trofimov (KT) counts of the decisions seen
after it, and is weighted half by its own KT estimate and half by the product
of its children, the contexts one byte longer.

All contexts up to DEPTH bytes count, however rare, so the model grows with
the corpus and lives in tables:

1. Every distinct run of DEPTH + 1 bytes (a context and the byte after it) has
   a 64-bit key that starts with the newest context byte, and its number in
   training texts.
2. Contexts of ``TOP`` bytes are the roots of subtrees, and a subtree's runs are
   neighbours when sorted by key: tasks weight whole subtrees from the leaves up.
3. What the subtrees of a context of TOP - 1 bytes come to is summed; the levels
   above them (no more than 256 ** (TOP - 1) contexts) are weighted at the
   driver and broadcast.
4. Prediction after training mixes the KT estimates along the path of contexts
   with their posterior weights

       beta = own block probability / product of the children's,

   which gives one probability per run.
5. The most frequent runs, at most ``COMMON_RUNS``, are looked up inside tasks;
   the others are joined to their probability by a shuffle.

Nodes that training never met have probability 1/2, as the definition says.

The base score is a unigram of words with additive smoothing.  Words with at
least one of ``COMMON_WORDS`` parts of all tokens (no more than that many) are
looked up inside tasks; the others are joined to their counts by a shuffle.

Defined results: null, empty and blank texts have the end token and the end
byte only; a null doc_id is trained on and not held out; repeated rows each
count and get their score; without training rows every decision has
probability 1/2 and the base formula holds with N = V = 0; a byte 0 in a text
is a byte like others (it also ends a text and stands before it); an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.groups import whole_groups
from triplake.llm.textbytes import chunks, hash_words, word_bounds
from triplake.plans.materialize import materialize

DEPTH = 5
TOP = 3  # bytes of the contexts whose subtrees are weighted in tasks
COMMON_WORDS = 1 << 18
COMMON_RUNS = 1 << 20
FOLDS = 10
SMOOTHING = 0.1
END_WORD = 0  # stands for the end token among the word hashes
MERGE_AT = 1 << 22  # distinct keys that a task holds before it sends them on


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


# ---------------------------------------------------------------- counting


class Counter:
    """Sums counts by 64-bit key within a task."""

    def __init__(self) -> None:
        self.keys, self.n, self.held = [], [], 0

    def add(self, keys: np.ndarray, times: int = 1) -> Iterator[pa.RecordBatch]:
        """Counts keys; yields the sums when too many are held."""
        k, n = np.unique(keys, return_counts=True)
        self.keys.append(k)
        self.n.append(n * times)
        self.held += len(k)
        if self.held >= MERGE_AT:
            self._merge()
            if self.held >= MERGE_AT // 2:
                yield self.batch()
                self.keys, self.n, self.held = [], [], 0

    def _merge(self) -> None:
        if self.keys:
            k, at = np.unique(np.concatenate(self.keys), return_inverse=True)
            n = np.bincount(at, np.concatenate(self.n), len(k)).astype(np.int64)
            self.keys, self.n, self.held = [k], [n], len(k)

    def batch(self) -> pa.RecordBatch:
        self._merge()
        k = self.keys[0] if self.keys else np.zeros(0, np.int64)
        n = self.n[0] if self.keys else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])


def positions(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts on one line, DEPTH zeros before and a zero after each; the
    places to predict (all bytes and ends, text by text); their offsets."""
    n = len(offsets) - 1
    own = offsets + np.arange(n + 1)
    places = np.arange(own[-1]) + np.repeat(np.arange(1, n + 1) * DEPTH, np.diff(own))
    line = np.zeros(int(own[-1]) + n * DEPTH, np.uint8)
    solid = np.ones(len(places), bool)
    solid[own[1:] - 1] = False
    line[places[solid]] = buf
    return line, places, own


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Log of the gamma function for x > 0: Stirling's series, after the
    recurrence has lifted small arguments to 8 and more."""
    steps = np.maximum(0, np.ceil(8 - x))
    lift = np.zeros_like(x)
    for s in range(8):
        lift += np.where(steps > s, np.log(x + s), 0.0)
    y = x + steps
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - lift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log KT probability of a block of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


# ---------------------------------------------------------------- the whole model


def runs(line: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Key of each place: the bytes before it, newest first, and its own."""
    key = np.zeros(len(places), np.int64)
    for d in range(1, DEPTH + 1):
        key = key << 8 | line[places - d]
    return key << 8 | line[places]


def run_counts(own: DataFrame, folds: int) -> DataFrame:
    """(key, n): the runs of all texts, n times in those that are trained on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for b in batches:
            learned = b.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, buf, offsets in chunks(b.column(0)):
                line, places, texts = positions(buf, offsets)
                key, met = runs(line, places), np.repeat(learned[lo:hi], np.diff(texts))
                yield from counter.add(key[met])
                yield from counter.add(key[~met], 0)
        yield counter.batch()

    texts = own.select("text", ~held_out(F.col("doc_id"), folds))
    return texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def weighted(node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Log weighted probability of nodes, their KT estimate of a one and their
    posterior share, given the log product of their children (none: leaves)."""
    own, kt = log_kt(zeros, ones), (ones + 0.5) / (zeros + ones + 1)
    if below is None:
        return own, kt, np.ones(len(node))
    share = 1 / (1 + np.exp(np.clip(below - own, -700, 700)))
    return np.logaddexp(own, below) - np.log(2), kt, share


def bit_nodes(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per level and run: the node (1 .. 255) and the bit decided there."""
    byte, level = key & 255, np.arange(8)[:, None]
    return 1 << level | byte >> 8 - level, byte >> 7 - level & 1


def subtrees(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weights whole subtrees of distinct runs.  Returns their nodes (context of
    TOP bytes and node), zeros, ones and log weighted probability; and the
    probability of a one that the subtrees mix, per level and run."""
    node, bit = bit_nodes(key)
    below, levels = None, []
    for depth in range(DEPTH, TOP - 1, -1):
        at, place = np.unique(key >> 8 * (DEPTH + 1 - depth) << 8 | node, return_inverse=True)
        place = place.reshape(node.shape)
        total = np.bincount(place.reshape(-1), np.broadcast_to(n, node.shape).reshape(-1), len(at))
        ones = np.bincount(place.reshape(-1), (bit * n).reshape(-1), len(at))
        if below is not None:
            lower, value = below
            below = np.bincount(np.searchsorted(at, lower >> 16 << 8 | lower & 255), value, len(at))
        value, kt, share = weighted(at, total - ones, ones, below)
        below = at, value
        levels.append((place, kt, share))
    p: np.ndarray | float = 0.0
    for place, kt, share in levels:
        p = (share * kt)[place] + (1 - share)[place] * p
    return at, total - ones, ones, value, p


def top_levels(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of contexts of TOP - 1 bytes, and a, b: a + b * p is the prediction
    there if the subtree's is p."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, 1):
            at, zeros, ones, value, _ = subtrees(t.column("key").to_numpy(), t.column("n").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at >> 16 << 8 | at & 255, zeros, ones, value)], names=["node", "zeros", "ones", "below"])

    rows = by_subtree(counts).mapInArrow(run, "node long, zeros double, ones double, below double")
    # At most 256 ** (TOP - 1) contexts, whatever the corpus holds.
    got = rows.groupBy("node").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "below"))).orderBy("node").toArrow()
    leaf, zeros, ones, below = (got.column(c).to_numpy() for c in ("node", "zeros", "ones", "below"))
    at, levels, place = leaf, [], np.arange(len(leaf))
    for depth in range(TOP - 1, -1, -1):
        value, kt, share = weighted(at, zeros, ones, below)
        levels.append((place, kt, share))
        if depth:
            at, up = np.unique(at >> 16 << 8 | at & 255, return_inverse=True)
            zeros, ones, below = (np.bincount(up, x, len(at)) for x in (zeros, ones, value))
            place = up[place]
    a, b = np.zeros(len(leaf)), np.ones(len(leaf))
    for place, kt, share in levels:
        a, b = (share * kt)[place] + (1 - share)[place] * a, (1 - share)[place] * b
    return leaf, a, b


def by_subtree(counts: DataFrame) -> DataFrame:
    root = F.shiftright("key", 8 * (DEPTH + 1 - TOP))
    return counts.select(root.alias("root"), "key", "n").repartition("root").sortWithinPartitions("root", "key")


def run_scores(counts: DataFrame) -> DataFrame:
    """(key, n, score): log10 probability of the last byte of every run."""
    shared = counts.sparkSession.sparkContext.broadcast(top_levels(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, a, b = shared.value
        for t in whole_groups(batches, 1):
            key, n = t.column("key").to_numpy(), t.column("n").to_numpy()
            *_, p = subtrees(key, n)
            node, bit = bit_nodes(key)
            at = np.searchsorted(leaf, key >> 8 * (DEPTH + 2 - TOP) << 8 | node)
            p = a[at] + b[at] * p
            score = np.log10(np.where(bit == 1, p, 1 - p)).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n), pa.array(score)], names=["key", "n", "score"])

    return by_subtree(counts).mapInArrow(run, "key long, n long, score double")


# ---------------------------------------------------------------- scoring


def looked_up(values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where values stand among sorted keys, and whether they are there."""
    at = np.minimum(np.searchsorted(keys, values), max(0, len(keys) - 1))
    return at, keys[at] == values if len(keys) else np.zeros(len(values), bool)


def own_lists(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[pa.ListArray, pa.ListArray]:
    """Per owner (0 .. n - 1): its distinct values, and how often each occurs."""
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(values))).astype(np.int64)
    sizes = np.append(0, np.cumsum(np.bincount(owner[first], minlength=n))).astype(np.int32)
    return pa.ListArray.from_arrays(sizes, pa.array(values[first])), pa.ListArray.from_arrays(sizes, pa.array(times))


def word_counts(texts: DataFrame) -> DataFrame:
    """(key, n): words of the texts by 64-bit hash, END_WORD once per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for b in batches:
            for lo, hi, buf, offsets in chunks(b.column(0)):
                starts, ends, _ = word_bounds(buf, offsets)
                words = hash_words(buf, starts, ends).view(np.int64)
                yield from counter.add(np.concatenate([words, np.full(hi - lo, END_WORD, np.int64)]))
        yield counter.batch()

    return texts.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def score_documents(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    training = own.where(~held_out(F.col("doc_id"), folds))
    words = materialize(word_counts(training), "word-counts")
    known = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, log_all = int(known["n"]), float(np.log10(known["n"] + SMOOTHING * (known["v"] + 1)))
    # No more than COMMON_WORDS words reach that share of all tokens.
    common = words.where(F.col("n") * COMMON_WORDS >= total).orderBy("key").toArrow()
    scores = materialize(run_scores(materialize(run_counts(own, folds), "run-counts")), "run-scores")
    # The most frequent runs, as many octave eighths as hold no more than COMMON_RUNS.
    octave = F.floor(F.log2("n") * 8)
    least, runs_met = np.inf, 0
    for r in sorted(scores.where("n > 0").groupBy(octave.alias("octave")).count().collect(), reverse=True):
        runs_met += r["count"]
        if runs_met > COMMON_RUNS:
            break
        least = r["octave"]
    often = scores.where((F.col("n") > 0) & (octave >= F.lit(float(least)))).select("key", "score").orderBy("key").toArrow()
    shared = spark.sparkContext.broadcast(
        tuple(t.column(c).to_numpy() for t, c in ((common, "key"), (common, "n"), (often, "key"), (often, "score")))
    )
    schema = (
        "doc_id long, n_tokens long, n_common long, common_log double, score double, "
        "rare array<long>, times array<long>, runs array<long>, run_times array<long>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, run_keys, run_logs = shared.value
        logs = np.log10(counts + SMOOTHING)
        for b in batches:
            for lo, hi, buf, offsets in chunks(b.column(1)):
                n = hi - lo
                starts, ends, per_text = word_bounds(buf, offsets)
                word = np.concatenate([hash_words(buf, starts, ends).view(np.int64), np.full(n, END_WORD, np.int64)])
                text = np.concatenate([np.repeat(np.arange(n), per_text), np.arange(n)])
                at, hit = looked_up(word, keys)
                line, places, bounds = positions(buf, offsets)
                key, place = np.unique(runs(line, places), return_inverse=True)
                key_at, key_hit = looked_up(key, run_keys)
                key_log = np.zeros(len(key))
                key_log[key_hit] = run_logs[key_at[key_hit]]
                rest = ~key_hit[place]
                owner = np.repeat(np.arange(n), np.diff(bounds))[rest]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).slice(lo, n),
                        pa.array(per_text + 1),
                        pa.array(np.bincount(text[hit], minlength=n)),
                        pa.array(np.bincount(text[hit], logs[at[hit]], n).astype(np.float64)),
                        pa.array(np.add.reduceat(key_log[place], bounds[:-1])),
                        *own_lists(word[~hit], text[~hit], n),
                        *own_lists(key[place[rest]], owner, n),
                    ],
                    names=[f.split()[0] for f in schema.split(", ")],
                )

    def listed(values: str, times: str) -> DataFrame:
        pairs = scored.select("row", F.explode(F.arrays_zip(F.col(values).alias("key"), F.col(times).alias("times"))).alias("w"))
        return pairs.select("row", "w.key", "w.times")

    scored = materialize(own.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    counted = listed("rare", "times").join(words.withColumnRenamed("n", "c"), "key", "left").select(
        "row", "times", F.coalesce("c", F.lit(0)).alias("c")
    )
    by_row = counted.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_rare"),
        F.sum(F.col("times") * F.log10(F.col("c") + F.lit(SMOOTHING))).alias("rare_log"),
    )
    rare_runs = listed("runs", "run_times").join(scores.select("key", F.col("score").alias("run_log")), "key")
    by_run = rare_runs.groupBy("row").agg(F.sum(F.col("times") * F.col("run_log")).alias("run_log"))
    n_tokens = F.col("n_tokens")
    return (
        scored.drop("rare", "times", "runs", "run_times")
        .join(by_row, "row", "left")
        .join(by_run, "row", "left")
        .select(
            "doc_id",
            held_out(F.col("doc_id"), folds).alias("held_out"),
            n_tokens,
            (F.col("n_common") + F.coalesce("n_rare", F.lit(0))).cast("long").alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("common_log") + F.coalesce("rare_log", F.lit(0.0)) - n_tokens * F.lit(log_all)).alias("base_score"),
            (F.col("score") + F.coalesce("run_log", F.lit(0.0))).alias("score"),
        )
    )
