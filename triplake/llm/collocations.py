"""Phrases whose words occur together more often than apart, by best-first
branch-and-bound growth.

A candidate is a phrase of two to five words that occurs at least ``least``
times; its score is the lowest over its cuts of ``1000 * a * n / (l * r)``.

Bounds.  Let a phrase Q start with the prefix p.  The cut after p has l = f(p)
and r >= f(Q), so Q scores at most ``1000 * n / f(p)``; of all prefixes the
first word has the largest count and the lowest bound.  The last word bounds Q
the same way from the other side.  So whatever grows from a word of count f
scores at most ``floor(1000 * n / f)``, and rare words are the best to grow.

Growth.  The frontier of a language is its words by rising count.  A round
expands the next ones: it counts the pairs that start or end with an expanded
word, then the phrases of three to five words that do and whose known pairs
are all frequent.  Every prefix of a phrase starts, every suffix ends, with an
expanded word if both its ends are expanded, so all counts of its score, and
all one-word extensions that could drop it, have been counted by then.

Bound.  When a language has 2000 surviving phrases of score T or more, words
whose bound is below T are settled; ties with T are expanded.  The next round
expands no further than that.  Without 2000 survivors all words are expanded.

A phrase is dropped if a longer candidate that contains it is as frequent; the
words between the two show that a one-word extension then is as frequent too.

What tasks know about frequent words, expanded words and frequent pairs comes
in bit filters of a fixed size; a false positive costs a count, and exact
joins decide.  Words are compared by 64-bit hashes of language and word,
phrases by the hashes of all their words.

Defined results: a null text has no words, a null language is ``und``; repeated
rows count as often as they occur; ties are ordered by count, then phrase; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triplake.llm.textbytes import LOWER, chunks, hash_words, mix64, string_buffer, word_bounds
from triplake.plans.materialize import materialize

LEAST = 100
TOP = 2000
LONGEST = 5
# Shares of a language's words that the rounds expand, rarest words first,
# unless the bound allows less.
SHARES = (1 / 8, 1.0)
SLICE = 2 << 20  # bytes of text that are counted at a time
FILTER_BITS = 1 << 26  # of every bit filter, at any size of the input
SALTS = 64
_EXACT = "decimal(38,0)"

BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BETWEEN = BREAKS.copy()
BETWEEN[[0x20, 0x09]] = True


# --------------------------------------------------------------- words of texts


class Words:
    """The words of a slice of texts: keys (hash of language and word), and
    whether the next word follows in the same piece."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        self.buf = buf
        self.starts, self.ends, per_text = word_bounds(buf, offsets, BETWEEN)
        self.text = np.repeat(np.arange(len(per_text)), per_text)
        keys = mix64(hash_words(buf, self.starts, self.ends) ^ langs[self.text])
        self.keys = keys + (keys == 0)  # 0 stands for no word
        pieces = np.cumsum(BREAKS[buf], dtype=np.int32)[self.starts] if len(self.starts) else np.zeros(0, np.int32)
        self.joined = (pieces[1:] == pieces[:-1]) & (self.text[1:] == self.text[:-1])

    def spelled(self, at: np.ndarray) -> pa.Array:
        """The words at these numbers, lower-cased."""
        first, size = self.starts[at], (self.ends - self.starts)[at]
        ends = np.cumsum(size)
        take = np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        offsets = np.append(0, ends).astype(np.int32)
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(LOWER[self.buf[take]]))


_lang_codes: dict[str, int] = {}


def _codes(langs: pa.Array) -> np.ndarray:
    """A 64-bit code of each text's language."""
    if len(_lang_codes) > 1 << 16:
        _lang_codes.clear()
    out = []
    for lang in langs.to_pylist():
        if lang not in _lang_codes:
            _lang_codes[lang] = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
        out.append(_lang_codes[lang])
    return np.array(out, np.uint64)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Words]]:
    """Languages and words of slices of (text, lang) batches."""
    for b in batches:
        codes = _codes(b.column(1))
        for lo, hi, buf, offsets in chunks(b.column(0), SLICE):
            yield b.column(1).slice(lo, hi - lo), Words(buf, offsets, codes[lo:hi])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def word_counts(texts: DataFrame, least: int) -> DataFrame:
    """(lang, word, key, f) of all words that occur at least ``least`` times,
    and a row without a word for all words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, words in slices(batches):
            keys, first, n = np.unique(words.keys, return_index=True, return_counts=True)
            coded = langs.dictionary_encode()
            all_words = np.bincount(coded.indices.to_numpy()[words.text], minlength=len(coded.dictionary))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([langs.take(pa.array(words.text[first])), coded.dictionary]),
                    pa.concat_arrays([words.spelled(first), pa.nulls(len(all_words), pa.string())]),
                    pa.concat_arrays([_signed(keys), pa.array(np.zeros(len(all_words), np.int64))]),
                    pa.array(np.concatenate([n, all_words])),
                ],
                names=["lang", "word", "key", "n"],
            )

    counted = texts.mapInArrow(run, "lang string, word string, key long, n long")
    counted = counted.groupBy("lang", "word", "key").agg(F.sum("n").alias("f"))
    return counted.where(F.col("word").isNull() | (F.col("f") >= least))


# ------------------------------------------------------------------ bit filters


class BitFilter:
    """Two bits of a fixed number of bits for each key of a set."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    def has(self, keys: np.ndarray) -> np.ndarray:
        out, low = np.ones(len(keys), bool), np.uint64(64 * len(self.slots) - 1)
        for at in ((keys & low).astype(np.int64), (keys >> np.uint64(32) & low).astype(np.int64)):
            out &= (self.slots[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
        return out


def bit_filter(spark: SparkSession, keys: DataFrame) -> Broadcast[BitFilter]:
    """The filter of the ``key`` column, broadcast.  Bits are joined on the
    executors: at most FILTER_BITS / 64 rows reach the driver."""
    low = F.lit(FILTER_BITS - 1).cast("long")
    bits = F.array(F.col("key").bitwiseAND(low), F.shiftrightunsigned("key", 32).bitwiseAND(low))
    at = keys.select(F.explode(bits).alias("at"))
    slot = at.select(F.shiftright("at", 6).alias("slot"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
    met = slot.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    slots = np.zeros(FILTER_BITS // 64, np.uint64)
    slots[met["slot"].to_numpy()] = met["bits"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(BitFilter(slots))


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One 64-bit key for two words, as ``_pair_key`` has it in Spark."""
    return first * np.uint64(0xD6E8FEB86659FD93) ^ (second + (second >> np.uint64(29)))


# --------------------------------------------------------------------- growth


class Frontier:
    """What a round's tasks know: frequent words, words expanded in this round
    and before, and (for longer phrases) the frequent pairs."""

    def __init__(self, frequent: Broadcast, new: Broadcast, old: Broadcast | None, pairs: Broadcast | None = None):
        self.frequent, self.new, self.old, self.pairs = frequent, new, old, pairs

    def phrases(self, words: Words) -> Iterator[np.ndarray]:
        """Rows of word keys of the phrases to count: pairs, or phrases of
        three to five words once the frequent pairs are known."""
        keys = words.keys
        if len(keys) < 2:
            return
        frequent = self.frequent.value.has(keys)
        new = self.new.value.has(keys) & frequent
        old = self.old.value.has(keys) if self.old else np.zeros(len(keys), bool)
        linked = words.joined & frequent[1:] & frequent[:-1]
        if self.pairs is None:
            sizes = [2]
        else:
            sizes = range(3, LONGEST + 1)
            known = np.flatnonzero(linked & (new | old)[1:] | linked & (new | old)[:-1])
            linked[known] = self.pairs.value.has(mix64(pair_keys(keys[known], keys[known + 1])))
        whole = linked.copy()  # all pairs of the phrase from here on
        for k in range(2, LONGEST + 1):
            if k > 2:
                whole = whole[:-1] & linked[k - 2 :]
            if k in sizes:
                last = slice(k - 1, None)
                ends_new = new[: len(whole)] | new[last]
                ends_old = old[: len(whole)] | old[last]
                at = np.flatnonzero(whole & ends_new & ~ends_old)
                yield np.stack([keys[at + i] if i < k else np.zeros(len(at), np.uint64) for i in range(LONGEST)])


def phrase_counts(texts: DataFrame, frontier: Frontier, least: int) -> DataFrame:
    """(words, f): frequent phrases of a round, as lists of word keys."""
    used = 2 if frontier.pairs is None else LONGEST
    names = [f"w{i}" for i in range(used)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in slices(batches):
            for rows in frontier.phrases(words):
                whole = rows[0]
                for r in rows[1:used]:
                    whole = mix64(whole * np.uint64(0xD6E8FEB86659FD93) + r)
                _, first, n = np.unique(whole, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([*(_signed(r[first]) for r in rows[:used]), pa.array(n)], names=[*names, "n"])

    counted = texts.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "n"]))
    counted = counted.groupBy(*names).agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return counted.select(F.filter(F.array(*names), lambda w: w != 0).alias("words"), "f")


def _pair_filter(spark: SparkSession, pairs: DataFrame) -> Broadcast[BitFilter]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, c = (b.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([_signed(mix64(pair_keys(a, c)))], names=["key"])

    return bit_filter(spark, pairs.select(F.col("words")[0].alias("a"), F.col("words")[1].alias("b")).mapInArrow(run, "key long"))


# -------------------------------------------------------------------- scoring


def _parts(words: str, size: Column) -> list[Column]:
    """A phrase without its last, and without its first word."""
    return [F.slice(words, F.lit(1), size - 1), F.slice(words, F.lit(2), size - 1)]


def surviving(counts: DataFrame, vocabulary: DataFrame, state: DataFrame) -> DataFrame:
    """(lang, words, a, l, r, n, score) of the phrases that survive, of those
    whose first and last word are expanded (count up to the ``cutoff``)."""
    own = vocabulary.join(state.select("lang", "n", "cutoff"), "lang").where("f <= cutoff")
    first = own.select(F.col("key").alias("_first"), "lang", "n")
    last = own.select(F.col("key").alias("_last"))
    size = F.size("words")
    longer = counts.where(size > 2).select("f", F.explode(F.array(*_parts("words", size))).alias("words"))
    whole = counts.join(longer.distinct(), ["words", "f"], "left_anti")
    ended = (
        whole.select("words", F.col("f").alias("a"), F.col("words")[0].alias("_first"), F.element_at("words", -1).alias("_last"))
        .join(first, "_first")
        .join(last, "_last", "left_semi")
    )
    cuts = ended.select("lang", "words", "a", "n", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("words", F.lit(1), F.col("k")).alias("_left"), F.slice("words", F.col("k") + 1, size - F.col("k")).alias("_right"))
    known = counts.unionByName(vocabulary.select(F.array("key").alias("words"), "f"))
    cuts = cuts.join(known.select(F.col("words").alias("_left"), F.col("f").alias("l")), "_left")
    cuts = cuts.join(known.select(F.col("words").alias("_right"), F.col("f").alias("r")), "_right")
    a, n, left, right = (F.col(c).cast(_EXACT) for c in ("a", "n", "l", "r"))
    # f <= n < 2^63 and l * r < 2^126 < 10^38; 1000 * a * n < 10^38 below 10^17 words
    over = (F.lit(1000).cast("decimal(4,0)") * a.cast("decimal(17,0)") * n.cast("decimal(17,0)")).cast(_EXACT)
    under = (left.cast("decimal(19,0)") * right.cast("decimal(19,0)")).cast(_EXACT)
    scored = cuts.select("lang", "words", "a", "n", "k", "l", "r", over.alias("_over"), under.alias("_under"))
    scored = scored.withColumn("score", F.expr("_over div _under"))
    lowest = scored.groupBy("lang", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("_low"))
    return lowest.select("lang", "words", "a", "_low.l", "_low.r", "n", "_low.score")


def first_ranks(df: DataFrame, order: list[Column], top: int) -> DataFrame:
    """The first ``top`` rows of each language with their ``rank``: first of
    each of a fixed number of parts, so that no task ranks a whole language."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64("words"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order)))
    some = some.where(F.col("rank") <= top).drop("_salt", "rank")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top)


def spelled(found: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``found`` with its ``phrase`` in place of the word keys kept beside."""
    placed = found.select("words", F.posexplode("words").alias("_at", "key"))
    texts = placed.join(vocabulary.select("key", "word"), "key").groupBy("words")
    texts = texts.agg(F.array_sort(F.collect_list(F.struct("_at", "word"))).alias("_texts"))
    return found.join(texts.select("words", F.array_join(F.transform("_texts", lambda t: t["word"]), " ").alias("phrase")), "words")


# --------------------------------------------------------------------- rounds


def next_cutoffs(vocabulary: DataFrame, state: DataFrame, share: float) -> DataFrame:
    """``state`` (lang, n, cutoff, settled, threshold) with the cutoffs of the
    next round: counts up to a share of the language's words, but at least one
    more word, and none whose bound is below the threshold."""
    steps = vocabulary.groupBy("lang", "f").agg((F.count(F.lit(1)) * F.col("f")).alias("_words"))
    reached = F.sum("_words").over(Window.partitionBy("lang").orderBy("f"))
    steps = steps.withColumn("_reached", reached).join(state.select("lang", "n", "cutoff"), "lang")
    steps = steps.groupBy("lang").agg(
        F.max(F.when(F.col("_reached") <= F.col("n") * F.lit(share), F.col("f"))).alias("_by_share"),
        F.min(F.when(F.col("f") > F.col("cutoff"), F.col("f"))).alias("_next"),
    )
    bound = F.expr("cast(1000 * cast(n as decimal(19,0)) as decimal(38,0)) div cast(threshold as decimal(38,0))")
    allowed = F.when(F.col("threshold") > 0, bound).otherwise(F.col("n"))
    wanted = F.least(F.greatest("_by_share", "_next"), allowed)
    cutoff = F.when(F.col("settled"), F.col("cutoff")).otherwise(F.greatest("cutoff", F.coalesce(wanted, F.col("cutoff"))))
    return state.join(steps, "lang").select("lang", "n", cutoff.alias("cutoff"), "settled", "threshold")


def settle(found: DataFrame, vocabulary: DataFrame, state: DataFrame, top: int) -> DataFrame:
    """``state`` after a round: the score of the language's last rank, and
    whether a word that is not expanded could still reach it."""
    ranked = first_ranks(found.select("lang", "words", "score"), [F.col("score").desc()], top)
    last = ranked.where(F.col("rank") == top).select("lang", F.col("score").alias("_threshold"))
    rest = vocabulary.join(state.select("lang", "cutoff"), "lang").where("f > cutoff").groupBy("lang").agg(F.min("f").alias("_next"))
    bound = F.expr("cast(1000 * cast(n as decimal(19,0)) as decimal(38,0)) div cast(_next as decimal(38,0))")
    settled = F.col("_next").isNull() | (F.col("_threshold").isNotNull() & (bound < F.col("_threshold")))
    return state.select("lang", "n", "cutoff").join(last, "lang", "left").join(rest, "lang", "left").select(
        "lang", "n", "cutoff", settled.alias("settled"), F.coalesce("_threshold", F.lit(0).cast("long")).alias("threshold")
    )


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, shares: tuple[float, ...] = SHARES) -> DataFrame:
    """Each language's first ``top`` surviving phrases: lang, rank, phrase, a
    (its count), l and r (the counts of the parts of its lowest cut), n (the
    language's words) and score."""
    spark = docs.sparkSession
    texts = docs.select(docs["text"].alias("text"), F.coalesce(docs["lang"], F.lit("und")).alias("lang"))
    counted = materialize(word_counts(texts, least), "words")
    vocabulary = counted.where("word is not null")
    start = counted.where("word is null").select("lang", F.col("f").alias("n"))
    state = start.select("lang", "n", F.lit(0).cast("long").alias("cutoff"), F.lit(False).alias("settled"), F.lit(0).cast("long").alias("threshold"))
    frequent = bit_filter(spark, vocabulary)
    counts: DataFrame | None = None
    old: Broadcast | None = None
    step = 0
    while True:
        before = state
        share = shares[min(step, len(shares) - 1)]
        state = materialize(next_cutoffs(vocabulary, before, share), "cutoffs")
        expanded = vocabulary.join(state.select("lang", "cutoff"), "lang").where("f <= cutoff")
        reached = bit_filter(spark, expanded)
        frontier = Frontier(frequent, reached, old)
        pairs = materialize(phrase_counts(texts, frontier, least), "pairs")
        counts = pairs if counts is None else counts.unionByName(pairs)
        frontier.pairs = _pair_filter(spark, counts.where(F.size("words") == 2))
        counts = counts.unionByName(materialize(phrase_counts(texts, frontier, least), "phrases"))
        frontier.pairs.unpersist()
        if old:
            old.unpersist()
        found = materialize(surviving(counts, vocabulary, state), "survivors")
        state = materialize(settle(found, vocabulary, state, top), "settled")
        if state.where("not settled").isEmpty():
            break
        old, step = reached, step + 1
    best = found.join(state.select("lang", "threshold"), "lang").where("score >= threshold").drop("threshold")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    ranked = first_ranks(spelled(best, vocabulary), order, top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
