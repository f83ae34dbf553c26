"""Benchmark passages in documents, in DataFrame and SQL functions only.

1. Texts are lower-cased and cut into words; every word gets a 64-bit hash.
2. Items are dealt to size classes.  A class has a window of ``w`` words and a
   stride ``s`` fitted to its items: a document window every ``s`` words, an
   item window at every offset.  A run of w + s - 1 common words therefore
   holds a document window that equals an item window.  The class is chosen so
   that every item-sized passage of the similarity asked for has such a run.
3. Each window has a SimHash of its words.  The 64 bits are summed as 8-bit
   fields of eight longs, so that a window costs a few shifts and additions
   per word in generated code.
4. Multi-index Hamming blocks: fingerprints within ``RADIUS`` = 3 bits agree in
   one of four 16-bit blocks at least, so joining on (class, block, value) finds
   all of them; the population count of the XOR decides.
5. A hit aligns document and item.  The item-sized passage there is compared by
   exact weighted-shingle similarity: shingles of five words, weighted by their
   number, sum of minima over sum of maxima.

The item index grows with the benchmark only.  It is broadcast if it has at
most ``BROADCAST_ROWS`` rows, and shuffled otherwise.

Defined results: null, empty and blank texts have no words and match nothing;
a text (item) with fewer words than a shingle has its whole sequence as one;
equal items each get their rows; rows that repeat a doc_id count as one
document; a null doc_id or item_id is reported as null; empty tables give no
rows; other columns are ignored (``matches``) or kept (``drop_contaminated``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.names import fresh_name
from triplake.plans.materialize import materialize

SHINGLE = 5
PERCENT = 80
RADIUS = 3
BLOCKS, BLOCK_BITS = 4, 16
LONGEST_WINDOW = 28  # longer ones would outgrow a compiled method
BROADCAST_ROWS = 2_000_000  # of about 40 bytes

# The lowest bit of every byte, and the seventh.
ONES = 0x0101010101010101
HALVES = 0x4040404040404040


@dataclass(frozen=True)
class SizeClass:
    """Word counts of the items in it, with their window and stride."""

    number: int
    words: tuple[int, ...]
    window: int
    stride: int


def common_run(words: int, k: int = SHINGLE, percent: int = PERCENT) -> int:
    """Words of the longest common run that a passage of as many words has at
    least, if its shingle similarity reaches ``percent``.

    Of the item's n shingles, r runs leave out (r - 1) * (k - 1) at least where
    they meet, and as many of the passage's: parts that change places cost just
    that, other changes inside cost more, and those at the ends none.  So the
    runs hold p * (n + (r - 1) * (k - 1)) shingles at least; a passage cut off by
    the end of its document is covered too.  (An item that repeats runs of
    k - 1 words may have shingles in common without a longer run.)"""
    n = words - k + 1
    if n <= 1:
        return words
    best, cost = words, 0
    for runs in range(1, n + 1):
        common = -(-percent * (n + cost) // 100)
        if common > n - cost:
            break
        best = min(best, -(-common // runs) + k - 1)
        cost += k - 1
    return best


def size_classes(sizes: list[int]) -> list[SizeClass]:
    """Classes for the word counts that occur among the items.  Counts with
    like runs share one; a class fits its shortest run."""
    out: list[SizeClass] = []
    by_run = sorted({(min(common_run(n), 2 * LONGEST_WINDOW), n) for n in sizes if n > 0})
    while by_run:
        least = by_run[0][0]
        own = [n for run, n in by_run if run < 2 * least]
        by_run = [(run, n) for run, n in by_run if run >= 2 * least]
        window = min(LONGEST_WINDOW, max(1, (2 * least + 2) // 3))
        out.append(SizeClass(len(out), tuple(own), window, least - window + 1))
    return out


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text, in lower case and in order."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t-\\r]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def simhash(hashes: Column, at: Column, window: int) -> Column:
    """64-bit majority of the ``window`` word hashes from index ``at`` on.

    Field j of sum k counts bit 8j + k; a field reaches bit 7 (value 64) when
    the bit is set in at least half of the words."""
    words = [F.coalesce(F.get(hashes, at + F.lit(j)), F.lit(0).cast("long")) for j in range(window)]
    lift = F.lit((64 - (window + 1) // 2) * ONES)
    bits = []
    for k in range(8):
        fields = [F.shiftrightunsigned(w, k).bitwiseAND(F.lit(ONES)) for w in words]
        total = reduce(lambda a, b: a + b, fields) + lift
        bits.append(F.shiftleft(F.shiftrightunsigned(total.bitwiseAND(F.lit(HALVES)), 6), k))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def windows(texts: DataFrame, c: SizeClass, stride: int) -> DataFrame:
    """Windows of class ``c`` of ``texts`` (..., hashes), with place ``at`` and
    fingerprint; shorter texts have one window of all their words."""
    last = F.greatest(F.size("hashes") - c.window, F.lit(0))
    # outer: else a filter on the word hashes is inferred, which makes them twice
    placed = texts.withColumn("at", F.explode_outer(F.sequence(F.lit(0), last, F.lit(stride))))
    return placed.withColumn("print", simhash(F.col("hashes"), F.col("at"), c.window))


def block_keys(fingerprint: Column, number: int) -> Column:
    """The four join keys of a fingerprint: class, block number, block."""
    mask = F.lit((1 << BLOCK_BITS) - 1).cast("long")
    return F.array(
        *(
            F.shiftrightunsigned(fingerprint, i * BLOCK_BITS).bitwiseAND(mask) + F.lit((number * BLOCKS + i) << BLOCK_BITS).cast("long")
            for i in range(BLOCKS)
        )
    )


def block_number(key: Column) -> Column:
    return F.shiftrightunsigned(key, BLOCK_BITS) % BLOCKS


def first_equal_block(differ: Column) -> Column:
    """First block without a bit of the XOR ``differ``: of the blocks in which
    a pair agrees, the one that reports it."""
    mask = F.lit((1 << BLOCK_BITS) - 1).cast("long")
    equal = [F.shiftrightunsigned(differ, i * BLOCK_BITS).bitwiseAND(mask) == 0 for i in range(BLOCKS)]
    return F.coalesce(*(F.when(e, F.lit(i).cast("long")) for i, e in enumerate(equal)))


def _shingles(hashes: Column) -> Column:
    """Hashes of the shingles of a run of word hashes, with repetitions."""
    last = F.greatest(F.size(hashes) - SHINGLE, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(hashes, i + 1, SHINGLE)))


def weighted_similarity(pairs: DataFrame, a: str, b: str, keys: list[str]) -> DataFrame:
    """``keys`` and ``percent``: 100 x sum of minima over sum of maxima of the
    shingle counts of the word runs ``a`` and ``b``."""
    side = lambda col, n, m: pairs.select(*keys, F.explode(_shingles(F.col(col))).alias("shingle")).withColumns(
        {"n": F.lit(n), "m": F.lit(m)}
    )
    counts = side(a, 1, 0).unionByName(side(b, 0, 1)).groupBy(*keys, "shingle").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    return counts.groupBy(*keys).agg((100 * F.sum(F.least("n", "m")) / F.sum(F.greatest("n", "m"))).alias("percent"))


def hits(docs: DataFrame, items: DataFrame, classes: list[SizeClass]) -> DataFrame:
    """Aligned passages: doc_id, item, at, passage_id, passage (word hashes), of
    all window pairs whose fingerprints differ in at most ``RADIUS`` bits."""
    index: list[DataFrame] = []
    for c in classes:
        own = items.where(F.size("hashes").isin(*c.words))
        keyed = windows(own, c, 1).select(
            "item",
            F.col("at").alias("item_at"),
            F.col("print").alias("item_print"),
            F.size("hashes").alias("item_size"),
            F.explode(block_keys(F.col("print"), c.number)).alias("key"),
        )
        index.append(keyed)
    # windows that an item repeats would only repeat hits
    table = materialize(reduce(DataFrame.unionByName, index).distinct(), "item-index")
    if table.count() <= BROADCAST_ROWS:
        table = F.broadcast(table)
    found: list[DataFrame] = []
    for c in classes:
        keyed = windows(docs, c, c.stride).withColumn("key", F.explode(block_keys(F.col("print"), c.number)))
        differ = F.col("print").bitwiseXOR(F.col("item_print"))
        near = keyed.join(table, "key").where((F.bit_count(differ) <= RADIUS) & (first_equal_block(differ) == block_number(F.col("key"))))
        begin = F.col("at") - F.col("item_at")
        found.append(
            near.select(
                "doc_id",
                "item",
                begin.alias("at"),
                F.slice("hashes", F.greatest(begin, F.lit(0)) + 1, F.col("item_size") + F.least(begin, F.lit(0))).alias("passage"),
            )
        )
    # several windows of a passage align it alike
    named = reduce(DataFrame.unionByName, found).withColumn(
        "passage_id", F.sha2(F.array_join(F.transform("passage", lambda h: h.cast("string")), " "), 256)
    )
    return named.groupBy("doc_id", "item", "at", "passage_id").agg(F.first("passage").alias("passage"))


def matches(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, item_id, at (first word of the best passage), percent (its
    similarity): one row per document and item that it contains."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), word_hashes(F.col("text")).alias("hashes"))
    items = materialize(items.where(F.size("hashes") > 0).withColumn("item", F.monotonically_increasing_id()), "items")
    # One row per word count that occurs among the items.
    sizes = [r[0] for r in items.select(F.size("hashes")).distinct().collect()]
    if not sizes:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("false").selectExpr(
            "doc_id", "cast(null as bigint) as item_id", "cast(null as int) as at", "cast(null as double) as percent"
        )
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_hashes(F.col("text")).alias("hashes"))
    passages = materialize(hits(hashed, items.select("item", "hashes"), size_classes(sizes)), "hits")
    # Equal passages are compared with an item once, however many documents have them.
    distinct = passages.groupBy("item", "passage_id").agg(F.first("passage").alias("passage"))
    both = distinct.join(items.select("item", "hashes"), "item")
    scored = weighted_similarity(both, "passage", "hashes", ["item", "passage_id"]).where(F.col("percent") >= percent)
    good = passages.select("doc_id", "item", "at", "passage_id").join(scored, ["item", "passage_id"])
    best = good.groupBy("doc_id", "item").agg(F.max(F.struct("percent", (-F.col("at")).alias("back"))).alias("best"))
    return best.join(items.select("item", "item_id"), "item").select(
        "doc_id", "item_id", (-F.col("best.back")).alias("at"), F.col("best.percent").alias("percent")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all columns.
    Rows are told apart by id and text: of several rows of one id, or without
    an id, those go whose own text holds an item."""
    row, name = F.xxhash64(docs["doc_id"], docs["text"]), fresh_name(docs, "bad_row")
    bad = matches(docs.select(row.alias("doc_id"), docs["text"].alias("text")), benchmark, percent)
    return docs.join(bad.select(F.col("doc_id").alias(name)).distinct(), row == F.col(name), "left_anti")
