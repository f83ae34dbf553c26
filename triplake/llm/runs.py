"""Periodic runs of words, found with suffix trees.

A run is a stretch of consecutive words with smallest period q, at least
``max(least, 2 * q)`` words long, that no neighbouring word extends with that
period.  Each document is searched on its own:

1.  A run holds each of its words twice, so a document splits at every word
    that stands alone in its stretch.  The stretches that are left are numbered
    and joined by symbols that occur once; nothing else can be in a run.
2.  Ukkonen's algorithm builds the suffix trees of that sequence and of its
    reversal.  The lowest common ancestor of two leaves is the minimum of an
    Euler tour, looked up in constant time, and its depth is the length of the
    longest common extension of two positions.
3.  Every run has a Lyndon root under one of the two orders of the words, and
    a longest Lyndon word starts at each position under each order (the next
    smaller suffix ends it).  These at most 2n candidates are extended in both
    directions; those that reach twice their length are the runs.

Memory of a task grows with its longest document, time with its words.

Defined results: a null text has no words; a null id is kept and its words are
not rewritten; repeated rows are searched each on its own; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.llm.textbytes import chunks, hash_words, mix64, word_bounds

LEAST_WORDS = 12
BLOCK = 16  # tour entries whose minimum the sparse table holds


# ------------------------------------------------------------- suffix trees


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of symbols from 1 on; the end is
    symbol 0, the least.  Nodes are numbers, 0 is the root."""

    def __init__(self, symbols: list[int]):
        text = [*symbols, 0]
        n, size = len(text), max(text) + 1
        start, end, link = [0], [0], [0]
        child: dict[int, int] = {}
        leaves: list[int] = []
        node = edge = length = remaining = 0
        for i, symbol in enumerate(text):
            remaining += 1
            waiting = 0  # an inner node whose suffix link is not set yet
            while remaining:
                if not length:
                    edge = i
                key = node * size + text[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    leaves.append(len(start))
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if waiting:
                        link[waiting] = node
                        waiting = 0
                else:
                    span = end[below] - start[below]
                    if length >= span:
                        edge += span
                        length -= span
                        node = below
                        continue
                    split_at = start[below] + length
                    if text[split_at] == symbol:
                        if waiting:
                            link[waiting] = node
                        length += 1
                        break
                    middle = len(start)
                    start.append(start[below])
                    end.append(split_at)
                    link.append(0)
                    child[key] = middle
                    child[middle * size + text[split_at]] = below
                    start[below] = split_at
                    child[middle * size + symbol] = middle + 1
                    leaves.append(middle + 1)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if waiting:
                        link[waiting] = middle
                    waiting = middle
                remaining -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - remaining + 1
        self.leaf = np.array(leaves, np.int64)  # of the suffix at each position
        self.width = np.subtract(end, start)
        keys = np.fromiter(child, np.int64, len(child))
        self.above, self.symbol = keys // size, keys % size
        self.below = np.fromiter(child.values(), np.int64, len(child))

    def _children(self, order: np.ndarray) -> tuple[list[int], list[int]]:
        """Children in order, and the place of each node's first one."""
        by = np.lexsort((order, self.above))
        return self.below[by].tolist(), np.searchsorted(self.above[by], np.arange(len(self.width) + 1)).tolist()

    def tour(self) -> np.ndarray:
        """The Euler tour, children by rising symbol."""
        children, first = self._children(self.symbol)
        following = first[:]
        path, out, node = [], [0], 0
        while True:
            k = following[node]
            if k < first[node + 1]:
                following[node] = k + 1
                path.append(node)
                node = children[k]
            elif path:
                node = path.pop()
            else:
                return np.array(out, np.int64)
            out.append(node)

    def ranks(self, falling: bool) -> np.ndarray:
        """Rank of each suffix among all; ``falling`` turns the order of the
        symbols around, but for the end, which stays the least."""
        children, first = self._children(np.where(self.symbol, -self.symbol if falling else self.symbol, np.iinfo(np.int64).min))
        place, pending = np.zeros(len(self.width), np.int64), [0]
        order = []
        while pending:
            node = pending.pop()
            a, b = first[node], first[node + 1]
            if a == b:
                order.append(node)
            else:
                pending += children[a:b][::-1]
        place[order] = np.arange(len(order))
        return place[self.leaf]


class Minima:
    """Minimum of any stretch of an array in constant time: prefix and suffix
    minima of blocks, and a sparse table of the blocks' minima."""

    def __init__(self, values: np.ndarray):
        blocks = -(-len(values) // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(values)] = values
        square = padded.reshape(blocks, BLOCK)
        self.values = padded
        self.prefix = np.minimum.accumulate(square, axis=1).reshape(-1)
        self.suffix = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self.levels = [square.min(axis=1)]
        while 2 << (len(self.levels) - 1) <= blocks:
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minima of the stretches from a to b, both included (a <= b)."""
        block_a, block_b = a // BLOCK, b // BLOCK
        out = np.minimum(self.suffix[a], self.prefix[b])
        far = np.flatnonzero(block_b - block_a > 1)
        if len(far):
            lo, count = block_a[far] + 1, (block_b - block_a)[far] - 1
            level = np.frexp(count.astype(np.float64))[1] - 1
            for k in np.unique(level):
                own = level == k
                at, first, n = far[own], lo[own], count[own]
                table = self.levels[k]
                out[at] = np.minimum(out[at], np.minimum(table[first], table[first + n - (1 << int(k))]))
        same = np.flatnonzero(block_a == block_b)
        if len(same):
            span = a[same, None] + np.arange(BLOCK)
            inside = np.where(span <= b[same, None], self.values[np.minimum(span, len(self.values) - 1)], np.iinfo(np.int32).max)
            out[same] = inside.min(axis=1)
        return out


class Extensions:
    """Longest common extensions of positions of a sequence, by the lowest
    common ancestors of its suffix tree."""

    def __init__(self, tree: SuffixTree):
        tour = tree.tour()
        up = np.zeros(len(tree.width), np.int64)
        up[tree.below] = tree.above
        step = np.where(up[tour[1:]] == tour[:-1], tree.width[tour[1:]], -tree.width[tour[:-1]])
        depth = np.append(0, np.cumsum(step))  # words from the root
        met = np.zeros(len(tree.width), np.int64)
        met[tour] = np.arange(len(tour))
        self.place = met[tree.leaf]
        self.minima = Minima(depth)

    def length(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words from positions i and j (i <> j) on."""
        a, b = self.place[i], self.place[j]
        return self.minima.between(np.minimum(a, b), np.maximum(a, b)).astype(np.int64)


def longest_lyndon(ranks: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word from each position on: it ends where
    the next smaller suffix starts."""
    order = ranks.tolist()
    ends, open_ = [0] * len(order), []
    for i in range(len(order) - 1, -1, -1):
        own = order[i]
        while open_ and order[open_[-1]] > own:
            open_.pop()
        ends[i] = open_[-1] if open_ else len(order)
        open_.append(i)
    return np.array(ends, np.int64) - np.arange(len(order))


def find_runs(symbols: list[int], least: int = LEAST_WORDS) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of symbols from
    1 on, by start, then period."""
    n = len(symbols)
    if n < max(2, least):
        return np.zeros((0, 3), np.int64)
    tree = SuffixTree(symbols)
    ahead = Extensions(tree)
    at = np.arange(n)
    # position n is the end's own suffix, the least of all
    period = np.concatenate([longest_lyndon(tree.ranks(falling))[:n] for falling in (False, True)])
    del tree
    left = np.concatenate([at, at])
    right = left + period
    after = np.zeros(len(left), np.int64)
    inner = right < n  # a root that reaches the end is extended to the left only
    after[inner] = ahead.length(left[inner], right[inner])
    # first drop what cannot reach twice its length even with all words before
    ok = after + left + period >= np.maximum(least, 2 * period)
    left, right, period, after = left[ok], right[ok], period[ok], after[ok]
    if not len(left):
        return np.zeros((0, 3), np.int64)
    back = Extensions(SuffixTree(symbols[::-1]))
    before = np.zeros(len(left), np.int64)
    inner = left > 0
    before[inner] = back.length(n - left[inner], n - right[inner])
    start, length = left - before, before + period + after
    ok = length >= np.maximum(least, 2 * period)
    return np.unique(np.stack([start[ok], length[ok], period[ok]], axis=1), axis=0)


# ------------------------------------------------- stretches that may hold runs


def stretches(words: np.ndarray, text: np.ndarray, least: int) -> np.ndarray:
    """Of word hashes and the texts they are of: a number for each word's
    stretch, -1 for words that are in no run.  A word that occurs once in its
    stretch ends it; rounds go on while they drop an eighth of what is left
    (the trees see to the rest)."""
    out = np.full(len(words), -1, np.int64)
    at, group = np.arange(len(words)), text.astype(np.int64)
    while len(at):
        key = mix64(words[at] ^ mix64(group.astype(np.uint64) + np.uint64(1)))
        by = np.argsort(key)
        same = key[by][1:] == key[by][:-1]
        kept = np.zeros(len(at), bool)
        kept[by[1:][same]] = True
        kept[by[:-1][same]] = True
        size, at, group = len(at), at[kept], group[kept]
        if not len(at):
            break
        new = np.append(True, (at[1:] != at[:-1] + 1) | (group[1:] != group[:-1]))
        group = np.cumsum(new) - 1
        long = np.bincount(group)[group] >= least
        at, group = at[long], group[long]
        if 8 * (size - len(at)) < size:
            break
    out[at] = group
    return out


def document_runs(words: list[bytes], stretch: np.ndarray, least: int) -> np.ndarray:
    """Runs of one document, whose words are numbered by first occurrence."""
    at = np.flatnonzero(stretch >= 0)
    if not len(at):
        return np.zeros((0, 3), np.int64)
    number: dict[bytes, int] = {}
    own = [number.setdefault(words[i], len(number) + 1) for i in at.tolist()]
    cut = np.flatnonzero(np.diff(stretch[at])) + 1  # a new stretch starts here
    symbols = np.insert(np.array(own, np.int64), cut, len(number) + 1 + np.arange(len(cut)))
    places = np.insert(at, cut, -1)
    runs = find_runs(symbols.tolist(), least)
    runs[:, 0] = places[runs[:, 0]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


# ------------------------------------------------------------------ documents


def rewritten(n: int, h: int) -> np.ndarray | None:
    """The original word numbers of a rewritten document; None if it stays."""
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


RUNS_SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def _row(words: list[bytes], runs: np.ndarray) -> tuple:
    if len(runs):
        start, length, period = (int(x) for x in runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]])
        best = (start, length, period, 1000 * length // period)
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
        np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0).tolist()]
    else:
        best = (None, None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
    return len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS, rewrite: bool = True
) -> DataFrame:
    """One row per document: its number of runs, the longest one, and digests
    of all runs and of the text with every run cut down to its first period.

    ``rewrite`` first makes the documents whose CRC-32 of the decimal id is
    divisible by 10 periodic from a word on, as the registered query asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            crcs = b.column(2).to_pylist()
            for lo, _, buf, offsets in chunks(b.column(1)):
                starts, ends, per_text = word_bounds(buf, offsets)
                hashes = hash_words(buf, starts, ends, lower=False)
                bounds = np.append(0, np.cumsum(per_text))
                order = np.arange(len(starts))
                changed = {}
                for i, n in enumerate(per_text.tolist()):
                    if rewrite and crcs[lo + i] is not None and (own := rewritten(n, crcs[lo + i])) is not None:
                        changed[i] = own
                        order[bounds[i] : bounds[i + 1]] = bounds[i] + own
                stretch = stretches(hashes[order], np.repeat(np.arange(len(per_text)), per_text), least)
                for i in range(len(per_text)):
                    words = buf[offsets[i] : offsets[i + 1]].tobytes().split()
                    if i in changed:
                        words = [words[k] for k in changed[i].tolist()]
                    rows.append(_row(words, document_runs(words, stretch[bounds[i] : bounds[i + 1]], least)))
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            names = [f.split()[0] for f in RUNS_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names)

    ident = docs[id_col].cast("long")
    own = docs.select(ident.alias("doc_id"), docs[text_col].alias("text"), F.crc32(ident.cast("string")).alias("crc"))
    return own.mapInArrow(run, RUNS_SCHEMA)
