"""Word hashing on UTF-8 buffers with numpy, shared by the text operators.

A word is a maximal run of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return (``[^\\x20\\x09-\\x0D]+``).  Work goes over
Arrow string buffers in slices of about ``CHUNK`` bytes, so the memory of a
task depends on the slice and on its longest single text, not on the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def _random_words(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, dtype=np.uint64)


_BYTE_CODES = _random_words(256, 11)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown by doubling."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK, 2 * (0 if have is None else len(have))), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[name] = np.multiply.accumulate(steps)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (xor-shift-multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices (first row, end row, bytes, offsets from 0) of about ``limit``
    bytes; a longer single text is a slice of its own."""
    if len(column) == 0:
        return
    data, offsets = string_buffer(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        own = offsets[lo : hi + 1]
        yield lo, hi, data[own[0] : own[-1]], own - own[0]
        lo = hi


def word_bounds(buf: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words per text.
    Words never span texts; ``space`` marks the bytes between words."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    solid = ~space[buf]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = solid[:-1]
    inner = offsets[1:-1]
    before[inner[inner < n]] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    after[inner[inner > 0] - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    per_text = np.diff(np.searchsorted(starts, offsets, side="left"))
    return starts, ends, per_text


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word's bytes (A-Z lower-cased unless ``lower`` is
    off): a polynomial over random byte codes, finalized with the length."""
    codes = _BYTE_CODES[LOWER] if lower else _BYTE_CODES
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + CHUNK, side="right")))
        base = starts[lo]
        part = buf[base : ends[hi - 1]]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(codes[part] * _power("up", _BASE, len(part)), out=total[1:])
        a, b = starts[lo:hi] - base, ends[lo:hi] - base
        out[lo:hi] = (total[b] - total[a]) * _power("down", _BASE_INVERSE, len(part))[a] + (b - a).astype(np.uint64)
        lo = hi
    return mix64(out)


def shingle_hashes(words: np.ndarray, per_text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``k`` consecutive words of each text, in order,
    and their number per text.  A text of 1 to k-1 words has one shingle, the
    whole sequence; a text without words has none."""
    firsts = np.concatenate([[0], np.cumsum(per_text)[:-1]]).astype(np.int64)
    counts = np.where(per_text >= k, per_text - k + 1, (per_text > 0).astype(np.int64))
    total = int(counts.sum())
    text = np.repeat(np.arange(len(per_text)), counts)
    position = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    at = firsts[text] + position
    last = (firsts + per_text)[text]
    out = np.zeros(total, np.uint64)
    short = bool((per_text[text] < k).any()) if total else False
    for j in range(k):
        if short:
            inside = at + j < last
            word = np.where(inside, words[np.minimum(at + j, len(words) - 1)], np.uint64(0x5851F42D4C957F2D))
        else:
            word = words[at + j]
        out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + word)
    return out, counts
