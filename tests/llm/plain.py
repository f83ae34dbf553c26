"""Plain versions of the operators' contracts, for comparison in tests."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text: str) -> str:
    """A-Z lower-cased, nothing else."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text or ""))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(digits[::-1]):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


PII = {
    "email": (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda s: True),
    "ip": (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda s: all(int(p) <= 255 for p in s.split("."))),
    "card": (re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda s: 13 <= len(re.sub(r"\D", "", s)) <= 19 and luhn(re.sub("[^0-9]", "", s))),
    "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15),
}


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    return [(kind, m.start(), m.end()) for kind, (pattern, good) in PII.items() for m in pattern.finditer(text or "") if good(m.group())]


def base_row(text: str | None) -> tuple:
    found = base_spans(text)
    n = Counter(k for k, _, _ in found)
    return (*(n[k] for k in PII), hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest())


def shingles(text: str | None, k: int) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def components(nodes, links) -> dict:
    """Smallest node that links reach, for each node."""
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def near_links(texts: dict[int, str | None], k: int, percent: int) -> set[tuple[int, int]]:
    sets = {i: shingles(t, k) for i, t in texts.items()}
    by_shingle = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by_shingle[x].append(i)
    common = Counter(p for ids in by_shingle.values() for p in combinations(sorted(ids), 2))
    return {(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)}


def contaminated(text: str | None, item: str | None, k: int = 5, percent: int = 80) -> bool:
    """Whether some item-sized run of words has the shingle similarity."""
    a, b = (text or "").lower(), (item or "").lower()
    a, b = WORD.findall(a), WORD.findall(b)
    if not a or not b:
        return False
    own = Counter(tuple(b[i : i + k]) for i in range(max(1, len(b) - k + 1)))
    if len(b) < k:
        places = range(max(1, len(a) - len(b) + 1))
    else:  # a run that is like the item holds one of its shingles
        common = [i for i in range(len(a) - k + 1) if tuple(a[i : i + k]) in own]
        places = {at for i in common for at in range(max(0, i + k - len(b)), i + 1)}
    for at in places:
        run = a[at : at + len(b)]
        there = Counter(tuple(run[i : i + k]) for i in range(max(1, len(run) - k + 1)))
        if 100 * sum((own & there).values()) >= percent * sum((own | there).values()):
            return True
    return False


def base_scores(docs: list[tuple[int, str | None]], folds: int = 10) -> dict[int, tuple]:
    """held_out, n_tokens, n_known, N, base score of each document."""
    held = {i: zlib.crc32(str(i).encode()) % folds == 0 for i, _ in docs}
    counts = Counter()
    for i, t in docs:
        if not held[i]:
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    out = {}
    for i, t in docs:
        tokens = [*words(t), None]
        score = sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        out[i] = (held[i], len(tokens), sum(counts[w] > 0 for w in tokens), n, score)
    return out


def vector_links(rows: list[tuple[int, object, object]], threshold: float = 0.98) -> set[tuple[int, int]]:
    """Positions of linked rows (vec_id, vector, label)."""
    good = defaultdict(list)
    for at, (_, v, label) in enumerate(rows):
        if v is None or label is None or not len(v) or any(x is None for x in v):
            continue
        v = np.asarray(v, np.float64)
        if np.isfinite(v).all() and v.any():
            good[label, len(v)].append((at, v / np.linalg.norm(v)))
    out = set()
    for own in good.values():
        m = np.stack([v for _, v in own])
        for i, j in zip(*np.nonzero(np.triu(m @ m.T >= threshold, 1))):
            out.add((own[i][0], own[j][0]))
    return out


def jump(key: int, shards: int) -> int:
    """Jump consistent hash as published."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def kt_weighting(texts: list[bytes], depth: int):
    """Context-tree weighting by its definition, without pruning: returns a
    function of (context bytes, byte) that gives the byte's probability after
    training on the texts."""
    counts = defaultdict(lambda: [0, 0])

    def bits(byte):
        node = 1
        for level in range(8):
            bit = byte >> (7 - level) & 1
            yield node, bit
            node = node << 1 | bit

    for t in texts:
        line = bytes(depth) + t + b"\0"
        for i in range(depth, len(line)):
            for node, bit in bits(line[i]):
                for d in range(depth + 1):
                    counts[line[i - d : i], node][bit] += 1
    children = defaultdict(set)
    for context, node in list(counts):
        if context:
            children[context[1:], node].add(context)

    def log_kt(a, b):
        p = 0.0
        for k in range(a):
            p += np.log((k + 0.5) / (k + 1))
        for k in range(b):
            p += np.log((k + 0.5) / (a + k + 1))
        return p

    memo = {}

    def weighted(context, node):
        if (context, node) not in memo:
            own = log_kt(*counts[context, node])
            if len(context) == depth:
                memo[context, node] = own
            else:
                below = sum(weighted(c, node) for c in children[context, node])
                memo[context, node] = np.logaddexp(own, below) - np.log(2)
        return memo[context, node]

    def p_one(context, node, full):
        if (context, node) not in counts:
            return 0.5
        a, b = counts[context, node]
        kt = (b + 0.5) / (a + b + 1)
        if len(context) == depth:
            return kt
        below = sum(weighted(c, node) for c in children[context, node])
        beta = np.exp(log_kt(a, b) - below)
        longer = full[len(full) - len(context) - 1 :]
        return (beta * kt + p_one(longer, node, full)) / (beta + 1)

    def probability(context, byte):
        p = 1.0
        for node, bit in bits(byte):
            one = p_one(b"", node, context)
            p *= one if bit else 1 - one
        return p

    return probability
