"""Phrase collocations, best-two-fit packing and periodic runs."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tests.llm import plain
from triplake.llm import best_fit, collocations, runs, tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ------------------------------------------------------------- collocations


def plain_collocations(rows, least, top):
    """All phrases of all pieces, counted and compared."""
    total, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", plain.lower(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            f.update((lang, tuple(w[i : i + m])) for m in range(1, 6) for i in range(len(w) - m + 1))
    frequent = {k: a for k, a in f.items() if a >= least}
    dropped = set()
    for (lang, g), a in frequent.items():
        for m in range(2, len(g)):
            for i in range(len(g) - m + 1):
                if frequent[lang, g[i : i + m]] == a:
                    dropped.add((lang, g[i : i + m]))
    by_lang = defaultdict(list)
    for (lang, g), a in frequent.items():
        if len(g) > 1 and (lang, g) not in dropped:
            n = total[lang]
            score, _, left, right = min(
                (1000 * a * n // (f[lang, g[:k]] * f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g))
            )
            by_lang[lang].append((-score, -a, " ".join(g).encode(), left, right, n))
    out = set()
    for lang, found in by_lang.items():
        for rank, (score, a, phrase, left, right, n) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def found_collocations(spark, rows, least, top, **options):
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    got = [tuple(r) for r in collocations.collocations(docs, least, top, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_collocations_equal_brute_force(spark):
    rng = random.Random(5)
    names = [f"w{i}" for i in range(60)]
    fixed = [" ".join(rng.choices(names, k=7)) for _ in range(6)]
    rows = []
    for i in range(300):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else names[min(59, int(rng.expovariate(0.1)))] for _ in range(rng.randint(0, 40))]
        text = "".join(p + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", ": "]) for p in parts)
        rows.append((text.title() if i % 3 else text, rng.choice(["en", "en", "de", None, "und"])))
    for least, top in ((3, 10), (8, 100_000)):
        want = plain_collocations(rows, least, top)
        assert want and found_collocations(spark, rows, least, top) == want
    # frontiers that are expanded in many small rounds give the same phrases
    assert found_collocations(spark, rows, 8, 25, shares=(0.0, 0.02, 0.2, 1.0)) == plain_collocations(rows, 8, 25)


def test_collocations_skip_words_that_cannot_reach_the_last_rank(spark):
    rare = [f"left{i % 10} right{i % 10}" for i in range(400)]
    common = ["the of the of the of a"] * 500
    rows = [(t, "en") for t in rare + common]
    texts = spark.createDataFrame(rows, "text string, lang string")
    counted = collocations.word_counts(texts, 5).cache()
    state = counted.where("word is null").selectExpr("lang", "f as n", "0L as cutoff", "false as settled", "0L as threshold")
    vocabulary = counted.where("word is not null")
    state = collocations.next_cutoffs(vocabulary, state, 0.25)
    assert state.first()["cutoff"] == 40  # left*, right*
    frequent = collocations.bit_filter(spark, vocabulary)
    new = collocations.bit_filter(spark, vocabulary.where("f <= 40"))
    pairs = collocations.phrase_counts(texts, collocations.Frontier(frequent, new, None), 5)
    found = collocations.surviving(pairs, vocabulary, state)
    assert found.count() == 10
    assert not collocations.settle(found, vocabulary, state, 11).first()["settled"]
    done = collocations.settle(found, vocabulary, state, 10).first()
    assert done["settled"] and done["threshold"] == found.first()["score"]


def test_collocations_do_not_depend_on_the_filters(spark, monkeypatch):
    """Full filters let everything pass: more is counted, nothing changes."""
    rng = random.Random(7)
    rows = [(" ".join(rng.choices([f"w{i}" for i in range(25)], k=30)), "en") for _ in range(60)]
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 6)
    assert found_collocations(spark, rows, 4, 30, shares=(0.1, 1.0)) == plain_collocations(rows, 4, 30)


def test_collocations_of_odd_rows(spark):
    assert found_collocations(spark, [], 2, 5) == set()
    assert found_collocations(spark, [(None, None), ("", "en"), (" .,;\n\t", "en")], 2, 5) == set()
    long = "x y " * 50_000
    for rows in ([(long, "en"), (None, "en")], [("É é É é. É", None)] * 3, [("a b c", "en")] * 4, [("a", "en"), ("b", "en")] * 5):
        assert found_collocations(spark, rows, 2, 50) == plain_collocations(rows, 2, 50)
    docs = spark.createDataFrame([(1, "a b", "en", 5, "x", 2, 3)] * 3, "doc_id long, text string, lang string, rank int, words string, n int, cutoff int")
    assert [r["phrase"] for r in collocations.collocations(docs, 2, 5).collect()] == ["a b"]


def test_collocations_of_many_words_stay_exact(spark):
    """1000 * a * n and l * r beyond 64 bits."""
    big = 10**15
    counts = spark.createDataFrame([([1, 2], big)], "words array<long>, f long")
    vocabulary = spark.createDataFrame([("en", "a", 1, big + 1), ("en", "b", 2, big + 2)], "lang string, word string, key long, f long")
    n = 10**16 + 7
    state = spark.createDataFrame([("en", n, n, False, 0)], "lang string, n long, cutoff long, settled boolean, threshold long")
    assert collocations.surviving(counts, vocabulary, state).first()["score"] == 1000 * big * n // ((big + 1) * (big + 2))


# ----------------------------------------------------------------- best fit


def byte_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path(best_fit.BYTE_BPE))


def check_packing(spark, rows, window=best_fit.WINDOW):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = best_fit.pack(docs, window=window).collect()
    t = byte_tokenizer()
    want = Counter()
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % window or window
        bounds = [0, *range(min(first, len(ids)), len(ids) + 1, window)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
            want[i, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences), sum(r.length for r in got)


def test_best_fit_packs_whole_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    sequences, total = check_packing(spark, rows)
    assert sequences <= -(-total // 2048) + 2
    check_packing(spark, rows, window=64)


def test_best_fit_of_odd_rows(spark):
    odd = [(None, "no id"), (1, None), (2, ""), (3, "<|endoftext|> special <|endoftext|>"), (4, "word " * 30_000), (4, "word " * 30_000), (5, "\n\t \x00 日本 é")]
    odd += [(10 + i, "copy of one text") for i in range(400)]
    check_packing(spark, odd)
    docs = spark.createDataFrame([(1, "a", 7, "x", 3)], "doc_id long, text string, slice int, length string, number int")
    assert best_fit.pack(docs).count() == 1
    assert best_fit.pack(docs.limit(0)).collect() == []


def test_plan_chooses_what_filling_one_by_one_chooses():
    rng = np.random.default_rng(2)
    for _ in range(150):
        window = int(rng.choice([8, 16, 50]))
        counts = np.bincount(rng.integers(1, window + 1, rng.integers(0, 80)), minlength=window + 1)
        stock, one_by_one = best_fit.Stock(counts), []
        while stock.counts.any():
            one_by_one.append(best_fit.fill(stock, window))
        chosen = list(best_fit.plan(counts, window))
        assert [sizes for sizes, times in chosen for _ in range(times)] == one_by_one
        assert all(sum(sizes) <= window for sizes in one_by_one)
        assert Counter(s for sizes in one_by_one for s in sizes) == Counter(np.repeat(np.arange(window + 1), counts).tolist())


def test_two_documents_replace_the_smallest():
    counts = np.bincount([60, 30, 22, 17], minlength=101)  # 60 + 30, gap 10: 22 + 17 fits 40 better than 30
    assert best_fit.fill(best_fit.Stock(counts), 100) == [60, 22, 17]
    counts = np.bincount([60, 40, 22, 18], minlength=101)
    assert best_fit.fill(best_fit.Stock(counts), 100) == [60, 40]
    stock = best_fit.Stock(np.bincount([5, 5, 3], minlength=20))
    assert stock.best_two(10) == (5, 5) and stock.best_two(9) == (5, 3) and stock.best_two(7) == (0, 0)


def test_plan_stays_small_for_any_number_of_documents():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 10**9, 2049)
    counts[0] = 0
    chosen = list(best_fit.plan(counts, 2048))
    assert len(chosen) < 5000 and len(best_fit.places(chosen)) < 20_000
    assert sum(times for _, times in chosen) < 1.01 * (counts * np.arange(2049)).sum() / 2048


# --------------------------------------------------------------------- runs


def plain_runs(w, least=12):
    """All maximal stretches of every period, those of a smaller period out."""
    found = set()
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q) and not any(
                w[start : i + q - p] == w[start + p : i + q] for p in range(1, q)
            ):
                found.add((start, i + q - start, q))
            i = max(i, start) + (i == start)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_run_row(doc_id, text, rewrite=True):
    w = plain.WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(w)
    if rewrite and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = plain_runs(w)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    out = {i for s, size, q in found for i in range(s + q, s + size)}
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in out)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    return (doc_id, len(found), *(best if best else (None,) * 3), 1000 * best[1] // best[2] if best else None, *digests)


def run_rows(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return Counter(tuple(r) for r in runs.periodic_runs(docs, **options).collect())


def test_runs_of_sequences_equal_brute_force():
    rng = random.Random(11)
    for _ in range(600):
        w = [rng.randint(1, rng.choice([1, 2, 2, 3, 4])) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5 and len(w) > 6:
            p, a = rng.randint(1, len(w) // 3), rng.randint(0, len(w) // 3)
            for i in range(a, min(len(w), a + p * rng.randint(2, 4))):
                w[i] = w[a + (i - a) % p]
        for least in (2, 12):
            assert [tuple(r) for r in runs.find_runs(w, least).tolist()] == plain_runs(w, least), w
        words = [b"%d" % x for x in w]
        stretch = runs.stretches(np.array(w, np.uint64), np.zeros(len(w), np.int64), 12)
        assert [tuple(r) for r in runs.document_runs(words, stretch, 12).tolist()] == plain_runs(w), w


def test_common_extensions_of_suffix_trees():
    rng = random.Random(13)
    w = [rng.randint(1, 3) for _ in range(300)]
    ahead = runs.Extensions(runs.SuffixTree(w))
    pairs = [(i, j) for i in range(0, 300, 7) for j in range(300) if i != j]
    got = ahead.length(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    for (i, j), n in zip(pairs, got.tolist()):
        assert w[i : i + n] == w[j : j + n] and (max(i, j) + n == 300 or w[i + n] != w[j + n])


def test_runs_of_documents_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect() if len(r.text or "") < 5000]
    rng = random.Random(17)
    for i in range(300):
        base = [rng.choice(["la", "li", "La", "é", "x."]) for _ in range(rng.randint(0, 50))]
        rows.append((10_000 + i, rng.choice([" ", "\n", " \t"]).join(base * rng.randint(1, 3))))
    want = Counter(plain_run_row(i, t) for i, t in rows)
    assert run_rows(spark, rows) == want and sum(n for r, n in want.items() if r[1]) > 50
    assert run_rows(spark, rows, rewrite=False) == Counter(plain_run_row(i, t, False) for i, t in rows)


def test_runs_of_odd_rows(spark):
    assert run_rows(spark, []) == {}
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a " * 20), (4, "a " * 11), (5, "a " * 12), (5, "a " * 12), (6, "  x\x1cy " * 15)]
    assert run_rows(spark, rows) == Counter(plain_run_row(i, t) for i, t in rows)
    words = [f"w{i % 997}" for i in range(60_000)]
    (got,) = run_rows(spark, [(1, " ".join(words))], rewrite=False)
    assert got[1:6] == (1, 0, 60_000, 997, 1000 * 60_000 // 997)
    docs = spark.createDataFrame([("x", 1, "b " * 12, 3, "y")], "start string, doc_id long, text string, length int, crc string")
    assert runs.periodic_runs(docs, rewrite=False).first()["length"] == 12
