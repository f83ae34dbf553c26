"""PII, near-dedup, decontamination, quality and LM scoring."""

import functools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF_SMALL
from tests.llm import plain
from triplake.llm import ctw, decontaminate, near_dedup, pii, quality, textbytes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def small(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


# ---------------------------------------------------------------- words


def test_words_and_hashes():
    texts = ["Ab c\x0b d", "", "  ", "x", None, "é ÀB\n\ttail ", "a" * 3_000_000 + " b"]
    buf, offsets = textbytes.string_buffer(pa.array(texts))
    starts, ends, per_text = textbytes.word_bounds(buf[offsets[0] : offsets[-1]], offsets - offsets[0])
    own = [bytes(buf[a:b]).decode() for a, b in zip(starts, ends)]
    assert [plain.lower(w) for w in own] == [w for t in texts for w in plain.words(t)]
    assert per_text.tolist() == [len(plain.words(t)) for t in texts]
    hashes = textbytes.hash_words(buf, starts, ends)
    again = textbytes.hash_words(np.frombuffer(b"ab", np.uint8), np.array([0]), np.array([2]))
    assert hashes[0] == again[0] and len(set(hashes.tolist())) == len(hashes)


def test_shingles_of_short_texts():
    column = pa.array(["a b c d", "a b", "", "c d a b"])
    (_, _, buf, offsets), = textbytes.chunks(column)
    starts, ends, per_text = textbytes.word_bounds(buf, offsets)
    shingles, counts = textbytes.shingle_hashes(textbytes.hash_words(buf, starts, ends), per_text, 3)
    assert counts.tolist() == [2, 1, 0, 2]
    assert len(set(shingles.tolist())) == 5


# ---------------------------------------------------------------- PII

TRICKY = [
    "a@b.c@d.e x@y.z-", "..@a.b a@b a@.b a@b..c me+x@A-1.co.uk.", "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 01.002.3.0004",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 0000000000000 1-2-3", "+1 (743) 555-3824 +12 +1 2345678 +123456789012345678 ++49-30.123456 7.",
    "12.34 56-78.9.1.2 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "é@b.c ü1.2.3.4é +49 30 1234567é", "٣.١.٢.٤ +٣٤٥٦٧٨٩٠١", "",
]


def test_base_spans_follow_the_patterns():
    rng = random.Random(5)
    alphabet = "a1 .-+@()9é0\n4,"
    texts = TRICKY + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(4000)]
    for t in texts:
        own = [s for s in pii.spans(t) if s[0] in pii.BASE_KINDS]
        assert own == sorted(plain.base_spans(t), key=lambda s: (pii.KINDS.index(s[0]), s[1])), t


def test_added_kinds_and_masking():
    text = 'see https://a.example/x?y=1. IBAN: DE89 3704 0044 0532 0130 00, SSN 123-45-6789 token = "f33e61083db5dbdf4bd2" at 12 Long Oak Street now'
    found = pii.spans(text)
    by_kind = {k: text[a:b] for k, a, b in found}
    assert by_kind["url"] == "https://a.example/x?y=1"
    assert by_kind["secret"] == "f33e61083db5dbdf4bd2"
    assert by_kind["address"] == "12 Long Oak Street"
    assert {text[a:b] for k, a, b in found if k == "account"} == {"DE89 3704 0044 0532 0130 00", "123-45-6789"}
    masked = pii.masked(text, found)
    assert "123-45" not in masked and "<ACCOUNT>" in masked and masked.endswith("<ADDRESS> now")
    assert not pii.spans("SSN 000-12-3456 IBAN DE00 3704 0044 accounting 5 street")


def test_pii_rows(spark):
    rows = [(1, TRICKY[0]), (1, TRICKY[0]), (2, None), (None, "x " * 100_000 + " a@b.co"), (4, "")]
    docs = documents(spark, rows).withColumnRenamed("lang", "n_email")
    got = sorted((r.doc_id or -1, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.find(docs).collect())
    assert got == sorted((i or -1, *plain.base_row(t)) for i, t in rows)
    assert pii.find(docs.limit(0)).count() == 0
    masked = {r.doc_id: r for r in pii.mask(documents(spark, rows)).collect()}
    assert masked[2].text is None and masked[2].n_chars == 0
    assert masked[None].text.endswith(" <EMAIL>") and masked[None].n_chars == len(masked[None].text)


# ---------------------------------------------------------------- near-dedup


def near_copies(rng):
    """Families of near copies, chains, copies, short and blank texts."""
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randrange(20, 200))] for _ in range(25)]
    rows, i = [], 0
    for w in base:
        for _ in range(rng.randrange(1, 12)):
            v = list(w)
            for _ in range(rng.randrange(0, max(2, len(w) // 25))):
                v[rng.randrange(len(v))] = rng.choice(vocabulary)
            rows.append((i, " ".join(v)))
            i += 1
    chain = [rng.choice(vocabulary) for _ in range(120)]
    for _ in range(15):  # neighbours are alike, the ends are not
        rows.append((i, "\n".join(chain)))
        chain = chain[3:] + [rng.choice(vocabulary) for _ in range(3)]
        i += 1
    rows += [(i, ""), (i + 1, None), (i + 2, " \t"), (i + 3, "one two"), (i + 4, "ONE two"), (i + 5, "two one"), (i + 6, rows[0][1].upper())]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,percent,seed", [(3, 85, 1), (5, 80, 2)])
def test_near_duplicates_against_all_pairs(spark, k, percent, seed):
    rows = near_copies(random.Random(seed))
    links = plain.near_links(dict(rows), k, percent)
    want = plain.components([i for i, _ in rows], links)
    got = {r.doc_id: r for r in near_dedup.near_duplicates(documents(spark, rows), k, percent).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) and r.n_shingles == len(plain.shingles(dict(rows)[i], k)) for i, r in got.items())
    assert len(set(want.values())) < len(want)


def test_links_without_the_pivot_are_found(spark):
    """A bucket whose pivot is like neither of two members that are alike."""
    rng = random.Random(9)
    w = [f"v{i}" for i in range(300)]
    rng.shuffle(w)
    far, a = w[:130], w[20:150]
    rows = [(0, " ".join(far)), (1, " ".join(a)), (2, " ".join([*a[:-1], "new"]))]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(documents(spark, rows)).collect()}
    assert got == plain.components(range(3), plain.near_links(dict(rows), 3, 85)) and got[2] == 1


def test_near_duplicates_small_tables(spark):
    rows = small(spark)
    want = plain.components([i for i, _ in rows], plain.near_links(dict(rows), 3, 85))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()} == want


def test_near_duplicates_odd_rows(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (3, "a b c d"), (None, "a b c d"), (None, "q r s t"), (7, None)]
    docs = documents(spark, rows).withColumnRenamed("lang", "component_id").withColumnRenamed("source", "bands")
    got = sorted(((r.doc_id or -1, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(-1, 3, True), (-1, None, True), (3, 3, True), (5, 3, False), (5, 3, False), (7, 7, True)], key=str)
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 3, 7]


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(3)
    for similarity in (0.9, 0.7):
        errors = []
        for _ in range(40):
            n = 2000
            same = int(2 * n * similarity / (1 + similarity))
            pool = rng.integers(0, 1 << 63, 2 * n - same, dtype=np.uint64)
            a, b = pool[:n], np.concatenate([pool[:same], pool[n:]])
            s = near_dedup.odd_sketch(near_dedup.minhash(np.concatenate([a, b]), np.array([n, n])))
            odd = int(near_dedup.odd_bits(s[:1], s[1])[0])
            errors.append(odd - near_dedup.most_odd_bits(similarity))
        assert abs(np.mean(errors)) < 6
        assert max(errors) < near_dedup.most_odd_bits(similarity - near_dedup.SLACK) - near_dedup.most_odd_bits(similarity)


def test_sketches_miss_less_than_the_bands():
    """Exact law of the odd bits: each sample that differs flips two of them."""
    samples, bits = near_dedup.BANDS * near_dedup.ROWS, 64 * near_dedup.SKETCH_LONGS
    odd = np.arange(bits + 1)
    law = [np.eye(1, bits + 1)[0]]
    for _ in range(2 * samples):
        law.append(np.roll(law[-1] * (1 - odd / bits), 1) + np.roll(law[-1] * odd / bits, -1))
    for similarity in (0.85, 0.8):
        differ = [math.comb(samples, i) * (1 - similarity) ** i * similarity ** (samples - i) for i in range(samples + 1)]
        beyond = near_dedup.most_odd_bits(similarity - near_dedup.SLACK) + 1
        lost = sum(p * law[2 * i][beyond:].sum() for i, p in enumerate(differ))
        assert lost < 0.1 * (1 - similarity**near_dedup.ROWS) ** near_dedup.BANDS


# ---------------------------------------------------------------- decontamination


def test_common_run_holds_for_every_change():
    """Any replacement that keeps the similarity leaves the promised run."""
    for n in range(1, 64):
        item = list(range(n))
        for size in range(1, n + 1):
            for at in range(n - size + 1):
                other = item[:at] + [-1] * size + item[at + size :]
                if plain.contaminated(" ".join(map(str, other)), " ".join(map(str, item))):
                    assert max(at, n - at - size) >= decontaminate.common_run(n)


def longest_common_run(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0] + [row[j] + 1 if x == y else 0 for j, y in enumerate(b)]
        best = max(best, *row)
    return best


def test_common_run_holds_for_other_edits():
    """Exchanged parts, insertions, deletions and scattered edits."""
    rng = random.Random(6)
    for n in range(1, 91):
        item = list(range(n))
        others = [item[cut:] + item[:cut] for cut in range(n)]
        others += [(item[:at] + [-1] * size + item[at:])[:n] for at in range(n) for size in (1, 3)]
        others += [item[:at] + item[at + 2 :] + [-1, -2] for at in range(n)]
        for _ in range(60):
            other = list(item)
            for _ in range(rng.randrange(1, 4)):
                at = rng.randrange(n)
                if rng.random() < 0.5:
                    other[at] = -1 - rng.randrange(9)
                else:
                    a, b, c = sorted(rng.randrange(n + 1) for _ in range(3))
                    other = other[:a] + other[b:c] + other[a:b] + other[c:]
            others.append(other)
        for other in others:
            if plain.contaminated(" ".join(map(str, other)), " ".join(map(str, item))):
                assert longest_common_run(item, other) >= decontaminate.common_run(n)


def test_matches_against_all_windows(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(draw(n))) for i, n in enumerate([3, 5, 6, 9, 14, 20, 27, 31, 40, 49, 59, 90, 200])]
    items += [(100, items[6][1]), (101, None), (102, " ")]
    docs = [(0, None), (1, ""), (2, " \n"), (3, items[0][1]), (4, " ".join(draw(20_000)))]
    for _ in range(60):
        passages = [w.split() for _, w in rng.sample(items[:13], 2)]
        for p in passages:
            for _ in range(rng.choice([0, 0, 1, 2])):
                p[rng.randrange(len(p))] = rng.choice(vocabulary)
            del p[: rng.choice([0, 0, 1])]
        docs.append((len(docs), " ".join([*draw(rng.randrange(60)), *passages[0], *draw(rng.randrange(30)), *passages[1], *draw(rng.randrange(40))])))
    docs.append((len(docs), f"X {items[8][1].upper()}\t{items[8][1]}"))
    want = {(d, i) for d, t in docs for i, w in items if plain.contaminated(t, w)}
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = documents(spark, docs).withColumnRenamed("lang", "item")
    got = decontaminate.matches(frame, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) > 50
    clean = decontaminate.drop_contaminated(frame, benchmark)
    assert clean.columns == frame.columns and {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert decontaminate.matches(frame, benchmark.limit(0)).count() == 0 == decontaminate.matches(frame.limit(0), benchmark).count()


def test_matches_without_broadcast(spark, monkeypatch):
    items = [(1, " ".join(f"a{i}" for i in range(30)))]
    docs = documents(spark, [(1, "x y " + items[0][1]), (2, "x y z"), (None, items[0][1])])
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    got = decontaminate.matches(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.item_id, r.at, r.percent) for r in got) == [(-1, 1, 0, 100.0), (1, 1, 2, 100.0)]


def test_simhash_is_the_majority_of_bits(spark):
    rng = np.random.default_rng(0)
    hashes = rng.integers(-(1 << 63), (1 << 63) - 1, 40).tolist()
    frame = spark.createDataFrame([(hashes,)], "hashes array<long>")
    c = decontaminate.SizeClass(0, (18,), 18, 7)
    for r in decontaminate.windows(frame, c, 7).collect():
        bits = [sum((h & (1 << 64) - 1) >> b & 1 for h in hashes[r.at : r.at + 18]) >= 9 for b in range(64)]
        assert r.print & (1 << 64) - 1 == sum(1 << b for b in range(64) if bits[b])


# ---------------------------------------------------------------- quality


def test_quality_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    scored = {r.doc_id: r for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    own = [(scored[r.doc_id], r.quality) for r in labels.collect()]
    assert len(scored) == docs.count()
    assert all(s.held_out == (zlib.crc32(str(s.doc_id).encode()) % 5 == 0) and s.predicted == (s.score >= 0.3) for s, _ in own)
    held = [(s.predicted, q) for s, q in own if s.held_out]
    assert np.mean([p == q for p, q in held]) > 0.95
    assert np.mean([p for p, q in held if q == 1]) > 0.98


def test_quality_uses_text_and_training_labels_only(spark):
    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) as quality", "toxic")
    a, b = quality.fit(docs, labels), quality.fit(docs.selectExpr("doc_id", "text", "'x' as lang", "'y' as source"), flipped)
    assert a.bias == b.bias and (a.weights == b.weights).all()


def test_quality_odd_rows(spark):
    rows = [(i, "GOOD words here " * 3 if i % 2 else "!!! ??? $$$ " * 3) for i in range(60)] + [(60, None), (61, ""), (None, "x")]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(61, None, 0), (None, 1, 0), (60, 7, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    assert got[60].score == got[61].score and 0 < got[60].score < 1 and got[None].held_out is False
    assert all(got[i].score > 0.5 if i % 2 else got[i].score < 0.5 for i in range(60))
    assert quality.fit(docs, labels.limit(0)).scores(pa.array(["x", None])).tolist() == [0.5, 0.5]
    assert quality.fit(docs, labels.where("quality = 1")).scores(pa.array(["x"]))[0] > 0.99
    assert quality.score(docs.limit(0), model).count() == 0
    kept = quality.keep_good(docs, model)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} >= {i for i in range(60) if i % 2}


# ---------------------------------------------------------------- LM scoring


def test_base_scores(spark, monkeypatch):
    monkeypatch.setattr(ctw, "COMMON_WORDS", 64)  # most words take the shuffled way
    rows = small(spark) + [(10_001, None), (10_002, " "), (10_003, "zzz unknown"), (10_004, "")]
    want = plain.base_scores(rows)
    got = {r.doc_id: r for r in ctw.score_documents(documents(spark, rows)).collect()}
    assert got.keys() == want.keys()
    for i, (held, n, known, total, score) in want.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(score, rel=1e-9)
        assert r.score < 0 and np.isfinite(r.score)


def test_rare_contexts_count(spark, monkeypatch):
    """A source with a small share of the bytes keeps its contexts."""
    monkeypatch.setattr(ctw, "COMMON_RUNS", 1 << 9)  # most runs take the shuffled way
    rows = [(i, "ab" * 300) for i in range(1, 40)] + [(60, "the zebra and a quagga"), (61, "the zebra")]
    rows += [(i, "a zebra é quagga") for i in range(100, 140) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += [(200, None), (201, ""), (201, "zebra"), (None, "ab\0ab")]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    learned = [(t or "").encode() for i, t in rows if not held[i]]
    want = functools.cache(plain.kt_weighting(learned, ctw.DEPTH))
    got = ctw.score_documents(documents(spark, rows)).select("doc_id", "score").collect()
    expected = []
    for i, t in rows:
        line = bytes(ctw.DEPTH) + (t or "").encode() + b"\0"
        expected.append((str(i), sum(np.log10(want(line[p - ctw.DEPTH : p], line[p])) for p in range(ctw.DEPTH, len(line)))))
    assert any(held.values()) and len(got) == len(rows)
    for (i, score), (j, own) in zip(sorted(expected), sorted((str(r.doc_id), r.score) for r in got)):
        assert i == j and own == pytest.approx(score, rel=1e-6)


def test_predictions_are_a_distribution(spark):
    """The bytes after a context, met or not, have probability 1 together."""
    learned = b"\0\0\0\0\0abracadabra abracadabra zebra\0"
    n = Counter(learned[i : i + ctw.DEPTH + 1] for i in range(len(learned) - ctw.DEPTH))
    contexts = [b"\0" * 5, b"abrac", b"dabra", b"zzzzz", b"xabra", bytes([255] * 5)]
    runs = {c + bytes([x]) for c in contexts for x in range(256)} | set(n)
    rows = [(int.from_bytes(r[:-1][::-1] + r[-1:], "big"), n[r]) for r in runs]
    got = {r.key: r.score for r in ctw.run_scores(spark.createDataFrame(rows, "key long, n long")).collect()}
    for c in contexts:
        scores = [got[int.from_bytes(c[::-1] + bytes([x]), "big")] for x in range(256)]
        assert sum(10.0**x for x in scores) == pytest.approx(1, rel=1e-9)
    assert len(got) == len(rows)


def test_scoring_without_training_rows(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    got = ctw.score_documents(documents(spark, [(held[0], "ab"), (held[1], None)])).collect()
    assert {(r.train_tokens, r.n_known) for r in got} == {(0, 0)}
    by_id = {r.doc_id: r for r in got}
    assert by_id[held[0]].score == pytest.approx(3 * 8 * np.log10(0.5), rel=1e-6)
    assert by_id[held[1]].score == pytest.approx(8 * np.log10(0.5), rel=1e-6)
    assert by_id[held[1]].base_score == pytest.approx(0.0)
    assert ctw.score_documents(documents(spark, []).limit(0)).count() == 0
