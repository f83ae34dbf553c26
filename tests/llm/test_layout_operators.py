"""Packing, WARC, vector dedup, sharding, token files, the pipeline."""

import hashlib
import io
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import plain
from triplake.llm import components, decontaminate, packing, quality, sharding, shared_files, token_files, tokens, vector_dedup, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD_TEXTS = [
    "Hello, WORLD's it's we'll they've I'd x'S", "naïve café ÉÀ ß ÿ Ž œ Ŋ ŉ ı İ ſ", "é combining", "日本語 текст", "a b c\x1cd\x85e",
    "<|startoftext|> x <|endoftext|>", "<|x|>", "''' ''s 's's !'s 12'3 ½ ² 4५", "tab\tnew\nline\r\x0b\x0c", "", "   ", "a" * 5000, "#!$%&" * 300, "x\x00y\x7fz", "×÷·¿",
]


# ---------------------------------------------------------------- tokens


def test_encoder_equals_the_tokenizer(spark, monkeypatch):
    t = tokenizer()
    texts = ODD_TEXTS + [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rng = random.Random(3)
    texts += ["".join(rng.choice("aB'stl vemrd ,.!é9\nß") for _ in range(40)) for _ in range(500)]
    texts += ["x " + "ab" * 700 + " y", "é" * 501, "don't" * 300, "a" * 400 + " " + "-" * 800 + "9" * 30]  # long pieces
    enc = tokens.Encoder(tokens.vocabulary_path())
    assert enc.by_piece and "tokenizer" not in vars(enc) and enc.size == t.get_vocab_size(with_added_tokens=True)
    want = [t.encode(text, add_special_tokens=False).ids for text in texts]
    for text, ids in zip(texts, want):
        assert enc.encode(text).tolist() == ids, text[:50]
    for held in (1, 3000, 1 << 20):
        monkeypatch.setattr(tokens, "HELD_CHARS", held)
        assert [ids.tolist() for ids in enc.encode_all([*texts, None])] == [*want, []]
    assert [len(x) for x in enc.encode_all([None, "", "  "])] == [0, 0, 0] and not list(enc.encode_all([]))
    # every token of the vocabulary, within a piece and at its end
    names = {v: k for k, v in t.get_vocab().items()}
    byte_of = {c: b for b, c in tokens.byte_letters().items()}
    words = (bytes(byte_of[c] for c in n.removesuffix("</w>")).decode(errors="ignore") for i, n in names.items() if i < 49_406)
    words = [w for w in words if w]
    for text in (" ".join(words), " ".join("a" + w + "e" for w in words)):
        assert enc.encode(tokens.UNUSUAL.sub("", text)).tolist() == t.encode(tokens.UNUSUAL.sub("", text), add_special_tokens=False).ids
    other = tokens.Encoder(tokens.vocabulary_path("byte_bpe_50k.json"))
    assert not other.by_piece and [len(x) > 0 for x in other.encode_all(["some text", None])] == [True, False]


def test_cut_pieces():
    pattern = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^a-zß-öø-ž0-9\s]+")
    rng = random.Random(12)
    texts = ["", " ", "'", "x'", "'s", "''s", "'rex've'll'l'dx'sty't1's", "÷'s×é×1", "'r", "'v\n'e"]
    texts += ["".join(rng.choice(4 * "'" + "stmdrevlA1é÷×Ž .,\n\t") for _ in range(rng.randrange(30))) for _ in range(3000)]
    line, ends = tokens.cut_pieces(texts)
    for text, a, b in zip(texts, [0, *ends[:-1]], ends):
        assert line[a:b].tobytes().decode() == "".join(f"{p} " for p in pattern.findall(text.lower())), text
    assert len(ends) == len(texts) and [len(x) for x in tokens.cut_pieces([])] == [0, 0]


def test_tokens_that_their_symbols_do_not_merge_to():
    order = {pair: i for i, pair in enumerate([("b", "c"), ("a", "b"), ("ab", "c"), ("bc", "d</w>"), ("a", "bcd</w>")])}
    tokens_of = {"bc": True, "ab": True, "abc": False, "bcd</w>": True, "abcd</w>": True}
    assert {t: tokens.reachable(t, order) for t in tokens_of} == tokens_of


# ---------------------------------------------------------------- token files


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = (rng.random(n) ** 8 * (1 << 32)).astype(np.uint32)
        ranks[: n // 2] >>= 20
        control, data = token_files.encode_block(ranks)
        assert len(control) == -(-n // 4)
        assert (token_files.decode_block(control, data, n) == ranks).all()


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 500)
    rng = random.Random(1)
    rows = [(i, t) for i, t in zip(rng.sample(range(10_000), len(ODD_TEXTS)), ODD_TEXTS)] + [(-3, None), (20_000, "a b"), (20_000, "a b")]
    docs = documents(spark, rows).withColumnRenamed("lang", "ids").withColumnRenamed("source", "n")
    t, start, want = tokenizer(), 0, []
    for i, text in sorted(rows, key=lambda r: r[0]):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    got = token_files.round_trip(docs, docs_per_file=4).collect()
    assert sorted(map(tuple, got)) == want
    assert token_files.round_trip(docs.limit(0)).count() == 0
    assert token_files.round_trip(documents(spark, [(None, "x"), (1, "y")])).where("doc_id is null and start = 0").count() == 1


def test_frequent_ids_get_short_codes(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    folder, manifest, by_rank = token_files.write_files(docs, tokens.vocabulary_path(), 2, 50)
    assert manifest.count() == 4
    counts = Counter()
    t = tokenizer()
    for r in docs.collect():
        counts.update([*t.encode(r.text or "", add_special_tokens=False).ids, 2])
    n = np.array([counts[i] for i in by_rank.tolist()])
    assert (np.diff(n) <= 0).all() and n.sum() == sum(counts.values())
    assert sorted(by_rank.tolist()) == list(range(len(by_rank)))


# ---------------------------------------------------------------- packing


def check_pieces(rows, pieces, window=2048):
    """Every id in one piece, sequences gapless; returns sequence lengths."""
    t = tokenizer()
    own = defaultdict(list)
    sequences = defaultdict(list)
    for p in pieces:
        own[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert own.keys() == {i for i, _ in rows}
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for p in sorted(own[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.length > 0
            assert p.ids_crc32 == crc(ids[at : at + p.length])
            at += p.length
        assert at == len(ids)
    lengths = []
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        lengths.append(at)
    return lengths


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 64)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(2000, None), (2001, "word " * 9000)]
    got = packing.pack(documents(spark, rows).withColumnRenamed("lang", "tail"), partition_docs=100).collect()
    lengths = check_pieces(rows, got)
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths)
    assert sum(n == 2048 for n in lengths) > len(lengths) / 2


def test_packing_odd_rows(spark):
    got = packing.pack(documents(spark, [(1, "a b"), (1, "a b"), (None, ""), (3, "a b")])).collect()
    assert sorted((p.doc_id or -1, p.length, p.doc_tokens) for p in got if p.start == 0 and p.length == p.doc_tokens) != []
    assert sum(p.length for p in got) == 3 + 3 + 1 + 3
    assert packing.pack(documents(spark, []).limit(0)).count() == 0


def test_neighbours_share_terms():
    rng = np.random.default_rng(2)
    topics = [rng.integers(100 * k, 100 * k + 100, (20, 50)) for k in range(3)]
    ids = [x for k in range(20) for x in (topics[0][k], topics[1][k], topics[2][k])]
    idf = np.ones(400)
    shard = packing.Shard(ids, idf, 50.0)
    near = shard.neighbours(1, np.arange(60) != 1)
    assert set(near) == {i for i in range(60) if i % 3 == 1 and i != 1}
    one_topic = [len({d % 3 for d, _, _ in s}) == 1 for s in packing.pack_shard(ids, idf, 50.0, 256)]
    assert np.mean(one_topic) > 0.6


def test_related_documents_with_distant_ids_share_sequences(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 64)
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    usual = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 6))) for _ in range(300)]
    topics = [["".join(rng.choice(letters) for _ in range(7)) for _ in range(3)] for _ in range(20)]
    rows = [(10_000 * j + 3 * k, [*topics[k] * 6, *rng.sample(usual, 60)]) for k in range(20) for j in range(6)]
    rows += [(i, rng.sample(usual, 75)) for i in rng.sample(range(70_000, 90_000), 500)]
    rows = [(i, " ".join(rng.sample(words, len(words)))) for i, words in rows]
    got = packing.pack(documents(spark, rows), window=512, partition_docs=100).collect()
    assert max(check_pieces(rows, got, 512)) == 512
    topic = {10_000 * j + 3 * k: k for k in range(20) for j in range(6)}
    together = defaultdict(set)
    for p in got:
        if p.doc_id in topic:
            together[p.sequence_id, topic[p.doc_id]].add(p.doc_id)
    met = set().union(*(ids for ids in together.values() if len(ids) > 1))
    assert len(met) > 0.9 * len(topic)


def test_strongest_terms():
    rng = np.random.default_rng(8)
    rows = sorted({(int(a), int(b)) for a, b in rng.integers(0, 30, (300, 2)) if a % 5})
    weight = rng.integers(0, 4, len(rows)).astype(float)
    tail, term = np.array(rows).T
    got = packing.strongest(tail, term, weight, 30, 4)
    for d in range(30):
        own = sorted((-w, t) for (a, t), w in zip(rows, weight) if a == d and w > 0)[:4]
        assert got[d].tolist() == [t for _, t in own] + [-1] * (4 - len(own))
    assert (packing.strongest(tail[:0], term[:0], weight[:0], 2, 3) == -1).all()


@pytest.mark.parametrize("kind", ["<u2", "<u4"])
def test_term_counts(kind, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_TAILS", 4)
    rng = np.random.default_rng(9)
    ids = [rng.integers(0, 9, n).astype(kind) for n in (3, 0, 50, 1, 20, 0)]
    got = []
    for at, (sizes, tail, term, times) in enumerate(packing.term_counts(pa.array([x.tobytes() for x in ids]), kind)):
        assert sizes.tolist() == [len(x) for x in ids[4 * at : 4 * at + 4]]
        got += zip((tail + 4 * at).tolist(), term.tolist(), times.tolist())
    assert got == [(d, t, n) for d, x in enumerate(ids) for t, n in sorted(Counter(x.tolist()).items())]
    empty = [pa.array([b"", b""]), pa.array([], pa.binary())]
    assert [len(term) for c in empty for _, _, term, _ in packing.term_counts(c, kind)] == [0]


@pytest.mark.parametrize("firsts", [1, 4, 16])
def test_neighbours_by_all_terms(firsts, monkeypatch):
    """Against plain scores; rare terms of the seed's own don't hide others."""
    monkeypatch.setattr(packing, "FIRST_NEIGHBOURS", firsts)
    rng = np.random.default_rng(4)
    ids = [np.append(np.arange(1000 + 100 * d, 1060 + 100 * d), rng.integers(0, 40, rng.integers(1, 60))) for d in range(30)]
    ids[7] = np.array([500, 501])
    idf = np.where(np.arange(5000) < 40, rng.random(5000) + 0.1, 9.0)
    shard, mean = packing.Shard(ids, idf, 80.0), 80.0
    for seed in (0, 7, 12):
        unused = rng.random(30) < 0.8
        score = np.zeros(30)
        for d, x in enumerate(ids):
            for t in np.intersect1d(x, ids[seed]):
                tf = (x == t).sum()
                score[d] += idf[t] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(x) / mean))
        want = sorted((d for d in range(30) if unused[d] and score[d] > 0), key=lambda d: (-score[d], d))
        assert list(shard.neighbours(seed, unused)) == want


# ---------------------------------------------------------------- WARC


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 300)
    long = "é" * 60
    rows = [(5, "u", long), (3, "u", long), (9, "u\r\nX: y", long), (1, "u", "short"), (2, "u", "short"), (7, None, None), (8, "", ""), (None, "u", long), (3, "u", long), (11, "u", "x" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "p") for r in rows], "page_id long, url string, html string, payload string")
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        refers = 3 if html == long and i != 3 else None
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if refers else "response", refers))
    folder, manifest = warc.write_archives(warc.with_revisits(pages), 300)
    assert manifest.count() > 2
    assert sorted(map(tuple, warc.read_archives(folder, manifest).collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, warc.round_trip(pages).collect()), key=str) == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_reader_finds_damage():
    good = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    read = lambda data: list(warc.ArchiveReader(io.BytesIO(data)))
    assert [(f["warc-record-id"], n) for f, n, _ in read(good * 2)] == [("<urn:page:1>", 7)] * 2
    assert read(b"") == []
    with pytest.raises(ValueError, match="too early"):
        read(good + good[:-6])
    with pytest.raises((ValueError, zlib.error)):
        read(good[:40] + b"\0" + good[41:])
    framed = zlib.compressobj(6, zlib.DEFLATED, 31)
    bad = framed.compress(b"WARC/1.1\r\nContent-Length: 3\r\n\r\npayload\r\n\r\n") + framed.flush()
    with pytest.raises(ValueError, match="frame"):
        read(bad)


def test_reader_of_small_pieces(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 3)
    data = b"".join(warc.record(i, "http://x/" + "y" * i, bytes(range(i)) * i, "d", None) for i in range(20))
    got = list(warc.ArchiveReader(io.BytesIO(data)))
    assert [n for _, n, _ in got] == [i * i for i in range(20)]
    assert [d for *_, d in got] == [hashlib.sha256(bytes(range(i)) * i).hexdigest() for i in range(20)]


def test_shared_folder_schemes():
    with pytest.raises(ValueError, match="scheme"):
        shared_files.open_folder("ftp://x/y")


# ---------------------------------------------------------------- vectors


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def expect(rows, threshold=0.98):
    links = plain.vector_links(rows, threshold)
    n = Counter(x for pair in links for x in pair)
    root = plain.components(range(len(rows)), links)
    least = defaultdict(list)
    for at, r in root.items():
        if rows[at][0] is not None:
            least[r].append(rows[at][0])
    return sorted(((rows[i][0], n[i], min(least[root[i]], default=None)) for i in range(len(rows))), key=str)


@pytest.mark.parametrize("block", [512, 8])
def test_vectors_against_all_pairs(spark, block):
    rng = np.random.default_rng(7)
    rows = []
    for c in rng.standard_normal((30, 64)):
        for _ in range(rng.integers(1, 30)):
            rows.append((c + rng.standard_normal(64) * rng.choice([0.05, 0.1, 0.14]), int(rng.integers(0, 2))))
    rows += [(rows[0][0] * 3, rows[0][1])] * 20  # copies of one direction
    order = rng.permutation(len(rows))
    rows = [(int(i), np.float32(v).tolist(), label) for i, (v, label) in zip(order, rows)]
    odd = [(None,), ([],), ([0.0] * 64,), ([float("nan")] * 64,), ([None] + [1.0] * 63,), ([1.0, 2.0],), ([1.0, 2.0],), ([float("inf")] + [0.0] * 63,)]
    rows += [(10_000 + i, *v, 1) for i, v in enumerate(odd)] + [(20_000, rows[0][1], None), (20_001, rows[0][1], None)]
    got = vector_dedup.near_duplicate_vectors(vectors(spark, rows).selectExpr("*", "'x' as cid", "1 as bands"), block=block).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == expect(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_vectors_repeated_and_null_ids(spark):
    v = np.eye(64, dtype=np.float32).tolist()
    near = [0.999, 0.03] + [0.0] * 62
    rows = [(4, v[0], 1), (4, v[0], 1), (2, near, 1), (None, v[0], 1), (None, v[5], 1), (4, v[9], 1), (9, v[9], 2)]
    got = vector_dedup.near_duplicate_vectors(vectors(spark, rows)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == expect(rows)
    assert vector_dedup.near_duplicate_vectors(vectors(spark, rows).limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    a = vector_dedup.unit(rng.standard_normal((4000, 64)))
    b = vector_dedup.unit(a[:, :64] + rng.standard_normal((4000, 64)) * 0.1)
    both = np.concatenate([a, b])
    runs, factor = vector_dedup.codes(both)
    signs, turned = vector_dedup.code_signs(runs, 64), both @ vector_dedup.rotation(64, 0)
    i = np.arange(4000)
    estimate, width = vector_dedup.estimates(signs, factor, turned, i, i + 4000)
    error = estimate - (a * b).sum(axis=1)
    assert abs(error.mean()) < 0.01 and (np.abs(error) <= width).all()


def test_components_of_paths_and_stars(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 120)] + [(500, i) for i in range(200, 260)] + [(7, 7), (600, 601), (601, 600)]
    links += [(rng.randrange(700, 900), rng.randrange(700, 900)) for _ in range(150)]
    rng.shuffle(links)
    got = components.components(spark.createDataFrame([*links, (None, 3)], "u long, v long"))
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.component for r in got.collect()} == plain.components(nodes, links)
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---------------------------------------------------------------- sharding


def test_sharding(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(-(1 << 62), 1 << 62), "é" * rng.randrange(5)) for _ in range(3000)] + [(7, "same")] * 900 + [(None, None), (8, None)]
    docs = documents(spark, rows).withColumnRenamed("lang", "shard").repartition(7)
    got = sharding.shard_documents(docs, 16).collect()
    key = lambda i: int(hashlib.md5(("null" if i is None else str(i)).encode()).hexdigest()[:15], 16)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), plain.jump(key(i), 16), plain.jump(key(i), 17)) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    assert all(r.law == "key" and r.grown_shard in (r.shard, 16) for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    moved = sum(r.grown_shard == 16 for r in got if r.doc_id != 7)
    assert abs(moved / 3000 - 1 / 17) < 0.02
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_sharding_runs_no_python(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = sharding.assign(docs, "doc_id", 16)._jdf.queryExecution().toString()
    plan += decontaminate.windows(docs.select(decontaminate.word_hashes(docs.text).alias("hashes")), decontaminate.SizeClass(0, (9,), 9, 5), 5)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark):
    """Each stage against a plain version over what its predecessor kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = [name for name, _ in corpus_pipeline.STAGES]
    assert kept == ["quality", "near_dedup", "decontaminate", "pii", "pack"]
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL).cache()
        frames[name] = docs
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    model = quality.fit(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    scores = dict(zip(source, model.scores(pa.array(list(source.values()), pa.string()))))
    good = {i: t for i, t in source.items() if scores[i] >= 0.3}
    texts = lambda name: {r.doc_id: r.text for r in frames[name].collect()}
    assert texts("quality") == good
    root = plain.components(good, plain.near_links(good, 5, 80))
    alone = {i: t for i, t in good.items() if root[i] == i}
    assert texts("near_dedup") == alone
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    clean = {i: t for i, t in alone.items() if not any(plain.contaminated(t, w) for w in items)}
    assert texts("decontaminate") == clean
    masked = texts("pii")
    assert masked.keys() == clean.keys() and not any(plain.base_spans(t) for t in masked.values())
    assert all(masked[i] == t for i, t in clean.items() if not plain.base_spans(t) and "://" not in t and "token" not in t)
    check_pieces(list(masked.items()), frames["pack"].collect())
    for name in kept[:-1]:
        assert frames[name].columns == ["doc_id", "text", "lang", "source", "n_chars"]
    again = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, frames["pack"].collect()))


def test_pipeline_over_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
