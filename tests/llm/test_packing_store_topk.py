"""Operators 2, 6 and 8: against plain loops and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from millrace.llm import packing, token_store, tokenizing, topk
from millrace.llm._common import components, scratch

ODD = ["", " ", "a ", "a  b", " \n x", "\tA", "ÀΣ ΑΣ", "<|endoftext|> x", "中文 字", "don't stop", "12 345", "x\x1cy z", "é́ e", "\xa0b", "a\x85 b", "😀 ok"]


def docs(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, ids string, length int")


@pytest.mark.parametrize("name,cut", [("byte_bpe_50k.json", "space"), ("word_bpe_49k.json", "white")])
def test_units_equal_whole_texts(name, cut):
    rng = random.Random(1)
    enc = tokenizing.UnitEncoder(tokenizing.public_path(name), cut)
    bits = ["a", "b", " ", "  ", "\n", " \n", "\t", "é", "Σ", "ΑΣ", "'s", "'t", "1", "23", ".", "<|endoftext|>", "\u2003", "\u3000", "\x1c", "İ", "́", "中文", "😀", "\x85", "ß", "ﬁ", "\0", "word", "Word,", "x.\nLa.", "\n\n", ".\n", "a\nb", "²", "½3", "_", "$$$", "e\u0301", "ΑΣ'Α", "-"]
    texts = ODD + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(6000)]
    ids, sizes = enc.encode(texts, 7)
    at = 0
    for t, n in zip(texts, sizes.tolist(), strict=True):
        assert ids[at : at + n].tolist() == [*enc.tokenizer.encode(t, add_special_tokens=False).ids, 7], t
        at += n


def test_stops_commas_and_line_ends_make_no_new_units():
    """A word is one unit whatever follows it; where a full stop or comma may be one piece with what is before it, ids are those of the whole text."""
    enc = tokenizing.UnitEncoder(tokenizing.public_path("byte_bpe_50k.json"), "space")
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcdeé") for _ in range(8)) for _ in range(500)})
    text = "".join(f"{w} {w}. {w}, {w}.\nThe " for w in words) + "end"
    bits = [". ", ", ", ".\n", "\n", " ", "a", "½", "_", ")", "'s", ".", ",", "\0", "\u00b2", "中", "\u0301", "  ", "\x1c", "...", "Word"]
    texts = [text, ". a", ", a", ".\na", ".", "\n", ".\n", ".\n\na", "a.\n b", "a).\nb. c_, d"] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    for some in ([text], texts, texts):
        ids, sizes = enc.encode(some, 7)
        assert len(some) > 1 or len(enc.index) < len(words) + 20
        ends = np.cumsum(sizes)
        for t, end, n in zip(some, ends.tolist(), sizes.tolist(), strict=True):
            assert ids[end - n : end].tolist() == [*enc.tokenizer.encode(t, add_special_tokens=False).ids, 7], t


def test_cache_cut_back():
    enc = tokenizing.UnitEncoder(tokenizing.public_path("byte_bpe_50k.json"), "space", most_units=20)
    for k in range(20):
        text = " ".join(f"w{j}" for j in range(k, k + 9)) + " the the"
        assert enc.encode([text], 1)[0].tolist() == [*enc.tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert len(enc.index) < 40


def test_long_units_are_forgotten(monkeypatch):
    """Texts without blanks: the cache is bounded in characters, and what is kept stays right under its new numbers."""
    monkeypatch.setattr(tokenizing, "CACHE_CHARS", 5000)
    enc = tokenizing.UnitEncoder(tokenizing.public_path("byte_bpe_50k.json"), "space")
    for k in range(30):
        text = f"the word w{k} " + "中文字" * (100 + k) + f" the end{k % 3} the"
        assert enc.encode([text], 1)[0].tolist() == [*enc.tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert enc.index.chars < 6000
    assert "the" in enc.index and len(enc.pool) < 4 << 20


def test_a_unit_of_several_slices_is_looked_up_once(monkeypatch):
    """Slices encoded together give what each gives alone, in few lookups, through cut-backs too; kept units keep their numbers."""
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abcdeé") for _ in range(6)) for _ in range(300)})
    slices = [[" ".join(rng.choice(words) + rng.choice(["", ".", ",", ".\nThe"]) for _ in range(400)), *rng.sample(ODD, 5), ""] for _ in range(30)] + [[], [""]]
    looked_up = []
    plain = tokenizing._Index.numbers
    monkeypatch.setattr(tokenizing._Index, "numbers", lambda self, pieces: looked_up.append(len(pieces)) or plain(self, pieces))
    path = tokenizing.public_path("byte_bpe_50k.json")
    for most, together in ((10_000, 1 << 30), (100, 9000), (100, 1)):
        monkeypatch.setattr(tokenizing, "TOGETHER", together)
        enc = tokenizing.UnitEncoder(path, "space", most_units=most)
        looked_up.clear()
        out = list(enc.encode_slices(slices, 7))
        assert together < 1 << 30 or (len(looked_up) == 1 and looked_up[0] < 2 * len(words))
        for texts, (ids, sizes) in zip(slices, out, strict=True):
            assert ids.tolist() == [i for t in texts for i in [*enc.tokenizer.encode(t, add_special_tokens=False).ids, 7]]
            assert len(sizes) == len(texts) and sizes.sum() == len(ids)
    enc = tokenizing.UnitEncoder(path, "space", most_units=100)
    enc.encode([" ".join(words)], 7)
    before = list(enc.index.items())
    enc._cut_back()
    assert list(enc.index.items()) == before[:60] and len(enc.index.closed) == 60
    assert enc.index.chars == sum(len(u) for u, _ in before[:60]) and enc.used < len(words) * 7


# --- operator 2


def check_slots(histogram, capacity):
    slots = packing.plan_slots(dict(histogram), capacity)
    fill = {}
    seen = dict.fromkeys(histogram, 0)
    for n, r0, r1, first, per, offset in sorted(slots, key=lambda s: (s[0], s[1])):
        assert r0 == seen[n] and r1 > r0
        seen[n] = r1
        for r in range(r1 - r0):
            fill.setdefault(first + r // per, []).append((offset + r % per * n, n))
    assert seen == dict(histogram)
    for items in fill.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= capacity
        assert sum(3 * n > capacity for _, n in items) <= 2
    return len(fill)


def test_slots_on_random_histograms():
    rng = random.Random(8)
    for _ in range(300):
        cap = rng.choice([7, 12, 30, 100])
        h = {n: rng.randint(1, 40) for n in rng.sample(range(1, cap + 1), rng.randint(1, min(cap, 12)))}
        bins = check_slots(h, cap)
        least = max(-(-sum(n * c for n, c in h.items()) // cap), sum(c for n, c in h.items() if 2 * n > cap))
        assert least <= bins <= least * 1.35 + 2
    assert check_slots({2048: 5, 1024: 4, 1025: 3, 1023: 3, 1: 7}, 2048) == 11
    assert packing.plan_slots({}, 10) == []


def test_packing(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice(["one", "Two", "größe", "x1,"]) for _ in range(rng.choice([0, 3, 50, 900])))) for k in range(120)] + [(200, None), (201, ""), (7, "again"), (None, "no id"), (202, "word " * 3000)]
    got = packing.pack_documents(docs(spark, rows), capacity=256).collect()
    enc = tokenizing.encoder("word_bpe_49k.json", "white")
    want = []
    for d, t in rows:
        ids = np.array([*enc.tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(d, p, s, len(ids[s : s + 256]), zlib.crc32(ids[s : s + 256].tobytes())) for p, s in enumerate(range(0, len(ids), 256))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= 256
    assert len(bins) <= max(-(-sum(w[3] for w in want) // 256), sum(w[3] > 128 for w in want)) * 1.1
    assert packing.pack_documents(docs(spark, [])).collect() == []


# --- operator 8


def test_store_roundtrip(spark):
    rng = random.Random(4)
    long = " ".join(f"word{rng.randrange(500)}" for _ in range(20000))
    rows = [(5, long), (3, long), (4, long[:30000]), (9, None), (1, ""), (5, "same id"), (None, "no id")] + [(10 + k, t) for k, t in enumerate(ODD)]
    path = scratch(spark, "test-store")
    token_store.write_store(docs(spark, rows), path)
    enc = tokenizing.encoder("byte_bpe_50k.json", "space")
    ids = [(d, np.array([*enc.tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")) for d, t in rows]
    got = token_store.verify_documents(spark, path).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(((d, len(x), zlib.crc32(x.tobytes())) for d, x in ids), key=repr)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    back = sorted(((r.doc_id, tuple(r.ids)) for r in token_store.read_documents(spark, path).collect()), key=repr)
    assert back == sorted(((d, tuple(map(int, x))) for d, x in ids), key=repr)
    chunks = spark.read.parquet(f"{path}/store").where("kind = 'chunk'")
    assert chunks.count() == chunks.select("digest").distinct().count() < sum(len(token_store.chunk_bounds(token_store.cut_points(x, 2048), 0, len(x), 512, 16384)) - 1 for _, x in ids)
    top = spark.read.parquet(f"{path}/manifest").where("_part = -1").first()
    assert (top.n_docs, top.n_tokens) == (len(rows), at)


def test_store_edges_and_damage(spark):
    path = scratch(spark, "test-store")
    token_store.write_store(docs(spark, []), path)
    assert token_store.verify_documents(spark, path).collect() == []
    path = scratch(spark, "test-store")
    token_store.write_store(docs(spark, [(1, "some text"), (2, "other text")]), path)
    bad = scratch(spark, "test-bad")
    for name in ("store", "recipes", "manifest"):
        df = spark.read.parquet(f"{path}/{name}")
        if name == "recipes":
            df = df.withColumn("n_tokens", F.col("n_tokens") + 1)
        df.write.parquet(f"{bad}/{name}")
    with pytest.raises(ValueError):
        token_store.verify_documents(spark, bad).collect()


def test_ids_are_stored_in_16_bits_where_they_fit(spark):
    path = scratch(spark, "test-store")
    token_store.write_store(docs(spark, [(k, f"some text {k % 3}" * 50) for k in range(9)]), path)
    rows = spark.read.parquet(f"{path}/store").where("kind = 'chunk'").collect()
    assert len(rows) == 3
    expand = zstandard.ZstdDecompressor()
    assert all(len(expand.decompress(r.payload)) == 2 * r.n for r in rows)
    wide, squeeze = np.array([5, 70_000, 65_536, 1], "<u4"), zstandard.ZstdCompressor()
    narrow = wide % 1000

    def check(ids, kind, n):
        batch = pa.record_batch([[hashlib.sha256(ids).digest()], pa.array([n], pa.int64()), [squeeze.compress(ids.astype(kind).tobytes())]], names=["digest", "n", "payload"])
        return [tuple(r.values())[1:] for b in token_store._check_chunks([batch]) for r in b.to_pylist()]

    for ids, kind in ((wide, "<u4"), (narrow, "<u4"), (narrow, "<u2")):
        assert check(ids, kind, 4) == [(4, zlib.crc32(ids.tobytes()))]
        for n in (2, 8):
            with pytest.raises(ValueError):
                check(ids, kind, n)
    with pytest.raises(ValueError):
        check(wide, "<u2", 4)


def test_chunks_follow_content():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 50000, 60000).astype("<u4")
    b = np.concatenate([rng.integers(0, 50000, 777).astype("<u4"), a])

    def cut(x):
        bounds = token_store.chunk_bounds(token_store.cut_points(x, 1024), 0, len(x), 128, 8192)
        return {x[s:e].tobytes() for s, e in zip(bounds, bounds[1:], strict=False)}

    assert len(cut(a) & cut(b)) > 0.8 * len(cut(a))


def test_merkle_and_crc():
    assert token_store.merkle_root([b"a", b"b", b"c"]) != token_store.merkle_root([b"a", b"c", b"b"]) != token_store.merkle_root([b"a", b"b"])
    ops = token_store._zero_operators()
    for a, b in ((b"hello", b"w" * 1000), (b"", b"x"), (b"q", b"")):
        x = np.array([zlib.crc32(a)], np.uint64)
        for k in range(20):
            if len(b) >> k & 1:
                x = token_store._carry(ops[k], x)
        assert int(x[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


# --- operator 6


def brute(rows, is_query, k):
    ok = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (q, a) in enumerate(ok):
        if is_query(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for c, (i, b) in enumerate(ok) if c != at)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, k=10, block=64):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, v string")
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, k, block).collect())


def test_topk_random(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=40) * 0.2]) for i in range(1500)]
    rows += [(2000 + i, rows[i % 7][1]) for i in range(300)]  # ties
    assert run(spark, rows) == brute(rows, lambda i: i % 100 == 0, 10)


def test_topk_edges(spark):
    f = [0.5, -0.25]
    rows = [(0, f), (1, None), (2, [0.5, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [0.001, -0.001]), (100, f), (6, [1.0]), (7, []), (None, f), (8, [0.1, 0.2, 0.3]), (8, [0.1, 0.2, 0.3])]
    assert run(spark, rows) == brute(rows, lambda i: i % 100 == 0, 10)
    assert run(spark, rows[1:5]) == [] and run(spark, []) == []
    again = [*rows, (0, f), (0, [0.9, 0.9]), (100, f)]  # repeated queries are candidates of one another
    assert run(spark, again) == brute(again, lambda i: i % 100 == 0, 10) and run(spark, again, k=2) == brute(again, lambda i: i % 100 == 0, 2)
    huge = spark.createDataFrame([(0, [1.0e306]), (100, [2.0]), (1, [1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(huge, F.col("vec_id") % 100 == 0).collect()] == [(100, 1, 1, 2 * 1024 * 1024)]
    big = [(0, [3.0e5, 1.0]), (1, [2.0e5, 1.0]), (2, [-1.0e5, 2.0]), (3, [2.0e5, 1.0])]
    assert run(spark, big) == brute(big, lambda i: i % 100 == 0, 10)


# --- shared


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, k) for k in range(1001, 1400)] + [(k, k + 1) for k in range(2000, 2150)] + [(5, 5)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(root == find(node) for node, root in got.items())
    assert set(got) == {x for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
