"""Operator 9: SimHash near-duplicates by a byte-position inverted index with count filtering.

Fingerprints are 64 bits over word shingles. Two that differ in at most 2 bits differ in at most 2 of their 8 bytes. A posting per single (position, byte)
would hold 1/256 of all fingerprints, so the index is keyed by sets of four positions with their bytes: the 14 sets whose places XOR to zero (the planes of
eight points), which meet every three positions just once. Two fingerprints that share six positional bytes or more share at least 3 of
these postings, those that share seven at least 7, equal ones all 14, and those that share five or fewer at most 1. So the number of postings that a pair shares, tallied over the
index, says whether it shares enough positional bytes: pairs below the guaranteed minimum are dropped by the tally, the rest are verified by bit count.

Equal fingerprints are one entry of the index, whatever their number. A posting with more than ``cap`` fingerprints is not expanded into pairs. Its members
go to an exact star join: each fingerprint is sent to itself and to its 64 one-bit neighbours, and two fingerprints
meet at one of these if, and only if, they differ in at most 2 bits; those that meet are linked to the smallest. A pair with a posting among the long ones has both
its members there; any other pair's postings are all expanded, so its tally is whole. So no link is lost and nothing grows with the square of a group.

Defined cases: null texts are empty texts; a text without words has fingerprint zero, linked like any
other; repeated rows and repeated doc_ids are rows of their own; rows with a null doc_id get a component too, but never name one
unless alone in it (component_id null); very long texts are hashed in slices of bounded memory; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm._common import components, map_arrow, row_key, skew_join, stage

SEED = 42
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)
#: Postings of more distinct fingerprints than this take the star join.
CAP = 32
#: The position sets that key the index.
PLANES = [p for p in combinations(range(8), 4) if p[0] ^ p[1] ^ p[2] ^ p[3] == 0]


def split_words(text: str) -> list[str]:
    """Runs of characters other than space and U+0009 to U+000D, A-Z lower-cased."""
    text = text.translate(_UPPER)
    if text.isascii():  # str.split() also cuts at U+001C to U+001F, which are rare
        if not any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return text.split()
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def shingle_hashes(words: list[str], width: int) -> np.ndarray:
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        grams = [" ".join(words)]
    else:
        grams = map(" ".join, zip(*(words[k:] for k in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(g, SEED) for g in grams), np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; 0 for none."""
    n = len(hashes)
    if not n:
        return 0
    total = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += part.sum(axis=0, dtype=np.int32)
    return int((_BITS * (total * 2 > n)).sum(dtype=np.uint64))


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            out = np.fromiter((fingerprint(shingle_hashes(split_words(t.as_py() or ""), width)) for t in texts), np.uint64, len(texts))
            yield pa.record_batch([batch.column("doc_id"), pa.array(out.view(np.int64))], names=["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) for every row."""
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _fingerprints(width), "doc_id long, fp long")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _byte(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * k).bitwiseAND(F.lit(255).cast("long"))


def index_keys(fp: Column) -> Column:
    """The 14 keys of a fingerprint: a set of four positions and their bytes."""
    keys = []
    for place, plane in enumerate(PLANES):
        key = F.lit(place).cast("long")
        for k in plane:
            key = F.shiftleft(key, 8).bitwiseOR(_byte(fp, k))
        keys.append(key)
    return F.array(*keys)


def least_postings(max_bits: int) -> int:
    """How many postings two fingerprints share at least if they differ in ``max_bits`` bits: the sets that avoid any so many positions."""
    return min(sum(not set(gone) & set(p) for p in PLANES) for gone in combinations(range(8), max_bits))


def link_fingerprints(distinct: DataFrame, max_bits: int = 2, cap: int = CAP) -> DataFrame:
    """Edges a, b between distinct fingerprints (column fp) that connect all those within ``max_bits`` (at most 2) bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the star join is exact for at most 2 bits")
    postings = stage(distinct.select("fp", F.explode(index_keys(F.col("fp"))).alias("key")), "simhash-postings")
    sizes = stage(postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-sizes")
    short = postings.join(sizes.where(F.col("n") <= cap).select("key"), "key")
    # A posting of at most cap entries becomes one row, then its pairs.
    lists = short.groupBy("key").agg(F.array_sort(F.collect_list("fp")).alias("fps"))
    heads = lists.select("fps", F.posexplode("fps").alias("_at", "a"))
    pairs = heads.select("a", F.explode(F.slice("fps", F.col("_at") + 2, F.lit(cap))).alias("b"))
    tally = pairs.groupBy("a", "b").agg(F.count("*").alias("shared")).where(F.col("shared") >= least_postings(max_bits))
    edges = tally.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")
    long = sizes.where(F.col("n") > cap)
    if max_bits and not long.isEmpty():
        total = long.agg(F.sum("n")).first()[0]
        marked = skew_join(postings, long.withColumn("is_long", F.lit(True)), ["key"], "n", total).where("is_long")
        crowd = stage(marked.select("fp").distinct(), "simhash-crowd")
        flips = [F.lit(0)] + ([F.lit(int(np.int64(np.uint64(1) << np.uint64(k)))) for k in range(64)])
        # For one bit only the edges between a fingerprint and a real neighbour count; they are kept by the check below.
        spokes = crowd.select("fp", F.explode(F.transform(F.array(*flips), lambda z: F.col("fp").bitwiseXOR(z))).alias("z"))
        if max_bits == 2:
            hubs = spokes.groupBy("z").agg(F.min("fp").alias("low"), F.count("*").alias("n")).where("n > 1")
            star = spokes.join(hubs.select("z", "low"), "z").select(F.col("low").alias("a"), F.col("fp").alias("b"))
        else:
            star = spokes.join(crowd.select(F.col("fp").alias("z")), "z").select(F.col("z").alias("a"), F.col("fp").alias("b"))
        edges = edges.unionByName(star.where("a <> b").distinct())
    return edges


def simhash_components(docs: DataFrame, width: int = 3, max_bits: int = 2, cap: int = CAP) -> DataFrame:
    """Every row's doc_id, fingerprint (hex) and component_id: the smallest doc_id that links of at most ``max_bits`` bits reach."""
    rows = stage(fingerprints(docs, width), "simhash")
    by_fp = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "simhash-distinct")
    total = by_fp.agg(F.sum("n")).first()[0] or 0
    roots = stage(components(link_fingerprints(by_fp.select("fp"), max_bits, cap)), "simhash-roots")
    named = by_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = stage(named, "simhash-named")
    tops = stage(named.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("_m")), "simhash-tops")
    table = stage(skew_join(named, tops, ["root"], "_m", named.count()).select("fp", "n", "component_id"), "simhash-table")
    return skew_join(rows, table, ["fp"], "n", total).select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


# Near-duplicates by shingle similarity (Jaccard), exactly.
#
# At a similarity of 0.8 some 15 % of two SimHash fingerprints' bits differ, so hardly a byte need be equal and no number of equal bytes is guaranteed.
# Here a text's fingerprint is its profile: byte k counts the shingles whose hash falls in position k. Two texts of n and m shingles and a similarity of at
# least t share t / (1 + t) (n + m) shingles or more, so their shared positional bytes (the lesser of the two, at each position) add up to at least that.
# Pairs that reach this guaranteed minimum are verified on all shingles.
#
# Pairs meet in an inverted index. Shingles have a global order. Two texts that are similar enough share max(t n, t m) of them or more, so
# each has a shared one among its first n - t n + 1: its prefix. The postings are those of the prefixes, so no pair is lost. Any order will do; common
# shingles come last, so that passages which many texts share are in few prefixes. Which ones are common is estimated from a sample, which bears on the
# number of comparisons only. Texts with the same set of shingles are one entry.

#: One document in so many is read for common shingles; at most so many of them are known.
SAMPLE, COMMON = 16, 200_000
#: Up to so many row keys (16 bytes each) are broadcast to pick rows that are read again.
BROADCAST_ROWS = 2_000_000
#: Most positions of a profile, and of one that goes into postings. Fewer make the count less sharp, never too small.
MOST_POSITIONS, COARSE = 8192, 128
#: So many of an entry's open keys go with it, so that a pair is told in one posting.
LEAST_KEYS = 8
#: Up to so many edges (16 bytes each) are connected in one task; more of them in distributed steps, each of which is several jobs.
EDGES_IN_A_TASK = 1_000_000


def _needed(n: int, similarity: float) -> int:
    """The least number of shared shingles that a text of n has with one that is similar enough."""
    return math.ceil(similarity * n - 1e-9)


def _sets(texts: pa.Array, width: int) -> Iterator[tuple[np.ndarray, int]]:
    """Each text's distinct shingle hashes, ascending, and a hash of them."""
    for t in texts:
        h = np.unique(shingle_hashes(split_words(t.as_py() or ""), width))
        yield h, xxhash.xxh64_intdigest(h.tobytes(), SEED)


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def profile(hashes: np.ndarray, most: int = MOST_POSITIONS) -> np.ndarray:
    """How many of the hashes fall in each position, a power of two of them; 255 stands for that or more."""
    size = min(max(16, 1 << max(len(hashes) - 1, 0).bit_length()), most)
    return np.minimum(np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size), 255).astype(np.uint8)


def _folded(rows: np.ndarray, size: int) -> np.ndarray:
    """Profiles (one a row) over fewer positions."""
    return np.minimum(rows.reshape(len(rows), -1, size).sum(axis=1, dtype=np.int64), 255).astype(np.uint8) if rows.shape[1] > size else rows


def shared_positional(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The most shingles that a text of profile ``x`` can share with those of the profiles ``rows`` (all over as many positions)."""
    least = np.minimum(rows, x)
    return least.sum(axis=1, dtype=np.int64) + (least == 255).sum(axis=1) * (1 << 40)


def _all_shingles(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                found = [h for h, _ in _sets(batch.column("text")[at : at + 200], width)]
                yield pa.record_batch([pa.array(np.concatenate(found).view(np.int64))], names=["h"])

    return run


def common_shingles(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (ascending) of shingles that many documents hold, and how common each is."""
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE)) == 0).select("text")
    counts = map_arrow(sample, _all_shingles(width), "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 2")
    found = counts.orderBy(F.desc("n"), "h").limit(COMMON).toArrow()
    h = found.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], np.log2(found.column("n").to_numpy()).astype(np.int8)[order]


def _entries(width: int, similarity: float, common: tuple[np.ndarray, np.ndarray]):
    known, rank = common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, firsts, profiles, coarse = [], [], [], [], []
            for h, key in _sets(batch.column("text"), width):
                sizes.append(len(h))
                keys.append(key)
                profiles.append(profile(h).tobytes())
                coarse.append(profile(h, COARSE).tobytes())
                if len(known) and len(h):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    h = h[np.argsort(np.where(known[at] == h, rank[at], 0), kind="stable")]
                firsts.append(h[: len(h) - _needed(len(h), similarity) + 1].tobytes())
            columns = [batch.column("doc_id"), batch.column("row_key"), _signed(keys), pa.array(sizes, pa.int64()), *(pa.array(x, pa.binary()) for x in (firsts, profiles, coarse))]
            yield pa.record_batch(columns, names=["doc_id", "row_key", "fp", "n_shingles", "prefix", "profile", "coarse"])

    return run


def _hash_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch.column("text"), width))
            yield pa.record_batch([_signed([k for _, k in sets]), pa.array([h.tobytes() for h, _ in sets], pa.binary())], names=["fp", "hashes"])

    return run


def _prefix_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of each entry's prefix."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            firsts = part.column("prefix").to_pylist()
            fps = np.repeat(part.column("fp").to_numpy(), [len(x) // 8 for x in firsts])
            yield pa.record_batch([pa.array(fps), pa.array(np.frombuffer(b"".join(firsts), np.int64))], names=["fp", "key"])


def _shared_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of postings sorted by key and fp: those with two entries or more, each with the posting's first entry.

    A posting may run over any number of batches; only the last row of the one before is kept.
    """
    last_key, last_fp, head, told = None, 0, 0, True
    for batch in batches:
        keys, fps = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
        if not len(keys):
            continue
        new = np.empty(len(keys), bool)
        new[0] = keys[0] != last_key
        new[1:] = keys[1:] != keys[:-1]
        starts = np.flatnonzero(new)
        heads = fps[starts][np.cumsum(new) - 1] if new[0] else np.concatenate([[head], fps[starts]])[np.cumsum(new)]
        shared = ~new
        shared[:-1] |= ~new[1:]
        out = [(keys[shared], fps[shared], heads[shared])]
        if not new[0] and not told:  # the row before this batch turned out to be shared
            out.insert(0, (np.array([last_key]), np.array([last_fp]), np.array([head])))
        last_key, last_fp, head = keys[-1], fps[-1], heads[-1]
        told = bool(shared[-1])
        cols = [np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True)]
        yield pa.record_batch([pa.array(c) for c in cols], names=["key", "fp", "head"])


def _can_share(n: np.ndarray, m: np.ndarray, most: np.ndarray, similarity: float) -> np.ndarray:
    """Whether texts of n and m shingles, of which at most ``most`` are shared, can be similar enough."""
    return most >= similarity / (1 + similarity) * (n + m) - 1e-9


def _alike(n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    return np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9


def _retained(similarity: float):
    """Of rows a, b with sizes and profiles: the pairs whose sizes and shared positional bytes reach the minimum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                if _alike(na[k], nb[k], similarity):
                    x, y = (np.frombuffer(batch.column(c)[k].as_buffer(), np.uint8)[None] for c in ("pa", "pb"))
                    size = min(x.shape[1], y.shape[1])
                    keep[k] = _can_share(na[k], nb[k], shared_positional(_folded(x, size)[0], _folded(y, size)), similarity)[0]
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _similar(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for p, q in zip(batch.column("ha"), batch.column("hb"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (p, q))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= _needed(len(x) + len(y) - both, similarity))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _chosen(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` (with row_key) whose key is (left_semi) or isn't (left_anti) in ``keys``; a small set of keys is broadcast."""
    return docs.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, "row_key", how)


def _texts_sets(fps: DataFrame, distinct: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """fp and hashes of these entries, from the texts, read again."""
    wanted = stage(fps.join(distinct.select("fp", "row_key"), "fp"), "near-wanted")
    texts = _chosen(docs, wanted.select("row_key").distinct(), "left_semi").select("text")
    sets = map_arrow(texts, _hash_sets(width), "fp long, hashes binary").join(wanted.select("fp"), "fp", "left_semi").dropDuplicates(["fp"])
    return stage(sets, "near-sets")


def _verified(pairs: DataFrame, distinct: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs a, b that are similar enough: those that reach the minimum on whole profiles are compared on the texts, read again."""
    pairs = stage(pairs, "near-met")
    side = lambda x: distinct.select(F.col("fp").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("profile").alias(f"p{x}"))
    # One entry can be the head of very many; its profile has MOST_POSITIONS bytes at most.
    heads = stage(side("a").join(pairs.groupBy("a").agg(F.count("*").alias("_n")), "a"), "near-heads")
    pairs = skew_join(pairs, heads, ["a"], "_n", pairs.count()).join(side("b"), "b")
    pairs = stage(map_arrow(pairs.select("a", "b", "na", "nb", "pa", "pb"), _retained(similarity), "a long, b long"), "near-retained")
    sets = _texts_sets(pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct(), distinct, docs, width)
    for x in "ab":
        pairs = pairs.join(sets.select(F.col("fp").alias(x), F.col("hashes").alias(f"h{x}")), x)
    return stage(map_arrow(pairs.select("a", "b", "ha", "hb"), _similar(similarity), "a long, b long", batch_rows=200), "near-links")


class _Entries:
    """The entries of a list column as plain arrays; all lists lie one after another."""

    def __init__(self, lists: pa.ListArray):
        self.bounds, entries = lists.offsets.to_numpy(), lists.values
        self.fp, self.root, self.n = (entries.field(c).to_numpy() for c in ("fp", "root", "n"))
        coarse = entries.field("coarse")
        _, places, data = coarse.buffers()
        self.starts = np.frombuffer(places, np.int32)[coarse.offset : coarse.offset + len(coarse) + 1]
        self.data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
        least = entries.field("least")
        self.key_bounds, self.keys = least.offsets.to_numpy(), least.values.to_numpy()

    def sizes(self, at: np.ndarray) -> np.ndarray:
        return self.starts[at + 1] - self.starts[at]

    def profiles(self, at: np.ndarray, size: int) -> np.ndarray:
        return self.data[self.starts[at][:, None] + np.arange(size)]

    def least(self, k: int) -> np.ndarray:
        return self.keys[self.key_bounds[k] : self.key_bounds[k + 1]]


#: Up to so many pairs an entry are verified as pairs (whose profiles spare most texts); beyond that a block's entries are compared inside a task.
FEW_PAIRS = 8
#: So many pairs are compared at a time.
PAIRS_AT_ONCE = 100_000


def _across(similarity: float, members: bool = False):
    """Of each row's two blocks (or its one) of a posting's entries: the pairs a < b of different roots whose sizes and shared positional bytes reach the minimum.

    Where the lists of least keys show that a pair also meets under a smaller key, it is told there only. With ``members``: one row for each that has such
    pairs, with its key and blocks; and with the pairs (lists a and b), or, if they are more than FEW_PAIRS an entry, with the entries in them (fps).
    """

    def compared(x: _Entries, y: _Entries, key: np.ndarray, i: np.ndarray, j: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int]]:
        on = np.flatnonzero((x.root[i] != y.root[j]) & _alike(x.n[i], y.n[j], similarity))
        sx, sy = x.sizes(i[on]), y.sizes(j[on])
        for s, t in {*zip(sx.tolist(), sy.tolist(), strict=True)}:
            some = on[(sx == s) & (sy == t)]
            size = min(s, t)
            least = np.minimum(_folded(x.profiles(i[some], s), size), _folded(y.profiles(j[some], t), size))
            most = least.sum(axis=1, dtype=np.int64) + (least == 255).sum(axis=1) * (1 << 40)
            for k in some[_can_share(x.n[i[some]], y.n[j[some]], most, similarity)].tolist():
                common = np.intersect1d(x.least(i[k]), y.least(j[k]), assume_unique=True)
                if not len(common) or common[0] >= key[k]:
                    pair = min(x.fp[i[k]], y.fp[j[k]]), max(x.fp[i[k]], y.fp[j[k]])
                    yield (row[k], *pair) if members else pair

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _Entries(batch.column("xs"))
            y = _Entries(batch.column("ys")) if "ys" in batch.schema.names else x
            keys, waiting, found = batch.column("key").to_numpy(), [], set()
            for k in range(batch.num_rows + 1):
                if waiting and (k == batch.num_rows or sum(len(w[1]) for w in waiting) > PAIRS_AT_ONCE):
                    found.update(compared(x, y, *map(np.concatenate, zip(*waiting, strict=True))))
                    waiting = []
                if k < batch.num_rows:
                    m, n = x.bounds[k + 1] - x.bounds[k], y.bounds[k + 1] - y.bounds[k]
                    i, j = np.triu_indices(m, 1) if y is x else (np.repeat(np.arange(m), n), np.tile(np.arange(n), m))
                    waiting.append((np.full(len(i), keys[k]), i + x.bounds[k], j + y.bounds[k], np.full(len(i), k)))
            if members:
                pairs = np.array(sorted(found), np.int64).reshape(-1, 3)
                rows, starts = np.unique(pairs[:, 0], return_index=True)
                lists = {"a": [], "b": [], "fps": []}
                for part in np.split(pairs[:, 1:], starts[1:]) if len(rows) else []:
                    fps = np.unique(part)
                    few = len(part) <= FEW_PAIRS * len(fps)
                    for name, values in (("a", part[:, 0] if few else fps[:0]), ("b", part[:, 1] if few else fps[:0]), ("fps", fps[:0] if few else fps)):
                        lists[name].append(values)
                columns = [batch.column(c).take(pa.array(rows)) for c in ("key", "xat", "yat")]
                yield pa.record_batch([*columns, *(pa.array(x, pa.list_(pa.int64())) for x in lists.values())], names=["key", "xat", "yat", *lists])
                continue
            a, b = zip(*sorted(found), strict=True) if found else ([], [])
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _least_keys(left: DataFrame) -> DataFrame:
    """fp and the least of its open keys."""
    return left.groupBy("fp").agg(F.slice(F.array_sort(F.collect_set("key")), 1, LEAST_KEYS).alias("least"))


def _blocks(left: DataFrame, entries: DataFrame, block: int, turn: int = 0, pure: bool = True) -> DataFrame:
    """The postings' entries (key, fp, root, with n, coarse and least of ``entries``) in blocks: key, single, at, xs.

    A posting of more than ``block`` entries is cut into blocks of about as many, others at each ``turn``, so no row and no task holds a long posting. A
    component with more entries than that in a posting has blocks of its own with ``pure``, which needn't meet one another.
    """
    long = stage(left.groupBy("key").agg(F.count("*").alias("_m")).where(F.col("_m") > block), "near-long")
    big = left.join(long.select("key"), "key").groupBy("key", "root").agg(F.count("*").alias("_n")).where((F.col("_n") > block) & F.lit(pure))
    big = stage(big, "near-big")
    rest = long.join(big.groupBy("key").agg(F.sum("_n").alias("_out")), "key", "left").select("key", (F.col("_m") - F.coalesce("_out", F.lit(0))).alias("_m"))
    placed = left.join(rest, "key", "left").join(big, ["key", "root"], "left").join(entries, "fp")
    parts = F.greatest(F.ceil(F.coalesce("_n", "_m", F.lit(1)) / block), F.lit(1))
    at = F.struct(F.col("_n").isNotNull().alias("pure"), F.when(F.col("_n").isNotNull(), F.col("root")).otherwise(0).alias("tag"), F.pmod(F.xxhash64("fp", "key", F.lit(turn)), parts).alias("part"))
    blocks = placed.select("key", F.col("_m").isNull().alias("single"), at.alias("at"), F.struct("fp", "root", "n", "coarse", "least").alias("e"))
    return stage(blocks.groupBy("key", "single", "at").agg(F.collect_list("e").alias("xs")), "near-blocks")


def _met(blocks: DataFrame) -> DataFrame:
    """The pairs of different blocks of one posting, and each mixed block with itself: key, xat, yat, xs, ys."""
    x, y = (blocks.where("not single").select("key", F.col("at").alias(f"{c}at"), F.col("xs").alias(f"{c}s")) for c in "xy")
    apart = (F.col("xat") <= F.col("yat")) & ~(F.col("xat.pure") & F.col("yat.pure") & (F.col("xat.tag") == F.col("yat.tag")))
    return x.join(y, "key").where(apart)


def _open_pairs(left: DataFrame, entries: DataFrame, similarity: float, block: int) -> DataFrame:
    """Every pair a < b of one posting's entries (key, fp, root) that are of different roots and reach the minimum on their coarse profiles (fp, n, coarse).

    Their number grows with the square of a group, so :func:`link_similar` doesn't make them; it sees the same pairs inside tasks (:func:`_links_within`).
    """
    blocks = _blocks(left, entries.join(_least_keys(left), "fp"), block)
    alone = map_arrow(blocks.where("single").select("key", "xs"), _across(similarity), "a long, b long", batch_rows=500)
    met = map_arrow(_met(blocks).select("key", "xs", "ys"), _across(similarity), "a long, b long", batch_rows=50)
    return alone.unionAll(met)


def shared_counts(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many members each two of these sets (of distinct members) share."""
    everything = np.concatenate([np.empty(0, np.uint64), *sets])
    values, place, times = np.unique(everything, return_inverse=True, return_counts=True)
    # Members of one set only are shared by none; the others are numbered anew.
    number = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[place]
    row = np.repeat(np.arange(len(sets)), [len(h) for h in sets])
    row, number = row[number >= 0], number[number >= 0]
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    both = np.zeros((len(sets), len(sets)), np.float64)
    for at in range(0, int((times > 1).sum()), columns):
        lo, hi = np.searchsorted(number, [at, at + columns])
        table = np.zeros((len(sets), columns), np.float32)
        table[row[lo:hi], number[lo:hi] - at] = 1
        both += table @ table.T
    both = np.rint(both).astype(np.int64)
    np.fill_diagonal(both, [len(h) for h in sets])
    return both


def _forest(similarity: float):
    """Of each row's entries (fp, root, hashes): pairs that are similar enough and connect all whom such pairs of them connect, none in vain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in range(batch.num_rows):
                entries = batch.column("es")[row].values
                fp, root = entries.field("fp").to_numpy(), entries.field("root").to_numpy()
                both = shared_counts([np.frombuffer(h.as_buffer(), np.uint64) for h in entries.field("hashes")])
                n = both.diagonal()
                like = both >= np.ceil(similarity * (n[:, None] + n[None, :] - both) - 1e-9)
                place, left = np.unique(root, return_inverse=True)[1], len(np.unique(root))
                up = list(range(left))
                a, b = np.nonzero(np.triu(like & (place[:, None] != place[None, :])))
                for i, j in zip(a.tolist(), b.tolist(), strict=True):
                    x, y = place[i], place[j]
                    while up[x] != x:
                        up[x] = x = up[up[x]]
                    while up[y] != y:
                        up[y] = y = up[up[y]]
                    if x != y:
                        up[max(x, y)] = min(x, y)
                        found.append((min(fp[i], fp[j]), max(fp[i], fp[j])))
                        left -= 1
                        if left == 1:
                            break
            a, b = zip(*found, strict=True) if found else ([], [])
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _links_within(rows: DataFrame, left: DataFrame, distinct: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """Edges that connect the entries of each row (key, xat, yat, xs and ys, or xs alone) which similar pairs of them connect.

    The profiles say which entries have a possible partner there. Where such pairs are at most FEW_PAIRS an entry, they are verified as pairs. Else the
    entries are read again, and all pairs of them are compared inside a task, which tells a spanning forest. So the rows made grow with the entries, whatever the number of pairs.
    """
    kind = dict(rows.dtypes)
    schema = f"key long, xat {kind['xat']}, yat {kind['yat']}, a array<long>, b array<long>, fps array<long>"
    met = stage(map_arrow(rows, _across(similarity, members=True), schema, batch_rows=50 if "ys" in kind else 500), "near-met-blocks")
    few = met.select(F.explode(F.arrays_zip("a", "b")).alias("p")).select("p.a", "p.b").distinct()
    edges = _verified(few, distinct, docs, width, similarity)
    asked = met.select("key", "xat", "yat", F.explode("fps").alias("fp"))
    if asked.isEmpty():
        return edges
    sets = _texts_sets(asked.select("fp").distinct(), distinct, docs, width)
    entries = asked.join(sets, "fp").join(left.select("fp", "root").distinct(), "fp")
    entries = entries.groupBy("key", "xat", "yat").agg(F.collect_list(F.struct("fp", "root", "hashes")).alias("es"))
    return edges.unionByName(stage(map_arrow(entries.select("es"), _forest(similarity), "a long, b long", batch_rows=20).distinct(), "near-forest"))


def _connected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of all these edges a, b, with the smallest node of its component as root."""
    parts = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    a, b = (np.concatenate([np.empty(0, np.int64), *c]) for c in (zip(*parts, strict=True) if parts else ((), ())))
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))  # never above the node itself
    while len(x):
        low = np.minimum(root[x], root[y])
        for side in (x, y):
            np.minimum.at(root, root[side], low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(nodes[root], pa.int64())], names=["node", "root"])


def _roots(edges: DataFrame) -> DataFrame:
    """:func:`components` of these edges, in one task where they are few: the steps of the other way are some dozens of jobs, whose plans the driver keeps."""
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "near-edges")
    if edges.count() > EDGES_IN_A_TASK:
        return components(edges)
    return map_arrow(edges.coalesce(1), _connected, "node long, root long")


def _still_open(shared: DataFrame, edges: DataFrame) -> DataFrame:
    """The postings (key, fp) with entries of different components, each entry with its root."""
    roots = stage(_roots(edges), "near-first-roots").withColumnRenamed("node", "fp")
    named = shared.select("key", "fp").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    split = named.groupBy("key").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).where("_lo <> _hi").select("key")
    return stage(named.join(split, "key"), "near-open")


def link_similar(distinct: DataFrame, docs: DataFrame, width: int, similarity: float, block: int = 128) -> DataFrame:
    """Edges a, b between entries (fp, row_key, n_shingles, prefix, profile, coarse) of ``docs`` that connect all those whose shingle similarity is high enough.

    First every entry is compared with two heads: of the smallest entries of its postings, the one with which it shares most postings, and the smallest.
    That gathers a group of near copies with few comparisons, whatever its size. Then all entries of one
    posting that are not connected yet are compared, whatever the posting's length: short postings whole; long ones block by block, twice within blocks (dealt
    anew the second time, which connects large groups), then those that are open still between all blocks. Tasks tell the edges of spanning forests only.
    """
    keys = map_arrow(distinct.select("fp", "prefix"), _prefix_keys, "fp long, key long")
    shared = keys.repartition("key").sortWithinPartitions("key", "fp")
    shared = stage(map_arrow(shared, _shared_postings, "key long, fp long, head long", batch_rows=20000), "near-postings")
    # The tally of shared shingles says which head is nearest; the smallest head is the one that a whole group has in common.
    tally = shared.where("fp <> head").groupBy("fp", "head").agg(F.count("*").alias("n"))
    heads = tally.groupBy("fp").agg(F.max_by("head", F.struct("n", "head")).alias("near"), F.min("head").alias("low"))
    pairs = heads.select(F.explode(F.array_distinct(F.array("near", "low"))).alias("a"), F.col("fp").alias("b"))
    edges = _verified(pairs, distinct, docs, width, similarity)
    left = _still_open(shared, edges)
    # A pair is told under the least key that both have, of those open at first: short postings are done in the first turn, long ones stay until all their blocks have met.
    entries = distinct.select("fp", F.col("n_shingles").alias("n"), "coarse").join(_least_keys(left), "fp")
    entries = stage(entries, "near-entries")
    within = lambda blocks: blocks.select("key", F.col("at").alias("xat"), F.col("at").alias("yat"), "xs")
    long = None
    for turn in range(3):
        # Within blocks dealt anew, pairs are told under any key: the more of a large group's entries meet.
        blocks = _blocks(left, entries.withColumn("least", F.array().cast("array<long>")) if turn == 1 else entries, block, turn, pure=turn == 2)
        rows = within(blocks) if turn < 2 else _met(blocks)
        edges = edges.unionByName(_links_within(rows, left, distinct, docs, width, similarity))
        if turn == 0:
            long = stage(blocks.where("not single").select("key").distinct(), "near-long-keys")
        if turn == 2 or long.isEmpty():
            break
        left = _still_open(shared.join(long, "key"), edges)
        if left.isEmpty():
            break
    return edges


def _groups(docs: DataFrame, width: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """doc_id, row_key and fp of every row of ``docs`` (with row_key), and fp, n (its rows), first (its first row, by doc_id, null ones last) and root."""
    common = common_shingles(docs, width)
    rows = map_arrow(docs.select(F.col("doc_id").cast("long"), "row_key", "text"), _entries(width, similarity, common), "doc_id long, row_key long, fp long, n_shingles long, prefix binary, profile binary, coarse binary")
    rows = stage(rows, "near")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("first")
    by_fp = stage(rows.groupBy("fp").agg(first, F.count("*").alias("n")), "near-distinct")
    chosen = by_fp.select("fp", F.col("first.row_key").alias("row_key"))
    once = rows.join(chosen, ["fp", "row_key"]).dropDuplicates(["fp", "row_key"])
    distinct = stage(once.select("fp", "row_key", "n_shingles", "prefix", "profile", "coarse"), "near-one")
    roots = stage(_roots(link_similar(distinct, docs, width, similarity)), "near-roots")
    named = by_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return rows.select("doc_id", "row_key", "fp"), stage(named, "near-named")


def near_duplicate_groups(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id and group_id (the smallest doc_id of the group) of every row: groups are connected by pairs with a shingle similarity of at least ``similarity``."""
    rows, named = _groups(docs.select("doc_id", "text", row_key(docs)), width, similarity)
    tops = named.groupBy("root").agg(F.min("first.doc_id").alias("group_id"), F.count("*").alias("_m"))
    table = stage(skew_join(named, stage(tops, "near-tops"), ["root"], "_m", named.count()).select("fp", "n", "group_id"), "near-table")
    total = named.agg(F.sum("n")).first()[0] or 0
    return skew_join(rows, table, ["fp"], "n", total).select("doc_id", "group_id")


def drop_near_duplicates(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group: that with the smallest doc_id (null ids last), then row key.

    Rows are told apart by all their columns (maps aside), so rows that share a doc_id are judged each. Of wholly equal rows one stays.
    """
    keyed = docs.withColumn("row_key", row_key(docs)) if "row_key" not in docs.columns else None
    if keyed is None:  # the name is taken
        return drop_near_duplicates(docs.withColumnRenamed("row_key", "_row_key"), width, similarity).withColumnRenamed("_row_key", "row_key")
    rows, named = _groups(keyed.select("doc_id", "text", "row_key"), width, similarity)
    kept = named.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row_key").alias("row_key"))
    kept = stage(kept, "near-kept")
    counts = rows.groupBy("row_key").agg(F.count("*").alias("n")).join(kept.withColumn("_kept", F.lit(True)), "row_key", "left")
    counts = stage(counts.where("_kept is null or n > 1").select("row_key", F.coalesce("_kept", F.lit(False)).alias("again")), "near-dropped")
    out = _chosen(keyed, counts.select("row_key"), "left_anti")
    again = counts.where("again").select("row_key")
    if not again.isEmpty():  # of rows that are equal in all columns, one
        out = out.unionByName(_chosen(keyed, again, "left_semi").dropDuplicates(["row_key"]))
    return out.select(*docs.columns)


def op9_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
