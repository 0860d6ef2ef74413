"""Operator 8: a content-addressed store of token ids.

Each text's ids (its end id appended) are cut where a rolling hash of the last WINDOW ids says so, so equal passages give equal chunks
wherever they stand. A chunk is addressed by the SHA-256 of its 32-bit ids and stored once. A document's recipe lists its
chunks; the root of a Merkle tree over them is in the recipe, and manifests hold Merkle roots over the recipes of each recipe part and over all
parts. Recipes are in ascending doc_id order.

The folder: ``store`` (Parquet: digest, n, payload = zstd of the n ids, little-endian, of 16 bits or, if one doesn't fit, 32), ``recipes`` (Parquet: doc_id, _part, _pos, n_tokens,
digests, ends, root) and ``manifest`` (Parquet: _part, n_docs, n_tokens, root; part -1 holds the root over the others).

Reading checks every chunk against its address and every root against the manifests. A document's checksum follows from its chunks'
checksums, because CRC-32 is linear: each is carried past the bytes that follow it and all are XORed. So verifying all
documents reads each stored chunk once, and moves no ids.

Defined cases: a null text is empty (its recipe is the end id alone); repeated rows and doc_ids are documents of their own, ordered by doc_id (nulls first), then
root; an empty table gives empty tables; further columns are ignored; a very long text has more chunks, each of bounded size, and its recipe is one row.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm._common import map_arrow, running_start, scratch, skew_join, stage, trim
from millrace.llm.tokenizing import encoder, release, text_slices

WINDOW = 8
_MIX = 0x9E3779B97F4A7C15
_RAW = "kind string, doc_id long, n long, digests binary, ends array<long>, root binary, digest binary, payload binary"
_RAW_ARROW = pa.schema([("kind", pa.string()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digests", pa.binary()), ("ends", pa.list_(pa.int64())), ("root", pa.binary()), ("digest", pa.binary()), ("payload", pa.binary())])
DIGEST = 32


def cut_points(ids: np.ndarray, mean: int) -> np.ndarray:
    """Ends of chunks inside ``ids``: where the polynomial rolling hash of the last WINDOW ids has log2(mean) zero high bits."""
    bits = mean.bit_length() - 1
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(_MIX)
    x ^= x >> np.uint64(29)
    h, base, width = x, 0x100000001B3, 1
    while width < WINDOW:  # WINDOW is a power of two: of two hashes that follow one another, that of both
        h = h[: max(len(h) - width, 0)] * np.uint64(base) + h[width:]
        base, width = base * base % (1 << 64), 2 * width
    h = h * np.uint64(_MIX)
    return np.flatnonzero(h >> np.uint64(64 - bits) == 0) + WINDOW


def chunk_bounds(cuts: np.ndarray, begin: int, end: int, least: int, most: int) -> list[int]:
    """The bounds of one document's chunks: at hash cuts, but no chunk (except a last one) shorter than ``least`` or longer than ``most``."""
    out = [begin]
    for c in [*cuts.tolist(), end]:
        while c - out[-1] > most:
            out.append(out[-1] + most)
        if c - out[-1] >= least and c < end:
            out.append(c)
    if end > out[-1]:
        out.append(end)
    return out


def merkle_root(leaves: list[bytes]) -> bytes:
    """Root of a binary hash tree; an odd last node moves up; leaves and nodes are hashed with different first bytes."""
    level = [hashlib.sha256(b"\0" + x).digest() for x in leaves] or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        pairs = [hashlib.sha256(b"\1" + a + b).digest() for a, b in zip(level[::2], level[1::2], strict=False)]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]


def _encode(tokenizer: str, cut: str, end_id: int, mean: int, least: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, cut, most_units=1_000_000)
        squeeze = zstandard.ZstdCompressor(level=1)
        seen: set[bytes] = set()  # of this task, to send few copies of a common chunk
        for batch in batches:
            doc_ids, at = batch.column("doc_id").to_pylist(), 0
            for ids, sizes in enc.encode_slices(text_slices(batch.column("text").to_pylist()), end_id):
                ids = ids.astype("<u4")
                short = ids.astype("<u2") if len(ids) and ids.max() < 1 << 16 else ids
                rows, begin = [], 0
                cuts = cut_points(ids, mean)  # those within WINDOW ids of a document's start are of two documents
                low = np.searchsorted(cuts, np.cumsum(sizes) - sizes + WINDOW)
                high = np.searchsorted(cuts, np.cumsum(sizes), "right")
                for k, n in enumerate(sizes.tolist()):
                    own = ids[begin : begin + n]
                    bounds = chunk_bounds(cuts[low[k] : high[k]] - begin, 0, n, least, most)
                    digests = []
                    for s, e in zip(bounds, bounds[1:], strict=False):
                        data = own[s:e].tobytes()
                        digests.append(d := hashlib.sha256(data).digest())
                        if d not in seen:
                            if len(seen) > 2_000_000:
                                seen.clear()
                            seen.add(d)
                            rows.append(("chunk", None, e - s, None, None, None, d, squeeze.compress(short[begin + s : begin + e].tobytes())))
                    rows.append(("recipe", doc_ids[at + k], n, b"".join(digests), bounds[1:], merkle_root(digests), None, None))
                    begin += n
                at += len(sizes)
                cols = list(zip(*rows, strict=True)) if rows else [[]] * len(_RAW_ARROW)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, _RAW_ARROW, strict=True)], schema=_RAW_ARROW)

    return run


@F.pandas_udf(T.BooleanType())
def _is_first(digests: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """True for all recipes (null), and of a task's equal chunks for the first. The token caches are done with."""
    if release():
        trim()
    seen: set[bytes] = set()
    for batch in digests:
        keep = []
        for d in batch:
            keep.append(d is None or d not in seen)
            if d is not None:
                seen.add(d)
        yield pd.Series(keep, dtype=bool)


@F.pandas_udf(T.BinaryType())
def _merkle_packed(digests: pd.Series) -> pd.Series:
    return digests.map(lambda b: merkle_root([b[k : k + DIGEST] for k in range(0, len(b), DIGEST)]))


@F.pandas_udf(T.BinaryType())
def _merkle_list(roots: pd.Series) -> pd.Series:
    return roots.map(lambda r: merkle_root([bytes(x) for x in r]))


def write_store(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2, cut: str = "space", mean: int = 2048, least: int = 512, most: int = 16384) -> None:
    """Encode ``docs`` (doc_id, text) and write the folder described above."""
    spark = docs.sparkSession
    raw = map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _encode(tokenizer, cut, end_id, mean, least, most), _RAW, encodes=True, batch_rows=10000, give_back=False)
    # One shuffle brings equal chunks together; recipes, which need no meeting, are spread by their content.
    key = F.coalesce("digest", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digests")).cast("binary"))
    # What is first is not the same below that shuffle, so the filter must stay above it; Python gets the digests alone.
    once = raw.repartition(F.xxhash64(key)).where(_is_first.asNondeterministic()("digest"))
    once.write.option("compression", "uncompressed").parquet(f"{path}/store")
    recipes = spark.read.schema(_RAW).parquet(f"{path}/store").where("kind = 'recipe'")
    recipes = recipes.select("doc_id", F.col("n").alias("n_tokens"), "digests", "ends", "root")
    ordered = recipes.repartitionByRange(F.col("doc_id").asc_nulls_first(), "root").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "root")
    ordered = ordered.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_pos"))
    ordered.write.parquet(f"{path}/recipes")
    _manifest(spark.read.parquet(f"{path}/recipes")).write.parquet(f"{path}/manifest")


def _manifest(recipes: DataFrame) -> DataFrame:
    """Counts and Merkle roots per recipe part (a part is one task's rows), and over the parts."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_pos", "root"))), lambda x: x["root"])
    parts = recipes.groupBy("_part").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), listed.alias("_r"))
    parts = parts.select("_part", "n_docs", "n_tokens", _merkle_list("_r").alias("root"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_part", "root"))), lambda x: x["root"])
    top = parts.agg(F.lit(-1).alias("_part"), F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"), listed.alias("_r"))
    return parts.unionByName(top.select("_part", "n_docs", "n_tokens", _merkle_list("_r").alias("root")))


def _chunk_ids(expand: zstandard.ZstdDecompressor, payload: bytes, n: int) -> np.ndarray:
    """The ``n`` ids of a stored chunk."""
    data = expand.decompress(payload)
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype("<u4", copy=False)


def _check_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        digests, ns, sums = batch.column("digest"), batch.column("n"), []
        for d, n, payload in zip(digests.to_pylist(), ns.to_pylist(), batch.column("payload").to_pylist(), strict=True):
            ids = _chunk_ids(expand, payload, n)
            if len(ids) != n or hashlib.sha256(ids).digest() != d:
                raise ValueError(f"the chunk stored as {d.hex()} has other ids")
            sums.append(zlib.crc32(ids))
        yield pa.record_batch([digests, ns, pa.array(sums, pa.int64())], names=["digest", "n", "crc"])


def _zero_operators() -> list[np.ndarray]:
    """For k = 0, 1, ...: the 32 columns of the matrix that carries a CRC-32 past 2**k zero bytes."""
    column = np.empty(32, np.uint64)
    column[0] = 0xEDB88320
    column[1:] = np.uint64(1) << np.arange(31, dtype=np.uint64)
    for _ in range(3):
        column = _carry(column, column)
    out = []
    for _ in range(44):
        out.append(column)
        column = _carry(column, column)
    return out


def _carry(columns: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = np.zeros_like(crc)
    for b in range(32):
        out ^= ((crc >> np.uint64(b)) & np.uint64(1)) * columns[b]
    return out


@F.pandas_udf(T.LongType())
def _carry_crc(crc: pd.Series, after: pd.Series) -> pd.Series:
    """Each CRC-32 carried past ``after`` bytes."""
    x, n = crc.to_numpy().astype(np.uint64), after.to_numpy().astype(np.uint64)
    for k, columns in enumerate(_zero_operators()):
        on = (n >> np.uint64(k)) & np.uint64(1) == 1
        if on.any():
            x[on] = _carry(columns, x[on])
    return pd.Series(x.astype(np.int64))


def read_recipes(spark: SparkSession, path: str) -> DataFrame:
    """The recipes, checked against the manifests."""
    recipes = spark.read.parquet(f"{path}/recipes")
    again = _manifest(recipes.withColumn("root", _merkle_packed("digests"))).exceptAll(spark.read.parquet(f"{path}/manifest"))
    if not again.isEmpty():
        raise ValueError("the recipes differ from the manifests")
    return recipes


def verify_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the folder: doc_id, start, n_tokens, ids_crc32, from the stored chunks."""
    recipes = running_start(read_recipes(spark, path), "n_tokens", "start")
    chunks = spark.read.schema(_RAW).parquet(f"{path}/store").where("kind = 'chunk'").select("digest", "n", "payload")
    chunks = stage(map_arrow(chunks, _check_chunks, "digest binary, n long, crc long"), "chunk-sums")
    before = lambda i: F.when(i > 0, F.get("ends", i - 1)).otherwise(0)
    parts = F.transform(
        "ends",
        lambda e, i: F.struct(F.substring(F.col("digests"), i * DIGEST + 1, F.lit(DIGEST)).alias("digest"), (e - before(i)).alias("n"), e.alias("end")),
    )
    ends = recipes.select("_pos", "n_tokens", F.explode(parts).alias("_c"))
    ends = ends.select("_pos", F.col("_c.digest").alias("digest"), F.col("_c.n").alias("stated"), (4 * (F.col("n_tokens") - F.col("_c.end"))).alias("after"))
    uses = ends.groupBy("digest").agg(F.count("*").alias("uses"))
    table = stage(chunks.join(uses, "digest"), "chunk-uses")
    total = table.agg(F.sum("uses")).first()[0] or 0
    found = skew_join(ends, table, ["digest"], "uses", total)
    ok = F.col("n") == F.col("stated")
    found = found.withColumn("crc", F.when(ok, F.col("crc")).otherwise(F.raise_error(F.lit("a recipe's chunk is missing or has another length"))))
    sums = found.groupBy("_pos").agg(F.bit_xor(_carry_crc("crc", "after")).alias("ids_crc32"))
    return recipes.select("_pos", "doc_id", "start", "n_tokens").join(sums, "_pos").select("doc_id", "start", "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and its ids, put together from the chunks (this moves the ids of every document)."""
    recipes = read_recipes(spark, path)
    parts = F.transform("ends", lambda e, i: F.substring(F.col("digests"), i * DIGEST + 1, F.lit(DIGEST)))
    wanted = recipes.select("_pos", "doc_id", F.posexplode(parts).alias("i", "digest"))
    chunks = spark.read.schema(_RAW).parquet(f"{path}/store").where("kind = 'chunk'").select("digest", F.struct("n", "payload").alias("stored"))
    uses = wanted.groupBy("digest").agg(F.count("*").alias("uses"))
    table = stage(chunks.join(uses, "digest"), "chunk-payloads")
    joined = skew_join(wanted, table, ["digest"], "uses", table.agg(F.sum("uses")).first()[0] or 0).groupBy("_pos", "doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "stored"))), lambda x: x["stored"]).alias("p"))

    @F.pandas_udf("array<long>")
    def unpack(chunks: pd.Series) -> pd.Series:
        expand = zstandard.ZstdDecompressor()
        return chunks.map(lambda cs: np.concatenate([_chunk_ids(expand, bytes(c["payload"]), c["n"]) for c in cs]).astype(np.int64))

    return joined.select("doc_id", unpack("p").alias("ids"))


def op8_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-store")
    write_store(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return verify_documents(spark, path)
