"""Operator 2: best-fit packing with large-item matching.

Lengths are small integers, so the packing is planned over the histogram of lengths: at most ``capacity`` numbers, whatever the corpus' size. Pieces above a third
of the capacity go at most two to a sequence; a greedy matching gives each, from the largest down, the largest
partner that fits. Smaller pieces then best-fit the gaps, from the largest down. The plan is a
list of slots (a length, a range of ranks among the pieces of that length, the sequences they go to); every piece finds its slot by its
rank, which is counted in parallel. So the packing is global, deterministic and never gathers pieces.

Defined cases: a null text is empty and packs as its end id alone; repeated rows are pieces of their own; an empty table gives no
rows; further columns are ignored; only documents longer than ``capacity`` are cut, a very long one into many pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm._common import map_arrow, stage
from millrace.llm.tokenizing import encoder, text_slices

#: Up to so many slots (48 bytes each) are broadcast.
BROADCAST_SLOTS = 200_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(tokenizer: str, cut: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, cut, most_units=500_000)
        for batch in batches:
            doc_ids, at = batch.column("doc_id"), 0
            for texts in text_slices(batch.column("text").to_pylist()):
                ids, sizes = enc.encode(texts, end_id)
                rows = []
                begin = 0
                data = memoryview(ids.astype("<u4").tobytes())
                for k, n in enumerate(sizes.tolist()):
                    for p, s in enumerate(range(0, n, capacity)):
                        e = min(n, s + capacity)
                        rows.append((at + k, p, s, e - s, zlib.crc32(data[4 * (begin + s) : 4 * (begin + e)])))
                    begin += n
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
                yield pa.record_batch(
                    [doc_ids.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[2:]]],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
                at += len(texts)

    return run


def cut_pieces(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 0, capacity: int = 2048, cut: str = "white") -> DataFrame:
    """One row per piece of each document's ids (``end_id`` appended)."""
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _pieces(tokenizer, cut, end_id, capacity), PIECES, encodes=True)


def plan_slots(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first rank, end rank, first sequence, pieces per sequence, offset).

    Piece r of a slot goes to sequence first + (r - first rank) // per, at offset + ((r - first rank) % per) * length.
    """
    left = {n: c for n, c in histogram.items() if c}
    placed = dict.fromkeys(left, 0)
    slots: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # free ids -> (first sequence, count)
    sequences = 0

    def put(n: int, count: int, per: int, first: int, offset: int) -> None:
        slots.append((n, placed[n], placed[n] + count, first, per, offset))
        placed[n] += count
        left[n] -= count

    def leave(gap: int, first: int, count: int) -> None:
        if count:
            gaps.setdefault(gap, []).append((first, count))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        b = next((n for n in reversed(large) if n + a <= capacity and (left[n] > 1 if n == a else left[n])), 0)
        count = min(left[a], left[b]) if b and b != a else left[a] // 2 if b else left[a]
        put(a, count, 1, sequences, 0)
        if b:
            put(b, count, 1, sequences, a)
        leave(capacity - a - b, sequences, count)
        sequences += count
    order = [g for g in gaps if g]
    heapq.heapify(order)
    for n in sorted((n for n in left if left[n]), reverse=True):
        small: list[int] = []
        while order and order[0] < n:  # too small for this length, though not for later ones
            small.append(heapq.heappop(order))
        while left[n]:
            while order and not gaps.get(order[0]):
                heapq.heappop(order)
            gap = order[0] if order else capacity
            first, count = gaps[gap].pop() if order else (sequences, -(-left[n] // (capacity // n)))
            if not order:
                sequences += count
            per = gap // n
            full = min(count, left[n] // per)
            rest = left[n] - full * per if full < count else 0
            rest = min(rest, per)
            offset = capacity - gap
            if full:
                put(n, full * per, per, first, offset)
                _give(gaps, small, order, gap - per * n, n, first, full)
            if rest and full < count:
                put(n, rest, rest, first + full, offset)
                _give(gaps, small, order, gap - rest * n, n, first + full, 1)
                full += 1
            if full < count:
                _give(gaps, small, order, gap, n, first + full, count - full)
        for g in small:
            heapq.heappush(order, g)
    return slots


def _give(gaps: dict[int, list[tuple[int, int]]], small: list[int], order: list[int], gap: int, n: int, first: int, count: int) -> None:
    """Sequences with a new gap: to the heap if the present length fits it, else aside."""
    if gap <= 0:
        return
    if not gaps.get(gap):
        gaps[gap] = []
        if gap >= n:
            heapq.heappush(order, gap)
        elif gap not in small:
            small.append(gap)
    gaps[gap].append((first, count))


def pack_pieces(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (a staged table with doc_id, piece, length, ids_crc32, ...) with sequence_id and offset."""
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    if not histogram:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    planned = plan_slots(histogram, capacity)
    slots = spark.createDataFrame(planned, "length long, r0 long, r1 long, first long, per long, off0 long")
    # Ranks: pieces fall by hash into buckets; counts per bucket and length give where each bucket starts.
    buckets = max(1024, sum(histogram.values()) >> 20)
    rows = pieces.withColumn("_b", F.pmod(F.xxhash64(*[c for c, kind in pieces.dtypes]), F.lit(buckets)))
    counts = rows.groupBy("_b", "length").agg(F.count("*").alias("_n"))
    base = counts.select("_b", "length", (F.sum("_n").over(Window.partitionBy("length").orderBy("_b")) - F.col("_n")).alias("_base"))
    own = Window.partitionBy("_b", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("_k", F.row_number().over(own)).join(base, ["_b", "length"]).withColumn("_r", F.col("_base") + F.col("_k") - 1)
    # The slots' number depends on the lengths alone; it is checked all the same.
    out = ranked.join(F.broadcast(slots) if len(planned) <= BROADCAST_SLOTS else slots, (ranked["length"] == slots["length"]) & (F.col("_r") >= F.col("r0")) & (F.col("_r") < F.col("r1"))).drop(slots["length"])
    step = F.col("_r") - F.col("r0")
    return out.select(
        *pieces.columns,
        (F.col("first") + F.floor(step / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("off0") + step % F.col("per") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 0, capacity: int = 2048, cut: str = "white") -> DataFrame:
    """Tokenise, cut and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack_pieces(stage(cut_pieces(docs, tokenizer, end_id, capacity, cut), "pieces"), capacity)


def op2_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
