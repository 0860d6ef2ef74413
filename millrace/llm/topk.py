"""Operator 6: exact top-k inner products by columnar branch-and-bound.

Candidates lie in vertical layout (one row of an array per dimension). Scores of a block of queries are accumulated dimension block by
dimension block. After each, the mass that remains (the Cauchy-Schwarz bound on the dimensions to come) says which candidates can still
reach a query's k-th best score; the rest are compacted away, first whole candidates, then single pairs. All arithmetic
is exact in integers held by float64 (checked), ties go to the smaller id.

Queries go in blocks of at most BLOCK rows. Such a block, of a known size, is sent to the tasks; each task scans its candidates and
returns its best k for each query, and a ranking over these gives the result. So every block is one pass over the table, and nothing grows on the driver.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part; shorter vectors count as padded with
zeros; an empty vector scores 0 with all; rows with a null vec_id take no part; each row of a repeated vec_id is a query of its own, and a candidate of the others; a component
that isn't finite any more once it is scaled counts as not finite; blocks whose sums could reach 2**53 take an exact, slower path, and a score beyond 64 bits fails; very long
vectors are just wide (a block of queries is sent whole); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm._common import map_arrow, stage

SCALE = 1024.0
BLOCK = 4096
CHUNK = 4096
DIMS = 16
_SAFE = float(1 << 53)
RESULT = "query_key long, query_id long, vec_id long, score long, own long"


def scaled(vector: Column) -> Column:
    """floor(1024 x) of each component as doubles, or null if the vector takes no part."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * SCALE) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(doubles, lambda x: F.call_function("rint", x * SCALE) - F.when(F.call_function("rint", x * SCALE) > x * SCALE, 1.0).otherwise(0.0)))


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows padded with zeros to ``width``."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(np.asarray(vectors.offsets))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(vectors), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class TopK:
    """The k best candidates so far of each query (rows of ``queries``)."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int):
        self.keys, self.ids, self.q, self.k = keys, ids, queries, k
        n, self.width = queries.shape
        self.score = np.full((n, k), -np.inf)
        self.vec = np.full((n, k), np.iinfo(np.int64).max)
        self.count = np.zeros(n, np.int64)
        self.largest, self.exact = float(np.abs(queries).max(initial=0.0)), True
        self.rest_q = self._rest(queries)

    def _rest(self, x: np.ndarray) -> np.ndarray:
        """Norms of what follows each dimension block, a little enlarged against rounding: (blocks, rows)."""
        ends = range(DIMS, self.width + DIMS, DIMS)
        return np.array([np.sqrt((x[:, e:] ** 2).sum(axis=1)) * (1 + 1e-9) for e in ends]).reshape(len(ends), len(x))

    def add(self, vec_ids: np.ndarray, rows: np.ndarray) -> None:
        if not self.width:
            self._merge_all(vec_ids, np.zeros((len(self.q), len(rows))))
        elif not self.exact or self.largest * float(np.abs(rows).max(initial=0.0)) * self.width >= _SAFE:
            self._slow(vec_ids, rows)
        else:
            columns, rest_x = np.ascontiguousarray(rows.T), self._rest(rows)
            for at in range(0, len(self.q), 256):
                self._bound(slice(at, at + 256), vec_ids, columns, rest_x)

    def _bound(self, part: slice, vec_ids: np.ndarray, columns: np.ndarray, rest_x: np.ndarray) -> None:
        q, floor = self.q[part], self.score[part, -1]
        live = np.arange(columns.shape[1])
        total = np.zeros((len(q), len(live)))
        pairs = None
        for b, s in enumerate(range(0, self.width, DIMS)):
            dims = slice(s, s + DIMS)
            if pairs is None:
                total += q[:, dims] @ (columns[dims] if len(live) == columns.shape[1] else columns[dims][:, live])
                keep = total + self.rest_q[b, part][:, None] * rest_x[b, live] >= floor[:, None]
                alive = keep.any(axis=0)
                if keep.mean() < 0.05:
                    qi, xi = np.nonzero(keep)
                    pairs = qi, live[xi], total[qi, xi]
                elif alive.mean() < 0.7:
                    live, total = live[alive], total[:, alive]
            else:
                qi, xi, t = pairs
                t = t + np.einsum("ij,ij->i", q[qi, dims], columns[dims][:, xi].T)
                keep = t + self.rest_q[b, part][qi] * rest_x[b, xi] >= floor[qi]
                pairs = qi[keep], xi[keep], t[keep]
        if pairs is None:
            qi, xi = np.nonzero(total >= floor[:, None])
            pairs = qi, live[xi], total[qi, xi]
        self._merge(part.start, vec_ids, *pairs)

    def _merge(self, base: int, vec_ids: np.ndarray, qi: np.ndarray, xi: np.ndarray, t: np.ndarray) -> None:
        ids = vec_ids[xi]
        order = np.lexsort((ids, -t, qi))
        qi, ids, t = qi[order], ids[order], t[order]
        for q, s, e in zip(*self._groups(qi), strict=True):
            e = min(e, s + self.k)
            row = base + q
            c = self.count[row]
            score, vec = np.concatenate([self.score[row, :c], t[s:e]]), np.concatenate([self.vec[row, :c], ids[s:e]])
            best = np.lexsort((vec, -score))[: self.k]
            self.count[row] = len(best)
            self.score[row, : len(best)], self.vec[row, : len(best)] = score[best], vec[best]

    @staticmethod
    def _groups(sorted_: np.ndarray) -> tuple[list[int], list[int], list[int]]:
        starts = np.flatnonzero(np.diff(sorted_, prepend=-1)) if len(sorted_) else np.empty(0, np.int64)
        return sorted_[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(sorted_)] if len(starts) else []

    def _merge_all(self, vec_ids: np.ndarray, total: np.ndarray) -> None:
        qi, xi = np.nonzero(np.ones(total.shape, bool))
        self._merge(0, vec_ids, qi, xi, total[qi, xi])

    def _slow(self, vec_ids: np.ndarray, rows: np.ndarray) -> None:
        """Python integers; scores stay objects from here on, so no digit is lost."""
        whole = np.vectorize(int, otypes=[object])
        self.score, self.exact = self.score.astype(object), False
        cols = whole(rows)
        for at, q in enumerate(whole(self.q)):
            self._merge(at, vec_ids, np.zeros(len(rows), np.int64), np.arange(len(rows)), (cols * q).sum(axis=1))

    def rows(self) -> pa.RecordBatch:
        has = np.arange(self.k)[None, :] < self.count[:, None]
        n = self.count
        score = pa.array([int(x) for x in self.score[has]], pa.int64())
        own = np.array([sum(int(x) ** 2 for x in q) for q in self.q], object)
        own = pa.array([int(x) if x < 1 << 63 else None for x in np.repeat(own, n)], pa.int64())
        return pa.record_batch([pa.array(np.repeat(self.keys, n)), pa.array(np.repeat(self.ids, n)), pa.array(self.vec[has]), score, own], names=["query_key", "query_id", "vec_id", "score", "own"])


def _scan(keys: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, width = TopK(keys, ids, queries, k), queries.shape[1]
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                best.add(part.column("vec_id").to_numpy(), matrix(part.column("v"), width))
        yield best.rows()

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the ``k`` best of all rows but itself.

    A query row is a candidate of its own with a known score, so each scan keeps one more, and one row of that id and score is taken out at the end.
    """
    spark = vectors.sparkSession
    rows = stage(vectors.select(F.col("vec_id").cast("long"), scaled(F.col("embedding")).alias("v")).where("vec_id is not null and v is not null"), "vectors")
    width, n = rows.agg(F.max(F.size("v")), F.count(F.when(is_query, 1))).first()
    asked = rows.where(is_query).groupBy("vec_id", "v").agg(F.count("*").alias("_n")).withColumn("_k", F.xxhash64("vec_id", "v"))
    blocks = max(1, -(-2 * n // block))  # of about half the size, so that none is much larger than block
    asked = stage(asked.withColumn("_b", F.pmod("_k", F.lit(blocks))), "queries")
    found = []
    for b in range(blocks if n else 0):
        mine = asked.where(F.col("_b") == b).select("_k", "vec_id", "v").toArrow().combine_chunks()
        if mine.num_rows:
            keys, ids = mine.column("_k").to_numpy(), mine.column("vec_id").to_numpy()
            found.append(stage(map_arrow(rows, _scan(keys, ids, matrix(mine.column("v").combine_chunks(), width), k + 1), RESULT), "topk-block"))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    every = found[0]
    for f in found[1:]:
        every = every.unionAll(f)
    w = Window.partitionBy("query_key", "query_id").orderBy(F.desc("score"), "vec_id", F.col("_self").cast("int"))
    ranked = every.withColumn("_self", (F.col("vec_id") == F.col("query_id")) & F.col("score").eqNullSafe(F.col("own")))
    ranked = ranked.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k + 1)
    at = F.min(F.when(F.col("_self"), F.col("rank"))).over(Window.partitionBy("query_key", "query_id"))
    ranked = ranked.withColumn("_at", at).where(F.col("_at").isNull() | (F.col("rank") != F.col("_at")))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") > F.col("_at"), F.col("rank") - 1).otherwise(F.col("rank")).cast("int")).where(F.col("rank") <= k)
    again = asked.where("_n > 1").select(F.col("_k").alias("query_key"), F.col("vec_id").alias("query_id"), "_n")  # equal query rows have equal rankings
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("_n", F.lit(1))))
    return ranked.join(again, ["query_key", "query_id"], "left").select("query_id", "rank", "vec_id", "score", times.alias("_t")).drop("_t")


def op6_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


#: DuckDB, for tables without nulls in vectors.
OP6_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.r <> c.r
), r AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 10
"""
