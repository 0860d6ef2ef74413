"""Joins and connected components that no key, however frequent, makes uneven."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, MapType

from millrace.staging import stage

#: A key is hot when it holds more than 1/HOT_SHARES of the rows, so at most HOT_SHARES keys are hot.
HOT_SHARES = 512


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """Left outer join to ``right``, which has one row per key and in ``weight`` the number of left rows of that key.

    ``total`` is the number of left rows that have a key in ``right`` (or more). Keys above
    ``total / HOT_SHARES`` rows are at most HOT_SHARES, so their rows of ``right`` are broadcast; every other key goes through a shuffle in which no key is
    large. Left rows that were already matched, or have a null key, are spread in that shuffle by a hash of their values (not by their place, which
    may differ when a lost task is run again).
    """
    payload = [c for c in right.columns if c not in keys and c != weight]
    bound = max(total // HOT_SHARES, 1)
    hot = right.where(F.col(weight) > bound).select(*keys, F.struct(*payload, F.lit(True).alias("_hit")).alias("_hot"))
    cold = right.where(F.col(weight) <= bound).select(*keys, F.lit(0).alias("_salt"), *[F.col(c).alias(f"_c_{c}") for c in payload])
    spread = F.pmod(F.xxhash64(*[c for c in left.columns if not isinstance(left.schema[c].dataType, (MapType, BinaryType))]), F.lit(1000003)).cast("int") + 1
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    out = (
        left.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.when(F.col("_hot").isNotNull() | null_key, spread).otherwise(0))
        .join(cold, [*keys, "_salt"], "left")
    )
    return out.select(*left.columns, *[F.coalesce(F.col("_hot")[c], F.col(f"_c_{c}")).alias(c) for c in payload])


def dealt_join(left: DataFrame, right: DataFrame, keys: list[str], n: int, how: str = "inner") -> DataFrame:
    """Inner, left semi or left outer join with both sides in ``n`` parts by the keys, so that a task's share is what ``staging.pieces`` makes it. Null keys never match.

    The keys go as one struct: a key that is the same for all rows would be left out of the join, and the rows be dealt once more.
    """
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    dealt = lambda df: df.select(F.struct(*keys).alias("_key"), *[c for c in df.columns if c not in keys]).repartition(n, "_key")
    out = dealt(left if how == "left" else left.where(known)).join(dealt(right.where(known)), "_key", how)
    return out.select("_key.*", *[c for c in out.columns if c != "_key"])


def _tally(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """Connected components by alternating large-star and small-star steps.

    ``edges``: long columns ``a`` and ``b``. Returns ``node, root`` with root the smallest node of the
    component, for every node that has an edge. Each half step is staged; stars of
    any size are handled through :func:`skew_join`.
    """
    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _tally(e)
    while before[0]:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
        large = skew_join(both, low, ["a"], "n", 2 * before[0]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stage(large.where("a <> b").distinct(), "large-star")
        total = e.count()
        low = e.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = skew_join(e, low, ["a"], "n", total).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        e = stage(small.where("a <> b").distinct(), "small-star")
        after = _tally(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
