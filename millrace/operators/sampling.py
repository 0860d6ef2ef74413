"""Deterministic shuffles, samples and group holdouts: the order is that of the MD5 of seed and key, so any engine gives the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shuffle_key(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    return df.orderBy(shuffle_key(F.col(key), seed), key).limit(n)


def holdout_groups(df: DataFrame, group: str, fraction: float, seed: int) -> DataFrame:
    """One row per group with held_out: at least one group, at most ``fraction`` of them."""
    groups = df.where(F.col(group).isNotNull()).select(group).distinct()
    groups = groups.withColumn("_o", shuffle_key(F.col(group), seed)).withColumn("_b", F.substring("_o", 1, 3))
    # Ranks from the counts of 4096 ranges of the order and the rank within a range, so no task sees all groups.
    counts = groups.groupBy("_b").agg(F.count("*").alias("_n"))
    base = counts.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_base"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_o", group))
    ranked = groups.withColumn("_k", inside).join(F.broadcast(base), "_b")
    return ranked.select(group, (F.col("_base") + F.col("_k") <= F.greatest(F.lit(1), F.floor(F.col("_all") * fraction))).alias("held_out"))
