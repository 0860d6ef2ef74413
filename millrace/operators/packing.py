"""Concatenate-and-cut packing: token rows in batches, cut to blocks of a fixed length, each batch's rest dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.staging import stage

BATCH_ROWS = 1000


def with_batch(rows: DataFrame, order: str, batch: int = BATCH_ROWS) -> DataFrame:
    """``_batch``: rows in groups of ``batch`` by the global order. Rows of equal order are ranked by all their values.

    The global row number needs no single task: rows are range-partitioned by the order and written with their partition's number, so it is the
    same however often it is read. Of what was written only the partitions' counts meet.
    """
    parts = stage(rows.repartitionByRange(F.col(order)).withColumn("_p", F.spark_partition_id()), "ordered")
    counts = parts.groupBy("_p").agg(F.count("*").alias("_n"))
    base = counts.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_base"))
    k = F.row_number().over(Window.partitionBy("_p").orderBy(order, *[c for c in rows.columns if c != order]))
    return parts.withColumn("_k", k).join(base, "_p").withColumn("_batch", F.floor((F.col("_base") + F.col("_k") - 1) / batch)).drop("_p", "_k", "_base")


def offsets(rows: DataFrame, order: str, length: str, batch: int = BATCH_ROWS) -> DataFrame:
    """Each row's first and end token place within its batch (``length`` counts its end token)."""
    w = Window.partitionBy("_batch").orderBy(order)
    out = with_batch(rows, order, batch).withColumn("_end", F.sum(length).over(w))
    return out.withColumn("_start", F.col("_end") - F.col(length))


def pack_plan(rows: DataFrame, order: str, length: str, block: int, batch: int = BATCH_ROWS) -> DataFrame:
    """Which part of which row goes to which block, without touching tokens: batch, block, row, from, n, place in the block. Orders must be unique."""
    placed = offsets(rows, order, length, batch)
    placed = placed.withColumn("_total", F.sum(length).over(Window.partitionBy("_batch"))).where(F.col(length) > 0)
    full = F.floor(F.col("_total") / block)
    rows_ = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("_start") / block), F.floor((F.col("_end") - 1) / block)))).where(F.col("block") < full)
    low = F.greatest(F.col("_start"), F.col("block") * block)
    high = F.least(F.col("_end"), (F.col("block") + 1) * block)
    return rows_.select(F.col("_batch").alias("batch"), "block", order, (low - F.col("_start")).alias("from_token"), (high - low).alias("n_tokens"), (low - F.col("block") * block).alias("place"))


def pack_sequences(rows: DataFrame, order: str, ids: str, block: int, end_id: int, batch: int = BATCH_ROWS) -> DataFrame:
    """batch, block, input_ids, attention_mask: blocks of exactly ``block`` ids."""
    closed = rows.select(order, F.concat(F.col(ids), F.array(F.lit(end_id))).alias("_ids")).withColumn("_len", F.size("_ids").cast("long"))
    plan = pack_plan(closed.select(order, "_len"), order, "_len", block, batch)
    cut = plan.join(closed.select(order, "_ids"), order)
    piece = F.slice("_ids", (F.col("from_token") + 1).cast("int"), F.col("n_tokens").cast("int"))
    out = cut.groupBy("batch", "block").agg(F.array_sort(F.collect_list(F.struct("place", piece.alias("ids")))).alias("_p"))
    out = out.withColumn("input_ids", F.flatten(F.transform("_p", lambda x: x["ids"]))).drop("_p")
    return out.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))


def pack_stats(n_rows: int, n_blocks: int, epochs: int, batch_size: int, accumulate: int) -> tuple[float, int]:
    """The packing ratio and the expected optimiser steps."""
    return n_rows / max(n_blocks, 1), n_blocks * epochs // (batch_size * accumulate)
