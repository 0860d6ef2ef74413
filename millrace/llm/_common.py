"""Shared plumbing of the llm operators: Arrow functions, row keys and distributed running sums.

Staged tables go under ``spark.checkpoint.dir``, the folder that driver and
executors share (see :mod:`millrace.staging`); skew-proof joins and connected components are those of :mod:`millrace.graph`.
"""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructType
from pyspark.sql.window import Window

from millrace.graph import components, skew_join
from millrace.llm.tokenizing import release
from millrace.shipping import ship
from millrace.staging import scratch, stage

__all__ = ["components", "map_arrow", "row_key", "running_start", "scratch", "skew_join", "stage", "trim"]

def map_arrow(df: DataFrame, function, schema: str, encodes: bool = False, batch_rows: int = 2000, give_back: bool = True) -> DataFrame:
    """``mapInArrow`` with a function of this package, which gets batches of at most ``batch_rows`` rows (texts can be long).

    Spark's own batches are bounded in bytes and rows by the session's settings, which stay as they are. Python workers stay for later stages: one that doesn't encode frees the token caches, and with ``give_back`` free memory goes back when a task ends. While
    the function runs, Python doesn't look for reference cycles, of which it makes none: with large caches that takes a quarter of the time.
    """
    ship(df.sparkSession)

    def run(batches):
        if not encodes:
            release()
        gc.disable()
        try:
            yield from function(b.slice(at, batch_rows) for b in batches for at in range(0, b.num_rows, batch_rows))
        finally:
            gc.enable()
        if give_back:
            trim()

    return df.mapInArrow(run, schema)


def trim() -> None:
    """Give this process's free memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, MapType) or (hasattr(kind, "elementType") and _has_map(kind.elementType))


def row_key(df: DataFrame) -> Column:
    """A 64-bit hash of a row's values in all columns but maps (which Spark doesn't hash), named row_key. Rows of equal values share it."""
    parts = [x for f in df.schema.fields if not _has_map(f.dataType) for x in (F.col(f"`{f.name}`").isNull(), F.col(f"`{f.name}`"))]
    return F.xxhash64(*parts).alias("row_key")


def running_start(df: DataFrame, value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one, by the columns ``_part`` then ``_pos``.

    ``_part`` numbers partitions that follow one another and ``_pos`` orders the rows of one. The
    sums per partition are one row for each, so only those meet in one place.
    """
    sums = df.groupBy("_part").agg(F.sum(value).alias("_sum"))
    base = sums.select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_base"))
    w = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        df.withColumn("_run", F.sum(value).over(w) - F.col(value))
        .join(base, "_part")
        .withColumn(out, (F.col("_run") + F.col("_base")).cast("long"))
        .drop("_run", "_base")
    )
