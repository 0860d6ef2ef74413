"""Tables written on the way, in the folder that the driver and all executors share (``spark.checkpoint.dir``).

Only where that is unset and Spark runs in one process, as in tests, a local temporary folder is used, which goes when the process ends; on a cluster
that is an error.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: dict[str, str] = {}
_SCOPES: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder of this session."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _OWN_DIR:
            _OWN_DIR[context.applicationId] = tempfile.mkdtemp(prefix="millrace-")
            atexit.register(shutil.rmtree, _OWN_DIR[context.applicationId], ignore_errors=True)
        base = _OWN_DIR[context.applicationId]
    return base.rstrip("/")


def _own(spark: SparkSession) -> str:
    return "/".join([shared_dir(spark), "millrace", spark.sparkContext.applicationId, *_SCOPES])


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{_own(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: this cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A task's share of the files that its rows come from, in bytes.
PIECE = 8 << 20


def pieces(*tables: DataFrame) -> int:
    """In how many parts to deal rows of these tables, so that a task's share stays the same however large they are.

    Adaptive execution only puts parts together, up to 64 MB of compressed rows; a number given to ``repartition`` stays. Tables without files count as small.
    """
    size = 0
    for t in tables:
        leaves = t._jdf.queryExecution().analyzed().collectLeaves()
        sizes = [int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size())]
        size += sum(x for x in sizes if x < 1 << 60)
    return max(tables[0].sparkSession.sparkContext.defaultParallelism, -(-size // PIECE))


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """What is staged within is deleted at the end: results must have been written elsewhere by then."""
    _SCOPES.append(f"scope-{uuid.uuid4().hex}")
    path = _own(spark)
    try:
        yield
    finally:
        _SCOPES.pop()
        delete(spark, path)
