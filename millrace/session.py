"""SparkSession settings shared by tests, the benchmark and applications."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.shipping import ship


def build_session(app: str = "millrace", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and skew-join handling. On a cluster leave ``master`` unset."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark
