"""Registration of queries with their SQL, and the bindings of the driver's tables that queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import REDACTION_RULES
from millrace.shipping import ship
from millrace.staging import pieces

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        ship(spark)
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables under a name, with the SQL that gives the same rows."""

    def put(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return f

    return put


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_scrub(x: str) -> str:
    """The redaction chain in DuckDB."""
    for pattern, replacement in REDACTION_RULES:
        x = f"regexp_replace({x}, {quote(pattern)}, {quote(replacement.replace('$1', chr(92) + '1'))}, 'g')"
    return x


def sql_redactions(x: str) -> str:
    """The number of substitutions of the chain in DuckDB."""
    parts = []
    for pattern, replacement in REDACTION_RULES:
        parts.append(f"len(regexp_extract_all({x}, {quote(pattern)}))")
        x = f"regexp_replace({x}, {quote(pattern)}, {quote(replacement.replace('$1', chr(92) + '1'))}, 'g')"
    return "CAST(" + " + ".join(parts) + " AS BIGINT)"


# Commits stand in for orders: a commit's files are the parts of its lines.
SUBJECT_SQL = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'fix(' || lower(c_mktsegment) || '): order ' || o_orderkey WHEN '2-HIGH' THEN 'feat(' || lower(c_mktsegment) || ')!: order ' || o_orderkey "
    "WHEN '3-MEDIUM' THEN 'chore: order ' || o_orderkey WHEN '4-NOT SPECIFIED' THEN 'Merge order ' || o_orderkey ELSE 'plain order ' || o_orderkey END"
)


def subject() -> Column:
    seg, key = F.lower("c_mktsegment"), F.col("o_orderkey").cast("string")
    p = F.col("o_orderpriority")
    return (
        F.when(p == "1-URGENT", F.concat(F.lit("fix("), seg, F.lit("): order "), key))
        .when(p == "2-HIGH", F.concat(F.lit("feat("), seg, F.lit(")!: order "), key))
        .when(p == "3-MEDIUM", F.concat(F.lit("chore: order "), key))
        .when(p == "4-NOT SPECIFIED", F.concat(F.lit("Merge order "), key))
        .otherwise(F.concat(F.lit("plain order "), key))
    )


def touches(t: Tables) -> DataFrame:
    """repo, sha, ts (seconds), file: one repository."""
    n = pieces(t.lineitem, t.orders)
    lines = t.lineitem.select(F.col("l_orderkey").alias("sha"), F.col("l_partkey").alias("file")).repartition(n, "sha").distinct()
    orders = t.orders.select(F.col("o_orderkey").alias("sha"), F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("ts")).repartition(n, "sha").distinct()
    return lines.join(orders, "sha").select(F.lit("main").alias("repo"), "sha", "ts", "file")  # distinct, as both sides are


TOUCHES_SQL = "SELECT DISTINCT 'main' AS repo, l_orderkey AS sha, CAST(epoch(o_orderdate) AS BIGINT) AS ts, l_partkey AS file FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def brand_clusters(t: Tables) -> DataFrame:
    """A determined clustering: parts of small size by brand, the rest without a cluster."""
    return t.part.where("p_size <= 40").select(F.lit("main").alias("repo"), F.col("p_partkey").alias("file"), F.col("p_brand").alias("cluster_id"))


CLUSTERS_SQL = "SELECT 'main' AS repo, p_partkey AS file, p_brand AS cluster_id FROM part WHERE p_size <= 40"
