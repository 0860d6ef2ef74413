"""Whole examples from one tool-call format to another: every message of a row, or the row goes, with its reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import codecs
from millrace.functions.text import strip
from millrace.operators.conversations import merge_system

REASON_CHARS = 60


def convert_examples(rows: DataFrame, row_id: str, target: str | None = None, tool: str | None = None) -> DataFrame:
    """Rows with ``messages`` in the marker format to the native one.

    Assistant messages are re-encoded, tool results unwrapped, system messages merged, empty messages dropped. ``target`` is one more assistant text; its
    first call's name replaces ``tool``. Adds n_calls, n_double, n_non_dict and drop_reason (null for rows that convert).
    """
    said = rows.select(row_id, F.posexplode("messages").alias("_p", "_m")).select(row_id, "_p", F.col("_m.role").alias("role"), F.coalesce("_m.content", F.lit("")).alias("content"))
    if target:
        said = said.unionByName(rows.select(row_id, F.lit(2**31 - 1).alias("_p"), F.lit("assistant").alias("role"), F.coalesce(target, F.lit("")).alias("content")))
    talk = said.where("role = 'assistant'").withColumn("_r", codecs.reencode_native(F.col("content")))
    talk = talk.select(row_id, "_p", "role", F.col("_r.text").alias("content"), "_r.n_calls", "_r.n_double", "_r.n_non_dict", "_r.error")
    zero = {c: F.lit(0).cast("long") for c in ("n_calls", "n_double", "n_non_dict")}
    rest = said.where("role is null or role <> 'assistant'").withColumn("content", F.when(F.col("role") == "tool", codecs.unwrap_result(F.col("content"))).when(F.col("role") == "system", strip("content")).otherwise(F.col("content")))
    every = talk.unionByName(rest.withColumns(zero).withColumn("error", F.lit(None).cast("string")))
    item = F.struct("_p", "role", "content")
    done = every.groupBy(row_id).agg(
        F.array_sort(F.collect_list(item)).alias("_l"),
        *[F.sum(c).alias(c) for c in zero],
        F.left(F.min_by("error", F.when(F.col("error").isNotNull(), F.col("_p"))), F.lit(REASON_CHARS)).alias("drop_reason"),
    )
    plain = lambda xs: F.transform(xs, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    last = 2**31 - 1
    done = done.withColumn("messages", merge_system(plain(F.filter("_l", lambda x: x["_p"] != last))))
    own = [c for c in rows.columns if c not in ("messages", target)]
    if target:
        done = done.withColumn(target, F.element_at(F.filter("_l", lambda x: x["_p"] == last), 1)["content"])
    out = rows.select(own).join(done.drop("_l"), row_id)
    if target and tool:
        out = out.withColumn(tool, F.coalesce(codecs.first_call_name(F.col(target)), F.col(tool)))
    return out


def reasons(converted: DataFrame, most: int = 10) -> DataFrame:
    """The most frequent reasons for dropped rows."""
    return converted.where("drop_reason is not null").groupBy("drop_reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "drop_reason").limit(most)
