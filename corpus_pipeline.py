"""A corpus pipeline of five stages over ``documents``. Each stage's result is written as Parquet and reread by the next.

Defined cases, of all stages: rows are judged by their texts, whatever their doc_id (null and repeated ids stay told apart); null and empty texts have no language and go in the first
stage; very long texts are read whole; extra columns, of whatever names, stay up to packing; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontam, langid, packing, pii, simhash
from millrace.staging import delete, scope, scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the language models (trained on a bounded sample of these documents) reject."""
    return langid.drop_rejected(docs, langid.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: 5-word shingles, similarity 0.8 or more."""
    return simhash.drop_near_duplicates(docs, width=5, similarity=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark passage."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by its kind; n_chars follows."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' tokens into sequences of at most 2048."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("pii", redact_pii),
    ("packing", pack),
]

#: Tokenizers and language models are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has staged goes when its result is written, and that when the next one is."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        with scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
