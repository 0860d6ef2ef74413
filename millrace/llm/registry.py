"""The llm queries and their SQL, for the entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.decontam import op10_query
from millrace.llm.langid import op7_query
from millrace.llm.licences import op3_query, op3_sql
from millrace.llm.packing import op2_query
from millrace.llm.pii import op4_query
from millrace.llm.simhash import op9_query
from millrace.llm.token_store import op8_query
from millrace.llm.topk import OP6_SQL, op6_query
from millrace.llm.urls import op5_query
from millrace.llm.warc import OP1_SQL, op1_query

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_roundtrip": op1_query,
    "op2_best_fit_packing": op2_query,
    "op3_licence_scan": op3_query,
    "op4_pii_spans": op4_query,
    "op5_url_verdicts": op5_query,
    "op6_exact_topk": op6_query,
    "op7_language_id": op7_query,
    "op8_token_store": op8_query,
    "op9_simhash_components": op9_query,
    "op10_decontamination": op10_query,
}

SQL = {"op1_warc_roundtrip": OP1_SQL, "op3_licence_scan": op3_sql(), "op6_exact_topk": OP6_SQL}
