"""Structured Streaming forms: redaction, deduplication and counts with watermarks, and the stateful pairing of calls with outputs."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.text import FATAL_SECRET, redacted
from millrace.operators.corpus import MIN_CHARS
from millrace.shipping import ship


def clean_stream(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Stateless corpus cleaning: short texts and private keys go, secrets are redacted."""
    kept = docs.where((F.length("text") >= min_chars) & ~F.col("text").rlike(FATAL_SECRET))
    done = kept.withColumn("_r", redacted("text"))
    return done.withColumn("n_redactions", F.col("_r.n")).withColumn("text", F.col("_r.text")).drop("_r")


def first_of_content_stream(docs: DataFrame, time: str, delay: str = "1 hour") -> DataFrame:
    """The first arrival of each content within the watermark: the state holds hashes, not texts."""
    return docs.withColumn("content_md5", F.md5("text")).withWatermark(time, delay).dropDuplicatesWithinWatermark(["content_md5"])


def tool_counts(events: DataFrame, time: str, tool: str, window: str = "10 minutes", delay: str = "10 minutes") -> DataFrame:
    """Calls per tool and tumbling window; late rows within the delay still count."""
    return events.withWatermark(time, delay).groupBy(F.window(time, window).alias("w"), tool).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), tool, "n")


_PAIR = "session string, call_pos long, output_pos long"


def _pairing(idle_ms: int):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        session = key[0]
        pending: dict[str, int] = json.loads(state.get[0]) if state.exists else {}
        if state.hasTimedOut:
            state.remove()
            yield _frame([(session, p, None) for p in pending.values()])
            return
        rows: list[tuple] = []
        for row in pd.concat(frames).sort_values("pos").itertuples():
            name = row.call_id or None
            if row.kind == "call":
                if name is None:
                    rows.append((session, row.pos, None))
                else:
                    if name in pending:  # its place is taken, so it stays without an output
                        rows.append((session, pending[name], None))
                    pending[name] = int(row.pos)
            elif row.kind == "output":
                rows.append((session, pending.pop(name, None) if name else None, row.pos))
        state.update((json.dumps(pending),))
        if idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield _frame(rows)

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["session", "call_pos", "output_pos"]).astype({"call_pos": "Int64", "output_pos": "Int64"})


def pair_calls_stream(events: DataFrame, idle_ms: int = 0) -> DataFrame:
    """Events (session, pos, kind, call_id) to pairs as outputs arrive.

    With ``idle_ms``, the open calls of a session without traffic for so long are emitted alone (such a query keeps running batches); without, they wait. Within
    a session events must arrive in order across batches; the state is one number per open call.
    """
    ship(events.sparkSession)
    rows = events.select(F.col("session").cast("string").alias("session"), F.col("pos").cast("long").alias("pos"), "kind", F.col("call_id").cast("string").alias("call_id"))
    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout
    return rows.groupBy("session").applyInPandasWithState(_pairing(idle_ms), _PAIR, "pending string", "append", timeout)
