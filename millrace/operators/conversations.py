"""Conversations as one row per turn: windows, examples, islands, call pairing, statistics.

Every operator works on rows with a conversation id and an order column; nothing relies on row order. Examples are arrays of (role, content) built by
ordered aggregation, one row per window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.text import is_blank, strip, token_estimate

# Fixed values.
MAX_CONTEXT_TURNS = 40
MIN_WINDOW_TURNS = 3
MIN_MESSAGES = 4
TOKEN_BUDGET = 8000
TOOL_OPEN = "\n[TOOL_CALL]"
SYSTEM_AGENTIC = "You are an expert coding assistant with access to tools. You help with software engineering tasks by reading code, running commands, editing files, and making decisions. You are precise, thorough, and follow existing code conventions. You use tools efficiently and explain your reasoning concisely."
SYSTEM_INSTRUCTION = "You are an expert software engineer and technical advisor. You provide clear, accurate, and practical guidance on architecture, code quality, debugging, and development workflows."


def request_windows(turns: DataFrame, conv: str = "conv_id", pos: str = "turn", role: str = "role", max_turns: int = MAX_CONTEXT_TURNS, min_turns: int = MIN_WINDOW_TURNS) -> DataFrame:
    """Turns with window_id (from 0): windows start at user turns.

    A conversation of at most ``max_turns`` that starts with a user turn is one window. Else each user turn
    opens a window up to the next one, cut at ``max_turns``; windows of fewer than ``min_turns`` go, as do turns before the first user turn. A conversation is ranked
    in one task, so the largest conversation bounds a task (its rows are spilled, not held).
    """
    ordered = Window.partitionBy(conv).orderBy(pos)
    whole = Window.partitionBy(conv)
    marked = (
        turns.withColumn("_req", F.sum((F.col(role) == "user").cast("int")).over(ordered))
        .withColumn("_n", F.count("*").over(whole))
        .withColumn("_first", F.first(role).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    single = (F.col("_n") <= max_turns) & (F.col("_first") == "user")
    marked = marked.withColumn("window_id", F.when(single, 0).otherwise(F.col("_req") - 1).cast("long")).where("window_id >= 0").withColumn("_single", single)
    inside = Window.partitionBy(conv, "window_id")
    marked = marked.withColumn("_k", F.row_number().over(inside.orderBy(pos))).where(F.col("_k") <= max_turns)
    marked = marked.withColumn("_size", F.count("*").over(inside)).where(F.col("_single") | (F.col("_size") >= min_turns))
    return marked.drop("_req", "_n", "_first", "_single", "_k", "_size")


def messages_of(rows: DataFrame, keys: list[str], pos: str, role: Column, content: Column, system: Column | None = None) -> DataFrame:
    """One row per ``keys`` with messages: an array of (role, content) in order, after an optional system message."""
    item = F.struct(F.col(pos).alias("p"), role.alias("role"), content.alias("content"))
    out = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_m"), *([F.first(system, True).alias("_s")] if system is not None else []))
    body = F.transform("_m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    if system is not None:
        body = F.concat(F.array(F.struct(F.lit("system").alias("role"), F.col("_s").alias("content"))), body)
    return out.select(*keys, body.alias("messages"))


def chars_of(messages: Column) -> Column:
    return F.aggregate(messages, F.lit(0), lambda a, m: a + F.length(m["content"]))


def instruction_examples(windows: DataFrame, conv: str = "conv_id", pos: str = "turn", text: str = "text", budget: int = TOKEN_BUDGET) -> DataFrame:
    """User and assistant texts under the instruction prompt; turns with tool calls and blank turns are left out."""
    rows = windows.where(F.col("role").isin("user", "assistant") & ~is_blank(text) & ~F.contains(F.col(text), F.lit(TOOL_OPEN)))
    out = messages_of(rows, [conv, "window_id"], pos, F.col("role"), F.col(text), F.lit(SYSTEM_INSTRUCTION))
    has = lambda r: F.exists("messages", lambda m: m["role"] == r)
    out = out.where((F.size("messages") >= MIN_MESSAGES) & has("user") & has("assistant"))
    return out.withColumn("token_estimate", token_estimate(chars_of(F.col("messages")))).where(F.col("token_estimate") <= budget)


def agentic_examples(turns: DataFrame, keys: list[str], pos: str, directory: Column | None = None, budget: int = TOKEN_BUDGET) -> DataFrame:
    """Rows (role, content already rendered with markers) to agentic examples with one system message.

    Needs a tool call and four messages. ``tool_result`` turns take the role tool.
    """
    system = F.lit(SYSTEM_AGENTIC)
    if directory is not None:
        system = F.when(F.coalesce(directory, F.lit("")) == "", system).otherwise(F.concat(system, F.lit("\n\nWorking directory: "), directory))
    role = F.when(F.col("role") == "tool_result", "tool").otherwise(F.col("role"))
    rows = turns.where(F.col("role").isin("user", "assistant", "tool_result") & ((F.col("role") == "tool_result") | ~is_blank("content")))
    out = messages_of(rows, keys, pos, role, F.col("content"), system)
    calls = F.exists("messages", lambda m: (m["role"] == "assistant") & F.contains(m["content"], F.lit(TOOL_OPEN)))
    out = out.where(calls & (F.size("messages") >= MIN_MESSAGES))
    return out.withColumn("token_estimate", token_estimate(chars_of(F.col("messages")))).where(F.col("token_estimate") <= budget)


def merge_system(messages: Column, separator: str = "\n\n") -> Column:
    """All system messages as one in front, blank ones skipped; empty messages go."""
    systems = F.filter(messages, lambda m: m["role"] == "system")
    merged = F.array_join(F.filter(F.transform(systems, lambda m: strip(m["content"])), lambda x: x != ""), separator)
    rest = F.filter(messages, lambda m: (m["role"] != "system") & (m["content"] != ""))
    head = F.array(F.struct(F.lit("system").alias("role"), merged.alias("content")))
    return F.when(F.size(systems) > 0, F.concat(head, rest)).otherwise(rest)


def assistant_islands(turns: DataFrame, conv: str = "conv_id", pos: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Runs of assistant items between user messages, each joined to one turn: conv, island, n_items, content."""
    w = Window.partitionBy(conv).orderBy(pos)
    rows = turns.withColumn("island", F.sum((F.col(role) == "user").cast("long")).over(w)).where(F.col(role) == "assistant")
    item = F.struct(F.col(pos), F.col(text).alias("t"))
    out = rows.groupBy(conv, "island").agg(F.count("*").alias("n_items"), F.array_sort(F.collect_list(item)).alias("_m"))
    return out.withColumn("content", F.array_join(F.transform("_m", lambda x: x["t"]), "\n")).drop("_m")


def pair_calls(events: DataFrame, session: str, pos: str, kind: str, call_id: str) -> DataFrame:
    """Calls matched with outputs by id, in sequence: one row per call and per orphan output (session, call_pos, output_pos).

    ``kind`` is 'call' or 'output'. A later call with the same id takes its place; the first output after a call matches it;
    other outputs are orphans (call_pos null) and unmatched calls keep a null output_pos. Null and empty ids never match.
    """
    known = F.coalesce(F.col(call_id), F.lit("")) != ""
    w = Window.partitionBy(session, call_id).orderBy(pos)
    rows = events.where(F.col(kind).isin("call", "output")).withColumn("_call", F.when(known, F.last(F.when(F.col(kind) == "call", F.col(pos)), True).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    outs = rows.where(F.col(kind) == "output")
    nth = F.row_number().over(Window.partitionBy(session, call_id, "_call").orderBy(pos))
    outs = outs.withColumn("_nth", nth).select(session, F.col(pos).alias("output_pos"), F.when((F.col("_nth") == 1) & F.col("_call").isNotNull(), F.col("_call")).alias("call_pos"))
    calls = rows.where(F.col(kind) == "call").select(session, F.col(pos).alias("call_pos"))
    paired = calls.join(outs.where("call_pos is not null"), [session, "call_pos"], "left").select(session, "call_pos", "output_pos")
    return paired.unionByName(outs.where("call_pos is null").select(session, "call_pos", "output_pos"))


def min_turns(turns: DataFrame, least: int, conv: str = "conv_id") -> DataFrame:
    """Turns of conversations with at least ``least`` turns."""
    return turns.withColumn("_n", F.count("*").over(Window.partitionBy(conv))).where(F.col("_n") >= least).drop("_n")


def tool_candidates(turns: DataFrame, conv: str, pos: str, content: str, marker: str, min_context: int = 3) -> DataFrame:
    """Each assistant row with a tool marker and at least ``min_context`` rows before it: conv, target_pos, n_context, target."""
    w = Window.partitionBy(conv).orderBy(pos)
    rows = turns.withColumn("n_context", (F.row_number().over(w) - 1).cast("long"))
    keep = (F.col("role") == "assistant") & F.contains(F.col(content), F.lit(marker)) & (F.col("n_context") >= min_context)
    return rows.where(keep).select(conv, F.col(pos).alias("target_pos"), "n_context", F.col(content).alias("target"))


def with_prefix(candidates: DataFrame, messages: DataFrame, conv: str) -> DataFrame:
    """Candidates with the messages before their target (an array column sliced, not a self-join)."""
    return candidates.join(messages, conv).withColumn("messages", F.slice("messages", F.lit(1), F.col("n_context").cast("int")))


def carry_forward(events: DataFrame, session: str, pos: str, *columns: str) -> DataFrame:
    """Per session the latest non-null value of each column."""
    rows = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(pos))).alias(c) for c in columns]
    return events.groupBy(session).agg(*rows)


def render_chat(messages: Column) -> Column:
    """A plain chat template: each message between start and end marks."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>\n"))), "")
