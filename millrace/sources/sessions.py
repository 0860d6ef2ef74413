"""Agent session logs of several shapes to one turn table.

A turn is a row: session_id, source, pos (an array that sorts), role, text, parts, tool_use_id, model. Parts are structs of type, text, name, input,
output, status, tool_use_id; arbitrary JSON stays JSON text. Inputs are lines with their parsed variant (see ``sources.jsonl``) or the tables of
a session database.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.codecs import map_tool_name
from millrace.functions.text import elided_chars, truncate_head_tail
from millrace.operators.conversations import pair_calls
from millrace.sources.jsonl import file_stem

PART = "struct<type:string,text:string,name:string,input:string,output:string,status:string,tool_use_id:string>"
# Part types that carry no signal.
SKIP_PARTS = ["step-start", "step-finish", "compaction", "snapshot"]
CALL_TYPES = ["function_call", "custom_tool_call"]
OUTPUT_TYPES = ["function_call_output", "custom_tool_call_output"]


def get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def kind_of(v: Column) -> Column:
    """STRING, ARRAY, OBJECT, ... or null."""
    return F.regexp_extract(F.schema_of_variant(v), r"^(\w+)", 1)


def items(v: Column, path: str = "$") -> Column:
    """The elements of a JSON array, or an empty array."""
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def part(**fields: Column) -> Column:
    names = ("type", "text", "name", "input", "output", "status", "tool_use_id")
    return F.struct(*[fields.get(n, F.lit(None)).cast("string").alias(n) for n in names])


def _json(v: Column, path: str) -> Column:
    """The value at a path as JSON text; a string stays itself."""
    inner = F.try_variant_get(v, path, "variant")
    return F.when(kind_of(inner) == "STRING", get(v, path)).otherwise(F.to_json(inner))


def _turn(role: Column, text: Column, parts: Column | None = None, tool_use_id: Column | None = None) -> Column:
    return F.struct(
        role.alias("role"),
        text.alias("text"),
        (F.lit(None) if parts is None else parts).cast(f"array<{PART}>").alias("parts"),
        (F.lit(None) if tool_use_id is None else tool_use_id).cast("string").alias("tool_use_id"),
    )


def transcript_turns(lines: DataFrame, nested: bool = False) -> DataFrame:
    """Client transcripts (file, line_no, data): file, pos, role, text, parts, tool_use_id, model.

    A user line with a list gives a tool_result turn for each result, then one user turn of its joined texts. An assistant line counts only if its
    content is a list with known parts. ``nested``: content lies under ``message``, and a model with it.
    """
    root = "$.message.content" if nested else "$.content"
    data = F.col("data")
    content = F.try_variant_get(data, root, "variant")
    listed = items(data, root)
    kind = lambda x: get(x, "$.type")
    body = lambda x: F.when(kind_of(F.try_variant_get(x, "$.content", "variant")) == "STRING", get(x, "$.content")).otherwise(
        F.array_join(F.transform(items(x, "$.content"), lambda r: F.coalesce(get(r, "$.text"), F.lit(""))), "\n")
    )
    results = F.transform(F.filter(listed, lambda x: kind(x) == "tool_result"), lambda x: _turn(F.lit("tool_result"), F.coalesce(body(x), F.lit("")), None, F.coalesce(get(x, "$.tool_use_id"), F.lit(""))))
    texts = F.transform(F.filter(listed, lambda x: kind(x) == "text"), lambda x: get(x, "$.text"))
    empty = F.array().cast(f"array<struct<role:string,text:string,parts:array<{PART}>,tool_use_id:string>>")
    user_list = F.concat(results, F.when(F.size(texts) > 0, F.array(_turn(F.lit("user"), F.array_join(texts, "\n")))).otherwise(empty))
    known = F.filter(listed, lambda x: kind(x).isin("text", "thinking", "tool_use"))
    parts = F.transform(
        known,
        lambda x: F.when(kind(x) == "text", part(type=F.lit("text"), text=get(x, "$.text")))
        .when(kind(x) == "thinking", part(type=F.lit("thinking"), text=F.coalesce(get(x, "$.thinking"), F.lit(""))))
        .otherwise(part(type=F.lit("tool_call"), name=map_tool_name(F.coalesce(get(x, "$.name"), F.lit(""))), input=F.coalesce(_json(x, "$.input"), F.lit("{}")), tool_use_id=F.coalesce(get(x, "$.id"), F.lit("")))),
    )
    is_user, is_assistant = get(data, "$.type") == "user", get(data, "$.type") == "assistant"
    turns = (
        F.when(is_user & (kind_of(content) == "STRING"), F.array(_turn(F.lit("user"), get(data, root))))
        .when(is_user & (kind_of(content) == "ARRAY"), user_list)
        .when(is_assistant & (kind_of(content) == "ARRAY") & (F.size(parts) > 0), F.array(_turn(F.lit("assistant"), F.lit(None).cast("string"), parts)))
        .otherwise(empty)
    )
    model = F.nullif(get(data, "$.message.model"), F.lit("")) if nested else F.lit(None).cast("string")
    rows = lines.select("file", "line_no", model.alias("_model"), F.posexplode(turns).alias("_i", "_t"))
    return rows.select("file", F.array("line_no", F.col("_i").cast("long")).alias("pos"), "_t.*", F.when(F.col("_t.role") == "assistant", F.col("_model")).alias("model"))


def project_sessions(lines: DataFrame) -> DataFrame:
    """Per file of nested transcripts: session_id (else the file's stem) and directory: the latest stated on a user line (an explicit null counts)."""
    user = lines.where(get(F.col("data"), "$.type") == "user")
    has = lambda path: F.try_variant_get("data", path, "variant").isNotNull()
    latest = lambda path: F.max_by(get(F.col("data"), path), F.when(has(path), F.col("line_no")))
    found = user.groupBy("file").agg(latest("$.sessionId").alias("sid"), latest("$.cwd").alias("directory"))
    out = lines.select("file").distinct().join(found, "file", "left")
    return out.select("file", F.coalesce("sid", file_stem(F.col("file"))).alias("session_id"), "directory")


def text_of(v: Column, path: str) -> Column:
    """A message's text: a string, or the non-empty texts (and bare strings) of a list, joined."""
    at = F.try_variant_get(v, path, "variant")
    each = F.transform(items(v, path), lambda x: F.when(kind_of(x) == "STRING", get(x, "$")).otherwise(F.nullif(get(x, "$.text"), F.lit(""))))
    return F.when(kind_of(at) == "STRING", get(v, path)).when(kind_of(at) == "ARRAY", F.array_join(F.filter(each, lambda x: x.isNotNull()), "\n")).otherwise("")


def rollout_sessions(lines: DataFrame) -> DataFrame:
    """Per file of rollout logs: session_id, model, agent, directory, git_commit, git_branch.

    The last session_meta replaces what came before it; the first turn_context after it gives the model, unless the meta states one.
    """
    rows = lines.select("file", "line_no", get(F.col("data"), "$.type").alias("t"), F.try_variant_get("data", "$.payload", "variant").alias("p"))
    meta = rows.where("t = 'session_meta'").groupBy("file").agg(F.max("line_no").alias("_m"), *[F.max_by(get(F.col("p"), path), "line_no").alias(name) for name, path in (("sid", "$.id"), ("own_model", "$.model"), ("agent", "$.originator"), ("directory", "$.cwd"), ("git_commit", "$.git.commit_hash"), ("git_branch", "$.git.branch"))])
    context = rows.where("t = 'turn_context'").join(meta.select("file", "_m"), "file", "left").where("_m is null or line_no > _m")
    model = context.groupBy("file").agg(F.min_by(get(F.col("p"), "$.model"), "line_no").alias("_model"))
    out = lines.select("file").distinct().join(meta, "file", "left").join(model, "file", "left")
    return out.select("file", F.coalesce(F.nullif("sid", F.lit("")), file_stem(F.col("file"))).alias("session_id"), F.coalesce("own_model", "_model").alias("model"), "agent", "directory", "git_commit", "git_branch")


def rollout_turns(lines: DataFrame, keep_reasoning: bool = False) -> DataFrame:
    """Rollout logs (file, line_no, data) to turns: file, pos, role, text, parts, and chars_elided of the turn.

    Assistant items gather until a user message. Each output goes to its call, wherever that is; one without a call is a part at its own place.
    """
    p = F.try_variant_get("data", "$.payload", "variant")
    rows = lines.where(get(F.col("data"), "$.type") == "response_item").select("file", "line_no", p.alias("p"), get(p, "$.type").alias("t"))
    rows = rows.withColumn("role", get(F.col("p"), "$.role")).withColumn("text", F.when(F.col("t") == "message", text_of(F.col("p"), "$.content")).when(F.col("t") == "reasoning", text_of(F.col("p"), "$.summary")))
    said = (F.col("t") == "message") & F.col("role").isin("user", "assistant") & (F.col("text") != "")
    thought = (F.col("t") == "reasoning") & (F.col("text") != "") if keep_reasoning else F.lit(False)
    kind = F.when(F.col("t").isin(CALL_TYPES), "call").when(F.col("t").isin(OUTPUT_TYPES), "output").when(said, "message").when(thought, "reasoning")
    rows = rows.withColumn("kind", kind).where("kind is not null").withColumn("call_id", get(F.col("p"), "$.call_id"))
    paired = pair_calls(rows, "file", "line_no", "kind", "call_id")
    output = rows.where("kind = 'output'").select("file", F.col("line_no").alias("output_pos"), F.coalesce(_json(F.col("p"), "$.output"), F.lit("")).alias("_out"))
    paired = paired.join(output, ["file", "output_pos"], "left").select("file", F.coalesce("call_pos", "output_pos").alias("line_no"), "_out", F.col("call_pos").isNull().alias("_orphan"))
    raw = F.coalesce(F.nullif(_json(F.col("p"), "$.arguments"), F.lit("")), _json(F.col("p"), "$.input"), F.lit(""))
    w = Window.partitionBy("file").orderBy("line_no")
    is_user = (F.col("kind") == "message") & (F.col("role") == "user")
    rows = rows.withColumn("_island", F.sum(is_user.cast("int")).over(w)).join(paired, ["file", "line_no"], "left")
    rows = rows.where("kind <> 'output' or _orphan")
    item = (
        F.when(F.col("kind") == "message", part(type=F.lit("text"), text=F.col("text")))
        .when(F.col("kind") == "reasoning", part(type=F.lit("reasoning"), text=F.col("text")))
        .when(F.col("kind") == "call", part(type=F.lit("tool_call"), name=get(F.col("p"), "$.name"), input=truncate_head_tail(raw), output=truncate_head_tail("_out"), status=get(F.col("p"), "$.status")))
        .otherwise(part(type=F.lit("tool_call"), output=truncate_head_tail("_out")))
    )
    cut = F.when(F.col("kind") == "call", elided_chars(raw)).otherwise(0) + F.coalesce(elided_chars("_out"), F.lit(0))
    rows = rows.withColumn("_part", item).withColumn("_cut", cut)
    users = rows.where(is_user).select("file", F.array("line_no").alias("pos"), "role", "text", F.lit(None).cast(f"array<{PART}>").alias("parts"), F.lit(0).cast("long").alias("chars_elided"))
    talk = rows.where(~is_user).groupBy("file", "_island").agg(F.min("line_no").alias("_at"), F.array_sort(F.collect_list(F.struct("line_no", "_part"))).alias("_l"), F.sum("_cut").alias("chars_elided"))
    talk = talk.select("file", F.array("_at").alias("pos"), F.lit("assistant").alias("role"), F.lit(None).cast("string").alias("text"), F.transform("_l", lambda x: x["_part"]).alias("parts"), "chars_elided")
    return users.unionByName(talk)


def _joined_parts(messages: DataFrame, parts: DataFrame, order: list[str]) -> DataFrame:
    """messages with ``_parts``: their parts' variants in order. Invalid JSON is left out row by row."""
    good = parts.withColumn("v", F.try_parse_json("data")).where("v is not null").withColumn("t", F.to_json("v"))
    listed = good.groupBy("session_id", "message_id").agg(F.array_sort(F.collect_list(F.struct(*order, "t"))).alias("_l"))
    listed = listed.select("session_id", "message_id", F.transform("_l", lambda x: F.parse_json(x["t"])).alias("_parts"))
    heads = messages.withColumn("m", F.try_parse_json("data")).where("m is not null")
    out = heads.join(listed, (heads["id"] == listed["message_id"]) & (heads["session_id"] == listed["session_id"]), "left").drop(listed["session_id"]).drop("message_id")
    return out.withColumn("_parts", F.coalesce("_parts", F.array().cast("array<variant>")))


def database_turns(messages: DataFrame, parts: DataFrame, join_all_text: bool = True, truncate: bool = True, min_messages: int = 0) -> DataFrame:
    """Message and part tables to turns: session_id, pos, role, text, parts, chars_elided.

    ``join_all_text``: a user turn is all its non-empty texts, else only the first. ``truncate``: long inputs and outputs
    are cut and patch parts are kept. Sessions with fewer than ``min_messages`` message rows are left out before anything is parsed.
    """
    if min_messages:
        messages = messages.withColumn("_n", F.count("*").over(Window.partitionBy("session_id"))).where(F.col("_n") >= min_messages).drop("_n")
    rows = _joined_parts(messages, parts, ["id"] if truncate else ["time_created", "id"])
    kind = lambda x: get(x, "$.type")
    texts = F.transform(F.filter("_parts", lambda x: (kind(x) == "text") & (F.coalesce(get(x, "$.text"), F.lit("")) != "")), lambda x: get(x, "$.text"))
    if not join_all_text:
        texts = F.filter(F.slice(F.transform(F.filter("_parts", lambda x: kind(x) == "text"), lambda x: F.coalesce(get(x, "$.text"), F.lit(""))), 1, 1), lambda x: x != "")
    cut = truncate_head_tail if truncate else (lambda x: x)
    call = lambda x: part(
        type=F.lit("tool_call"),
        name=get(x, "$.tool"),
        input=cut(F.coalesce(_json(x, "$.state.input"), F.lit(None if truncate else "{}"))),
        output=cut(F.coalesce(_json(x, "$.state.output"), F.lit(None if truncate else ""))),
        status=get(x, "$.state.status"),
    )
    patch = lambda x: part(type=F.lit("patch"), text=F.coalesce(F.nullif(_json(x, "$.hash"), F.lit("")), F.nullif(_json(x, "$.files"), F.lit("[]")), F.to_json(x)))
    kinds = ["text", "tool", "patch"] if truncate else ["text", "tool"]
    known = F.filter("_parts", lambda x: kind(x).isin(kinds) & ~kind(x).isin(SKIP_PARTS) & ~((kind(x) == "text") & (F.coalesce(get(x, "$.text"), F.lit("")) == "") & F.lit(truncate)))
    made = F.transform(known, lambda x: F.when(kind(x) == "text", part(type=F.lit("text"), text=get(x, "$.text"))).when(kind(x) == "tool", call(x)).otherwise(patch(x)))
    lost = F.aggregate(
        F.filter("_parts", lambda x: kind(x) == "tool"),
        F.lit(0).cast("long"),
        lambda a, x: a + F.coalesce(elided_chars(_json(x, "$.state.input")), F.lit(0)) + F.coalesce(elided_chars(_json(x, "$.state.output")), F.lit(0)),
    )
    role = get(F.col("m"), "$.role")
    rows = rows.select("session_id", F.struct("time_created", "id").alias("pos"), role.alias("role"), F.array_join(texts, "\n").alias("text"), F.size(texts).alias("_n"), made.alias("parts"), (lost if truncate else F.lit(0).cast("long")).alias("chars_elided"))
    rows = rows.where(((F.col("role") == "user") & (F.col("_n") > 0)) | ((F.col("role") == "assistant") & (F.size("parts") > 0))).drop("_n")
    user = F.col("role") == "user"
    return rows.withColumns({"text": F.when(user, F.col("text")), "parts": F.when(~user, F.col("parts")), "chars_elided": F.when(user, 0).otherwise(F.col("chars_elided"))})


def event_turns(sessions: DataFrame, messages: DataFrame) -> DataFrame:
    """The newer message table (session_id, id, type, seq, data) to turns; messages of unknown sessions are left out.

    A tool part's output is the texts of its state's content, null if it has none; summary turns keep their data as JSON text.
    """
    rows = messages.join(sessions.select(F.col("id").alias("session_id")), "session_id", "left_semi").withColumn("m", F.try_parse_json("data"))
    role = F.coalesce("type", get(F.col("m"), "$.role"))
    kind = lambda x: get(x, "$.type")
    output = lambda x: F.when(
        F.size(items(x, "$.state.content")) > 0,
        F.array_join(F.transform(F.filter(items(x, "$.state.content"), lambda c: kind(c) == "text"), lambda c: get(c, "$.text")), "\n"),
    )
    made = F.transform(
        F.filter(items(F.col("m"), "$.content"), lambda x: kind(x).isin("text", "tool")),
        lambda x: F.when(kind(x) == "text", part(type=F.lit("text"), text=get(x, "$.text"))).otherwise(
            part(type=F.lit("tool_call"), name=get(x, "$.name"), input=F.coalesce(_json(x, "$.state.input"), F.lit("{}")), output=output(x), status=get(x, "$.state.status"))
        ),
    )
    rows = rows.select("session_id", F.col("seq").alias("pos"), role.alias("role"), F.coalesce(get(F.col("m"), "$.text"), F.lit("")).alias("text"), made.alias("parts"), F.to_json("m").alias("_raw"))
    rows = rows.where(((F.col("role") == "user") & (F.col("text") != "")) | ((F.col("role") == "assistant") & (F.size("parts") > 0)) | (F.col("role") == "summary"))
    text = F.when(F.col("role") == "user", F.col("text")).when(F.col("role") == "summary", F.col("_raw"))
    return rows.withColumns({"text": text, "parts": F.when(F.col("role") == "assistant", F.col("parts"))}).drop("_raw")


def conversations(turns: DataFrame, key: str, least: int) -> DataFrame:
    """One row per session with at least ``least`` turns, its turns nested in order."""
    names = [c for c in turns.columns if c not in (key, "pos")]
    out = turns.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", F.struct(*names).alias("t"))), lambda a, b: F.when(a["pos"] < b["pos"], -1).when(a["pos"] > b["pos"], 1).otherwise(0)).alias("_l"))
    return out.where(F.size("_l") >= least).select(key, F.transform("_l", lambda x: x["t"]).alias("turns"))


def turn_text(parts: Column, text: Column) -> Column:
    """A turn's text: its own, or its text and thinking parts; tool calls are left out."""
    known = F.filter(parts, lambda p: p["type"].isin("text", "thinking"))
    said = F.transform(known, lambda p: F.when(p["type"] == "thinking", F.concat(F.lit("[THINKING]"), F.coalesce(p["text"], F.lit("")), F.lit("[/THINKING]"))).otherwise(p["text"]))
    return F.coalesce(text, F.array_join(said, "\n"))


def source_counts(convs: DataFrame) -> DataFrame:
    """Conversations and turns per source (else format, else folder)."""
    name = F.coalesce("source", "format", "folder")
    return convs.groupBy(name.alias("source")).agg(F.count("*").alias("conversations"), F.sum(F.size("turns")).alias("turns"))
