"""Queries on conversations, tool calls, commits and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions import codecs
from millrace.graph import dealt_join
from millrace.operators import cochange, commits, conversations, conversion, metrics, nextedit, sampling
from millrace.plans.base import CLUSTERS_SQL, SUBJECT_SQL, TOUCHES_SQL, Tables, big, brand_clusters, query, quote, subject, touches
from millrace.plans.text_queries import strip_sql
from millrace.staging import pieces, stage

# --- conversations -------------------------------------------------------------------------------------------------


def windows_sql(most: int, least: int) -> str:
    return f"""
WITH a AS (
  SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS req, count(*) OVER (PARTITION BY conv_id) AS n,
    first_value(role) OVER (PARTITION BY conv_id ORDER BY turn) AS head FROM conversations
), b AS (
  SELECT *, CASE WHEN n <= {most} AND head = 'user' THEN 0 ELSE req - 1 END AS w, n <= {most} AND head = 'user' AS single FROM a
), c AS (
  SELECT * FROM b WHERE w >= 0 QUALIFY row_number() OVER (PARTITION BY conv_id, w ORDER BY turn) <= {most}
), win AS (
  SELECT conv_id, CAST(w AS BIGINT) AS window_id, turn, role, text, single FROM c QUALIFY single OR count(*) OVER (PARTITION BY conv_id, w) >= {least}
)
"""


_WIN = windows_sql(40, 3)


@query("request_windows", _WIN + "SELECT conv_id, window_id, turn, role FROM win")
def request_windows(t: Tables) -> DataFrame:
    return conversations.request_windows(t.conversations).select("conv_id", "window_id", "turn", "role")


@query("request_windows_capped", windows_sql(4, 2) + "SELECT conv_id, window_id, turn, role FROM win")
def request_windows_capped(t: Tables) -> DataFrame:
    return conversations.request_windows(t.conversations, max_turns=4, min_turns=2).select("conv_id", "window_id", "turn", "role")


_SFT = (
    windows_sql(40, 2)
    + f""", k AS (SELECT * FROM win WHERE role IN ('user', 'assistant') AND {strip_sql('text')} <> '' AND NOT contains(text, chr(10) || '[TOOL_CALL]')),
m AS (
  SELECT conv_id, window_id, count(*) + 1 AS n_messages, bool_or(role = 'user') AND bool_or(role = 'assistant') AS ok, sum(length(text)) + {len(conversations.SYSTEM_INSTRUCTION)} AS chars,
    md5(string_agg(role || ':' || text, chr(10) ORDER BY turn)) AS body_md5 FROM k GROUP BY ALL
), sft AS (SELECT conv_id, window_id, CAST(n_messages AS BIGINT) AS n_messages, CAST(chars // 4 AS BIGINT) AS token_estimate, body_md5 FROM m WHERE n_messages >= 4 AND ok AND chars // 4 <= 8000)
"""
)


def _sft(t: Tables) -> DataFrame:
    return conversations.instruction_examples(conversations.request_windows(t.conversations, min_turns=2))


@query("sft_instruction", _SFT + "SELECT * FROM sft")
def sft_instruction(t: Tables) -> DataFrame:
    body = F.array_join(F.transform(F.slice("messages", F.lit(2), F.size("messages")), lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return _sft(t).select("conv_id", "window_id", big(F.size("messages")).alias("n_messages"), "token_estimate", F.md5(body).alias("body_md5"))


@query("sft_summary", _SFT + "SELECT count(*) AS n, round(avg(n_messages), 4) AS avg_messages, CAST(sum(token_estimate) AS BIGINT) AS tokens FROM sft")
def sft_summary(t: Tables) -> DataFrame:
    return _sft(t).agg(F.count("*").alias("n"), F.round(F.avg(F.size("messages")), 4).alias("avg_messages"), F.sum("token_estimate").alias("tokens"))


@query(
    "system_merge",
    f"""
WITH s AS (SELECT conv_id, string_agg({strip_sql('text')}, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE {strip_sql('text')} <> '') AS sys FROM conversations WHERE role = 'system' OR turn = 3 GROUP BY 1),
m AS (SELECT conv_id, count(*) FILTER (WHERE NOT (role = 'system' OR turn = 3) AND text <> '') AS n FROM conversations GROUP BY 1)
SELECT conv_id, CAST(n + CASE WHEN s.conv_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_messages, CASE WHEN s.conv_id IS NULL THEN NULL ELSE md5(coalesce(sys, '')) END AS system_md5 FROM m LEFT JOIN s USING (conv_id)
""",
)
def system_merge(t: Tables) -> DataFrame:
    """Turn 3 counts as a second system message, to have conversations with two."""
    role = F.when(F.col("turn") == 3, "system").otherwise(F.col("role"))
    rows = conversations.messages_of(t.conversations, ["conv_id"], "turn", role, F.col("text")).withColumn("messages", conversations.merge_system(F.col("messages")))
    first = F.get("messages", F.lit(0))
    return rows.select("conv_id", big(F.size("messages")).alias("n_messages"), F.when(first["role"] == "system", F.md5(first["content"])).alias("system_md5"))


@query("concat_turns", "SELECT conv_id, md5(string_agg(text, chr(10) ORDER BY turn)) AS text_md5, count(*) AS n FROM conversations WHERE role <> 'system' GROUP BY 1")
def concat_turns(t: Tables) -> DataFrame:
    rows = conversations.messages_of(t.conversations.where("role <> 'system'"), ["conv_id"], "turn", F.col("role"), F.col("text"))
    return rows.select("conv_id", F.md5(F.array_join(F.transform("messages", lambda m: m["content"]), "\n")).alias("text_md5"), big(F.size("messages")).alias("n"))


@query("min_turns", "SELECT conv_id, turn, role FROM conversations QUALIFY count(*) OVER (PARTITION BY conv_id) >= 4")
def min_turns(t: Tables) -> DataFrame:
    return conversations.min_turns(t.conversations, 4).select("conv_id", "turn", "role")


@query("turn_stats", "SELECT role, count(*) AS turns, count(DISTINCT conv_id) AS conversations, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY role")
def turn_stats(t: Tables) -> DataFrame:
    return t.conversations.groupBy("role").agg(F.count("*").alias("turns"), F.count_distinct("conv_id").alias("conversations"), F.sum(F.length("text")).alias("chars"))


@query("source_counts", "SELECT CASE WHEN doc_id % 7 = 0 THEN lang ELSE source END AS source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1")
def source_counts(t: Tables) -> DataFrame:
    """A seventh of the documents has no source; its language then stands for it."""
    own = F.when(F.col("doc_id") % 7 != 0, F.col("source"))
    return t.documents.groupBy(F.coalesce(own, "lang").alias("source")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


_CHAT = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)"


@query("chat_render", f"SELECT conv_id, md5(string_agg({_CHAT}, '' ORDER BY turn)) AS chat_md5 FROM conversations GROUP BY 1")
def chat_render(t: Tables) -> DataFrame:
    rows = conversations.messages_of(t.conversations, ["conv_id"], "turn", F.col("role"), F.col("text"))
    return rows.select("conv_id", F.md5(conversations.render_chat(F.col("messages"))).alias("chat_md5"))


@query("mix_union", f"SELECT md5(text) AS text_md5, origin FROM (SELECT text, 'documents' AS origin FROM documents UNION ALL SELECT string_agg({_CHAT}, '' ORDER BY turn), 'conversations' FROM conversations GROUP BY conv_id UNION ALL SELECT text, 'benchmark' FROM benchmark)")
def mix_union(t: Tables) -> DataFrame:
    chat = conversations.messages_of(t.conversations, ["conv_id"], "turn", F.col("role"), F.col("text")).select(conversations.render_chat(F.col("messages")).alias("text"), F.lit("conversations").alias("origin"))
    part = lambda df, name: df.select("text", F.lit(name).alias("origin"))
    out = part(t.documents, "documents").unionByName(chat).unionByName(part(t.benchmark, "benchmark"), allowMissingColumns=True)
    return out.select(F.md5("text").alias("text_md5"), "origin")


@query("assistant_islands", "WITH i AS (SELECT *, sum(CASE WHEN turn % 4 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM conversations) SELECT conv_id, CAST(island AS BIGINT) AS island, count(*) AS n_items, md5(string_agg(text, chr(10) ORDER BY turn)) AS content_md5 FROM i WHERE turn % 4 <> 0 GROUP BY ALL")
def assistant_islands(t: Tables) -> DataFrame:
    """Every fourth turn counts as a user message, so that runs have several items."""
    rows = t.conversations.withColumn("role", F.when(F.col("turn") % 4 == 0, "user").otherwise("assistant"))
    return conversations.assistant_islands(rows).select("conv_id", "island", "n_items", F.md5("content").alias("content_md5"))


# --- tool calls: events stand in -----------------------------------------------------------------------------------

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_PRETTY = f"'{{' || chr(10) || '  \"k\": ' || {_K} || chr(10) || '}}'"
_MARK = f"(chr(10) || '[TOOL_CALL]' || event_type || chr(10) || {_PRETTY} || '[/TOOL_CALL]' || chr(10))"


def _rendered(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", "event_type", "props", codecs.render_markers(F.col("event_type"), codecs.pretty_json("props")).alias("text"))


@query("tool_render", f"SELECT event_id, {_MARK} AS text FROM events")
def tool_render(t: Tables) -> DataFrame:
    return _rendered(t).select("event_id", "text")


def _parsed(rows: DataFrame, fmt: str) -> DataFrame:
    got = codecs.FORMATS[fmt].parse(F.col("text"))
    return rows.select("event_id", got["name"].alias("name"), F.get_json_object(got["args"], "$.k").cast("long").alias("k"))


_NAME_K = f"SELECT event_id, event_type AS name, {_K} AS k FROM events"


@query("tool_parse", f"SELECT event_id, event_type AS name, CASE WHEN event_id % 3 = 2 THEN NULL ELSE {_K} END AS k FROM events")
def tool_parse(t: Tables) -> DataFrame:
    """A third of the calls has its arguments encoded twice, a third has none."""
    kind = F.col("event_id") % 3
    twice = F.concat(F.lit('"'), F.replace("props", F.lit('"'), F.lit('\\"')), F.lit('"'))
    args = F.when(kind == 0, F.col("props")).when(kind == 1, twice).otherwise("")
    return _parsed(t.events.withColumn("text", codecs.render_markers(F.col("event_type"), args)), "markers")


@query("tool_roundtrip", _NAME_K)
def tool_roundtrip(t: Tables) -> DataFrame:
    return _parsed(_rendered(t), "markers")


@query("tool_roundtrip_xml", _NAME_K)
def tool_roundtrip_xml(t: Tables) -> DataFrame:
    return _parsed(t.events.withColumn("text", codecs.render_xml(F.col("event_type"), F.col("props"))), "xml_tool_call")


@query("tool_roundtrip_lfm2", _NAME_K)
def tool_roundtrip_lfm2(t: Tables) -> DataFrame:
    return _parsed(t.events.withColumn("text", codecs.render_lfm2(F.col("event_type"), F.col("props"))), "lfm2")


@query("reencode_native", f"SELECT event_id, '<think>' || chr(10) || 'so ' || event_type || chr(10) || '</think>' || chr(10) || '<tool_call>' || chr(10) || '{{\"name\": \"' || event_type || '\", \"arguments\": {{\"k\": ' || {_K} || '}}}}' || chr(10) || '</tool_call>' AS text, event_type AS tool FROM events WHERE event_id % 10 <> 9")
def reencode_native(t: Tables) -> DataFrame:
    """A tenth of the calls has arguments that aren't JSON; these rows are dropped."""
    args = F.when(F.col("event_id") % 10 == 9, "{broken").otherwise(codecs.pretty_json("props"))
    text = F.concat(F.lit("[THINKING] so "), F.col("event_type"), F.lit(" [/THINKING]"), codecs.render_markers(F.col("event_type"), args))
    rows = t.events.select("event_id", codecs.reencode_native(text).alias("r")).where("r.error is null")
    return rows.select("event_id", F.col("r.text").alias("text"), codecs.first_call_name(F.col("r.text")).alias("tool"))


@query("tool_name_map", "SELECT event_id, CASE event_type WHEN 'view' THEN 'webfetch' WHEN 'click' THEN 'todowrite' WHEN 'error' THEN 'multi_edit' ELSE event_type END AS tool FROM events")
def tool_name_map(t: Tables) -> DataFrame:
    e = F.col("event_type")
    name = F.when(e == "view", "WebFetch").when(e == "click", "TodoWrite").when(e == "error", "MultiEdit").otherwise(F.upper(e))
    return t.events.select("event_id", codecs.map_tool_name(name).alias("tool"))


_PAIR_SQL = f"""
WITH e AS (SELECT user_id, event_id AS pos, CASE WHEN event_type IN ('click', 'view') THEN 'call' WHEN event_type IN ('purchase', 'error') THEN 'output' END AS kind, CASE WHEN {_K} % 7 = 0 THEN NULL ELSE CAST({_K} % 7 AS VARCHAR) END AS id FROM events),
o AS (SELECT o.user_id, o.pos AS output_pos, max(c.pos) AS c FROM e o LEFT JOIN e c ON c.kind = 'call' AND c.user_id = o.user_id AND c.id = o.id AND c.pos < o.pos WHERE o.kind = 'output' GROUP BY ALL),
n AS (SELECT user_id, output_pos, CASE WHEN c IS NOT NULL AND row_number() OVER (PARTITION BY user_id, c ORDER BY output_pos) = 1 THEN c END AS call_pos FROM o)
SELECT c.user_id, c.pos AS call_pos, n.output_pos FROM e c LEFT JOIN n ON n.user_id = c.user_id AND n.call_pos = c.pos WHERE c.kind = 'call'
UNION ALL SELECT user_id, NULL, output_pos FROM n WHERE call_pos IS NULL
"""


@query("call_pairing", _PAIR_SQL)
def call_pairing(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long") % 7
    e = F.col("event_type")
    kind = F.when(e.isin("click", "view"), "call").when(e.isin("purchase", "error"), "output")
    rows = t.events.select("user_id", F.col("event_id").alias("pos"), kind.alias("kind"), F.when(k != 0, k.cast("string")).alias("call_id"))
    return conversations.pair_calls(rows, "user_id", "pos", "kind", "call_id")


# A user's events in order are a conversation: signups are the user's, errors are results, the rest are calls.
_EVENT_TURNS = f"""
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, event_id, event_type,
  CASE event_type WHEN 'signup' THEN 'user' WHEN 'error' THEN 'tool_result' ELSE 'assistant' END AS role,
  CASE event_type WHEN 'signup' THEN props WHEN 'error' THEN '[TOOL_RESULT]' || props || '[/TOOL_RESULT]' ELSE chr(10) || '[TOOL_CALL]' || event_type || chr(10) || props || '[/TOOL_CALL]' || chr(10) END AS content
FROM events
"""


def _event_turns(t: Tables) -> DataFrame:
    e = F.col("event_type")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t.events.select(
        "user_id",
        F.row_number().over(w).cast("long").alias("pos"),
        "event_id",
        "event_type",
        F.when(e == "signup", "user").when(e == "error", "tool_result").otherwise("assistant").alias("role"),
        F.when(e == "signup", F.col("props")).when(e == "error", codecs.render_result(F.col("props"))).otherwise(codecs.render_markers(e, F.col("props"))).alias("content"),
    )


@query(
    "sft_agentic",
    f"""WITH t AS ({_EVENT_TURNS}), m AS (SELECT user_id, count(*) + 1 AS n, bool_or(role = 'assistant') AS calls, sum(length(content)) + {len(conversations.SYSTEM_AGENTIC)} + length(chr(10) || chr(10) || 'Working directory: /u') AS chars,
  md5(string_agg(CASE role WHEN 'tool_result' THEN 'tool' ELSE role END || ':' || content, chr(10) ORDER BY pos)) AS body_md5 FROM t GROUP BY user_id)
SELECT user_id, CAST(n AS BIGINT) AS n_messages, CAST(chars // 4 AS BIGINT) AS token_estimate, body_md5 FROM m WHERE calls AND n >= 4 AND chars // 4 <= 8000""",
)
def sft_agentic(t: Tables) -> DataFrame:
    out = conversations.agentic_examples(_event_turns(t), ["user_id"], "pos", F.lit("/u"))
    body = F.array_join(F.transform(F.slice("messages", F.lit(2), F.size("messages")), lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return out.select("user_id", big(F.size("messages")).alias("n_messages"), "token_estimate", F.md5(body).alias("body_md5"))


_NATIVE = f"""WITH t AS ({_EVENT_TURNS}), n AS (SELECT user_id, pos, CASE role WHEN 'tool_result' THEN 'tool' ELSE role END AS role,
  CASE role WHEN 'user' THEN props WHEN 'tool_result' THEN props ELSE '<tool_call>' || chr(10) || '{{"name": "' || event_type || '", "arguments": ' || props || '}}' || chr(10) || '</tool_call>' END AS content
  FROM t JOIN (SELECT event_id, props FROM events) USING (event_id) WHERE user_id % 10 <> 3)
SELECT user_id, count(*) + 1 AS n_messages, CAST(count(*) FILTER (WHERE role = 'assistant') AS BIGINT) AS n_calls, md5(string_agg(role || ':' || content, chr(10) ORDER BY pos)) AS body_md5 FROM n GROUP BY user_id"""


@query("sft_convert", _NATIVE)
def sft_convert(t: Tables) -> DataFrame:
    """All users' examples in the native format; a tenth of the users has an unreadable call and is dropped."""
    bad = (F.col("user_id") % 10 == 3) & (F.col("role") == "assistant")
    rows = _event_turns(t).withColumn("content", F.when(bad, "[TOOL_CALL]x\n{oops[/TOOL_CALL]").otherwise(F.col("content")))
    made = conversations.messages_of(rows, ["user_id"], "pos", F.when(F.col("role") == "tool_result", "tool").otherwise(F.col("role")), F.col("content"), F.lit(" one system "))
    out = conversion.convert_examples(made, "user_id").where("drop_reason is null")
    body = F.array_join(F.transform(F.slice("messages", F.lit(2), F.size("messages")), lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return out.select("user_id", big(F.size("messages")).alias("n_messages"), "n_calls", F.md5(body).alias("body_md5"))


@query("next_tool_candidates", f"WITH t AS ({_EVENT_TURNS}) SELECT user_id, pos AS target_pos, pos - 1 AS n_context, event_type AS tool FROM t WHERE role = 'assistant' AND pos - 1 >= 3")
def next_tool_candidates(t: Tables) -> DataFrame:
    rows = conversations.tool_candidates(_event_turns(t), "user_id", "pos", "content", conversations.TOOL_OPEN)
    return rows.select("user_id", "target_pos", "n_context", codecs.parse_markers(F.col("target"))["name"].alias("tool"))


@query("majority_baseline", "WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1) SELECT event_type AS majority, round(n / CAST((SELECT sum(n) FROM c) AS DOUBLE), 4) AS share, (SELECT count(*) FROM c) AS n_values FROM c ORDER BY n DESC, event_type LIMIT 1")
def majority_baseline(t: Tables) -> DataFrame:
    return metrics.majority(t.events, "event_type")


@query("tool_distribution", f"WITH t AS ({_EVENT_TURNS}) SELECT event_type AS tool, count(*) AS n FROM t WHERE role = 'assistant' GROUP BY 1 ORDER BY n DESC, tool")
def tool_distribution(t: Tables) -> DataFrame:
    names = F.regexp_extract_all("content", F.lit(codecs.MARKER_NAME), 1)
    return _event_turns(t).where("role = 'assistant'").select(F.explode(names).alias("tool")).groupBy("tool").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tool")


# The prediction for an event is the user's event before it.
_PRED = f"SELECT event_id, event_type AS gold, lag(event_type) OVER w AS pred, {_K} AS k, lag({_K}) OVER w AS pk FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"
_OVERLAP = "CASE WHEN pk IS NOT NULL AND k = pk THEN 1.0 ELSE 0.0 END"


def _predicted(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return t.events.select("event_id", F.col("event_type").alias("gold"), F.lag("event_type").over(w).alias("pred"), "props", F.lag("props").over(w).alias("pred_props"))


@query("args_overlap", f"WITH p AS ({_PRED}) SELECT event_id, CAST({_OVERLAP} AS DOUBLE) AS args_overlap FROM p")
def args_overlap(t: Tables) -> DataFrame:
    return metrics.args_overlap(_predicted(t), "event_id", "pred_props", "props")


@query("tool_metrics", f"WITH p AS ({_PRED}) SELECT count(*) AS n, round(avg(CASE WHEN gold = pred THEN 1.0::DOUBLE ELSE 0.0 END), 4) AS tool_match, round(avg(CASE WHEN pred IS NULL THEN 0.0::DOUBLE ELSE 1.0 END), 4) AS called_any, round(avg(CAST({_OVERLAP} AS DOUBLE)) FILTER (WHERE gold = pred), 4) AS args_overlap FROM p")
def tool_metrics(t: Tables) -> DataFrame:
    rows = _predicted(t)
    both = rows.join(metrics.args_overlap(rows, "event_id", "pred_props", "props"), "event_id").withColumn("match", F.coalesce(F.col("gold") == F.col("pred"), F.lit(False)))
    over = F.round(F.avg(F.when(F.col("match"), F.col("args_overlap"))), 4)
    return both.withColumn("called", F.col("pred").isNotNull()).agg(F.count("*").alias("n"), metrics.mean_of("match", "tool_match"), metrics.mean_of("called", "called_any"), over.alias("args_overlap"))


@query("confusion_topk", f"WITH p AS ({_PRED}) SELECT gold || ' -> ' || coalesce(pred, 'None') AS pair, count(*) AS n FROM p WHERE gold IS DISTINCT FROM pred GROUP BY 1 ORDER BY n DESC, pair LIMIT 6")
def confusion_topk(t: Tables) -> DataFrame:
    return metrics.confusion(_predicted(t), "gold", "pred")


@query("format_gate", "SELECT true AS markers, false AS xml_tool_call, false AS lfm2")
def format_gate(t: Tables) -> DataFrame:
    rows = _rendered(t)
    return rows.agg(*[F.bool_or(codecs.format_valid(F.col("text"), f)).alias(n) for n, f in codecs.FORMATS.items()])


@query("event_type_filter", "SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('view', 'click')")
def event_type_filter(t: Tables) -> DataFrame:
    return t.events.where(F.col("event_type").isin("view", "click")).select("event_id", "user_id", "event_type")


@query("metadata_carry_forward", "SELECT user_id, arg_max(event_type, event_id) FILTER (WHERE event_id % 3 = 0) AS directory, arg_max(props, event_id) FILTER (WHERE event_id % 5 = 0) AS model FROM events GROUP BY 1")
def metadata_carry_forward(t: Tables) -> DataFrame:
    some = lambda c, n: F.when(F.col("event_id") % n == 0, F.col(c))
    rows = t.events.select("user_id", "event_id", some("event_type", 3).alias("directory"), some("props", 5).alias("model"))
    return conversations.carry_forward(rows, "user_id", "event_id", "directory", "model")


# --- commits: orders stand in ---------------------------------------------------------------------------------------


def _subjects(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", subject().alias("subject"))


_SUBJECTS = f"SELECT o_orderkey, {SUBJECT_SQL} AS subject FROM orders JOIN customer ON o_custkey = c_custkey"
_TYPE = f"nullif(regexp_extract(subject, {quote(commits.CONVENTIONAL)}, 1), '')"
_SCOPE = f"nullif(regexp_extract(subject, {quote(commits.CONVENTIONAL)}, 2), '')"


@query("commit_parse", f"WITH s AS ({_SUBJECTS}) SELECT o_orderkey, {_TYPE} AS type, {_SCOPE} AS scope FROM s")
def commit_parse(t: Tables) -> DataFrame:
    return _subjects(t).select("o_orderkey", commits.subject_type(F.col("subject")).alias("type"), commits.subject_scope(F.col("subject")).alias("scope"))


@query(
    "commit_filter",
    f"""WITH s AS ({_SUBJECTS}), f AS (SELECT o_orderkey, subject, (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS n FROM s)
SELECT CASE WHEN n = 0 THEN 'skip_nofiles' WHEN {_TYPE} IN ({', '.join(map(quote, commits.SKIP_TYPES))}) THEN 'skip_type' WHEN regexp_matches(subject, {quote(commits.SKIP_MESSAGE)}) THEN 'skip_msg' WHEN n > 25 THEN 'skip_large' ELSE 'kept' END AS reason, count(*) AS n FROM f GROUP BY 1""",
)
def commit_filter(t: Tables) -> DataFrame:
    files = t.lineitem.groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("files"))
    rows = _subjects(t).join(files, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("files", F.coalesce("files", F.array().cast("array<bigint>")))
    return commits.drop_reason(rows).groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query("dedup_key_first", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) = 1")
def dedup_key_first(t: Tables) -> DataFrame:
    return commits.first_by_key(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey", "l_linenumber", "l_partkey")


_EDGES = f"""
WITH t AS ({TOUCHES_SQL}), w AS (SELECT *, exp(-greatest(0.0, ((SELECT max(ts) FROM t) - ts) / 86400.0::DOUBLE) / 180.0::DOUBLE) AS w FROM t),
f AS (SELECT file, sum(w) AS fw FROM w GROUP BY 1), p AS (SELECT x.file AS a, y.file AS b, count(*) AS n, sum(x.w) AS pw FROM w x JOIN w y ON x.sha = y.sha AND x.file < y.file GROUP BY ALL HAVING count(*) >= 2),
e AS (SELECT a, b, n, pw / (fa.fw + fb.fw - pw) AS j FROM p JOIN f fa ON fa.file = a JOIN f fb ON fb.file = b)
SELECT a, b, n, round(j, 4) AS jaccard FROM e WHERE j >= 0.15
"""


@query("cochange_edges", _EDGES)
def cochange_edges(t: Tables) -> DataFrame:
    out = cochange.edges(touches(t), min_pair=2)
    return out.select("a", "b", "n", F.round("jaccard", 4).alias("jaccard"))


@query("cochange_clusters")
def cochange_clusters(t: Tables) -> DataFrame:
    """Communities are not expressible in SQL; the tests check their properties."""
    table = cochange.edges(touches(t), min_pair=2).select("repo", F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), "jaccard")
    return cochange.cohesion(table, cochange.communities(table))


def _scopes(t: Tables) -> DataFrame:
    n = pieces(t.lineitem, t.orders)
    orders = dealt_join(t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")), t.customer.select("c_custkey", "c_mktsegment"), ["c_custkey"], n)
    orders = orders.select(F.col("o_orderkey").alias("sha"), F.lower("c_mktsegment").alias("scope")).repartition(n, "sha")
    rows = dealt_join(touches(t).join(orders, "sha").select("repo", "file", "scope"), brand_clusters(t), ["repo", "file"], n)
    return rows.groupBy("repo", "cluster_id", "scope").agg(F.count("*").alias("n"))


@query(
    "cluster_label",
    f"""WITH t AS ({TOUCHES_SQL}), c AS ({CLUSTERS_SQL}), s AS (SELECT cluster_id, lower(c_mktsegment) AS scope, count(*) AS n FROM t JOIN c USING (repo, file) JOIN orders ON o_orderkey = sha JOIN customer ON c_custkey = o_custkey GROUP BY ALL)
SELECT cluster_id, arg_min(scope, (-n, scope)) AS label FROM s GROUP BY 1 HAVING max(n) >= 2""",
)
def cluster_label(t: Tables) -> DataFrame:
    members = brand_clusters(t).withColumn("file", F.concat(F.lit("src/"), F.col("cluster_id"), F.lit("/"), F.col("file").cast("string"), F.lit(".py")))
    return cochange.label(_scopes(t), members).select("cluster_id", "label")


@query("cluster_size_quantiles", f"WITH s AS (SELECT count(*) AS n FROM ({CLUSTERS_SQL}) GROUP BY cluster_id), r AS (SELECT n, row_number() OVER (ORDER BY n) AS k, count(*) OVER () AS c FROM s) SELECT CAST(max(c) AS BIGINT) AS n, min(n) FILTER (WHERE k > c // 2) AS p50, min(n) FILTER (WHERE k > floor(c * 0.9)) AS p90, max(n) AS max FROM r")
def cluster_size_quantiles(t: Tables) -> DataFrame:
    sizes = brand_clusters(t).groupBy("cluster_id").agg(F.count("*").alias("size"))
    return cochange.size_quantiles(sizes, "size")


_COHERENT = f"SELECT repo, sha, min(cluster_id) AS cluster_id FROM ({TOUCHES_SQL}) LEFT JOIN ({CLUSTERS_SQL}) USING (repo, file) GROUP BY ALL HAVING count(DISTINCT cluster_id) = 1"


@query("coherent_commits", f"SELECT sha, cluster_id FROM ({_COHERENT})")
def coherent_commits(t: Tables) -> DataFrame:
    return cochange.coherent(touches(t), brand_clusters(t)).select("sha", "cluster_id")


@query(
    "cluster_siblings",
    f"""WITH c AS ({CLUSTERS_SQL}), t AS ({TOUCHES_SQL}), h AS ({_COHERENT}),
s AS (SELECT h.sha, h.cluster_id, c.file, row_number() OVER (PARTITION BY h.sha ORDER BY c.file) AS k FROM h JOIN c ON c.cluster_id = h.cluster_id WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.sha = h.sha AND t.file = c.file))
SELECT sha, cluster_id, string_agg(file, ',' ORDER BY file) AS siblings FROM s WHERE k <= 6 GROUP BY ALL""",
)
def cluster_siblings(t: Tables) -> DataFrame:
    own = touches(t).join(cochange.coherent(touches(t), brand_clusters(t)), ["repo", "sha"]).select("sha", "cluster_id", "file")
    out = cochange.siblings(own, brand_clusters(t))
    return out.select("sha", "cluster_id", F.array_join(F.transform("siblings", lambda x: x.cast("string")), ",").alias("siblings")).where("siblings <> ''")


_HOLDOUT = "SELECT cluster_id, row_number() OVER (ORDER BY md5('42:' || cluster_id), cluster_id) <= greatest(1, floor(count(*) OVER () * 0.1)) AS held_out FROM (SELECT DISTINCT p_brand AS cluster_id FROM part WHERE p_size <= 40)"


@query("group_holdout", _HOLDOUT)
def group_holdout(t: Tables) -> DataFrame:
    return sampling.holdout_groups(brand_clusters(t), "cluster_id", 0.1, 42)


@query(
    "leak_guard",
    f"""WITH o AS ({_HOLDOUT}), h AS ({_COHERENT}), t AS ({TOUCHES_SQL}), r AS (SELECT h.sha, h.cluster_id, t.file, o.held_out FROM h JOIN t USING (repo, sha) JOIN o USING (cluster_id)),
e AS (SELECT DISTINCT file FROM r WHERE held_out)
SELECT sha, cluster_id, file, CASE WHEN held_out THEN 'eval' ELSE 'train' END AS split FROM r WHERE held_out OR file NOT IN (SELECT file FROM e)""",
)
def leak_guard(t: Tables) -> DataFrame:
    coherent = stage(cochange.coherent(touches(t), brand_clusters(t)), "coherent")
    held = sampling.holdout_groups(brand_clusters(t), "cluster_id", 0.1, 42)
    rows = touches(t).join(coherent, ["repo", "sha"]).select("repo", "sha", "cluster_id", "file")
    return nextedit.leak_guard(rows, coherent, held, touches(t)).select("sha", "cluster_id", "file", "split")


# --- joins ----------------------------------------------------------------------------------------------------------


@query("join_left_outer", "SELECT o_orderkey, l_linenumber, l_partkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey")
def join_left_outer(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "l_linenumber", "l_partkey")


@query("group_join", "SELECT o_orderkey, count(l_orderkey) AS n_parts, string_agg(l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS parts FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def group_join(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("ls"))
    out = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    parts = F.array_join(F.transform("ls", lambda x: x["l_partkey"].cast("string")), ",")
    return out.select("o_orderkey", big(F.coalesce(F.size("ls"), F.lit(0))).alias("n_parts"), parts.alias("parts"))


@query("join_semi", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def join_semi(t: Tables) -> DataFrame:
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("join_anti", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def join_anti(t: Tables) -> DataFrame:
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")

