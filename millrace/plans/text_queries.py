"""Queries on documents: redaction, corpus, truncation, sampling, fill-in-the-middle, edits and their metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.operators import corpus, fim, metrics, nextedit, packing, sampling
from millrace.plans.base import Tables, big, query, quote, sql_redactions, sql_scrub

# White space, spelt out here so that a mistake in the engine's own set would show.
_WHITE_SQL = "'" + "".join(chr(c) for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]) + "'"


def strip_sql(x: str) -> str:
    return f"trim({x}, {_WHITE_SQL})"


def lines_sql(x: str) -> str:
    return f"(CASE WHEN string_split({x}, chr(10))[-1] = '' THEN string_split({x}, chr(10))[:-2] ELSE string_split({x}, chr(10)) END)"


def normalise_sql(x: str) -> str:
    return f"array_to_string(list_transform({lines_sql(strip_sql(f'split_part({x}, {quote(X.TERMINATOR)}, 1)'))}, lambda l: rtrim(l, {_WHITE_SQL})), chr(10))"


_MARKED = f"SELECT doc_id, text, source, {sql_scrub('text')} AS clean_text, {sql_redactions('text')} AS n_redactions FROM documents"
_REASONS = f"""
WITH m AS ({_MARKED}), r AS (
  SELECT *, CASE WHEN length(text) < 200 THEN 'too_short' WHEN regexp_matches(text, {quote(X.FATAL_SECRET)}) THEN 'private_key'
    WHEN regexp_matches(clean_text, {quote(X.RESIDUAL_SECRET)}) THEN 'residual_secret' END AS reason FROM m
), d AS (
  SELECT *, CASE WHEN reason IS NULL AND row_number() OVER (PARTITION BY md5(clean_text), reason IS NULL ORDER BY doc_id) > 1 THEN 'duplicate' ELSE reason END AS drop_reason FROM r
)
"""


@query("corpus_clean", _REASONS + "SELECT doc_id, clean_text AS text, n_redactions FROM d WHERE drop_reason IS NULL")
def corpus_clean(t: Tables) -> DataFrame:
    return corpus.corpus_clean(t.documents.select("doc_id", "text", "source")).select("doc_id", "text", "n_redactions")


@query("corpus_drop_reasons", _REASONS + "SELECT coalesce(drop_reason, 'kept') AS drop_reason, count(*) AS n, CAST(sum(n_redactions) AS BIGINT) AS n_redactions FROM d GROUP BY 1")
def corpus_drop_reasons(t: Tables) -> DataFrame:
    rows = corpus.drop_reasons(t.documents.select("doc_id", "text"))
    return rows.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")).agg(F.count("*").alias("n"), F.sum("n_redactions").alias("n_redactions"))


@query("scrub_secrets", f"SELECT doc_id, md5({sql_scrub('text')}) AS clean_md5, {sql_redactions('text')} AS n_redactions FROM documents")
def scrub_secrets(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.redacted("text").alias("_r")).select("doc_id", F.md5("_r.text").alias("clean_md5"), F.col("_r.n").alias("n_redactions"))


@query("secret_gate", f"SELECT count(*) AS n_docs, count(*) FILTER (WHERE regexp_matches({sql_scrub('text')}, {quote(X.RESIDUAL_SECRET)})) AS n_leaks FROM documents")
def secret_gate(t: Tables) -> DataFrame:
    return t.documents.agg(F.count("*").alias("n_docs"), F.count(F.when(X.scrub("text").rlike(X.RESIDUAL_SECRET), 1)).alias("n_leaks"))


@query("dedup_content", "SELECT doc_id, md5(text) AS content_md5 FROM documents WHERE length(text) >= 200 QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1")
def dedup_content(t: Tables) -> DataFrame:
    return corpus.first_of_content(t.documents.select("doc_id", "text").where(F.length("text") >= 200), "doc_id").select("doc_id", F.md5("text").alias("content_md5"))


@query(
    "corpus_chunks",
    """
WITH c AS (SELECT doc_id, source || '/' || doc_id || '.md' AS source_path, text, unnest(range(0, (greatest(length(text), 1) - 1) // 2000 + 1)) AS chunk FROM documents),
p AS (SELECT doc_id, source_path, chunk, substr(text, CAST(chunk * 2000 + 1 AS BIGINT), 2000) AS body FROM c)
SELECT doc_id, source_path, chunk, CASE WHEN chunk = 0 THEN '# Document: ' ELSE '# Document (cont.): ' END || source_path || chr(10) || chr(10) || body AS text
FROM p WHERE chunk = 0 OR length(body) >= 200
""",
)
def corpus_chunks(t: Tables) -> DataFrame:
    out = corpus.chunks(t.documents, corpus.document_path(F.col("source"), F.col("doc_id")), max_chars=2000)
    return out.select("doc_id", "source_path", "chunk", "text")


@query(
    "truncate_output",
    """
SELECT doc_id, CASE WHEN length(text) <= 3064 THEN text ELSE left(text, 2000) || chr(10) || '... [' || format('{:,}', length(text) - 3000) || ' chars elided] ...' || chr(10) || right(text, 1000) END AS text,
       CAST(CASE WHEN length(text) > 3064 THEN length(text) - 3000 ELSE 0 END AS BIGINT) AS chars_elided FROM documents
""",
)
def truncate_output(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.truncate_head_tail("text").alias("text"), X.elided_chars("text").alias("chars_elided"))


@query(
    "truncate_json",
    """
WITH j AS (SELECT doc_id, '{"doc": ' || doc_id || ', "body": "' || replace(replace(text, '"', ''''), chr(10), ' ') || '"}' AS js FROM documents)
SELECT doc_id, CASE WHEN length(js) <= 364 THEN js ELSE left(js, 200) || chr(10) || '... [' || format('{:,}', length(js) - 300) || ' chars elided] ...' || chr(10) || right(js, 100) END AS js FROM j
""",
)
def truncate_json(t: Tables) -> DataFrame:
    js = F.concat(F.lit('{"doc": '), F.col("doc_id").cast("string"), F.lit(', "body": "'), F.translate("text", '"\n', "' "), F.lit('"}'))
    return t.documents.select("doc_id", X.truncate_head_tail(js, 200, 100).alias("js"))


@query("truncate_head", "SELECT doc_id, CASE WHEN length(text) <= 2000 THEN text ELSE left(text, 2000) || chr(10) || '... [truncated, ' || length(text) || ' total chars]' END AS text FROM documents")
def truncate_head(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.truncate_head("text").alias("text"))


@query("token_estimate", "SELECT doc_id, CAST(length(text) // 4 AS BIGINT) AS tokens, round(length(text) / 3.6::DOUBLE, 4) AS corpus_tokens FROM documents")
def token_estimate(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.token_estimate(F.length("text")).alias("tokens"), F.round(F.length("text") / F.lit(X.CORPUS_CHARS_PER_TOKEN), 4).alias("corpus_tokens"))


@query(
    "budget_sample",
    """
WITH RECURSIVE o AS (SELECT doc_id, length(text) AS n, row_number() OVER (ORDER BY md5('42:' || doc_id)) AS k FROM documents WHERE length(text) <= 300000),
f(k, used, took) AS (
  SELECT 0::BIGINT, 0::BIGINT, false
  UNION ALL
  SELECT o.k, CASE WHEN used + n <= 300000 THEN used + n ELSE used END, used + n <= 300000 FROM f JOIN o ON o.k = f.k + 1
)
SELECT doc_id, CAST(n AS BIGINT) AS n_chars FROM o JOIN f USING (k) WHERE took
""",
)
def budget_sample(t: Tables) -> DataFrame:
    out = corpus.budget_sample(t.documents.select("doc_id", "text"), 300_000, sampling.shuffle_key(F.col("doc_id"), 42), F.length("text"))
    return out.select("doc_id", big(F.length("text")).alias("n_chars"))


@query("lang_distribution", "SELECT lang, count(*) AS n FROM documents GROUP BY lang ORDER BY n DESC, lang LIMIT 15")
def lang_distribution(t: Tables) -> DataFrame:
    return t.documents.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(15)


@query("seeded_sample", "SELECT doc_id FROM documents ORDER BY md5('1234:' || doc_id), doc_id LIMIT 300")
def seeded_sample(t: Tables) -> DataFrame:
    return sampling.seeded_sample(t.documents, "doc_id", 300, 1234).select("doc_id")


@query("sample_limit", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 200")
def sample_limit(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang").orderBy("doc_id").limit(200)


@query("keep_paths", f"SELECT doc_id, path FROM (SELECT doc_id, source || '/' || CASE doc_id % 4 WHEN 0 THEN 'build/' WHEN 1 THEN '.claude/skills/' WHEN 2 THEN 'rebuild/' ELSE 'src/' END || doc_id || '.md' AS path FROM documents) WHERE NOT regexp_matches(path, {quote(corpus.SKIP_DIRS)}) AND NOT regexp_matches(path, {quote(corpus.SKIP_INSTALLED)})")
def keep_paths(t: Tables) -> DataFrame:
    k = F.col("doc_id") % 4
    folder = F.when(k == 0, "build/").when(k == 1, ".claude/skills/").when(k == 2, "rebuild/").otherwise("src/")
    rows = t.documents.select("doc_id", F.concat("source", F.lit("/"), folder, F.col("doc_id").cast("string"), F.lit(".md")).alias("path"))
    return corpus.keep_paths(rows)


_USABLE = "len(ls) BETWEEN 7 AND 500 AND len(list_filter(ls, lambda x: length(x) > 200)) = 0"


def _split_sql(k: str) -> str:
    return f"array_to_string(ls[1:{k}], chr(10)) AS prefix, ls[{k} + 1] AS middle, array_to_string(ls[{k} + 2:], chr(10)) AS suffix"


_FIM = f"""
WITH f AS (SELECT doc_id, lang, string_split(text, chr(10)) AS ls FROM documents), u AS (SELECT * FROM f WHERE {_USABLE}),
c AS (SELECT doc_id, lang, ls, unnest(range(5, len(ls) - 1)) AS line FROM u),
p AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY md5('42:' || doc_id || ':' || line), line) <= least(5, len(ls) - 6))
SELECT doc_id, lang, line, {_split_sql('line')} FROM p WHERE length({strip_sql('ls[line + 1]')}) >= 3
"""


def _candidates(t: Tables) -> DataFrame:
    return fim.fim_candidates(t.documents.select("doc_id", "lang", "text"), "doc_id")


@query("fim_candidates", _FIM)
def fim_candidates(t: Tables) -> DataFrame:
    return _candidates(t)


@query(
    "fim_midpoint",
    f"WITH f AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE length(text) > 50), m AS (SELECT doc_id, ls, len(ls) // 2 AS k FROM f WHERE len(ls) > 3) SELECT doc_id, {_split_sql('k')} FROM m WHERE {strip_sql('ls[k + 1]')} <> ''",
)
def fim_midpoint(t: Tables) -> DataFrame:
    return fim.fim_midpoint(t.documents.select("doc_id", "text"))


@query(
    "fim_render",
    f"WITH e AS ({_FIM}) SELECT doc_id, line, md5('<|fim_prefix|>' || prefix || '<|fim_suffix|>' || suffix || '<|fim_middle|>' || middle || '<|fim_hole|><|endoftext|>') AS qwen, md5('<fim_prefix>' || prefix || '<fim_suffix>' || suffix || '<fim_middle>' || middle) AS starcoder FROM e",
)
def fim_render(t: Tables) -> DataFrame:
    parts = [F.col(c) for c in ("prefix", "middle", "suffix")]
    return _candidates(t).select("doc_id", "line", F.md5(fim.render_qwen(*parts)).alias("qwen"), F.md5(fim.render_starcoder(*parts)).alias("starcoder"))


# A diff stands for each document: its lines removed, added and kept in turn, in two hunks.
_DIFF_SQL = """
SELECT doc_id, source, CASE WHEN len(ls) < 2 THEN '' ELSE 'diff --git' || chr(10) || '@@ -' || (doc_id % 90 + 1) || ',9 +1,9 @@' || chr(10) || array_to_string(ls[1:len(ls) // 2], chr(10)) || chr(10) || '\\ No newline' || chr(10) || '@@ -' || (doc_id % 90 + 200) || ' +7 @@ tail' || chr(10) || array_to_string(ls[len(ls) // 2 + 1:], chr(10)) END AS diff
FROM (SELECT doc_id, source, list_transform(string_split(text, chr(10)), lambda x, i: (CASE i % 3 WHEN 1 THEN '-' WHEN 2 THEN '+' ELSE ' ' END) || x) AS ls FROM documents)
"""
_HUNKS_SQL = f"""
WITH d AS ({_DIFF_SQL}), l AS (SELECT doc_id, source, unnest({lines_sql('diff')}) AS l, unnest(range(1, len({lines_sql('diff')}) + 1)) AS i FROM d WHERE diff <> ''),
h AS (SELECT *, regexp_matches(l, '^@@ -[0-9]+') AS head, sum(CASE WHEN regexp_matches(l, '^@@ -[0-9]+') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS h FROM l),
g AS (
  SELECT doc_id, source, h, max(CASE WHEN head THEN CAST(regexp_extract(l, '^@@ -([0-9]+)', 1) AS BIGINT) END) AS start,
    coalesce(list(substr(l, 2) ORDER BY i) FILTER (WHERE NOT head AND left(l, 1) IN ('-', ' ')), []) AS pre,
    coalesce(list(substr(l, 2) ORDER BY i) FILTER (WHERE NOT head AND left(l, 1) IN ('+', ' ')), []) AS post,
    list(l ORDER BY i) AS raw
  FROM h WHERE h > 0 AND (head OR left(l, 1) <> '\\') GROUP BY ALL
), k AS (SELECT * FROM g WHERE pre <> post)
"""


def _hunks(t: Tables) -> DataFrame:
    prefix = lambda x, i: F.concat(F.when(i % 3 == 0, "-").when(i % 3 == 1, "+").otherwise(" "), x)
    rows = t.documents.select("doc_id", "source", F.transform(F.split("text", "\n"), prefix).alias("ls"))
    half = F.floor(F.size("ls") / 2).cast("int")
    key = F.col("doc_id") % 90
    head = F.concat(F.lit("diff --git\n@@ -"), (key + 1).cast("string"), F.lit(",9 +1,9 @@\n"), F.array_join(F.slice("ls", F.lit(1), half), "\n"))
    tail = F.concat(F.lit("\n\\ No newline\n@@ -"), (key + 200).cast("string"), F.lit(" +7 @@ tail\n"), F.array_join(F.slice("ls", half + 1, F.size("ls")), "\n"))
    rows = rows.select("doc_id", "source", F.when(F.size("ls") < 2, "").otherwise(F.concat(head, tail)).alias("diff"))
    return nextedit.parse_hunks(rows, ["doc_id", "source"])


@query("hunk_parse", _HUNKS_SQL + "SELECT doc_id, start, CAST(len(pre) AS BIGINT) AS n_pre, CAST(len(post) AS BIGINT) AS n_post, md5(array_to_string(pre, chr(10))) AS pre_md5, md5(array_to_string(post, chr(10))) AS post_md5, md5(array_to_string(raw, chr(10))) AS raw_md5 FROM k")
def hunk_parse(t: Tables) -> DataFrame:
    digest = lambda c: F.md5(F.array_join(c, "\n")).alias(f"{c}_md5")
    return _hunks(t).select("doc_id", "start", big(F.size("pre")).alias("n_pre"), big(F.size("post")).alias("n_post"), digest("pre"), digest("post"), digest("raw"))


# A commit is a group of eight documents; a document is a file of it.
_BLOCK_SQL = "['--- ' || path] || (CASE WHEN len(raw) - 1 > 40 THEN raw[2:21] || ['... [' || (len(raw) - 41) || ' lines elided] ...'] || raw[-20:] ELSE raw[2:] END)"
_HISTORY_SQL = (
    _HUNKS_SQL
    + f""", f AS (SELECT doc_id // 8 AS sha, 'd' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS path, start, pre, post, raw FROM k),
b AS (SELECT *, {_BLOCK_SQL} AS block FROM f),
e AS (SELECT *, list(block) OVER w AS prior, row_number() OVER (PARTITION BY sha ORDER BY path, start) AS n FROM b WINDOW w AS (PARTITION BY sha ORDER BY path, start ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)),
r AS (SELECT * FROM e WHERE n > 1)
"""
)


def _history(t: Tables) -> DataFrame:
    rows = _hunks(t).select(F.floor(F.col("doc_id") / 8).alias("sha"), F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("path"), "start", "pre", "post", "raw")
    return nextedit.edit_history(rows)


@query("edit_history", _HISTORY_SQL + "SELECT sha, path, start, CAST(len(prior) AS BIGINT) AS n_prior, md5(array_to_string(flatten(prior), chr(10))) AS prior_md5 FROM r")
def edit_history(t: Tables) -> DataFrame:
    return _history(t).select("sha", "path", "start", big(F.size("prior")).alias("n_prior"), F.md5(F.array_join(F.flatten("prior"), "\n")).alias("prior_md5"))


def _prompt_sql(prior: str) -> str:
    return (
        f"array_to_string((CASE WHEN len({prior}) > 0 THEN ['### Edits already made'] || flatten({prior}) || [''] ELSE [] END) || ['### Related files (same feature cluster)', 'a.md', 'b.md', '']"
        f" || ['### Current file: ' || path, '<<<<<<< CURRENT', array_to_string(pre, chr(10)), '======='], chr(10))"
    )


def _siblings() -> object:
    return F.array(F.lit("a.md"), F.lit("b.md"))


@query("prompt_build", _HISTORY_SQL + f"SELECT sha, path, start, md5({_prompt_sql('prior')}) AS prompt_md5, md5(array_to_string(post, chr(10)) || chr(10) || '>>>>>>> UPDATED') AS target_md5 FROM r WHERE len(pre) <= 80 AND len(post) <= 80")
def prompt_build(t: Tables) -> DataFrame:
    rows = _history(t).where(nextedit.within_region(F.col("pre"), F.col("post")))
    text = nextedit.prompt(F.flatten("prior"), F.col("path"), F.col("pre"), _siblings())
    return rows.select("sha", "path", "start", F.md5(text).alias("prompt_md5"), F.md5(nextedit.target(F.col("post"))).alias("target_md5"))


@query(
    "prompt_budget",
    _HISTORY_SQL
    + f""", c AS (SELECT *, unnest(range(0, len(prior) + 1)) AS cut FROM r WHERE len(pre) <= 80 AND len(post) <= 80),
s AS (SELECT *, prior[CAST(cut + 1 AS BIGINT):] AS kept FROM c), p AS (SELECT *, {_prompt_sql('kept')} AS prompt FROM s),
o AS (SELECT * FROM p WHERE length(prompt) <= 4000 QUALIFY row_number() OVER (PARTITION BY sha, path, start ORDER BY cut) = 1)
SELECT sha, path, start, CAST(len(kept) AS BIGINT) AS n_kept, md5(prompt) AS prompt_md5 FROM o""",
)
def prompt_budget(t: Tables) -> DataFrame:
    rows = _history(t).where(nextedit.within_region(F.col("pre"), F.col("post")))
    rows = rows.withColumn("kept", nextedit.fit_history(F.col("prior"), F.col("path"), F.col("pre"), _siblings(), 4000))
    rows = rows.withColumn("prompt", nextedit.prompt(F.flatten("kept"), F.col("path"), F.col("pre"), _siblings())).where(F.length("prompt") <= 4000)
    return rows.select("sha", "path", "start", big(F.size("kept")).alias("n_kept"), F.md5("prompt").alias("prompt_md5"))


@query("normalise_text", f"SELECT doc_id, md5({normalise_sql('text')}) AS normal_md5 FROM documents")
def normalise_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(X.normalise_prediction("text")).alias("normal_md5"))


# A prediction for a document is the document ten before it, with the terminator for even ones; copies make some of them right.
_PAIRS_SQL = """
SELECT g.doc_id, g.source AS cluster_id, g.text || chr(10) || '>>>>>>> UPDATED' AS completion,
  coalesce(CASE WHEN g.doc_id % 3 = 0 THEN g.text WHEN g.doc_id % 3 = 1 THEN p.text ELSE left(g.text, CAST(length(g.text) // 2 AS BIGINT)) END, '') || CASE WHEN g.doc_id % 2 = 0 THEN chr(10) || '>>>>>>> UPDATED' ELSE '' END AS prediction,
  '### Current file: x' || chr(10) || '<<<<<<< CURRENT' || chr(10) || coalesce(p.text, '') || chr(10) || '=======' AS prompt
FROM documents g LEFT JOIN documents p ON p.doc_id = g.doc_id - 10
"""


def _pairs(t: Tables) -> DataFrame:
    g = t.documents.select("doc_id", F.col("source").alias("cluster_id"), "text")
    p = t.documents.select((F.col("doc_id") + 10).alias("doc_id"), F.col("text").alias("other"))
    k = F.col("doc_id")
    guess = F.when(k % 3 == 0, F.col("text")).when(k % 3 == 1, F.col("other")).otherwise(F.left("text", F.floor(F.length("text") / 2).cast("int")))
    return g.join(p, "doc_id", "left").select(
        "doc_id",
        "cluster_id",
        F.concat("text", F.lit("\n" + X.TERMINATOR)).alias("completion"),
        F.concat(F.coalesce(guess, F.lit("")), F.when(k % 2 == 0, "\n" + X.TERMINATOR).otherwise("")).alias("prediction"),
        F.concat(F.lit("### Current file: x\n<<<<<<< CURRENT\n"), F.coalesce("other", F.lit("")), F.lit("\n=======")).alias("prompt"),
    )


_F1_SQL = f"""
WITH q AS ({_PAIRS_SQL}), p AS (SELECT doc_id, v, count(*) AS c FROM (SELECT doc_id, unnest({lines_sql(normalise_sql('prediction'))}) AS v FROM q) WHERE {strip_sql('v')} <> '' GROUP BY ALL),
g AS (SELECT doc_id, v, count(*) AS d FROM (SELECT doc_id, unnest({lines_sql(normalise_sql('completion'))}) AS v FROM q) WHERE {strip_sql('v')} <> '' GROUP BY ALL),
t AS (SELECT doc_id, coalesce(sum(least(c, d)) FILTER (WHERE c IS NOT NULL AND d IS NOT NULL), 0) AS o, coalesce(sum(c), 0) AS np, coalesce(sum(d), 0) AS ng FROM p FULL JOIN g USING (doc_id, v) GROUP BY doc_id),
f AS (SELECT q.doc_id, CASE WHEN coalesce(np, 0) = 0 AND coalesce(ng, 0) = 0 THEN 1.0 WHEN coalesce(o, 0) = 0 THEN 0.0 ELSE 2.0 * o / (np + ng) END AS line_f1 FROM q LEFT JOIN t USING (doc_id))
"""


@query("line_f1", _F1_SQL + "SELECT doc_id, round(CAST(line_f1 AS DOUBLE), 6) AS line_f1 FROM f")
def line_f1(t: Tables) -> DataFrame:
    return metrics.line_f1(_pairs(t), "doc_id", "prediction", "completion").select("doc_id", F.round("line_f1", 6).alias("line_f1"))


_FIRST = "coalesce(string_split({}, chr(10))[1], '')"
_RESULTS_SQL = f"""
WITH q AS ({_PAIRS_SQL}), n AS (SELECT *, {normalise_sql('prediction')} AS p, {normalise_sql('completion')} AS g, {normalise_sql("regexp_extract(prompt, '(?s)<<<<<<< CURRENT' || chr(10) || '(.*?)' || chr(10) || '?=======\\s*$', 1)")} AS r FROM q),
e AS (SELECT doc_id, cluster_id, p = g AS exact_match, contains(prediction, '>>>>>>> UPDATED') AS format_valid, {_FIRST.format('p')} = {_FIRST.format('g')} AND {_FIRST.format('g')} <> '' AS first_line_hit, p = r AS no_op FROM n)
"""


@query("edit_results", _RESULTS_SQL + "SELECT * FROM e")
def edit_results(t: Tables) -> DataFrame:
    return metrics.edit_results(_pairs(t)).select("doc_id", "cluster_id", "exact_match", "format_valid", "first_line_hit", "no_op")


def _mean_sql(flag: str) -> str:
    return f"round(avg(CASE WHEN {flag} THEN 1.0::DOUBLE ELSE 0.0 END), 4) AS {flag}"


@query("edit_metrics", _RESULTS_SQL + f"SELECT count(*) AS n, {', '.join(map(_mean_sql, ('exact_match', 'format_valid', 'first_line_hit', 'no_op')))} FROM e")
def edit_metrics(t: Tables) -> DataFrame:
    return metrics.edit_results(_pairs(t)).agg(F.count("*").alias("n"), *[metrics.mean_of(c, c) for c in ("exact_match", "format_valid", "first_line_hit", "no_op")])


@query("weakest_groups", _RESULTS_SQL + "SELECT cluster_id, round(avg(CASE WHEN exact_match THEN 1.0::DOUBLE ELSE 0.0 END), 4) AS score, count(*) AS n FROM e GROUP BY 1 HAVING count(*) >= 5 ORDER BY score, cluster_id, n LIMIT 5")
def weakest_groups(t: Tables) -> DataFrame:
    return metrics.weakest_groups(metrics.edit_results(_pairs(t)), "cluster_id", "exact_match")


_LABELS = ("Code region being edited", "Reference edit", "Predicted edit")


@query("judge_prompt", f"WITH q AS ({_PAIRS_SQL}) SELECT doc_id, md5('### {_LABELS[0]}' || chr(10) || right(prompt, 1500) || chr(10) || chr(10) || '### {_LABELS[1]}' || chr(10) || left(completion, 1500) || chr(10) || chr(10) || '### {_LABELS[2]}' || chr(10) || left(prediction, 1500)) AS prompt_md5 FROM q")
def judge_prompt(t: Tables) -> DataFrame:
    text = metrics.judge_prompt(F.col("prompt"), F.col("completion"), F.col("prediction"), _LABELS)
    return _pairs(t).select("doc_id", F.md5(text).alias("prompt_md5"))


# A document's words stand for its token ids.
_PACK_SQL = """
WITH w AS (SELECT doc_id, len(string_split(text, ' ')) + 1 AS n, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS b FROM documents),
o AS (SELECT *, sum(n) OVER (PARTITION BY b ORDER BY doc_id) AS e, sum(n) OVER (PARTITION BY b) AS total FROM w),
x AS (SELECT *, unnest(range(CAST((e - n) // 512 AS BIGINT), CAST((e - 1) // 512 + 1 AS BIGINT))) AS block FROM o),
p AS (SELECT b AS batch, block, doc_id, greatest(e - n, block * 512) AS lo, least(e, (block + 1) * 512) AS hi, e - n AS s FROM x WHERE block < total // 512)
"""


def _lengths(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", (F.size(F.split("text", " ")) + 1).cast("long").alias("n"))


@query("pack_sequences", _PACK_SQL + "SELECT CAST(batch AS BIGINT) AS batch, CAST(block AS BIGINT) AS block, doc_id, CAST(lo - s AS BIGINT) AS from_token, CAST(hi - lo AS BIGINT) AS n_tokens, CAST(lo - block * 512 AS BIGINT) AS place FROM p")
def pack_sequences(t: Tables) -> DataFrame:
    out = packing.pack_plan(_lengths(t), "doc_id", "n", 512, batch=100)
    return out.select(*[big(c).alias(c) for c in out.columns])


@query("pack_stats", _PACK_SQL + "SELECT (SELECT count(*) FROM documents) AS n_rows, count(*) AS n_blocks, round((SELECT count(*) FROM documents) / CAST(count(*) AS DOUBLE), 4) AS ratio, CAST(count(*) * 2 // (2 * 8) AS BIGINT) AS steps FROM (SELECT DISTINCT batch, block FROM p)")
def pack_stats(t: Tables) -> DataFrame:
    blocks = packing.pack_plan(_lengths(t), "doc_id", "n", 512, batch=100).select("batch", "block").distinct().agg(F.count("*").alias("n_blocks"))
    rows = t.documents.agg(F.count("*").alias("n_rows"))
    both = rows.join(F.broadcast(blocks))  # one row each
    return both.select("n_rows", "n_blocks", F.round(F.col("n_rows") / F.col("n_blocks"), 4).alias("ratio"), F.floor(F.col("n_blocks") * 2 / (2 * 8)).alias("steps"))
