"""End-to-end chains of operators. Each takes and gives DataFrames; nothing is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import codecs
from millrace.operators import cochange, commits, conversations, conversion, corpus, fim, nextedit, packing, sampling
from millrace.sources import gitlog, jsonl, sessions


def turn_content(turns: DataFrame) -> DataFrame:
    """Turns (role, text, parts) to rendered content: text and thinking parts, then calls in the marker format, in their order."""
    blank = lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)^\s+|\s+$", "")
    rows = turns.withColumn("_parts", F.filter("parts", lambda p: p["type"].isin("text", "thinking", "tool_call") & ~((p["type"] == "thinking") & (blank(p["text"]) == ""))))
    rows = rows.withColumn("_args", F.transform("_parts", lambda p: p["input"]))
    items = F.transform(
        "_parts",
        lambda p, i: F.when(p["type"] == "thinking", F.concat(F.lit("[THINKING]"), blank(p["text"]), F.lit("[/THINKING]")))
        .when(p["type"] == "text", F.coalesce(p["text"], F.lit("")))
        .otherwise(codecs.render_markers(F.coalesce(p["name"], F.lit("None")), F.coalesce(F.nullif(F.get("_pretty", i), F.lit("")), F.lit("{}")))),
    )
    rows = rows.withColumn("_pretty", codecs.pretty_json_list("_args"))
    content = F.when(F.col("role") == "tool_result", codecs.render_result(F.col("text"))).when((F.col("role") == "assistant") & (F.size("_parts") > 0), F.array_join(items, "\n")).otherwise(F.coalesce("text", F.lit("")))
    return rows.withColumn("content", content).drop("_parts", "_args", "_pretty")


def agentic_sft(turns: DataFrame, key: str, pos: str, directory: Column | None = None, seed: int = 42) -> DataFrame:
    """Turns to windows, to examples, deduplicated by their whole payload and in shuffled order."""
    windows = conversations.request_windows(turn_content(turns), conv=key, pos=pos)
    out = conversations.agentic_examples(windows, [key, "window_id"], pos, directory)
    out = out.withColumn("_md5", F.md5(F.to_json("messages")))
    return commits.first_by_key(out, "_md5", key, "window_id").orderBy(sampling.shuffle_key(F.col("_md5"), seed)).drop("_md5")


def native_sft(examples: DataFrame, row_id: str) -> DataFrame:
    """Examples in the native call format; those with an unreadable call are dropped."""
    return conversion.convert_examples(examples, row_id).where("drop_reason is null").drop("drop_reason")


def next_edits(spark: SparkSession, roots: list[str], holdout: float = 0.1, min_pair: int = cochange.MIN_PAIR, min_jaccard: float = cochange.MIN_JACCARD, context: int = 10) -> DataFrame:
    """Repositories to next-edit rows with a leak-free split: log, filters, clusters, coherent commits, diffs, prompts."""
    repos = gitlog.repo_table(spark, gitlog.find_repos(roots))
    log = commits.drop_reason(commits.parse_log(gitlog.log_lines(repos), gitlog.tracked_files(repos))).where("drop_reason is null")
    log = commits.first_by_key(log, "sha", "repo")
    touches = log.select("repo", "sha", "ts", F.explode("files").alias("file"))
    edges = cochange.edges(touches, min_pair, min_jaccard)
    members = cochange.communities(edges)
    sized = cochange.cohesion(edges, members).select("repo", "cluster_id")
    members = members.join(sized, ["repo", "cluster_id"], "left_semi")
    coherent = cochange.coherent(touches.select("repo", "sha", "file"), members)
    wanted = touches.join(coherent, ["repo", "sha"]).select("repo", "sha", "cluster_id", F.col("file").alias("path"))
    hunks = nextedit.parse_hunks(gitlog.diffs(wanted, context), ["repo", "sha", "path"]).join(wanted, ["repo", "sha", "path"])
    touched = hunks.select("sha", "cluster_id", F.col("path").alias("file"))
    rows = nextedit.next_edit_examples(hunks, cochange.siblings(touched, members)).withColumn("file", F.col("path"))
    held = sampling.holdout_groups(members, "cluster_id", holdout, 42)
    return nextedit.leak_guard(rows, coherent, held, touches.select("repo", "sha", "file")).drop("file")


def markdown_corpus(spark: SparkSession, path: str, budget_millions: float | None = None) -> DataFrame:
    """A folder of Markdown files to scrubbed, deduplicated, budgeted chunks; fails before it writes if a secret is left."""
    files = corpus.keep_paths(jsonl.read_text_files(spark, path, "*.md"))
    kept = corpus.corpus_clean(files, order="path")
    if budget_millions is not None:
        kept = corpus.budget_sample(kept, corpus.budget_for_tokens(budget_millions), sampling.shuffle_key(F.col("path"), 42), F.length("text"))
    return corpus.assert_no_secrets(corpus.chunks(kept, F.col("path"))).select("text", "source_path")


def fim_formats(files: DataFrame, key: str = "path") -> DataFrame:
    """Files to rendered examples in every format: format, text, language."""
    rows = fim.fim_candidates(files.where(fim.include_file(F.col(key))), key)
    language = F.regexp_extract(key, r"\.([^.]+)$", 1)
    parts = [F.col(c) for c in ("prefix", "middle", "suffix")]
    made = F.array(F.struct(F.lit("qwen").alias("format"), fim.render_qwen(*parts).alias("text")), F.struct(F.lit("starcoder").alias("format"), fim.render_starcoder(*parts).alias("text")))
    return rows.select(F.explode(made).alias("_f"), language.alias("language")).select("_f.*", "language")


def all_conversations(*sources: DataFrame) -> DataFrame:
    """Sources of turns as one, whatever columns each has."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def packed(rows: DataFrame, order: str, ids: str, block: int, end_id: int, batch: int = packing.BATCH_ROWS) -> DataFrame:
    """Token rows to blocks of exactly ``block`` ids with masks of ones."""
    return packing.pack_sequences(rows, order, ids, block, end_id, batch)


def conversations_with_counts(turns: DataFrame, key: str, least: int) -> tuple[DataFrame, DataFrame]:
    """Nested conversations, and per role the numbers of turns and of tool calls."""
    calls = F.size(F.filter(F.coalesce("parts", F.array().cast(f"array<{sessions.PART}>")), lambda p: p["type"] == "tool_call"))
    stats = turns.groupBy("role").agg(F.count("*").alias("turns"), F.sum(calls).alias("tool_calls"))
    return sessions.conversations(turns, key, least), stats
