"""Next-edit examples: hunks of unified diffs, edit history, prompts under a budget, leak-free splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.text import TERMINATOR, lines_of
from millrace.graph import dealt_join
from millrace.staging import pieces

# Fixed values.
HUNK_HEADER = r"^@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@"
MAX_REGION_LINES = 80
MAX_PRIOR_HUNKS = 4
MAX_PRIOR_LINES = 40
MAX_SIBLINGS = 6
MAX_PROMPT_CHARS = 11000


def parse_hunks(diffs: DataFrame, keys: list[str], diff: str = "diff") -> DataFrame:
    """Hunks that change something: keys, start (old-file line), pre, post and raw lines.

    Lines before the first header and ``\\`` notes are left out; removed lines go to pre, added ones to post, context lines to both, others to raw alone.
    """
    lines = diffs.select(*keys, F.posexplode(lines_of(diff)).alias("_i", "_l"))
    head = F.col("_l").rlike(HUNK_HEADER)
    w = Window.partitionBy(*keys).orderBy("_i")
    rows = lines.withColumn("_head", head).withColumn("_h", F.sum(head.cast("int")).over(w)).where((F.col("_h") > 0) & (F.col("_head") | ~F.startswith("_l", F.lit("\\"))))
    first, rest = F.left("_l", F.lit(1)), F.substr("_l", F.lit(2))
    plain = ~F.col("_head")
    kept = lambda marks: F.array_sort(F.collect_list(F.when(plain & first.isin(marks), F.struct("_i", rest.alias("t")))))
    out = rows.groupBy(*keys, "_h").agg(
        F.max(F.when(F.col("_head"), F.regexp_extract("_l", HUNK_HEADER, 1).cast("long"))).alias("start"),
        kept(["-", " "]).alias("pre"),
        kept(["+", " "]).alias("post"),
        F.array_sort(F.collect_list(F.struct("_i", F.col("_l").alias("t")))).alias("raw"),
    )
    texts = lambda c: F.transform(c, lambda x: x["t"])
    out = out.select(*keys, "start", *[texts(c).alias(c) for c in ("pre", "post", "raw")])
    return out.where(F.col("pre") != F.col("post"))


def history_block(path: Column, raw: Column, most: int = MAX_PRIOR_LINES) -> Column:
    """A hunk in the history: its path line and its lines, long ones with the middle elided."""
    body = F.slice(raw, F.lit(2), F.greatest(F.size(raw) - 1, F.lit(0)))
    keep = most // 2
    note = F.concat(F.lit("... ["), (F.size(body) - 2 * keep).cast("string"), F.lit(" lines elided] ..."))
    short = F.when(F.size(body) > most, F.concat(F.slice(body, 1, keep), F.array(note), F.slice(body, -keep, keep))).otherwise(body)
    return F.concat(F.array(F.concat(F.lit("--- "), path)), short)


def edit_history(hunks: DataFrame, sha: str = "sha", most: int = MAX_PRIOR_HUNKS, block: Column | None = None) -> DataFrame:
    """Every hunk but a commit's first, with ``prior``: the blocks of up to ``most`` hunks before it, in (path, start) order."""
    w = Window.partitionBy(sha).orderBy("path", "start")
    rows = hunks.withColumn("_b", block if block is not None else history_block(F.col("path"), F.col("raw")))
    rows = rows.withColumn("prior", F.collect_list("_b").over(w.rowsBetween(-most, -1))).withColumn("_k", F.row_number().over(w))
    return rows.where("_k > 1").drop("_k", "_b")


def prompt(prior: Column, path: Column, pre: Column, siblings: Column) -> Column:
    """The prompt of a hunk: history lines, related files, the current region."""
    history = F.when(F.size(prior) > 0, F.concat(F.array(F.lit("### Edits already made")), prior, F.array(F.lit("")))).otherwise(F.array().cast("array<string>"))
    related = F.when(F.size(siblings) > 0, F.concat(F.array(F.lit("### Related files (same feature cluster)")), siblings, F.array(F.lit("")))).otherwise(F.array().cast("array<string>"))
    tail = F.array(F.concat(F.lit("### Current file: "), path), F.lit("<<<<<<< CURRENT"), F.array_join(pre, "\n"), F.lit("======="))
    return F.array_join(F.concat(history, related, tail), "\n")


def target(post: Column) -> Column:
    return F.concat(F.array_join(post, "\n"), F.lit("\n" + TERMINATOR))


def fit_history(blocks: Column, path: Column, pre: Column, siblings: Column, most: int = MAX_PROMPT_CHARS) -> Column:
    """The newest blocks (an array of line arrays) that fit the budget: the oldest go first.

    The size with k blocks is the size with none plus that of the kept blocks, so the answer is the first k that fits, without building prompts.
    """
    bare = F.length(prompt(F.array().cast("array<string>"), path, pre, siblings))
    sizes = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + F.length(x) + 1))
    frame = len("### Edits already made") + 2
    total = lambda k: bare + frame + F.aggregate(F.slice(sizes, k + 1, F.size(sizes)), F.lit(0), lambda a, x: a + x)
    fits = F.filter(F.sequence(F.lit(0), F.greatest(F.size(blocks) - 1, F.lit(0))), lambda k: (k < F.size(blocks)) & (total(k) <= most))
    return F.when(F.size(fits) > 0, F.slice(blocks, F.element_at(fits, 1) + 1, F.size(blocks))).otherwise(F.array().cast("array<array<string>>"))


def within_region(pre: Column, post: Column, most: int = MAX_REGION_LINES) -> Column:
    return (F.size(pre) <= most) & (F.size(post) <= most)


def next_edit_examples(hunks: DataFrame, siblings: DataFrame, max_chars: int = MAX_PROMPT_CHARS) -> DataFrame:
    """Hunks (repo, sha, cluster_id, path, start, pre, post, raw) to text, prompt, completion and their keys."""
    rows = edit_history(hunks).where(within_region(F.col("pre"), F.col("post")))
    rows = rows.join(siblings, ["sha", "cluster_id"], "left").withColumn("siblings", F.coalesce("siblings", F.array().cast("array<string>")))
    kept = fit_history(F.col("prior"), F.col("path"), F.col("pre"), F.col("siblings"), max_chars)
    rows = rows.withColumn("prompt", prompt(F.flatten(kept), F.col("path"), F.col("pre"), F.col("siblings"))).where(F.length("prompt") <= max_chars)
    rows = rows.withColumn("completion", target(F.col("post")))
    return rows.select(F.concat("prompt", F.lit("\n"), "completion").alias("text"), "prompt", "completion", "repo", "sha", "cluster_id", "path")


def leak_guard(rows: DataFrame, coherent: DataFrame, held_out: DataFrame, touches: DataFrame) -> DataFrame:
    """``rows`` (repo, sha, cluster_id, file) with split: eval for held-out clusters; train rows whose file an eval commit touches are dropped."""
    n = pieces(rows, touches)
    groups = held_out.where("held_out").select("cluster_id").distinct()
    shas = coherent.join(groups, "cluster_id", "left_semi").select("repo", "sha")
    # Dealt before they are made distinct: no task holds the files of all that it read.
    files = touches.join(shas, ["repo", "sha"], "left_semi").select("repo", "file").repartition(n, "file").distinct()
    out = rows.join(groups.withColumn("_e", F.lit(True)), "cluster_id", "left").withColumn("split", F.when(F.col("_e"), "eval").otherwise("train")).drop("_e")
    marked = dealt_join(out, files.withColumn("_leak", F.lit(True)), ["repo", "file"], n, "left")
    return marked.where("split = 'eval' or _leak is null").select(*out.columns)
