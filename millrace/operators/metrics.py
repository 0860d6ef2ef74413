"""Scoring of predictions: edits (exact match, line F1) and tool calls (match, argument overlap), and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import TERMINATOR, is_blank, let, lines_of, normalise_prediction

# Fixed values.
ARG_CHARS = 200
JUDGE_CHARS = 1500
REASON_CHARS = 80


def numbered(values: Column) -> Column:
    """The values as texts that differ: each with the number of its occurrence, so that the common ones of two such arrays are their multisets' intersection."""

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))

        def spread(at: Column) -> Column:
            one = lambda p, k: F.transform(F.sequence(p, F.coalesce(F.get(at, k + 1), F.size(s)) - 1), lambda i: F.concat((i - p).cast("string"), F.lit(":"), F.get(s, i)))
            return F.flatten(F.transform(at, one))

        return let(starts, spread)

    return F.when(F.size(values) > 0, let(F.array_sort(values), runs)).otherwise(F.array().cast("array<string>"))


def overlap_of(left: Column, right: Column) -> Column:
    """A struct of overlap (of the two arrays' multisets), n_left and n_right, all within the row."""

    def tally(x: Column) -> Column:
        common = F.size(F.array_intersect(numbered(x["l"]), numbered(x["r"])))
        return F.struct(common.alias("overlap"), F.size(x["l"]).alias("n_left"), F.size(x["r"]).alias("n_right"))

    none = F.array().cast("array<string>")
    return let(F.struct(F.coalesce(left, none).alias("l"), F.coalesce(right, none).alias("r")), tally)


def content_lines(text: Column) -> Column:
    """The non-blank lines of a normalised prediction."""
    return F.filter(lines_of(normalise_prediction(text)), lambda x: ~is_blank(x))


def line_f1(rows: DataFrame, key: str, pred: str, gold: str) -> DataFrame:
    """key and line_f1 of each row: F1 over multisets of lines; 1 if both have none, 0 if one has none."""

    def f1(x: Column) -> Column:
        return F.when((x["n_left"] == 0) & (x["n_right"] == 0), 1.0).when(x["overlap"] == 0, 0.0).otherwise(2.0 * x["overlap"] / (x["n_left"] + x["n_right"]))

    return rows.select(key, let(overlap_of(content_lines(F.col(pred)), content_lines(F.col(gold))), f1).alias("line_f1"))


def current_region(prompt: Column) -> Column:
    """The region between the CURRENT mark and the closing line, normalised; null if there is none."""
    mark = "<<<<<<< CURRENT\n"
    whole = F.regexp_extract(prompt, r"(?s)<<<<<<< CURRENT\n(.*?)\n?=======\s*$", 0)
    return let(whole, lambda x: F.when(x != "", normalise_prediction(F.regexp_replace(F.substr(x, F.lit(len(mark) + 1)), r"\n?=======\s*$", ""))))


def first_line(text: Column) -> Column:
    return F.substring_index(F.coalesce(text, F.lit("")), "\n", 1)


def edit_results(rows: DataFrame, pred: str = "prediction", gold: str = "completion", prompt: str = "prompt") -> DataFrame:
    """``rows`` with exact_match, format_valid, first_line_hit and no_op. Each text is normalised once."""
    texts = F.struct(normalise_prediction(F.col(pred)).alias("p"), normalise_prediction(F.col(gold)).alias("g"), current_region(F.col(prompt)).alias("r"))

    def judge(x: Column) -> Column:
        first = (first_line(x["p"]) == first_line(x["g"])) & (first_line(x["g"]) != "")
        return F.struct((x["p"] == x["g"]).alias("exact_match"), first.alias("first_line_hit"), F.coalesce(x["p"] == x["r"], F.lit(False)).alias("no_op"))

    judged = rows.withColumn("_j", let(texts, judge)).withColumn("format_valid", F.contains(F.col(pred), F.lit(TERMINATOR)))
    return judged.select(*rows.columns, "_j.exact_match", "format_valid", "_j.first_line_hit", "_j.no_op")


def mean_of(flag: str, alias: str) -> Column:
    return F.round(F.avg(F.col(flag).cast("double")), 4).alias(alias)


def weakest_groups(rows: DataFrame, group: str, flag: str, least: int = 5, most: int = 5) -> DataFrame:
    """The groups with the lowest mean of ``flag``, of those with at least ``least`` rows."""
    out = rows.groupBy(group).agg(F.round(F.avg(F.col(flag).cast("double")), 4).alias("score"), F.count("*").alias("n")).where(F.col("n") >= least)
    return out.orderBy("score", group, "n").limit(most)


def args_overlap(rows: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """key and args_overlap of each row: Dice over the multisets of argument values (as text, cut at ARG_CHARS); names don't count.

    ``left`` and ``right`` are JSON objects; one that is null or empty gives 0.
    """
    values = lambda c: F.transform(F.map_values(F.from_json(c, "map<string,string>")), lambda v: F.left(F.coalesce(v, F.lit("None")), F.lit(ARG_CHARS)))
    dice = lambda x: F.when((x["n_left"] == 0) | (x["n_right"] == 0), 0.0).otherwise(2.0 * x["overlap"] / (x["n_left"] + x["n_right"]))
    return rows.select(key, let(overlap_of(values(F.col(left)), values(F.col(right))), dice).alias("args_overlap"))


def confusion(rows: DataFrame, gold: str, pred: str, most: int = 6) -> DataFrame:
    """The most frequent wrong pairs ``gold -> pred``."""
    wrong = rows.where(~F.col(gold).eqNullSafe(F.col(pred)))
    pair = F.concat(F.col(gold), F.lit(" -> "), F.coalesce(F.col(pred), F.lit("None")))
    return wrong.groupBy(pair.alias("pair")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "pair").limit(most)


def majority(rows: DataFrame, column: str) -> DataFrame:
    """The most frequent value and its share."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    out = counts.agg(F.max("n").alias("_m"), F.sum("n").alias("_t"), F.count("*").alias("n_values"))
    first = counts.join(F.broadcast(out), F.col("n") == F.col("_m"))  # one row on the right
    return first.groupBy("_m", "_t", "n_values").agg(F.min(column).alias("majority")).select("majority", F.round(F.col("_m").cast("double") / F.col("_t"), 4).alias("share"), "n_values")


# Fixed value.
JUDGE_SYSTEM = (
    "You grade code-edit predictions. Given the code region being edited, the reference "
    "edit a developer actually made, and a model's predicted edit, decide whether the "
    "prediction is an acceptable substitute for the reference.\n\n"
    "Judge INTENT, not characters. Say correct when the prediction makes the same "
    "functional change, even if identifiers, formatting, comments or ordering differ. "
    "Say incorrect when it makes a different change, changes nothing, is incomplete, or "
    "would not compile/run in context.\n\n"
    'Reply with JSON only: {"correct": true|false, "reason": "<12 words max>"}'
)


def judge_messages(prompt: Column, gold: Column, pred: Column, labels: tuple[str, str, str], system: str = JUDGE_SYSTEM) -> Column:
    """The messages for a judge: a system message, which can be another, and the user message of :func:`judge_prompt`."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(message("system", F.lit(system)), message("user", judge_prompt(prompt, gold, pred, labels)))


def judge_prompt(prompt: Column, gold: Column, pred: Column, labels: tuple[str, str, str], chars: int = JUDGE_CHARS) -> Column:
    """The user message for a judge: the prompt's end, the reference's and the prediction's beginning."""
    part = lambda name, text: F.concat(F.lit(f"### {name}\n"), text)
    return F.concat(part(labels[0], F.right(prompt, F.lit(chars))), F.lit("\n\n"), part(labels[1], F.left(gold, F.lit(chars))), F.lit("\n\n"), part(labels[2], F.left(pred, F.lit(chars))))


def parse_verdict(reply: Column) -> Column:
    """A struct of correct and reason from a judge's reply; null unless it holds a JSON object."""
    body = F.try_parse_json(F.regexp_extract(reply, r"(?s)(\{.*\})", 1))
    is_object = F.startswith(F.schema_of_variant(body), F.lit("OBJECT"))
    reason = F.left(F.coalesce(F.try_variant_get(body, "$.reason", "string"), F.lit("")), F.lit(REASON_CHARS))
    return F.when(is_object, F.struct(F.coalesce(F.try_variant_get(body, "$.correct", "boolean"), F.lit(False)).alias("correct"), reason.alias("reason")))


def judge_rate(rows: DataFrame, verdict: str) -> DataFrame:
    """The share of correct among verdicts that exist, and how many are missing."""
    return rows.agg(F.avg(F.col(verdict).cast("double")).alias("rate"), F.count(verdict).alias("n"), F.count(F.when(F.col(verdict).isNull(), 1)).alias("n_failed"))


def zip_rows(left: DataFrame, right: DataFrame, row_id: str) -> DataFrame:
    """Results and verdicts joined by an explicit row id, never by position."""
    return left.join(right, row_id, "left")

