"""Version-control history: log text to commits, keep rules, conventional subjects, the ordered filter cascade, first-wins deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.graph import dealt_join
from millrace.staging import pieces, stage

# Fixed values.
CONVENTIONAL = r"^([a-z]+)(?:\(([^)]*)\))?!?:"
SKIP_TYPES = ["chore", "ci", "build", "style", "docs", "release", "revert", "test"]
SKIP_MESSAGE = r"(?i)\[skip ci\]|^Merge |^Revert |bump version"
MAX_FILES = 25
SECRET_PATH = r"(?i)(^|/)\.env($|\.)|\.pem$|\.key$|\.p12$|id_rsa|credentials?\.json$"
SKIP_PATH = (
    r"(?i)(^|/)(node_modules|dist|build|out|target|vendor|\.next|\.nuxt|__pycache__|\.venv|venv|coverage|\.git)/|"
    r"\.(lock|min\.js|min\.css|snap|map|png|jpe?g|gif|svg|ico|webp|pdf|zip|gz|tar|woff2?|ttf|eot|mp4|mp3|wav|bin|so|dylib|dll|exe|pyc|class|jar|wasm)$|"
    r"(^|/)(package-lock\.json|pnpm-lock\.yaml|yarn\.lock|poetry\.lock|Cargo\.lock|go\.sum|composer\.lock|Gemfile\.lock|uv\.lock)$"
)
CODE_PATH = (
    r"(?i)\.(py|js|jsx|ts|tsx|rs|go|java|kt|swift|c|h|cc|cpp|hpp|cs|rb|php|scala|sh|bash|"
    r"zsh|sql|gd|vue|svelte|lua|ex|exs|erl|hs|ml|r|jl|dart|toml|yaml|yml|json|md)$"
)
HEADER = "__C__"
SEPARATOR = "\x1f"


def keep_path(path: Column) -> Column:
    """Neither secret nor generated, and code by its ending."""
    return ~path.rlike(SECRET_PATH) & ~path.rlike(SKIP_PATH) & path.rlike(CODE_PATH)


def subject_type(subject: Column) -> Column:
    return F.nullif(F.regexp_extract(subject, CONVENTIONAL, 1), F.lit(""))


def subject_scope(subject: Column) -> Column:
    return F.nullif(F.regexp_extract(subject, CONVENTIONAL, 2), F.lit(""))


def parse_log(lines: DataFrame, tracked: DataFrame | None = None) -> DataFrame:
    """Log lines (repo, line_no, line) to one row per commit: repo, sha, ts, subject, files (kept ones, sorted).

    A line that starts with the header mark opens a commit; lines of three tab-separated fields after it are its files, binary ones left out.
    """
    n = 4 * pieces(lines)  # small parts, as a task may get a few of these ranges
    # A commit's number is that of the headers up to it: those of the ranges of the log before, and those in its own range. So no task sees a whole log.
    parts = stage(lines.select("repo", "line_no", "line", F.startswith("line", F.lit(HEADER)).alias("_head")).repartitionByRange(n, "repo", "line_no").withColumn("_p", F.spark_partition_id()), "log")
    counts = parts.groupBy("repo", "_p").agg(F.sum(F.col("_head").cast("long")).alias("_n"))
    before = counts.select("repo", "_p", (F.sum("_n").over(Window.partitionBy("repo").orderBy("_p")) - F.col("_n")).alias("_before"))
    inside = F.sum(F.col("_head").cast("long")).over(Window.partitionBy("repo", "_p").orderBy("line_no"))
    rows = parts.repartition(n, "repo", "_p").withColumn("_in", inside).join(before, ["repo", "_p"]).withColumn("_c", F.col("_before") + F.col("_in")).where("_c > 0")
    head = F.split(F.substr("line", F.lit(len(HEADER) + 1)), SEPARATOR)
    field = F.split("line", "\t")
    rows = rows.withColumn("path", F.when(~F.col("_head") & (F.size(field) == 3) & ~((field[0] == "-") & (field[1] == "-")), field[2]))
    rows = stage(rows.select("repo", "_c", "_head", F.when(F.col("_head"), head).alias("_h"), F.when(keep_path(F.col("path")), F.col("path")).alias("path")).where("_head or path is not null"), "numbered")
    files = rows.where("path is not null").select("repo", "_c", "path")
    if tracked is not None:
        files = dealt_join(files, tracked.select("repo", "path"), ["repo", "path"], n, "left_semi")
    heads = rows.where("_head").select("repo", "_c", F.lit(None).cast("string").alias("path"), "_h")
    rows = heads.unionByName(files.withColumn("_h", F.lit(None).cast("array<string>"))).repartition(n, "repo", "_c")
    out = rows.groupBy("repo", "_c").agg(F.first("_h", True).alias("_h"), F.array_sort(F.collect_list("path")).alias("files"))
    part = lambda k: F.coalesce(F.get("_h", F.lit(k)), F.lit(""))
    return out.select("repo", part(0).alias("sha"), part(1).try_cast("long").alias("ts"), part(2).alias("subject"), "files")


def drop_reason(commits: DataFrame) -> DataFrame:
    """``commits`` (subject, files) with type, scope and drop_reason; the first rule that applies names the reason."""
    kind = subject_type(F.col("subject"))
    reason = (
        F.when(F.size("files") == 0, "skip_nofiles")
        .when(kind.isin(SKIP_TYPES), "skip_type")
        .when(F.col("subject").rlike(SKIP_MESSAGE), "skip_msg")
        .when(F.size("files") > MAX_FILES, "skip_large")
    )
    return commits.withColumns({"type": kind, "scope": subject_scope(F.col("subject")), "drop_reason": reason})


def first_by_key(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key by ``order``."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
