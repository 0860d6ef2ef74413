"""Fill-in-the-middle examples from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.text import strip

# Fixed values.
INCLUDE_EXTENSIONS = [
    ".ts", ".tsx", ".js", ".jsx", ".svelte", ".vue", ".py", ".rs", ".go", ".gd", ".zig", ".css", ".scss", ".html",
    ".json", ".yaml", ".yml", ".toml", ".sql", ".md",
]
EXCLUDE_PARTS = [
    "node_modules", ".git", "dist", "build", "__pycache__", ".next", ".nuxt", "target", ".cache", ".venv", "venv",
    "*.lock", "vendor", ".turbo", ".codegraph", "coverage", ".svelte-kit", ".output",
]
EXCLUDE_NAMES = [".min.js", ".min.css", ".map", ".lock", "package-lock", "bun.lock", "go.sum"]
MIN_LINES, MAX_LINES, MAX_LINE_CHARS = 5, 500, 200
MAX_PER_FILE = 5
MIN_MIDDLE = 3
FIRST_SPLIT = 5


def include_file(path: Column) -> Column:
    """By extension, and no excluded word anywhere in a part of the path (so ``build`` also excludes ``rebuilder.py``)."""
    parts = F.split(path, "/")
    name = F.element_at(parts, -1)
    ext = F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))
    bad_part = F.exists(parts, lambda p: _any(p, EXCLUDE_PARTS))
    return ext.isin(INCLUDE_EXTENSIONS) & ~bad_part & ~_any(name, EXCLUDE_NAMES)


def _any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def usable_lines(lines: Column) -> Column:
    size = F.size(lines)
    return (size >= MIN_LINES) & (size <= MAX_LINES) & (size > 6) & F.forall(lines, lambda x: F.length(x) <= MAX_LINE_CHARS)


def split_at(lines: Column, k: Column) -> Column:
    """Prefix, middle and suffix around line k (from 0)."""
    join = lambda x: F.array_join(x, "\n")
    return F.struct(
        join(F.slice(lines, F.lit(1), k)).alias("prefix"),
        F.get(lines, k).alias("middle"),
        join(F.slice(lines, k + 2, F.size(lines))).alias("suffix"),
    )


def fim_candidates(files: DataFrame, key: str, text: str = "text", most: int = MAX_PER_FILE, seed: int = 42) -> DataFrame:
    """Up to ``most`` split lines per file, chosen by the MD5 of seed, key and line; blank and very short middles go."""
    rows = files.withColumn("_lines", F.split(text, "\n")).where(usable_lines(F.col("_lines")))
    order = lambda i: F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"), F.lit(":"), i.cast("string")))
    ranked = F.array_sort(F.transform(F.sequence(F.lit(FIRST_SPLIT), F.size("_lines") - 2), lambda i: F.struct(order(i).alias("h"), i.alias("i"))))
    picks = F.slice(ranked, F.lit(1), F.least(F.lit(most), F.size("_lines") - 6))
    rows = rows.withColumn("line", F.explode(F.transform(picks, lambda x: x["i"])))
    rows = rows.withColumn("_f", split_at(F.col("_lines"), F.col("line"))).where(F.length(strip("_f.middle")) >= MIN_MIDDLE)
    return rows.select(*[c for c in files.columns if c != text], F.col("line").cast("long").alias("line"), "_f.prefix", "_f.middle", "_f.suffix")


def fim_midpoint(rows: DataFrame, text: str = "text") -> DataFrame:
    """The middle line of texts of over 50 characters and 3 lines."""
    lines = rows.withColumn("_lines", F.split(text, "\n")).where((F.length(text) > 50) & (F.size("_lines") > 3))
    lines = lines.withColumn("_f", split_at(F.col("_lines"), F.floor(F.size("_lines") / 2).cast("int"))).where(strip("_f.middle") != "")
    return lines.select(*[c for c in rows.columns if c != text], "_f.prefix", "_f.middle", "_f.suffix")


def render_qwen(prefix: Column, middle: Column, suffix: Column) -> Column:
    return F.concat(F.lit("<|fim_prefix|>"), prefix, F.lit("<|fim_suffix|>"), suffix, F.lit("<|fim_middle|>"), middle, F.lit("<|fim_hole|><|endoftext|>"))


def render_starcoder(prefix: Column, middle: Column, suffix: Column) -> Column:
    return F.concat(F.lit("<fim_prefix>"), prefix, F.lit("<fim_suffix>"), suffix, F.lit("<fim_middle>"), middle)


def rank_by_hash(df: DataFrame, partition: str, *keys: str) -> Column:
    return F.row_number().over(Window.partitionBy(partition).orderBy(F.md5(F.concat_ws(":", *keys))))
