"""Line-oriented sources: JSON lines, files on disk, log text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.graph import dealt_join
from millrace.staging import pieces, stage


def read_lines(spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = False) -> DataFrame:
    """file, line_no (from 0, blank lines count) and line. Bad bytes become U+FFFD.

    Files are split into blocks as Spark likes, so a file of any size is read in parallel. A line's number is its place in its block and the number of lines in the blocks
    before; lines are written once with their place, so numbers don't change when a task runs again.
    """
    reader = spark.read.option("recursiveFileLookup", recursive).option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    lines = stage(lines, "lines")
    counts = lines.groupBy("file", "block").agg(F.count("*").alias("_n"), F.min("at").alias("_first"))
    before = counts.select("file", "block", "_first", (F.sum("_n").over(Window.partitionBy("file").orderBy("block")) - F.col("_n")).alias("_before"))
    return lines.join(before, ["file", "block"]).select("file", (F.col("at") - F.col("_first") + F.col("_before")).alias("line_no"), "line")


def read_json_lines(spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = False) -> DataFrame:
    """file, line_no, line and data (variant) of :func:`read_lines`: blank lines and lines that aren't JSON are left out."""
    return json_of(read_lines(spark, path, glob, recursive))


def json_of(lines: DataFrame) -> DataFrame:
    """Lines with data (variant): blank lines and lines that aren't JSON are left out."""
    return lines.where(F.trim("line") != "").withColumn("data", F.try_parse_json("line")).where("data is not null")


#: Ends a member's name in a line of a bundle. Names hold neither it nor line ends.
MEMBER = "\x1f"


def write_bundles(rows: DataFrame, path: str, name: str, order: str, line: str = "line") -> None:
    """Many small files as few large ones: each line with its file's name before it. A file's lines lie together in one bundle, in order."""
    dealt = rows.repartition(pieces(rows), name).sortWithinPartitions(name, order)
    dealt.select(F.concat(F.col(name).cast("string"), F.lit(MEMBER), F.coalesce(line, F.lit(""))).alias("value")).write.text(path)


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """file (the name of a bundle's member), line_no (from 0 in the member, blank lines count) and line."""
    rows = read_lines(spark, path)
    name = F.substring_index("line", MEMBER, 1)
    rows = stage(rows.select(name.alias("member"), "line_no", F.substr("line", F.length(name) + len(MEMBER) + 1).alias("line")), "members")
    # A member lies in one bundle, so its lines' numbers follow one another from its first.
    first = rows.groupBy("member").agg(F.min("line_no").alias("_first"))
    return dealt_join(rows, first, ["member"], pieces(rows)).select(F.col("member").alias("file"), (F.col("line_no") - F.col("_first")).alias("line_no"), "line")


def write_json_lines(df: DataFrame, path: str) -> None:
    """One object per row, null fields too."""
    df.write.option("ignoreNullFields", False).json(path)


def write_split(df: DataFrame, path: str, column: str = "split") -> None:
    """One folder per value of the split column."""
    df.write.partitionBy(column).option("ignoreNullFields", False).json(path)


def sound_files(lines: DataFrame, bad: Column) -> DataFrame:
    """Only lines of files none of whose lines is ``bad``: a fault drops its file, not the job."""
    marked = lines.withColumn("_bad", F.coalesce(bad, F.lit(False)))
    broken = marked.where("_bad").select("file").distinct()
    return marked.join(broken, "file", "left_anti").drop("_bad").select(*lines.columns)


#: Stands for a genuine U+FFFD while bad bytes become one: a noncharacter, which no text has, so it can't be confused.
_GENUINE = "\ufdd0"


def read_text_files(spark: SparkSession, path: str | list[str], glob: str | None = None, drop_bad_bytes: bool = False) -> DataFrame:
    """path and text of whole files. Bad UTF-8 bytes become U+FFFD, or go with ``drop_bad_bytes``; a U+FFFD that the file holds stays."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    text = F.col("content").cast("string")
    if drop_bad_bytes:
        marked = F.make_valid_utf8(F.replace(text, F.lit("\ufffd"), F.lit(_GENUINE)))
        text = F.replace(F.replace(marked, F.lit("\ufffd"), F.lit("")), F.lit(_GENUINE), F.lit("\ufffd"))
    else:
        text = F.make_valid_utf8(text)
    return reader.load(path).select(F.col("path"), text.alias("text"))


def file_stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]+$", "")


def mix(spark: SparkSession, paths: str) -> DataFrame:
    """A training mix: comma-separated JSON-lines paths, all to one text column; rows with messages are rendered."""
    from millrace.operators.conversations import render_chat

    out: DataFrame | None = None
    for p in (x.strip() for x in paths.split(",") if x.strip()):
        rows = spark.read.schema("text string, messages array<struct<role:string,content:string>>").json(p)
        part = rows.select(F.coalesce(F.when(F.col("messages").isNotNull(), render_chat(F.col("messages"))), F.col("text")).alias("text"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no path was given")
    return out
