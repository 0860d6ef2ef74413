"""Operator 3: canonical digest lookup of licence texts.

A text is made canonical (case, punctuation, copyright lines, equivalent spellings, line breaks), hashed whole, and hash-joined to the digests of
known texts, long ones (the GNU, Apache, Mozilla and Creative Commons texts) by their digests alone. The same is done for each of its lines, since corpora carry short notices on a line
of their own; these are told apart in the result. Built-in functions only; the known digests are a fixed, small table, so the join needs no shuffle.

Defined cases: null and empty texts match nothing; a text of copyright lines only matches nothing; repeated rows
are judged each; a very long text is one unit and its lines are units; an empty table gives no rows; further columns are ignored; of several licences all are listed, sorted and distinct.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.licence_texts import KNOWN, KNOWN_DIGESTS

# Spellings held to be equal, after punctuation became spaces.
SPELLINGS = [
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("behaviour", "behavior"),
    ("honour", "honor"),
    ("copyright owner", "copyright holder"),
    ("merchantibility", "merchantability"),
    ("https", "http"),
]
COPYRIGHT_LINE = r"^[^\p{L}\p{N}(©]*(copyright\b|\(c\)|©|all rights reserved).*$"


def canonical_line(line: Column) -> Column:
    """Words of one lower-cased line, single-spaced; empty for a copyright line."""
    out = F.trim(F.regexp_replace(line, r"[^\p{L}\p{N}]+", " "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.when(line.rlike(COPYRIGHT_LINE), F.lit("")).otherwise(out)


def canonical_lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.lower(text), r"\r?\n"), canonical_line), lambda x: x != "")


def digests(text: Column) -> Column:
    """Structs of whole (is it the whole text?) and digest, for the text and each of its lines."""
    lines = canonical_lines(text)
    unit = lambda x, whole: F.struct(F.lit(whole).alias("whole"), F.sha2(x, 256).alias("digest"))
    whole = F.when(F.size(lines) > 0, F.array(unit(F.array_join(lines, " "), True))).otherwise(F.array().cast("array<struct<whole:boolean,digest:string>>"))
    return F.concat(whole, F.transform(lines, lambda x: unit(x, False)))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN, long: list[tuple[str, str]] = KNOWN_DIGESTS) -> DataFrame:
    """digest, and the place of its licence among the sorted names."""
    names = _names(known, long)
    texts = spark.createDataFrame([(names.index(name), text) for name, text in known], "place int, text string")
    short = texts.select("place", F.sha2(F.array_join(canonical_lines(F.col("text")), " "), 256).alias("digest"))
    return short.unionByName(spark.createDataFrame([(names.index(name), d) for name, d in long], "place int, digest string")).groupBy("digest").agg(F.min("place").alias("place"))


def _names(known: list[tuple[str, str]], long: list[tuple[str, str]]) -> list[str]:
    return sorted({name for name, _ in [*known, *long]})


def scan_licences(docs: DataFrame, known: list[tuple[str, str]] = KNOWN, long: list[tuple[str, str]] = KNOWN_DIGESTS) -> DataFrame:
    """For every document: doc_id, licences (of the whole text or of lines), text_licence (of the whole text), notices (of lines), n_matches (lines or whole texts that matched) and whole_text.

    Names are comma-joined, null if there are none. A one-line document that matches counts once. Matches are gathered as bits, 62 licences to a
    number, so that the aggregation stays a plain hash aggregation of one row per document.
    """
    names = _names(known, long)
    table = F.broadcast(known_digests(docs.sparkSession, known, long))  # as many rows as known texts: fixed
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("_row"), digests(F.col("text")).alias("_d"))
    hits = rows.select("doc_id", "_row", F.explode_outer("_d").alias("_u")).select("doc_id", "_row", F.col("_u.whole").alias("whole"), F.col("_u.digest").alias("digest"))
    words = range(-(-len(names) // 62))
    bit = lambda w, on: F.when(on & (F.floor(F.col("place") / 62) == w), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place") % 62)).otherwise(F.lit(0).cast("long"))
    out = hits.join(table, "digest", "left").groupBy("_row", "doc_id").agg(
        *[F.bit_or(bit(w, ~F.col("whole"))).alias(f"_l{w}") for w in words],
        *[F.bit_or(bit(w, F.col("whole"))).alias(f"_t{w}") for w in words],
        F.count(F.when(~F.col("whole"), F.col("place"))).alias("_lines"),
        F.count(F.when(F.col("whole"), F.col("place"))).alias("_whole"),
    )

    def listed(bits: Callable[[int], Column]) -> Column:
        found = F.array(*[F.when(F.getbit(bits(k // 62), F.lit(k % 62)) == 1, F.lit(name)) for k, name in enumerate(names)])
        return F.nullif(F.array_join(found, ","), F.lit(""))

    return out.select(
        "doc_id",
        listed(lambda w: F.col(f"_l{w}").bitwiseOR(F.col(f"_t{w}"))).alias("licences"),
        listed(lambda w: F.col(f"_t{w}")).alias("text_licence"),
        listed(lambda w: F.col(f"_l{w}")).alias("notices"),
        F.greatest("_lines", "_whole").alias("n_matches"),
        (F.col("_whole") > 0).alias("whole_text"),
    )


def op3_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op3_sql(known: list[tuple[str, str]] = KNOWN, long: list[tuple[str, str]] = KNOWN_DIGESTS) -> str:
    """DuckDB SQL for :func:`op3_query`."""
    canon = "trim(regexp_replace(line, '[^\\p{L}\\p{N}]+', ' ', 'g'))"
    for old, new in SPELLINGS:
        canon = f"replace({canon}, '{old}', '{new}')"
    line = f"CASE WHEN regexp_matches(line, {_sql_text(COPYRIGHT_LINE)}) THEN '' ELSE {canon} END"
    lines = f"list_filter(list_transform(string_split_regex(lower(text), '\\r?\\n'), lambda line: {line}), lambda x: x <> '')"
    values = ", ".join(f"({_sql_text(n)}, {_sql_text(t)})" for n, t in known)
    whole = ", ".join(f"({_sql_text(n)}, {_sql_text(d)})" for n, d in long)
    return f"""
WITH known AS (
  SELECT min(licence) AS licence, d FROM (SELECT licence, sha256(array_to_string({lines}, ' ')) AS d FROM (VALUES {values}) v(licence, text) UNION ALL SELECT licence, d FROM (VALUES {whole}) w(licence, d)) GROUP BY d
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {lines} AS ls FROM documents
), units AS (
  SELECT r, true AS whole, sha256(array_to_string(ls, ' ')) AS d FROM docs WHERE len(ls) > 0
  UNION ALL SELECT r, false, sha256(l) FROM (SELECT r, unnest(ls) AS l FROM docs)
), hits AS (
  SELECT r, licence, whole FROM units JOIN known USING (d)
), found AS (
  SELECT r, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences,
         string_agg(DISTINCT licence, ',' ORDER BY licence) FILTER (WHERE whole) AS text_licence, string_agg(DISTINCT licence, ',' ORDER BY licence) FILTER (WHERE NOT whole) AS notices,
         greatest(count(*) FILTER (WHERE NOT whole), count(*) FILTER (WHERE whole)) AS n, bool_or(whole) AS whole FROM hits GROUP BY r
)
SELECT doc_id, licences, text_licence, notices, CAST(coalesce(n, 0) AS BIGINT) AS n_matches, coalesce(whole, false) AS whole_text FROM docs LEFT JOIN found USING (r)
"""
