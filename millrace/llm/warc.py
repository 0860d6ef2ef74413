"""Operator 1: WARC writing, and reading with boundary-chain verification.

Writing is a plain text sink whose line separator is the end of a record, so archives are
committed like any other Spark output. Reading splits the archives at every occurrence of the record magic
(a splittable text scan) and treats each as a candidate record. A candidate's header names its successor's
offset. From the file's start the chain of successors is followed by pointer jumping; candidates off the chain are
magic strings inside payloads and become part of the record that holds them.

Everything is built-in DataFrame functions; payloads never pass through Python.

Defined cases: a null html is an empty payload; a null url leaves out WARC-Target-URI; rows with a null page_id are
written and read back with a null page_id; repeated page_ids are separate records (of equal payloads one, the last by url, is the response, and of wholly equal rows
one); an empty table gives no archives and no rows; further columns are ignored; a very long payload is one record. Payloads shorter than ``min_revisit_bytes`` are never revisits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm._common import scratch, skew_join, stage

MAGIC = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_ID = "urn:page:"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column (160 bits are 32 letters, without padding)."""
    digest = F.sha1(payload)
    letters = []
    for k in range(8):  # five hex digits are four letters
        bits = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(_B32), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def plan_revisits(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """``pages`` with payload, payload_bytes, payload_digest, record_type and refers_to.

    Of equal payloads the row with the largest page_id (nulls lowest) is the response. Only digests that
    occur more than once are joined back; where their table is small Spark broadcasts it, else hot digests are handled apart.
    """
    rows = (
        pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
        .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
        .withColumn("payload_digest", base32_sha1(F.col("payload")))
        .withColumn("_rank", F.struct(F.coalesce("page_id", F.lit(-(2**63))), F.coalesce("url", F.lit(""))))
    )
    groups = (
        rows.where(F.col("payload_bytes") >= min_revisit_bytes)
        .groupBy("payload_digest")
        .agg(F.max("_rank").alias("_first"), F.max("page_id").alias("_refers"), F.count("*").alias("_n"))
        .where("_n > 1")
    )
    groups = stage(groups, "warc-groups")
    # Equal rows that would all be the response: only one of them may be.
    same = rows.join(groups.select("payload_digest", F.col("_first").alias("_rank")), ["payload_digest", "_rank"], "left_semi") if not groups.isEmpty() else rows.limit(0)
    same = stage(same.groupBy("payload_digest", "_rank").agg(F.count("*").alias("_same")).where("_same > 1"), "warc-same")
    total = groups.agg(F.sum("_n")).first()[0] or 0
    marked = skew_join(rows, groups, ["payload_digest"], "_n", total) if total else rows.withColumns({"_first": F.lit(None).cast(rows.schema["_rank"].dataType), "_refers": F.lit(None).cast("long")})
    revisit = F.coalesce((F.col("payload_bytes") >= min_revisit_bytes) & (F.col("_rank") != F.col("_first")), F.lit(False))
    marked = marked.withColumn("_revisit", revisit)
    if not same.isEmpty():
        keys = ["payload_digest", "_rank"]
        once = marked.join(same, keys).dropDuplicates(keys).withColumn("_revisit", F.explode(F.transform(F.sequence(F.lit(1).cast("long"), F.col("_same")), lambda k: k > 1)))
        marked = marked.join(same.select(*keys), keys, "left_anti").select(*marked.columns).unionByName(once.select(*marked.columns))
    revisit = F.col("_revisit")
    return marked.select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_refers")).alias("refers_to"),
    )


def write_archives(planned: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one record per row of :func:`plan_revisits` to WARC/1.1 files under ``path``."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(RECORD_END))
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload").cast("string")))
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    head = F.concat(
        F.lit("WARC-Type: "), F.col("record_type"),
        F.lit(f"\r\nWARC-Record-ID: <{_ID}"), number("page_id"),
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), F.regexp_replace("url", r"\s+", "%20")), F.lit("")),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), F.lit(f"\r\nWARC-Refers-To: <{_ID}"), number("refers_to"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length("_body").cast("string"), F.lit(RECORD_END),
    )
    planned.withColumn("_body", body).select(F.concat(F.lit(MAGIC), head, F.col("_body")).alias("value")).write.option("lineSep", RECORD_END).text(path)


def _field(name: str) -> Column:
    return F.nullif(F.regexp_extract("_head", rf"(?:^|\r\n){name}: ?([^\r\n]*)", 1), F.lit(""))


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at each magic: file, block, an ascending seq within the block, and the bytes after the magic."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").cast("binary").alias("data"),
    )


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Each magic's offset, and where its header parses, the successor's offset and header fields."""
    mark = len(MAGIC)
    seg = segments(spark, path)
    head = F.substring_index(F.col("data").cast("string"), RECORD_END, 1)
    # A block is an HTTP head and the payload; lengths are in bytes.
    cut = (
        seg.withColumn("_head", head)
        .withColumn("size", F.octet_length("data").cast("long"))
        .withColumn("head_bytes", F.octet_length("_head").cast("long") + 4)
        .withColumn("length", _field("Content-Length").try_cast("long"))
        .withColumn("type", _field("WARC-Type"))
        .withColumn("record_id", F.regexp_extract("_head", rf"WARC-Record-ID: <{_ID}([^>]*)>", 1))
        .withColumn("refers_id", F.nullif(F.regexp_extract("_head", rf"WARC-Refers-To: <{_ID}([^>]*)>", 1), F.lit("")))
        .withColumn("digest", F.nullif(F.regexp_extract("_head", r"WARC-Payload-Digest: sha1:([A-Z2-7]+)", 1), F.lit("")))
        .withColumn("_block", F.when(F.col("head_bytes") + F.col("length") <= F.col("size"), F.expr("substring(data, int(head_bytes + 1), int(length))")))
    )
    cut = cut.select("file", "block", "seq", "size", "head_bytes", "length", "type", "record_id", "refers_id", "digest", *payload_columns(F.col("_block")))
    cut = stage(cut, "warc-segments")
    blocks = cut.groupBy("file", "block").agg(F.sum(F.col("size") + mark).alias("bytes"))
    base = blocks.select("file", "block", (F.sum("bytes").over(Window.partitionBy("file").orderBy("block")) - F.col("bytes")).alias("base"))
    inner = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cut.withColumn("_end", F.sum(F.col("size") + mark).over(inner)).withColumn("k", F.row_number().over(Window.partitionBy("file", "block").orderBy("seq"))).join(base, ["file", "block"])
    # Segments are what stands between magics: the first of a file has no magic before it.
    placed = placed.withColumn("off", F.col("base") + F.col("_end") - F.col("size") - 2 * mark).drop("base", "_end")
    return placed.withColumn(
        "next",
        F.when((F.col("off") >= 0) & (F.col("length") >= 0) & F.col("type").isNotNull(), F.col("off") + mark + F.col("head_bytes") + F.col("length") + len(RECORD_END)),
    )


def payload_columns(block: Column) -> list[Column]:
    """From a record's block: the HTTP head's Content-Length, the bytes after that head and their digest."""
    head = F.substring_index(block.cast("string"), RECORD_END, 1)
    start = F.octet_length(head) + 5
    payload = block.substr(start, F.greatest(F.octet_length(block) - start + 1, F.lit(0)))
    return [
        F.regexp_extract(head, r"(?:^|\r\n)Content-Length: ?([0-9]+)", 1).try_cast("long").alias("stated_bytes"),
        F.octet_length(payload).cast("long").alias("held_bytes"),
        base32_sha1(payload).alias("held_digest"),
    ]


def retain_reachable(cand: DataFrame) -> DataFrame:
    """The candidates that lie on the chain from their file's start.

    A run is a stretch of candidates each of which names the next one in the file. A chain that enters a run leaves it at the
    run's end, so pointer jumping needs only the runs' exits: where no payload holds the magic, each file is one run.
    Each round doubles the length of the jumps.
    """
    order = Window.partitionBy("file").orderBy("off")
    real = cand.where("off >= 0")
    follows = F.coalesce(F.lag("next").over(order) == F.col("off"), F.lit(False))
    runs = real.withColumn("_new", (~follows).cast("long"))
    runs = runs.withColumn("run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = stage(runs.drop("_new"), "warc-runs")
    exits = runs.groupBy("file", "run").agg(F.max_by("next", "off").alias("exit"))
    members = runs.select("file", "run", "off")
    # Entry offsets: the file's start and every run's exit. jump: the exit of the run that an entry falls in.
    starts = runs.groupBy("file").agg(F.lit(0).cast("long").alias("off"))
    entries = starts.unionByName(exits.where("exit is not null").select("file", F.col("exit").alias("off"))).distinct()
    entries = stage(entries.join(members, ["file", "off"]).join(exits, ["file", "run"]).select("file", "off", "run", F.col("exit").alias("jump")), "warc-entries")
    jumps = entries.select("file", "off", "jump").where("jump is not null")
    reached = stage(entries.where("off = 0").select("file", "off"), "warc-reached")
    count = reached.count()
    while True:
        grown = reached.join(jumps, ["file", "off"]).select("file", F.col("jump").alias("off"))
        grown = grown.join(entries.select("file", "off"), ["file", "off"], "left_semi")
        reached = stage(reached.unionByName(grown).distinct(), "warc-reached")
        if (now := reached.count()) == count:
            break
        count = now
        ahead = jumps.select("file", F.col("off").alias("jump"), F.col("jump").alias("_far"))
        jumps = stage(jumps.join(ahead, ["file", "jump"]).select("file", "off", F.col("_far").alias("jump")), "warc-jumps")
    first = reached.join(entries.select("file", "off", "run"), ["file", "off"]).groupBy("file", "run").agg(F.min("off").alias("_from"))
    return runs.join(first, ["file", "run"]).where("off >= _from").drop("_from", "run")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every verified record of the archives under ``path``.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to, file, offset, and digest_ok (the payload held matches the header's digest; null for revisits).
    A record whose payload holds the magic is pieced together from its segments. The blocks that hold them are read a second time; a segment is
    found again by its number within its block.
    """
    cand = stage(candidates(spark, path), "warc-candidates")
    kept = stage(retain_reachable(cand), "warc-records")
    known = ["stated_bytes", "held_bytes", "held_digest"]
    plain = kept.where("held_digest is not null")
    split = kept.where("held_digest is null")
    if not split.isEmpty():
        order = Window.partitionBy("file").orderBy("off").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        owners = kept.select("file", "off", F.when(F.col("held_digest").isNull(), F.col("off")).alias("_own"), F.lit(True).alias("_rec"))
        parts = cand.where("off >= 0").select("file", "off", "block", "k", "size").join(owners, ["file", "off"], "left")
        parts = parts.withColumn("owner", F.last(F.when(F.col("_rec"), F.struct("_own")), True).over(order)["_own"]).where("owner is not null")
        parts = stage(parts.select("file", "block", "k", "off", "size", "owner"), "warc-parts")
        again = segments(spark, path).join(parts.select("file", "block").distinct(), ["file", "block"], "left_semi")
        again = again.withColumn("k", F.row_number().over(Window.partitionBy("file", "block").orderBy("seq")))
        bytes_ = again.select("file", "block", "k", "data").join(parts, ["file", "block", "k"], "right")
        bytes_ = bytes_.withColumn("data", F.when(F.coalesce(F.octet_length("data"), F.lit(-1)) == F.col("size"), F.col("data")).otherwise(F.raise_error(F.lit("the archives changed while they were read"))))
        whole = bytes_.withColumnRenamed("off", "at").groupBy("file", F.col("owner").alias("off")).agg(F.array_sort(F.collect_list(F.struct("at", F.col("data").cast("string").alias("s")))).alias("_all"))
        text = F.array_join(F.transform("_all", lambda x: x["s"]), MAGIC).cast("binary")
        whole = split.drop(*known).join(whole.select("file", "off", text.alias("data")), ["file", "off"])
        whole = whole.withColumn("_block", F.expr("substring(data, int(head_bytes + 1), int(length))"))
        plain = plain.unionByName(whole.select(*split.drop(*known).columns, *payload_columns(F.col("_block"))))
    revisit = F.col("type") == "revisit"
    return plain.select(
        F.col("record_id").try_cast("long").alias("page_id"),
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("held_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("digest")).otherwise(F.col("held_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, F.col("refers_id").try_cast("long")).alias("refers_to"),
        "file",
        F.col("off").alias("offset"),
        F.when(~revisit, F.col("digest") == F.col("held_digest")).alias("digest_ok"),
    )


def warc_roundtrip(pages: DataFrame, min_revisit_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC archives and read them back."""
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    write_archives(plan_revisits(pages, min_revisit_bytes), path)
    return read_archives(spark, path)


def op1_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc_roundtrip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


#: DuckDB: the same rows from the table itself.
OP1_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d, coalesce(url, '') AS u FROM pages
), r AS (
  SELECT *, row_number() OVER (PARTITION BY h ORDER BY coalesce(page_id, -9223372036854775808) DESC, u DESC) AS k,
         max(page_id) OVER (PARTITION BY h) AS first_id FROM p
)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((('0x' || substr(d, CAST(i // 4 AS INT) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) AS INT) + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN first_id END AS refers_to,
       CASE WHEN k = 1 THEN true END AS digest_ok
FROM r
"""
