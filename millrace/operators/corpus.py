"""Document corpus: drop reasons, scrubbing, exact deduplication, budgeted sampling and chunking.

The order matters and is fixed: length is tested on the raw text, private keys drop a document, then secrets are redacted, and duplicates are found
on the redacted text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.text import CORPUS_CHARS_PER_TOKEN, FATAL_SECRET, RESIDUAL_SECRET, redacted
from millrace.staging import stage

# Fixed values.
MIN_CHARS = 200
MAX_CHARS = 60000
SKIP_DIRS = r"(?i)(^|/)(node_modules|\.git|dist|build|out|target|vendor|\.next|\.nuxt|__pycache__|\.venv|venv|coverage|site-packages|\.pnpm|\.cache|\.turbo)/"
SKIP_INSTALLED = r"(?i)(^|/)(_bmad|\.bmad)(/|$)|(^|/)\.(claude|opencode|codex)/(skills|plugins|agents|commands)/|(^|/)node_modules/"


def document_path(source: Column, doc_id: Column) -> Column:
    return F.concat(source, F.lit("/"), doc_id.cast("string"), F.lit(".md"))


def keep_paths(files: DataFrame, path: str = "path") -> DataFrame:
    """Without build output, vendored and installed content."""
    return files.where(~F.col(path).rlike(SKIP_DIRS) & ~F.col(path).rlike(SKIP_INSTALLED))


def first_of_content(docs: DataFrame, order: str, text: str = "text") -> DataFrame:
    """Exact deduplication by MD5 of the text: the first by ``order`` stays."""
    first = docs.withColumn("_md5", F.md5(text))
    w = Window.partitionBy("_md5").orderBy(order)
    return first.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k", "_md5")


def _marked(docs: DataFrame, min_chars: int, drop: bool = False) -> DataFrame:
    """With clean_text, n_redactions and ``_r``: the first reason that needs no other document. With ``drop``, only rows without a reason.

    A generator holds what was found, so each text goes through the rules once and filters don't repeat them.
    """

    def judge(x: Column) -> Column:
        reason = F.when(F.length("text") < min_chars, "too_short").when(F.col("text").rlike(FATAL_SECRET), "private_key").when(x["text"].rlike(RESIDUAL_SECRET), "residual_secret")
        return F.struct(x["text"].alias("clean_text"), x["n"].alias("n_redactions"), reason.alias("_r"))

    found = F.transform(F.array(redacted("text")), judge)
    if drop:
        found = F.filter(found, lambda x: x["_r"].isNull())
    return docs.select("*", F.explode(found).alias("_m")).select(*docs.columns, "_m.*")


def drop_reasons(docs: DataFrame, min_chars: int = MIN_CHARS, order: str = "doc_id", salts: int = 16) -> DataFrame:
    """``docs`` with clean_text, n_redactions and drop_reason (null for those that stay).

    The first of each content comes from a pre-aggregated minimum. It is joined back on content and a salt, so a
    content that holds a large share of the rows is dealt to several tasks.
    """
    marked = _marked(docs, min_chars).withColumn("_md5", F.md5("clean_text")).withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(salts)).cast("int"))
    firsts = marked.where("_r is null").groupBy("_md5").agg(F.min(order).alias("_first"))
    firsts = firsts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = marked.join(firsts, ["_md5", "_salt"], "left")
    again = F.col("_r").isNull() & (F.col(order) > F.col("_first"))
    return joined.withColumn("drop_reason", F.when(again, "duplicate").otherwise(F.col("_r"))).select(*docs.columns, "clean_text", "n_redactions", "drop_reason")


def corpus_clean(docs: DataFrame, min_chars: int = MIN_CHARS, order: str = "doc_id") -> DataFrame:
    """The documents that stay, scrubbed. Spark limits each content to its first row before the shuffle."""
    kept = _marked(docs, min_chars, drop=True).withColumn("text", F.col("clean_text")).drop("clean_text", "_r")
    return first_of_content(kept, order)


def assert_no_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Fails at run time, before anything is committed, if a secret is left."""
    bad = F.col(text).rlike(RESIDUAL_SECRET)
    return docs.withColumn(text, F.when(bad, F.raise_error(F.lit("a secret is left after redaction"))).otherwise(F.col(text)))


def chunks(docs: DataFrame, path: Column, max_chars: int = MAX_CHARS, min_chars: int = MIN_CHARS, text: str = "text") -> DataFrame:
    """One row per chunk of ``max_chars``, under a header line; a continuation shorter than ``min_chars`` is dropped."""
    count = F.floor((F.greatest(F.length(text), F.lit(1)) - 1) / max_chars)
    rows = docs.withColumn("_path", path).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), count)))
    body = F.substring(F.col(text), (F.col("chunk") * max_chars + 1).cast("int"), F.lit(max_chars))
    rows = rows.withColumn("_body", body).where((F.col("chunk") == 0) | (F.length("_body") >= min_chars))
    header = F.when(F.col("chunk") == 0, F.lit("# Document: ")).otherwise(F.lit("# Document (cont.): "))
    return rows.withColumn(text, F.concat(header, F.col("_path"), F.lit("\n\n"), F.col("_body"))).withColumnRenamed("_path", "source_path").drop("_body")


def budget_sample(docs: DataFrame, budget: int, order: Column, size: Column) -> DataFrame:
    """Greedy budget over one global order: a document that would overflow is passed over, later ones still get their chance.

    ``order`` is an MD5 in hex. Each round takes the longest run of documents that fits. Where it ends, the next document is too large for what is left; so are all later ones of
    its size or more, now and for good, and they are no candidates any more. A round needs the sums of 4096 ranges of the order and one running sum within the range where the
    budget ends, over a written table of orders and sizes, so nothing is gathered and ``docs`` is read once. What is left falls with each round below the size of the document that
    ended it, so there are at most as many rounds as different sizes above the smallest, in practice a few. The result is a plain filter: a document is taken if it
    lies in a round's range and was a candidate in that round; documents of equal order and size are taken or passed over together.
    """
    sized = docs.withColumn("_order", order).withColumn("_size", size.cast("long"))
    slim = stage(sized.select("_order", "_size").where(F.col("_size") <= budget).withColumn("_b", F.substring("_order", 1, 3)), "budget")
    left, after = budget, ""
    taken = F.lit(False)
    while True:
        here = slim.where((F.col("_order") > after) & (F.col("_size") <= left))
        total, end = 0, None
        for r in sorted(here.groupBy("_b").agg(F.sum("_size").alias("s")).collect()):  # at most 4096 rows
            if total + r["s"] > left:
                end = r["_b"]
                break
            total += r["s"]
        inside = (F.col("_order") > after) & (F.col("_size") <= left)
        if end is None:
            return sized.where(taken | inside).drop("_order", "_size")
        run = F.sum("_size").over(Window.partitionBy("_b").orderBy("_order"))
        over = here.where(F.col("_b") == end).withColumn("_run", run).where(F.col("_run") > left - total)
        first = over.orderBy("_order").select("_order", (F.col("_run") - F.col("_size")).alias("used")).first()
        taken = taken | (inside & (F.col("_order") < first["_order"]))
        left, after = left - total - first["used"], first["_order"]


def budget_for_tokens(millions: float) -> int:
    return int(millions * 1_000_000 * CORPUS_CHARS_PER_TOKEN)
