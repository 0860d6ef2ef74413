"""Operator 10: benchmark decontamination by spaced-seed hashing.

A mask keeps some of a few successive token positions and ignores the rest. Under each mask every
window of a document and of a benchmark item is hashed over its kept tokens; windows with equal hashes are
hits. All windows of both sides are hashed. The masks are such that no stretch of SPAN tokens or more that starts and ends with equal tokens, three
quarters of them equal, is without a hit, wherever its substitutions are (the tests go through all patterns). Items shorter than SPAN have masks that do the same for the whole
item. A hit fixes how document and item line up; the tokens around it are then compared one by one, and pairs with a long enough, equal enough overlap stand.
Built-in functions only.

Defined cases: null and empty texts have no tokens and never match; documents with a null doc_id are looked at like any other (their pairs have a null doc_id); items with a
null item_id or of fewer than ``min_item`` tokens are left out; repeated rows of documents or items give the same pair once, rows that share a doc_id but not their text are
judged each; of overlaps of one pair the longest (then the earliest) is returned; a very long text has one row for each hit only, and is compared around its hits; empty tables give no
rows; further columns are ignored. Tokens are compared by 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm._common import stage

SPAN = 12
#: Each mask's kept positions: for overlaps of SPAN tokens or more,
MASKS = ((0, 1, 2, 3), (0, 1, 3, 4))
#: for those of LEAST or more,
SHORT_MASKS = ((0, 1, 2), (0, 1, 3, 4))
LEAST = 5
#: and for whole items of fewer tokens.
TINY_MASKS = {1: ((0,),), 2: ((0, 1),), 3: ((0, 1, 2),), 4: ((0, 1, 3), (0, 2, 3))}
#: The masks hold for overlaps with at least this share of equal tokens.
EQUAL = 0.75
#: Up to so many hashed benchmark windows (20 bytes each) are broadcast; beyond, the join shuffles.
BROADCAST_WINDOWS = 2_000_000


def tokens(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits. What stands before a first separator is empty and goes; so does what follows a last one."""
    words = F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda x: x != ""), lambda x: F.xxhash64(x))


def document_key(docs: DataFrame) -> Column:
    """What tells documents apart: doc_id and text."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text")


def _window_hashes(words: Column, kept: tuple[int, ...], tag: int) -> Column:
    """The hash of each window over its kept positions; windows whose kept positions overrun are left out."""
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - max(kept), F.lit(0)))
    return F.transform(starts, lambda _, i: F.xxhash64(F.lit(tag), *[F.get(words, i + k) for k in kept]))


def masks_of(width: int, min_overlap: int = SPAN) -> tuple[tuple[int, ...], ...]:
    """The masks for items of ``width`` tokens."""
    width = min(width, min_overlap)
    return MASKS if width >= SPAN else SHORT_MASKS if width >= LEAST else TINY_MASKS[width]


def windows(frame: DataFrame, masks: list[tuple[int, ...]]) -> DataFrame:
    """``frame`` (id, words) to id, pos, h: hashed windows under all masks."""
    arrays = [_window_hashes(F.col("words"), kept, sum(1 << k for k in kept)) for kept in masks]
    packed = [F.transform(a, lambda h, i: F.struct(i.alias("pos"), h.alias("h"))) for a in arrays]
    return frame.select("id", F.explode(F.concat(*packed)).alias("_w")).select("id", F.col("_w.pos").alias("pos"), F.col("_w.h").alias("h"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, min_overlap: int = 12, min_equal: float = 0.75, min_item: int = 1) -> DataFrame:
    """Pairs of documents and items: doc_id, item_id, doc_start, item_start, n_tokens (length of the overlap) and n_equal."""
    return _overlaps(docs, benchmark, min_overlap, min_equal, min_item).drop("id")


def _overlaps(docs: DataFrame, benchmark: DataFrame, min_overlap: int = 12, min_equal: float = 0.75, min_item: int = 1) -> DataFrame:
    """The pairs with the document's key (id).

    An overlap is a stretch that starts and ends with equal tokens, has at least ``min_overlap`` tokens (or the whole item, if
    that is shorter) and at least ``min_equal`` of them equal. It is the best-scoring stretch of the
    alignment, an equal token counting 1 and a different one -0.9.
    """
    if min_equal < EQUAL:
        raise ValueError(f"the masks guarantee a hit for overlaps with at least {EQUAL} of their tokens equal")
    items = benchmark.where("item_id is not null").select(F.col("item_id").alias("id"), tokens(F.col("text")).alias("words")).where(F.size("words") >= max(min_item, 1))
    items = stage(items, "bench-items")
    widths = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(SPAN))).distinct().collect())  # at most SPAN values
    of = {w: masks_of(w, max(min_overlap, 1)) for w in widths}
    masks = sorted({m for found in of.values() for m in found})
    seeds = [windows(items.where(F.least(F.size("words"), F.lit(SPAN)).isin([w for w in widths if m in of[w]])), [m]) for m in masks]
    seeds = reduce(DataFrame.unionByName, seeds) if seeds else windows(items, [MASKS[0]])
    seeds = stage(seeds.select(F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), "h").distinct(), "bench-seeds")
    words = docs.select(document_key(docs).alias("id"), "doc_id", tokens(F.col("text")).alias("words"))
    small = seeds.count() <= BROADCAST_WINDOWS
    hits = windows(words, masks or [MASKS[0]]).join(F.broadcast(seeds) if small else seeds, "h")
    lined = hits.select("id", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct()
    lined = stage(lined, "bench-hits")
    by_doc = lined.groupBy("id").agg(F.collect_set(F.struct("item_id", "shift")).alias("lines"))
    # The few documents with hits are read again for their tokens; Spark broadcasts the hits where their table is small.
    pairs = words.join(stage(by_doc, "bench-lines"), "id").select("id", "doc_id", "words", F.explode("lines").alias("_l"))
    pairs = pairs.select("id", "doc_id", F.col("_l.item_id").alias("item_id"), F.col("_l.shift").alias("shift"), F.slice("words", F.greatest(F.col("_l.shift"), F.lit(0)) + 1, F.lit(_longest(items))).alias("near"))
    both = pairs.join(items.select(F.col("id").alias("item_id"), F.col("words").alias("item")), "item_id")
    skip = F.greatest(-F.col("shift"), F.lit(0))  # item tokens before the document's first
    same = F.transform(F.sequence(F.lit(0), F.least(F.size("near"), F.size("item") - F.col("skip")) - 1), lambda i: F.get("near", i) == F.get("item", i + F.col("skip")))
    both = both.withColumn("skip", skip).where((F.size("near") > 0) & (F.col("skip") < F.size("item"))).withColumn("same", same)
    best = F.aggregate(
        F.col("same"),
        F.struct(F.lit(0.0).alias("run"), F.lit(0).alias("from"), F.lit(0).alias("i"), F.lit(0.0).alias("best"), F.lit(0).alias("lo"), F.lit(-1).alias("hi")),
        _extend,
    )
    both = both.withColumn("_b", best).where("_b.hi >= 0")
    inside = F.slice("same", F.col("_b.lo") + 1, F.col("_b.hi") - F.col("_b.lo") + 1)
    out = both.select(
        "id",
        "doc_id",
        "item_id",
        (F.greatest(F.col("shift"), F.lit(0)) + F.col("_b.lo")).cast("long").alias("doc_start"),
        (F.col("skip") + F.col("_b.lo")).cast("long").alias("item_start"),
        (F.col("_b.hi") - F.col("_b.lo") + 1).cast("long").alias("n_tokens"),
        F.size(F.filter(inside, lambda x: x)).cast("long").alias("n_equal"),
        F.size("item").alias("_len"),
    )
    out = out.where((F.col("n_tokens") >= F.least(F.lit(min_overlap), F.col("_len"))) & (F.col("n_equal") >= min_equal * F.col("n_tokens"))).drop("_len")
    w = Window.partitionBy("id", "item_id").orderBy(F.desc("n_equal"), "n_tokens", "doc_start", "item_start")
    return out.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def _longest(items: DataFrame) -> int:
    return items.agg(F.max(F.size("words"))).first()[0] or 1


def _extend(acc: Column, same: Column) -> Column:
    """One step of the maximum-sum stretch."""
    fresh = acc["run"] <= 0
    run = F.when(fresh, F.lit(0.0)).otherwise(acc["run"]) + F.when(same, 1.0).otherwise(-0.9)
    start = F.when(fresh, acc["i"]).otherwise(acc["from"])
    better = run > acc["best"]
    return F.struct(
        run.alias("run"),
        start.alias("from"),
        (acc["i"] + 1).alias("i"),
        F.when(better, run).otherwise(acc["best"]).alias("best"),
        F.when(better, start).otherwise(acc["lo"]).alias("lo"),
        F.when(better, acc["i"]).otherwise(acc["hi"]).alias("hi"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents (told apart by doc_id and text) that hold a passage of the benchmark."""
    bad = stage(_overlaps(docs, benchmark).select("id").distinct(), "bench-bad")
    small = bad.count() <= BROADCAST_WINDOWS
    return docs.join(F.broadcast(bad) if small else bad, document_key(docs) == bad["id"], "left_anti").select(*docs.columns)


def op10_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
