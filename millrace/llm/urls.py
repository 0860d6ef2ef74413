"""Operator 5: URL verdicts from host/path rules and from mined association rules.

Listed rules decide first; the longest that fits a URL wins. For the rest, pattern growth (as in FP-growth: conditional tables of suffixes, equal
ones merged, tokens in ascending order of frequency) mines combinations of URL tokens that go with the bad label. Rules pruned by support and confidence form an inverted index
from token to rule; a URL whose tokens include a rule's whole antecedent is blocked. DataFrame functions only.

Confidence is asked for relative to the label: a rule must be ``min_lift`` times as often bad as all labelled URLs are. All tokens of all URLs are
mined. A set grows unless every rule beyond it would be dropped for a part of it: if all its rows are bad, or if a part of it has the same rows. So tokens that go
together don't multiply. What remains, sets with rows of their own and enough bad ones, is not bounded otherwise: URLs with many independent, frequent tokens have many of them.

Defined cases: a null URL, or one without ``://``, has an empty host and path, no rule and verdict allow; repeated
rows are judged each; of rules of equal length the first by text wins; without labels, or where none or all are bad, no rule is mined; a very long URL is matched by
all its tokens; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm._common import skew_join, stage

# Verdict, host, path prefix.
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Below this many index rows the rule index is broadcast; above it the join shuffles.
BROADCAST_RULES = 200_000


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_match(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]), reverse=True):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def url_tokens(url: Column) -> Column:
    """Distinct tokens: scheme, host labels by place, path words, file ending, query keys and fragment. Numbers are one token."""
    host, path = host_of(url), path_of(url)
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host="), x))
    words = F.transform(F.filter(F.split(F.lower(path), r"[/._-]+"), lambda x: x != ""), lambda x: F.concat(F.lit("path="), F.regexp_replace(x, r"^[0-9]+$", "#")))
    keys = F.transform(F.regexp_extract_all(url, F.lit(r"[?&]([^=&#]+)"), 1), lambda x: F.concat(F.lit("query="), F.lower(x)))
    rest = F.array(F.concat(F.lit("scheme="), F.lower(F.substring_index(url, "://", 1))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(rest, labels, words, keys)))


def label_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Label a page by its document: the last number in a URL's path is the doc_id of the page's text. Bad means quality 0."""
    doc = F.regexp_extract(path_of(F.col("url")), r"([0-9]{1,18})[^0-9]*$", 1).try_cast("long")
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    return pages.select("url", doc.alias("doc_id")).join(marks, "doc_id").where("bad is not null").select("url", "bad")


def _few(df: DataFrame) -> DataFrame:
    """``df``, broadcast if it has at most BROADCAST_RULES rows."""
    return F.broadcast(df) if df.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES else df


def _suffixes(rows: DataFrame, least: float) -> DataFrame:
    """The table that sets grow from: id 0, rest (of a token array those tokens that ``least`` bad rows have, rare ones first), and the numbers of all and of bad rows."""
    groups = stage(rows.groupBy(F.xxhash64("t").alias("k"), "t").agg(F.count("*").alias("all"), F.count(F.when(F.col("bad"), 1)).alias("bad")), "url-groups")
    each = groups.select("k", "all", "bad", F.explode("t").alias("token"))
    tokens = stage(each.groupBy("token").agg(F.sum("all").alias("n"), F.sum("bad").alias("hits")).where(F.col("hits") >= least), "url-tokens")
    rest = F.transform(F.array_sort(F.collect_list(F.struct("n", "token"))), lambda x: x["token"])
    found = each.join(_few(tokens.select("token", "n")), "token").groupBy("k", "all", "bad").agg(rest.alias("rest"))
    return stage(found.groupBy(F.lit(0).cast("long").alias("id"), "rest").agg(F.sum("all").alias("all"), F.sum("bad").alias("bad")), "url-suffixes")


def mine_rules(labelled: DataFrame, min_support: float = 0.002, min_lift: float = 1.5, min_hits: int = 10) -> DataFrame:
    """Rules ``antecedent => bad`` as rule_id, antecedent, confidence, support, lift, hits.

    ``labelled``: url, bad. A rule needs ``min_hits`` bad rows, ``min_support`` of all rows being so, and ``min_lift`` times the share that is bad at large. It is dropped if a
    part of its antecedent is a rule with at least the same confidence.
    """
    rows = stage(labelled.select(url_tokens(F.col("url")).alias("t"), "bad").where(F.size("t") > 0), "url-labelled")
    rules = rows.sparkSession.createDataFrame([], "rule_id long, antecedent array<string>, confidence double, support double, lift double, hits long")
    n, n_bad = rows.agg(F.count("*"), F.count(F.when(F.col("bad"), 1))).first()
    if n_bad < min_hits or n_bad == n:
        return rules
    least = max(min_hits, min_support * n)
    table, grown, size = _suffixes(rows, least), None, 1
    while not table.isEmpty():
        longer = table.select("id", "all", "bad", "rest", F.posexplode("rest").alias("_at", "token"))
        longer = longer.select("id", "token", F.slice("rest", F.col("_at") + 2, F.size("rest")).alias("rest"), "all", "bad")
        sets = longer.groupBy("id", "token").agg(F.sum("all").alias("freq"), F.sum("bad").alias("hits"), F.count("*").alias("times")).where(F.col("hits") >= least)
        if grown is None:
            sets = sets.withColumn("items", F.array("token")).withColumn("best_part", F.lit(0.0))
        else:
            # All parts that lack one token must have grown, and have more rows.
            sets = sets.join(grown.select("id", "items"), "id").withColumn("items", F.concat("items", F.array("token")))
            part = lambda k: F.concat(F.slice("items", 1, k), F.slice("items", k + 2, size))
            parts = sets.select("id", "token", "freq", F.explode(F.array(*[F.xxhash64(part(k)) for k in range(size)])).alias("part"))
            parts = parts.join(grown.select(F.col("id").alias("part"), F.col("freq").alias("_f"), "best"), "part").where("_f > freq")
            parts = parts.groupBy("id", "token").agg(F.count("*").alias("_n"), F.max("best").alias("best_part")).where(F.col("_n") == size).drop("_n")
            sets = sets.join(parts, ["id", "token"])
        sets = sets.withColumn("confidence", F.col("hits") / F.col("freq")).withColumn("lift", F.col("confidence") / F.lit(n_bad / n))
        best = F.greatest("best_part", F.when(F.col("lift") >= min_lift, F.col("confidence")).otherwise(0.0))
        sets = stage(sets.withColumn("best", best).withColumnRenamed("id", "parent").withColumn("id", F.xxhash64("items")), "url-sets")
        items = F.array_sort("items")
        told = sets.where((F.col("lift") >= min_lift) & (F.col("confidence") > F.col("best_part")))
        rules = rules.unionByName(told.select(F.xxhash64(items).alias("rule_id"), items.alias("antecedent"), "confidence", (F.col("hits") / F.lit(n)).alias("support"), "lift", "hits"))
        grown = sets.where("hits < freq").select("id", "parent", "token", "items", "freq", "best", "times")
        where = grown.select(F.col("parent").alias("id"), "token", F.col("id").alias("next"), "times")
        following = skew_join(longer.where(F.size("rest") > 0), where, ["id", "token"], "times", grown.agg(F.sum("times")).first()[0] or 0).where("next is not null")
        table = stage(following.groupBy(F.col("next").alias("id"), "rest").agg(F.sum("all").alias("all"), F.sum("bad").alias("bad")), "url-suffixes")
        size += 1
    return rules


def _matched(probe: DataFrame, index: DataFrame, *carried: list[str]) -> DataFrame:
    """Of rows (key, token, ...) and index rows (token, rule_id, n, ...): key, rule_id and the carried columns where all n tokens of a rule are met."""
    index = _few(index)
    columns = [c for names in carried for c in names]
    found = probe.join(index, "token").groupBy("key", "rule_id").agg(F.count("*").alias("_c"), F.first("n").alias("_n"), *[F.first(c).alias(c) for c in columns])
    return found.where("_c = _n").drop("_c", "_n")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (key, url): the keys whose tokens include a whole antecedent, with the highest confidence of such a rule."""
    index = rules.select(F.explode("antecedent").alias("token"), "rule_id", F.size("antecedent").alias("n"), "confidence")
    probe = urls.select("key", F.explode(url_tokens(F.col("url"))).alias("token"))
    return _matched(probe, index, ["confidence"]).groupBy("key").agg(F.max("confidence").alias("confidence"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES, min_support: float = 0.002, min_lift: float = 1.5, min_hits: int = 10) -> DataFrame:
    """page_id, host, path, rule, verdict and the mined rule's confidence (where one decided) for every page.

    Mined rules are matched once for each distinct URL without a listed rule.
    """
    url = F.col("url")
    rows = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path")).withColumn("_m", rule_match(F.col("host"), F.col("path"), rules))
    mined = stage(mine_rules(label_urls(pages, labels), min_support, min_lift, min_hits), "url-mined")
    if mined.isEmpty():
        rows = rows.withColumn("confidence", F.lit(None).cast("double"))
    else:
        # A URL that very many pages share is matched once, and joined back apart from the rest.
        asked = rows.where("_m is null and url is not null").groupBy("url").agg(F.count("*").alias("times"))
        asked = stage(asked.select(F.col("url").alias("key"), "url", "times"), "url-asked")
        found = stage(match_rules(asked.select("key", "url"), mined).join(asked.select("key", "times"), "key").withColumnRenamed("key", "url"), "url-found")
        rows = skew_join(rows, found, ["url"], "times", found.agg(F.sum("times")).first()[0] or 0)
        rows = rows.withColumn("confidence", F.when(F.col("_m").isNull(), F.col("confidence")))
    verdict = F.coalesce(F.col("_m.verdict"), F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", F.col("_m.rule").alias("rule"), verdict.alias("verdict"), "confidence")


def op5_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge_urls(pages, labels)
