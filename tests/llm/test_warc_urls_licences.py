"""Operators 1, 3 and 5: round trips, planted rules and texts, and SQL."""

import base64
import hashlib
import itertools
import os
import random
from collections import Counter

import duckdb
import pytest

from millrace.llm import licences, registry, urls, warc
from millrace.llm.licence_texts import KNOWN

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PAGES = "page_id long, url string, html string, extra string, digest string, _rank string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


EVIL = "x WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n tail é"


@pytest.mark.parametrize("split", ["128m", "700"])
def test_warc_roundtrip(spark, split):
    rows = [(1, "http://a", "aé"), (2, None, None), (3, "u", ""), (4, "u\r\nX: y", EVIL), (5, "u", "aé"), (6, "u", EVIL), (None, "u", "zz"), (7, "u", "WARC/1.1\r\n"), (8, "u", "q" * 5000), (8, "v", "q" * 5000)]
    rows += [(100 + k, "u", EVIL + str(k)) for k in range(30)] + [(200, "u", "\r\n\r\n"), (201, "u", "HTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\n")]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.warc_roundtrip(pages(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == Counter((a, len((c or "").encode()), digest(c)) for a, _, c in rows)
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in got}
    assert {(5, "response", None), (1, "revisit", 5), (3, "response", None), (2, "revisit", 3), (6, "response", None), (4, "revisit", 6), (8, "response", None), (8, "revisit", 8)} <= kinds
    assert all(r.digest_ok for r in got if r.record_type == "response")


def test_one_of_equal_rows_is_the_response(spark):
    rows = [(1, "http://a", "x"), (1, "http://a", "x"), (3, None, None), (3, None, None), (3, None, ""), (4, "u", "alone"), (5, "u", "y"), (2, "u", "y"), (5, "u", "y"), (5, "t", "y"), (None, "u", "z"), (None, "u", "z")]
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.warc_roundtrip(pages(spark, rows)).collect())
    assert got == Counter({(1, "response", None): 1, (1, "revisit", 1): 1, (3, "response", None): 1, (3, "revisit", 3): 2, (4, "response", None): 1, (5, "response", None): 1, (5, "revisit", 5): 2, (2, "revisit", 5): 1, (None, "response", None): 1, (None, "revisit", None): 1})


def test_a_very_long_payload(spark):
    body = "<p>é WARC/1.1\r\n</p>" * 150_000
    (got,) = warc.warc_roundtrip(pages(spark, [(1, "u", body)])).collect()
    assert (got.payload_bytes, got.payload_digest, got.digest_ok) == (len(body.encode()), digest(body), True)


def test_warc_edges(spark):
    assert warc.warc_roundtrip(pages(spark, [])).collect() == []
    got = warc.warc_roundtrip(pages(spark, [(1, "u", "ab"), (2, "u", "ab")]), min_revisit_bytes=3).collect()
    assert [r.record_type for r in got] == ["response"] * 2


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = registry.QUERIES[name](spark, FOLDER)
    want = con.sql(registry.SQL[name])
    cols = sorted(df.columns)
    place = [want.columns.index(c) for c in cols]
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == sorted((tuple(r[i] for i in place) for r in want.fetchall()), key=repr)


def test_licences(spark):
    mit, bsd = KNOWN[0][1], next(t for n, t in KNOWN if n == "BSD-3-Clause")
    rows = [
        (0, mit), (1, "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace(",", " ,").replace("LICENSE", "LICENCE")), (2, "© X\n" + bsd.replace("\n\n", "\n")), (3, mit + " one word more"),
        (4, "prose\nlicensed under the APACHE licence, version 2.0\nmore\nReleased under the MIT License.\nReleased under the MIT License."), (5, None), (6, ""), (7, "Copyright 2020"), (8, "Released under the MIT License."), (8, "Released under the MIT License."), (9, "no licence here " * 5000),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, licences string, digest int")
    every = licences.scan_licences(df).fillna("", ["licences"]).collect()
    assert {(r.text_licence, r.notices) for r in every if r.doc_id in (0, 4, 8)} == {("MIT", None), (None, "Apache-2.0,MIT"), ("MIT", "MIT")}
    got = sorted((r.doc_id, r.licences, r.n_matches, r.whole_text) for r in every)
    assert got == sorted([
        (0, "MIT", 1, True), (1, "MIT", 1, True), (2, "BSD-3-Clause", 1, True), (3, "", 0, False), (4, "Apache-2.0,MIT", 3, False), (5, "", 0, False), (6, "", 0, False), (7, "", 0, False),
        (8, "MIT", 1, True), (8, "MIT", 1, True), (9, "", 0, False),
    ])
    assert licences.scan_licences(df.limit(0)).collect() == []


def test_every_known_text_is_found(spark):
    df = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(KNOWN)], "doc_id long, text string")
    assert {r.doc_id: r.licences for r in licences.scan_licences(df).collect() if r.whole_text} == {k: n for k, (n, _) in enumerate(KNOWN)}


@pytest.mark.skipif(not os.path.exists("/usr/share/common-licenses/GPL-3"), reason="needs the long texts")
def test_long_texts_are_known_by_digest(spark):
    """The whole texts as shipped by the system; also in capitals with British spelling and another copyright line, but not with a word more."""
    read = lambda name: open(f"/usr/share/common-licenses/{name}", encoding="utf-8").read()
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    rows = [(k, read(f)) for k, f in enumerate(files)]
    rows += [(10, "Copyright (c) 2031 Nobody\n" + read("GPL-3").upper().replace("LICENSE", "LICENCE")), (11, read("GPL-3") + "\nword")]
    got = {r.doc_id: r.text_licence for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**dict(enumerate(files.values())), 10: "GPL-3.0", 11: None}


CASES = {
    "http://a.COM/en/x": ("a.com", "/en/x", "com/en/", "block"),
    "https://x.example.com/en/7?q": ("x.example.com", "/en/7", "example.com/en/7", "allow"),
    "https://example.com/en/8": ("example.com", "/en/8", "com/en/", "block"),
    "http://b.net/de/1": ("b.net", "/de/1", "net/de/", "allow"),
    "http://example.net/de/81": ("example.net", "/de/81", "example.net/de/8", "block"),
    "http://notexample.net/de/8": ("notexample.net", "/de/8", "net/de/", "allow"),
    "http://o.org/es/": ("o.org", "/es/", "org/es/", "block"),
    "http://com": ("com", "", None, "allow"),
    "x": ("", "", None, "allow"),
    "a://b://c/d": ("b:", "//c/d", None, "allow"),
    "http://É.Com?x/en/": ("É.com", "", None, "allow"),
    "http://h.com#f/en/": ("h.com", "", None, "allow"),
}


def test_url_rules(spark):
    rows = [(k, u) for k, u in enumerate([*CASES, None])]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df, labels).collect()}
    assert got == dict(enumerate([*CASES.values(), ("", "", None, "allow")]))
    assert urls.judge_urls(df.limit(0), labels).collect() == []


def test_mined_rules(spark):
    """Two tokens that are bad only together; each alone is no sign."""
    rows, labels = [], []
    for k in range(400):
        a, b = k % 2, k // 2 % 2
        rows.append((k, f"https://{'win' if a else 'news'}.site.info/{'casino' if b else 'text'}/{k}"))
        labels.append((k, 0 if a and b else 1, 0))
    rows += [(1000, "https://win.site.info/casino/9999"), (1001, "https://win.site.info/text/9999"), (1002, "https://win.site.info/casino/9999")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    lab = spark.createDataFrame(labels + labels[:5], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in urls.judge_urls(df, lab, min_lift=3.0).collect()}  # a quarter is bad, of each token's URLs half
    assert [got[k].verdict for k in (1000, 1001, 1002)] == ["block", "allow", "block"] and got[1000].confidence == 1.0
    assert all((got[k].verdict == "block") == (k % 2 == 1 and k // 2 % 2 == 1) for k in range(400))
    rules = urls.mine_rules(urls.label_urls(df, lab), min_lift=3.0).collect()
    assert [sorted(r.antecedent) for r in rules] == [["host=win", "path=casino"]]


def test_many_shared_words_are_mined_in_bounded_time(spark):
    """URLs that share 18 words have 2**18 sets of them; mining looks at the words most often bad."""
    words = "/".join(f"w{chr(97 + k)}" for k in range(18))
    rows = [(k, f"https://h{k % 2}.info/{words}/{k}") for k in range(60)]
    lab = spark.createDataFrame([(k, 0 if k % 2 else 1, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame([*rows, (99, "https://h1.info/other"), (98, "https://h0.info/x")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge_urls(df, lab).collect()}
    assert all(got[k] == ("block" if k % 2 else "allow") for k in range(60)) and (got[99], got[98]) == ("block", "allow")


def test_rules_of_tokens_beyond_the_ones_most_often_bad(spark):
    """Twelve words are more often bad than the two that are bad only together."""
    words = "/".join(f"d{chr(97 + k)}" for k in range(12))
    paths = [f"win/casino/{words}"] * 40 + ["win"] * 40 + ["casino"] * 40 + [words] * 25
    df = spark.createDataFrame([*((k, f"https://a.info/{p}/{k}") for k, p in enumerate(paths)), (900, "https://a.info/win/casino"), (901, "https://a.info/casino")], "page_id long, url string")
    lab = spark.createDataFrame([(k, 0 if k < 40 else 1, 0) for k in range(len(paths))], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in urls.judge_urls(df, lab, min_lift=3.0).collect()}
    assert (got[900], got[901]) == ("block", "allow") and all(got[k] == ("block" if k < 40 else "allow") for k in range(len(paths)))


def test_rules_equal_all_sets_counted(spark):
    """URLs of up to 13 tokens: the rules are those of all sets of tokens, less those that a part has with at least the same confidence."""
    rng = random.Random(4)
    rows = []
    for _ in range(300):
        t = [w for w in "abcdefghij" if rng.random() < 0.6]
        rows.append((f"https://x.info/{'/'.join(t)}", rng.random() < (0.7 if {"a", "d"} <= set(t) else 0.4 if "b" in t and "c" not in t else 0.1)))
    df = spark.createDataFrame(rows, "url string, bad boolean")
    plain = [(frozenset(r.t), r.bad) for r in df.select(urls.url_tokens(urls.F.col("url")).alias("t"), "bad").collect()]
    share, sets = sum(b for _, b in plain) / len(plain), {}
    for t, bad in plain:
        for size in range(1, len(t) + 1):
            for x in itertools.combinations(sorted(t), size):
                n, hits = sets.get(x, (0, 0))
                sets[x] = n + 1, hits + bad
    rules = {frozenset(x): h / n for x, (n, h) in sets.items() if h >= 10 and h / n / share >= 1.5}
    want = {tuple(sorted(x)): c for x, c in rules.items() if not any(y < x and d >= c for y, d in rules.items())}
    got = {tuple(sorted(r.antecedent)): r.confidence for r in urls.mine_rules(df).collect()}
    assert got == want and len(want) > 5 and max(map(len, want)) > 2


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1"), reason="needs the driver's tables")
def test_mined_rules_decide_on_the_tables(spark):
    """On the driver's tables labels and URLs are drawn apart, so rules are few and weak; those that there are hold on all labelled rows, counted plainly."""
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    labelled = urls.label_urls(read("pages"), read("labels"))
    rules = urls.mine_rules(labelled).collect()
    rows = [(set(r.t), r.bad) for r in labelled.select(urls.url_tokens(urls.F.col("url")).alias("t"), "bad").collect()]
    share = sum(b for _, b in rows) / len(rows)
    assert rules
    for r in rules:
        fit = [b for t, b in rows if set(r.antecedent) <= t]
        assert sum(fit) == r.hits >= 10 and r.confidence == pytest.approx(sum(fit) / len(fit)) and r.lift == pytest.approx(r.confidence / share) and r.lift >= 1.5
    got = urls.judge_urls(read("pages"), read("labels")).where("rule is null")
    assert got.where("verdict = 'block'").count() == got.where("confidence is not null").count() > 0


def test_url_parts_and_rules_equal_sql(spark):
    """Host, path, rule and the rules' verdicts of all pages, and of odd URLs, against DuckDB."""
    odd = ["http://A.Example.COM", "x://y://z", "://", "http://u@h.org:80/es/9", "https://example.com/en/7", "https://EXAMPLE.net/de/8?x", "HTTP://é.net/de/", "a://b#c?d/e", "net://net/de/", None]
    con = duckdb.connect()
    con.sql(f"CREATE TABLE p AS SELECT page_id, url FROM '{FOLDER}/pages.parquet' UNION ALL SELECT 100000 + i, u FROM (SELECT unnest({[u or '' for u in odd]}) AS u, unnest(range({len(odd)})) AS i)")
    values = ", ".join(f"('{v}', '{h}', '{q}')" for v, h, q in urls.RULES)
    want = con.sql(f"""
      WITH s AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM p),
      h AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM s),
      m AS (SELECT page_id, host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS verdict FROM h LEFT JOIN (VALUES {values}) t(v, rh, rp) ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL)
      SELECT page_id, host, path, rule, verdict FROM m""").fetchall()
    df = spark.createDataFrame(con.sql("SELECT * FROM p").fetchall(), "page_id long, url string")
    got = urls.judge_urls(df, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in got) == sorted(want)
