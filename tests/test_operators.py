"""Operators on inline rows, where the driver's tables carry no signal."""

import random

from pyspark.sql import functions as F

from millrace import staging
from millrace.operators import cochange, commits, conversations, corpus, fim, metrics, nextedit, packing, sampling


def turns(spark, *convs):
    rows = [(c, k, role, f"{role} {c}.{k}") for c, roles in enumerate(convs) for k, role in enumerate(roles)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def windows(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.conv_id, r.window_id), []).append(r.turn)
    return {k: sorted(v) for k, v in out.items()}


def test_request_windows(spark):
    u, a = "user", "assistant"
    long = [u] + [a] * 60
    got = windows(conversations.request_windows(turns(spark, [u, a], [a, u, a, a, u, a], [a, a], long, [u, *[a] * 20, u, a, *[a] * 30])))
    assert got[0, 0] == [0, 1]  # a short one that starts with a user turn is kept whole
    assert got[1, 0] == [1, 2, 3] and (1, 1) not in got  # the last window has two turns
    assert not any(c == 2 for c, _ in got)
    assert got[3, 0] == list(range(40))
    assert got[4, 0] == list(range(21)) and got[4, 1] == list(range(21, 53))


def test_call_pairing_against_a_dictionary(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 3), k, rng.choice(["call", "output", "message"]), rng.choice([None, "", "a", "b", "c"])) for k in range(500)]
    got = {tuple(r) for r in conversations.pair_calls(spark.createDataFrame(rows, "s long, pos long, kind string, id string"), "s", "pos", "kind", "id").collect()}
    want, pending = [], {}
    for s, pos, kind, key in rows:
        if kind == "call":
            want.append([s, pos, None])
            if key:
                pending[s, key] = want[-1]
        elif kind == "output":
            call = pending.pop((s, key), None)
            if call is None:
                want.append([s, None, pos])
            else:
                call[2] = pos
    assert got == {tuple(w) for w in want}


def test_agentic_examples_need_a_call(spark):
    rows = [(0, 0, "user", "go"), (0, 1, "assistant", "\n[TOOL_CALL]x\n{}[/TOOL_CALL]\n"), (0, 2, "tool_result", "[TOOL_RESULT]r[/TOOL_RESULT]"), (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "ok"), (2, 0, "user", " ")]
    got = conversations.agentic_examples(spark.createDataFrame(rows, "c long, pos long, role string, content string"), ["c"], "pos").collect()
    assert [r.c for r in got] == [0]
    assert [m.role for m in got[0].messages] == ["system", "user", "assistant", "tool"]


def test_log_parsing_and_filters(spark):
    lines = [
        "noise", "__C__s1\x1f100\x1ffeat(ui): x", "1\t2\tsrc/b.py", "3\t4\tsrc/a.py", "-\t-\timg.py", "1\t1\t.env", "1\t1\tnode_modules/x.js", "bad line",
        "__C__s2\x1f200\x1fdocs!: y", "1\t1\ta.py", "__C__s3\x1f300\x1fMerge branch", "1\t1\ta.py", "__C__s4\x1f400\x1ffix: z", "", "__C__s5\x1f500\x1fplain",
    ] + [f"1\t1\tf{k:02}.py" for k in range(26)]
    df = spark.createDataFrame([("r", k, x) for k, x in enumerate(lines)], "repo string, line_no long, line string")
    parsed = commits.parse_log(df)
    rows = {r.sha: r for r in commits.drop_reason(parsed).collect()}
    assert rows["s1"].files == ["src/a.py", "src/b.py"] and (rows["s1"].type, rows["s1"].scope, rows["s1"].ts, rows["s1"].drop_reason) == ("feat", "ui", 100, None)
    assert [rows[f"s{k}"].drop_reason for k in (2, 3, 4, 5)] == ["skip_type", "skip_msg", "skip_nofiles", "skip_large"]
    tracked = spark.createDataFrame([("r", "src/a.py")], "repo string, path string")
    assert {r.sha: r.files for r in commits.parse_log(df, tracked).collect()}["s1"] == ["src/a.py"]


DIFF = "diff --git a b\n@@ -3,2 +3,3 @@ def f\n keep\n-old\n--- x\n+new\n\\ No newline at end of file\n@@ -40 +41 @@\n same\n@@ -90,0 +91,1 @@\n+added\n"


def test_log_in_ranges(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for repo in ("a", "b"):
        sha = None
        for k in range(3000):
            if k and rng.random() < 0.1:
                sha = f"{repo}{k}"
                want[repo, sha] = []
                rows.append((repo, k, f"__C__{sha}\x1f{k}\x1fs"))
            else:
                rows.append((repo, k, f"1\t1\tp{k}.py"))
                if sha and k % 7:
                    want[repo, sha].append(f"p{k}.py")
    tracked = spark.createDataFrame([(r, f"p{k}.py") for r in ("a", "b") for k in range(3000) if k % 7] * 2, "repo string, path string")
    out = commits.parse_log(spark.createDataFrame(rows, "repo string, line_no long, line string").repartition(5, "line"), tracked)
    assert {(r.repo, r.sha): r.files for r in out.collect()} == {k: sorted(v) for k, v in want.items()}
    assert "line_no#" not in "".join(x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window" in x and "_p#" not in x)


def test_hunks(spark):
    got = sorted(nextedit.parse_hunks(spark.createDataFrame([("s", DIFF)], "sha string, diff string"), ["sha"]).collect(), key=lambda r: r.start)
    assert [(r.start, r.pre, r.post) for r in got] == [(3, ["keep", "old", "-- x"], ["keep", "new"]), (90, [], ["added"])]
    assert got[0].raw == ["@@ -3,2 +3,3 @@ def f", " keep", "-old", "--- x", "+new"]


def test_next_edit_history_and_budget(spark):
    hunks = [("r", "s", "c", f"p{k}", 1, ["x"], ["y"], ["@@"] + [f"-l{j}" for j in range(50 if k == 0 else 3)]) for k in range(7)]
    df = spark.createDataFrame(hunks, "repo string, sha string, cluster_id string, path string, start long, pre array<string>, post array<string>, raw array<string>")
    sib = spark.createDataFrame([("s", "c", ["a", "b"])], "sha string, cluster_id string, siblings array<string>")
    got = {r.path: r for r in nextedit.next_edit_examples(df, sib).collect()}
    assert sorted(got) == [f"p{k}" for k in range(1, 7)]
    assert "... [10 lines elided] ..." in got["p1"].prompt and got["p6"].prompt.count("--- p") == 4
    assert got["p1"].completion == "y\n>>>>>>> UPDATED" and got["p1"].prompt.endswith("### Current file: p1\n<<<<<<< CURRENT\nx\n=======")
    small = {r.path: r for r in nextedit.next_edit_examples(df, sib, max_chars=170).collect()}
    assert all(len(r.prompt) <= 170 for r in small.values())
    for r in small.values():  # keeping one more block would have gone over
        kept = r.prompt.count("--- p")
        assert kept == 4 or kept == int(r.path[1:]) or len(got[r.path].prompt) > 170


def test_metrics(spark):
    rows = [(0, "a\nb\n>>>>>>> UPDATED", "a\nb\n>>>>>>> UPDATED"), (1, "a  \nb", "a\nb\n>>>>>>> UPDATED"), (2, "", ""), (3, "x", ""), (4, "a\na\nb", "a\nb\nb\n>>>>>>> UPDATED")]
    df = spark.createDataFrame(rows, "id long, prediction string, completion string").withColumn("prompt", F.lit("<<<<<<< CURRENT\na\nb\n======="))
    f1 = {r.id: r.line_f1 for r in metrics.line_f1(df, "id", "prediction", "completion").collect()}
    assert f1 == {0: 1.0, 1: 1.0, 2: 1.0, 3: 0.0, 4: 2 * 2 / 6}
    res = {r.id: r for r in metrics.edit_results(df).collect()}
    assert [res[k].exact_match for k in range(5)] == [True, True, True, False, False]
    assert res[0].no_op and res[1].no_op and not res[4].no_op and not res[1].format_valid
    args = spark.createDataFrame([(0, '{"a": "x", "b": "y"}', '{"z": "x"}'), (1, "{}", '{"a": 1}'), (2, None, '{"a": 1}'), (3, '{"q": "%s1"}' % ("w" * 200), '{"r": "%s2"}' % ("w" * 200))], "id long, p string, g string")
    assert {r.id: r.args_overlap for r in metrics.args_overlap(args, "id", "p", "g").collect()} == {0: 2 / 3, 1: 0.0, 2: 0.0, 3: 1.0}
    verdicts = spark.createDataFrame([('ok {"correct": true, "reason": "r"} end',), ("none",), ('{"correct": 1}',)], "t string").select(metrics.parse_verdict(F.col("t")).alias("v")).collect()
    assert verdicts[0].v.correct is True and verdicts[0].v.reason == "r" and verdicts[1].v is None
    rate = metrics.judge_rate(spark.createDataFrame([(True,), (False,), (None,)], "v boolean"), "v").first()
    assert (rate.rate, rate.n, rate.n_failed) == (0.5, 2, 1)


def test_fim_rules(spark):
    ok = "\n".join(["line %d" % k for k in range(12)])
    files = [("a", ok), ("few", "\n".join("abcdef")), ("many", "\n".join(["x1y"] * 501)), ("wide", ok + "\n" + "w" * 201), ("blank", "\n".join(["  "] * 10)), ("short", "\n".join(["ab"] * 10))]
    got = fim.fim_candidates(spark.createDataFrame(files, "path string, text string"), "path").collect()
    assert {r.path for r in got} == {"a"} and len(got) == 5 and all(5 <= r.line <= 10 for r in got)
    assert all(r.prefix + "\n" + r.middle + "\n" + r.suffix == ok for r in got)
    paths = {"src/a.py": True, "rebuilder.py": False, "src/x.min.js": False, "a.PY": True, "a.exe": False, "vendor/a.py": False, ".py": False}
    df = spark.createDataFrame([(p,) for p in paths], "p string").select("p", fim.include_file(F.col("p")).alias("k"))
    assert {r.p: r.k for r in df.collect()} == paths


def test_packing_matches_a_loop(spark):
    rng = random.Random(2)
    rows = [(k, [rng.randint(3, 99) for _ in range(rng.randint(0, 40))]) for k in range(57)]
    got = packing.pack_sequences(spark.createDataFrame(rows, "row long, ids array<int>"), "row", "ids", 16, 0, batch=10).collect()
    want = []
    for b in range(0, len(rows), 10):
        flat = [t for _, ids in rows[b : b + 10] for t in [*ids, 0]]
        want += [flat[k : k + 16] for k in range(0, len(flat) - 15, 16)]
    assert [r.input_ids for r in sorted(got, key=lambda r: (r.batch, r.block))] == want
    assert all(r.attention_mask == [1] * 16 for r in got)
    assert packing.pack_stats(100, 40, 2, 2, 4) == (2.5, 10)


def modularity(pairs, member):
    total = sum(w for *_, w in pairs)
    degree, inside = {}, {}
    for a, b, w in pairs:
        degree[member[a]] = degree.get(member[a], 0) + w
        degree[member[b]] = degree.get(member[b], 0) + w
        if member[a] == member[b]:
            inside[member[a]] = inside.get(member[a], 0) + w
    return sum(inside.get(c, 0) / total - (d / (2 * total)) ** 2 for c, d in degree.items())


def test_communities(spark):
    rng = random.Random(3)
    pairs = [(f"g{g}n{a}", f"g{g}n{b}", 0.9) for g in range(3) for a in range(6) for b in range(a + 1, 6)] + [("g0n0", "g1n0", 0.1), ("g1n1", "g2n1", 0.1)]
    rng.shuffle(pairs)
    member = cochange.louvain(pairs)
    assert len(set(member.values())) == 3 and member == cochange.louvain(pairs[::-1])
    assert modularity(pairs, member) > modularity(pairs, dict.fromkeys(member, 0))
    edges = spark.createDataFrame([("r", min(a, b), max(a, b), w) for a, b, w in pairs], "repo string, a string, b string, jaccard double")
    members = cochange.communities(edges)
    assert {r.file for r in members.collect()} == set(member)
    rows = cochange.cohesion(edges, members).collect()
    assert sorted(r.n_files for r in rows) == [6, 6, 6] and all(r.cohesion == 0.9 for r in rows)


def test_labels_and_prefix(spark):
    members = spark.createDataFrame([("r", "c1", "src/ui/a.ts"), ("r", "c1", "src/ui/b/c.ts"), ("r", "c2", "x.py"), ("r", "c2", "y/z.py")], "repo string, cluster_id string, file string")
    scopes = spark.createDataFrame([("r", "c2", "core", 1), ("r", "c1", "api", 1)], "repo string, cluster_id string, scope string, n long")
    assert {r.cluster_id: r.label for r in cochange.label(scopes, members).collect()} == {"c1": "ui", "c2": "x"}
    more = scopes.union(spark.createDataFrame([("r", "c1", "web", 3)], scopes.schema))
    assert {r.cluster_id: r.label for r in cochange.label(more, members).collect()}["c1"] == "web"


def test_coherence_and_siblings(spark):
    touches = spark.createDataFrame([("r", "s1", "a"), ("r", "s1", "z"), ("r", "s2", "a"), ("r", "s2", "c"), ("r", "s3", "z")], "repo string, sha string, file string")
    clusters = spark.createDataFrame([("r", "a", "k1"), ("r", "b", "k1"), ("r", "c", "k2")], "repo string, file string, cluster_id string")
    good = cochange.coherent(touches, clusters)
    assert [(r.sha, r.cluster_id) for r in good.collect()] == [("s1", "k1")]
    own = touches.join(good, ["repo", "sha"])
    assert [r.siblings for r in cochange.siblings(own, clusters).collect()] == [["b"]]


def test_siblings_match_a_loop(spark):
    rng = random.Random(3)
    members = [("r", f"f{k:03}", f"k{k % 3}") for k in range(120)] + [("r", "only", "k9")]
    places = {f: c for _, f, c in members}
    touched = [(f"s{j}", f"k{j % 3}", f"f{3 * k + j % 3:03}") for j in range(60) for k in rng.sample(range(40), rng.choice([1, 2, 39, 40]))]
    touched += [("t", "k9", "only"), ("u", "k1", "elsewhere"), ("v", "none", "f001")]
    clusters = spark.createDataFrame(members, "repo string, file string, cluster_id string")
    ranks = {(r.cluster_id, r.file): r._k for r in cochange.ranked_members(clusters).collect()}
    assert ranks == {(c, f): 1 + sorted(x for x in places if places[x] == c).index(f) for f, c in places.items()}
    got = {(r.sha, r.cluster_id): r.siblings for r in cochange.siblings(spark.createDataFrame(touched * 2, "sha string, cluster_id string, file string"), clusters).collect()}
    want = {}
    for sha, c, _ in touched:
        own = {f for s, _, f in touched if s == sha}
        if c in places.values():
            want[sha, c] = sorted(f for f, x in places.items() if x == c and f not in own)[:6]
    assert got == want


def test_commits_are_dealt_by_size(spark, tmp_path, monkeypatch):
    touches = spark.range(5000).selectExpr("'r' AS repo", "id % 700 AS sha", "id AS file")
    touches.write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    clusters = spark.range(5000).selectExpr("'r' AS repo", "id AS file", "'k' || least(id % 700, 3) AS cluster_id")
    few = staging.pieces(table)
    monkeypatch.setattr(staging, "PIECE", 1 << 10)
    assert staging.pieces(table) > few
    out = cochange.coherent(table, clusters)
    n = staging.pieces(table, clusters)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count(f", {n}), REPARTITION_BY_NUM") >= 3 or plan.count(f", {n})") >= 3
    assert {(r.sha, r.cluster_id) for r in out.collect()} == {(k, f"k{min(k, 3)}") for k in range(700)}


def test_leak_guard_reads_its_rows_once(spark):
    rows = spark.createDataFrame([("r", "s1", "k1", "a"), ("r", "s2", "k2", "a"), ("r", "s2", "k2", None), ("r", "s3", "k2", "b"), ("r", "s3", None, "c")], "repo string, sha string, cluster_id string, file string")
    held = spark.createDataFrame([("k1", True), ("k1", True), ("k2", False)], "cluster_id string, held_out boolean")
    out = nextedit.leak_guard(rows, rows.select("repo", "sha", "cluster_id"), held, rows.select("repo", "sha", "file"))
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, out.select("sha", "file", "split").collect()), key=repr) == sorted([("s1", "a", "eval"), ("s2", None, "train"), ("s3", "b", "train"), ("s3", "c", "train")], key=repr)


def test_holdout_is_disjoint(spark):
    df = spark.createDataFrame([(f"c{k % 30}",) for k in range(100)], "cluster_id string")
    rows = sampling.holdout_groups(df, "cluster_id", 0.1, 42).collect()
    assert sum(r.held_out for r in rows) == 3 and len(rows) == 30
    assert sum(r.held_out for r in sampling.holdout_groups(df.limit(5), "cluster_id", 0.1, 42).collect()) == 1


def test_corpus_order_of_rules(spark):
    body = "word " * 60
    rows = [(0, "a", body), (1, "a", body), (2, "a", "short"), (3, "a", body + "-----BEGIN RSA PRIVATE KEY-----"), (4, "a", body + "PASSWORD=abcdefgh1"), (5, "a", body + "PASSWORD=zyxwvuts2")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r.drop_reason for r in corpus.drop_reasons(df).collect()}
    assert got == {0: None, 1: "duplicate", 2: "too_short", 3: "private_key", 4: None, 5: "duplicate"}
    parts = corpus.chunks(spark.createDataFrame([(0, "x" * 450), (1, "")], "doc_id long, text string"), F.lit("p"), 200, 100).orderBy("doc_id", "chunk").collect()
    assert [(r.doc_id, r.chunk, len(r.text)) for r in parts] == [(0, 0, 200 + 15), (0, 1, 200 + 23), (1, 0, 15)]


def test_budget_sample_matches_a_loop(spark):
    rng = random.Random(12)
    rows = [(k, rng.choice([1, 2, 5, 30, 200, 999])) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, n long")
    key = sampling.shuffle_key(F.col("doc_id"), 42)
    order = [r.doc_id for r in df.orderBy(key).collect()]
    size = dict(rows)
    for budget in (0, 1, 37, 1500, 20_000, 10**7):
        want, used = set(), 0
        for k in order:
            if used + size[k] <= budget:
                want.add(k)
                used += size[k]
        assert {r.doc_id for r in corpus.budget_sample(df, budget, key, F.col("n")).collect()} == want


def test_cluster_document_and_row_zip(spark):
    members = spark.createDataFrame([("r", "r:0", "a"), ("r", "r:0", "b"), ("r", "r:1", "c"), ("r", "r:1", "d"), ("r", "r:1", "e")], "repo string, cluster_id string, file string")
    named = spark.createDataFrame([("r", "r:0", "x", 2, 0.5), ("r", "r:1", "y", 3, 0.4)], "repo string, cluster_id string, label string, n_files long, cohesion double")
    doc = cochange.clusters_document(members, named).first()
    assert [(c.cluster_id, c.files) for c in doc.clusters] == [("r:1", ["c", "d", "e"]), ("r:0", ["a", "b"])]
    left = spark.createDataFrame([(1, "p"), (2, "q")], "id long, r string")
    right = spark.createDataFrame([(2, True)], "id long, v boolean")
    assert {tuple(r) for r in metrics.zip_rows(left, right, "id").collect()} == {(1, "p", None), (2, "q", True)}


def test_batches_keep_every_row(spark):
    """Wide rows, many partitions and adaptive execution: no row is lost, whatever reads the numbered table how often."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = spark.range(60_000).select("id", F.repeat(F.md5(F.col("id").cast("string")), 16).alias("pad"))
        got = packing.with_batch(rows, "id").groupBy("_batch").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((r._batch, r.n, r.a, r.b) for r in got) == [(k, 1000, 1000 * k, 1000 * k + 999) for k in range(60)]


def test_repeated_keys_are_scored_by_row(spark):
    rows = spark.createDataFrame([(1, "a\nb\nb", "b\nb\nc"), (1, "x", "x"), (1, "", " \n"), (2, None, "y")], "k int, p string, g string")
    assert sorted(round(r.line_f1, 4) for r in metrics.line_f1(rows, "k", "p", "g").collect()) == [0.0, 0.6667, 1.0, 1.0]
