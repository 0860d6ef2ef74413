"""Sources on small files: JSON lines, session logs, SQLite, git."""

import json
import sqlite3
import subprocess

from millrace.operators import commits, nextedit
from millrace.sources import gitlog, jsonl, sessions, sqlite


def write(path, rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    return str(path)


def turns_of(df, key="file"):
    return sorted(df.collect(), key=lambda r: (r[key], r.pos))


def test_json_lines(spark, tmp_path):
    write(tmp_path / "a.jsonl", [{"a": 1}, "", "{bad", {"b": [1]}])
    got = jsonl.read_json_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [r.line_no for r in got] == [0, 3]


def test_transcripts(spark, tmp_path):
    write(
        tmp_path / "t.jsonl",
        [
            {"type": "user", "content": "hello"},
            {"type": "assistant", "content": [{"type": "thinking", "thinking": "hm"}, {"type": "text", "text": "hi"}, {"type": "tool_use", "id": "1", "name": "MultiEdit", "input": {"p": 1}}, {"type": "odd"}]},
            {"type": "user", "content": [{"type": "text", "text": "a"}, {"type": "tool_result", "tool_use_id": "1", "content": [{"text": "r1"}, {"text": "r2"}]}, {"type": "text", "text": "b"}]},
            {"type": "assistant", "content": "a bare string is dropped"},
            {"type": "assistant", "content": [{"type": "odd"}]},
            {"type": "assistant", "content": [{"type": "tool_use", "name": "CustomTool"}]},
        ],
    )
    got = turns_of(sessions.transcript_turns(jsonl.read_json_lines(spark, str(tmp_path))))
    assert [r.role for r in got] == ["user", "assistant", "tool_result", "user", "assistant"]
    assert [p.type for p in got[1].parts] == ["thinking", "text", "tool_call"] and got[1].parts[2].name == "multi_edit" and json.loads(got[1].parts[2].input) == {"p": 1}
    assert (got[2].text, got[2].tool_use_id, got[3].text) == ("r1\nr2", "1", "a\nb")
    assert (got[4].parts[0].name, got[4].parts[0].input) == ("customtool", "{}")


def test_project_files(spark, tmp_path):
    rows = [
        {"type": "user", "cwd": "/a", "sessionId": "S", "message": {"content": "x"}},
        {"type": "assistant", "message": {"model": "m", "content": [{"type": "text", "text": "y"}]}},
        {"type": "user", "message": {"content": "z"}},
    ]
    write(tmp_path / "p.jsonl", rows)
    write(tmp_path / "q.jsonl", [{"type": "user", "message": {"content": "only"}}])
    lines = jsonl.read_json_lines(spark, str(tmp_path))
    got = [r for r in turns_of(sessions.transcript_turns(lines, nested=True)) if r.file.endswith("p.jsonl")]
    assert [(r.role, r.model) for r in got] == [("user", None), ("assistant", "m"), ("user", None)]
    meta = {r.session_id: r.directory for r in sessions.project_sessions(lines).collect()}
    assert meta == {"S": "/a", "q": None}


def item(kind, **payload):
    return {"type": kind, "payload": payload}


def test_rollouts(spark, tmp_path):
    write(
        tmp_path / "rollout-1.jsonl",
        [
            item("session_meta", id="R", cwd="/w", originator="cli", git={"commit_hash": "c", "branch": "b"}),
            item("turn_context", model="m1"),
            item("turn_context", model="m2"),
            item("response_item", type="message", role="user", content=[{"text": "do"}, {"text": ""}, "it"]),
            item("event_msg", type="message", role="user", content="dropped"),
            item("response_item", type="reasoning", summary=[{"text": "why"}]),
            item("response_item", type="function_call", name="sh", call_id="1", arguments="{}"),
            item("response_item", type="message", role="assistant", content="working"),
            item("response_item", type="message", role="user", content="next"),
            item("response_item", type="function_call_output", call_id="1", output="late"),
            item("response_item", type="function_call_output", call_id="1", output="again"),
            item("response_item", type="custom_tool_call", name="p", call_id="2", input="y" * 4000),
        ],
    )
    lines = jsonl.read_json_lines(spark, str(tmp_path), glob="rollout-*.jsonl")
    meta = sessions.rollout_sessions(lines).first()
    assert (meta.session_id, meta.model, meta.agent, meta.directory, meta.git_commit, meta.git_branch) == ("R", "m1", "cli", "/w", "c", "b")
    got = turns_of(sessions.rollout_turns(lines))
    assert [r.role for r in got] == ["user", "assistant", "user", "assistant"] and got[0].text == "do\nit"
    assert [(p.type, p.name, p.output) for p in got[1].parts] == [("tool_call", "sh", "late"), ("text", None, None)]
    assert [(p.name, p.output) for p in got[3].parts] == [(None, "again"), ("p", None)] and got[3].chars_elided == 1000
    assert [p.type for p in turns_of(sessions.rollout_turns(lines, keep_reasoning=True))[1].parts] == ["reasoning", "tool_call", "text"]
    assert len(sessions.conversations(sessions.rollout_turns(lines), "file", 2).first().turns) == 4


def database(path):
    con = sqlite3.connect(path)
    con.executescript(
        "CREATE TABLE message(id TEXT, session_id TEXT, time_created INT, data TEXT); CREATE TABLE part(id TEXT, session_id TEXT, message_id TEXT, time_created INT, data TEXT);"
        "CREATE TABLE session_v2(id TEXT, title TEXT, model TEXT, agent TEXT, project_id TEXT, directory TEXT); CREATE TABLE session_message(session_id TEXT, id TEXT, type TEXT, seq INT, data TEXT, time_created INT);"
    )
    j = json.dumps
    con.executemany("INSERT INTO message VALUES(?,?,?,?)", [("m1", "s", 1, j({"role": "user"})), ("m2", "s", 2, j({"role": "assistant"})), ("m3", "s", 3, "{bad"), ("m4", "s", 4, j({"role": "assistant"})), ("m5", "t", 1, j({"role": "user"}))])
    parts = [("p1", "m1", {"type": "text", "text": "one"}), ("p2", "m1", {"type": "text", "text": "two"}), ("p3", "m2", {"type": "step-start"}), ("p4", "m2", {"type": "tool", "tool": "sh", "state": {"input": {"c": 1}, "output": "o" * 4000, "status": "done"}}), ("p5", "m2", {"type": "patch", "hash": "h"}), ("p6", "m2", {"type": "text", "text": ""})]
    con.executemany("INSERT INTO part VALUES(?,?,?,?,?)", [(a, "s", m, k, j(d)) for k, (a, m, d) in enumerate(parts)] + [("p9", "s", "m2", 9, "{bad")])
    con.executemany("INSERT INTO session_v2 VALUES(?,?,?,?,?,?)", [("v", "t", "m", "a", "p", "/d")])
    v2 = [("v", "1", "user", 1, {"text": "q"}), ("v", "2", "assistant", 2, {"content": [{"type": "text", "text": "r"}, {"type": "tool", "name": "n", "state": {"input": {"x": 2}, "content": [{"type": "text", "text": "o1"}, {"type": "text", "text": "o2"}], "status": "ok"}}]}), ("v", "3", "summary", 3, {"s": 1}), ("w", "4", "user", 1, {"text": "unknown session"})]
    con.executemany("INSERT INTO session_message VALUES(?,?,?,?,?,?)", [(*r[:4], j(r[4]), 0) for r in v2])
    con.commit()
    con.close()


def test_session_database(spark, tmp_path):
    path = str(tmp_path / "s.db")
    database(path)
    messages = sqlite.read_sqlite(spark, path, "message", "id string, session_id string, time_created long, data string", "session_id", 3)
    parts = sqlite.read_sqlite(spark, path, "part", "id string, session_id string, message_id string, time_created long, data string", "session_id", 2)
    assert messages.count() == 5 and parts.count() == 7
    got = turns_of(sessions.database_turns(messages, parts, min_messages=2), "session_id")
    assert [(r.role, r.text) for r in got] == [("user", "one\ntwo"), ("assistant", None)]
    call, patch = got[1].parts
    assert (call.name, json.loads(call.input), call.status, patch.type, patch.text, got[1].chars_elided) == ("sh", {"c": 1}, "done", "patch", "h", 1000)
    old = turns_of(sessions.database_turns(messages, parts, join_all_text=False, truncate=False), "session_id")
    assert old[0].text == "one" and [p.type for p in old[1].parts] == ["tool_call", "text"] and len(old[1].parts[0].output) == 4000
    heads = sqlite.read_sqlite(spark, path, "session_v2", "id string, title string")
    events = sqlite.read_sqlite(spark, path, "session_message", "session_id string, id string, type string, seq long, data string")
    new = turns_of(sessions.event_turns(heads, events), "session_id")
    assert [r.role for r in new] == ["user", "assistant", "summary"] and new[1].parts[1].output == "o1\no2" and json.loads(new[2].text) == {"s": 1}


def test_git(spark, tmp_path):
    repo = tmp_path / "work" / "one"
    repo.mkdir(parents=True)
    git = lambda *a: subprocess.run(["git", "-c", "user.name=n", "-c", "user.email=e@example.com", *a], cwd=repo, check=True, capture_output=True)
    git("init", "-q")
    (repo / "a.py").write_text("x = 1\n")
    git("add", "."), git("commit", "-qm", "feat(core): first")
    (repo / "a.py").write_text("x = 2\n")
    (repo / "b.py").write_text("y = 1\n")
    git("add", "."), git("commit", "-qm", "fix: second")
    repos = gitlog.repo_table(spark, gitlog.find_repos([str(tmp_path)]))
    log = commits.parse_log(gitlog.log_lines(repos), gitlog.tracked_files(repos).select("repo", "path"))
    rows = {r.subject: r for r in log.collect()}
    assert rows["fix: second"].files == ["a.py", "b.py"] and rows["feat(core): first"].files == ["a.py"]
    touched = log.where("subject = 'fix: second'").selectExpr("repo", "sha", "explode(files) as path")
    hunks = sorted(nextedit.parse_hunks(gitlog.diffs(touched), ["repo", "sha", "path"]).collect(), key=lambda r: r.path)
    assert [(r.path, r.pre, r.post) for r in hunks] == [("a.py", ["x = 1"], ["x = 2"]), ("b.py", [], ["y = 1"])]


def test_mix_and_text_files(spark, tmp_path):
    a = write(tmp_path / "a.jsonl", [{"text": "plain"}])
    b = write(tmp_path / "b.jsonl", [{"messages": [{"role": "user", "content": "q"}]}])
    assert {r.text for r in jsonl.mix(spark, f"{a},{b}").collect()} == {"plain", "<|im_start|>user\nq<|im_end|>\n"}
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "x.md").write_bytes(b"ok \xff end")
    assert jsonl.read_text_files(spark, str(tmp_path / "docs"), "*.md").first().text == "ok � end"
    assert jsonl.read_text_files(spark, str(tmp_path / "docs"), "*.md", drop_bad_bytes=True).first().text == "ok  end"


def test_faulty_files_drop_whole(spark, tmp_path):
    write(tmp_path / "a.jsonl", [{"v": 1}, {"v": "bad"}])
    write(tmp_path / "b.jsonl", [{"v": 2}])
    lines = jsonl.read_json_lines(spark, str(tmp_path))
    got = jsonl.sound_files(lines, sessions.kind_of(sessions.F.try_variant_get("data", "$.v", "variant")) == "STRING").collect()
    assert [r.line for r in got] == ['{"v": 2}']


def test_bundles_hold_many_files(spark, tmp_path):
    lines = [(f"d/{k % 300}.jsonl", k // 300, x) for k, x in enumerate(['{"k": 1}', "", " a\x1fb", None, "{broken"] * 240)]
    jsonl.write_bundles(spark.createDataFrame(lines, "name string, at long, line string"), str(tmp_path / "b"), "name", "at")
    assert len(list((tmp_path / "b").glob("part-*"))) < 20  # not one for each of 300 files
    out = jsonl.read_bundles(spark, str(tmp_path / "b"))
    assert sorted(map(tuple, out.select("file", "line_no", "line").collect())) == sorted((f, n, x or "") for f, n, x in lines)
    assert {r.line for r in jsonl.json_of(out).collect()} == {'{"k": 1}'}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "train", None), ("b", "eval", "x")], "text string, split string, note string")
    jsonl.write_json_lines(df, str(tmp_path / "all"))
    assert sorted(json.loads(r.value)["text"] for r in spark.read.text(str(tmp_path / "all")).collect()) == ["a", "b"]
    jsonl.write_split(df, str(tmp_path / "split"))
    assert [json.loads(r.value) for r in spark.read.text(str(tmp_path / "split" / "split=eval")).collect()] == [{"text": "b", "note": "x"}]
