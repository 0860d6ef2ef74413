"""The chains of operators, end to end on small inputs."""

import json
import subprocess

from pyspark.sql import functions as F

from millrace.operators import conversion
from millrace.plans import pipelines
from millrace.sources import jsonl, sessions

MSG = "id long, messages array<struct<role:string,content:string>>"


def test_conversion_of_examples(spark):
    good = [("system", " a "), ("system", ""), ("system", "b"), ("user", "q"), ("assistant", '[TOOL_CALL]x-y\n"{\\"k\\": 1}"[/TOOL_CALL]'), ("tool", "[TOOL_RESULT] r [/TOOL_RESULT]"), ("assistant", "")]
    bad = [("user", "q"), ("assistant", "[TOOL_CALL]x\n{[/TOOL_CALL]")]
    df = spark.createDataFrame([(1, good), (2, bad)], MSG)
    rows = {r.id: r for r in conversion.convert_examples(df, "id").collect()}
    assert [tuple(m) for m in rows[1].messages] == [("system", "a\n\nb"), ("user", "q"), ("assistant", '<tool_call>\n{"name": "x-y", "arguments": {"k": 1}}\n</tool_call>'), ("tool", "r")]
    assert (rows[1].n_calls, rows[1].n_double, rows[1].drop_reason) == (1, 1, None) and rows[2].drop_reason.startswith("tool x: ")
    assert [r.n for r in conversion.reasons(conversion.convert_examples(df, "id")).collect()] == [1]
    ev = df.where("id = 1").withColumn("target", F.lit("[TOOL_CALL]q-docs\n{}[/TOOL_CALL]")).withColumn("tool", F.lit("q"))
    got = conversion.convert_examples(ev, "id", "target", "tool").first()
    assert got.tool == "q-docs" and got.target.startswith("<tool_call>")


def test_transcripts_to_native_examples(spark, tmp_path):
    rows = [
        {"type": "user", "content": "fix it"},
        {"type": "assistant", "content": [{"type": "thinking", "thinking": " hm "}, {"type": "text", "text": "ok"}, {"type": "tool_use", "name": "Bash", "input": {"c": "ls"}}]},
        {"type": "user", "content": [{"type": "tool_result", "content": "out"}]},
    ]
    (tmp_path / "a.jsonl").write_text("\n".join(map(json.dumps, rows)))
    turns = sessions.transcript_turns(jsonl.read_json_lines(spark, str(tmp_path)))
    out = pipelines.agentic_sft(turns, "file", "pos").withColumn("id", F.monotonically_increasing_id())
    assert [m.content for m in out.first().messages][2] == '[THINKING]hm[/THINKING]\nok\n\n[TOOL_CALL]bash\n{\n  "c": "ls"\n}[/TOOL_CALL]\n'
    native = pipelines.native_sft(out, "id").first()
    assert [m.role for m in native.messages] == ["system", "user", "assistant", "tool"]
    assert native.messages[2].content.endswith('<tool_call>\n{"name": "bash", "arguments": {"c": "ls"}}\n</tool_call>') and native.messages[3].content == "out"
    nested, stats = pipelines.conversations_with_counts(turns, "file", 2)
    assert nested.count() == 1 and {r.role: r.tool_calls for r in stats.collect()}["assistant"] == 1


def test_next_edits_from_git(spark, tmp_path):
    repo = tmp_path / "one"
    repo.mkdir()
    git = lambda *a: subprocess.run(["git", "-c", "user.name=n", "-c", "user.email=e@example.com", *a], cwd=repo, check=True, capture_output=True)
    git("init", "-q")
    for k in range(6):
        for group in ("ab", "cd") if k % 2 else ("ab",):
            for f in group:
                (repo / f"{f}.py").write_text(f"x = {k}\n")
            git("add", "."), git("commit", "-qm", f"feat(core): step {k} {group}")
    out = pipelines.next_edits(spark, [str(tmp_path)], min_pair=2).collect()
    assert {r.split for r in out} == {"train", "eval"} and {r.path for r in out} == {"b.py", "d.py"}
    train, held = ({r.path for r in out if r.split == s} for s in ("train", "eval"))
    assert not train & held and all("### Edits already made" in r.prompt and r.completion.endswith(">>>>>>> UPDATED") for r in out)


def test_markdown_and_fim(spark, tmp_path):
    (tmp_path / "node_modules").mkdir()
    (tmp_path / "a.md").write_text("word " * 100 + "API_KEY=abcdefgh12")
    (tmp_path / "b.md").write_text("word " * 100 + "API_KEY=zzzzzzzz12")
    (tmp_path / "node_modules" / "c.md").write_text("other " * 100)
    got = pipelines.markdown_corpus(spark, str(tmp_path), budget_millions=1).collect()
    assert len(got) == 1 and "API_KEY=REDACTED" in got[0].text and got[0].text.startswith("# Document: ")
    files = spark.createDataFrame([("src/a.py", "\n".join(f"line {k}" for k in range(9))), ("build/a.py", "\n".join(f"line {k}" for k in range(9)))], "path string, text string")
    made = pipelines.fim_formats(files).collect()
    assert {r.format for r in made} == {"qwen", "starcoder"} and len(made) == 6 and {r.language for r in made} == {"py"}
