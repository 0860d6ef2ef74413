"""Text and codec expressions on inline rows."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import codecs
from millrace.functions import text as X


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression.alias("y")).first()["y"]


SECRETS = [
    ("key sk-" + "a1" * 10, "key sk-REDACTED"),
    ("ghp_" + "b" * 22, "ghp_REDACTED"),
    ("gho_" + "b" * 22, "gho_REDACTED"),
    ("glpat-" + "c_" * 9, "glpat-REDACTED"),
    ("rpa_" + "d" * 21, "rpa_REDACTED"),
    ("AKIA" + "Z9" * 8, "AKIA_REDACTED"),
    ("AIza" + "e" * 35, "AIza_REDACTED"),
    ("xoxb-" + "1-" * 6, "xoxb-REDACTED"),
    ("ey" + "A" * 12 + "." + "B" * 12 + "." + "C" * 12, "JWT_REDACTED"),
    ("MY_TOKEN = 'abcdefgh1'", "MY_TOKEN=REDACTED'"),
    ("https://bob:pw@host/x", "https://REDACTED:REDACTED@host/x"),
    ("see ~/keys/a.pem now", "see REDACTED.pem now"),
]


@pytest.mark.parametrize("text,clean", SECRETS)
def test_each_redaction_rule(spark, text, clean):
    assert one(spark, text, X.scrub("x")) == clean
    assert one(spark, text, X.count_redactions("x")) == 1


def test_a_value_rewritten_by_two_rules_counts_twice(spark):
    text = "API_KEY=sk-" + "a" * 20
    assert one(spark, text, X.count_redactions("x")) == 2
    assert one(spark, text, X.scrub("x")) == "API_KEY=REDACTED"
    assert one(spark, "plain words only", X.count_redactions("x")) == 0


def test_private_keys_and_residues(spark):
    assert one(spark, "-----BEGIN RSA PRIVATE KEY-----", F.col("x").rlike(X.FATAL_SECRET))
    assert not one(spark, "a clean text", F.col("x").rlike(X.RESIDUAL_SECRET))


def test_truncation_bounds(spark):
    assert one(spark, "x" * 3064, X.truncate_head_tail("x")) == "x" * 3064
    long = "a" * 2000 + "b" * 9999 + "c" * 1000
    assert one(spark, long, X.truncate_head_tail("x")) == "a" * 2000 + "\n... [9,999 chars elided] ...\n" + "c" * 1000
    assert one(spark, long, X.elided_chars("x")) == 9999
    assert one(spark, None, X.truncate_head("x")) == ""
    assert one(spark, "y" * 2001, X.truncate_head("x")) == "y" * 2000 + "\n... [truncated, 2001 total chars]"


def test_lines_and_normalising(spark):
    for text in ("", "a", "a\n", "a\n\nb", "a\r\nb\rc", "\n", "a\x0bb c"):
        assert one(spark, text, X.lines_of("x")) == text.splitlines()
    assert one(spark, "  a  \n b \n\n>>>>>>> UPDATED tail", X.normalise_prediction("x")) == "a\n b"
    assert one(spark, "abc<e>def<s>", X.cut_at_stops("x", ["<s>", "<e>"])) == "abc"


def test_names_and_registry():
    assert codecs.format_for("qwen").name == "xml_tool_call"
    with pytest.raises(KeyError):
        codecs.format_for("unknown")


CALLS = [
    ("markers", '[TOOL_CALL]read\n{"a": 1}[/TOOL_CALL]', "read", {"a": 1}),
    ("markers", '[TOOL_CALL]ctx_query-docs.v2\n"{\\"a\\": \\"b\\"}"[/TOOL_CALL]', "ctx_query-docs.v2", {"a": "b"}),
    ("markers", "[TOOL_CALL]bash", "bash", None),
    ("markers", "[TOOL_CALL]bash\n{bad}[/TOOL_CALL]", "bash", None),
    ("markers", "prose only", None, None),
    ("markers", "", None, None),
    ("xml_tool_call", '<tool_call>\n{"name": "x", "arguments": {"k": [1, 2]}}\n</tool_call>', "x", {"k": [1, 2]}),
    ("xml_tool_call", '<tool_call>{"name": "x", "arguments": "no"}</tool_call>', "x", None),
    ("xml_tool_call", '<tool_call>{"name": "x"', None, None),
    ("lfm2", '<|tool_call_start|>[{"name": "x", "arguments": {"k": 1}}, {"name": "y"}]<|tool_call_end|>', "x", {"k": 1}),
    ("lfm2", '<|tool_call_start|>{"name": "z", "arguments": {}}<|tool_call_end|>', "z", {}),
    ("lfm2", "<|tool_call_start|>[]<|tool_call_end|>", None, None),
]


@pytest.mark.parametrize("fmt,text,name,args", CALLS)
def test_parsing(spark, fmt, text, name, args):
    got = one(spark, text, codecs.FORMATS[fmt].parse(F.col("x")))
    assert got["name"] == name
    assert (json.loads(got["args"]) if got["args"] is not None else None) == args


def test_reencoding(spark):
    text = '[THINKING] why [/THINKING]\n[TOOL_CALL]a.b-c\n{"x": "é"}[/TOOL_CALL]\n and [TOOL_CALL]d\n"{\\"y\\": 2}"[/TOOL_CALL] [TOOL_CALL]e\n[1][/TOOL_CALL]\n'
    got = one(spark, text, codecs.reencode_native(F.col("x")))
    assert got["text"].startswith('<think>\nwhy\n</think>\n<tool_call>\n{"name": "a.b-c", "arguments": {"x": "é"}}\n</tool_call>\n and ')
    assert '{"name": "e", "arguments": {"input": [1]}}' in got["text"]
    assert (got["n_calls"], got["n_double"], got["n_non_dict"], got["error"]) == (3, 1, 1, None)
    assert one(spark, "[TOOL_CALL]f\n{oops[/TOOL_CALL]", codecs.reencode_native(F.col("x")))["error"].startswith("tool f: ")
    assert one(spark, got["text"], codecs.first_call_name(F.col("x"))) == "a.b-c"


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.text("abcd", min_size=1, max_size=4), st.one_of(st.integers(0, 99), st.text("xyzäö 0", max_size=8)), max_size=3))
def test_roundtrip_is_the_identity(spark, args):
    for f in codecs.FORMATS.values():
        text = one(spark, json.dumps(args, ensure_ascii=False), f.render(F.lit("tool"), F.col("x")))
        got = one(spark, text, f.parse(F.col("x")))
        assert (got["name"], json.loads(got["args"])) == ("tool", args)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([t for t, _ in SECRETS] + ["plain words", "x = 1", "\n"]), max_size=6))
def test_scrubbing_twice_changes_nothing(spark, parts):
    once = one(spark, " ".join(parts), X.scrub("x"))
    assert one(spark, once, X.scrub("x")) == once
    assert not one(spark, once, F.col("x").rlike(X.RESIDUAL_SECRET))


def test_white_space_is_that_of_python(spark):
    every = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    assert set(X.WHITE) == set(every)
    assert one(spark, every + "a b" + every, X.strip(F.col("x"))) == "a b"


def test_the_gate_fails(spark):
    rows = spark.createDataFrame([("plain",)], "t string")
    with pytest.raises(Exception, match="no text holds a call"):
        codecs.gate(rows, "t", codecs.FORMATS["lfm2"]).collect()
    assert codecs.gate(rows.limit(0), "t", codecs.FORMATS["lfm2"]).collect() == []
    assert codecs.for_model("katanemo/Arch-Agent-7B").name == "xml_tool_call" and codecs.for_model("other") is None
