"""Tool-call wire formats: rendering, parsing, and re-encoding between them.

A format is a row of the registry: delimiters, a renderer and a parser, all column expressions. Arguments travel as JSON strings. Where the exact
bytes of Python's ``json.dumps`` matter (indentation, separators), an Arrow UDF writes them; everything else stays in the JVM.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import HEAD_CHARS, TAIL_CHARS, let, strip, truncate_head, truncate_head_tail

# Tool names of one client to the common ones; others are lower-cased.
TOOL_NAMES = {
    "Bash": "bash",
    "Read": "read",
    "Write": "write",
    "Edit": "edit",
    "Grep": "grep",
    "Glob": "glob",
    "Skill": "skill",
    "WebFetch": "webfetch",
    "WebSearch": "websearch",
    "TodoWrite": "todowrite",
    "Task": "task",
    "MultiEdit": "multi_edit",
    "NotebookEdit": "notebook_edit",
}
# The formats' patterns.
MARKER_NAME = r"\[TOOL_CALL\]([A-Za-z0-9_.\-]+)"
MARKER_BLOCK = r"(?s)\[TOOL_CALL\]([A-Za-z0-9_.\-]+)\s*(\{.*?\}|\".*?\")?\s*\[/TOOL_CALL\]"
XML_BLOCK = r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>"
LFM2_BLOCK = r"(?s)<\|tool_call_start\|>\s*(\[.*?\]|\{.*?\})\s*<\|tool_call_end\|>"
NATIVE_CALL = r"(?s)\[TOOL_CALL\]([A-Za-z0-9_.\-]+)\n(.*?)\[/TOOL_CALL\]"
THINKING_BLOCK = r"(?s)\[THINKING\](.*?)\[/THINKING\]"
RESULT_BLOCK = r"(?s)\[TOOL_RESULT\](.*?)\[/TOOL_RESULT\]"


def map_tool_name(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in TOOL_NAMES.items() for x in pair])
    return F.coalesce(F.element_at(table, name), F.lower(name))


@F.pandas_udf(T.StringType())
def pretty_json(raw: pd.Series) -> pd.Series:
    """A JSON text as json.dumps(..., indent=2) writes it; empty values are {}; invalid JSON is a string."""

    def one(x: str | None) -> str:
        try:
            value = json.loads(x) if x else None
        except ValueError:
            value = x
        return json.dumps(value, indent=2) if value else "{}"

    return raw.map(one)


@F.pandas_udf(T.ArrayType(T.StringType()))
def pretty_json_list(raws: pd.Series) -> pd.Series:
    """:func:`pretty_json` of each element; a null array stays null."""
    one = pretty_json.func
    return raws.map(lambda xs: None if xs is None else list(one(pd.Series(list(xs), dtype=object))))


def render_markers(name: Column, args_text: Column) -> Column:
    return F.concat(F.lit("\n[TOOL_CALL]"), name, F.lit("\n"), args_text, F.lit("[/TOOL_CALL]\n"))


def render_result(output: Column) -> Column:
    return F.concat(F.lit("[TOOL_RESULT]"), truncate_head(output), F.lit("[/TOOL_RESULT]"))


def _json_string(x: Column) -> Column:
    """A string as a JSON literal."""
    return F.regexp_extract(F.to_json(F.struct(x.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)


def render_xml(name: Column, args_text: Column) -> Column:
    return F.concat(F.lit('<tool_call>\n{"name": '), _json_string(name), F.lit(', "arguments": '), args_text, F.lit("}\n</tool_call>"))


def render_lfm2(name: Column, args_text: Column) -> Column:
    return F.concat(F.lit('<|tool_call_start|>[{"name": '), _json_string(name), F.lit(', "arguments": '), args_text, F.lit("}]<|tool_call_end|>"))


def _kind(raw: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(F.try_parse_json(raw)), r"^(\w+)", 1)


def unwrap_args(raw: Column) -> Column:
    """An argument blob as an object's JSON text: one layer of string encoding is taken off; anything else is null."""
    inner = F.when(_kind(raw) == "STRING", F.try_variant_get(F.try_parse_json(raw), "$", "string")).otherwise(raw)
    return F.when(_kind(inner) == "OBJECT", inner)


def _group(text: Column, pattern: str, k: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, k), F.lit(""))


def parse_markers(text: Column) -> Column:
    name = F.coalesce(_group(text, MARKER_BLOCK, 1), _group(text, MARKER_NAME, 1))
    return F.struct(name.alias("name"), unwrap_args(_group(text, MARKER_BLOCK, 2)).alias("args"))


def _payload(body: Column) -> Column:
    parsed = F.try_parse_json(body)
    args = F.try_variant_get(parsed, "$.arguments", "variant")
    is_object = F.regexp_extract(F.schema_of_variant(args), r"^(\w+)", 1) == "OBJECT"
    return F.struct(F.try_variant_get(parsed, "$.name", "string").alias("name"), F.when(is_object, F.to_json(args)).alias("args"))


def parse_xml(text: Column) -> Column:
    return _payload(_group(text, XML_BLOCK, 1))


def parse_lfm2(text: Column) -> Column:
    body = _group(text, LFM2_BLOCK, 1)
    first = F.to_json(F.try_variant_get(F.try_parse_json(body), "$[0]", "variant"))
    return _payload(F.when(F.startswith(body, F.lit("[")), first).otherwise(body))


@dataclass(frozen=True)
class Format:
    name: str
    render: Callable[[Column, Column], Column]
    parse: Callable[[Column], Column]
    block: str
    stop: str
    skip_special: bool
    result_role: str = "tool"


FORMATS = {
    f.name: f
    for f in (
        Format("markers", render_markers, parse_markers, MARKER_BLOCK, "[/TOOL_CALL]", True),
        Format("xml_tool_call", render_xml, parse_xml, XML_BLOCK, "</tool_call>", False),
        Format("lfm2", render_lfm2, parse_lfm2, LFM2_BLOCK, "<|tool_call_end|>", False),
    )
}
#: Target names to formats.
TARGETS = {"markers": "markers", "minicpm5": "xml_tool_call", "qwen": "xml_tool_call", "lfm2": "lfm2"}


# Models whose template was looked at, and their targets.
MODEL_TARGETS = {
    "openbmb/MiniCPM5-1B": "minicpm5",
    "katanemo/Plano-Orchestrator-4B": "qwen",
    "katanemo/Arch-Agent-7B": "qwen",
    "ornith-ai/Ornith-1.0-9B": "qwen",
    "Dingdust/LFM2.5-2.6B-heretic": "lfm2",
    "Youssofal/Qwen3.6-35B-A3B-Abliterated-Heretic-BF16": "qwen",
}


def format_for(target: str) -> Format:
    """The format of a target; an unknown one is a KeyError, never a guess."""
    return FORMATS[TARGETS[target]]


def for_model(model: str) -> Format | None:
    """The format that a base model was checked to expect, or None: an unchecked model has no default."""
    target = MODEL_TARGETS.get(model)
    return FORMATS[TARGETS[target]] if target else None


def format_valid(text: Column, fmt: Format) -> Column:
    return text.rlike(fmt.block)


def gate(rows: DataFrame, text: str, fmt: Format) -> DataFrame:
    """``rows``, if any of their texts holds a call in the format: if none does, texts and format disagree and the job fails when it runs. No rows pass."""
    found = rows.agg(F.coalesce(F.max(format_valid(F.col(text), fmt)), F.count("*") == 0).alias("_found"))
    checked = found.select(F.when(F.col("_found"), True).otherwise(F.raise_error(F.lit(f"no text holds a call in the format {fmt.name}"))).alias("_ok"))
    return rows.join(F.broadcast(checked), F.col("_ok")).drop("_ok")  # one row


@F.pandas_udf(T.StringType())
def spaced_json(raws: pd.Series) -> pd.Series:
    """A JSON text on one line, as json.dumps(..., ensure_ascii=False) writes it."""
    return raws.map(lambda x: None if x is None else json.dumps(json.loads(x), ensure_ascii=False))


@F.pandas_udf(T.ArrayType(T.StringType()))
def spaced_json_list(raws: pd.Series) -> pd.Series:
    """Each JSON text of an array on one line, as json.dumps(..., ensure_ascii=False) writes it; nulls stay."""
    one = lambda x: None if x is None else json.dumps(json.loads(x), ensure_ascii=False)
    return raws.map(lambda xs: None if xs is None else [one(x) for x in xs])


def _call_args(raw: Column) -> Column:
    """A struct of args (an object as JSON text, null if ``raw`` isn't JSON), double (a layer of string encoding was taken off) and wrapped (it was no object)."""

    def judge(x: Column) -> Column:
        inside = F.when(_kind(x) == "STRING", F.try_variant_get(F.try_parse_json(x), "$", "string"))
        double = F.coalesce(_kind(inside) == "OBJECT", F.lit(False))
        wrapped = ~double & F.coalesce(_kind(x) != "OBJECT", F.lit(False))
        args = F.when(double, inside).when(wrapped, F.concat(F.lit('{"input": '), x, F.lit("}"))).otherwise(x)
        return F.struct(F.when(_kind(x).isNotNull(), args).alias("args"), double.alias("double"), wrapped.alias("wrapped"))

    return let(F.coalesce(F.nullif(strip(raw), F.lit("")), F.lit("{}")), judge)


def reencode_native(text: Column) -> Column:
    """Marker text to the XML form: a struct of text, n_calls, n_double, n_non_dict and error.

    The text between the calls stays; of each call, name and arguments are read by array functions and put back in its place. A call whose arguments
    aren't JSON makes error non-null and text null; the counts are of all calls.
    """
    # The reluctant body keeps its surrounding white space; stripping it is part of the rewrite.
    thought = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?sU)\[THINKING\]\s*((?:(?!\[/THINKING\]).)*?)\s*\[/THINKING\]", "<think>\n$1\n</think>")
    between = F.split(thought, NATIVE_CALL)
    names = F.regexp_extract_all(thought, F.lit(NATIVE_CALL), 1)
    calls = F.transform(F.regexp_extract_all(thought, F.lit(NATIVE_CALL), 2), _call_args)
    spaced = spaced_json_list(F.transform(calls, lambda c: c["args"]))
    blocks = F.zip_with(names, spaced, lambda n, c: render_xml(n, F.coalesce(c, F.lit(""))))
    whole = strip(F.array_join(F.zip_with(between, blocks, lambda t, c: F.concat(t, F.coalesce(c, F.lit("")))), ""))
    unread = F.get(F.filter(F.zip_with(names, calls, lambda n, c: F.when(c["args"].isNull(), n)), lambda n: n.isNotNull()), F.lit(0))
    count = lambda flag: F.size(F.filter(calls, lambda c: c[flag])).cast("long")
    return F.struct(
        F.when(unread.isNull(), whole).alias("text"),
        F.size(names).cast("long").alias("n_calls"),
        count("double").alias("n_double"),
        count("wrapped").alias("n_non_dict"),
        F.concat(F.lit("tool "), unread, F.lit(": the arguments aren't JSON")).alias("error"),
    )


def truncate_json_like(rows: DataFrame, column: str, head: int = HEAD_CHARS, tail: int = TAIL_CHARS) -> Column:
    """A payload of any type of ``rows`` as a truncated text: strings as they are, structures as JSON, what JSON has no form for as its plain text; null stays."""
    kind, value = rows.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        value = spaced_json(F.to_json(value))
    elif not isinstance(kind, T.StringType):
        value = value.cast("string")
    return truncate_head_tail(value, head, tail)


def unwrap_result(text: Column) -> Column:
    return strip(F.regexp_replace(text, RESULT_BLOCK, "$1"))


def first_call_name(text: Column) -> Column:
    """The name in the first native call of a converted turn."""
    body = F.split_part(F.regexp_extract(text, r"(?s)<tool_call>(.*)$", 1), F.lit("</tool_call>"), F.lit(1))
    return F.try_variant_get(F.try_parse_json(body), "$.name", "string")
