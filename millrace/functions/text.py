"""Text expressions: stripping, truncation, token estimates, redaction and prediction normalising. All are built-in column functions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Head and tail kept of a long tool output, and the slack below which nothing is cut.
HEAD_CHARS = 2000
TAIL_CHARS = 1000
SLACK_CHARS = 64
MAX_TOOL_OUTPUT = 2000
CHARS_PER_TOKEN = 4
CORPUS_CHARS_PER_TOKEN = 3.6
TERMINATOR = ">>>>>>> UPDATED"

#: What counts as white space: the characters of Unicode's White_Space and the four information separators.
WHITE = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# Pattern and replacement of each redaction rule, in the order in which they apply.
REDACTION_RULES = [
    (r"\b(sk-[A-Za-z0-9]{16,})", "sk-REDACTED"),
    (r"\b(ghp_[A-Za-z0-9]{20,})", "ghp_REDACTED"),
    (r"\b(gho_[A-Za-z0-9]{20,})", "gho_REDACTED"),
    (r"\b(glpat-[A-Za-z0-9_-]{16,})", "glpat-REDACTED"),
    (r"\b(rpa_[A-Za-z0-9]{20,})", "rpa_REDACTED"),
    (r"\b(AKIA[0-9A-Z]{16})", "AKIA_REDACTED"),
    (r"\b(AIza[0-9A-Za-z_-]{35})", "AIza_REDACTED"),
    (r"\b(xox[baprs]-[A-Za-z0-9-]{10,})", "xoxb-REDACTED"),
    (r"\bey[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", "JWT_REDACTED"),
    (r"(?i)\b([A-Z0-9_]*(?:TOKEN|SECRET|PASSWORD|PASSWD|APIKEY|API_KEY)[A-Z0-9_]*)\s*[=:]\s*['\"]?([^\s'\"&#]{8,})", r"$1=REDACTED"),
    (r"(https?://)([^/\s:@]+):([^/\s@]+)@", r"$1REDACTED:REDACTED@"),
    (r"[\w./~-]+\.pem\b", "REDACTED.pem"),
]
#: What each rule's matches hold; the rule of keys and values has several, in lower case.
RULE_PARTS = ("sk-", "ghp_", "gho_", "glpat-", "rpa_", "AKIA", "AIza", "xox", "ey", "", "://", ".pem")
KEY_VALUE_RULE, KEY_VALUE_PARTS = 9, ("token", "secret", "password", "passwd", "apikey", "api_key")
# A text that matches is dropped whole; a scrubbed text that still matches fails the gate.
FATAL_SECRET = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
RESIDUAL_SECRET = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----|\bsk-[A-Za-z0-9]{16,}|\bghp_[A-Za-z0-9]{20,}|\bAKIA[0-9A-Z]{16}|\bAIza[0-9A-Za-z_-]{35}|"
    r"\bglpat-[A-Za-z0-9_-]{16,}|\brpa_[A-Za-z0-9]{20,}|\bxox[baprs]-[A-Za-z0-9-]{10,}"
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column | str) -> Column:
    """White space off both ends, not just spaces."""
    return F.btrim(col(c), F.lit(WHITE))


def strip_end(c: Column | str) -> Column:
    return F.rtrim(col(c), F.lit(WHITE))


def is_blank(c: Column | str) -> Column:
    return strip(c) == ""


def lines_of(c: Column | str) -> Column:
    """Lines without their ends; a final line end opens no further line, and an empty text has no lines."""
    parts = F.split(col(c), r"\r\n|[\n\r\u000B\u000C\u001C-\u001E\u0085\u2028\u2029]")
    return let(parts, lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p))


def truncate_head_tail(c: Column | str, head: int = HEAD_CHARS, tail: int = TAIL_CHARS) -> Column:
    """A long text's head and tail with a note of what was cut; shorter ones unchanged."""
    text = col(c)
    note = F.concat(F.lit("\n... ["), F.format_number(elided_chars(text, head, tail), 0), F.lit(" chars elided] ...\n"))
    return F.when(F.length(text) <= head + tail + SLACK_CHARS, text).otherwise(F.concat(F.left(text, F.lit(head)), note, F.right(text, F.lit(tail))))


def elided_chars(c: Column | str, head: int = HEAD_CHARS, tail: int = TAIL_CHARS) -> Column:
    text = col(c)
    return F.when(F.length(text) > head + tail + SLACK_CHARS, F.length(text) - head - tail).otherwise(0).cast("long")


def truncate_head(c: Column | str, most: int = MAX_TOOL_OUTPUT) -> Column:
    """The first ``most`` characters and the total; null becomes empty."""
    text = F.coalesce(col(c), F.lit(""))
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.left(text, F.lit(most)), F.lit("\n... [truncated, "), F.length(text).cast("string"), F.lit(" total chars]")))


def token_estimate(chars: Column) -> Column:
    return F.floor(chars / CHARS_PER_TOKEN).cast("long")


def _may_match(rule: int, text: Column) -> Column:
    """Whether a text holds the fixed part that every match of a rule has; cheap, so that most texts skip the rule's pattern."""
    if rule == KEY_VALUE_RULE:
        return let(F.lower(text), lambda x: reduce(Column.__or__, [F.contains(x, F.lit(p)) for p in KEY_VALUE_PARTS]))
    return F.contains(text, F.lit(RULE_PARTS[rule]))


def _apply_rule(rule: int) -> Callable[[Column], Column]:
    pattern, replacement = REDACTION_RULES[rule]

    def apply(s: Column) -> Column:
        done = F.struct(F.regexp_replace(s["text"], pattern, replacement).alias("text"), (s["n"] + F.regexp_count(s["text"], F.lit(pattern))).alias("n"))
        return F.when(_may_match(rule, s["text"]), done).otherwise(s)

    return apply


def redacted(c: Column | str) -> Column:
    """A struct of text, after every redaction rule, and n: how many substitutions that took (a value that two rules rewrite counts twice)."""
    state = F.struct(col(c).alias("text"), F.lit(0).cast("long").alias("n"))
    for rule in range(len(REDACTION_RULES)):
        state = let(state, _apply_rule(rule))
    return state


def scrub(c: Column | str) -> Column:
    """The text after every redaction rule."""
    return redacted(c)["text"]


def count_redactions(c: Column | str) -> Column:
    """How many substitutions :func:`scrub` makes."""
    return redacted(c)["n"]


def normalise_prediction(c: Column | str) -> Column:
    """What stands before the terminator, stripped, each line stripped at its end."""
    body = strip(F.substring_index(col(c), TERMINATOR, 1))
    return F.array_join(F.transform(lines_of(body), strip_end), "\n")


def cut_at_stops(c: Column | str, stops: list[str]) -> Column:
    """The text up to the first of each stop string, in their order."""
    out = col(c)
    for stop in stops:
        out = F.split_part(out, F.lit(stop), F.lit(1))
    return out
