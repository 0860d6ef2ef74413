"""Operator 4: personal data by fixed patterns and a linear-chain conditional random field.

The patterns (email, ip, card, phone) are base spans and always stay. The field adds spans in forms the patterns don't know, such as
phone numbers without a country code. It works on tokens: runs
of letters, runs of digits, single marks. Its features are word shapes, of a token and its neighbours. It is trained here from a small labelled table
(LABELLED_ROWS rows written by rule, with look-alikes such as dates, prices and versions), and decodes rows of like length together by
Viterbi in numpy. Added spans never overlap base spans.

Whole texts are covered by windows around digits and at-signs, without which nothing can be of any kind (:func:`plausible`). The words around them are more than features reach,
so elsewhere the field sees words only; the tests hold the windows' spans against those of whole texts, and measure what the field adds on sentences it wasn't made from.

Defined cases: a null or empty text has no spans; overlapping matches of different kinds are all kept; repeated rows are judged each; a very long
text is decoded in slices; an empty table gives no rows; further columns are ignored. Positions are code points, ends exclusive. Patterns run in linear time on any text.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm._common import map_arrow

KINDS = ("email", "ip", "card", "phone")
LABELLED_ROWS = 600
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can start only where a run of digits starts and takes whole runs, so these equal the plain patterns and take linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_CLUE = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
Span = tuple[int, int, int]  # start, place of the kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The patterns' spans by start, then kind."""
    out: list[Span] = []
    at, low = text.find("@"), 0
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            low = m.end()
        else:
            low = at + 1
        at = text.find("@", low)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".") if len(p) < 4000) and all(len(p) < 4000 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


#: A row of more tokens is decoded in slices of so many, each with so many more at both ends.
SLICE, OVERLAP = 20_000, 200

# The field. Labels: 0 is outside; 1 + 2k starts a span of kind k, 2 + 2k continues it.
N_LABELS = 1 + 2 * len(KINDS)


def shape(token: str, spaced: bool) -> str:
    """The shape of a token, with an underscore first if white space comes before it."""
    c = token[0]
    if "0" <= c <= "9":
        s = f"d{min(len(token), 12)}"
    elif c.isalpha():
        low = token.lower()
        s = low if low in _CUES else ("a" if len(token) == 1 else "Xx" if c.isupper() else "xx" if len(token) < 4 else "xxxx")
    else:
        s = c
    return f"_{s}" if spaced else s


# Words that announce a number.
_CUES = frozenset("tel phone call fax mobile mail email ip card visa v version page isbn order no".split())


def features(shapes: list[str], k: int) -> list[str]:
    """Feature names of token k."""
    get = lambda i: shapes[i] if 0 <= i < len(shapes) else "#"
    a, b, c, d, e = (get(k + o) for o in (-2, -1, 0, 1, 2))
    return ["bias", f"0{c}", f"-1{b}", f"+1{d}", f"-2{a}", f"+2{e}", f"-1{b}|0{c}", f"0{c}|+1{d}", f"-1{b}|0{c}|+1{d}", f"-2{a}|-1{b}|0{c}", f"0{c}|+1{d}|+2{e}", f"+1{d}|+2{e}|+3{get(k + 3)}", f"-3{get(k - 3)}|-2{a}|-1{b}"]


def tokenize(text: str, start: int = 0, end: int | None = None) -> tuple[list[tuple[int, int]], list[str]]:
    places, shapes, last = [], [], -1
    for m in _TOKEN.finditer(text, start, len(text) if end is None else end):
        places.append(m.span())
        shapes.append(shape(m[0], m.start() != last))
        last = m.end()
    return places, shapes


def labelled_table(rows: int = LABELLED_ROWS, seed: int = 7) -> list[tuple[str, list[Span]]]:
    """Texts with their spans, written by rule from the seed: half hold personal data, half only look-alikes."""
    rng = random.Random(seed)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(2, 9)))

    name = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))

    def luhn_card() -> str:
        body = rng.choice("3456") + d(14)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def card() -> str:
        c = luhn_card()
        return rng.choice([c, f"{c[:4]} {c[4:8]} {c[8:12]} {c[12:]}", f"{c[:4]}-{c[4:8]}-{c[8:12]}-{c[12:]}", f"{c[:4]}.{c[4:8]}.{c[8:12]}.{c[12:]}", f"{c[:4]} - {c[4:8]} - {c[8:12]} - {c[12:]}"])

    def phone() -> str:
        a, b, c = d(3), d(3), d(4)
        return rng.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{d(2)} {a} {b} {c}", f"({a}){b}-{c}", f"1-{a}-{b}-{c}", f"00{d(2)} {a} {b} {c}"])

    data = {
        0: lambda: rng.choice([f"{name()}.{d(2)}@{name()}.com", f"{name()}@{name()}.{name()}.org", f"{name()} @ {name()}.com", f"{name()}{d(2)}@{name()}.net"]),
        1: lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        2: card,
        3: phone,
    }
    other = [
        lambda: f"{d(4)}", lambda: f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.20{d(2)}", lambda: f"20{d(2)}-{d(2)}-{d(2)}", lambda: f"{d(2)}:{d(2)}:{d(2)}",
        lambda: f"${d(2)}.{d(2)}", lambda: f"version {d(1)}.{d(1)}.{d(1)}", lambda: f"v{d(1)}.{d(1)}", lambda: f"{d(1)},{d(3)},{d(3)}", lambda: f"no {d(7)}", lambda: f"{d(2)}%",
        lambda: f"page {d(3)}", lambda: f"isbn 978-{d(1)}-{d(5)}-{d(3)}-{d(1)}", lambda: f"{d(3)}-{d(3)}", lambda: f"order {d(10)}", lambda: f"@{word()}", lambda: f"{word()} @ {word()}", lambda: f"Version {d(1)}.{d(1)}.",
        lambda: f"{d(5)}", lambda: f"{d(12)}", lambda: f"{d(3)} {d(3)} {d(3)}", lambda: f"({d(4)})", lambda: f"({d(2)})", lambda: f"[{d(2)}]", lambda: f"{d(3)}.{d(2)}", lambda: f"{word()}={d(6)}", lambda: f"/{word()}/{d(4)}?page={d(1)}",
        lambda: f"4.{d(1)}.", lambda: f"{d(2)}-{d(2)}", lambda: f"+{d(2)}", lambda: f"{d(20)}", lambda: f"key={hexes(18)}", lambda: f'{word()} = "{hexes(40)}"', lambda: hexes(rng.randint(12, 40)), lambda: f"{word()}={hexes(18)}", lambda: hexes(8), lambda: f"{d(3)}-{d(2)}-{d(4)}", lambda: f"{d(8)}",
    ]
    out = []
    for row in range(rows):
        text, spans = "", []
        for _ in range(rng.randint(1, 3)):
            text += " ".join(rng.choice([word(), word(), word().title(), word() + ",", word() + "."]) for _ in range(rng.randint(1, 6))) + " "
            if row % 2:
                text += rng.choice(other)()
            else:
                kind = rng.randint(0, 3)
                item = data[kind]()
                spans.append((len(text), kind, len(text) + len(item)))
                text += item
            text += rng.choice([" ", " ", ", ", ". ", "\n"])
        out.append((text, spans))
    return out


class Field:
    """A trained linear-chain conditional random field."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.names, self.weights, self.moves = names, weights, moves

    def emissions(self, shapes: list[str]) -> np.ndarray:
        at, owner = [], []
        for k in range(len(shapes)):
            for f in features(shapes, k):
                if (i := self.names.get(f)) is not None:
                    at.append(i)
                    owner.append(k)
        out = np.zeros((len(shapes), N_LABELS))
        np.add.at(out, owner, self.weights[at])
        return out

    def decode(self, batch: list[list[str]]) -> list[np.ndarray]:
        """The best labels of each token row. Rows longer than SLICE are decoded in slices that overlap by far more than a span's length."""
        parts, owner = [], []
        for k, row in enumerate(batch):
            for at in range(0, max(len(row), 1), SLICE):
                low = max(at - OVERLAP, 0)
                parts.append(row[low : at + SLICE + OVERLAP])
                owner.append((k, at - low, min(SLICE, len(row) - at)))
        out: list[list[np.ndarray]] = [[] for _ in batch]
        for (k, skip, n), labels in zip(owner, self._decode(parts), strict=True):
            out[k].append(labels[skip : skip + n])
        return [np.concatenate(x) for x in out]

    def _decode(self, batch: list[list[str]]) -> list[np.ndarray]:
        """The best labels of rows of bounded length; those of like length are decoded together."""
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(batch)
        order = sorted(range(len(batch)), key=lambda k: len(batch[k]))
        while order:
            longest = len(batch[order[-1]])
            take = max(1, min(len(order), 200_000 // max(longest, 1)))
            group, order = order[-take:], order[:-take]
            for k, labels in zip(group, self._viterbi([self.emissions(batch[k]) for k in group]), strict=True):
                out[k] = labels
        return out

    def _viterbi(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        sizes = np.array([len(r) for r in rows])
        longest = int(sizes.max(initial=0))
        e = np.zeros((len(rows), longest, N_LABELS))
        for k, r in enumerate(rows):
            e[k, : len(r)] = r
        back = np.zeros((len(rows), longest, N_LABELS), np.int8)
        best = e[:, 0].copy() if longest else np.zeros((len(rows), N_LABELS))
        best[:, 2::2] = -np.inf
        for t in range(1, longest):
            step = best[:, :, None] + self.moves[None]
            back[:, t] = step.argmax(axis=1)
            best = np.where((t < sizes)[:, None], step.max(axis=1) + e[:, t], best)
        labels = np.zeros((len(rows), longest), np.int64)
        now = best.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            on = t < sizes
            labels[on, t] = now[on]
            if t:
                now = np.where(on, back[np.arange(len(rows)), t, now], now)
        return [labels[k, : sizes[k]] for k in range(len(rows))]


def _allowed() -> np.ndarray:
    """0 for a label that may follow another, -inf for a continuation that doesn't."""
    out = np.zeros((N_LABELS, N_LABELS))
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = -np.inf
        out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0.0
    return out


def train(table: list[tuple[str, list[Span]]], steps: int = 70, rate: float = 0.25, penalty: float = 2e-3) -> Field:
    """Maximum likelihood with an L2 penalty by Adam, full batch."""
    rows = []
    for text, spans in table:
        places, shapes = tokenize(text)
        labels = np.zeros(len(places), np.int64)
        for s, kind, e in spans:
            inside = [k for k, (a, b) in enumerate(places) if a >= s and b <= e]
            labels[inside] = 2 + 2 * kind
            labels[inside[0]] = 1 + 2 * kind
        rows.append((shapes, labels))
    names: dict[str, int] = {}
    size, longest = len(rows), max(len(s) for s, _ in rows)
    width = len(features(["x"], 0))
    ids = np.zeros((size, longest, width), np.int64)
    gold, mask = np.zeros((size, longest), np.int64), np.zeros((size, longest), bool)
    for r, (shapes, labels) in enumerate(rows):
        for k in range(len(shapes)):
            ids[r, k] = [names.setdefault(f, len(names)) for f in features(shapes, k)]
        gold[r, : len(labels)], mask[r, : len(labels)] = labels, True
    allowed = _allowed()
    w, m = np.zeros((len(names), N_LABELS)), np.zeros((N_LABELS, N_LABELS))
    state = [np.zeros_like(x) for x in (w, w, m, m)]
    start = np.zeros(N_LABELS)
    start[2::2] = -np.inf
    flat = ids[mask].ravel()
    for step in range(1, steps + 1):
        e = w[ids].sum(axis=2)
        moves = m + allowed
        alpha, beta = np.full((size, longest, N_LABELS), -np.inf), np.zeros((size, longest, N_LABELS))
        alpha[:, 0] = e[:, 0] + start
        for t in range(1, longest):
            new = _logsum(alpha[:, t - 1, :, None] + moves[None], 1) + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
        z = _logsum(alpha[:, -1], 1)
        pair = np.zeros_like(m)
        for t in range(longest - 1, 0, -1):
            ahead = moves[None] + (e[:, t] + beta[:, t])[:, None, :]
            on = mask[:, t]
            pair += np.exp(alpha[on, t - 1][:, :, None] + ahead[on] - z[on][:, None, None]).sum(axis=0)
            beta[:, t - 1] = np.where(on[:, None], _logsum(ahead, 2), beta[:, t])
        # Rows end at different places: beta is 0 at a row's last token.
        p = np.exp(alpha + beta - z[:, None, None])
        p[~mask] = 0.0
        gap = -p
        gap[np.nonzero(mask) + (gold[mask],)] += 1.0
        gw = np.zeros_like(w)
        np.add.at(gw, flat, np.repeat(gap[mask], width, axis=0))
        gm = -pair
        both = mask[:, 1:]
        np.add.at(gm, (gold[:, :-1][both], gold[:, 1:][both]), 1.0)
        for x, g, k in ((w, gw, 0), (m, gm, 2)):
            g = g / size - penalty * x
            state[k] = 0.9 * state[k] + 0.1 * g
            state[k + 1] = 0.99 * state[k + 1] + 0.01 * g * g
            x += rate * (state[k] / (1 - 0.9**step)) / (np.sqrt(state[k + 1] / (1 - 0.99**step)) + 1e-8)
    return Field(names, w, m + allowed)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


@cache
def default_field() -> Field:
    return train(labelled_table())


def windows(text: str, around: int = 4) -> list[tuple[int, int]]:
    """Stretches of text around its digits and at-signs: the words that hold them and ``around`` words on each side."""
    out: list[tuple[int, int]] = []
    at = 0
    while m := _CLUE.search(text, at):
        start, end = m.start(), m.end()
        for _ in range(around + 1):
            while start > at and text[start - 1].isspace():
                start -= 1
            while start > at and not text[start - 1].isspace():
                start -= 1
        quiet = 0
        while end < len(text) and quiet <= around:
            while end < len(text) and not text[end].isspace():
                quiet = 0 if text[end] in "0123456789@" else quiet
                end += 1
            while end < len(text) and text[end].isspace():
                end += 1
            quiet += 1
        out.append((start, end))
        at = end
    return out


def plausible(item: str, kind: int) -> bool:
    """Whether a decoded span can be of its kind at all: an email has an at-sign, the others have no letters and enough digits."""
    if kind == 0:
        return "@" in item[1:-1]
    digits = sum("0" <= c <= "9" for c in item)
    return not any(c.isalpha() for c in item) and digits >= (4, 4, 13, 7)[kind] and digits <= (0, 12, 19, 15)[kind]


def find_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """For each text its base spans and all its spans."""
    base = [base_spans(t) if _CLUE.search(t) else [] for t in texts]
    jobs, shapes = [], []
    for k, t in enumerate(texts):
        for s, e in windows(t):
            places, sh = tokenize(t, s, e)
            jobs.append((k, places))
            shapes.append(sh)
    added: list[list[Span]] = [[] for _ in texts]
    for (k, places), labels in zip(jobs, field.decode(shapes), strict=True):
        starts = np.flatnonzero(labels % 2 == 1)
        for i in starts.tolist():
            kind, j = int(labels[i] - 1) // 2, i + 1
            while j < len(labels) and labels[j] == 2 + 2 * kind:
                j += 1
            span = (places[i][0], kind, places[j - 1][1])
            if plausible(texts[k][span[0] : span[2]], kind):
                added[k].append(span)
    out = []
    for own, more in zip(base, added, strict=True):
        ends, reach = [], 0
        for _, _, e in own:
            reach = max(reach, e)
            ends.append(reach)
        begins = [s for s, _, _ in own]
        free = [x for x in more if not ((i := bisect_right(begins, x[2] - 1)) and ends[i - 1] > x[0])]
        out.append((own, sorted(own + free)))
    return out


RESULT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
_ARROW = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]


def _slices(texts: list[str | None], most: int = 4_000_000) -> Iterator[list[str]]:
    part: list[str] = []
    size = 0
    for t in texts:
        t = t or ""
        if part and size + len(t) > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    yield part


def _detect(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for texts in _slices(batch.column("text").to_pylist()):
                for own, every in find_spans(texts, field):
                    counts = [sum(k == x for _, x, _ in own) for k in range(len(KINDS))]
                    rows.append((*counts, hashlib.sha256(spans_text(own).encode()).hexdigest(), spans_text(every), len(every) - len(own)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(_ARROW)
            yield pa.record_batch([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, _ARROW, strict=True)]], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return run


def detect(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, counts and digest of the base spans, all spans, and how many the field added."""
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _detect(field or default_field()), f"doc_id long, {RESULT}")


def redact_text(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first stands for all."""
    out, at, last = [], 0, 0
    for s, k, e in spans:
        if s >= last:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
            last = e
        last = max(last, e)
        at = last
    return "".join([*out, text[at:]])


def _redact(field: Field, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(place).to_pylist()
            new: list[str | None] = []
            for texts in _slices(values):
                new += [redact_text(t, every) for t, (_, every) in zip(texts, find_spans(texts, field), strict=True)]
            cols = batch.columns
            cols[place] = pa.array([None if v is None else n for v, n in zip(values, new, strict=True)] if values else [], pa.string())
            yield pa.record_batch(cols, names=batch.schema.names)

    return run


def redact(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``docs`` with the spans in its column text replaced; all columns stay."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_arrow(docs, _redact(field or default_field(), docs.columns.index("text")), kinds)


def op4_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(spark.read.parquet(f"{sf_dir}/documents.parquet"))
