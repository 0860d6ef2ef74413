"""Fast exact encoding of whole texts with a public tokenizer file.

Both supported vocabularies never form a token across certain white space. So a batch of texts is cut
there into units; each new unit is encoded by the tokenizers library, and a text's ids are the concatenation of its units' ids. Corpora repeat
their words, so most units come from the cache, where slices of texts look up theirs together. Full stops and commas after a letter or digit are units of their own, and so are line ends after
a full stop: else each word is a new unit with each of them. A new unit of letters and marks is put together from the units of its parts: pieces also end where letters do, and at
single line ends. What is left is encoded many at a time, as one text in which each unit can be found again by the
number of bytes its tokens stand for; where these don't add up, units are encoded one by one.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units at which the cache is cut back (about 200 bytes each). It then keeps the earliest three fifths, which are the more frequent.
CACHE_UNITS = 500_000
#: Units of more characters (texts without blanks, whole lines of Chinese) are forgotten when the cache is cut back, which also happens once units of all lengths together have so many characters.
LONG_UNIT, CACHE_CHARS = 64, 40_000_000
#: Slices of texts of about so many characters together are looked up at once: a unit of several of them is looked up once.
TOGETHER = 12_000_000
#: Characters that are given to the tokenizers library at once, as its results take some 100 bytes a token.
_GIVEN = 200_000
#: White space to Python, but not to the tokenizers.
_CONTROL = "\x1c\x1d\x1e\x1f"
_JOINED = 2000
#: Starts a unit that follows the one before it without a space. Texts that hold it are encoded whole.
_MARK = "\0"
#: Only after a letter or digit are these pieces of their own; a line end is one between a full stop and what is not white space.
_STOP, _COMMA, _LINE = f"{_MARK}.", f"{_MARK},", f"{_MARK}\n"
#: White space that may be one piece; line ends apart from it are pieces of their own.
_RUN = re.compile(r"\s{3}|\n\s*\Z|\n\n")
_LETTERS = re.compile(r"[^\W\d_]+")
_ENCODERS: dict[str, "UnitEncoder"] = {}


def public_path(name: str) -> str:
    """The path of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(name: str, cut: str, most_units: int = CACHE_UNITS) -> "UnitEncoder":
    """This process's encoder. ``name``: a file of public_tokenizers, or a path. ``cut``: 'space' or 'white'."""
    key = f"{cut}:{name}:{most_units}"
    if key not in _ENCODERS:
        _ENCODERS[key] = UnitEncoder(name if os.path.sep in name else public_path(name), cut, most_units)
    return _ENCODERS[key]


def release() -> bool:
    """Free this process's encoders: a worker calls it when it turns to other work. Tells whether there were any."""
    had = bool(_ENCODERS)
    _ENCODERS.clear()
    return had


class _Index(dict):
    """Unit to number; an unknown unit gets the next number and waits to be encoded. A 1-tuple is a text's first unit, or a whole text."""

    def __init__(self, marks: bool, *args):
        super().__init__(*args)
        self.marks = marks
        self.waiting: list[str | tuple[str]] = []
        self.chars = sum(len(u if u.__class__ is str else u[0]) for u in self)
        #: Whether a unit ends with a letter or digit.
        self.closed = bytearray((u if u.__class__ is str else u[0])[-1:].isalnum() for u in self)

    def __missing__(self, unit: str | tuple[str]) -> int:
        text = unit if unit.__class__ is str else unit[0]
        n = self[unit] = len(self)
        self.waiting.append(unit)
        self.chars += len(text)
        self.closed.append(text[-1:].isalnum())
        return n

    def keep(self, most: int) -> None:
        """Forget all units but the earliest ``most``, whose numbers stay."""
        while len(self) > most:
            unit, _ = self.popitem()
            self.chars -= len(unit if unit.__class__ is str else unit[0])
        del self.closed[most:]
        kept = dict(self)  # a table from which was popped doubles although there is room
        self.clear()
        self.update(kept)

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The numbers of different pieces; -1 for what is no unit, as it belongs to what comes before it."""
        known = np.array(list(map(self.get, pieces, repeat(-1))), np.int64)
        where = np.flatnonzero(known < 0).tolist()
        where = [k for k in where if (p := pieces[k]) and not (p[1:2] if p[0] == _MARK and p != _LINE else p[0]).isspace() and p != _MARK]
        new = [pieces[k] for k in where]
        known[where] = np.arange(len(self), len(self) + len(new))
        self.update(zip(new, range(len(self), len(self) + len(new)), strict=True))
        self.waiting += new
        self.chars += sum(map(len, new))
        self.closed += bytes([p[-1].isalnum() for p in new])
        return known


class UnitEncoder:
    """``cut='space'`` suits byte-level BPE whose pieces start with their space: a piece starts at any space before a character that is not
    white space. ``cut='white'`` suits vocabularies that drop white space: a piece ends at any."""

    def __init__(self, path: str, cut: str, most_units: int = CACHE_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cut, self.most_units = cut, most_units
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix") or ""
        sizes = {i: len(token.removesuffix(suffix) if suffix else token) for token, i in spec["model"]["vocab"].items()}
        sizes |= {t["id"]: len(t["content"].encode()) for t in spec["added_tokens"]}
        self.token_bytes = np.zeros(max(sizes) + 1, np.int64)
        self.token_bytes[list(sizes)] = list(sizes.values())
        self.index = _Index(cut == "space")
        self.pool = np.empty(1 << 20, np.uint32)
        self.used = 0
        self.starts = np.empty(1 << 16, np.int64)
        self.lengths = np.empty(1 << 16, np.int64)

    def _cut_back(self) -> None:
        """Keep the earliest units and their ids only; if they have many characters, those that aren't long, under new numbers."""
        self.index.keep(self.most_units * 3 // 5)
        n = len(self.index)
        self.used = int((self.starts[:n] + self.lengths[:n]).max()) if n else 0
        if self.index.chars <= CACHE_CHARS // 4:
            return
        size = lambda u: len(u[0]) if isinstance(u, tuple) else len(u)
        kept = [(u, n) for u, n in self.index.items() if size(u) <= LONG_UNIT]
        old = np.array([n for _, n in kept], np.int64)
        starts, lengths = self.starts[old], self.lengths[old]
        ends = np.cumsum(lengths)
        self.used = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(self.used)]
        self.pool = np.concatenate([ids, np.empty(1 << 20, np.uint32)])
        self.starts, self.lengths = (np.concatenate([x, np.empty(1 << 16, np.int64)]) for x in (ends - lengths, lengths))
        self.index = _Index(self.index.marks, ((u, k) for k, (u, _) in enumerate(kept)))

    def _numbers(self, text: str) -> np.ndarray:
        """The numbers of a text's units."""
        get = self.index.__getitem__
        if self.cut == "white":
            if any(c in text for c in _CONTROL):  # white space to Python, but not to the tokenizer
                return np.array([get((text,))], np.int64)
            pieces = text.split()
            return np.fromiter(map(get, pieces), np.int64, len(pieces))
        if _MARK in text:
            return np.array([get((text,))], np.int64)
        pieces = text.split(" ")
        merged = pieces[:1]
        for p in pieces[1:]:
            if not p or p[0].isspace():
                merged[-1] += " " + p
            else:
                merged.append(p)
        return np.array([get((merged[0],)), *map(get, merged[1:])], np.int64)

    def _numbers_at_marks(self, slices: list[list[str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each slice the numbers of the units of all its texts, cut at spaces and around full stops, commas and line ends, and how many each text has. Each different unit of all slices is looked up once.

        Texts in which a piece is no unit, or a full stop, comma or line end follows what may be one piece with it, are cut at spaces only.
        """
        counts, coded = [], []
        for texts in slices:
            marked = pa.array(["" if _MARK in t else t for t in texts], pa.large_string())
            for what, cut in ((". ", f" {_STOP} "), (", ", f" {_COMMA} "), (".\n", f" {_STOP} {_LINE} {_MARK}")):
                marked = pc.replace_substring(marked, what, cut)
            marked = pc.binary_join_element_wise(pa.scalar(_MARK, pa.large_string()), marked, pa.scalar("", pa.large_string()))
            pieces = pc.split_pattern(marked, " ")
            counts.append(np.diff(pieces.offsets.to_numpy()))
            coded.append(pieces.values.dictionary_encode())
        every = pa.concat_arrays([c.dictionary for c in coded]).dictionary_encode()
        units = every.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist() takes eight times as long
        known = np.split(self.index.numbers(units)[every.indices.to_numpy()], np.cumsum([len(c.dictionary) for c in coded])[:-1])
        stop, comma, line = (self.index.get(m, -1) for m in (_STOP, _COMMA, _LINE))
        for texts, count, code, own in zip(slices, counts, coded, known, strict=True):
            numbers = own[code.indices.to_numpy()]
            at, lines = np.flatnonzero((numbers == stop) | (numbers == comma)), np.flatnonzero(numbers == line)
            closed = np.array(self.index.closed)
            bad = np.concatenate([np.flatnonzero(numbers < 0), at[closed[numbers[at - 1]] == 0], lines[numbers[lines - 1] != stop]])
            ends = np.cumsum(count)
            if len(rows := np.unique(np.searchsorted(ends, bad, "right"))):
                per_text = np.split(numbers, ends[:-1])
                for k in rows.tolist():
                    per_text[k] = self._numbers(texts[k])
                numbers, count = np.concatenate(per_text), np.fromiter(map(len, per_text), np.int64, len(texts))
            yield numbers, count

    def _parts(self, unit: str | tuple[str]) -> list[str | tuple[str]] | None:
        """The units that a unit is made of, if it can be told that no token goes over their bounds."""
        first = unit.__class__ is str
        text = unit if first else unit[0]
        if "\n" in text and self.cut == "space" and not _RUN.search(text):
            lines = text.split("\n")
        else:
            lines = (text,)
        out: list[str | tuple[str]] = []
        for k, line in enumerate(lines):
            if k:
                out.append(("\n",))
            m = _LETTERS.match(line)
            if m and (end := m.end()) < len(line) and line[end].isascii() and (head := m[0]).isalpha() and (head.isascii() or head.lower().isalpha() and "Σ" not in head):
                # Marks compose with letters, some letters end with a mark in lower case, and a final sigma depends on what follows.
                out.append(head if first and not k else (head,))
                out.append((line[end:],))
            elif line:
                out.append(line if first and not k else (line,))
            elif first and not k:
                return None
        return out if len(out) > 1 else None

    def _learn(self) -> None:
        units, self.index.waiting = self.index.waiting, []
        if not units:
            return
        at = len(self.index) - len(units)
        if self.index.marks:
            units = [(u[1:],) if u.__class__ is str and u[0] == _MARK else u for u in units]
        made, parts, odd = [], [], []
        get = self.index.__getitem__
        letters = [u.__class__ is str and u.isalpha() for u in units]
        plain = list(compress(range(len(units)), letters))
        for k in [k for k, x in enumerate(letters) if not x]:
            u = units[k]
            if p := self._parts(u):
                made.append(at + k)
                parts.append(list(map(get, p)))
            else:
                (plain if u.__class__ is str else odd).append(k)
        more, self.index.waiting = self.index.waiting, []  # parts that are new themselves; they are encoded whole
        for k, u in enumerate(more, len(units)):
            (plain if u.__class__ is str else odd).append(k)
        units += more
        while at + len(units) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.empty_like(x)]) for x in (self.starts, self.lengths))
        lead = " " if self.cut == "space" else ""
        groups = [plain[k : k + _JOINED] for k in range(0, len(plain), _JOINED)]
        texts = [lead + " ".join([units[k] for k in g]) for g in groups]
        for g, text, e in zip(groups, texts, self._encoded(texts), strict=True):
            ids = np.array(e.ids, np.uint32)
            ends = np.cumsum(self.token_bytes[ids])
            wanted = self._unit_ends(text)
            stops = np.searchsorted(ends, wanted)
            if len(stops) == len(g) and len(ids) and stops[-1] == len(ids) - 1 and (ends[stops] == wanted).all():
                self._store(at + np.array(g), ids, np.diff(stops, prepend=-1))
            else:
                odd += g
        if self.cut == "space" and self.tokenizer.normalizer is None:
            odd = self._learn_lines(at, units, odd)
        alone = [units[k][0] if isinstance(units[k], tuple) else lead + units[k] for k in odd]
        found = [np.array(e.ids, np.uint32) for e in self._encoded(alone)]
        if found:
            self._store(at + np.array(odd), np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found)))
        if made:
            each = np.fromiter(chain.from_iterable(parts), np.int64)
            counts = np.fromiter(map(len, parts), np.int64, len(parts))
            ids, lengths = self._gather(each)
            self._store(np.array(made), ids, np.add.reduceat(lengths, np.cumsum(counts) - counts))

    def _encoded(self, texts: list[str]) -> Iterator:
        """What the tokenizers library makes of each text, some texts at a time."""
        for some in text_slices(texts, _GIVEN):
            if some:
                yield from self.tokenizer.encode_batch_fast(some, add_special_tokens=False)

    def _learn_lines(self, at: int, units: list[str | tuple[str]], odd: list[int]) -> list[int]:
        """Encode those of the ``odd`` units that are letters without a space as lines of joined texts: no token goes over a line end there. Returns the others."""
        lines = [k for k in odd if units[k].__class__ is tuple and units[k][0].isalpha()]
        groups = [lines[k : k + _JOINED] for k in range(0, len(lines), _JOINED)]
        texts = ["\n".join([units[k][0] for k in g]) for g in groups]
        done: set[int] = set()
        for g, text, e in zip(groups, texts, self._encoded(texts), strict=True):
            ids, data = np.array(e.ids, np.uint32), np.frombuffer(text.encode(), np.uint8)
            ends = np.cumsum(self.token_bytes[ids])
            wanted = np.append(np.flatnonzero(data == 10), len(data))
            stops = np.searchsorted(ends, wanted)
            breaks = stops[:-1] + 1
            if stops[-1] == len(ids) - 1 and (ends[stops] == wanted).all() and (ends[breaks] == wanted[:-1] + 1).all():
                self._store(at + np.array(g), np.delete(ids, breaks), np.diff(stops, prepend=-1) - np.append(0, np.ones(len(breaks), np.int64)))
                done.update(g)
        return [k for k in odd if k not in done]

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units, one after another, and how many each has."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        return self.pool[np.repeat(self.starts[numbers] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)], lengths

    def _store(self, places: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Keep the ids of the units at ``places``, one after another in ``ids``."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.lengths[places] = lengths
        self.starts[places] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)

    def _unit_ends(self, text: str) -> np.ndarray:
        """How many bytes the tokens of joined units stand for, up to the end of each unit, as the tokenizer sees the text."""
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        data = np.frombuffer(text.encode(), np.uint8)
        spaces = np.flatnonzero(data == 32)
        if self.cut == "space":  # each unit starts with its space
            return np.append(spaces[1:], len(data))
        return np.append(spaces - np.arange(len(spaces)), len(data) - len(spaces))

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text's followed by ``end_id``, and the number of ids of each."""
        return next(self.encode_slices([texts], end_id))

    def encode_slices(self, slices: Iterable[list[str]], end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What ``encode`` gives for each list of texts; the units of several are looked up at once."""
        group: list[list[str]] = []
        size = 0
        for texts in slices:
            n = sum(map(len, texts))
            if group and size + n > TOGETHER:
                yield from self._encode_group(group, end_id)
                group, size = [], 0
            group.append(texts)
            size += n
        if group:
            yield from self._encode_group(group, end_id)

    def _encode_group(self, slices: list[list[str]], end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(self.index) > self.most_units or self.index.chars > CACHE_CHARS:
            self._cut_back()
        if self.index.marks:
            found = list(self._numbers_at_marks(slices))
        else:
            found = []
            for texts in slices:
                per_text = [self._numbers(t) for t in texts]
                counts = np.fromiter(map(len, per_text), np.int64, len(texts))
                found.append((np.concatenate(per_text) if texts else np.empty(0, np.int64), counts))
        self._learn()
        for where, counts in found:
            body, lengths = self._gather(where)
            ends = np.cumsum(lengths)
            bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
            sizes = np.diff(bounds)
            yield np.insert(body, bounds[1:], np.uint32(end_id)).astype(np.uint32), sizes + 1


def text_slices(texts: list[str | None], most: int = 2_000_000) -> list[list[str]]:
    """The texts in lists of about ``most`` characters (one text at least); nulls are empty."""
    out: list[list[str]] = [[]]
    size = 0
    for t in texts:
        t = t or ""
        if out[-1] and size + len(t) > most:
            out.append([])
            size = 0
        out[-1].append(t)
        size += len(t)
    return out
