"""Operator 7: language identification by interpolated Kneser-Ney character models.

Each language has a character model over words (padded by a space), trained on a bounded sample of labelled rows: at most
``per_language`` whole texts of each language, those with the lowest hashes. n-grams of all languages lie in one sorted hash array per order, with a
column per language: the interpolated log-probability of a seen n-gram, and the back-off weight of a seen context.
The language with the lowest cross-entropy per character is chosen. It is rejected if that entropy is nine tenths of the way from what its own texts have to
what those of the nearest other language have under this model (calibrated on held-back training rows, so that texts that mix
learned languages stay), also after allowing six standard errors for short texts. Words repeat, so each task scores a word once.

Defined cases: a null text, or one without letters (numerals are none), gives ``und``, score 0 and rejected; a row with a null doc_id is no training row and not held out; very long texts are
read whole, their words scored in slices; ties go to the first language by name; repeated rows
are judged each; without training rows every prediction is ``und``; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm._common import map_arrow

ORDER = 5
PER_LANGUAGE = 400
#: Labelled texts of fewer words are never taken for wrongly labelled.
FEW_WORDS = 20
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]{1,40}")  # longer words (scripts without spaces) are scored in pieces
_PRIME = np.uint64(0x9E3779B97F4A7C15)
RESULT = "doc_id long, lang_pred string, score double, entropy double, rejected boolean"


def _letters(word: str) -> list[str]:
    """The runs of letters in a word, which may also hold numerals that aren't digits, such as fractions."""
    return [word] if word.isalpha() else "".join(c if c.isalpha() else " " for c in word).split()


def words_of(text: str) -> list[str]:
    found = _WORD.findall(text.lower())
    return found if not found or "".join(found).isalpha() else [w for x in found for w in _letters(x)]


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words, each between spaces; the place of each within its word; and its word's number."""
    text = "".join(f" {w} " for w in words)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return points, place, word


def _hashes(points: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n code points that end at each position (those before the array's start count as 0)."""
    h = np.full(len(points), n, np.uint64)
    for k in range(n - 1, -1, -1):
        back = np.concatenate([np.zeros(k, np.uint64), points[: len(points) - k]])
        h = (h ^ (back + np.uint64(1))) * _PRIME
        h ^= h >> np.uint64(29)
    return h


@dataclass
class Model:
    languages: list[str]
    keys: list[np.ndarray]  # per order: sorted hashes of n-grams
    logp: list[np.ndarray]  # per order: (n-grams, languages), backed off for languages that haven't seen the n-gram
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]  # per order: (contexts, languages), 0 where not seen
    floor: np.ndarray  # per language: log-probability of an unknown character
    own: np.ndarray = None  # calibration: mean entropy of own texts,
    limit: np.ndarray = None  # the entropy above which a text is rejected,
    spread: np.ndarray = None  # and the variance of a word's entropy
    sharpness: float = 20.0  # how fast a language's odds fall with its entropy, fitted to calibration texts

    def word_scores(self, words: list[str]) -> np.ndarray:
        """(words, languages): log-probability of each word with its closing space."""
        points, place, word = _grams(words)
        total = np.zeros((len(points), len(self.languages)))
        todo = np.flatnonzero(place > 0)
        after = _hashes(points, ORDER)
        for n in range(ORDER, 0, -1):
            hashes, after = after, _hashes(points, n - 1)
            fits = place[todo] >= n - 1
            at, hit = _find(self.keys[n - 1], hashes[todo[fits]])
            seen = todo[fits][hit]
            total[seen] += self.logp[n - 1][at[hit]]
            unseen = todo[fits][~hit]
            if n > 1 and len(unseen):
                at, hit = _find(self.contexts[n - 1], after[unseen - 1])
                total[unseen[hit]] += self.backoff[n - 1][at[hit]]
            todo = np.concatenate([todo[~fits], unseen])
        total[todo] += self.floor
        return np.add.reduceat(total, np.flatnonzero(place == 0), axis=0) if len(words) else np.empty((0, len(self.languages)))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


def _kneser_ney(words: Counter) -> tuple[list[tuple[np.ndarray, ...]], list[tuple[np.ndarray, np.ndarray]], float]:
    """Per order (n-gram hashes, log-probabilities, hashes of the contexts and of all but the first character) and (context hashes, log back-offs), and the floor, of one language."""
    points, place, word = _grams(list(words))
    weight = np.fromiter(words.values(), np.float64, len(words))[word]
    hashes = [_hashes(points, n) for n in range(ORDER + 1)]
    grams, contexts = [], []
    lower: tuple[np.ndarray, np.ndarray] | None = None
    floor = 0.0
    for n in range(1, ORDER + 1):
        ends = np.flatnonzero((place >= n - 1) & (place > 0))
        key, first, inverse = np.unique(hashes[n][ends], return_index=True, return_inverse=True)
        count = np.bincount(inverse, weights=weight[ends])
        if n < ORDER:  # how many characters come before it; n-grams at a word's start have none, and keep their count
            inner = ends[place[ends] >= n]
            pairs = np.unique(np.stack([hashes[n + 1][inner], hashes[n][inner]]), axis=1)[1]
            at, _ = _find(key, pairs)
            before = np.bincount(at, minlength=len(key)).astype(np.float64)
            count = np.where(before > 0, before, count)
        where = ends[first]
        context = hashes[n - 1][where - 1] if n > 1 else np.zeros(len(key), np.uint64)
        ones, twos = (count == 1).sum(), (count == 2).sum()
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        ckey, cinv = np.unique(context, return_inverse=True)
        csum, ctypes = np.bincount(cinv, weights=count), np.bincount(cinv)
        weight_back = d * ctypes / csum
        if n == 1:
            below = np.full(len(key), 1.0 / (len(key) + 1))
            floor = float(np.log(weight_back[0] / (len(key) + 1)))
        else:
            at, hit = _find(lower[0], hashes[n - 1][where])
            below = np.where(hit, lower[1][at], np.exp(floor))
        p = np.maximum(count - d, 0) / csum[cinv] + weight_back[cinv] * below
        lower = (key, p)
        grams.append((key, np.log(p), context, hashes[n - 1][where]))
        contexts.append((ckey, np.log(weight_back)))
    return grams, contexts, floor


def _join_columns(parts: list[tuple[np.ndarray, np.ndarray]], empty: float) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(np.concatenate([k for k, _ in parts]))
    table = np.full((len(keys), len(parts)), empty)
    for c, (k, v) in enumerate(parts):
        table[np.searchsorted(keys, k), c] = v
    return keys, table


def _tables(texts: dict[str, list[list[str]]]) -> Model:
    """A model of texts (lists of words) by language, without calibration."""
    languages = sorted(texts)
    fitted = [_kneser_ney(Counter(w for words in texts[lang] for w in words)) for lang in languages]
    grams = [_join_columns([f[0][n][:2] for f in fitted], np.nan) for n in range(ORDER)]
    contexts = [_join_columns([f[1][n] for f in fitted], 0.0) for n in range(ORDER)]
    floor = np.array([f[2] for f in fitted])
    for n, (keys, table) in enumerate(grams):  # what a language hasn't seen is backed off here, once
        below = np.broadcast_to(floor, table.shape)
        if n:
            context, rest = np.empty(len(keys), np.uint64), np.empty(len(keys), np.uint64)
            for f in fitted:
                own = np.searchsorted(keys, f[0][n][0])
                context[own], rest[own] = f[0][n][2:]
            at, hit = _find(contexts[n][0], context)
            below = grams[n - 1][1][_find(grams[n - 1][0], rest)[0]] + np.where(hit[:, None], contexts[n][1][at], 0.0)
        table[:] = np.where(np.isnan(table), below, table)
    return Model(languages, [k for k, _ in grams], [v for _, v in grams], [k for k, _ in contexts], [v for _, v in contexts], floor)


def _entropies(model: Model, texts: list[list[str]]) -> np.ndarray:
    """(texts, languages): entropy per character under each language's model."""
    out = []
    for words in texts:
        every = Counter(words)
        score = (model.word_scores(list(every)) * np.fromiter(every.values(), np.float64, len(every))[:, None]).sum(axis=0)
        out.append(-score / (sum(map(len, words)) + len(words)))
    return np.array(out).reshape(-1, len(model.languages))


def _sound(texts: dict[str, list[list[str]]]) -> dict[str, list[list[str]]]:
    """Without the labelled texts that aren't of their language: each half is judged by a model of the other, at nine tenths of the way to the nearest other language. Texts of few words stay."""
    halves = [{lang: own[h::2] or own for lang, own in texts.items()} for h in (0, 1)]
    judged = {lang: np.empty((len(own), len(texts))) for lang, own in texts.items()}
    for h in (0, 1):
        model = _tables(halves[h])
        for lang, own in texts.items():
            judged[lang][1 - h :: 2] = _entropies(model, own[1 - h :: 2])
    languages = sorted(texts)
    middle = np.array([np.median(judged[lang], axis=0) for lang in languages])  # of a's texts under each model
    out = {}
    for a, lang in enumerate(languages):
        nearest = min((middle[b, a] for b in range(len(languages)) if b != a), default=2 * middle[a, a])
        limit = middle[a, a] + 0.9 * max(nearest - middle[a, a], 0.2)
        out[lang] = [t for t, e in zip(texts[lang], judged[lang][:, a], strict=True) if e <= limit or len(t) < FEW_WORDS] or texts[lang]
    return out


def fit(rows: list[tuple[str, str]]) -> Model:
    """A model from (language, text) rows, without those whose label is plainly wrong; every fourth row of a language calibrates the rejection."""
    texts: dict[str, list[list[str]]] = {}
    for lang, text in rows:
        if words := words_of(text or ""):
            texts.setdefault(lang, []).append(words)
    languages = sorted(texts)
    if not languages:
        return Model([], [], [], [], [], np.empty(0))
    texts = _sound(texts)
    held = {lang: own[3::4] or own for lang, own in texts.items()}
    model = _tables({lang: [t for k, t in enumerate(texts[lang]) if k % 4 != 3] for lang in languages})
    size = len(languages)
    mean, model.spread = np.zeros((size, size)), np.zeros(size)
    for a, lang in enumerate(languages):
        every = Counter(w for words in held[lang] for w in words)
        score, n = model.word_scores(list(every)), np.fromiter(every.values(), np.float64, len(every))
        chars = np.fromiter((len(w) + 1 for w in every), np.float64, len(every))
        mean[a] = -(score * n[:, None]).sum(axis=0) / (chars * n).sum()  # entropy of a's texts under each model
        model.spread[a] = ((-score[:, a] - mean[a, a] * chars) ** 2 * n).sum() / n.sum()
    model.own = mean.diagonal().copy()
    others = mean + np.where(np.eye(size, dtype=bool), np.inf, 0.0)
    nearest = others.min(axis=0) if size > 1 else -model.floor
    model.limit = model.own + 0.9 * np.maximum(nearest - model.own, 0.2)
    model.sharpness = _sharpness(model, held)
    return model


def _sharpness(model: Model, held: dict[str, list[list[str]]]) -> float:
    """The value of a fixed grid under which the calibration texts' languages are likeliest (each text with one miss in 1000 allowed for)."""
    gaps = [e - e[a] for a, lang in enumerate(model.languages) for e in _entropies(model, held[lang])]
    gaps = np.array(gaps)
    grid = [2.0**k for k in range(0, 9)]
    loss = [np.log(0.999 / np.maximum(np.exp(-t * np.maximum(gaps, -50 / t)).sum(axis=1), 1e-300) + 0.001 / len(model.languages)).mean() for t in grid]
    return grid[int(np.argmax(loss))]


class _Words(dict):
    """Word to number; an unknown word gets the next number and waits to be scored."""

    def __init__(self):
        super().__init__()
        self.waiting: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.waiting.append(word)
        return n


class Judge:
    """Scores texts with one model, keeping the scores of words. A word with numerals in it scores as its runs of letters do."""

    def __init__(self, model: Model, most_words: int = 200_000):
        self.model, self.most = model, most_words
        self._clear()

    def _clear(self) -> None:
        self.index = _Words()
        self.table = np.empty((0, len(self.model.languages) + 2))  # scores, characters with a closing space each, number of words

    def _learn(self) -> None:
        words, self.index.waiting = self.index.waiting, []
        if not words:
            return
        parts = [_letters(w) for w in words]
        flat = [p for x in parts for p in x]
        rows = np.zeros((len(flat), self.table.shape[1]))
        for k in range(0, len(flat), 5000):
            rows[k : k + 5000, :-2] = self.model.word_scores(flat[k : k + 5000])
        rows[:, -2], rows[:, -1] = [len(p) + 1 for p in flat], 1
        table = np.zeros((len(words), rows.shape[1]))
        np.add.at(table, np.repeat(np.arange(len(words)), [len(x) for x in parts]), rows)
        self.table = np.concatenate([self.table, table])

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float, float | None, bool]]:
        if len(self.index) > self.most:
            self._clear()
        get = self.index.__getitem__
        places = [np.fromiter(map(get, w), np.int64, len(w)) if t and (w := _WORD.findall(t.lower())) else np.empty(0, np.int64) for t in (texts if self.model.languages else [None] * len(texts))]
        self._learn()
        sums = np.zeros((len(texts), self.table.shape[1]))
        for k, at in enumerate(places):
            if len(at):
                sums[k] = self.table[at].sum(axis=0)
        out = []
        for total in sums:
            if not total[-1]:
                out.append((UNKNOWN, 0.0, None, True))
                continue
            entropy = -total[:-2] / total[-2]
            best = int(entropy.argmin())
            odds = np.exp(-self.model.sharpness * (entropy - entropy[best]))
            error = 6.0 * np.sqrt(self.model.spread[best] * total[-1]) / total[-2]
            limit = max(self.model.limit[best], self.model.own[best] + error)
            out.append((self.model.languages[best], float(1.0 / odds.sum()), float(entropy[best]), bool(entropy[best] > limit)))
        return out


def _identify(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        for batch in batches:
            texts = batch.column("text")
            rows = []
            for at in range(0, len(texts), 300):
                rows += judge(texts[at : at + 300].to_pylist())
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.record_batch([*batch.columns[:-1], *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=[*batch.schema.names[:-1], "lang_pred", "score", "entropy", "rejected"])

    return run


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on at most about ``per_language`` rows (doc_id, lang, text) of each language: those of the lowest hash. Texts are whole, equal rows count once.

    A row is taken if its hash lies in the share that ``per_language`` is of its language; twice that is each language's bound."""
    rows = labelled.where("text is not null and lang is not null").select("lang", "text", F.xxhash64("doc_id", "text").alias("_h"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("_h", 0.02).alias("_n"))  # a row per language
    place = F.shiftrightunsigned("_h", 11) / F.lit(float(1 << 53))  # in [0, 1)
    chosen = rows.join(F.broadcast(sizes), "lang").where(place * F.col("_n") < per_language)
    once = chosen.groupBy("lang", "_h").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_h"))
    sample = once.withColumn("_k", rank).where(F.col("_k") <= 2 * per_language).orderBy("lang", "_k")
    return fit([(r["lang"], r["text"]) for r in sample.select("lang", "text").collect()])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` but text first, then lang_pred, score, entropy (per character) and rejected."""
    keys = [c for c in docs.columns if c not in ("text", "lang_pred", "score", "entropy", "rejected")]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keys).schema)
    return map_arrow(docs.select(*keys, "text"), _identify(model), f"{kinds}, lang_pred string, score double, entropy double, rejected boolean")


def _keep(model: Model, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        for batch in batches:
            texts = batch.column(place)
            keep = [not r[3] for at in range(0, len(texts), 300) for r in judge(texts[at : at + 300].to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def drop_rejected(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text isn't rejected."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_arrow(docs, _keep(model, docs.columns.index("text")), kinds)


def op7_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(F.coalesce(~held_out(F.col("doc_id")), F.lit(False))))
    return identify(docs.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text"), model)
