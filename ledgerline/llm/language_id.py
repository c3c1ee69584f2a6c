"""Language of texts and of their parts: script ranges, scores per word, and Viterbi with a switching penalty.

A word is a run of letters and marks of one script. Its script, found by code point ranges, leaves the languages whose training words
use that script; a script that none uses leaves all. Each of these scores the word by hashed n-grams of its lower-case letters
and its borders: the sum of log likelihoods over the orders, divided by their number. Along a text, the best sequence of languages is found by
Viterbi, where each change of language costs ``switch`` nats; runs of one language are spans. A text's language is the one
with the most letters in its spans (ties: the first by name), the score is their share.

Learning takes rows that have text and language: of each language at most ``rows`` different texts of at most ``text_bytes`` bytes, those with
the least hash. Counts are made by one task a language, and only tables of ``2 ** bits`` numbers a language and order come to the driver.

Nulls and odd rows: a null text, one without a letter, and every text where nothing could be learned, is ``und`` with score
0; rows without language teach nothing; texts of any length are labelled whole; repeated rows are
rows like others and teach once; an empty table gives no rows; other columns are passed on by ``label`` unless they are named as a column
that it adds (in any case), which then has the added value.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.scratch import stored
from ledgerline.llm.texts import mixed, sub_batches

UNKNOWN = "und"

# First and last code point of the blocks of each script (The Unicode Standard).
SCRIPTS = {
    "Latin": [(0x0041, 0x024F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "Greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x0400, 0x052F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x0530, 0x058F)],
    "Hebrew": [(0x0590, 0x05FF), (0xFB1D, 0xFB4F)],
    "Arabic": [(0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Devanagari": [(0x0900, 0x097F)],
    "Bengali": [(0x0980, 0x09FF)],
    "Gurmukhi": [(0x0A00, 0x0A7F)],
    "Gujarati": [(0x0A80, 0x0AFF)],
    "Oriya": [(0x0B00, 0x0B7F)],
    "Tamil": [(0x0B80, 0x0BFF)],
    "Telugu": [(0x0C00, 0x0C7F)],
    "Kannada": [(0x0C80, 0x0CFF)],
    "Malayalam": [(0x0D00, 0x0D7F)],
    "Sinhala": [(0x0D80, 0x0DFF)],
    "Thai": [(0x0E00, 0x0E7F)],
    "Lao": [(0x0E80, 0x0EFF)],
    "Tibetan": [(0x0F00, 0x0FFF)],
    "Myanmar": [(0x1000, 0x109F)],
    "Georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)],
    "Ethiopic": [(0x1200, 0x139F)],
    "Khmer": [(0x1780, 0x17FF)],
    "Kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "Han": [(0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)],
}


@dataclass(frozen=True)
class Settings:
    """``share``: the part of a language's letters that a script must have to be one of its scripts."""

    rows: int = 1500
    text_bytes: int = 16_000
    orders: tuple[int, ...] = (2, 3, 4)
    bits: int = 15
    smoothing: float = 0.05
    share: float = 0.005
    switch: float = 12.0


@dataclass(frozen=True)
class Model:
    """``scores``: per order a table of log likelihoods by bucket and language; ``scripts``: which script each language uses."""

    languages: tuple[str, ...]
    scores: np.ndarray
    scripts: np.ndarray
    settings: Settings


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every code point: lower case (where that is one code point), 1 for letters and 2 for marks, and the script."""
    size = 0x110000
    lower = np.arange(size, dtype=np.uint32)
    kind = np.zeros(size, dtype=np.uint8)
    for i in (*range(0xD800), *range(0xE000, 0x31350)):
        c = chr(i)
        if c.isalpha():
            kind[i] = 1
            low = c.lower()
            if len(low) == 1:
                lower[i] = ord(low)
        elif unicodedata.category(c)[0] == "M":
            kind[i] = 2
    script = np.zeros(size, dtype=np.uint8)
    for n, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            script[first : last + 1] = n
    return lower, kind, script


class Words:
    """Words of several texts at once: places in ``code``, number of letters, script, and which text each is in."""

    def __init__(self, texts: list[str]):
        lower, kind, script = _tables()
        # A line feed before, between and after: every word has a border on both sides.
        joined = "\n" + "\n".join(texts) + "\n"
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.firsts = np.concatenate(([1], 1 + np.cumsum(lengths + 1)))[: len(texts)]
        kinds, scripts = kind[code], script[code]
        inside = kinds > 0
        # Marks have the script of what they stand on.
        scripts = scripts[np.maximum.accumulate(np.where(kinds != 2, np.arange(len(code)), 0))]
        change = np.zeros(len(code), dtype=bool)
        change[1:] = (scripts[1:] != scripts[:-1]) & (kinds[1:] == 1)
        starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])) | inside & change)
        ends = np.flatnonzero(~inside[1:] & inside[:-1]) + 1
        if len(starts) > len(ends):
            cut = starts[np.concatenate(([False], inside[starts[1:] - 1]))]
            ends = np.sort(np.concatenate((ends, cut)))
        letters = np.concatenate(([0], np.cumsum(kinds == 1)))
        self.letters = letters[ends] - letters[starts]
        keep = self.letters > 0
        self.starts, self.ends, self.letters = starts[keep], ends[keep], self.letters[keep]
        self.code = np.where(inside, lower[code], 0).astype(np.uint64)
        self.script = scripts[self.starts]
        self.text = np.searchsorted(self.firsts, self.starts, side="right") - 1
        self.count = len(texts)

    def grams(self, orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the n-grams that begin at each place from a word's left border on, one row an order (-1: none), and where words begin."""
        spans = self.ends - self.starts + 1
        at = np.concatenate(([0], np.cumsum(spans)[:-1])) if len(spans) else np.zeros(0, np.int64)
        place = np.arange(int(spans.sum())) - np.repeat(at - self.starts + 1, spans)
        end = np.repeat(self.ends, spans)
        out = np.empty((len(orders), len(place)), dtype=np.int32)
        padded = np.concatenate((self.code, np.zeros(max(orders), np.uint64)))
        first = np.repeat(self.starts, spans)
        for row, n in enumerate(orders):
            h = np.zeros(len(place), dtype=np.uint64)
            for i in range(n):
                # Beyond the word's own letters there is a border, also where the next word follows at once.
                where = place + i
                c = padded[where]
                c[(where < first) | (where >= end)] = 0
                h = h * np.uint64(0x9E3779B97F4A7C15) + c + np.uint64(1)
            out[row] = (mixed(h) >> np.uint64(64 - bits)).astype(np.int32)
            out[row][place + n - 1 > end] = -1
        return out, at


def counts(texts: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """How often each bucket of each order, and each script by letters, occurs."""
    size = 1 << settings.bits
    grams, scripts = np.zeros((len(settings.orders), size), dtype=np.int64), np.zeros(len(SCRIPTS) + 1, dtype=np.int64)
    for text in texts:
        words = Words([text])
        found, _ = words.grams(settings.orders, settings.bits)
        for row, buckets in enumerate(found):
            grams[row] += np.bincount(buckets[buckets >= 0], minlength=size)
        scripts += np.bincount(words.script, weights=words.letters, minlength=len(SCRIPTS) + 1).astype(np.int64)
    return grams, scripts


def training_rows(docs: DataFrame, text: str, language: str, settings: Settings) -> DataFrame:
    """``lang, text``: of each language the different texts with the least hash."""
    rows = docs.select(F.col(language).alias("lang"), F.col(text).alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & (F.octet_length("text") <= settings.text_bytes) & F.col("text").rlike(r"\p{L}"))
    hashed = rows.withColumn("h", F.xxhash64("text"))
    # The hashes alone are ranked; the texts follow by what each language's last hash is.
    order = Window.partitionBy("lang").orderBy("h")
    ranked = hashed.select("lang", "h").distinct().withColumn("r", F.row_number().over(order)).filter(F.col("r") <= settings.rows)
    last = stored(ranked.groupBy(F.col("lang").alias("l")).agg(F.max("h").alias("last")), "language-bounds")
    chosen = hashed.join(last, (F.col("lang") == F.col("l")) & (F.col("h") <= F.col("last")))
    return chosen.groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")


def learn(docs: DataFrame, text: str = "text", language: str = "lang", settings: Settings = Settings()) -> Model:
    """The model of all languages that occur."""

    def count(table: pa.Table) -> pa.Table:
        grams, scripts = counts(table["text"].to_pylist(), settings)
        return pa.table({"lang": table["lang"][:1].cast(pa.string()), "grams": [grams.astype("<i8").tobytes()], "scripts": [scripts.astype("<i8").tobytes()]})

    rows = training_rows(docs, text, language, settings)
    found = sorted(rows.groupBy("lang").applyInArrow(count, "lang string, grams binary, scripts binary").collect())
    languages = tuple(r.lang for r in found)
    size = 1 << settings.bits
    if not languages:
        return Model((), np.zeros((len(settings.orders), size, 0), np.float32), np.zeros((0, len(SCRIPTS) + 1), bool), settings)
    grams = np.stack([np.frombuffer(r.grams, "<i8").reshape(len(settings.orders), size) for r in found], axis=2)
    smooth = grams + settings.smoothing
    scores = np.log(smooth / smooth.sum(axis=1, keepdims=True)) / len(settings.orders)
    letters = np.stack([np.frombuffer(r.scripts, "<i8") for r in found])
    scripts = letters >= np.maximum(1, settings.share * letters.sum(axis=1, keepdims=True))
    return Model(languages, scores.astype(np.float32), scripts, settings)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """Score of each word in each language, 0 for the best; languages without the word's script are far below."""
    grams, at = words.grams(model.settings.orders, model.settings.bits)
    total = np.zeros((grams.shape[1], len(model.languages)), dtype=np.float32)
    for row, buckets in enumerate(grams):
        known = model.scores[row][buckets]
        known[buckets < 0] = 0
        total += known
    summed = np.add.reduceat(total, at, axis=0).astype(np.float64)
    uses = model.scripts[:, words.script].T
    uses = np.where(uses.any(axis=1)[:, None], uses, True)
    summed[~uses] -= 1000.0
    return summed - summed.max(axis=1, keepdims=True)


def best_path(scores: np.ndarray, firsts: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """The best language of each word; texts are the runs of ``lengths`` words from ``firsts`` on, all taken a step at a time."""
    state = np.zeros(len(scores), dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    firsts, lengths = firsts[order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    # How many texts have more than t words.
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    best = np.zeros((int(active[0]) if steps else 0, scores.shape[1]))
    moved, origin = np.zeros(scores.shape, dtype=bool), np.zeros(len(scores), dtype=np.int64)
    for t in range(steps):
        k, at = active[t], firsts[: active[t]] + t
        now = best[:k]
        if t:
            top = now.argmax(axis=1)
            jump = now[np.arange(k), top][:, None] - switch
            moved[at], origin[at] = jump > now, top
            np.maximum(now, jump, out=now)
        now += scores[at]
    last = best.argmax(axis=1) if steps else None
    for t in range(steps - 1, -1, -1):
        k, at = active[t], firsts[: active[t]] + t
        state[at] = last[:k]
        if t:
            last[:k] = np.where(moved[at, last[:k]], origin[at], last[:k])
    return state


def label_texts(texts: list[str], model: Model) -> tuple[list[str], list[float], list[list[tuple[int, int, str]]]]:
    """Language, score and spans (first and last character, exclusive, and language) of each text."""
    words = Words(texts)
    names, n_languages = model.languages, len(model.languages)
    if not names or not len(words.starts):
        return [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
    lengths = np.bincount(words.text, minlength=len(texts))
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    path = best_path(word_scores(words, model), firsts, lengths, model.settings.switch)
    share = np.bincount(words.text * n_languages + path, weights=words.letters, minlength=len(texts) * n_languages).reshape(-1, n_languages)
    letters, best = share.sum(axis=1), share.argmax(axis=1)
    first = np.ones(len(path), dtype=bool)
    first[1:] = (path[1:] != path[:-1]) | (words.text[1:] != words.text[:-1])
    runs = np.flatnonzero(first)
    ends = words.ends[np.concatenate((runs[1:], [len(path)])) - 1]
    spans: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    of_run = words.text[runs]
    for i, a, b, s in zip(of_run.tolist(), (words.starts[runs] - words.firsts[of_run]).tolist(), (ends - words.firsts[of_run]).tolist(), path[runs].tolist()):
        spans[i].append((a, b, names[s]))
    known = letters > 0
    predicted = [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
    scores = np.where(known, share.max(axis=1) / np.maximum(letters, 1), 0.0)
    return predicted, scores.tolist(), spans


ADDED = ("lang_pred", "score", "spans")


def label(docs: DataFrame, model: Model, text: str = "text", spans: bool = False) -> DataFrame:
    """``docs`` without ``text``, with ``lang_pred`` and ``score``, and on demand the ``spans`` of each language."""
    model_of = docs.sparkSession.sparkContext.broadcast(model)
    added = ADDED[: 2 + spans]
    passed = [f for f in docs.schema.fields if f.name.lower() not in added and f.name != text]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sub_batches(batch, "__text", 2 << 20):
                texts = [t or "" for t in part.column("__text").to_pylist()]
                predicted, scores, found = label_texts(texts, model_of.value)
                columns = [*part.columns[:-1], pa.array(predicted, pa.string()), pa.array(scores, pa.float64())]
                if spans:
                    columns.append(pa.array([[dict(zip(("start", "end", "lang"), s)) for s in one] for one in found], span))
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-1], *added])

    # Columns go by number, so that no name clashes with one of the operator.
    rows = docs.select(*[docs[_quoted(f.name)].alias(f"c{i}") for i, f in enumerate(passed)], docs[_quoted(text)].alias("__text"))
    kinds = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(passed)]
    schema = ", ".join([*kinds, "lang_pred string", "score double", *["spans array<struct<start: bigint, `end`: bigint, lang: string>>"] * spans])
    out = rows.mapInArrow(task, schema)
    return out.toDF(*[f.name for f in passed], *added)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def held_out(key: Column, parts: int = 5, part: int = 0) -> Column:
    """Rows on which the model is judged; a null key is one to learn from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))
