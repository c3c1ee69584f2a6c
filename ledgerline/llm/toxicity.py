"""Toxicity by a convolutional text classifier.

A word is the sum of hashed embeddings of itself and of its first bytes (four to seven), so that inflected forms share
a stem. Filters over one, two and three words in a row, a rectifier, the maximum over the whole text, and a logistic
unit give the score. Scoring reads every word of every text inside the tasks that read the documents, with the model as a
broadcast variable whose size the parameters fix.

Every labelled row takes part, with its whole text. Four in five, by a hash, are dealt to shards of about ``Training.shard_bytes``. In each
round every shard goes through its rows from the same model, inside a task, and Spark adds up what the shards changed; the new model is the
mean: of an embedding over the shards that met it, of the rest over all. Only these sums, whose size the parameters fix, reach the driver.
They are added as whole numbers, so the model does not depend on which task held which shard. ``train`` does the same to rows in memory.

Only features that at least two training texts share have an embedding; of those of one bucket it is the one in the most texts. A feature keeps
part of its hash beside its bucket, so that a word never seen in training counts as nothing rather than as what happens to share its bucket.

Scores are calibrated on the other labelled rows, all of them, which took no part in training: one scale for all (``Model.cut`` lies at 0.7), and
per language a threshold that serves the column ``flagged`` alone. Language, source, id and label are never inputs
of a score.

Nulls and odd rows: a null or empty text has no words and gets the score of no evidence; labels that are null are not
learned from; a document with several labels is learned from with each; without labelled rows of both kinds every
score is 0; repeated rows are scored each for itself; an empty table gives no rows; other columns are passed on.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.decontamination import _NO_WORD as NO_WORD
from ledgerline.llm.scratch import drop_table, release, stored
from ledgerline.llm.texts import RangeHashes, WordRuns, mixed, slices, sub_batches, utf8

PREFIXES = (4, 5, 6, 7)
N_FEATURES = 1 + len(PREFIXES)
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS) - 1
#: Where the calibrated decision lies.
DECISION = 0.7
#: Windows of which outputs are held at a time in training.
WORDS = 1 << 17
#: One in a sum of changes, and rows of the table in a part of it.
UNIT, PART = 2.0**40, 512
#: Labels up to which they are sent to all tasks.
MOST_BROADCAST = 500_000
#: Of so many labelled rows one calibrates.
FOLDS = 5
#: Steps of a logit that calibration tells apart.
LOGIT_STEPS = 1024


@dataclass(frozen=True)
class Training:
    """Parameters of the model. All labelled rows are learned from, unless a caller asks for at most so many of each label, of at most so many bytes."""

    positives: int | None = None
    negatives: int | None = None
    text_bytes: int | None = None
    #: Bytes of text of a shard.
    shard_bytes: int = 16 << 20
    bucket_bits: int = 17
    dim: int = 16
    filters: int = 8
    epochs: int = 8
    #: A shard of few rows is gone through more often, up to so many steps.
    steps: int = 1500
    batch: int = 32
    rate: float = 0.05
    seed: int = 7


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of every word's features (0 where it has no such feature), and the border of each text's words."""
    runs = WordRuns([t.lower() for t in texts], NO_WORD)
    hashes = RangeHashes(runs.data)
    out = np.zeros((len(runs.starts), N_FEATURES), dtype=np.uint64)
    out[:, 0] = hashes.of(runs.starts, runs.ends)
    length = runs.ends - runs.starts
    for i, n in enumerate(PREFIXES, 1):
        long = np.flatnonzero(length >= n)
        out[long, i] = mixed(hashes.of(runs.starts[long], runs.starts[long] + n) + np.uint64(i))
    return out, np.concatenate(([0], np.cumsum(runs.words)))


@dataclass
class Model:
    """Embeddings by bucket, the part of the hash that a bucket belongs to, filters, and the logistic unit."""

    table: np.ndarray
    owner: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    weights: np.ndarray
    offset: float
    #: Logit that is calibrated to ``DECISION``, and the scale of logits.
    cut: float = 0.0
    scale: float = 1.0
    thresholds: dict[str, float] = field(default_factory=dict)

    @property
    def pad(self) -> int:
        return len(self.table) - 1

    def buckets(self, hashes: np.ndarray) -> np.ndarray:
        """Row of the table of each feature; the last row, which is zero, for what was not seen in training."""
        at = (hashes >> np.uint64(64 - (self.pad.bit_length() - 1))).astype(np.int64)
        seen = (self.owner[at] == (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)) & (hashes != 0)
        return np.where(seen, at, self.pad)

    def padded(self, rows: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows with empty words after each text (an empty text gets one more): rows, first word and end of each text."""
        n = np.maximum(1, np.diff(borders))
        starts = np.concatenate(([0], np.cumsum(n + PAD)[:-1]))
        out = np.full((int((n + PAD).sum()), N_FEATURES), self.pad, dtype=np.int64)
        shift = starts - borders[:-1]
        words = np.arange(len(rows)) + np.repeat(shift, np.diff(borders))
        out[words] = rows
        return out, starts, starts + n

    def windows(self, x: np.ndarray, width: int) -> np.ndarray:
        """Filter outputs for the windows that begin at each row."""
        i = WIDTHS.index(width)
        n = len(x) - PAD
        out = x[:n] @ self.filters[i][0]
        for j in range(1, width):
            out += x[j : n + j] @ self.filters[i][j]
        return out + self.bias[i]

    def embed(self, rows: np.ndarray) -> np.ndarray:
        x = self.table[rows[:, 0]]
        for i in range(1, N_FEATURES):
            x = x + self.table[rows[:, i]]
        return x

    def logits(self, hashes: np.ndarray, borders: np.ndarray) -> np.ndarray:
        rows, starts, ends = self.padded(self.buckets(hashes), borders)
        x = self.embed(rows)
        inside = np.zeros(len(rows), dtype=bool)
        for a, b in zip(starts, ends):
            inside[a:b] = True
        pooled = []
        for width in WIDTHS:
            z = self.windows(x, width)
            z[~inside[: len(z)]] = 0
            pooled.append(np.maximum(np.maximum.reduceat(z, starts, axis=0), 0))
        return np.concatenate(pooled, axis=1) @ self.weights + self.offset

    def scores(self, texts: list[bytes]) -> np.ndarray:
        parts = [np.zeros(0)]
        for a, b in slices(texts, 1 << 18):
            z = (self.logits(*features(texts[a:b])) - self.cut) * self.scale + np.log(DECISION / (1 - DECISION))
            parts.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return np.concatenate(parts)


def _empty(p: Training, seen: np.ndarray, times: np.ndarray) -> Model:
    """A model before training, with a bucket for the features that occur most."""
    rng = np.random.default_rng(p.seed)
    size = 1 << p.bucket_bits
    owner = np.zeros(size, dtype=np.uint32)
    order = np.argsort(times, kind="stable")
    at = (seen[order] >> np.uint64(64 - p.bucket_bits)).astype(np.int64)
    owner[at] = (seen[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)  # the last one, the most frequent, stays
    table = (rng.standard_normal((size + 1, p.dim)) * 0.1).astype(np.float32)
    table[-1] = 0
    filters = [(rng.standard_normal((w, p.dim, p.filters)) * (0.5 / np.sqrt(w))).astype(np.float32) for w in WIDTHS]
    bias = [np.zeros(p.filters, dtype=np.float32) for _ in WIDTHS]
    weights = (rng.standard_normal(len(WIDTHS) * p.filters) * 0.3).astype(np.float32)
    return Model(table, owner, filters, bias, weights, 0.0)


class _Steps:
    """A model in training: Adagrad for the dense parameters and for the rows of the table that a batch touches."""

    def __init__(self, model: Model, rate: float):
        self.model, self.rate = model, rate
        self.dense = [*model.filters, *model.bias, model.weights]
        self.squares = [np.full_like(d, 1e-2) for d in self.dense]
        self.rows = np.full(len(model.table), 1e-2, dtype=np.float32)

    def apply(self, dense: list[np.ndarray], rows: np.ndarray, grads: np.ndarray) -> None:
        for d, s, g in zip(self.dense, self.squares, dense):
            s += g * g
            d -= self.rate * g / np.sqrt(s)
        kept = rows != self.model.pad
        rows, grads = rows[kept], grads[kept]
        if len(rows):
            touched, place = np.unique(rows, return_inverse=True)
            total = np.zeros((len(touched), grads.shape[1]), dtype=np.float32)
            np.add.at(total, place, grads)
            self.rows[touched] += (total * total).mean(axis=1)
            self.model.table[touched] -= self.rate * total / np.sqrt(self.rows[touched])[:, None]

    def flat(self) -> np.ndarray:
        """The dense parameters and their squares, in a row."""
        return np.concatenate([*[d.ravel() for d in (*self.dense, *self.squares)], [self.model.offset]]).astype(np.float64)

    def add(self, change: np.ndarray) -> None:
        at = 0
        for d in (*self.dense, *self.squares):
            d += change[at : at + d.size].reshape(d.shape).astype(np.float32)
            at += d.size
        self.model.offset += float(change[at])


@dataclass
class _Shard:
    """Texts as the table rows of each different word, the last of which is the empty word, and the number of each word in that list."""

    entries: np.ndarray
    words: np.ndarray
    borders: np.ndarray
    labels: np.ndarray

    @staticmethod
    def of(model: Model, texts: list[bytes], labels: np.ndarray) -> _Shard:
        parts, numbers, sizes, before = [], [], [], 0
        for a, b in slices(texts, 1 << 20):
            hashes, borders = features(texts[a:b])
            # The hash of a word says which features it has.
            _, first, number = np.unique(hashes[:, 0], return_index=True, return_inverse=True)
            parts.append(model.buckets(hashes[first]).astype(np.int32))
            numbers.append(number + before)
            sizes.append(np.diff(borders))
            before += len(first)
        empty = np.full((1, N_FEATURES), model.pad, dtype=np.int32)
        entries, place = np.unique(np.concatenate([*parts, empty]), axis=0, return_inverse=True)
        words = place.ravel()[np.concatenate(numbers)] if numbers else np.zeros(0)
        # Nothing is larger than the row of the empty word, so it comes last.
        return _Shard(entries, words.astype(np.int32), np.concatenate(([0], np.cumsum(np.concatenate([[], *sizes]), dtype=np.int64))), np.asarray(labels, np.float32))

    def padded(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the words of some texts with empty words after each, and the first and the end of its windows."""
        n = self.borders[texts + 1] - self.borders[texts]
        starts = np.concatenate(([0], np.cumsum(np.maximum(1, n) + PAD)))
        out = np.full(starts[-1], len(self.entries) - 1, dtype=np.int32)
        for t, a, length in zip(texts, starts, n):
            out[a : a + length] = self.words[self.borders[t] : self.borders[t + 1]]
        return out, starts[:-1], starts[:-1] + np.maximum(1, n)


def _pooled(model: Model, entries: np.ndarray, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the largest output of each filter, and where its first window begins; ``WORDS`` windows are held at a time, however long a text is."""
    best = np.full((len(starts), sum(len(b) for b in model.bias)), -np.inf, dtype=np.float32)
    at = np.zeros(best.shape, dtype=np.int64)
    for c in range(0, len(words) - PAD, WORDS):
        x = model.embed(entries[words[c : c + WORDS + PAD]])
        z = np.concatenate([model.windows(x, width) for width in WIDTHS], axis=1)
        for t in range(np.searchsorted(ends, c, side="right"), np.searchsorted(starts, c + WORDS)):
            a, b = max(starts[t], c), min(ends[t], c + WORDS)
            if a < b:
                own = z[a - c : b - c]
                found = own.argmax(axis=0)
                high = np.take_along_axis(own, found[None], axis=0)[0]
                more = high > best[t]
                best[t, more], at[t, more] = high[more], found[more] + a
    return best, at


def _batch(steps: _Steps, shard: _Shard, some: np.ndarray, weight: np.ndarray) -> None:
    """One step of gradient descent; only the windows that won the maximum pass a gradient on."""
    model, y = steps.model, shard.labels[some]
    words, starts, ends = shard.padded(some)
    best, won = _pooled(model, shard.entries, words, starts, ends)
    h = np.maximum(best, 0)
    logit = h @ model.weights + model.offset
    d = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) * weight / weight.sum()).astype(np.float32)
    dh = d[:, None] * model.weights * (h > 0)
    dfilters, dbias, touched, grads = [], [], [], []
    n = len(model.bias[0])
    for i, width in enumerate(WIDTHS):
        part, first = dh[:, i * n : (i + 1) * n], won[:, i * n : (i + 1) * n]
        g = np.zeros_like(model.filters[i])
        for j in range(width):
            rows = shard.entries[words[(first + j).ravel()]]
            g[j] = np.einsum("dfe,df->ef", model.embed(rows).reshape(*first.shape, -1), part)
            touched.append(rows)
            grads.append((part[:, :, None] * model.filters[i][j].T[None]).reshape(-1, model.table.shape[1]))
        dfilters.append(g)
        dbias.append(part.sum(axis=0))
    model.offset -= steps.rate * float(d.sum())
    grad = np.concatenate(grads)
    steps.apply([*dfilters, *dbias, (h * d[:, None]).sum(axis=0)], np.concatenate(touched).ravel(), np.repeat(grad, N_FEATURES, axis=0))


def _pass(steps: _Steps, shard: _Shard, p: Training, balance: tuple[float, float], seed: list[int]) -> None:
    """Go through the texts of a shard once; ``balance`` weighs texts of label 0 and 1."""
    order = np.random.default_rng(seed).permutation(len(shard.labels))
    weight = np.where(shard.labels > 0, balance[1], balance[0]).astype(np.float32)
    for i in range(0, len(order), p.batch):
        some = order[i : i + p.batch]
        _batch(steps, shard, some, weight[some])


def _rounds(p: Training, rows: int) -> int:
    return max(p.epochs, p.steps * p.batch // max(p.steps, rows))


def _balance(labels: int, toxic: int) -> tuple[float, float]:
    return labels / (2 * (labels - toxic)), labels / (2 * toxic)


class _Changes:
    """Sums of what shards changed, as whole numbers, which add up alike in any order.

    Of each row of the table: the change, that of its squares, and how many shards met it; of the rest the change.
    """

    def __init__(self, steps: _Steps):
        size, dim = steps.model.table.shape
        self.table, self.dense, self.shards = np.zeros((size, dim + 2), dtype=np.int64), np.zeros(len(steps.flat()), dtype=np.int64), 0

    def add(self, before: _Steps, after: _Steps) -> None:
        met = np.flatnonzero(after.rows != before.rows)
        change = np.column_stack((after.model.table[met] - before.model.table[met], after.rows[met] - before.rows[met])).astype(np.float64)
        self.table[met, :-1] += np.rint(change * UNIT).astype(np.int64)
        self.table[met, -1] += 1
        self.dense += np.rint((after.flat() - before.flat()) * UNIT).astype(np.int64)
        self.shards += 1

    def parts(self) -> pa.RecordBatch:
        """``part, sums``: the table in parts of ``PART`` rows, and the rest as the part below zero."""
        numbers = [-1, *range(-(-len(self.table) // PART))]
        sums = [np.append(self.dense, self.shards), *(self.table[i * PART : (i + 1) * PART] for i in numbers[1:])]
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array([v.tobytes() for v in sums], pa.binary())], names=["part", "sums"])

    def take(self, parts: pa.Table) -> None:
        for i, v in zip(parts["part"].to_pylist(), parts["sums"].to_pylist()):
            v = np.frombuffer(v, dtype=np.int64)
            if i < 0:
                self.dense, self.shards = v[:-1], int(v[-1])
            else:
                self.table[i * PART : (i + 1) * PART] = v.reshape(-1, self.table.shape[1])

    def apply(self, steps: _Steps) -> None:
        met = np.flatnonzero(self.table[:, -1])
        mean = (self.table[met, :-1] / self.table[met, -1:] / UNIT).astype(np.float32)
        steps.model.table[met] += mean[:, :-1]
        steps.rows[met] += mean[:, -1]
        steps.add(self.dense / (self.shards * UNIT))


def _added(parts: pa.Table) -> pa.Table:
    """One part's sums over all tasks."""
    sums = np.sum([np.frombuffer(v, dtype=np.int64) for v in parts["sums"].to_pylist()], axis=0)
    return pa.table([parts["part"].slice(0, 1), pa.array([sums.tobytes()], pa.binary())], names=["part", "sums"])


def _best_cut(logits: np.ndarray, y: np.ndarray) -> float:
    """The logit with the best F1 on calibration rows: midway between the neighbours on both sides."""
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    at = int(np.flatnonzero(f1 == f1.max())[-1])
    below = logits[order[at + 1]] if at + 1 < len(y) else logits[order[at]] - 1
    return float((logits[order[at]] + below) / 2)


def _shared_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features in at least two texts (told apart by 24 bits of their hash), and in how many."""
    counts = np.zeros(1 << 24, dtype=np.uint16)

    def own(text: bytes) -> np.ndarray:
        found = np.unique(features([text])[0])
        return found[found != 0]

    for text in texts:
        at = np.unique(own(text) >> np.uint64(40)).astype(np.int64)
        counts[at] += 1
    seen = np.zeros(0, dtype=np.uint64)
    for a, b in slices(texts, 1 << 18):
        found = np.unique(features(texts[a:b])[0])
        seen = np.union1d(seen, found[(counts[(found >> np.uint64(40)).astype(np.int64)] >= 2) & (found != 0)])
    return seen, counts[(seen >> np.uint64(40)).astype(np.int64)]


def _scaled(logit: float) -> float:
    """Score of a logit counted from the cut."""
    return float(1 / (1 + np.exp(-np.clip(logit + np.log(DECISION / (1 - DECISION)), -30, 30))))


def train(texts: list[bytes], labels: np.ndarray, langs: list[str], p: Training = Training()) -> Model | None:
    """A calibrated model of rows in memory, or None if they do not have both labels. Every fifth row only calibrates."""
    labels = np.asarray(labels, dtype=np.float32)
    if not 0 < labels.sum() < len(labels):
        return None
    order = np.random.default_rng(p.seed).permutation(len(texts))
    calibrate, learn = order[::FOLDS], order[np.arange(len(order)) % FOLDS != 0]
    learned = [texts[i] for i in learn]
    steps = _Steps(_empty(p, *_shared_features(learned)), p.rate)
    model = steps.model
    shard = _Shard.of(model, learned, labels[learn])
    for i in range(_rounds(p, len(learn))):
        _pass(steps, shard, p, _balance(len(labels), int(labels.sum())), [p.seed, i])
    logits = np.concatenate([model.logits(*features(texts[a:b])) for a, b in slices(texts, 1 << 18)])
    held = calibrate if 0 < labels[calibrate].sum() < len(calibrate) else order
    model.cut = _best_cut(logits[held], labels[held])
    for lang in sorted({langs[i] for i in held if langs[i] is not None}):
        own = np.array([i for i in held if langs[i] == lang])
        if 0 < labels[own].sum() < len(own):
            model.thresholds[lang] = _scaled(_best_cut(logits[own], labels[own]) - model.cut)
    return model


def sample(rows: DataFrame, p: Training, label: str) -> DataFrame:
    """If ``p`` has bounds, of each label the rows with the smallest hash of ``id`` and ``td``, up to the bounds; else all rows."""
    if p.text_bytes is not None:
        rows = rows.filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= p.text_bytes)
    parts = []
    for y, most in ((1, p.positives), (0, p.negatives)):
        own = rows.filter(F.col(label) == y)
        parts.append(own if most is None else own.orderBy(F.xxhash64("id", "td"), "id", "td").limit(most))
    return rows if p.positives is None and p.negatives is None else parts[0].unionByName(parts[1])


def _vocabulary(rows: DataFrame, p: Training) -> tuple[np.ndarray, np.ndarray]:
    """What ``_shared_features`` gives, for all rows, but only the feature of each bucket that is in the most texts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sub_batches(batch, "text", 4 << 20):
                texts, found = utf8(part.column("text")), [np.zeros(0, dtype=np.uint64)]
                for a, b in slices(texts, 1 << 18):
                    hashes, borders = features(texts[a:b])
                    found += [np.unique(hashes[i:j]) for i, j in zip(borders, borders[1:])]
                feature, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(feature.view(np.int64)), pa.array(n.astype(np.int64))], names=["feature", "n"])

    counts = rows.select("text").mapInArrow(task, "feature bigint, n bigint").filter("feature <> 0").groupBy("feature").agg(F.sum("n").alias("n"))
    bucket = F.shiftrightunsigned("feature", 64 - p.bucket_bits)
    most = counts.filter("n >= 2").groupBy(bucket.alias("bucket")).agg(F.max(F.struct("n", "feature")).alias("most"))
    # One row a bucket.
    got = most.select("most.n", "most.feature").toArrow()
    return got["feature"].to_numpy().view(np.uint64), got["n"].to_numpy()


def _shards(rows: DataFrame, model: Model, n: int) -> DataFrame:
    """``shard, entries, words, borders, labels``: one row a shard, to which its rows are dealt by their hash."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("id", "ascending"), ("td", "ascending"), ("y", "ascending")])
        shard = _Shard.of(shared.value, utf8(group["text"]), group["y"].to_numpy())
        parts = [pa.array([v.tobytes()], pa.binary()) for v in (shard.entries, shard.words, shard.borders, shard.labels)]
        return pa.table([group["shard"].slice(0, 1), *parts], names=["shard", "entries", "words", "borders", "labels"])

    dealt = F.pmod(F.xxhash64("td", "id"), F.lit(n)).alias("shard")
    # Only the order of the ids matters.
    named = rows.select(dealt, F.xxhash64("id").alias("id"), "td", "y", "text")
    packed = named.groupBy("shard").applyInArrow(pack, "shard bigint, entries binary, words binary, borders binary, labels binary")
    return stored(packed, "shards")


def _round(shards: DataFrame, steps: _Steps, p: Training, balance: tuple[float, float], passes: range) -> None:
    """These passes of every shard from the same model, which becomes their mean."""
    shared = shards.sparkSession.sparkContext.broadcast(steps)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        changes = None
        for batch in batches:
            for row in range(batch.num_rows):
                number, *own = (batch.column(c)[row].as_py() for c in ("shard", "entries", "words", "borders", "labels"))
                entries, words, borders, labels = (np.frombuffer(v, dtype=t) for v, t in zip(own, (np.int32, np.int32, np.int64, np.float32)))
                after = copy.deepcopy(shared.value)
                for i in passes:
                    _pass(after, _Shard(entries.reshape(-1, N_FEATURES), words, borders, labels), p, balance, [p.seed, i, number])
                changes = changes or _Changes(after)
                changes.add(shared.value, after)
        if changes:
            yield changes.parts()

    parts = shards.mapInArrow(task, "part int, sums binary").groupBy("part").applyInArrow(_added, "part int, sums binary")
    changes = _Changes(steps)
    changes.take(parts.toArrow())
    changes.apply(steps)
    shared.destroy()
    release(shards.sparkSession)


def _calibrate(rows: DataFrame, model: Model) -> None:
    """Set the cut with the best F1 on all rows, and a threshold per language: midway between the neighbours on both sides, as ``_best_cut``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sub_batches(batch, "text"):
                texts = utf8(part.column("text"))
                logits = np.concatenate([shared.value.logits(*features(texts[a:b])) for a, b in slices(texts, 1 << 18)])
                steps = pa.array(np.rint(logits * LOGIT_STEPS).astype(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("y"), steps], names=["lang", "y", "z"])

    found = rows.select("text", "lang", "y").mapInArrow(task, "lang string, y int, z bigint")
    # Rows by steps of the logit, so that a window holds as many rows as there are steps at most.
    own = found.groupBy("lang", "z").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("hits"))
    own = stored(own, "logits")
    whole = own.groupBy("z").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    both = own.filter("lang IS NOT NULL").select(F.lit(False).alias("all"), "lang", "z", "n", "hits")
    both = both.unionByName(whole.select(F.lit(True).alias("all"), F.lit(None).cast("string").alias("lang"), "z", "n", "hits"))
    each, down = Window.partitionBy("all", "lang"), Window.partitionBy("all", "lang").orderBy(F.desc("z"))
    running = both.select(
        "all", "lang", "z", F.lead("z").over(down).alias("below"), F.sum("n").over(down).alias("taken"), F.sum("hits").over(down).alias("caught"),
        F.sum("n").over(each).alias("rows"), F.sum("hits").over(each).alias("toxic"),
    )
    f1 = 2 * F.col("caught") / (F.col("taken") + F.col("toxic"))
    best = F.max(F.struct(f1.alias("f1"), (-F.col("z")).alias("last"), F.coalesce("below", F.col("z") - LOGIT_STEPS).alias("below")))
    cuts = running.filter("toxic > 0 AND toxic < rows").groupBy("all", "lang").agg(best.alias("best"))
    # One row a language.
    got = {(r["all"], r["lang"]): (r.best.below - r.best.last) / (2 * LOGIT_STEPS) for r in cuts.collect()}
    drop_table(own)
    model.cut = got.pop((True, None))
    model.thresholds = {lang: _scaled(cut - model.cut) for (_, lang), cut in sorted(got.items())}


def fit(
    docs: DataFrame, labels: DataFrame, may_learn: Column, p: Training = Training(), key: str = "doc_id", text: str = "text", lang: str = "lang", label: str = "toxic"
) -> Model | None:
    """Train on all labelled documents for which ``may_learn`` holds, and calibrate; see the module."""
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).filter("y IN (0, 1)")
    named = docs.filter(may_learn).select(F.col(key).alias("id"), F.xxhash64(text).alias("td"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    # Few labels are sent to the texts; many, and the texts, are shuffled.
    known = F.broadcast(known) if known.count() <= MOST_BROADCAST else known
    rows = sample(named.join(known, F.col("id") == F.col("k")).drop("k"), p, "y")
    rows = stored(rows.withColumn("learns", F.pmod(F.xxhash64("id", "td"), F.lit(FOLDS)) > 0), "labelled")
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)
    counts = {(r.learns, r.y): (r.n, r.size) for r in rows.groupBy("learns", "y").agg(F.count(F.lit(1)).alias("n"), size.alias("size")).collect()}
    n, toxic = sum(c for c, _ in counts.values()), sum(c for (_, y), (c, _) in counts.items() if y)
    if not 0 < toxic < n:
        drop_table(rows)
        return None
    # Where a part does not have both labels, it is all rows.
    learn, held = (rows.filter(F.col("learns") == side) if {(side, 0), (side, 1)} <= counts.keys() else rows for side in (True, False))
    own = [c for (side, _), c in counts.items() if side or learn is rows]
    steps = _Steps(_empty(p, *_vocabulary(learn, p)), p.rate)
    n_shards = max(1, round(sum(size for _, size in own) / p.shard_bytes))
    shards = _shards(learn, steps.model, n_shards)
    passes = range(_rounds(p, sum(c for c, _ in own) // n_shards))
    # A single shard has no other to meet between its passes.
    for some in [passes] if n_shards == 1 else [range(i, i + 1) for i in passes]:
        _round(shards, steps, p, _balance(n, toxic), some)
    _calibrate(held, steps.model)
    drop_table(shards)
    drop_table(rows)
    return steps.model


def score(docs: DataFrame, model: Model | None, text: str = "text", lang: str = "lang", name: str = "score") -> DataFrame:
    """``docs`` with the score of every row and, by the threshold of its language, ``flagged``."""
    if model is None:
        return docs.withColumn(name, F.lit(0.0)).withColumn("flagged", F.lit(False))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = [name, "flagged"]
    kept = [f for f in docs.schema.fields if f.name not in added]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = model.scores(utf8(batch.column(text)))
            limits = [model.thresholds.get(v, DECISION) for v in batch.column(lang).to_pylist()]
            own = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(found, pa.float64()), pa.array(found >= np.array(limits), pa.bool_())], names=[*[f.name for f in kept], *added]
            )

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], f"`{name}` double", "flagged boolean"])
    return docs.mapInArrow(task, schema)
