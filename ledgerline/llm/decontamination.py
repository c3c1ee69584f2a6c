"""Benchmark decontamination: rare n-gram seeds find passages, Smith-Waterman alignment scores them.

Words are runs of ASCII letters and digits and of bytes from 0x80 on, A-Z lowered, so marks and line breaks do not
matter. Seeds are the five-word shingles of the benchmark items. A passage is a stretch of a document around seeds that
lie within one item's length of each other, with that much room on both sides. Passages and items that share any seed, however frequent, are aligned word by word (match 2, mismatch and gap -1), unless the
passage holds too few of the item's words to reach ``least_score``; the score is that of the best local alignment over twice
the words of the item, 1 for an exact copy. Passages of the same words are one content, which is joined and aligned once, however many
documents hold it. Seeds in more than ``common`` contents are joined apart, by a broadcast of them if they are at most ``most_broadcast``
rows, so that none of them fills a task; more of them are left to a shuffle, whose crowded keys Spark splits.

The benchmark is tested to be small before its seeds go to every task (``most_seeds``); a larger one makes every document a
passage and joins them by shuffles. Everything after the scan is joins on seeds, of which a document has few.

Nulls and odd rows: a null text has no words; items of fewer than five words have no seed and are never found; equal items
are found each for itself; rows that share a key are judged by their best passage together; rows with a null key are
found under the null key; an empty table on either side gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.scratch import stored
from ledgerline.llm.texts import PrimeRangeHashes, WordRuns, mixed, slices, utf8

SEED_WORDS = 5
MATCH, MISMATCH, GAP = 2, -1, -1

_NO_WORD = np.ones(256, dtype=bool)
_NO_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in turn, and the border of each text's words."""
    runs = WordRuns([t.lower() for t in texts], _NO_WORD)
    hashes = PrimeRangeHashes(runs.data).of(runs.starts, runs.ends)
    return hashes, np.concatenate(([0], np.cumsum(runs.words)))


def seed_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of the five words from each place on (of one text or several in a row)."""
    n = max(0, len(words) - SEED_WORDS + 1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(SEED_WORDS):
        out = mixed(out + words[i : i + n])
    return out


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Score of the best local alignment, and how many words of the passage lie up to its end."""
    steps = np.arange(len(passage) + 1) * -GAP
    row = np.zeros(len(passage) + 1, dtype=np.int64)
    best, end = 0, 0
    for word in item:
        below = row + GAP
        below[1:] = np.maximum(below[1:], row[:-1] + np.where(passage == word, MATCH, MISMATCH))
        row = np.maximum.accumulate(np.maximum(below, 0) + steps) - steps
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def _item_rows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """``item, words`` with the word hashes of every item."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            words, borders = word_hashes(texts)
            lists = [words[a:b].view(np.int64) for a, b in zip(borders[:-1], borders[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(lists, pa.list_(pa.int64()))], ["item", "words"])

    kind = benchmark.schema[item].dataType.simpleString()
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).dropDuplicates()
    return rows.mapInArrow(task, f"item {kind}, words array<bigint>")


def _item_seeds(items: DataFrame) -> DataFrame:
    """``seed, item, place`` of every item."""
    kind = items.schema["item"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lists = batch.column("item").to_pylist(), batch.column("words").to_pylist()
            for key, words in zip(keys, lists):
                seeds = seed_hashes(np.array(words, dtype=np.int64).view(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seeds), pa.array([key] * len(seeds), batch.schema.field("item").type), pa.array(np.arange(len(seeds)))],
                    names=["seed", "item", "place"],
                )

    return items.mapInArrow(task, f"seed bigint, item {kind}, place bigint")


def _stretches(places: np.ndarray, n_words: int, reach: int) -> list[tuple[int, int]]:
    """Stretches of words around seeds, as word borders."""
    cuts = np.flatnonzero(np.diff(places) > reach) + 1
    return [
        (max(0, int(part[0]) - reach), min(n_words, int(part[-1]) + SEED_WORDS + reach)) for part in np.split(places, cuts)
    ]


def passages(docs: DataFrame, key: str, text: str, seeds, reach: int) -> DataFrame:
    """``key, first_word, content, words, seeds`` for each stretch of a document that holds a seed; ``content`` is a digest of the words.

    ``seeds`` is a broadcast sorted array, or None: then each document with a seed's length is one passage.
    """
    kind = docs.schema[key].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if seeds is None else seeds.value
        for batch in batches:
            keys, texts = batch.column("key").to_pylist(), utf8(batch.column("text"))
            for a, b in slices(texts, 1 << 20):
                words, borders = word_hashes(texts[a:b])
                found = seed_hashes(words)
                hit = np.ones(len(found), dtype=bool)
                if wanted is not None:
                    at = np.minimum(np.searchsorted(wanted, found), max(0, len(wanted) - 1))
                    hit = wanted[at] == found if len(wanted) else np.zeros(len(found), dtype=bool)
                out: list[tuple] = []
                spots = np.flatnonzero(hit)
                for doc in np.unique(np.searchsorted(borders, spots, side="right") - 1):
                    lo, hi = int(borders[doc]), int(borders[doc + 1])
                    own = spots[(spots >= lo) & (spots <= hi - SEED_WORDS)] - lo
                    if not len(own):
                        continue
                    parts = _stretches(own, hi - lo, reach) if wanted is not None else [(0, hi - lo)]
                    for first, last in parts:
                        inside = own[(own >= first) & (own <= last - SEED_WORDS)] + lo
                        own_words = words[lo + first : lo + last].view(np.int64)
                        content = hashlib.blake2b(own_words.tobytes(), digest_size=16).digest()
                        out.append((keys[a + doc], first, content, own_words, np.unique(found[inside]).view(np.int64)))
                if out:
                    k, f, c, w, s = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(k, batch.schema.field("key").type),
                            pa.array(f, pa.int64()),
                            pa.array(c, pa.binary()),
                            pa.array(w, pa.list_(pa.int64())),
                            pa.array(s, pa.list_(pa.int64())),
                        ],
                        names=["key", "first_word", "content", "words", "seeds"],
                    )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(task, f"key {kind}, first_word bigint, content binary, words array<bigint>, seeds array<bigint>")


def _met(seeds: DataFrame, holders: DataFrame, common: int, most_broadcast: int) -> DataFrame:
    """``content, item`` of all that share a seed, each once."""
    df = holders.groupBy("seed").agg(F.count(F.lit(1)).alias("df"))
    counted = stored(seeds.select("seed", "item").distinct().join(df, "seed"), "seed-counts")
    few = counted.filter(F.col("df") <= common).select("seed", "item")
    many = counted.filter(F.col("df") > common).select("seed", "item")
    many = F.broadcast(many) if many.count() <= most_broadcast else many
    pairs = holders.join(few, "seed").select("content", "item").unionByName(holders.join(many, "seed").select("content", "item"))
    return pairs.distinct()


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The rows of a column of lists of numbers, as views of its one buffer."""
    edges, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(edges[:-1], edges[1:])]


def _scored(pairs: DataFrame, item_kind: str, least_score: float) -> DataFrame:
    """The pairs' scores and the words of the passage that the alignment takes, without those that can't reach ``least_score``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for i, (a, b) in enumerate(zip(_lists(batch.column("item_words")), _lists(batch.column("words")))):
                # No alignment matches more words of the item than the passage holds.
                if np.isin(a, b).sum() / len(a) < least_score:
                    continue
                score, end = align(a, b)
                _, back = align(a[::-1], b[:end][::-1])
                rows.append((i, score / (MATCH * len(a)), end - back, end))
            at, scores, firsts, ends = zip(*rows) if rows else [()] * 4
            own = batch.select(["content", "item"]).take(pa.array(at, pa.int64()))
            found = [pa.array(scores, pa.float64()), pa.array(firsts, pa.int64()), pa.array(ends, pa.int64())]
            yield pa.RecordBatch.from_arrays([*own.columns, *found], names=["content", "item", "score", "from_word", "to_word"])

    schema = f"content binary, item {item_kind}, score double, from_word bigint, to_word bigint"
    return pairs.select("content", "item", "item_words", "words").mapInArrow(task, schema)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    least_score: float = 0.6,
    common: int = 1000,
    most_seeds: int = 1_000_000,
    most_broadcast: int = 200_000,
) -> DataFrame:
    """``key, item, score, first_word, end_word``: the best passage of every document for each item that it holds."""
    spark = docs.sparkSession
    items = stored(_item_rows(benchmark, item, item_text), "items")
    longest = items.agg(F.max(F.size("words"))).first()[0] or 0
    seeds = stored(_item_seeds(items), "item-seeds")
    distinct = seeds.select("seed").distinct()
    shared = None
    if distinct.count() <= most_seeds:
        listed = distinct.toPandas()["seed"].to_numpy(dtype=np.int64).view(np.uint64)
        shared = spark.sparkContext.broadcast(np.sort(listed))
    # Up to a quarter more words may have been put in.
    found = passages(docs, key, text, shared, reach=longest + longest // 4 + 1)
    found = stored(found, "passages")
    contents = stored(found.select("content", "words", "seeds").dropDuplicates(["content"]), "contents")
    holders = contents.select("content", F.explode("seeds").alias("seed"))
    pairs = _met(seeds, holders, common, most_broadcast)
    words = items.select(F.col("item").alias("i"), F.col("words").alias("item_words"))
    met = pairs.join(contents.select("content", "words"), "content").join(words, F.col("item").eqNullSafe(F.col("i")))
    scored = _scored(met, benchmark.schema[item].dataType.simpleString(), least_score).filter(F.col("score") >= least_score)
    best = found.select("key", "first_word", "content").join(scored, "content")
    best = best.select("key", "item", "score", (F.col("first_word") + F.col("from_word")).alias("first_word"), (F.col("first_word") + F.col("to_word")).alias("end_word"))
    place = F.struct("score", -F.col("first_word"), -F.col("end_word"))
    top = best.groupBy("key", "item").agg(F.max(place).alias("b"))
    return top.select(
        F.col("key").alias(key), F.col("item").alias(item), "b.score", (-F.col("b.col2")).alias("first_word"), (-F.col("b.col3")).alias("end_word")
    )
