"""Quality rules: a ledger of measurements and failure bits, and policies that read only the ledger.

Every rule is evaluated once per document. Its verdict is one bit of ``failed``; the measurements stay beside
it. A policy is a versioned set of rules: applying one, comparing several, and asking what each rule alone is
responsible for are bitwise operations over the ledger, without another look at a text.

Nulls and odd rows: a null text has no words and fails ``few_words``; an empty table gives an empty ledger;
repeated rows are measured and kept each for itself; other columns of the input are passed on unchanged, and one
with the name of a ledger column is replaced by the ledger's. A null measurement never occurs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.texts import IS_SEPARATOR, PrimeRangeHashes, WordRuns, mixed, slices, utf8

#: Characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_echo_words")

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True


@dataclass(frozen=True)
class Rule:
    """A named rule: the bit that it owns for good, and what makes a document fail it."""

    name: str
    bit: int
    fails: str


#: The rules in the order of their bits. A changed rule gets a new bit, so that old ledgers keep their meaning.
RULES = (
    Rule("few_words", 0, "n_words < 10"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words"),
    Rule("repeated_lines", 3, "n_lines > 0 AND 2 * n_dup_lines > n_lines"),
    Rule("short_words", 4, "n_words > 0 AND word_chars < 2 * n_words"),
    Rule("long_words", 5, "n_words > 0 AND word_chars > 20 * n_words"),
    Rule("echoed_words", 6, "10 * n_echo_words > 3 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules; a document that fails any of them is rejected."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in RULES}
        return sum(1 << bits[name] for name in set(self.rules))


BASE = Policy("base-1", ("few_words", "repeated_windows"))
STANDARD = Policy("standard-1", tuple(r.name for r in RULES))


def _echoed_words(runs: WordRuns, words: np.ndarray, n_texts: int) -> np.ndarray:
    """Per text, how many words equal the word just before them."""
    same = (words[1:] == words[:-1]) & (runs.doc[1:] == runs.doc[:-1])
    return np.bincount(runs.doc[1:][same], minlength=n_texts)


def _repeated_words(runs: WordRuns, words: np.ndarray, n_texts: int) -> np.ndarray:
    """Per text, how many words lie in windows of five words found more than once in that text."""
    n = len(runs.starts) - WINDOW + 1
    if n < 2:
        return np.zeros(n_texts, dtype=np.int64)
    keys = np.zeros(n, dtype=np.uint64)
    for i in range(WINDOW):
        keys = mixed(keys + words[i : i + n])
    keys = mixed(keys + runs.doc[:n].astype(np.uint64))
    whole = np.flatnonzero(runs.doc[:n] == runs.doc[WINDOW - 1 :])
    keys = keys[whole]
    ordered = np.sort(keys)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return np.zeros(n_texts, dtype=np.int64)
    at = np.minimum(np.searchsorted(again, keys), len(again) - 1)
    first = whole[again[at] == keys]
    edges = np.zeros(len(runs.starts) + 1, dtype=np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, first + WINDOW, -1)
    covered = np.cumsum(edges[:-1]) > 0
    return np.bincount(runs.doc[covered], minlength=n_texts)


def _measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    runs = WordRuns(texts)
    words = PrimeRangeHashes(runs.data).of(runs.starts, runs.ends)
    code_points = ((runs.data & 0xC0) != 0x80) & ~IS_SEPARATOR[runs.data]
    lines, again = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        filled = [line for line in text.split(b"\n") if line.strip()]
        lines[i], again[i] = len(filled), len(filled) - len(set(filled))
    return {
        "n_words": runs.words,
        "word_chars": runs.per_text(code_points),
        "n_symbols": runs.per_text(_IS_SYMBOL[runs.data]),
        "n_dup_lines": again,
        "n_repeat_words": _repeated_words(runs, words, len(texts)),
        "n_lines": lines,
        "n_echo_words": _echoed_words(runs, words, len(texts)),
    }


def _measured(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch.column(text))
        parts = [_measure(texts[a:b]) for a, b in slices(texts, 1 << 20)]
        columns = [
            pa.array(np.concatenate([p[m] for p in parts]) if parts else np.zeros(0, np.int64), pa.int64())
            for m in MEASURES
        ]
        kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name.lower() not in MEASURES]
        names = [name for name in batch.schema.names if name.lower() not in MEASURES]
        yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*names, *MEASURES])


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` with the measurements beside them; one pass, no shuffle."""
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name.lower() not in MEASURES]
    schema = ", ".join([*kept, *[f"{m} bigint" for m in MEASURES]])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _measured(batches, text)

    return docs.mapInArrow(task, schema)


def failed_bits(rules: Sequence[Rule] = RULES) -> Column:
    """All verdicts as one number."""
    bits = F.lit(0).cast("bigint")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("bigint"))
    return bits


def build_ledger(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Measurements and ``failed`` of every document."""
    return measure(docs, text).withColumn("failed", failed_bits(rules))


def accepted(policy: Policy, failed: str = "failed") -> Column:
    """Whether a ledger row passes every rule of the policy."""
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("bigint")) == 0


def ablation(ledger: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that only it rejects. One row per rule.

    The ledger is first reduced to one row per combination of bits, of which there are at most two to the number
    of rules.
    """
    combos = ledger.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask).cast("bigint")).alias("bits")).count()
    rules = [r for r in RULES if r.name in policy.rules]
    listed = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("bigint").alias("m")) for r in rules]))
    rows = combos.select("bits", "count", listed.alias("r"))
    return rows.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.m")) != 0, F.col("count")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.m"), F.col("count")).otherwise(0)).alias("n_only_this"),
    ).select(F.lit(policy.version).alias("policy"), "rule", "n_failed", "n_only_this")
