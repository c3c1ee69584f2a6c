"""Distributed merge sort of byte strings that carries common prefixes along.

Each task sorts its strings into runs, stores of every string only what differs from the one before (front coding), and
cuts the runs at splitters. The tasks that receive the pieces of one range merge them with a loser tree whose players know
how much they share with the last winner: two players are compared only from the prefix that both are known to share.
The length of the prefix that neighbours in the final order share thus comes out of the merge.

``neighbours`` returns for every item what it shares with the item before it and the item after it. Items are pairs of
byte strings without the byte 0xFF, ordered by the first and then the second.

A range holds about ``range_bytes`` of strings. Equal strings never meet in more than one row per task: callers pass
each string once, or with few copies. Nulls do not occur; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.scratch import stored

#: Ends the first part of a key. Not a byte of UTF-8 text.
BETWEEN = b"\xff"


def common_prefix(x: bytes, y: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to agree."""
    n = min(len(x), len(y))
    at, step = known, 32
    while at < n and x[at : at + step] == y[at : at + step]:
        at += step
        step *= 2
    if at >= n:
        return n
    low, high = at, min(n, at + step)
    while high - low > 1:
        middle = (low + high) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle
    return low if x[low] != y[low] else min(n, low + 1)


def front_code(strings: Iterable[bytes]) -> tuple[list[int], list[bytes]]:
    """Prefix shared with the string before, and the rest, of each string of a sorted run."""
    shared, rests, last = [], [], b""
    for s in strings:
        n = common_prefix(last, s)
        shared.append(n)
        rests.append(s[n:])
        last = s
    return shared, rests


def front_decode(pieces: Iterable[tuple]) -> Iterator[tuple[int, bytes, tuple]]:
    """``(prefix shared with the one before, string, item)`` of a run given by its pieces in turn."""
    before = b""
    for shared, rests, items in pieces:
        last = b""
        for i, (n, rest) in enumerate(zip(shared, rests)):
            last = last[:n] + rest
            yield n if i else common_prefix(before, last), last, items[i]
        before = last


class LoserTree:
    """Merges runs; a player is the head of a run, with the prefix that it shares with the last winner it met."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes, tuple]]]):
        self.runs = runs
        self.size = 1 << max(0, len(runs) - 1).bit_length()
        self.heads: list[bytes | None] = [None] * self.size
        self.items: list[tuple | None] = [None] * self.size
        self.shared = [0] * self.size
        self.losers = [0] * self.size
        for i in range(len(runs)):
            self._next(i)
        winners = [*([0] * self.size), *range(self.size)]
        for node in range(self.size - 1, 0, -1):
            winners[node], self.losers[node] = self._play(winners[2 * node], winners[2 * node + 1])
        self.winner = winners[1] if self.size > 1 else 0

    def _next(self, run: int) -> None:
        found = next(self.runs[run], None) if run < len(self.runs) else None
        if found is None:
            self.heads[run] = None
        else:
            self.shared[run], self.heads[run], self.items[run] = found

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser. The one that shares more with the last winner is the smaller one."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if self.shared[a] != self.shared[b]:
            return (a, b) if self.shared[a] > self.shared[b] else (b, a)
        n = common_prefix(x, y, self.shared[a])
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            self.shared[b] = n
            return a, b
        self.shared[a] = n
        return b, a

    def __iter__(self) -> Iterator[tuple[int, bytes, tuple]]:
        while (head := self.heads[self.winner]) is not None:
            run = self.winner
            yield self.shared[run], head, self.items[run]
            self._next(run)
            node = (run + self.size) // 2
            while node:
                run, self.losers[node] = self._play(run, self.losers[node])
                node //= 2
            self.winner = run


# --- runs ------------------------------------------------------------------------------------------------------

_RUN = "range bigint, run bigint, piece bigint, shared binary, rests array<binary>, g binary, c binary, o binary"
_PIECE_BYTES = 1 << 20


def _runs(items: DataFrame, splitters: list[bytes], run_bytes: int) -> DataFrame:
    """Sorted, front-coded and cut runs of each task."""
    cuts = items.sparkSession.sparkContext.broadcast(splitters)

    def sorted_run(rows: list[tuple], run: int) -> Iterator[pa.RecordBatch]:
        rows.sort(key=lambda r: r[0])
        part: list[tuple] = []
        at, piece, held = -1, 0, 0

        def emit() -> pa.RecordBatch:
            shared, rests = front_code(r[0] for r in part)
            columns = [np.array([r[i] for r in part], dtype=np.int64).tobytes() for i in (1, 2, 3)]
            return pa.RecordBatch.from_arrays(
                [
                    *[pa.array([v], pa.int64()) for v in (at, run, piece)],
                    pa.array([np.array(shared, dtype=np.int32).tobytes()], pa.binary()),
                    pa.array([rests], pa.list_(pa.binary())),
                    *[pa.array([c], pa.binary()) for c in columns],
                ],
                names=["range", "run", "piece", "shared", "rests", "g", "c", "o"],
            )

        for row in rows:
            target = bisect_right(cuts.value, row[0])
            if part and (target != at or held > _PIECE_BYTES):
                yield emit()
                piece = piece + 1 if target == at else 0
                part, held = [], 0
            at = target
            part.append(row)
            held += len(row[0])
        if part:
            yield emit()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 24
        rows: list[tuple] = []
        held = run = 0
        for batch in batches:
            got = zip(*(batch.column(n).to_pylist() for n in ("k", "g", "c", "o")))
            for row in got:
                rows.append(row)
                held += len(row[0])
                if held > run_bytes:
                    yield from sorted_run(rows, first + run)
                    rows, held, run = [], 0, run + 1
        yield from sorted_run(rows, first + run)

    return items.select("k", "g", "c", "o").mapInArrow(task, _RUN)


def _decoded(rows: list[dict]) -> list[Iterator[tuple[int, bytes, tuple]]]:
    """The runs of one range."""
    by_run: dict[int, list[dict]] = {}
    for row in sorted(rows, key=lambda r: (r["run"], r["piece"])):
        by_run.setdefault(row["run"], []).append(row)

    def pieces(own: list[dict]) -> Iterator[tuple]:
        for row in own:
            ids = [np.frombuffer(row[n], dtype=np.int64).tolist() for n in ("g", "c", "o")]
            yield np.frombuffer(row["shared"], dtype=np.int32).tolist(), row["rests"], list(zip(*ids))

    return [front_decode(pieces(own)) for own in by_run.values()]


def _parts_shared(shared: int, x: bytes, y: bytes) -> tuple[int, int]:
    """What two keys share of the first part and of the second, given what the keys share."""
    first = x.index(BETWEEN)
    if shared > first:
        return first, shared - first - 1
    other = y.index(BETWEEN)
    return min(shared, first, other), common_prefix(x[first + 1 :], y[other + 1 :])


_OUT = "g bigint, c bigint, o bigint, first bigint, second bigint, range bigint, last boolean, k binary"
_OUT_TYPES = [*[pa.int64()] * 6, pa.bool_(), pa.binary()]
_OUT_NAMES = ["g", "c", "o", "first", "second", "range", "last", "k"]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs of each range; the rows of a range come one after the other."""

    def merge(at: int, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        before = None
        for shared, key, item in LoserTree(_decoded(rows)):
            if before is None:
                out.append((*item, None, None, at, False, key))
            else:
                both = _parts_shared(shared, before[0], key)
                out.append((*before[1], *both, None, None, None))
                out.append((*item, *both, None, None, None))
            before = key, item
            if len(out) >= 8192:
                yield as_batch(out)
                out = []
        if before is not None:
            out.append((*before[1], None, None, at, True, before[0]))
            yield as_batch(out)

    def as_batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _OUT_TYPES)], names=_OUT_NAMES)

    at, held = None, []
    for batch in batches:
        # Row by row: one row may hold a megabyte of strings.
        for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
            if row["range"] != at and held:
                yield from merge(at, held)
                held = []
            at = row["range"]
            held.append(row)
    if held:
        yield from merge(at, held)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the last item of a range and the first of the next one share."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            both = _parts_shared(common_prefix(r["k0"], r["k"]), r["k0"], r["k"])
            out += [(r["g0"], r["c0"], r["o0"], *both), (r["g"], r["c"], r["o"], *both)]
        columns = list(zip(*out)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_OUT_NAMES[:5])


def neighbours(items: DataFrame, range_bytes: int = 8 << 20) -> DataFrame:
    """``g, c, o, first, second``: two rows per pair of neighbours in the order of the keys, one for each of them.

    ``items`` has the key ``k`` (first part, 0xFF, second part) and three numbers that name the item; it is read three
    times, so it should be a stored table. First and second say how many bytes of those parts the pair shares.
    """
    total, rows = items.agg(F.sum(F.octet_length("k")), F.count(F.lit(1))).first()
    ranges = max(1, int((total or 0) // range_bytes))
    splitters: list[bytes] = []
    if ranges > 1:
        # About sixteen sampled keys a range, cut to a bounded length.
        share = min(1.0, 16 * ranges / rows)
        some = items.filter(F.pmod(F.xxhash64("g", "c", "o"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        keys = sorted(bytes(r[0]) for r in some.select(F.substring("k", 1, 256)).toLocalIterator())
        splitters = [keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else []
    runs = _runs(items, splitters, run_bytes=16 << 20)
    placed = runs.repartition(ranges, "range").sortWithinPartitions("range", "run", "piece")
    merged = stored(placed.mapInArrow(_merged, _OUT), "merged")
    inside = merged.filter(F.col("first").isNotNull()).select("g", "c", "o", "first", "second")
    # One row per range: the last item of the range before beside its first.
    order = W.orderBy("range")
    edge = merged.filter(F.col("range").isNotNull())
    lasts = edge.filter("last").select("range", F.struct("g", "c", "o", "k").alias("l"))
    firsts = edge.filter("NOT last").select(F.col("range").alias("r"), "g", "c", "o", "k")
    edges = lasts.join(firsts, F.col("range") == F.col("r")).withColumn("l0", F.lag("l").over(order)).filter("l0 IS NOT NULL")
    pairs = edges.select("g", "c", "o", "k", F.col("l0.g").alias("g0"), F.col("l0.c").alias("c0"), F.col("l0.o").alias("o0"), F.col("l0.k").alias("k0"))
    return inside.unionByName(pairs.mapInArrow(_across, "g bigint, c bigint, o bigint, first bigint, second bigint"))
