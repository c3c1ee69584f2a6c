"""Removal of every byte that lies in a long string which also starts elsewhere.

Texts are UTF-8 bytes; a string of ``length`` bytes is repeated if it starts at two places of any texts, and every byte of
every repeated string goes, judged on the input.

A sparse suffix array is enough. Every string of ``length`` bytes names one place in it, its anchor: the least hash of its
grams of ``GRAM`` bytes, the first of several. Equal strings have their anchors at the same offset, so only places that are
anchors need to be sorted, each with what lies between the first and the last byte of the strings that name it (its context).

1. Anchors whose gram of ``GRAM`` bytes from the anchor on occurs once can't be in a repeated string; they are dropped by counts.
2. Equal contexts are taken together, with how many there are, before any bytes move.
3. The different contexts are merge-sorted (``suffix_merge``) by what follows the anchor, and again by what precedes
   it, read backwards. Two neighbours that share r bytes after and l bytes before share all strings that begin
   between ``length - r`` and l bytes before the anchor.
4. What the best r and l of a context over all others still leave open (its best partners in both directions are not one
   and the same) is settled by a third sort of the strings themselves, after counts by hash as in step 1.

Three passes over the texts compute anchors anew rather than keep them. A bit set of fixed size, with one bit per hash of
what is wanted, lets the later ones leave out most of the rest before the join that decides. A table goes, and with it the
shuffle files of its making, as soon as the steps that read it are done.

Nulls and odd rows: a null text is the empty text; texts shorter than ``length`` keep all their bytes and hold no
repeated string; rows that share key and text are copies of each other; a null key is a key; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.scratch import drop_table, release, stored
from ledgerline.llm.suffix_merge import BETWEEN, neighbours
from ledgerline.llm.texts import PrimeRangeHashes, RangeHashes, mixed, sub_batches, utf8

GRAM = 32
#: Bytes of text whose anchors are found at a time.
_PIECE = 1 << 18
#: Bits of the sets that thin out later passes: 8 MB.
_SET_BITS = 26
_PLACE = "h bigint, lo bigint, hi bigint, a bigint, g bigint, c bigint"
_PLACE_NAMES = ["h", "lo", "hi", "a", "g", "c"]


def _gram(length: int) -> int:
    return max(1, min(GRAM, length // 8))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    padded = padded.reshape(-1, width)
    from_left = np.minimum.accumulate(padded, axis=1).ravel()
    from_right = np.ascontiguousarray(np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1]).ravel()
    n = len(keys) - width + 1
    return np.minimum(from_right[:n], from_left[width - 1 : width - 1 + n])


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Texts in groups of about ``_PIECE`` bytes: which text, where in it, and the bytes. Long texts are cut with an overlap."""
    group: list[tuple[int, int, bytes]] = []
    held = 0
    for i, text in enumerate(texts):
        for at in range(0, max(0, len(text) - length + 1), _PIECE):
            part = text[at : at + _PIECE + length - 1]
            group.append((i, at, part))
            held += len(part)
            if held >= _PIECE:
                yield group
                group, held = [], 0
    if group:
        yield group


def anchors(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Per group of pieces: text, first and last string start, anchor (places in the text), gram hash, context hash."""
    gram = _gram(length)
    width = length - gram + 1
    for group in _pieces(texts, length):
        data = np.frombuffer(b"".join(part for _, _, part in group), dtype=np.uint8)
        sizes = np.array([len(part) for _, _, part in group])
        firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        spots = np.arange(len(data) - gram + 1)
        low = max(24, len(data).bit_length())
        # Grams only choose places; contexts are taken for equal if their hashes are.
        grams = RangeHashes(data).of(spots, spots + gram)
        keys = (grams >> np.uint64(low) << np.uint64(low)) | spots.astype(np.uint64)
        least = (_least(keys, width) & np.uint64((1 << low) - 1)).astype(np.int64)
        within = np.zeros(len(data) + 1, dtype=np.int8)
        within[firsts] += 1
        within[firsts + sizes - length + 1] -= 1
        starts = np.flatnonzero(np.cumsum(within[: len(least)]) > 0)
        named = least[starts]
        new = np.flatnonzero((np.diff(named) != 0) | (np.diff(starts) != 1)) + 1
        first, last = np.concatenate(([0], new)), np.concatenate((new - 1, [len(starts) - 1]))
        lo, hi, a = starts[first], starts[last], named[first]
        piece = np.searchsorted(firsts, lo, side="right") - 1
        context = PrimeRangeHashes(data).of(lo, hi + length)
        context = mixed(context + mixed(((a - lo) * (length + 1) + (hi - a + length)).astype(np.uint64)))
        shift = np.array([at for _, at, _ in group])[piece] - firsts[piece]
        yield np.array([i for i, _, _ in group])[piece], lo + shift, hi + shift, a + shift, grams[a], context


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``h, text``: every row's name and its text."""
    return docs.select(F.xxhash64(F.col(key), F.col(text)).alias("h"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def _bit(h: np.ndarray) -> np.ndarray:
    return (mixed(h.view(np.uint64)) >> np.uint64(64 - _SET_BITS)).astype(np.int64)


def _bit_set(rows: DataFrame, *columns: str):
    """A broadcast bit set of the hashes in a column, or of places ``h, lo``; none is missing.

    At most two to the ``_SET_BITS - 6`` numbers are collected, whatever the number of rows.
    """

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            at = np.unique(_bit(own[0] if len(own) == 1 else _place_hash(*own)))
            words, place = np.unique(at >> 6, return_inverse=True)
            masks = np.zeros(len(words), dtype=np.uint64)
            np.bitwise_or.at(masks, place, np.uint64(1) << (at & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array(masks.view(np.int64))], names=["word", "mask"])

    words = rows.select(*columns).mapInArrow(bits, "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    got = words.toArrow()
    out = np.zeros(1 << (_SET_BITS - 6), dtype=np.uint64)
    out[got["word"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
    return rows.sparkSession.sparkContext.broadcast(out)


def _in_set(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _bit(h)
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def _place_hash(h: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return mixed(h.view(np.uint64) + mixed(lo.astype(np.uint64))).view(np.int64)


def _found(batch: pa.RecordBatch, length: int) -> Iterator[tuple[list[bytes], np.ndarray, tuple[np.ndarray, ...]]]:
    """The anchors of a batch of ``h, text``: texts, which text each is in, and the columns of ``_PLACE``."""
    for part in sub_batches(batch, "text"):
        names = part.column("h").to_numpy(zero_copy_only=False)
        texts = utf8(part.column("text"))
        for text, lo, hi, a, g, c in anchors(texts, length):
            yield texts, text, (names[text], lo, hi, a, g.view(np.int64), c.view(np.int64))


def _all_grams(texts: DataFrame, length: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, place in _found(batch, length):
                yield pa.RecordBatch.from_arrays([pa.array(place[4])], names=["g"])

    return texts.mapInArrow(task, "g bigint")


def _places(texts: DataFrame, length: int, grams) -> DataFrame:
    """Places of anchors whose gram is in a bit set."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, place in _found(batch, length):
                keep = _in_set(grams.value, place[4])
                yield pa.RecordBatch.from_arrays([pa.array(x[keep], pa.int64()) for x in place], names=_PLACE_NAMES)

    return texts.mapInArrow(task, _PLACE)


def _contexts(texts: DataFrame, length: int, wanted) -> DataFrame:
    """``g, c, o, k``: what follows the anchor, 0xFF, and what precedes it backwards, for the places in a bit set."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for own, text, (h, lo, hi, a, g, c) in _found(batch, length):
                near = np.flatnonzero(_in_set(wanted.value, _place_hash(h, lo)))
                # Rows that repeat a text, and other places that fall on the same bits, add a context once per task.
                names = list(zip(g[near].tolist(), c[near].tolist()))
                new = [i for i, name in enumerate(names) if not (name in seen or seen.add(name))]
                keep, keys = near[new], []
                for i in keep:
                    content = own[text[i]]
                    keys.append(content[a[i] : hi[i] + length] + BETWEEN + content[lo[i] : a[i]][::-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g[keep]), pa.array(c[keep]), pa.array(np.full(len(keep), -1)), pa.array(keys, pa.binary())], names=["g", "c", "o", "k"]
                )

    return texts.mapInArrow(task, "g bigint, c bigint, o bigint, k binary")


def _swapped(contexts: DataFrame, grams) -> DataFrame:
    """The contexts whose gram is in a bit set, with what precedes the anchor first."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_in_set(grams.value, batch.column("g").to_numpy(zero_copy_only=False))))
            keys = []
            for k in batch.column("k").to_pylist():
                after, _, before = k.partition(BETWEEN)
                keys.append(before + BETWEEN + after)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in ("g", "c", "o")], pa.array(keys, pa.binary())], names=["g", "c", "o", "k"])

    return contexts.select("g", "c", "o", "k").mapInArrow(task, "g bigint, c bigint, o bigint, k binary")


def _asked(contexts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Contexts with the offsets of the strings that are asked for."""
    named = wanted.withColumnsRenamed({"g": "wg", "c": "wc"})
    return contexts.join(named, (F.col("g") == F.col("wg")) & (F.col("c") == F.col("wc"))).drop("wg", "wc")


def _string_hashes(contexts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``g, c, o, own, s``: hashes of single strings; ``wanted`` has ``g, c, offsets`` and in ``own`` those not settled."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, c, k, offsets, own in zip(*(batch.column(n).to_pylist() for n in ("g", "c", "k", "offsets", "own"))):
                after, _, before = k.partition(BETWEEN)
                at = len(before) - np.array(offsets, dtype=np.int64)
                s = PrimeRangeHashes(np.frombuffer(before[::-1] + after, dtype=np.uint8)).of(at, at + length)
                mine = np.isin(offsets, own) if own else np.zeros(len(offsets), dtype=bool)
                n = len(offsets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * n, pa.int64()), pa.array([c] * n, pa.int64()), pa.array(offsets, pa.int64()), pa.array(mine), pa.array(s.view(np.int64))],
                    names=["g", "c", "o", "own", "s"],
                )

    met = _asked(contexts, wanted).select("g", "c", "k", "offsets", "own")
    return met.mapInArrow(task, "g bigint, c bigint, o bigint, own boolean, s bigint")


def _kept(df: DataFrame, name: str, *done: DataFrame) -> DataFrame:
    """``df`` as a table; those that ``done`` read are dropped, as nothing needs them any more."""
    table = stored(df, name)
    for old in done:
        drop_table(old)
    release(table.sparkSession)
    return table


def _worth_sorting(hashes: DataFrame) -> DataFrame:
    """``g, c, offsets`` of the strings not settled that have a partner by hash, with one partner each."""
    by = ["g", "o", "s"]
    groups = hashes.groupBy(*by).agg(
        F.count_if("own").alias("n_own"), F.count(F.lit(1)).alias("n"), F.min(F.when(~F.col("own"), F.col("c"))).alias("partner")
    )
    groups = stored(groups.filter((F.col("n_own") > 0) & (F.col("n") > 1)).select(*by, "partner"), "string-groups")
    kept = hashes.join(groups, by).filter(F.col("own") | (F.col("c") == F.col("partner")))
    return kept.groupBy("g", "c").agg(F.collect_set("o").alias("offsets"))


def _strings(contexts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``g, c, o, k``: the single strings of some contexts; ``wanted`` has ``g, c, offsets``."""
    met = _asked(contexts, wanted).select("g", "c", "k", "offsets")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for g, c, k, offsets in zip(*(batch.column(n).to_pylist() for n in ("g", "c", "k", "offsets"))):
                after, _, before = k.partition(BETWEEN)
                whole = before[::-1] + after
                for o in offsets:
                    at = len(before) - o
                    out.append((g, c, o, whole[at : at + length] + BETWEEN))
            columns = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x, pa.int64()) for x in columns[:3]], pa.array(columns[3], pa.binary())], names=["g", "c", "o", "k"]
            )

    return met.mapInArrow(task, "g bigint, c bigint, o bigint, k binary")


def _best(shared: DataFrame, length: int) -> DataFrame:
    """``g, c, r, l, spans``: the most that each context shares on either side, and the strings that it shares with neighbours."""
    both = F.when(F.col("r") + F.col("l") >= length, F.struct((F.lit(length) - F.col("r")).alias("lo"), F.col("l").alias("hi")))
    return shared.groupBy("g", "c").agg(F.max("r").alias("r"), F.max("l").alias("l"), F.collect_set(both).alias("spans"))


def _undecided(classes: DataFrame, best: DataFrame, length: int) -> DataFrame:
    """Contexts that occur once and may share strings beyond those known, going by what follows the anchor alone."""
    once = classes.filter("n = 1").join(best.withColumnsRenamed({"g": "kg", "c": "kc"}), (F.col("g") == F.col("kg")) & (F.col("c") == F.col("kc")))
    from_o = F.greatest(F.col("least"), F.lit(length) - F.col("r"))
    some = once.withColumn("from_o", from_o).filter(F.col("from_o") <= F.col("most"))
    # Neighbours' strings end at what precedes the anchor in both, so the last one alone tells.
    return some.filter(~F.expr("exists(spans, s -> most BETWEEN s.lo AND s.hi AND s.lo <= from_o)"))


def repeated_places(docs: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``h, start, end`` of stretches of repeated strings, which may overlap, as a table; ``h`` names rows as ``_texts`` does."""
    texts = _texts(docs, key, text)
    ids = ["g", "c"]
    twice = _all_grams(texts, length).groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("g")
    twice = _kept(twice, "grams")
    places = _kept(_places(texts, length, _bit_set(twice, "g")).join(twice, "g", "left_semi").select(*_PLACE_NAMES), "places", twice)
    # One place of each context, how many there are, and the offsets of its strings from the anchor.
    one = F.min(F.struct("h", "lo", "hi", "a"))
    classes = places.groupBy(*ids).agg(F.count(F.lit(1)).alias("n"), one.alias("p"))
    classes = classes.select(
        *ids, "n", F.col("p.h").alias("h"), F.col("p.lo").alias("lo"), (F.col("p.a") - F.col("p.hi")).alias("least"), (F.col("p.a") - F.col("p.lo")).alias("most")
    )
    classes = _kept(classes, "classes")

    contexts = _kept(_contexts(texts, length, _bit_set(classes, "h", "lo")), "contexts")
    found = neighbours(contexts)
    after = _kept(found.select(*ids, F.col("first").alias("r"), F.col("second").alias("l")), "after", found)
    # The second order is needed only where the first one leaves strings open.
    open_grams = _undecided(classes, _best(after, length), length).select("g").distinct()
    back = _kept(_swapped(contexts, _bit_set(open_grams, "g")), "contexts-back")
    before = neighbours(back).select(*ids, F.col("second").alias("r"), F.col("first").alias("l"))
    shared = _kept(after.unionByName(before), "shared", after, before, back)
    known = _best(shared, length).withColumnsRenamed({"g": "kg", "c": "kc"})
    many = F.col("n") > 1
    whole = F.array(F.struct(F.col("least").alias("lo"), F.col("most").alias("hi")))
    no_span = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    judged = classes.join(known, (F.col("g") == F.col("kg")) & (F.col("c") == F.col("kc")), "left").select(
        *ids,
        "n",
        F.when(many, F.col("least")).otherwise(F.greatest(F.col("least"), F.lit(length) - F.coalesce("r", F.lit(0)))).alias("from_o"),
        F.when(many, F.col("most")).otherwise(F.least(F.col("most"), F.coalesce("l", F.lit(-1)))).alias("to_o"),
        F.when(many, whole).otherwise(F.coalesce("spans", no_span)).alias("spans"),
    )
    judged = _kept(judged, "judged", classes, shared)
    open_o = F.expr("filter(sequence(from_o, to_o), o -> NOT exists(spans, s -> o BETWEEN s.lo AND s.hi))")
    may = judged.filter(F.col("from_o") <= F.col("to_o"))
    own = F.when(F.col("n") == 1, open_o).otherwise(F.array().cast("array<bigint>"))
    may = stored(may.select(*ids, "from_o", "to_o", own.alias("own")), "may-match")
    unsettled = may.select("g", F.explode("own").alias("o")).distinct().groupBy("g").agg(F.collect_set("o").alias("os"))
    asked = may.join(stored(unsettled, "unsettled"), "g").select(
        *ids, "own", F.expr("filter(os, o -> o BETWEEN from_o AND to_o)").alias("offsets")
    )
    # The plan of ``asked`` reads all that it is made of.
    asked = _kept(asked.filter(F.size("offsets") > 0), "asked", asked)
    hashes = _kept(_string_hashes(contexts, asked, length), "string-hashes", asked)
    worth = _worth_sorting(hashes)
    strings = _kept(_strings(contexts, worth, length), "strings", worth, contexts)
    equal = neighbours(strings).filter(F.col("first") >= length)
    single = equal.select(*ids, F.array(F.struct(F.col("o").alias("lo"), F.col("o").alias("hi"))).alias("spans"))
    spans = judged.select(*ids, "spans").unionByName(single).filter(F.size("spans") > 0)
    spans = spans.select(*ids, F.explode("spans").alias("s")).distinct().groupBy(*ids).agg(F.collect_list("s").alias("spans"))
    spans = _kept(spans.select(F.col("g").alias("sg"), F.col("c").alias("sc"), "spans"), "spans", judged, equal, strings)
    hit = places.join(spans, (F.col("g") == F.col("sg")) & (F.col("c") == F.col("sc")))
    hit = hit.select("h", "a", F.explode("spans").alias("s"))
    hit = hit.select("h", (F.col("a") - F.col("s.hi")).alias("start"), (F.col("a") - F.col("s.lo") + length).alias("end"))
    return _kept(hit, "repeated", places, spans)


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching stretches made one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[new], ends[np.concatenate((new[1:], [True]))]


def remove_repeats(docs: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept`` of every row; ``kept`` holds the remaining bytes, joined."""
    places = repeated_places(docs, length, key, text)
    per_row = places.groupBy("h").agg(F.collect_set(F.struct("start", "end")).alias("cut"))
    per_row = _kept(per_row.select(F.col("h").alias("ch"), "cut"), "cuts", places)
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(key), F.col(text)).alias("h"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cuts = _bit_set(per_row, "ch")
    kind = docs.schema[key].dataType.simpleString()
    out = f"key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    names = ["key", "n_bytes", "n_removed", "n_spans", "kept"]

    def touched(inside: bool):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = _in_set(cuts.value, batch.column("h").to_numpy(zero_copy_only=False))
                yield batch.filter(pa.array(hit if inside else ~hit))

        return task

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in sub_batches(whole, "text")):
            sizes, removed, spans, kept = [], [], [], []
            for content, own in zip(utf8(batch.column("text")), batch.column("cut").to_pylist()):
                starts, ends = np.array([(s["start"], s["end"]) for s in own or []], dtype=np.int64).reshape(-1, 2).T
                if len(starts):
                    starts, ends = merged_spans(starts, ends)
                edges = [0, *np.stack([starts, ends], axis=1).ravel().tolist(), len(content)]
                kept.append(b"".join([content[a:b] for a, b in zip(edges[::2], edges[1::2])]))
                sizes.append(len(content))
                removed.append(int((ends - starts).sum()))
                spans.append(len(starts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *[pa.array(x, pa.int64()) for x in (sizes, removed, spans)], pa.array(kept, pa.binary())], names=names
            )

    schema = f"key {kind}, h bigint, text string"
    some = rows.mapInArrow(touched(True), schema).join(per_row, F.col("h") == F.col("ch"), "left").select("key", "text", "cut")
    rest = rows.mapInArrow(touched(False), schema).select(
        "key",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"),
        F.encode("text", "UTF-8").alias("kept"),
    )
    return some.mapInArrow(cut, out).unionByName(rest).withColumnRenamed("key", key)
