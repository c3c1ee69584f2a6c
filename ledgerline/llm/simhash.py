"""SimHash near-duplicates by multi-index hashing.

A text is lower-cased (A-Z), cut into words at space and U+0009 to U+000D, and its shingles of ``words`` words,
repeats included, vote on each of 64 bits with their XXH64 (seed 42): a bit is set where more than half agree. Two
fingerprints are linked if they differ in at most ``max_bits`` bits; groups are the connected components.

Links are found by segments. The 64 bits are cut into segments; if two fingerprints differ in at most
``max_bits = s * segments + a`` bits, they differ in at most s bits in one of the first a + 1 segments, or in at most
s - 1 bits in one of the others. So each fingerprint looks up every value within that many bits of its own segment in
the table of that segment and compares what it meets in full. Of two different values only the smaller looks up the
larger, so every link is fetched from one side.

Tables hold distinct fingerprints, so copies are one row. A segment value that more than ``bucket`` fingerprints
share is not expanded into pairs: its rows are first linked to one of them, and only if they then still belong to several
components are the rest compared, cut further by the other bits (``_crowded``). Where links must also be similar, they are
tested before components are taken, so no similar link between components is lost.

Nulls and odd rows: a null text is the empty text, with fingerprint zero, linked like any other; fewer words than a
shingle make one shingle of all of them; repeated rows and repeated ids are rows like others; rows with a null
id take part, but name a component only where no other id does; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import connected_components
from ledgerline.llm.scratch import stored
from ledgerline.llm.texts import utf8

BITS = 64
SEED = 42
#: Where a segment's number stands above its value in a key.
_SEGMENT_SHIFT = 40
#: Shingles whose bits are counted at a time.
_BLOCK = 1 << 16


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every shingle as eight big-endian bytes each."""
    from xxhash import xxh64_digest

    found = text.lower().split()
    if not found:
        return np.zeros((0, 8), dtype=np.uint8)
    ends = list(accumulate(map(len, found), lambda at, n: at + 1 + n))
    joined = b" ".join(found)
    starts = [0, *[e + 1 for e in ends[:-1]]]
    last = ends[min(words, len(found)) - 1 :]
    digests = [xxh64_digest(joined[a:b], SEED) for a, b in zip(starts, last)]
    return np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, 8)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have, as a signed number."""
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _BLOCK):
        votes += np.unpackbits(hashes[at : at + _BLOCK], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int, key: str = "doc_id", text: str = "text", sketch: int = 0) -> DataFrame:
    """``key, fp`` of every row; with ``sketch``, also that many of the smallest different shingle hashes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, sketches = [], []
            for content in utf8(batch.column("text")):
                hashes = shingle_hashes(content, words)
                fps.append(fingerprint(hashes))
                if sketch:
                    numbers = np.unique(hashes.reshape(-1).view(">i8").astype(np.int64))
                    sketches.append(numbers[:sketch])
            columns = [batch.column("key"), pa.array(fps, pa.int64())]
            if sketch:
                columns.append(pa.array(sketches, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=["key", "fp", "sketch"][: len(columns)])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, fp bigint" + ", sketch array<bigint>" * bool(sketch)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(task, schema)
    return rows.withColumnRenamed("key", key)


def _differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _segments(segments: int) -> list[tuple[int, int]]:
    """Lowest bit and width of each segment."""
    widths = [BITS // segments + (i < BITS % segments) for i in range(segments)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def _value(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def _masks(width: int, most: int) -> list[int]:
    """All sets of at most ``most`` of ``width`` bits."""
    return [sum(1 << i for i in chosen) for n in range(most + 1) for chosen in combinations(range(width), n)]


def _tables(fps: DataFrame, segments: int) -> DataFrame:
    """``k, b``: the table of each segment; ``k`` is a segment's number above its value."""
    rows = [_key(i, _value(F.col("fp"), low, width)) for i, (low, width) in enumerate(_segments(segments))]
    return fps.select(F.explode(F.array(*rows)).alias("k"), F.col("fp").alias("b"))


def _key(segment: int, value: Column) -> Column:
    return F.lit(segment << _SEGMENT_SHIFT).cast("bigint").bitwiseOR(value)


def _same_value(segments: int, a: Column, b: Column, k: Column) -> Column:
    """Two fingerprints have the same value in the segment that ``k`` is of."""
    segment, differing = F.shiftright(k, _SEGMENT_SHIFT), a.bitwiseXOR(b)
    out = F.lit(False)
    for i, (low, width) in enumerate(_segments(segments)):
        out = F.when(segment == i, _value(differing, low, width) == 0).otherwise(out)
    return out


def _lookups(fps: DataFrame, segments: int, max_bits: int) -> DataFrame:
    """``k, a``: the values that each fingerprint looks up, its own among them."""
    each, extra = divmod(max_bits, segments)
    parts = []
    for i, (low, width) in enumerate(_segments(segments)):
        most = each if i <= extra else each - 1
        if most < 0:
            continue
        masks = F.array(*[F.lit(m).cast("bigint") for m in _masks(width, most)])
        looked = fps.select("fp", _value(F.col("fp"), low, width).alias("mine"), F.explode(masks).alias("mask"))
        value = F.col("mine").bitwiseXOR(F.col("mask"))
        parts.append(
            looked.filter(value >= F.col("mine")).select(_key(i, value).alias("k"), F.col("fp").alias("a"))
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _linked(max_bits: int, segments: int) -> Column:
    """A lookup meets a table row: near enough, and the same value only from one side."""
    own = _same_value(segments, F.col("a"), F.col("b"), F.col("k"))
    return (~own | (F.col("a") < F.col("b"))) & (_differing("a", "b") <= max_bits)


def _crowded(
    lookups: DataFrame,
    tables: DataFrame,
    hot: DataFrame,
    links: DataFrame,
    max_bits: int,
    segments: int,
    verified: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Links that reach every component that the pairs of the ``hot`` values would.

    All rows of a hot value are compared with its smallest fingerprint, which takes one comparison a row. Rows that
    are then still in another component than some row of their value are compared with each other where they
    also agree on one of ``max_bits + 1`` blocks of the 64 bits; of two fingerprints that differ in ``max_bits`` bits, at
    least one block is the same. Pairs of one component are left out, for they would add nothing;
    components are those of ``verified`` links, as ``links`` are.
    """
    keys = ["k"]
    mine = F.lit(None).cast("bigint")
    for i, (low, width) in enumerate(_segments(segments)):
        mine = F.when(F.shiftright("k", _SEGMENT_SHIFT) == i, _key(i, _value(F.col("a"), low, width))).otherwise(mine)
    members = stored(
        tables.select(*keys, F.col("b").alias("x"), F.lit(True).alias("listed")).unionByName(
            lookups.filter(F.col("k") != mine).select(*keys, F.col("a").alias("x"), F.lit(False).alias("listed"))
        ).join(hot, keys, "left_semi"),
        "hot-members",
    )
    centre = stored(members.filter("listed").groupBy(*keys).agg(F.min("x").alias("centre")), "hot-centres")
    star = members.join(centre, keys).filter(_differing("x", "centre") <= max_bits)
    star = star.select(F.col("x").alias("a"), F.col("centre").alias("b")).filter("a <> b").distinct()
    star = stored(verified(star), "hot-star")
    so_far = links.unionByName(star)
    component = stored(connected_components(so_far, "a", "b"), "hot-components")
    placed = stored(
        members.join(component, F.col("x") == F.col("node"), "left").select(
            *keys, "x", "listed", F.coalesce("component", "x").alias("c")
        ),
        "hot-placed",
    )
    open_keys = placed.groupBy(*keys).agg(F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 <> c1").select(*keys)
    rest = stored(placed.join(stored(open_keys, "hot-open"), keys, "left_semi"), "hot-rest")
    blocks = _segments(max_bits + 1)
    cut = F.explode(
        F.array(*[F.struct(F.lit(i).alias("block"), _value(F.col("x"), lo, w).alias("part")) for i, (lo, w) in enumerate(blocks)])
    )
    rows = rest.select(*keys, "x", "listed", "c", cut.alias("p")).select(*keys, "p.block", "p.part", "x", "listed", "c")
    left = rows.select(*keys, "block", "part", F.col("x").alias("a"), F.col("c").alias("ca"))
    right = rows.filter("listed").select(*keys, "block", "part", F.col("x").alias("b"), F.col("c").alias("cb"))
    near = (F.col("ca") != F.col("cb")) & _linked(max_bits, segments)
    pairs = left.join(right, [*keys, "block", "part"]).filter(near).select("a", "b")
    return star.unionByName(verified(pairs.distinct()))


def link_fingerprints(
    fps: DataFrame,
    max_bits: int,
    segments: int = 2,
    bucket: int = 64,
    verified: Callable[[DataFrame], DataFrame] = lambda links: links,
) -> DataFrame:
    """``a, b``: links between different values of the column ``fp`` (each value once) that connect every component.

    ``verified`` keeps those of some links ``a, b`` that hold; components are those of the links that it keeps.
    """
    tables = _tables(fps, segments)
    lookups = _lookups(fps, segments, max_bits)
    counts = tables.groupBy("k").count().filter(F.col("count") > bucket).select("k")
    hot = stored(counts, "hot-values")
    if hot.isEmpty():
        return verified(lookups.join(tables, "k").filter(_linked(max_bits, segments)).select("a", "b"))
    cold = tables.join(hot, "k", "left_anti")
    links = lookups.join(cold, "k").filter(_linked(max_bits, segments)).select("a", "b")
    links = stored(verified(links), "links")
    return links.unionByName(_crowded(lookups, tables, hot, links, max_bits, segments, verified))


def near_duplicates(
    docs: DataFrame,
    max_bits: int = 2,
    words: int = 3,
    segments: int = 2,
    key: str = "doc_id",
    text: str = "text",
    bucket: int = 64,
    similarity: float | None = None,
    sketch: int = 128,
) -> DataFrame:
    """``key, fp, component_id`` of every row; the component is the smallest key in it.

    With ``similarity``, a link must also have that Jaccard similarity of its shingles, estimated from the
    ``sketch`` smallest different shingle hashes of the first text of each fingerprint (exact for texts with no more).
    """
    marked = stored(fingerprints(docs, words, key, text, sketch if similarity is not None else 0), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min(key).alias("first")), "distinct")
    if similarity is None:
        links = link_fingerprints(distinct.select("fp"), max_bits, segments, bucket)
    else:
        sketches = marked.select(F.col(key).alias("key"), "fp", "sketch")

        def verified(links: DataFrame) -> DataFrame:
            return _similar(links, sketches, distinct, similarity, sketch)

        links = link_fingerprints(distinct.select("fp"), max_bits, segments, bucket, verified)
    component = stored(connected_components(links, "a", "b"), "components")
    named = distinct.join(component, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("c")
    )
    names = stored(named.groupBy("c").agg(F.min("first").alias("component_id")), "names")
    of_fp = stored(named.join(names, "c").select("fp", "component_id"), "of-fingerprint")
    return marked.select(key, "fp").join(of_fp, "fp").select(key, "fp", "component_id")


def _similar(links: DataFrame, marked: DataFrame, distinct: DataFrame, similarity: float, size: int) -> DataFrame:
    """The links whose shingle sketches agree."""
    links = stored(links.distinct(), "near-links")
    ends = links.select(F.col("a").alias("fp")).unionByName(links.select(F.col("b").alias("fp"))).distinct()
    first = distinct.join(ends, "fp", "left_semi").select(F.col("fp").alias("f"), "first")
    known = marked.join(first, (F.col("fp") == F.col("f")) & F.col("key").eqNullSafe(F.col("first")))
    known = stored(known.select("fp", "sketch").dropDuplicates(["fp"]), "sketches")
    both = links.join(known.select(F.col("fp").alias("a"), F.col("sketch").alias("sa")), "a")
    both = both.join(known.select(F.col("fp").alias("b"), F.col("sketch").alias("sb")), "b")
    smallest = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, size)
    shared = F.size(F.array_intersect(smallest, F.array_intersect("sa", "sb")))
    return both.filter(shared >= F.lit(similarity) * F.size(smallest)).select("a", "b")


def hex_digits(fp: str = "fp") -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
