"""Ranked lexical search: Block-Max MaxScore over sharded posting lists.

Terms are the maximal runs of digits, ASCII letters and characters above U+007F; only A-Z are lower-cased. With N documents
that have a term and L terms in them, a document of n terms has m = 50 + 50 n N div L, and a term with frequency df weighs
w = floor(1000 ln((2 N + 2) / (2 df + 1))). A document's score is the sum of w * (1000000000 tf div (1000 tf + 20 m)) over the
different terms of a query, in 64-bit integers.

Index. A task cuts its documents into shards of about ``shard_bytes`` of text and writes one row per shard and term: a posting
list in blocks of ``BLOCK`` postings, each packed as variable-length gaps and frequencies, beside its last document, largest
frequency and least document length. Nothing is shuffled, and the rows hold no statistics of the corpus, so tables can be added up.

Search. Of the index only the lists of the queries' terms are taken and brought together by shard. In a shard, the lists of a query are ordered by
their bounds; those at the front whose bounds together stay below the threshold are not essential, for no document in them alone
can get in. The others are read whole and give candidates with partial scores. Each list that is not essential then adds the bound of the
block that holds a candidate: candidates that stay below the threshold are rejected and only blocks with a candidate left are
unpacked. Thresholds come from ``seed_shards`` shards that are searched first; ties with a threshold are never rejected. Shards
give their best ``k``, and the best of all are taken by a window, which Spark cuts to ``k`` a task before the shuffle.

Queries go to the tasks in blocks of about ``terms_per_block`` terms, as many passes as there are blocks; a document is in no query's way.

Nulls and odd rows: a null or empty text has no term, and takes no part; a query without a known term gives no rows; query rows
that share id and text are one, those with different texts are ranked each by itself; documents with equal ids are documents of their own;
equal scores stand by ascending id, null first; a text longer than a shard is a shard; empty tables give no rows;
other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import count
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.scratch import stored
from ledgerline.llm.texts import sub_batches, utf8

BLOCK = 128
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Lower case for A-Z, a blank for every byte that is in no term.
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_BLOCKS = "array<struct<last: int, max_tf: int, min_len: int, data: binary>>"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_CLEAN).split()


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2**32 as bytes of seven bits each, low ones first, and where each number begins (one more at the end)."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), dtype=np.int64)
    for k in range(1, 5):
        size += values >= np.uint64(1 << 7 * k)
    at = np.concatenate(([0], np.cumsum(size)))
    out = np.zeros(int(at[-1]), dtype=np.uint8)
    for k in range(5):
        has = size > k
        byte = (values[has] >> np.uint64(7 * k)) & np.uint64(127)
        out[at[:-1][has] + k] = byte + np.where(size[has] > k + 1, np.uint64(128), np.uint64(0))
    return out, at


def unpack(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    if len(ends) == len(data):
        return data.astype(np.int64)
    starts = np.concatenate(([0], ends[:-1] + 1))
    out = np.zeros(len(ends), dtype=np.int64)
    for k in range(5):
        has = ends - starts >= k
        out[has] |= (data[starts[has] + k].astype(np.int64) & 127) << 7 * k
    return out


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0] + 1, ...``, ``lengths[0]`` of them, then those of the next."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


class _Builder:
    """Terms of the documents of one shard."""

    def __init__(self) -> None:
        self.vocabulary: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.ids: list[np.ndarray] = []
        self.keys: list[pa.Array] = []
        self.lengths: list[int] = []
        self.bytes = 0

    def add(self, keys: pa.Array, texts: list[bytes]) -> None:
        kept = []
        for i, text in enumerate(texts):
            found = terms_of(text)
            if found:
                self.ids.append(np.fromiter(map(self.vocabulary.__getitem__, found), dtype=np.int64, count=len(found)))
                self.lengths.append(len(found))
                kept.append(i)
            self.bytes += len(text) + 1
        self.keys.append(keys.take(pa.array(kept, pa.int64())))

    def rows(self, shard: int, schema: pa.Schema) -> pa.RecordBatch:
        """The shard's documents as one row without a term, and one row per term."""
        n, lengths = len(self.lengths), np.array(self.lengths, dtype=np.int64)
        pairs, tf = np.unique(np.concatenate(self.ids) * n + np.repeat(np.arange(n), lengths), return_counts=True)
        term, doc = pairs // n, pairs % n
        lists = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))
        df = np.diff(np.concatenate((lists, [len(term)])))
        # Blocks of each list, and where the postings of each begin.
        per_list = -(-df // BLOCK)
        first = runs(np.zeros(len(df), np.int64), per_list) * BLOCK + np.repeat(lists, per_list)
        size = np.minimum(BLOCK, np.repeat(lists + df, per_list) - first)
        before = np.concatenate(([-1], doc[:-1]))
        before[lists] = -1
        values = np.empty(2 * len(doc), dtype=np.int64)
        values[runs(2 * first, size)] = doc - before
        values[runs(2 * first + size, size)] = tf
        data, at = pack(values)
        edges = np.append(at[2 * first], len(data)).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(edges), pa.py_buffer(data)])
        blocks = pa.StructArray.from_arrays(
            [
                pa.array(doc[first + size - 1].astype(np.int32)),
                pa.array(np.maximum.reduceat(tf, first).astype(np.int32)),
                pa.array(np.minimum.reduceat(lengths[doc], first).astype(np.int32)),
                packed,
            ],
            fields=list(schema.field("blocks").type.value_type),
        )
        # The first row is the documents' own: it has no block.
        offsets = pa.array(np.concatenate(([0, 0], np.cumsum(per_list))).astype(np.int32))
        keys = pa.concat_arrays(self.keys)
        none = [None] * len(df)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(df) + 1, shard, dtype=np.int64)),
                pa.array([None, *[w.decode() for w in self.vocabulary]], pa.string()),
                pa.array(np.concatenate(([n], df)).astype(np.int64)),
                pa.array([int(lengths.sum()), *none], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, *[n] * (len(df) + 1)], pa.int32()), keys).cast(schema.field("keys").type),
                pa.array([lengths.astype("<i4").tobytes(), *none], pa.binary()),
                pa.ListArray.from_arrays(offsets, blocks, type=schema.field("blocks").type),
            ],
            schema=schema,
        )


@dataclass(frozen=True)
class Index:
    """``table``: ``shard, term, df, total, keys, lens, blocks``; ``documents`` and ``terms`` count those of the corpus."""

    table: DataFrame
    documents: int
    terms: int
    shards: int


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_bytes: int = 8 << 20) -> Index:
    """Write the index of all documents to the checkpoint folder."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(docs.schema[key].dataType)
    block = pa.struct([("last", pa.int32()), ("max_tf", pa.int32()), ("min_len", pa.int32()), ("data", pa.binary())])
    schema = pa.schema(
        [("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("total", pa.int64()), ("keys", pa.list_(kind)), ("lens", pa.binary()), ("blocks", pa.list_(block))]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, built = TaskContext.get().partitionId() << 32, _Builder()
        for batch in batches:
            for part in sub_batches(batch, "text", min(1 << 20, shard_bytes)):
                built.add(part.column("key"), utf8(part.column("text")))
                if built.bytes >= shard_bytes:
                    if built.lengths:
                        yield built.rows(shard, schema)
                    shard, built = shard + 1, _Builder()
        if built.lengths:
            yield built.rows(shard, schema)

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    spec = f"shard bigint, term string, df bigint, total bigint, keys array<{docs.schema[key].dataType.simpleString()}>, lens binary, blocks {_BLOCKS}"
    table = stored(rows.mapInArrow(task, spec), "lexical-index")
    own = table.filter("term is null").agg(F.sum("df"), F.sum("total"), F.count(F.lit(1))).first()
    return Index(table, own[0] or 0, own[1] or 0, own[2])


class Shard:
    """Posting lists of one shard, with bounds that need the corpus's statistics."""

    def __init__(self, table: pa.Table, documents: int, terms: int):
        table = table.combine_chunks()
        names = table["term"].to_pylist()
        own = names.index(None)
        order = [i for i in range(len(names)) if i != own]
        keys = table["keys"].combine_chunks()
        if isinstance(keys, pa.ChunkedArray):
            keys = keys.chunk(0)
        self.keys = keys[own].values
        self.key_rank = pc.rank(self.keys, sort_keys="ascending", null_placement="at_start", tiebreaker="first").to_numpy()
        lengths = np.frombuffer(table["lens"][own].as_py(), "<i4").astype(np.int64)
        self.norms = 50 + 50 * lengths * documents // terms
        self.lists = {names[i]: n for n, i in enumerate(order)}
        lists = table["blocks"].combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.chunk(0)
        lists = lists.take(pa.array(order, pa.int64()))
        df = table["df"].to_numpy()[order] if order else np.zeros(0, np.int64)
        self.count = pc.list_value_length(lists).to_numpy().astype(np.int64)
        self.first = np.cumsum(self.count) - self.count
        blocks = lists.flatten()
        self.last, max_tf, min_len = (pc.struct_field(blocks, f).to_numpy().astype(np.int64) for f in ("last", "max_tf", "min_len"))
        data = pc.struct_field(blocks, "data")
        sizes = pc.binary_length(data).to_numpy().astype(np.int64)
        self.data = np.frombuffer(b"".join(data.to_pylist()), dtype=np.uint8)
        self.bytes, self.at = sizes, np.cumsum(sizes) - sizes
        number = runs(np.zeros(len(df), np.int64), self.count)
        self.size = np.minimum(BLOCK, np.repeat(df, self.count) - number * BLOCK)
        self.before = np.where(number == 0, -1, np.concatenate(([-1], self.last[:-1]))) if len(self.last) else self.last
        self.bound = impact(max_tf, 50 + 50 * min_len * documents // terms)
        self.most = np.maximum.reduceat(self.bound, self.first) if len(df) else self.bound
        self.whole: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.unpacked = 0

    def postings(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks, in order."""
        self.unpacked += len(blocks)
        values = unpack(self.data[runs(self.at[blocks], self.bytes[blocks])])
        size = self.size[blocks]
        start = np.cumsum(2 * size) - 2 * size
        gaps = values[runs(start, size)]
        head = np.cumsum(size) - size
        sums = np.cumsum(gaps)
        docs = sums + np.repeat(self.before[blocks] - (sums[head] - gaps[head]), size)
        return docs, impact(values[runs(start + size, size)], self.norms[docs])

    def read(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """A whole list; kept, since queries share terms."""
        if n not in self.whole:
            self.whole[n] = self.postings(np.arange(self.first[n], self.first[n] + self.count[n]))
        return self.whole[n]

    def best(self, terms: Sequence[str], weights: Sequence[int], k: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best documents that reach ``threshold``, and their scores."""
        known = [(self.lists[t], w) for t, w in zip(terms, weights) if w > 0 and t in self.lists]
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not known:
            return none
        lists, w = (np.array(x, dtype=np.int64) for x in zip(*known))
        bounds = w * self.most[lists]
        order = np.argsort(bounds, kind="stable")
        lists, w, together = lists[order], w[order], np.cumsum(bounds[order])
        essential = int(np.searchsorted(together, threshold, side="left"))
        if essential == len(lists):
            return none
        partial = np.zeros(len(self.norms), dtype=np.int64)
        for n, weight in zip(lists[essential:], w[essential:]):
            docs, impacts = self.read(int(n))
            partial[docs] += weight * impacts
        docs = np.flatnonzero(partial)
        scores = partial[docs]
        for j in range(essential - 1, -1, -1):
            stay = scores + together[j] >= threshold
            docs, scores = docs[stay], scores[stay]
            if not len(docs):
                return none
            rest = together[j - 1] if j else 0
            a, n = self.first[lists[j]], self.count[lists[j]]
            block = np.searchsorted(self.last[a : a + n], docs)
            inside = block < n
            block = a + np.minimum(block, n - 1)
            stay = scores + np.where(inside, w[j] * self.bound[block], 0) + rest >= threshold
            docs, scores, block, inside = docs[stay], scores[stay], block[stay], inside[stay]
            wanted = np.unique(block[inside])
            if len(wanted):
                there, impacts = self.postings(wanted)
                at = np.minimum(np.searchsorted(there, docs), len(there) - 1)
                scores = scores + np.where(there[at] == docs, w[j] * impacts[at], 0)
        stay = scores >= max(threshold, 1)
        docs, scores = docs[stay], scores[stay]
        chosen = np.lexsort((self.key_rank[docs], -scores))[:k]
        return docs[chosen], scores[chosen]


def impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * norm)


def query_terms(text: Column) -> Column:
    """The different terms of a text, as an array; null for null."""
    return F.array_distinct(F.regexp_extract_all(F.translate(text, ascii_uppercase, ascii_lowercase), F.lit(TERM), F.lit(0)))


def _searched(index: Index, wanted: DataFrame, queries: dict[int, tuple[list[str], list[int]]], thresholds: dict[int, int], k: int, seeds: Column) -> DataFrame:
    """``q, key, score``: the best of every shard that ``seeds`` names."""
    sent = index.table.sparkSession.sparkContext.broadcast((queries, thresholds))
    documents, terms = index.documents, index.terms
    kind = index.table.schema["keys"].dataType.elementType.simpleString()

    def search(table: pa.Table) -> pa.Table:
        shard = Shard(table, documents, terms)
        asked, least = sent.value
        q, docs, scores = [], [], []
        for number, (names, weights) in asked.items():
            found, values = shard.best(names, weights, k, least.get(number, 0))
            q.append(np.full(len(found), number, dtype=np.int64))
            docs.append(found)
            scores.append(values)
        return pa.table({"q": np.concatenate(q), "key": shard.keys.take(pa.array(np.concatenate(docs), pa.int64())), "score": np.concatenate(scores)})

    table = index.table.filter(seeds)
    lists = table.filter("term is not null").join(wanted, "term", "left_semi")
    rows = lists.select(*table.columns).unionByName(table.filter("term is null"))
    by_shard = rows.select("shard", "term", "df", "keys", "lens", "blocks").groupBy("shard")
    return by_shard.applyInArrow(search, f"q bigint, key {kind}, score bigint")


def _top(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("key").asc_nulls_first())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    index: Index,
    queries: DataFrame,
    k: int = 50,
    key: str = "item_id",
    text: str = "text",
    seed_shards: int = 8,
    terms_per_block: int = 200_000,
) -> DataFrame:
    """``key, rank, doc, score``: the ``k`` documents with the highest scores above 0 for every query."""
    asked = queries.select(F.col(key).alias("item"), query_terms(F.col(text)).alias("terms"), F.xxhash64(text).alias("h"))
    asked = asked.filter(F.size("terms") > 0).dropDuplicates(["item", "h"]).withColumn("q", F.monotonically_increasing_id())
    asked = stored(asked.select("q", "item", "terms"), "lexical-queries")
    each = asked.select("q", F.explode("terms").alias("term"))
    wanted = stored(each.select("term").distinct(), "lexical-terms")
    counts = index.table.filter("term is not null").select("term", "df").join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    ratio = F.lit(2.0 * index.documents + 2) / (2.0 * F.col("df") + 1)
    weights = counts.select("term", F.floor(1000 * F.log(ratio)).cast("bigint").alias("w"))
    weighted = stored(each.join(weights, "term"), "lexical-weights")
    blocks = -(-weighted.count() // terms_per_block)
    parts = []
    for n in range(blocks):
        own: dict[int, tuple[list[str], list[int]]] = {}
        for r in weighted.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == n).toLocalIterator():
            names, values = own.setdefault(r.q, ([], []))
            names.append(r.term)
            values.append(r.w)
        if not own:
            continue
        is_seed = F.pmod(F.xxhash64("shard"), F.lit(max(1, index.shards // seed_shards))) == 0
        first = stored(_top(_searched(index, wanted, own, {}, k, is_seed), k), "lexical-seeds")
        least = {r.q: r.score for r in first.filter(F.col("rank") == k).select("q", "score").toLocalIterator()}
        rest = _searched(index, wanted, own, least, k, ~is_seed)
        parts.append(first.select("q", "key", "score").unionByName(rest))
    kind = index.table.schema["keys"].dataType.elementType.simpleString()
    rows = index.table.sparkSession.createDataFrame([], f"q bigint, key {kind}, score bigint")
    for part in parts:
        rows = rows.unionByName(part)
    ranked = _top(rows, k).join(asked.select("q", "item"), "q")
    return ranked.select(F.col("item").alias(key), F.col("rank").cast("int").alias("rank"), F.col("key").alias("doc"), "score")
