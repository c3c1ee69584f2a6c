"""Merkle manifest of a dataset: a postorder append log of digests, and proofs taken from it.

Rows are leaves. Leaves of one group (``tree``) stand in the order of their key; while several nodes remain, every ``FANOUT``
consecutive ones (in the last run fewer, even one) become their parent, the SHA-256 of their hex digests. What remains, a
lone leaf itself, is the group's subroot. The subroots, ordered by group (null first, then by UTF-8 bytes), give the root likewise.

Building. Leaves are numbered within their group by ranges, so no task holds a group. A builder takes one aligned block of
``FANOUT ** levels`` consecutive leaves and appends each node to its log when the node is complete, that is in postorder. The roots of all blocks
are the leaves of the next round, until each group has one block; the subroots then are the leaves of one more tree. So
every task holds one block, and each round is smaller by that factor.

Proving. In postorder, the place of a node follows from the sizes of complete subtrees alone (``position``): nodes below it
and to its left are finished, and so are those ancestors of earlier leaves that end before it. So the siblings of a leaf are
fetched from its block's log by place, without a search or an index. Paths go down from the root: what a block has above
it is the path of one leaf of the round before.

Nulls and odd rows: a null value is a leaf's ``-``, apart from an empty one (``0:``); a null key comes first and a null group is a
group of its own; rows that share a key stand in the order of their digests; equal rows are equal leaves, each at a place of its
own; of a tampered leaf that is null, nothing was tampered with; an empty table gives no rows and no root; other columns are not read,
whatever their names are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.scratch import stored
from ledgerline.operators.windows import number_rows

FANOUT = 16
#: Levels that one builder completes: blocks of 4096 leaves.
LEVELS = 3
#: Bytes of a digest.
SIZE = 32
#: The steps from a node up to the root: its place in its run, and the digests of the others.
PATH = "array<struct<at: int, others: binary>>"
_PATH = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.binary())]))
_LOG = "tree string, block bigint, n bigint, nodes binary, top binary"


def digest_of(digests: Sequence[bytes]) -> bytes:
    """The parent of some nodes: SHA-256 of their hex digests."""
    return sha256("".join([d.hex() for d in digests]).encode()).digest()


def height(n: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def position(n: int, level: int, index: np.ndarray | int, top: int) -> np.ndarray:
    """Place of node ``index`` of ``level`` in the postorder of a tree of ``n`` leaves and ``top`` levels above them.

    At its own level and below, all nodes are finished that hold leaves up to its last one; of the levels above, those are that end
    before its first leaf.
    """
    index = np.asarray(index, dtype=np.int64)
    last = np.minimum(n, (index + 1) * FANOUT**level)
    done = sum(-(-last // FANOUT**i) for i in range(level + 1)) - 1
    return done + sum((index // FANOUT ** (i - level) for i in range(level + 1, top + 1)), np.zeros_like(index))


def block_log(leaves: Sequence[bytes], top: int) -> list[bytes]:
    """Nodes in the order in which they are complete, the block's root last."""
    log: list[bytes] = []
    runs: list[list[bytes]] = [[] for _ in range(top + 1)]

    def add(level: int, node: bytes) -> None:
        log.append(node)
        runs[level].append(node)
        if level < top and len(runs[level]) == FANOUT:
            fold(level)

    def fold(level: int) -> None:
        node = digest_of(runs[level])
        runs[level].clear()
        add(level + 1, node)

    for leaf in leaves:
        add(0, leaf)
    for level in range(top):
        if runs[level]:
            fold(level)
    return log


class Block:
    """Siblings of the leaves of one block, from its log."""

    def __init__(self, nodes: bytes, n: int, number: int, levels: int):
        """Block ``number`` of a round of ``n`` leaves."""
        block = FANOUT**levels
        self.nodes, self.first = nodes, number * block
        self.size = min(block, n - self.first)
        self.top = min(levels, height(n))
        self.places = [position(self.size, k, np.arange(-(-self.size // FANOUT**k)), self.top) for k in range(self.top)]

    def _node(self, level: int, index: int) -> bytes:
        at = int(self.places[level][index]) * SIZE
        return self.nodes[at : at + SIZE]

    def step(self, level: int, index: int) -> tuple[int, bytes]:
        """Place in the run and the other digests of it, for a node given by its number in the block."""
        start = index - index % FANOUT
        end = min(start + FANOUT, len(self.places[level]))
        return index - start, b"".join([self._node(level, i) for i in range(start, end) if i != index])

    def above(self, run: int) -> list[tuple[int, bytes]]:
        """Steps of the leaves of one run from their parent to the block's root."""
        return [self.step(level, run // FANOUT ** (level - 1)) for level in range(1, self.top)]


def folded(digest: bytes, path: Sequence[tuple[int, bytes]]) -> bytes:
    """The root that a node and its path lead to."""
    for at, others in path:
        text, cut = others.hex(), at * 2 * SIZE
        digest = sha256((text[:cut] + digest.hex() + text[cut:]).encode()).digest()
    return digest


def proof_digest(path: Sequence[tuple[int, bytes]]) -> bytes:
    """SHA-256 of the hex digests of all siblings, from the leaf up, left to right."""
    return sha256("".join([others.hex() for _, others in path]).encode()).digest()


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values one after another: ``-`` for a null, else its UTF-8 bytes after their count and a colon."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


@dataclass(frozen=True)
class Manifest:
    """``leaves`` has ``tree, key, leaf, other, idx, n``; ``rounds`` one log a round; ``groups`` the logs above the subroots."""

    leaves: DataFrame
    rounds: list[DataFrame]
    subroots: DataFrame
    groups: list[DataFrame]
    root: bytes | None
    levels: int = LEVELS


def _logs(leaves: DataFrame, most: int, levels: int) -> list[DataFrame]:
    """The log of every round over ``tree, idx, digest, n``; ``most`` is the largest ``n``."""

    size = FANOUT**levels

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        tree, n = table["tree"][0].as_py(), table["n"][0].as_py()
        log = block_log(table["digest"].to_pylist(), min(levels, height(n)))
        row = {"tree": tree, "block": table["idx"][0].as_py() // size, "n": n, "nodes": b"".join(log), "top": log[-1]}
        return pa.Table.from_pylist([row], schema)

    schema = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("nodes", pa.binary()), ("top", pa.binary())])
    rounds = []
    while True:
        rows = leaves.select("tree", "idx", "digest", "n", F.expr(f"idx div {size}").alias("block"))
        log = stored(rows.groupBy("tree", "block").applyInArrow(build, _LOG), "merkle-log")
        rounds.append(log)
        if most <= size:
            return rounds
        most = -(-most // size)
        above = log.filter(F.col("n") > size)
        leaves = above.select("tree", F.col("block").alias("idx"), F.col("top").alias("digest"), F.expr(f"(n + {size - 1}) div {size}").alias("n"))


def _subroots(rounds: list[DataFrame], size: int) -> DataFrame:
    """``tree, subroot, round``: a group is finished in the round where one block holds it."""
    out = None
    for r, log in enumerate(rounds):
        part = log.filter(F.col("n") <= size).select("tree", F.col("top").alias("subroot"), F.lit(r).alias("round"))
        out = part if out is None else out.unionByName(part)
    return out


def build(rows: DataFrame, tree: Column, key: Column, leaf: Column, other: Column | None = None, levels: int = LEVELS) -> Manifest:
    """Number the leaves, write the logs of all rounds and find the root.

    ``other`` is a digest that is to be checked in place of the leaf (null: the leaf itself).
    """
    other = F.lit(None).cast("binary") if other is None else other
    # Null is less than any text, and is not the empty one.
    group = F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit(""))
    named = rows.select(group.alias("tree"), key.alias("key"), leaf.alias("leaf"), other.alias("other"))
    numbered = number_rows(named, [F.col("tree").asc(), F.col("key").asc_nulls_first(), F.col("leaf").asc()], name="g")
    sizes = stored(numbered.groupBy(F.col("tree").alias("t")).agg(F.min("g").alias("g0"), F.count(F.lit(1)).alias("n")), "merkle-sizes")
    most = sizes.agg(F.max("n")).first()[0]
    leaves = stored(numbered.join(sizes, F.col("tree") == F.col("t")).select("tree", "key", "leaf", "other", (F.col("g") - F.col("g0")).alias("idx"), "n"), "merkle-leaves")
    if not most:
        return Manifest(leaves, [], leaves.select("tree"), [], None)
    rounds = _logs(leaves.withColumnRenamed("leaf", "digest"), most, levels)
    subroots = _subroots(rounds, FANOUT**levels)
    placed = number_rows(subroots, [F.col("tree").asc()], name="idx", start=-1, unique_order=True)
    placed = stored(placed.select("tree", "subroot", "round", "idx"), "merkle-subroots")
    count = placed.count()
    groups = _logs(placed.select(F.lit("").alias("tree"), "idx", F.col("subroot").alias("digest"), F.lit(count).cast("bigint").alias("n")), count, levels)
    return Manifest(leaves, rounds, placed, groups, bytes(groups[-1].first()["top"]), levels)


def _paths(log: DataFrame, levels: int) -> DataFrame:
    """``tree, idx, path`` of every leaf of a round, from its log with ``above``, the path of the block."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                above = [(s["at"], s["others"]) for s in row["above"]]
                block = Block(row["nodes"], row["n"], row["block"], levels)
                for start in range(0, block.size, FANOUT):
                    inner = block.above(start // FANOUT) + above
                    own = range(start, min(start + FANOUT, block.size))
                    paths = [([block.step(0, k)] if block.top else []) + inner for k in own]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["tree"]] * len(own), pa.string()),
                            pa.array([block.first + k for k in own], pa.int64()),
                            pa.array([[{"at": at, "others": others} for at, others in p] for p in paths], _PATH),
                        ],
                        names=["tree", "idx", "path"],
                    )

    rows = log.select("tree", "block", "n", "nodes", "above")
    return rows.mapInArrow(task, f"tree string, idx bigint, path {PATH}")


def _with_path(log: DataFrame, paths: DataFrame) -> DataFrame:
    known = paths.select(F.col("tree").alias("t"), F.col("idx").alias("b"), F.col("path").alias("above"))
    return log.join(known, (F.col("tree") == F.col("t")) & (F.col("block") == F.col("b"))).drop("t", "b")


def prove(manifest: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """``key, leaf, subroot, root, proof_sha256, folded_root, verified`` of ``leaves`` (all of the manifest, unless some of them are given).

    ``folded_root`` is what ``other``, or the leaf where that is null, and the leaf's siblings lead to. Digests are hex.
    """
    leaves = manifest.leaves if leaves is None else leaves
    kind = leaves.schema["key"].dataType.simpleString()
    schema = f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if manifest.root is None:
        return leaves.sparkSession.createDataFrame([], schema)
    root, levels = manifest.root, manifest.levels
    paths = leaves.sparkSession.createDataFrame([("", 0, [])], f"tree string, idx bigint, path {PATH}")
    for log in reversed(manifest.groups):
        paths = stored(_paths(_with_path(log, paths), levels), "merkle-paths")
    subroots = manifest.subroots
    at_group = subroots.join(paths.select(F.col("idx").alias("i"), "path"), F.col("idx") == F.col("i")).select("tree", "round", "path")
    paths = None
    for r in reversed(range(len(manifest.rounds))):
        first = at_group.filter(F.col("round") == r).select("tree", F.lit(0).cast("bigint").alias("idx"), "path")
        known = first if paths is None else paths.unionByName(first)
        log = _with_path(manifest.rounds[r], known)
        if r:
            paths = stored(_paths(log, levels), "merkle-paths")
    top = subroots.select(F.col("tree").alias("t"), "subroot")
    log = log.join(top, F.col("tree") == F.col("t")).select("tree", "block", "n", "nodes", "above", "subroot")
    rows = leaves.select("tree", F.expr(f"idx div {FANOUT**levels}").alias("block"), "idx", "key", "leaf", "other")
    key_type = pa.field("key", _arrow_type(leaves, "key"))
    out = pa.schema([key_type, *[pa.field(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], pa.field("verified", pa.bool_())])

    def extract(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return out.empty_table()
        row = right.slice(0, 1).to_pylist()[0]
        above = [(s["at"], s["others"]) for s in row["above"]]
        block = Block(row["nodes"], row["n"], row["block"], levels)
        left = left.sort_by("idx")
        run, inner, proofs, roots = -1, [], [], []
        for idx, leaf, other in zip(left["idx"].to_pylist(), left["leaf"].to_pylist(), left["other"].to_pylist()):
            k = idx - block.first
            if k // FANOUT != run:
                run = k // FANOUT
                inner = block.above(run) + above
            path = ([block.step(0, k)] if block.top else []) + inner
            proofs.append(proof_digest(path).hex())
            roots.append(folded(leaf if other is None else other, path))
        count = left.num_rows
        return pa.table(
            [
                left["key"].cast(key_type.type),
                pa.array([d.hex() for d in left["leaf"].to_pylist()], pa.string()),
                pa.array([row["subroot"].hex()] * count, pa.string()),
                pa.array([root.hex()] * count, pa.string()),
                pa.array(proofs, pa.string()),
                pa.array([r.hex() for r in roots], pa.string()),
                pa.array([r == root for r in roots], pa.bool_()),
            ],
            schema=out,
        )

    return rows.groupBy("tree", "block").cogroup(log.groupBy("tree", "block")).applyInArrow(extract, schema)


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)
