import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import merkle as m


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes):
    """All levels of a tree over hex digests."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        start = i - i % 16
        run = level[start : start + 16]
        out.append((i - start, run[: i - start] + run[i - start + 1 :]))
        i //= 16
    return out


def postorder(n, top):
    """Every node ``(level, index)`` in the order of completion, by recursion."""
    out = []

    def visit(level, index):
        for child in range(index * 16, min((index + 1) * 16, -(-n // 16 ** (level - 1)))) if level else ():
            visit(level - 1, child)
        out.append((level, index))

    visit(top, 0)
    return out


@pytest.mark.parametrize("n,top", [(1, 0), (1, 3), (2, 1), (16, 1), (17, 2), (33, 2), (256, 2), (257, 3), (700, 3), (4096, 3), (4095, 3), (5000, 4)])
def test_positions_are_those_of_a_postorder_walk(n, top):
    for place, (level, index) in enumerate(postorder(n, top)):
        assert int(m.position(n, level, index, top)) == place
    assert m.position(n, 0, np.arange(min(n, 3)), top).tolist() == list(range(min(n, 3)))


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 1000, 4096])
def test_log_holds_the_nodes_where_positions_say(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    top = m.height(n)
    log, levels = m.block_log(leaves, top), climb([x.hex() for x in leaves])
    assert len(log) == sum(map(len, levels))
    for k, level in enumerate(levels):
        for i, digest in enumerate(level):
            assert log[int(m.position(n, k, i, top))].hex() == digest


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def expected(rows):
    """rows: (key, group, text); sorted result tuples."""
    groups = {}
    for key, group, text in rows:
        leaf = h([field(key), field(group), field(text)])
        groups.setdefault(group, []).append((key is not None, key or 0, leaf, key))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    top = climb([trees[g][-1][0] for g in order])
    out = []
    for number, g in enumerate(order):
        for i, (_, _, leaf, key) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = siblings(trees[g], i) + siblings(top, number)
            out.append((key, leaf, trees[g][-1][0], top[-1][0], h(x for _, others in path for x in others)))
    return sorted(out, key=str)


def manifest(spark, rows, other=None, levels=m.LEVELS):
    df = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], "id bigint, grp string, text string, tree string, leaf string, idx int")
    values = [F.col(c) for c in ("id", "grp", "text")]
    return m.build(df, F.col("grp"), F.col("id"), m.leaf_digest(values), other, levels)


ODD = [(None, None, None), (None, None, ""), (1, None, "x"), (1, "", "x"), (1, "", "y"), (1, "", "y"), (2, "é", "ü" * 200_000), (3, "z", None), (4, "a.b", "q")]


def test_nulls_ties_repeated_rows_long_texts_and_clashing_columns(spark):
    got = m.prove(manifest(spark, ODD)).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == expected(ODD)
    assert all(r.folded_root == r.root and r.verified for r in got)


def test_blocks_beyond_one_and_many_groups(spark):
    """Blocks of 16 leaves, so that three rounds and two rounds of groups are needed."""
    rng = random.Random(5)
    rows = [(i, "hot" if i % 3 else f"g{rng.randrange(40)}", f"t{rng.random()}") for i in range(700)]
    got = m.prove(manifest(spark, rows, levels=1)).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == expected(rows)
    assert all(r.verified for r in got)


def test_tampered_leaves_lead_elsewhere(spark):
    rows = [(i, f"g{i % 3}", f"Text {i}") for i in range(60)]
    wrong = F.when(F.col("id") % 7 == 0, m.leaf_digest([F.col("id"), F.col("grp"), F.lower("text")]))
    made = manifest(spark, rows, wrong)
    got = m.prove(made).collect()
    assert {r.key for r in got if not r.verified} == {i for i in range(60) if i % 7 == 0}
    assert all((r.folded_root == r.root) == r.verified for r in got)
    few = m.prove(made, made.leaves.filter("key in (7, 8)")).collect()
    assert {tuple(r) for r in few} == {tuple(r) for r in got if r.key in (7, 8)}


def test_empty_table(spark):
    got = m.prove(manifest(spark, []))
    assert got.collect() == [] and got.columns[0] == "key"
