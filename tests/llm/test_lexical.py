import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import lexical as m

WORD = re.compile(m.TERM)
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(docs, queries, k):
    """Every document scored for every query."""
    tfs = [(key, Counter(words(text))) for key, text in docs]
    tfs = [(key, c) for key, c in tfs if c]
    n, total = len(tfs), sum(sum(c.values()) for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = []
    for item, text in dict.fromkeys(queries):
        scored = []
        for key, c in tfs:
            norm = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * norm)) for t in set(words(text)) if t in c)
            if score > 0:
                scored.append((-score, (key is not None, key or 0), key))
        out += [(item, r, key, -s) for r, (s, _, key) in enumerate(sorted(scored, key=lambda x: x[:2])[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, queries, k=5, parts=3, **options):
    shard_bytes = options.pop("shard_bytes", 1 << 20)
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id bigint, text string, shard int, term string").repartition(parts)
    q = spark.createDataFrame([(*r, 2) for r in queries], "item_id bigint, text string, q int")
    index = m.build_index(d, shard_bytes=shard_bytes)
    return sorted(map(tuple, m.search(index, q, k=k, **options).collect()), key=str), index


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for values in (np.zeros(0, np.int64), rng.integers(0, 128, 50), rng.integers(0, 1 << 32, 5000) >> rng.integers(0, 32, 5000)):
        data, at = m.pack(values)
        assert m.unpack(data).tolist() == values.tolist() and at[-1] == len(data)


def test_terms_are_those_of_the_pattern():
    text = "Ab1-Éé x_y 日本 \x7f ÄÖ's\x00z\tQ"
    assert [t.decode() for t in m.terms_of(text.encode())] == words(text)


@pytest.mark.parametrize("shard_bytes,seeds,block", [(1 << 20, 8, 200_000), (4000, 1, 200_000), (20_000, 3, 7)])
def test_equals_scoring_every_document(spark, shard_bytes, seeds, block):
    rng = random.Random(shard_bytes)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 60)))) for i in range(1500)]
    docs += [(5000 + i, "w0 w1 w299 same text") for i in range(60)]
    queries = [(i, " ".join(rng.choices(vocabulary, k=8))) for i in range(6)] + [(9, "w0 w1 w2"), (10, "same W299 text"), (11, "absent"), (12, "w0")]
    got, index = run(spark, docs, queries, 50, shard_bytes=shard_bytes, seed_shards=seeds, terms_per_block=block)
    assert got == brute(docs, queries, 50)
    assert index.shards > (3 if shard_bytes < 10_000 else 2)


ODD = [(None, "a b"), (None, "a b"), (1, None), (2, ""), (3, " .,;"), (4, "A b"), (4, "a c"), (7, "b " * 400_000), (8, "É é"), (9, "a b")]


def test_nulls_ties_repeated_rows_and_long_texts(spark):
    queries = [(1, "a B a"), (1, "a B a"), (1, "c"), (None, "é"), (2, None), (3, ""), (4, "B")]
    got, _ = run(spark, ODD, queries, 3, shard_bytes=1000)
    assert got == brute(ODD, [q for q in queries if words(q[1])], 3)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")])[0] == []
    assert run(spark, ODD, [])[0] == []


def test_block_bounds_reject_before_unpacking(spark):
    """A frequent term beside a rare one: with a threshold, few of the frequent term's blocks are unpacked."""
    docs = [(i, "common " + ("rare filler" if i % 1000 == 7 else f"filler{i % 50}")) for i in range(6000)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    index = m.build_index(frame)
    table = pa.Table.from_batches(index.table.filter("term is null or term in ('common', 'rare')").toArrow().to_batches())
    shard = m.Shard(table, index.documents, index.terms)
    assert shard.count[shard.lists["common"]] == 47
    asked = (["common", "rare"], [5, 6000])
    free = shard.best(*asked, 5, 0)
    eager = shard.unpacked
    shard = m.Shard(table, index.documents, index.terms)
    pruned = shard.best(*asked, 5, int(free[1][-1]))
    assert [x.tolist() for x in free] == [x.tolist() for x in pruned]
    assert eager == 48 and shard.unpacked <= 7
