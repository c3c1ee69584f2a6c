import random

import pytest
import xxhash

from ledgerline.llm import simhash as s
from ledgerline.llm.components import connected_components


def fingerprint(text, k):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(points, most):
    """Smallest member of each point's component by brute force."""
    root = {p: p for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in points:
        for b in points:
            if a < b and (a ^ b).bit_count() <= most:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in points}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


TEXTS = [None, "", " \t", "One", "one", "a b", "A  b", "the quick brown fox jumps", "The quick\nbrown fox jumps", "x " * 4000, "é È é"]


def test_fingerprints_equal_the_definition(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.f for r in s.fingerprints(docs, 3).select("doc_id", s.hex_digits().alias("f")).collect()}
    assert got == {i: format(fingerprint(t, 3), "016x") for i, t in rows}


@pytest.mark.parametrize("most,segments,bucket", [(2, 2, 64), (2, 2, 2), (3, 2, 4), (8, 3, 3)])
def test_links_connect_what_brute_force_connects(spark, most, segments, bucket):
    rng = random.Random(most * 100 + bucket)
    points = {0, 1, (1 << 64) - 1}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice((1, 3, 14))):
            point = centre
            for _ in range(rng.randint(0, most + 1)):
                point ^= 1 << rng.randrange(64)
            points.add(point)
    fps = spark.createDataFrame([(signed(p),) for p in points], "fp bigint")
    links = s.link_fingerprints(fps, most, segments, bucket)
    found = links.collect()
    mask = (1 << 64) - 1
    assert all(((r.a & mask) ^ (r.b & mask)).bit_count() <= most for r in found)
    named = {r.node & mask: r.component & mask for r in connected_components(links, "a", "b").collect()}
    want = groups(points, most)
    got_sets, want_sets = {}, {}
    for p in points:
        got_sets.setdefault(named.get(p, p), set()).add(p)
        want_sets.setdefault(want[p], set()).add(p)
    assert sorted(map(sorted, got_sets.values())) == sorted(map(sorted, want_sets.values()))


def test_groups_of_documents(spark):
    rows = [(7, "a b c d"), (3, "a b c d"), (9, None), (8, ""), (5, "entirely other words here"), (3, "a b c d"), (None, "a b c d")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, fp int, key int")
    got = sorted(((r.doc_id, r.component_id) for r in s.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(7, 3), (3, 3), (3, 3), (None, 3), (9, 8), (8, 8), (5, 5)], key=str)


def test_similarity_is_asked_for(spark):
    text = " ".join(f"w{i}" for i in range(200))
    near = text.replace("w100 ", "changed ")
    docs = spark.createDataFrame([(1, text), (2, near), (3, text + " tail")], "doc_id bigint, text string")
    loose = s.near_duplicates(docs, max_bits=12, words=5, segments=3, similarity=0.8)
    assert {r.component_id for r in loose.collect()} == {1}
    strict = s.near_duplicates(docs, max_bits=12, words=5, segments=3, similarity=0.999)
    assert {r.component_id for r in strict.collect()} == {1, 2, 3}


def test_similar_copies_of_a_crowded_value_stay_linked(spark):
    """Copies are similar to their original and often not to the smallest fingerprint of their value."""
    rng = random.Random(5)
    original = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    rows = [(0, " ".join(original))]
    for i in range(1, 40):
        copy = list(original)
        for at in rng.sample(range(200), 3):
            copy[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))

    def shingles(text):
        words = text.split()
        return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}

    points = {i: (fingerprint(t, 5), shingles(t)) for i, t in rows}
    root = {i: i for i in points}
    for a in points:
        for b in points:
            (fa, sa), (fb, sb) = points[a], points[b]
            if a < b and (fa ^ fb).bit_count() <= 12 and len(sa & sb) >= 0.85 * len(sa | sb):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = s.near_duplicates(docs, max_bits=12, words=5, segments=3, similarity=0.85, bucket=2, sketch=10_000)
    assert {r.doc_id: r.component_id for r in got.collect()} == root
    assert len(set(root.values())) < 10


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert s.near_duplicates(docs).collect() == []


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    hub = [(5, i) for i in range(1000, 1200)]
    rows = [*path, *hub, (5, 5), (None, 5), (101, 100)]
    links = spark.createDataFrame(rows, "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(links, "a", "b").collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, 5: 5, **{i: 5 for i in range(1000, 1200)}}
