import os
import random
from collections import Counter

import pytest

from ledgerline.llm import suffix_dedup as s
from ledgerline.llm import suffix_merge as m


def removed(texts, length):
    """Per text the remaining bytes, and how many runs went, by counting every string."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(g and not b for g, b in zip(gone, [0, *gone]))
        out.append((bytes(c for c, g in zip(t, gone) if not g), sum(gone), runs))
    return out


def corpus(seed, alphabet, n, size):
    """Texts with copies, shared passages with different surroundings, edits and runs of one letter."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choices(alphabet, k=k))
    shared = [word(rng.randint(size, 3 * size)) for _ in range(4)]
    texts = [None, "", word(size - 1), alphabet[0] * (4 * size)]
    for _ in range(n):
        parts = [word(rng.randint(0, size))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            a, b = sorted((rng.randint(0, len(passage)), rng.randint(0, len(passage))))
            parts += [passage[a:b] if rng.random() < 0.7 else passage, word(rng.randint(0, size // 2))]
        texts.append("".join(parts))
    return texts + rng.sample(texts[4:], 3)


@pytest.mark.parametrize("seed,alphabet,size", [(1, "ab", 16), (2, "abcdefgh", 24), (3, "aé\n", 40)])
def test_equals_brute_force(spark, seed, alphabet, size):
    texts = corpus(seed, alphabet, 40, size)
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, texts[6], "x", 1), (5, texts[5], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, h string, start int").repartition(3)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in s.remove_repeats(docs, size).collect()), key=str)
    raw = [(t or "").encode() for _, t, _, _ in rows]
    want = sorted(((i, len(t), n, k, kept) for (i, _, _, _), t, (kept, n, k) in zip(rows, raw, removed(raw, size))), key=str)
    assert got == want


def test_empty_table_and_no_repeats(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert s.remove_repeats(empty, 20).collect() == []


def test_long_texts_are_cut_with_an_overlap(monkeypatch):
    monkeypatch.setattr(s, "_PIECE", 50)
    rng = random.Random(4)
    text = bytes(rng.choices(b"abc", k=500))
    starts = []
    for i, lo, hi, a, g, c in s.anchors([text, b"", text[:19], text[:20]], 20):
        for t, x, y, z in zip(i, lo, hi, a):
            starts += [(int(t), k) for k in range(x, y + 1)]
            assert x <= z and all(k <= z <= k + 20 - s._gram(20) for k in (x, y))
    assert sorted(starts) == [(0, k) for k in range(481)] + [(3, 0)]


def test_loser_tree_knows_common_prefixes():
    rng = random.Random(5)
    for _ in range(60):
        strings = [bytes(rng.choices(b"ab", k=rng.randint(0, 20))) for _ in range(rng.randint(0, 40))]
        n = rng.randint(1, 6)
        runs = []
        for i in range(n):
            part = sorted(strings[i::n])
            cut = len(part) // 2
            pieces = [(*m.front_code(p), [(x,) for x in p]) for p in (part[:cut], part[cut:]) if p]
            runs.append(m.front_decode(pieces))
        out = list(m.LoserTree(runs))
        assert [k for _, k, _ in out] == sorted(strings)
        for (_, x, _), (n_shared, y, _) in zip(out, out[1:]):
            assert n_shared == m.common_prefix(x, y)


def test_known_prefixes_are_not_compared_again(monkeypatch):
    base = b"z" * 300
    runs = [sorted(base + bytes([i, j]) for j in range(8)) for i in range(4)]
    asked = []
    real = m.common_prefix
    monkeypatch.setattr(m, "common_prefix", lambda x, y, known=0: asked.append(real(x, y, known) - known) or real(x, y, known))
    coded = [(*m.front_code(r), r) for r in runs]
    asked.clear()
    list(m.LoserTree([m.front_decode([c]) for c in coded]))
    assert sum(asked) < 4 * 302 + 64


def test_neighbours_across_ranges(spark):
    rng = random.Random(6)
    keys = sorted({bytes(rng.choices(b"ab", k=12)) for _ in range(300)})
    items = spark.createDataFrame([(i, 0, 0, k + m.BETWEEN + k[:2]) for i, k in enumerate(keys)], "g bigint, c bigint, o bigint, k binary")
    got = Counter((r.g, r["first"], r.second) for r in m.neighbours(items, range_bytes=400).collect())
    want = Counter()
    for i, (x, y) in enumerate(zip(keys, keys[1:])):
        pair = m.common_prefix(x, y), m.common_prefix(x[:2], y[:2])
        want[(i, *pair)] += 1
        want[(i + 1, *pair)] += 1
    assert got == want


def test_tables_go_when_they_are_read(spark, monkeypatch):
    """When the result is made, only the table that it reads is left."""
    made = []
    for module in (s, m):
        real = module.stored
        monkeypatch.setattr(module, "stored", lambda df, name, real=real: made.append(real(df, name)) or made[-1])
    texts = corpus(1, "ab", 40, 16)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    result = s.remove_repeats(docs, 16)
    folders = {t: {f.rpartition("/")[0] for f in t.inputFiles()} for t in made}
    left = {f for own in folders.values() for f in own if os.path.isdir(f.removeprefix("file://"))}
    assert len(made) > 10 and left == folders[made[-1]] and result.count() == len(texts)
