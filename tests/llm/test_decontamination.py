import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import decontamination as d

ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (2, "A train leaves the station at noon and travels sixty miles every single hour"),
    (3, "too short item"),
    (4, None),
    (5, "The quick brown fox jumps over the lazy dog near the old river bank today"),
]


def score(item, passage):
    """Smith-Waterman by the book."""
    best = 0
    rows = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, x in enumerate(item, 1):
        for j, y in enumerate(passage, 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (2 if x == y else -1), rows[i - 1][j] - 1, rows[i][j - 1] - 1)
            best = max(best, rows[i][j])
    return best


def test_alignment_equals_the_book():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.randrange(4) for _ in range(rng.randint(1, 12))]
        b = [rng.randrange(4) for _ in range(rng.randint(1, 25))]
        got, end = d.align(np.array(a), np.array(b))
        assert got == score(a, b) == score(a, b[:end])


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9, "x") for r in rows], "doc_id bigint, text string, item int, words string")


def found(spark, rows, items=ITEMS, **options):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    return {(r.doc_id, r.item_id): r for r in d.contaminated(frame(spark, rows), benchmark, **options).collect()}


FILL = "unrelated words fill this place and carry no meaning of their own at all "


@pytest.mark.parametrize("most_seeds", [1_000_000, 0])
def test_copies_and_edits_are_found_and_others_are_not(spark, most_seeds):
    item = ITEMS[0][1]
    edited = item.replace("lazy", "sleepy").replace("old ", "")
    rows = [
        (1, FILL + item + " " + FILL),
        (2, FILL + item.upper().replace(" ", ",\n") + "! " + FILL),
        (3, FILL + edited + " " + FILL),
        (4, FILL * 20),
        (5, "the quick brown fox jumps high " + FILL),
        (6, None),
        (7, ""),
        (8, (FILL * 400) + ITEMS[1][1] + " " + FILL * 400),
        (None, item),
        (1, "again " + item),
    ]
    got = found(spark, rows, most_seeds=most_seeds)
    assert set(got) == {(k, i) for k in (1, 2, 3, None) for i in (1, 5)} | {(8, 2)}
    assert got[(1, 1)].score == got[(2, 1)].score == got[(8, 2)].score == 1.0
    assert 0.6 <= got[(3, 1)].score < 1
    words = 13
    assert (got[(8, 2)].first_word, got[(8, 2)].end_word) == (400 * 14, 400 * 14 + words + 1)


def test_frequent_seeds_still_find_what_only_they_can(spark):
    rows = [(i, FILL + ITEMS[0][1]) for i in range(30)]
    assert {k for k, _ in found(spark, rows, common=1)} == set(range(30))


def test_edited_copies_of_a_common_item_are_found(spark):
    """The edits make the seeds that are left intact more frequent than those that they break."""
    words = ITEMS[0][1].split()
    edited = " ".join([*words[:5], "edited", *words[6:11], "changed", *words[12:]])
    rows = [(i, FILL + (ITEMS[0][1] if i < 10 else edited)) for i in range(40)]
    got = found(spark, rows, items=ITEMS[:1], common=4)
    want = {(k, 1): score([w.lower() for w in words], t.lower().split()) / (2 * len(words)) for k, t in rows}
    assert {k: r.score for k, r in got.items()} == want
    assert min(want.values()) == 0.8


@pytest.mark.parametrize("most_broadcast", [200_000, 0])
def test_every_item_against_every_document(spark, most_broadcast):
    """All alignments of items and documents that share five words in a row, copies and shared passages included."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(5, 25)))) for i in range(20)]
    items += [(20, " ".join(["all", "of", "these", "share", "it", *rng.choices(words, k=9)])) for _ in range(3)]
    rows = []
    for k in range(120):
        held = list(rng.choice(items)[1].split())
        for _ in range(rng.randint(0, 5)):
            held[rng.randrange(len(held))] = rng.choice(words)
        rows.append((k, " ".join(rng.choices(words, k=rng.randint(0, 60)) + held + rng.choices(words, k=rng.randint(0, 9)))))
    # A third of all rows hold one passage.
    rows += [(200 + k, f"{items[0][1]} all of these share it") for k in range(60)]
    items = [(i, t) for i, (_, t) in enumerate(items)]

    def seeds(ws):
        return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}

    want = {}
    for k, text in rows:
        passage = text.split()
        for i, item in items:
            ws = item.split()
            if seeds(ws) & seeds(passage) and score(ws, passage) / (2 * len(ws)) >= 0.6:
                want[k, i] = score(ws, passage) / (2 * len(ws))
    got = found(spark, rows, items=items, common=8, most_broadcast=most_broadcast)
    assert {pair: r.score for pair, r in got.items()} == want
    assert len(want) > 100


def test_clashing_columns_and_very_long_texts(spark):
    item = ITEMS[0][1]
    rows = [(1, (FILL * 20_000) + item), (2, item)]
    docs = frame(spark, rows).withColumns({c: F.lit(7) for c in ("key", "content", "seeds", "score", "first_word", "i")})
    benchmark = spark.createDataFrame(ITEMS[:1], "item_id bigint, text string").withColumn("seed", F.lit(1))
    got = d.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id, r.score) for r in got} == {(1, 1, 1.0), (2, 1, 1.0)}


def test_empty_tables(spark):
    assert found(spark, [(1, ITEMS[0][1])], items=[(3, None)]) == {}
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert d.contaminated(frame(spark, [(1, "a")]).limit(0), benchmark).collect() == []
    assert d.contaminated(frame(spark, [(1, "a")]), benchmark.limit(0)).collect() == []
