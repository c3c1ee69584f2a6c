import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import quality_ledger as q

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def measured(text):
    raw = (text or "").encode()
    words = WORD.findall(raw)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    lines = [x for x in raw.split(b"\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(len(w.decode()) for w in words),
        "n_symbols": sum(raw.count(bytes([c])) for c in b"#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "n_lines": len(lines),
        "n_echo_words": sum(a == b for a, b in zip(words, words[1:])),
    }


def thue_morse(n):
    signs = ["-" if bin(i).count("1") % 2 else "Y" for i in range(n)]
    return "".join(signs), "".join(signs).translate(str.maketrans("-Y", "Y-"))


THUE_MORSE = thue_morse(2048)
TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "a b c d e a b c d e",
    "a b c d e f g h i j",
    "été été été été été été # $ | x",
    "same line here\nsame line here\n\nother\nsame line here",
    "w " * 5000,
    " ".join(f"w{i % 700}" for i in range(30_000)),
    "x y z w",
    "\x0bv\x0ct\r\nu",
    # Two different words whose hash by powers modulo 2**64 is the same.
    " ".join(["a b", THUE_MORSE[0], "c d", "a b", THUE_MORSE[1], "c d"]),
]


@pytest.fixture
def docs(spark):
    rows = [(i, t, "kept", 5) for i, t in enumerate(TEXTS)] + [(0, "one", "kept", 5), (None, "one two", None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, N_WORDS int")


def test_measurements_equal_brute_force(docs):
    got = q.build_ledger(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for row in got:
        want = measured(row.text)
        assert {m: row[m] for m in q.MEASURES} == want, row.text and row.text[:40]


def test_other_columns_stay_and_clashing_ones_are_replaced(docs):
    ledger = q.build_ledger(docs)
    assert ledger.columns == ["doc_id", "text", "source", *q.MEASURES, "failed"]


def test_base_policy(docs):
    for row in q.build_ledger(docs).withColumn("ok", q.accepted(q.BASE)).collect():
        failed = row.n_words < 10 or 100 * row.n_repeat_words > 20 * row.n_words
        assert row.ok == (not failed)


def test_policies_read_only_the_ledger(docs):
    ledger = q.build_ledger(docs)
    one = q.Policy("one", ("symbols",))
    assert one.mask == 4
    rows = ledger.select(q.accepted(one).alias("a"), (10 * F.col("n_symbols") > F.col("n_words")).alias("f")).collect()
    assert all(r.a != r.f for r in rows)


def test_ablation_counts(docs):
    ledger = q.build_ledger(docs)
    rows = [r.failed for r in ledger.select("failed").collect()]
    got = {r.rule: (r.n_failed, r.n_only_this) for r in q.ablation(ledger).collect()}
    for rule in q.RULES:
        if rule.name in got:
            bit = 1 << rule.bit
            assert got[rule.name] == (sum(bool(f & bit) for f in rows), sum(f & q.STANDARD.mask == bit for f in rows))


def test_empty_table(docs):
    assert q.build_ledger(docs.limit(0)).collect() == []
    assert q.ablation(q.build_ledger(docs.limit(0))).collect() == []
