import os
import random
import re
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline as p  # noqa: E402

LEAK = "The quick brown fox jumps over the lazy dog near the old river bank today"


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(n))


ROWS = [
    (1, prose(120, 1)),
    (2, prose(120, 1)),
    (3, prose(60, 2) + "\n" + prose(70, 3)),
    (4, prose(60, 2) + "\n" + prose(70, 4)),
    (5, prose(300, 5)),
    # The same words in other lines, which no line of another document equals.
    (6, "\n".join(" ".join(prose(300, 5).split(" ")[i : i + 100]) for i in (0, 100, 200))),
    (7, prose(80, 7) + " " + LEAK + " " + prose(40, 8)),
    (8, None),
    (9, "few words"),
    (10, "$$$ ### " * 50),
    (11, prose(5000, 11)),
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in ROWS], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, LEAK)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_each_stage_takes_effect(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = {}
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, tables)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = {r.doc_id: r for r in docs.collect()}
    texts = dict(ROWS)
    assert set(kept["quality_rules"]) == {1, 2, 3, 4, 5, 6, 7, 11}
    assert 2 not in kept["line_dedup"] and kept["line_dedup"][1].text == texts[1]
    assert kept["line_dedup"][4].text == prose(70, 4) and kept["line_dedup"][4].n_chars == len(prose(70, 4))
    assert {5, 6} <= set(kept["line_dedup"]) and 6 not in kept["near_dedup"]
    assert set(kept["near_dedup"]) == {1, 3, 4, 5, 7, 11}
    assert set(kept["decontaminate"]) == {1, 3, 4, 5, 11}
    pieces = p.STAGES[-1][1](spark, docs, tables).collect()
    assert {r.doc_id for r in pieces} == set(kept["decontaminate"])


def test_run_equals_its_stages(spark, tables):
    got = p.run(spark, tables).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d")).collect()
    assert {r.doc_id for r in got} == {1, 3, 4, 5, 11} and all(r.n == r.d for r in got)


def test_registered_queries():
    names = set(entry.queries())
    for n in range(1, 14):
        assert sum(bool(re.match(rf"op{n}_", x)) for x in names) == 1
    assert "pipeline" in names
    assert set(entry.oracle_sql()) <= names


FULL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def odd(spark, rows):
    """Documents with columns that clash with names inside of the stages."""
    extra = ", n_words bigint, `a.b` string, key string, id string, digest string, __n_gone int"
    return spark.createDataFrame([(i, t, "en", "s", 7, 60, "dot", "k", "i", "d", 5) for i, t in rows], FULL + extra)


ODD = [(1, prose(60, 21)), (1, prose(60, 22)), (None, prose(60, 23)), (None, prose(60, 24)), (None, prose(60, 24)), (2, prose(60, 21)), (3, prose(60, 25)), (3, prose(60, 25))]


def places(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_near_dedup_keeps_unlike_rows_of_one_id_and_one_of_repeated_rows(spark, tables):
    got = p.near_dedup(spark, odd(spark, ODD), tables)
    assert places(got) == sorted([ODD[0], ODD[1], ODD[2], ODD[3], ODD[6]], key=str)
    assert {tuple(r)[2:] for r in got.collect()} == {("en", "s", 7, 60, "dot", "k", "i", "d", 5)}


def test_decontaminate_takes_only_texts_that_hold_an_item(spark, tables):
    leaked = prose(20, 30) + " " + LEAK
    rows = [(None, leaked), (None, prose(40, 31)), (1, leaked), (1, prose(40, 32)), (2, None), (3, "")]
    got = p.decontaminate(spark, odd(spark, rows), tables)
    assert places(got) == sorted([rows[1], rows[3], rows[4], rows[5]], key=str)


@pytest.mark.parametrize("name, stage", p.STAGES[:-1])
def test_stages_keep_clashing_columns_and_take_empty_tables(spark, tables, name, stage):
    docs = odd(spark, [(1, prose(80, 40)), (None, None), (2, "")])
    got = stage(spark, docs, tables)
    assert got.columns == docs.columns
    assert {tuple(r)[5:] for r in got.collect()} == {(60, "dot", "k", "i", "d", 5)}
    assert 1 in {r.doc_id for r in got.collect()}
    assert stage(spark, docs.limit(0), tables).collect() == []


def test_pack_takes_nulls_repeats_and_empty_tables(spark, tables):
    docs = odd(spark, [(1, "a b"), (1, "a b"), (None, None)])
    got = p.pack(spark, docs, tables).collect()
    assert [r.length for r in got if r.doc_id is None] == [1]
    assert sum(r.length for r in got if r.doc_id == 1) == 2 * max(r.doc_tokens for r in got)
    assert p.pack(spark, docs.limit(0), tables).collect() == []


def test_line_dedup_finds_a_word_with_two_edits_near_its_ends(spark):
    docs = spark.createDataFrame([(1, "abcdefghij\nkeep one", 19), (2, "axcdefghxj\nother words stay", 27)], "doc_id bigint, text string, n_chars bigint")
    got = {r.doc_id: r.text for r in p.line_dedup(spark, docs, "").collect()}
    assert got == {1: "abcdefghij\nkeep one", 2: "other words stay"}
