import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import language_id as m

SAMPLES = {
    "en": ["the cat and the dog went with them to the house", "this is what they thought about the weather", "nothing in the world is there for them"],
    "fr": ["le chat et le chien sont dans la maison avec eux", "ce que nous avons vu est une belle chose", "rien dans le monde ne vous est plus utile"],
    "el": ["η γάτα και ο σκύλος είναι στο σπίτι", "αυτό που είδαμε ήταν ωραίο"],
    "ru": ["кошка и собака живут в доме", "это было очень красиво"],
    "uk": ["кішка і собака живуть у будинку", "це було дуже гарно"],
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t, lang, 1) for lang, texts in SAMPLES.items() for t in texts] + [("no language", None, 1), (None, "en", 1), ("123", "xx", 1)]
    return m.learn(spark.createDataFrame(rows, "text string, lang string, h int"))


def test_languages_and_scripts_are_learned(model):
    assert model.languages == ("el", "en", "fr", "ru", "uk")
    names = ["other", *m.SCRIPTS]
    uses = {lang: {names[i] for i in np.flatnonzero(row)} for lang, row in zip(model.languages, model.scripts)}
    assert uses == {"el": {"Greek"}, "en": {"Latin"}, "fr": {"Latin"}, "ru": {"Cyrillic"}, "uk": {"Cyrillic"}}


def test_texts_and_spans(model):
    mixed = "the house and the weather. le chien est dans la maison, κόσμος ωραίο"
    texts = ["the dog in the house", "les chiens sont dans la maison", "КОШКА И СОБАКА", "", "12 -- 34", mixed, "ქართული ენა", "the " * 50_000]
    predicted, scores, spans = m.label_texts(texts, model)
    assert predicted[:5] == ["en", "fr", "ru", "und", "und"] and scores[3] == scores[4] == 0 and scores[0] == 1
    assert [(mixed[a:b].strip(), lang) for a, b, lang in spans[5]] == [
        ("the house and the weather", "en"), ("le chien est dans la maison", "fr"), ("κόσμος ωραίο", "el")
    ]
    assert predicted[6] in model.languages and predicted[7] == "en" and spans[7] == [(0, 4 * 50_000 - 1, "en")]


def test_script_without_spaces_cuts_words():
    words = m.Words(["abcДЕЖ x́y", "日本ab"])
    joined = "\nabcДЕЖ x́y\n日本ab\n"
    assert [joined[a:b] for a, b in zip(words.starts, words.ends)] == ["abc", "ДЕЖ", "x́y", "日本", "ab"]
    assert words.letters.tolist() == [3, 3, 2, 2, 2] and words.text.tolist() == [0, 0, 0, 1, 1]


def test_words_are_scored_alike_wherever_they_stand(model):
    one = m.word_scores(m.Words(["maison"]), model)
    more = m.word_scores(m.Words(["дом maisonдом", "", "x maison."]), model)
    assert np.allclose(more[[1, 4]], one[0])


def test_viterbi_equals_all_sequences():
    rng = np.random.default_rng(3)
    lengths = np.array([4, 1, 0, 6, 3])
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    scores = rng.normal(0, 3, (lengths.sum(), 3))
    path = m.best_path(scores, firsts, lengths, 2.0)

    def value(a, states):
        return sum(scores[a + i, s] for i, s in enumerate(states)) - 2.0 * sum(x != y for x, y in zip(states, states[1:]))

    for a, n in zip(firsts, lengths):
        best = max(value(a, s) for s in itertools.product(range(3), repeat=int(n)))
        assert value(a, path[a : a + n].tolist()) == pytest.approx(best)


def test_batches_label_like_single_texts(model):
    texts = [t for own in SAMPLES.values() for t in own] + ["", "!", "le the и"]
    together = m.label_texts(texts, model)
    alone = [m.label_texts([t], model) for t in texts]
    assert together[0] == [a[0][0] for a in alone] and together[2] == [a[2][0] for a in alone]


def test_label_keeps_other_columns_and_answers_odd_rows(spark, model):
    rows = [(1, "the dog", "x", 0.5, 1), (1, "the dog", "x", 0.5, 1), (None, None, None, None, None), (2, "", "y", 1.0, 2), (3, "42", "z", 1.0, 3)]
    docs = spark.createDataFrame(rows, "id bigint, text string, `a.b` string, Score double, __text int")
    out = m.label(docs, model, spans=True)
    assert out.columns == ["id", "a.b", "__text", "lang_pred", "score", "spans"]
    got = sorted(map(tuple, out.select("id", "`a.b`", "__text", "lang_pred", "score").collect()), key=str)
    assert got == sorted([(1, "x", 1, "en", 1.0)] * 2 + [(None, None, None, "und", 0.0), (2, "y", 2, "und", 0.0), (3, "z", 3, "und", 0.0)], key=str)


def test_nothing_to_learn_and_empty_tables(spark, model):
    docs = spark.createDataFrame([(1, "words here", None)], "id bigint, text string, lang string")
    nothing = m.learn(docs)
    assert nothing.languages == () and m.label(docs, nothing).select("lang_pred", "score").collect() == [("und", 0.0)]
    assert m.label(docs.limit(0), model).collect() == []


def test_sample_is_bounded_and_copies_teach_once(spark):
    docs = spark.createDataFrame([("same words", "en")] * 500 + [(f"text number {i}", "en") for i in range(40)], "text string, lang string")
    settings = m.Settings(rows=10)
    chosen = [r.text for r in m.training_rows(docs, "text", "lang", settings).collect()]
    assert len(chosen) == len(set(chosen)) == 10


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", m.held_out(F.col("doc_id")))
    out = m.label(docs.select("doc_id", "text", "held_out", F.col("lang").alias("known")), m.learn(docs.filter("not held_out")))
    hits, n = out.filter("held_out").agg(F.sum(F.expr("int(lang_pred = known)")), F.count("*")).first()
    assert n > 150 and hits >= 0.98 * n
