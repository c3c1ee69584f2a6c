import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import toxicity as x

BAD = ("grimble", "snarkle", "blorten")


def texts(n, seed):
    """Neutral words; a third also holds forms of bad words, in any place."""
    rng = random.Random(seed)
    neutral = [a + b for a in ("mo", "ta", "li", "ke", "ru") for b in ("ban", "der", "sil", "fon", "gat")]
    rows = []
    for i in range(n):
        words = rng.choices(neutral, k=rng.randint(5, 120))
        toxic = i % 3 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(("", "s", "er", "!!", "ous")))
        rows.append((i, " ".join(words), rng.choice(("en", "fr", None)), int(toxic)))
    return rows


P = x.Training(steps=400, bucket_bits=14)


@pytest.fixture(scope="module")
def model():
    rows = texts(400, 1)
    return x.train([t.encode() for _, t, _, _ in rows], np.array([y for *_, y in rows]), [lang for _, _, lang, _ in rows], P)


def test_held_out_texts_are_told_apart(model):
    rows = texts(300, 2)
    scores = model.scores([t.encode() for _, t, _, _ in rows])
    labels = np.array([y for *_, y in rows])
    assert ((scores >= x.DECISION) == labels).mean() > 0.95
    assert set(model.thresholds) <= {"en", "fr"}


def test_scores_do_not_depend_on_neighbours(model):
    some = [t.encode() for _, t, _, _ in texts(30, 3)] + [b"", b"  ", b"one", b"word " * 60_000]
    together = model.scores(some)
    alone = np.concatenate([model.scores([t]) for t in some])
    assert np.allclose(together, alone, atol=1e-6)
    assert ((together >= 0) & (together <= 1)).all()


def test_the_convolution_equals_the_definition(model):
    text = b"moban tader grimbles lisil"
    hashes, borders = x.features([text])
    rows = [model.table[r].sum(axis=0) for r in model.buckets(hashes)] + [np.zeros(P.dim, np.float32)] * x.PAD
    pooled = []
    for i, width in enumerate(x.WIDTHS):
        outs = [sum(rows[t + j] @ model.filters[i][j] for j in range(width)) + model.bias[i] for t in range(4)]
        pooled.append(np.maximum(np.max(outs, axis=0), 0))
    want = np.concatenate(pooled) @ model.weights + model.offset
    assert np.allclose(model.logits(hashes, borders), [want], atol=1e-4)


def test_words_not_seen_in_training_count_as_nothing(model):
    unknown = model.scores([b"", b"zzyzx qwvut", b"12 ?? !!"])
    assert np.allclose(unknown, unknown[0])


def test_fit_and_score(spark):
    rows = texts(150, 4) + [(1000, None, "en", 0), (1001, "", None, None), (1002, "moban", None, None)]
    docs = spark.createDataFrame([(i, t, lang, 0.5) for i, t, lang, _ in rows], "doc_id bigint, text string, lang string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, _, y in rows] + [(0, None), (1, 0)], "doc_id bigint, toxic int")
    small = x.Training(steps=200, bucket_bits=12, positives=40, negatives=60)
    found = x.fit(docs, labels, F.col("doc_id") % 2 == 0, small)
    assert found.table.shape == ((1 << 12) + 1, small.dim)
    got = x.score(docs.repartition(3), found).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    assert got[0].asDict().keys() == {"doc_id", "text", "lang", "score", "flagged"}
    assert all(0 <= r.score <= 1 for r in got)


def test_without_both_labels_every_score_is_zero(spark):
    docs = spark.createDataFrame([(1, "a", "en"), (2, None, None)], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int")
    none = x.fit(docs, labels, F.lit(True))
    assert none is None
    assert {(r.score, r.flagged) for r in x.score(docs, none).collect()} == {(0.0, False)}
    assert x.score(docs.limit(0), none).collect() == []


def test_long_texts_are_learned_from(spark):
    """All toxic rows are long ones."""
    rows = [(i, (t + " ") * (1 if not y else 1 + 20_000 // len(t)), lang, y) for i, t, lang, y in texts(90, 5)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id bigint, toxic int")
    found = x.fit(docs, labels, F.lit(True), x.Training(steps=200, bucket_bits=12))
    scores = found.scores([b"moban tader grimbles", b"moban tader lisil", b"blorten", b"kefon"]) >= x.DECISION
    assert scores.tolist() == [True, False, True, False]


def test_all_rows_reach_the_vocabulary(spark):
    """Each rare word is in two of 6,400 texts; in some bucket another word may be the one in more texts."""
    rows = spark.range(6400).selectExpr("id AS doc_id", "concat('moban rare', id div 2, if(id % 100 = 0, ' grimble', '')) AS text", "'en' AS lang")
    labels = rows.selectExpr("doc_id", "int(doc_id % 100 = 0) AS toxic")
    model = x.fit(rows, labels, F.lit(True), x.Training(steps=1, epochs=1))
    learns = rows.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(5)) > 0).alias("learns")).collect()
    learns = {r.doc_id: r.learns for r in learns}
    twice = [f"rare{i}".encode() for i in range(3200) if learns[2 * i] and learns[2 * i + 1]]
    known = model.buckets(x.features(twice)[0][:, 0]) != model.pad
    assert len(twice) > 1800 and known.mean() > 0.95


def test_the_model_does_not_depend_on_partitions(spark):
    rows = texts(200, 6)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id bigint, toxic int")
    p = x.Training(epochs=2, steps=60, bucket_bits=12, shard_bytes=16_000)
    a, b = (x.fit(docs.repartition(n), labels, F.lit(True), p) for n in (1, 5))
    assert (a.table == b.table).all() and (a.owner == b.owner).all() and a.offset == b.offset
    assert (a.cut, a.thresholds) == (b.cut, b.thresholds) and set(a.thresholds) == {"en", "fr"}
    scores = a.scores([t.encode() for _, t, _, _ in rows]) >= x.DECISION
    assert (scores == np.array([y for *_, y in rows])).mean() > 0.9


def test_long_texts_are_trained_on_in_pieces(model, monkeypatch):
    some = [t.encode() for _, t, _, _ in texts(20, 7)] + [b"", b"one"]
    shard = x._Shard.of(model, some, np.zeros(len(some)))
    placed = shard.padded(np.arange(len(some)))
    whole = x._pooled(model, shard.entries, *placed)
    want = np.maximum(whole[0], 0) @ model.weights + model.offset
    assert np.allclose(model.logits(*x.features(some)), want, atol=1e-4)
    monkeypatch.setattr(x, "WORDS", 7)
    pieces = x._pooled(model, shard.entries, *placed)
    assert np.allclose(whole[0], pieces[0], atol=1e-5) and (whole[1] == pieces[1]).mean() > 0.99
