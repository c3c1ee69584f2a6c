import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing as p

MODEL = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None,
    "",
    " \t\n",
    "It's we'll don't. (x). ... A1b2 5th x1.",
    "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>",
    "İstanbul ΣΑΣ σς Straße ǅ",
    "H̱ Å Ǻ K  x y \u0085z",
    "日本語 текст emoji 👩‍👩‍👧 éé.",
    "$$$ ### the%%% a...b \x00 \x7f",
    "word, word; word: Word! WORD? word.,;",
]


def ids_of(text):
    return [*Tokenizer.from_file(MODEL).encode(text or "", add_special_tokens=False).ids, 1]


def test_words_give_the_ids_of_the_whole_text():
    rng = random.Random(3)
    letters = "abcDE éßñ.,!'<|>1$\ń"
    texts = [*(t or "" for t in ODD), *("".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(400))]
    tokenizer = Tokenizer.from_file(MODEL)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    got = p.WordEncoder(MODEL).encode([t.encode() for t in texts])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want


def check(pieces, docs, limits, key="doc_id"):
    """Every id in exactly one piece, sequences gapless and within the limits."""
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r[key], []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == {i for i, _ in docs}
    for i, text in docs:
        ids, at = ids_of(text), 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == np.cumsum([0, *[r.length for r in rows]])[:-1].tolist()
        n = sum(r.length for r in rows)
        assert n <= limits.tokens and len(rows) <= limits.segments and sum(r.loss_tokens for r in rows) <= limits.loss
        padding += 0 if n & (n - 1) == 0 else limits.tokens - n
        total += n
    return padding / total


@pytest.mark.parametrize("limits", [p.Limits(), p.Limits(64, 5, 64, 0), p.Limits(64, 100, 40, 3)])
def test_all_limits_hold(spark, limits):
    rng = random.Random(limits.segments)
    docs = [(i, t) for i, t in enumerate(ODD)]
    docs += [(100 + i, " ".join(rng.choice(("alpha", "beta", "c", "delta.")) for _ in range(rng.choice((1, 3, 30, 400))))) for i in range(120)]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, start string").repartition(3)
    padding = check(p.tokenize_and_pack(frame, MODEL, limits).collect(), docs, limits)
    if limits == p.Limits():
        assert padding < 0.01


def test_prompts_bear_no_loss(spark):
    rows = [(1, "a b c d", 3), (2, "a b c d", None), (3, "a", 9)]
    frame = spark.createDataFrame(rows, "conv_id bigint, text string, prompt int")
    got = p.tokenize_and_pack(frame, MODEL, key="conv_id", loss_from="prompt").collect()
    loss = {}
    for r in got:
        loss[r.conv_id] = loss.get(r.conv_id, 0) + r.loss_tokens
    assert loss == {1: 2, 2: 4, 3: 0}


def test_a_very_long_text_and_repeated_rows(spark):
    long = "many words here " * 30_000
    frame = spark.createDataFrame([(1, long), (2, "x"), (2, "x"), (None, "y")], "doc_id bigint, text string").coalesce(1)
    got = p.tokenize_and_pack(frame, MODEL).collect()
    assert sum(r.length for r in got if r.doc_id == 1) == 90_001
    assert sum(r.length for r in got if r.doc_id == 2) == 4
    assert sum(r.length for r in got if r.doc_id is None) == 2


def test_empty_table(spark):
    assert p.tokenize_and_pack(spark.createDataFrame([], "doc_id bigint, text string"), MODEL).collect() == []


def test_the_fullest_match_is_chosen():
    packer = p.Packer(p.Limits(10, 3, 10, 0), 0)
    for i, n in enumerate((7, 3, 5, 2)):
        packer.example(i, bytes(4 * n), 0)
    packer.pack(0)
    assert sorted([x[0] for x in packer.out if x[5] == 0]) == [0, 1]
