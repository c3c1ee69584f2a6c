import public_tokenizers
import pytest
import sentencepiece

from ledgerline.llm import token_counts as t

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ROWS = [(1, "Hello world"), (2, None), (3, ""), (4, "Hello world"), (4, "Hello world"), (5, "é" * 3000), (None, "a b"), (6, "<s> </s> x"), (7, " \n  y")]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(*r, "s", "d") for r in ROWS], "doc_id bigint, text string, digest string, key string")


def want(rows):
    pieces = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return sorted(((i, len((x or "").encode()), len(pieces.encode(x or ""))) for i, x in rows), key=str)


def test_counts_equal_the_library(docs, tmp_path):
    got = t.count_tokens(docs, MODEL, str(tmp_path / "cache"))
    assert sorted(map(tuple, got.collect()), key=str) == want(ROWS)


def test_each_content_is_encoded_once_and_then_found(spark, docs, tmp_path):
    cache = str(tmp_path / "cache")
    t.count_tokens(docs, MODEL, cache).collect()
    contents = {x or "" for _, x in ROWS}
    assert spark.read.parquet(cache).select("digest").distinct().count() == len(contents)
    before = spark.read.parquet(cache).count()
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(9, "new text")], "doc_id bigint, text string"))
    got = t.count_tokens(more, MODEL, cache)
    assert sorted(map(tuple, got.collect()), key=str) == want([*ROWS, (9, "new text")])
    assert spark.read.parquet(cache).count() == before + 1


def test_another_tokenizer_has_its_own_counts(docs, tmp_path):
    cache = str(tmp_path / "cache")
    t.count_tokens(docs, MODEL, cache).collect()
    other = t.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), cache)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = sorted(((i, len((x or "").encode()), len(tokenizer.encode(x or "", add_special_tokens=False).ids)) for i, x in ROWS), key=str)
    assert sorted(map(tuple, other.collect()), key=str) == expected


def test_empty_table(docs, tmp_path):
    assert t.count_tokens(docs.limit(0), MODEL, str(tmp_path / "cache")).collect() == []
