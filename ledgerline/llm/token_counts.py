"""Token counts with a digest cache.

A text is looked up by the digest of its content and the digest of the tokenizer's file. Only texts that the
cache does not know are encoded, each distinct one once; their counts are appended to the cache, from which
the result is then read. The cache is a parquet table; several runs may append to it at a time, and a count that
two runs both added is the same number, so readers take each digest once.

Nulls and odd rows: a null text counts as the empty text (no tokens); repeated rows all get their count; a null
or repeated ``doc_id`` is an ordinary value; an empty table gives no rows; columns other than key and text are
left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.texts import slices, utf8

CACHE_SCHEMA = "tokenizer string, digest string, n_tokens bigint"


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer's file: another file, another version."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _counter(path: str):
    """Counts of a list of UTF-8 texts, as the library gives them without begin, end or added tokens."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode([t.decode() for t in texts], num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [
        len(e.ids) for e in tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
    ]


def encode_counts(texts: DataFrame, path: str) -> DataFrame:
    """``(digest, text)`` to ``(digest, n_tokens)``, in slices of one megabyte."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in batches:
            contents = utf8(batch.column("text"))
            counts = [n for a, b in slices(contents, 1 << 20) for n in count(contents[a:b])]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(task, "digest string, n_tokens bigint")


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Counts of one tokenizer version, one row per digest."""
    if not _exists(spark, cache):
        return spark.createDataFrame([], "digest string, n_tokens bigint")
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def content(text: str) -> Column:
    """The content that a digest stands for; a tokenizer sees nothing else."""
    return F.coalesce(F.col(text), F.lit(""))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens`` of every row; appends what the cache at ``cache`` lacks, when called.

    Texts move once: the first row of each unknown digest is found on digests alone, and the rows with their texts
    meet that list by key and digest. A content that a third of the rows share is one row of the list.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    rows = docs.select(F.col(key).alias("key"), content(text).alias("text"))
    rows = rows.withColumn("digest", F.sha2(F.col("text"), 256))
    firsts = rows.groupBy("digest").agg(F.min("key").alias("key"))
    known = read_cache(spark, cache, version)
    missing = firsts.join(known, "digest", "left_anti").select(F.col("digest").alias("m_digest"), F.col("key").alias("m_key"))
    same = (F.col("digest") == F.col("m_digest")) & F.col("key").eqNullSafe(F.col("m_key"))
    fresh = rows.join(missing, same, "left_semi")
    counted = encode_counts(fresh, tokenizer).select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
    counted.write.mode("append").parquet(cache)
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == version)
    stored = stored.select("digest", "n_tokens").dropDuplicates(["digest", "n_tokens"])
    sized = rows.select("key", F.octet_length("text").cast("bigint").alias("n_bytes"), "digest")
    return sized.join(stored, "digest", "inner").select(F.col("key").alias(key), "n_bytes", "n_tokens")
