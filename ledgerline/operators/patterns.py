"""Rows whose text fits a pattern, found through stored trigrams instead of a scan.

A text that fits ``%green%`` holds the runs ``gre``, ``ree`` and ``een``. ``TrigramIndex`` keeps every run of three characters of a text beside the row's
key, in folders by a hash of the run and sorted by it; a search reads the folders and row groups of the pattern's runs alone, keeps
the keys that have them all, fetches these rows by a join and tests the pattern itself. A pattern without a run of three
characters between wildcards is answered by a scan.

Postings are added with ``extend``. Those of deleted or changed rows do no harm, since every row is tested again; new texts must be added. A row with a
null key has no posting and is tested in any case; a null text fits nothing; repeated keys and rows are found like others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.lookup import thin

SIZE = 3


def literal_runs(pattern: str, escape: str = "\\") -> list[str]:
    """What a LIKE pattern holds between its wildcards."""
    runs, run, i = [], "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == escape and i + 1 < len(pattern):
            i += 1
            run += pattern[i]
        elif c in "%_":
            runs.append(run)
            run = ""
        else:
            run += c
        i += 1
    return [r for r in [*runs, run] if r]


def trigrams(text: Column) -> Column:
    """The different runs of three characters, as an array; empty for shorter texts, null for null."""
    starts = F.sequence(F.lit(1), F.length(text) - (SIZE - 1))
    every = F.transform(starts, lambda i: F.substr(text, i, F.lit(SIZE)))
    return F.when(F.length(text) >= SIZE, F.array_distinct(every)).when(text.isNotNull(), F.array().cast("array<string>"))


@dataclass(frozen=True)
class TrigramIndex:
    """Postings below ``path``; ``any_case`` answers ILIKE, otherwise LIKE."""

    spark: SparkSession
    path: str
    any_case: bool = True
    buckets: int = 64

    def _folded(self, text: Column) -> Column:
        return F.lower(text) if self.any_case else text

    def _bucket(self, gram: Column) -> Column:
        return F.pmod(F.xxhash64(gram), F.lit(self.buckets)).cast("int")

    def extend(self, rows: DataFrame, key: str, text: str) -> None:
        """Add the postings of some rows."""
        grams = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.explode(trigrams(self._folded(F.col(text)))).alias("gram"))
        placed = grams.withColumn("bucket", self._bucket(F.col("gram"))).hint("rebalance", "bucket")
        placed.sortWithinPartitions("bucket", "gram").write.mode("append").partitionBy("bucket").parquet(self.path)

    def grams_of(self, pattern: str) -> list[tuple[str, int]]:
        """The pattern's trigrams and their folders."""
        runs = [r for r in literal_runs(pattern) if len(r) >= SIZE]
        if not runs:
            return []
        texts = self.spark.createDataFrame([(r,) for r in runs], "run string")
        grams = texts.select(F.explode(trigrams(self._folded(F.col("run")))).alias("gram")).distinct()
        return [tuple(r) for r in grams.select("gram", self._bucket(F.col("gram"))).collect()]

    def keys(self, pattern: str) -> DataFrame | None:
        """``key`` of the rows that have all the pattern's trigrams; None where the pattern has none."""
        grams = self.grams_of(pattern)
        if not grams:
            return None
        names, folders = (sorted({g[i] for g in grams}) for i in (0, 1))
        postings = self.spark.read.parquet(self.path).filter(F.col("bucket").isin(folders) & F.col("gram").isin(names))
        having = postings.groupBy("key").agg(F.count_distinct("gram").alias("n"))
        return having.filter(F.col("n") == len(names)).select("key")

    def search(self, rows: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
        """The rows whose text fits the pattern."""
        fits = F.col(text).ilike(pattern) if self.any_case else F.col(text).like(pattern)
        found = self.keys(pattern)
        if found is None:
            return rows.filter(fits)
        listed = thin(found.withColumnRenamed("key", "__key"), ["__key"])
        known = rows.join(listed, rows[key] == listed["__key"], "left_semi")
        return known.unionAll(rows.filter(F.col(key).isNull())).filter(fits)
