"""The two row rules of incoming sales on a stream.

Pricing is the batch function on a stream-static join. Stock is kept as a base
snapshot and a ledger of what each micro-batch sold per key, so a batch writes
only its own sums, whatever the size of the stock table; ``compact`` folds the
ledger into a new base now and then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.ingest import price_facts, sold_per_key
from ledgerline.sources.sinks import drop_path, folder_names, publish_snapshot


def read_facts(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """New parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def priced_stream(facts: DataFrame, prices: DataFrame, key: str, quantity: str = "quantity") -> DataFrame:
    """Every arriving row gets its amount from the price table."""
    return price_facts(facts, prices, key, quantity=quantity)


class StockLedger:
    """Sold quantities per micro-batch below ``root``, one folder per batch id.

    A batch that is replayed after a failure overwrites its own folder, so each
    batch counts once. Without any batch the stock is the base.
    """

    def __init__(self, root: str, key: Sequence[str], quantity: str = "quantity"):
        self.root = root
        self.key = list(key)
        self.quantity = quantity

    def record(self, batch: DataFrame, batch_id: int) -> None:
        sold = sold_per_key(batch, self.key, self.quantity)
        sold.write.mode("overwrite").parquet(f"{self.root}/batch_id={batch_id}")

    def _batches(self, spark: SparkSession) -> list[int]:
        """Recorded batch ids, from the folder names."""
        names = folder_names(spark, self.root)
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith("batch_id="))

    def last_batch(self, spark: SparkSession) -> int | None:
        """Largest recorded batch id, None before the first."""
        return max(self._batches(spark), default=None)

    def stock(
        self,
        base: DataFrame,
        available: str = "quantity_available",
        after_batch: int = -1,
        up_to_batch: int | None = None,
    ) -> DataFrame:
        """The base less what the batches after ``after_batch``, up to ``up_to_batch``, sold."""
        spark = base.sparkSession
        wanted = [b for b in self._batches(spark) if b > after_batch and (up_to_batch is None or b <= up_to_batch)]
        if not wanted:
            return base
        schema = T.StructType([*[base.schema[k] for k in self.key], T.StructField("sold", T.DecimalType(28, 2))])
        ledger = spark.read.schema(schema).parquet(*[f"{self.root}/batch_id={b}" for b in wanted])
        sold = ledger.groupBy(*self.key).agg(F.sum("sold").alias("sold"))
        left = F.col(available).cast("decimal(28,2)") - F.coalesce(F.col("sold"), F.lit(0))
        return base.join(sold, self.key, "left").withColumn(available, left.cast("decimal(28,2)")).select(*base.columns)

    def compact(
        self, base: DataFrame, base_root: str, available: str = "quantity_available", after_batch: int = -1
    ) -> tuple[DataFrame, int]:
        """Fold the ledger into a new base version. Returns it and the last batch it holds,
        which is the ``after_batch`` of later reads; batches that arrive meanwhile stay out.
        Without a new batch the base stays as it is."""
        last = self.last_batch(base.sparkSession)
        if last is None or last <= after_batch:
            return base, after_batch
        folded = self.stock(base, available, after_batch, last)
        return publish_snapshot(folded, base_root, last), last

    def retire(self, spark: SparkSession, up_to_batch: int) -> None:
        """Remove the batches that a published base holds, once no reader needs an older base."""
        for batch in self._batches(spark):
            if batch <= up_to_batch:
                drop_path(spark, f"{self.root}/batch_id={batch}")


def run_available(facts: DataFrame, ledger: StockLedger, checkpoint: str) -> StreamingQuery:
    """Record all files that are there and stop."""
    query = (
        facts.writeStream.foreachBatch(ledger.record)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
