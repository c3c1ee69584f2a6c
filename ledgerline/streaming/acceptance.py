"""Sales judged one by one as they arrive, with the balance of each key as state.

The same rule as ``operators.ingest.accept_rows``: a fact that its key's balance does not cover is refused and takes nothing. The
balance starts from a stock table and lives in the state store, so a batch that is replayed after a failure, or a restart from the checkpoint,
gives the same rows. Within a micro-batch facts are taken in their order, across batches as they arrive. Every row comes
out, with ``accepted`` and the balance after it, so refused rows are a filter away.

The facts of one key in one micro-batch are sorted in one task, which ``files_per_batch`` of the source bounds; a table with hot keys that is there as
a whole is for ``accept_rows``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerline.operators.ingest import QUANTITY

#: State variables of this kind need it; to be set on the session that runs the stream.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_CENTS = "__cents"


class Balance(StatefulProcessor):
    """Keeps what is left of a key's stock in hundredths; without stock nothing is refused."""

    def __init__(self, columns: Sequence[str], order: Sequence[str]):
        self.columns, self.order = list(columns), list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.left = handle.getValueState("left", "cents bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.left.exists()
        left = self.left.get()[0] if known else 0
        for row in sorted(rows, key=lambda r: ([(r[c] is not None, r[c]) for c in self.order], r[_CENTS])):
            cents = row[_CENTS]
            accepted = cents >= 0 and (not known or cents <= left)
            if known and accepted:
                left -= cents
            yield Row(**{c: row[c] for c in self.columns}, accepted=accepted, balance_cents=left if known else None)
        if known:
            self.left.update((left,))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if initialState["cents"] is not None:
            self.left.update((initialState["cents"],))

    def close(self) -> None:
        pass


def judged_stream(
    facts: DataFrame, stock: DataFrame, key: Sequence[str], order: Sequence[str], available: str = "quantity_available", quantity: str = "quantity"
) -> DataFrame:
    """The facts of a stream with ``accepted`` and ``balance_cents``; ``stock`` is read when the stream first starts.

    A null quantity takes nothing, one below zero is refused; of several stock rows of a key the least decides.
    """
    cents = F.coalesce(F.col(quantity).cast(QUANTITY) * 100, F.lit(0)).cast("bigint")
    marked = facts.withColumn(_CENTS, cents)
    start = stock.groupBy(*key).agg(F.min((F.col(available).cast("decimal(28,2)") * 100).cast("bigint")).alias("cents"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in facts.schema.fields]
    return marked.groupBy(*key).transformWithState(
        statefulProcessor=Balance(facts.columns, order),
        outputStructType=", ".join([*kinds, "accepted boolean", "balance_cents bigint"]),
        outputMode="append",
        timeMode="none",
        initialState=start.groupBy(*key),
    )


def run_judged(judged: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the judged facts of all files that are there below ``path`` and stop."""
    query = (
        judged.writeStream.option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
        .start()
    )
    query.awaitTermination()
    return query
