"""Incoming facts: price enrichment, stock folding, fact load by natural key.

The functions take batch or streaming facts alike, as long as the other side is a
table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numbers import MONEY
from ledgerline.operators.lookup import resolve_key, thin
from ledgerline.operators.windows import running_total
from ledgerline.session import cut_lineage

QUANTITY = "decimal(18,2)"
#: Rows of a key that one task folds in order; keys with more are cut first.
FOLD_ROWS = 2000


def price_facts(
    facts: DataFrame, prices: DataFrame, key: str, quantity: str = "quantity", price: str = "price", amount: str = "total_amount"
) -> DataFrame:
    """``amount = quantity * price`` for every row, whatever amount the row brought along.

    An unknown key leaves the amount NULL. A key with two prices is an error.
    """
    known = thin(
        prices.filter(F.col(key).isNotNull()), [key], F.max(price).alias(price), F.count(F.lit(1)).alias("__n")
    )
    twice = F.raise_error(F.lit(f"a {key} has two prices")).cast("boolean")
    single = known.filter(F.when(F.col("__n") > 1, twice).otherwise(F.lit(True))).drop("__n")
    looked_up = facts.drop(amount).join(single, key, "left")
    exact = F.col(quantity).cast(QUANTITY) * F.col(price).cast(MONEY)
    columns = facts.columns if amount in facts.columns else [*facts.columns, amount]
    return looked_up.withColumn(amount, F.round(exact, 2).cast(MONEY)).select(*columns)


def split_rejects(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with a ``reason`` column); ``reason`` is NULL for a good row."""
    marked = rows.withColumn("reason", reason)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


def sold_per_key(facts: DataFrame, key: Sequence[str], quantity: str = "quantity") -> DataFrame:
    """Quantity per key, combined on the map side."""
    return facts.groupBy(*key).agg(F.sum(F.col(quantity).cast(QUANTITY)).cast("decimal(28,2)").alias("sold"))


def fold_stock(
    stock: DataFrame, facts: DataFrame, key: Sequence[str], available: str = "quantity_available", quantity: str = "quantity"
) -> DataFrame:
    """Stock after the facts. Several stock rows of one key all go down; a fact without a stock row changes nothing."""
    sold = sold_per_key(facts, key, quantity)
    folded = stock.join(thin(sold, key, F.min("sold").alias("sold")), list(key), "left")
    left = F.col(available).cast("decimal(28,2)") - F.coalesce(F.col("sold"), F.lit(0))
    return folded.withColumn(available, left.cast("decimal(28,2)")).drop("sold").select(*stock.columns)


def overdrawn(folded: DataFrame, available: str = "quantity_available") -> DataFrame:
    """Stock rows below zero. Sold quantities are positive, so the end balance is the lowest."""
    return folded.filter(F.col(available) < 0)


def accept_batch(
    stock: DataFrame,
    facts: DataFrame,
    key: Sequence[str],
    available: str = "quantity_available",
    quantity: str = "quantity",
    reject: str = "batch",
) -> DataFrame:
    """Facts with an ``accepted`` flag after the balance rule.

    ``reject="batch"``: one overdrawn balance refuses everything, as a multi-row
    insert would. ``reject="key"``: only the facts of the overdrawn keys.
    """
    bad = thin(overdrawn(fold_stock(stock, facts, key, available, quantity), available).select(*key), key)
    if reject == "batch":
        n_bad = bad.agg(F.count(F.lit(1)).alias("n")).scalar()
        return facts.withColumn("accepted", n_bad == 0)
    if reject != "key":
        raise ValueError("reject must be 'batch' or 'key'")
    return (
        facts.join(bad.withColumn("__bad", F.lit(True)), list(key), "left")
        .select(*facts.columns, F.col("__bad").isNull().alias("accepted"))
    )


def accept_rows(
    stock: DataFrame,
    facts: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    available: str = "quantity_available",
    quantity: str = "quantity",
    fold_rows: int = FOLD_ROWS,
) -> DataFrame:
    """Facts with an ``accepted`` flag, judged one after another as single inserts would be.

    Along ``order`` a fact is refused just if the balance of its key, less what was accepted before, does not cover it; a
    refused fact takes nothing, so that a smaller one after it may still pass. ``order`` tells the facts of a key apart; of equal ones the
    smaller quantity is first. Several stock rows of a key all go down, so the least one decides; a key without
    stock (or a null in it) takes every fact. A null quantity takes nothing, one below zero is refused.

    Whether a fact passes depends on all before it, which no window sum can tell. Keys of up to ``fold_rows`` facts are folded in one
    task. For a key with more, running sums over ranges of any size accept all facts before the first that overdraws; every
    later fact above the balance then left is refused at once, since balances only fall; what remains starts anew with that
    balance. A round more than halves what can still be sold where quantities are spread, so few rounds follow; each writes its rows once to the
    checkpoint folder.
    """
    keys = [f"k{i}" for i in range(len(key))]
    cents = F.coalesce(F.col(quantity).cast(QUANTITY) * 100, F.lit(0)).cast("bigint")
    rows = facts.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(key, keys)],
        F.struct(*[F.col(f"`{c}`") for c in order], cents.alias("__cents")).alias("at"),
        cents.alias("cents"),
        F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(facts.columns)]).alias("row"),
    )
    least = stock.groupBy(*key).agg(F.min((F.col(available).cast("decimal(28,2)") * 100).cast("bigint")).alias("balance"))
    known = rows.join(least.toDF(*keys, "balance"), keys, "left")
    free = known.filter(F.col("balance").isNull() | (F.col("cents") < 0)).select("row", (F.col("cents") >= 0).alias("accepted"))
    waiting = known.filter(F.col("balance").isNotNull() & (F.col("cents") >= 0))
    judged = free
    while True:
        sizes = waiting.groupBy(*keys).count()
        hot = cut_lineage(sizes.filter(F.col("count") > fold_rows).select(*keys))
        if hot.isEmpty():
            judged = judged.unionByName(_folded(waiting, keys))
            break
        judged = judged.unionByName(_folded(waiting.join(hot, keys, "left_anti"), keys))
        crowded = waiting.join(hot, keys, "left_semi")
        summed = running_total(crowded, F.col("cents"), [F.col("at").asc()], name="so_far", partition_by=keys, value_type="decimal(38,0)")
        summed = cut_lineage(summed)
        covered = F.col("so_far") <= F.col("balance")
        taken = summed.filter(covered).groupBy(*keys).agg(F.max("so_far").cast("bigint").alias("taken"))
        judged = judged.unionByName(summed.filter(covered).select("row", F.lit(True).alias("accepted")))
        rest = summed.filter(~covered).join(taken, keys, "left")
        rest = rest.withColumn("balance", F.col("balance") - F.coalesce("taken", F.lit(0).cast("bigint"))).drop("taken", "so_far")
        judged = judged.unionByName(rest.filter(F.col("cents") > F.col("balance")).select("row", F.lit(False).alias("accepted")))
        waiting = cut_lineage(rest.filter(F.col("cents") <= F.col("balance")))
    return judged.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(facts.columns)], "accepted")


def _folded(waiting: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``row, accepted`` of keys with few rows, taken in order."""
    listed = waiting.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("at", "cents", "row"))).alias("rows"),
        F.min("balance").alias("balance"),
    )

    def step(state: Column, row: Column) -> Column:
        fits = row["cents"] <= state["balance"]
        left = F.when(fits, state["balance"] - row["cents"]).otherwise(state["balance"])
        return F.struct(left.alias("balance"), F.concat(state["flags"], F.array(fits)).alias("flags"))

    start = F.struct(F.col("balance"), F.array().cast("array<boolean>").alias("flags"))
    flags = F.aggregate("rows", start, step, lambda state: state["flags"])
    each = listed.select(F.explode(F.arrays_zip(F.col("rows").alias("r"), flags.alias("f"))).alias("x"))
    return each.select(F.col("x.r.row").alias("row"), F.col("x.f").alias("accepted"))


def first_failure(*steps: tuple[Column, str]) -> Column:
    """Text of the first condition that holds, NULL when none does."""
    result = F.lit(None).cast("string")
    for failed, text in reversed(steps):
        result = F.when(failed, F.lit(text)).otherwise(result)
    return result


def resolve_all(facts: DataFrame, lookups: Sequence[tuple[DataFrame, Mapping[str, str], str]]) -> DataFrame:
    """Resolve several natural keys, one left join each."""
    result = facts
    for dimension, on, key in lookups:
        result = resolve_key(result, dimension, on, key)
    return result
