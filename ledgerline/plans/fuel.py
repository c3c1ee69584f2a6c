"""A fuel station network: reports, table jobs and integrity rules."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions.numbers import total
from ledgerline.functions.text import list_text, message
from ledgerline.operators import quality as q
from ledgerline.operators.ingest import (
    accept_batch,
    accept_rows,
    first_failure,
    fold_stock,
    price_facts,
    resolve_all,
    split_rejects,
)
from ledgerline.operators.lookup import thin
from ledgerline.operators.mutate import assign_keys, id_buckets
from ledgerline.operators.ordering import ascending, top_k
from ledgerline.session import cut_lineage

# The texts the patch and load jobs answer with.
PATCHABLE = ("name", "location")
STATION_NOT_FOUND = "❌ Station not found"
FUEL_NOT_FOUND = "❌ Fuel type not found"
CUSTOMER_NOT_FOUND = "❌ Customer not found"
INSERTED = "✅ Transaction inserted for %s on %s: %s L of %s paid by %s"

PAYMENT_METHODS = ("cash", "card", "mobile")
FIRST_DAY = dt.date(2024, 1, 1)


def previous_quarter(
    transactions: DataFrame, stations: DataFrame, fuels: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Sales, quantity and revenue per station and fuel in the last complete quarter before ``as_of``."""
    start, end = cal.previous_quarter_bounds(cal.as_of_or_today(as_of))
    keys = ["station_name", "fuel_name"]
    named = (
        transactions.filter(cal.in_range(F.col("transaction_date"), start, end))
        .join(stations.select("station_id", F.col("name").alias("station_name")), "station_id", "inner")
        .join(fuels.select("fuel_type_id", "fuel_name"), "fuel_type_id", "inner")
    )
    return (
        named.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            total(F.col("quantity_sold")).alias("total_quantity_sold"),
            total(F.col("total_amount")).alias("total_revenue"),
        )
        .orderBy(*ascending(*keys))
    )


def latest_transaction(transactions: DataFrame, key: str = "transaction_id") -> DataFrame:
    return top_k(transactions, 1, F.col(key).desc_nulls_first())


def stock_of(inventory: DataFrame, stations: DataFrame, fuels: DataFrame, station: str, fuel: str) -> DataFrame:
    """Stock rows of one station and fuel, found by name."""
    here = stations.filter(F.col("name") == station).select("station_id")
    kind = fuels.filter(F.col("fuel_name") == fuel).select("fuel_type_id")
    return (
        inventory.join(here, "station_id", "inner").join(kind, "fuel_type_id", "inner").select("quantity_available")
    )


def patch_rows(
    table: DataFrame, patches: DataFrame, key: str = "station_id", columns: Sequence[str] = PATCHABLE
) -> tuple[DataFrame, DataFrame]:
    """Apply single-column patches ``(seq, key, column_name, new_value)``.

    Returns the new snapshot and one status text per patch. A patch fails on a
    column outside the list, on a NULL value, and on a key the table does not have,
    in this order. Of several good patches to one cell the last counts.
    """
    known = thin(table.select(key), [key]).withColumn("__known", F.lit(True))
    allowed = F.array(*[F.lit(c) for c in columns])
    judged = patches.join(known, key, "left").withColumn(
        "status",
        F.when(
            ~F.col("column_name").isin(list(columns)),
            F.concat(F.lit("Error: Invalid column name. Must be one of: "), list_text(allowed)),
        )
        .when(
            F.col("new_value").isNull(),
            F.concat(F.lit("Error: New value cannot be NULL for column "), F.col("column_name")),
        )
        .when(
            F.col("__known").isNull(),
            F.concat(F.lit(f"Error: No row found with {key} = "), F.col(key).cast("string")),
        )
        .otherwise(
            F.concat(
                F.lit("Success: Updated "),
                F.col("column_name"),
                F.lit(f" for {key} = "),
                F.col(key).cast("string"),
                F.lit(" to "),
                F.col("new_value"),
            )
        ),
    )
    good = judged.filter(F.col("status").startswith("Success"))
    newest = good.groupBy(key).agg(
        *[
            F.max_by(
                F.when(F.col("column_name") == c, F.col("new_value")),
                F.when(F.col("column_name") == c, F.col("seq")),
            ).alias(f"__{c}")
            for c in columns
        ]
    )
    patched = table.join(newest, key, "left")
    changed = patched.withColumns({c: F.coalesce(F.col(f"__{c}"), F.col(c)) for c in columns})
    return changed.select(*table.columns), judged.select("seq", key, "column_name", "new_value", "status")


def load_transactions(
    incoming: DataFrame, stations: DataFrame, fuels: DataFrame, customers: DataFrame
) -> DataFrame:
    """Resolve station, fuel and customer names of incoming sales and answer each row.

    Adds ``station_id``, ``fuel_type_id``, ``customer_id``, ``total_amount`` and
    ``status``. The first unknown name decides the status; such a row is not to be
    inserted (``inserted`` is false).
    """
    resolved = resolve_all(
        incoming,
        [
            (stations, {"station_name": "name"}, "station_id"),
            (fuels, {"fuel_name": "fuel_name"}, "fuel_type_id"),
            (customers, {"customer_full_name": "full_name"}, "customer_id"),
        ],
    )
    prices = fuels.select("fuel_type_id", F.col("price_per_liter").alias("price"))
    priced = price_facts(resolved, prices, "fuel_type_id", quantity="quantity_sold")
    failure = first_failure(
        (F.col("station_id").isNull(), STATION_NOT_FOUND),
        (F.col("fuel_type_id").isNull(), FUEL_NOT_FOUND),
        (F.col("customer_id").isNull(), CUSTOMER_NOT_FOUND),
    )
    success = message(
        INSERTED,
        F.col("customer_full_name"),
        F.date_format("transaction_date", "yyyy-MM-dd"),
        F.col("quantity_sold").cast("decimal(10,2)").cast("string"),
        F.col("fuel_name"),
        F.col("payment_method"),
    )
    return priced.withColumn("inserted", failure.isNull()).withColumn("status", F.coalesce(failure, success))


def record_sales(
    incoming: DataFrame,
    stations: DataFrame,
    fuels: DataFrame,
    customers: DataFrame,
    transactions: DataFrame,
    inventory: DataFrame,
    reject: str = "batch",
    chunk: int = 100_000,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The whole write path of a batch of sales (``seq`` and the columns of ``load_transactions``).

    Names are resolved and amounts computed; a row with an unknown name or one that
    breaks a rule of the transaction table is refused; then the balance rule is applied,
    with ``reject="row"`` to one sale after another by ``seq`` (``accept_rows``), else to
    whole keys or the batch (``accept_batch``). Returns the transactions to append with new
    keys, the refused rows with a reason, and the new stock.

    The names are looked up once: the rows with their verdicts are written to the checkpoint folder, and all three results read these.
    """
    broken = first_failure(*[(r.broken, r.reason) for r in rules()["transaction"].rows])
    verdict = F.when(~F.col("inserted"), F.col("status")).otherwise(broken)
    loaded = cut_lineage(load_transactions(incoming, stations, fuels, customers).withColumn("__verdict", verdict))
    good, bad = split_rejects(loaded, F.col("__verdict"))
    good = good.drop("__verdict")
    pair = ["station_id", "fuel_type_id"]
    if reject == "row":
        judged = accept_rows(inventory, good, pair, ["seq"], quantity="quantity_sold")
    else:
        judged = accept_batch(inventory, good, pair, quantity="quantity_sold", reject=reject)
    judged = cut_lineage(judged)
    accepted = judged.filter(F.col("accepted"))
    overdrawn = judged.filter(~F.col("accepted")).select("seq", F.lit("stock would fall below zero").alias("reason"))

    columns = [c for c in transactions.columns if c != "transaction_id"]
    keyed = assign_keys(
        accepted.select("seq", *columns),
        transactions,
        "transaction_id",
        ascending("seq"),
        id_buckets("seq", chunk),
    )
    stock = fold_stock(inventory, accepted, pair, quantity="quantity_sold")
    return keyed.select(*transactions.columns), bad.select("seq", "reason").unionByName(overdrawn), stock


def with_full_name(customers: DataFrame) -> DataFrame:
    """The stored generated column: first and last name, NULL if either is."""
    return customers.withColumn("full_name", F.concat("first_name", F.lit(" "), "last_name"))


def _positive(column: str) -> q.RowRule:
    return q.check(f"{column} > 0", F.col(column) > 0)


def _after_first_day(column: str) -> q.RowRule:
    return q.check(f"{column} > {FIRST_DAY}", F.col(column) > F.lit(FIRST_DAY))


def _text(column: str, length: int) -> list[q.RowRule]:
    return [q.not_null(column), q.max_length(column, length)]


def rules() -> dict[str, q.TableRules]:
    """Every declared rule of the seven tables. Built on call: column expressions need a session."""
    station = q.ForeignKey(("station_id",), "fuel_station", ("station_id",))
    fuel = q.ForeignKey(("fuel_type_id",), "fuel_type", ("fuel_type_id",))
    customer = q.ForeignKey(("customer_id",), "customer", ("customer_id",))
    links = [q.not_null("station_id"), q.not_null("fuel_type_id")]
    return {
        "fuel_station": q.TableRules(("station_id",), tuple(_text("name", 100) + _text("location", 150))),
        "fuel_type": q.TableRules(
            ("fuel_type_id",),
            (
                *_text("fuel_name", 50),
                q.not_null("price_per_liter"),
                q.fits_decimal("price_per_liter", 10, 2),
                _positive("price_per_liter"),
            ),
            unique=(q.Unique(("fuel_name",)),),
        ),
        "customer": q.TableRules(
            ("customer_id",),
            (
                *_text("first_name", 50),
                *_text("last_name", 50),
                q.max_length("full_name", 100),
                q.max_length("contact_number", 20),
            ),
        ),
        "employee": q.TableRules(
            ("employee_id",),
            (*_text("full_name", 100), *_text("position", 50), q.not_null("station_id")),
            foreign=(station,),
        ),
        "inventory": q.TableRules(
            ("inventory_id",),
            (
                *links,
                q.not_null("quantity_available"),
                q.fits_decimal("quantity_available", 10, 2),
                q.check("quantity_available >= 0", F.col("quantity_available") >= 0),
            ),
            foreign=(station, fuel),
        ),
        "transaction": q.TableRules(
            ("transaction_id",),
            (
                *links,
                q.not_null("customer_id"),
                q.not_null("transaction_date"),
                _after_first_day("transaction_date"),
                q.not_null("quantity_sold"),
                q.fits_decimal("quantity_sold", 10, 2),
                _positive("quantity_sold"),
                *_text("payment_method", 20),
                q.one_of("payment_method", PAYMENT_METHODS),
                q.not_null("total_amount"),
                q.fits_decimal("total_amount", 10, 2),
            ),
            foreign=(station, fuel, customer),
        ),
        "replenishment": q.TableRules(
            ("replenishment_id",),
            (
                *links,
                q.not_null("delivery_date"),
                _after_first_day("delivery_date"),
                q.not_null("quantity_received"),
                q.fits_decimal("quantity_received", 10, 2),
                _positive("quantity_received"),
                *_text("supplier_name", 100),
            ),
            foreign=(station, fuel),
        ),
    }

