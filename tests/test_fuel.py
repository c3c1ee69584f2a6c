"""Golden values of the fuel network: prices, stock and twelve sales."""

import datetime as dt
from decimal import Decimal as D

import pytest
from conftest import row_set, rows
from pyspark.sql import functions as F

from ledgerline.operators import ingest
from ledgerline.operators.quality import row_counts, violations
from ledgerline.plans import fuel

PRICES = {1: "6.50", 2: "6.20", 3: "7.00", 4: "5.80", 5: "6.80", 6: "4.50"}
STOCK = [(1, 1, 5000), (1, 2, 3000), (2, 3, 4000), (3, 4, 2000), (4, 5, 2500), (5, 6, 1500)]
SALES = [
    (1, 1, "2025-01-25", 50),
    (1, 2, "2025-01-30", 40),
    (2, 3, "2025-02-05", 30),
    (2, 3, "2025-02-15", 45),
    (3, 4, "2025-02-20", 20),
    (3, 4, "2025-03-01", 25),
    (4, 5, "2025-03-05", 35),
    (4, 5, "2025-03-15", 50),
    (5, 6, "2025-03-20", 60),
    (5, 6, "2025-04-01", 55),
    (1, 1, "2025-04-10", 70),
    (2, 3, "2025-04-20", 65),
]
AMOUNTS = "325.00 248.00 210.00 315.00 116.00 145.00 238.00 340.00 270.00 247.50 455.00 455.00".split()


@pytest.fixture
def network(frame):
    """Six stations, fuels and customers, the stock, and the sales with their amounts."""
    stations = frame("station_id int, name string, location string", *[(i, f"Station {i}", f"Road {i}") for i in range(1, 7)])
    fuels = frame(
        "fuel_type_id int, fuel_name string, price_per_liter decimal(10,2)",
        *[(i, f"Fuel {i}", D(p)) for i, p in PRICES.items()],
    )
    customers = fuel.with_full_name(
        frame(
            "customer_id int, first_name string, last_name string, contact_number string",
            *[(i, f"First{i}", f"Last{i}", f"07{i}") for i in range(1, 7)],
        )
    )
    inventory = frame(
        "inventory_id int, station_id int, fuel_type_id int, quantity_available decimal(10,2)",
        *[(i, s, f, D(q)) for i, (s, f, q) in enumerate(STOCK, 1)],
    )
    raw = frame(
        "transaction_id int, station_id int, fuel_type_id int, customer_id int, transaction_date date, "
        "quantity_sold decimal(10,2), payment_method string, total_amount decimal(10,2)",
        *[
            (i, s, f, (i - 1) % 6 + 1, dt.date.fromisoformat(d), D(q), ("card", "cash", "mobile")[i % 3], D("1.00"))
            for i, (s, f, d, q) in enumerate(SALES, 1)
        ],
    )
    prices = fuels.select("fuel_type_id", F.col("price_per_liter").alias("price"))
    sales = ingest.price_facts(raw, prices, "fuel_type_id", quantity="quantity_sold")
    return {"fuel_station": stations, "fuel_type": fuels, "customer": customers, "inventory": inventory, "transaction": sales}


def test_amounts_override_what_was_supplied(network):
    got = [str(r.total_amount) for r in network["transaction"].orderBy("transaction_id").collect()]
    assert got == AMOUNTS


def test_unknown_fuel_is_rejected(network, frame):
    facts = frame("fuel_type_id int, quantity decimal(10,2)", (1, D(2)), (99, D(3)))
    prices = network["fuel_type"].select("fuel_type_id", F.col("price_per_liter").alias("price"))
    priced = ingest.price_facts(facts, prices, "fuel_type_id")
    good, bad = ingest.split_rejects(
        priced, ingest.first_failure((F.col("total_amount").isNull(), "price not found"))
    )
    assert row_set(good, "fuel_type_id") == [(1,)]
    assert row_set(bad, "fuel_type_id", "reason") == [(99, "price not found")]


def test_previous_quarter(network):
    got = rows(
        fuel.previous_quarter(network["transaction"], network["fuel_station"], network["fuel_type"], dt.date(2025, 5, 1))
    )
    assert [(r[0], r[1], r[2], float(r[3]), float(r[4])) for r in got] == [
        ("Station 1", "Fuel 1", 1, 50.0, 325.0),
        ("Station 1", "Fuel 2", 1, 40.0, 248.0),
        ("Station 2", "Fuel 3", 2, 75.0, 525.0),
        ("Station 3", "Fuel 4", 2, 45.0, 261.0),
        ("Station 4", "Fuel 5", 2, 85.0, 578.0),
        ("Station 5", "Fuel 6", 1, 60.0, 270.0),
    ]


def test_row_counts(network):
    assert dict(rows(row_counts(network))) == {
        "fuel_station": 6,
        "fuel_type": 6,
        "customer": 6,
        "inventory": 6,
        "transaction": 12,
    }


def test_stock_after_all_sales(network):
    key = ["station_id", "fuel_type_id"]
    folded = ingest.fold_stock(network["inventory"], network["transaction"], key, quantity="quantity_sold")
    assert [(r[0], r[1], float(r[2])) for r in row_set(folded, *key, "quantity_available")] == [
        (1, 1, 4880.0),
        (1, 2, 2960.0),
        (2, 3, 3860.0),
        (3, 4, 1955.0),
        (4, 5, 2415.0),
        (5, 6, 1385.0),
    ]


def test_sale_without_stock_row_changes_nothing(frame):
    stock = frame("k int, quantity_available decimal(10,2)", (1, D(5)), (1, D(7)))
    facts = frame("k int, quantity decimal(10,2)", (1, D(2)), (2, D(9)))
    folded = ingest.fold_stock(stock, facts, ["k"])
    # Both rows of the key go down; the sale of key 2 finds none.
    assert [(r[0], float(r[1])) for r in row_set(folded)] == [(1, 3.0), (1, 5.0)]


def test_overselling_rejects_the_batch_or_the_key(frame):
    stock = frame("k int, quantity_available decimal(10,2)", (1, D(10)), (2, D(10)))
    facts = frame("n int, k int, quantity decimal(10,2)", (1, 1, D(6)), (2, 1, D(6)), (3, 2, D(6)))
    assert {r.accepted for r in ingest.accept_batch(stock, facts, ["k"]).collect()} == {False}
    by_key = ingest.accept_batch(stock, facts, ["k"], reject="key")
    assert row_set(by_key, "n", "accepted") == [(1, False), (2, False), (3, True)]
    fine = ingest.accept_batch(stock, facts.filter("n <> 2"), ["k"])
    assert {r.accepted for r in fine.collect()} == {True}
    with pytest.raises(ValueError):
        ingest.accept_batch(stock, facts, ["k"], reject="never")


def test_patch_statuses(network, frame):
    patches = frame(
        "seq int, station_id int, column_name string, new_value string",
        (1, 1, "name", "New name"),
        (2, 1, "location", "New road"),
        (3, 1, "invalid_column", "Some value"),
        (4, 999, "name", "Nobody"),
        (5, 1, "name", None),
        (6, 2, "name", "first"),
        (7, 2, "name", "second"),
    )
    table, status = fuel.patch_rows(network["fuel_station"], patches)
    assert [r.status for r in status.orderBy("seq").collect()] == [
        "Success: Updated name for station_id = 1 to New name",
        "Success: Updated location for station_id = 1 to New road",
        "Error: Invalid column name. Must be one of: name, location",
        "Error: No row found with station_id = 999",
        "Error: New value cannot be NULL for column name",
        "Success: Updated name for station_id = 2 to first",
        "Success: Updated name for station_id = 2 to second",
    ]
    assert row_set(table)[:3] == [(1, "New name", "New road"), (2, "second", "Road 2"), (3, "Station 3", "Road 3")]


def test_first_unknown_name_decides(network, frame):
    incoming = frame(
        "n int, station_name string, fuel_name string, customer_full_name string, transaction_date date, "
        "quantity_sold decimal(10,2), payment_method string",
        *[
            (n, s, f, c, dt.date(2025, 3, 28), D("30.00"), "card")
            for n, s, f, c in [
                (1, "Station 1", "Fuel 1", "First1 Last1"),
                (2, "nowhere", "nothing", "nobody"),
                (3, "Station 1", "nothing", "nobody"),
                (4, "Station 1", "Fuel 1", "nobody"),
                (5, "Station 1", "Fuel 1", None),
            ]
        ],
    )
    got = fuel.load_transactions(incoming, network["fuel_station"], network["fuel_type"], network["customer"])
    assert [(r.inserted, r.status) for r in got.orderBy("n").collect()] == [
        (True, "✅ Transaction inserted for First1 Last1 on 2025-03-28: 30.00 L of Fuel 1 paid by card"),
        (False, fuel.STATION_NOT_FOUND),
        (False, fuel.FUEL_NOT_FOUND),
        (False, fuel.CUSTOMER_NOT_FOUND),
        (False, fuel.CUSTOMER_NOT_FOUND),
    ]
    assert [str(r.total_amount) for r in got.filter("inserted").collect()] == ["195.00"]


def test_latest_transaction_and_stock_by_name(network):
    assert [r.transaction_id for r in fuel.latest_transaction(network["transaction"]).collect()] == [12]
    stock = fuel.stock_of(network["inventory"], network["fuel_station"], network["fuel_type"], "Station 2", "Fuel 3")
    assert [float(r[0]) for r in rows(stock)] == [4000.0]


def test_golden_data_breaks_no_rule(spark, network):
    assert violations(spark, network, fuel.rules()).count() == 0


def test_each_rule_of_transactions(spark, network, frame):
    bad = frame(
        "transaction_id int, station_id int, fuel_type_id int, customer_id int, transaction_date date, "
        "quantity_sold decimal(12,2), payment_method string, total_amount decimal(12,2)",
        (1, 1, 1, 1, dt.date(2023, 12, 31), D("5"), "card", D("1")),
        (2, 1, 1, 1, dt.date(2025, 1, 1), D("-5"), "card", D("1")),
        (3, 1, 1, 1, dt.date(2025, 1, 1), D("0"), "card", D("1")),
        (4, 1, 1, 1, dt.date(2025, 1, 1), D("5"), "cheque", D("1")),
        (5, 1, 1, None, dt.date(2025, 1, 1), D("5"), "cash", None),
        (6, 77, 1, 1, dt.date(2025, 1, 1), D("5"), "cash", D("1")),
        (6, 1, 1, 1, dt.date(2025, 1, 1), D("5"), "cash", D("123456789.00")),
    )
    found = violations(spark, {**network, "transaction": bad}, fuel.rules())
    assert row_set(found.filter("table_name = 'transaction'"), "rule", "key") == sorted(
        [
            ("check", "1"),
            ("check", "2"),
            ("check", "3"),
            ("domain", "4"),
            ("not_null", "5"),
            ("not_null", "5"),
            ("foreign_key", "77"),
            ("primary_key", "6"),
            ("precision", "6"),
        ]
    )


def test_duplicate_fuel_name_and_missing_first_name(spark, network, frame):
    fuels = frame("fuel_type_id int, fuel_name string, price_per_liter decimal(10,2)", (1, "A", D(1)), (2, "A", D(2)))
    people = fuel.with_full_name(
        frame("customer_id int, first_name string, last_name string, contact_number string", (1, None, "L", "0" * 21))
    )
    found = violations(spark, {"fuel_type": fuels, "customer": people}, fuel.rules())
    assert row_set(found, "table_name", "rule", "key") == [
        ("customer", "length", "1"),
        ("customer", "not_null", "1"),
        ("fuel_type", "unique", "A"),
    ]
    assert rows(people, "full_name") == [(None,)]


@pytest.fixture
def incoming(frame):
    def make(*sales):
        return frame(
            "seq int, station_name string, fuel_name string, customer_full_name string, transaction_date date, "
            "quantity_sold decimal(10,2), payment_method string",
            *[(i, *s) for i, s in enumerate(sales, 1)],
        )

    return make


def test_record_sales(network, incoming):
    day = dt.date(2025, 5, 1)
    batch = incoming(
        ("Station 1", "Fuel 1", "First1 Last1", day, D("30"), "card"),
        ("nowhere", "Fuel 1", "First1 Last1", day, D("30"), "card"),
        ("Station 1", "Fuel 1", "First1 Last1", dt.date(2023, 1, 1), D("30"), "card"),
        ("Station 1", "Fuel 1", "First1 Last1", day, D("-1"), "card"),
        ("Station 1", "Fuel 1", "First1 Last1", day, D("1"), "cheque"),
        ("Station 6", "Fuel 6", "First2 Last2", day, D("4"), "cash"),
    )
    args = [network[n] for n in ("fuel_station", "fuel_type", "customer", "transaction", "inventory")]
    new, refused, stock = fuel.record_sales(batch, *args)
    assert [(r[0], r[1], str(r[2])) for r in row_set(new, "transaction_id", "station_id", "total_amount")] == [
        (13, 1, "195.00"),
        (14, 6, "18.00"),
    ]
    assert row_set(refused) == [
        (2, fuel.STATION_NOT_FOUND),
        (3, "transaction_date > 2024-01-01"),
        (4, "quantity_sold > 0"),
        (5, "payment_method not in list"),
    ]
    assert float(stock.filter("station_id = 1 and fuel_type_id = 1").first().quantity_available) == 4970.0
    assert new.columns == network["transaction"].columns


def test_record_sales_that_oversell(network, incoming):
    day = dt.date(2025, 5, 1)
    batch = incoming(
        ("Station 5", "Fuel 6", "First1 Last1", day, D("1000"), "card"),
        ("Station 5", "Fuel 6", "First2 Last2", day, D("501"), "card"),
        ("Station 1", "Fuel 1", "First1 Last1", day, D("1"), "card"),
    )
    args = [network[n] for n in ("fuel_station", "fuel_type", "customer", "transaction", "inventory")]
    new, refused, stock = fuel.record_sales(batch, *args)
    assert new.count() == 0 and refused.count() == 3
    assert row_set(stock, "inventory_id", "quantity_available") == row_set(
        network["inventory"], "inventory_id", "quantity_available"
    )
    new, refused, stock = fuel.record_sales(batch, *args, reject="key")
    assert row_set(new, "transaction_id", "station_id") == [(13, 1)]
    assert row_set(refused, "seq") == [(1,), (2,)]


def test_record_sales_one_by_one(network, incoming):
    """Only the sale that overdraws is refused; a smaller one after it passes."""
    day = dt.date(2025, 5, 1)
    left = float(network["inventory"].filter("station_id = 1 and fuel_type_id = 1").first().quantity_available)
    sales = [("Station 1", "Fuel 1", "First1 Last1", day, D(str(q)), "card") for q in (left - 10, 11, 9, 2, 1)]
    args = [network[n] for n in ("fuel_station", "fuel_type", "customer", "transaction", "inventory")]
    new, refused, stock = fuel.record_sales(incoming(*sales), *args, reject="row")
    assert [float(r[0]) for r in rows(new.orderBy("transaction_id"), "quantity_sold")] == [left - 10, 9.0, 1.0]
    assert row_set(refused) == [(2, "stock would fall below zero"), (4, "stock would fall below zero")]
    assert float(stock.filter("station_id = 1 and fuel_type_id = 1").first().quantity_available) == 0.0
