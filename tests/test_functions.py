import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerline.functions import arguments, calendar, numbers, text


def test_concat_skips_or_keeps_null(frame):
    df = frame("a string, b string", ("A", None))
    got = rows(df.select(text.join_skipping_nulls(F.col("a"), F.lit(" "), F.col("b")), text.join_or_null("a", "b")))
    assert got == [("A ", None)]


@pytest.mark.parametrize(
    "amount, expected",
    [
        ("1234.50", "       1,234.50"),
        ("-1234.50", "      -1,234.50"),
        ("0", "           0.00"),
        ("-0.5", "          -0.50"),
        ("999999999.99", " 999,999,999.99"),
        ("1000000000", " ###,###,###.##"),
        ("-1000000000", "-###,###,###.##"),
        (None, None),
    ],
)
def test_amount_text(frame, amount, expected):
    df = frame("x string", (amount,)).select(text.amount_text(F.col("x").cast("decimal(18,2)")))
    assert rows(df) == [(expected,)]


@pytest.mark.parametrize(
    "size, expected",
    [
        (0, "0 bytes"),
        (10239, "10239 bytes"),
        (10240, "10 kB"),
        (10 * 1024 + 512, "11 kB"),
        (10 * 1024 + 511, "10 kB"),
        (10240 * 1024 - 513, "10239 kB"),
        (10240 * 1024 - 512, "10 MB"),
        (575 * 1024 * 1024, "575 MB"),
        (8192, "8192 bytes"),
        (10**13, "9313 GB"),
        (-10240, "-10 kB"),
        (None, None),
    ],
)
def test_size_text(frame, size, expected):
    assert rows(frame("x long", (size,)).select(text.size_text(F.col("x")))) == [(expected,)]


@pytest.mark.parametrize(
    "size,largest,expected",
    [
        (2**63, "PB", "8192 PB"),
        (2**63 - 1, "PB", "8192 PB"),
        (-(2**63), "PB", "-8192 PB"),
        (54_000_000**2 * 100_003, "TB", "265216611 TB"),
        (20000 * 2**50 + 2**49, "PB", "20001 PB"),
        (20000 * 2**50 + 2**49 - 1, "PB", "20000 PB"),
        (10**37, "PB", "8881784197001252323389 PB"),
        (10240 * 2**40, "TB", "10240 TB"),
        (None, "TB", None),
    ],
)
def test_size_text_beyond_bigint(frame, size, largest, expected):
    df = frame("x decimal(38,0)", (None if size is None else Decimal(size),))
    assert rows(df.select(text.size_text(F.col("x"), largest=largest))) == [(expected,)]


def test_size_query_over_large_keys(spark, tmp_path):
    """The query's own SQL ends at its product of ten million keys squared; to there the two agree."""
    from ledgerline.testbed import load_cases

    keys = [1, 7, 335_000, 336_000, 9_600_000, 54_000_000, 600_000_000]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey bigint").write.parquet(str(tmp_path / "orders.parquet"))
    got = dict(rows(load_cases()[0]["f_size_text"](spark, str(tmp_path))))
    exact = {k: k * k * 100_003 for k in keys}
    assert got[1] == "98 kB" and got[7] == "4785 kB"
    assert all(got[k] == f"{(exact[k] + 2**39) >> 40} TB" for k in keys[2:])


def test_percent_text_and_share(frame):
    df = frame("x string, y string", ("1", "3"), ("2", "3"))
    share = numbers.percent_of(F.col("x").cast("decimal(18,2)"), F.col("y").cast("decimal(18,2)"), 4)
    assert rows(df.select(text.percent_text(share))) == [("33.3333 %",), ("66.6667 %",)]


def test_label_without_case(frame):
    df = frame("r string", ("pg-13",), ("G",), ("X",), (None,))
    got = [r[0] for r in rows(df.select(text.label_for(F.col("r"), text.AUDIENCE_BY_RATING, "unknown")))]
    assert got == ["Inappropriate for Children Under 13", "All ages", "unknown", "unknown"]


def test_number_after_prefix_rejects_text(frame):
    df = frame("c string", ("p12",), ("px",), (None,))
    assert rows(df.select(text.number_after_prefix(F.col("c"), "p"))) == [(12,), (None,), (None,)]


def test_equality_keeps_accents(frame):
    df = frame("a string, b string", ("și", "si"), ("SI", "si"))
    assert [r[0] for r in rows(df.select(text.same_text(F.col("a"), F.col("b"))))] == [False, True]


def test_quarters():
    assert calendar.quarter_bounds(dt.date(2025, 5, 9)) == (dt.date(2025, 4, 1), dt.date(2025, 7, 1))
    assert calendar.quarter_bounds(dt.date(2025, 12, 31)) == (dt.date(2025, 10, 1), dt.date(2026, 1, 1))
    assert calendar.previous_quarter_bounds(dt.date(2025, 1, 1)) == (dt.date(2024, 10, 1), dt.date(2025, 1, 1))
    assert calendar.previous_quarter_bounds(dt.date(2025, 8, 15)) == (dt.date(2025, 4, 1), dt.date(2025, 7, 1))


def test_calendar_attributes(frame):
    df = calendar.with_calendar(frame("time_id date", (dt.date(1999, 12, 6),), (dt.date(2000, 1, 1),)))
    assert rows(df) == [
        (dt.date(1999, 12, 6), 1999, 4, "1999-12", 49, "Monday"),
        (dt.date(2000, 1, 1), 2000, 1, "2000-01", 52, "Saturday"),
    ]


def test_iso_weeks_at_the_turn_of_the_year(frame):
    """Equal to the plain predicate on calendar year and week, whatever the year."""
    days = [dt.date(1994, 12, 20) + dt.timedelta(days=i) for i in range(13_200)]
    df = frame("d date", *[(d,) for d in days])
    weeks = ((1, 1), (49, 52), (50, 53), (52, 52), (53, 53), (1, 53))
    differs = [
        calendar.in_iso_weeks(F.col("d"), year, a, b)
        != ((F.year("d") == year) & F.weekofyear("d").between(a, b))
        for year in range(1995, 2031)
        for a, b in weeks
    ]
    counts = [F.count_if(x).alias(f"c{i}") for i, x in enumerate(differs)]
    assert set(df.agg(*counts).first()) == {0}
    assert df.filter(calendar.in_iso_weeks(F.col("d"), 2001, 53, 53)).count() == 0
    assert df.filter(calendar.in_iso_weeks(F.col("d"), 2001, 1, 1)).count() == 8


def test_power_and_row_total(frame):
    df = frame("q1 int, q2 int", (3, None))
    got = rows(df.select(numbers.power(F.lit(10.0), F.lit(7)), numbers.add_cells(F.col("q1"), F.col("q2"))))
    assert got == [(1e7, 3)]


def test_arguments():
    for bad in (None, "", "  "):
        with pytest.raises(ValueError):
            arguments.required_text(bad, "Title")
    for bad in (None, []):
        with pytest.raises(ValueError):
            arguments.required_list(bad, "List")
    with pytest.raises(ValueError):
        arguments.required(None, "Date")
    assert arguments.required_text(" x ", "Title") == "x"


def test_money_is_exact(frame):
    df = frame("x double", *[(0.1,)] * 10).agg(numbers.total(F.col("x")).alias("s"))
    assert rows(df) == [(Decimal("1.00"),)]


def test_current_schema_and_database(spark):
    assert rows(spark.range(1).select(F.current_schema(), F.current_database())) == [("default", "default")]
