import datetime as dt
from decimal import Decimal as D

import pytest
from conftest import row_set, rows
from test_fuel import network  # noqa: F401
from test_rental import tables  # noqa: F401

from ledgerline.plans import rental, sql_surface


def test_rental_functions_equal_the_plans(spark, tables):  # noqa: F811
    day = dt.date(2017, 6, 1)
    sql_surface.publish_rental(spark, tables, day)
    want = row_set(rental.get_quarter_revenue(tables.payments_by_category(), day))
    assert row_set(spark.sql("SELECT * FROM get_sales_revenue_by_category_qtr(DATE '2017-06-01')")) == want
    assert [(n, float(v)) for n, v in row_set(spark.table("sales_revenue_by_category_qtr"))] == [
        (n, float(v)) for n, v in want
    ]
    films = rental.popular_by_country(
        tables.rentals_by_country(), tables.films_with_language(), ["peru", "Chad"]
    ).drop("rental_count")
    got = spark.sql("SELECT * FROM most_popular_films_by_countries(array('peru', 'Chad'))")
    assert row_set(got) == row_set(films)
    stock = spark.sql("SELECT * FROM films_in_stock_by_title(' %love% ')")
    listed = rental.films_in_stock(
        tables.inventory, tables.films_with_language(), tables.rental, tables.customer, "%love%"
    )
    assert row_set(stock) == row_set(listed)
    with pytest.raises(Exception, match="currently available"):
        spark.sql("SELECT * FROM films_in_stock_by_title('no such title')").collect()


@pytest.mark.parametrize(
    "call, text",
    [
        ("get_sales_revenue_by_category_qtr(CAST(NULL AS DATE))", "Input date cannot be NULL"),
        ("most_popular_films_by_countries(CAST(array() AS ARRAY<STRING>))", "cannot be NULL or empty"),
        ("most_popular_films_by_countries(CAST(NULL AS ARRAY<STRING>))", "cannot be NULL or empty"),
        ("films_in_stock_by_title('  ')", "cannot be NULL or empty"),
        ("films_in_stock_by_title(CAST(NULL AS STRING))", "cannot be NULL or empty"),
    ],
)
def test_bad_parameters_raise(spark, tables, call, text):  # noqa: F811
    sql_surface.publish_rental(spark, tables)
    with pytest.raises(Exception, match=text):
        spark.sql(f"SELECT * FROM {call}").collect()


def test_fuel_view(spark, network):  # noqa: F811
    sql_surface.publish_fuel(
        network["transaction"], network["fuel_station"], network["fuel_type"], dt.date(2025, 5, 1)
    )
    got = rows(spark.sql("SELECT sum(total_revenue) FROM vw_quarterly_analytics"))
    assert got == [(D("2207.00"),)]


def test_calendar_view(spark):
    sql_surface.calendar_view(spark, dt.date(1999, 1, 1), dt.date(1999, 12, 31))
    got = spark.sql("SELECT count(*), max(calendar_week_number) FROM times WHERE day_name = 'Monday'")
    assert rows(got) == [(52, 52)]
