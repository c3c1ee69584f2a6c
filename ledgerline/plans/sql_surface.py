"""The reports as SQL views and table functions.

``publish`` registers them for ``spark.sql``. The joined relations come from the
DataFrame plans as views; a function is a short query over one of them, so its
parameters reach the scan as literals.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions.text import join_skipping_nulls
from ledgerline.operators.lookup import left_join_many, not_in
from ledgerline.plans import fuel, rental


def publish_rental(spark: SparkSession, tables: rental.RentalTables, as_of: dt.date | None = None) -> None:
    """Views ``sales_revenue_by_category_qtr``, ``category_payments``, ``country_rentals``, ``stock_history``
    and functions ``get_sales_revenue_by_category_qtr(day)``, ``most_popular_films_by_countries(countries)``,
    ``films_in_stock_by_title(pattern)``."""
    payments = tables.payments_by_category()
    payments.createOrReplaceTempView("category_payments")
    rental.quarter_revenue(payments, as_of).createOrReplaceTempView("sales_revenue_by_category_qtr")
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION get_sales_revenue_by_category_qtr(day DATE)
        RETURNS TABLE (category_name STRING, total_sales_revenue DECIMAL(10,2))
        RETURN WITH asked AS (
                 SELECT category_name, amount, payment_date,
                        CASE WHEN get_sales_revenue_by_category_qtr.day IS NULL
                             THEN raise_error('Input date cannot be NULL.')
                             ELSE date_trunc('quarter', get_sales_revenue_by_category_qtr.day) END AS quarter_start
                 FROM category_payments)
               SELECT category_name, CAST(sum(amount) AS DECIMAL(10,2)) FROM asked
               WHERE payment_date >= quarter_start AND payment_date < add_months(quarter_start, 3)
               GROUP BY category_name HAVING sum(amount) > 0
        """
    )

    films = tables.films_with_language()
    counted = tables.rentals_by_country().groupBy(F.upper("country").alias("country_name"), "film_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    counted.join(films, "film_id", "inner").groupBy(
        "country_name", F.col("title").alias("film_title"), "rating", "language", "length", "release_year"
    ).agg(F.sum("n").alias("rental_count")).createOrReplaceTempView("country_rentals")
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION most_popular_films_by_countries(countries ARRAY<STRING>)
        RETURNS TABLE (country_name STRING, film_title STRING, rating STRING, language STRING, length INT,
                       release_year INT)
        RETURN WITH ranked AS (
                 SELECT *, rank() OVER (PARTITION BY country_name ORDER BY rental_count DESC) AS place
                 FROM country_rentals
                 WHERE array_contains(
                   CASE WHEN coalesce(size(most_popular_films_by_countries.countries), 0) < 1
                        THEN raise_error('Input country list cannot be NULL or empty.')
                        ELSE transform(most_popular_films_by_countries.countries, c -> upper(c)) END, country_name))
               SELECT country_name, film_title, rating, language, length, release_year FROM ranked WHERE place = 1
        """
    )

    copies = tables.inventory.select("inventory_id", "film_id").join(
        films.select("film_id", F.col("title").alias("film_title"), "language"), "film_id", "inner"
    )
    out = tables.rental.filter(F.col("return_date").isNull()).select("inventory_id")
    names = tables.customer.select(
        "customer_id", join_skipping_nulls(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("customer_name")
    )
    past = tables.rental.select("inventory_id", "customer_id", "rental_date")
    history = left_join_many(not_in(copies, "inventory_id", out, "inventory_id"), past, ["inventory_id"])
    history.join(names, "customer_id", "left").select(
        "film_title",
        "language",
        "inventory_id",
        F.coalesce("customer_name", F.lit(" ")).alias("customer_name"),
        "rental_date",
        "customer_id",
    ).createOrReplaceTempView("stock_history")
    # Numbers in two steps, titles and then copies, so no window holds more than the copies of one title.
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION films_in_stock_by_title(pattern STRING)
        RETURNS TABLE (row_num BIGINT, film_title STRING, language STRING, inventory_id BIGINT, customer_name STRING,
                       rental_date TIMESTAMP_NTZ)
        RETURN WITH listed AS (
                 SELECT * FROM stock_history
                 WHERE film_title ILIKE coalesce(nullif(trim(films_in_stock_by_title.pattern), ''),
                                                 raise_error('Input title cannot be NULL or empty.'))),
               per_copy AS (SELECT film_title, inventory_id, count(*) AS n FROM listed GROUP BY film_title, inventory_id),
               per_title AS (SELECT film_title, sum(n) AS n FROM per_copy GROUP BY film_title),
               titles AS (
                 SELECT film_title AS title, sum(n) OVER (ORDER BY film_title) - n AS earlier FROM per_title),
               copies AS (
                 SELECT film_title AS copy_title, inventory_id AS copy,
                        sum(n) OVER (PARTITION BY film_title ORDER BY inventory_id) - n AS earlier_copies
                 FROM per_copy)
               SELECT earlier + earlier_copies + row_number() OVER (
                        PARTITION BY film_title, inventory_id ORDER BY rental_date NULLS LAST, customer_id NULLS LAST),
                      film_title, language, inventory_id, customer_name, rental_date
               FROM listed JOIN titles ON film_title = title JOIN copies ON film_title = copy_title AND inventory_id = copy
               UNION ALL
               SELECT n, '', '', n, '', NULL FROM (SELECT count(*) AS n FROM listed)
               WHERE CASE WHEN n = 0 THEN raise_error('No films matching the title are currently available.')
                          ELSE false END
        """
    )


def publish_fuel(
    transactions: DataFrame, stations: DataFrame, fuels: DataFrame, as_of: dt.date | None = None
) -> None:
    """View ``vw_quarterly_analytics``."""
    fuel.previous_quarter(transactions, stations, fuels, as_of).createOrReplaceTempView("vw_quarterly_analytics")


def calendar_view(spark: SparkSession, first: dt.date, last: dt.date, name: str = "times") -> None:
    """A ``times`` dimension for SQL users: one row per day with the calendar attributes."""
    days = spark.sql(
        "SELECT explode(sequence(:first, :last, INTERVAL 1 DAY)) AS time_id", args={"first": first, "last": last}
    )
    cal.with_calendar(days).createOrReplaceTempView(name)
