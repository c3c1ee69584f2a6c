"""Rental and fuel reports on the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numbers import money
from ledgerline.operators.quality import row_counts
from ledgerline.plans import fuel, rental
from ledgerline.sources.tables import ParquetTables
from ledgerline.testbed.registry import case, shown

ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def actors(t: ParquetTables) -> DataFrame:
    """Suppliers as people: nation and name, and the nation as their store."""
    nations = t["nation"].select("n_nationkey", F.col("n_name").alias("first_name"))
    return t["supplier"].join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "inner").select(
        F.col("s_suppkey").alias("actor_id"), "first_name", F.col("s_name").alias("last_name"),
        F.col("s_nationkey").alias("store_id"),
    )


def rated_films(t: ParquetTables) -> DataFrame:
    size = F.col("p_size")
    rating = (
        F.when(size <= 10, "G").when(size <= 20, "PG").when(size <= 30, "pg-13").when(size <= 40, "R")
        .when(size <= 45, "NC-17").otherwise("X")
    )
    return t["part"].select(
        F.col("p_partkey").alias("film_id"),
        F.col("p_name").alias("title"),
        rating.alias("rating"),
        F.col("p_type").alias("language"),
        size.alias("length"),
        size.alias("release_year"),
        F.col("p_type").alias("category"),
        money(F.col("p_retailprice")).alias("rental_rate"),
    )


def payments(t: ParquetTables) -> DataFrame:
    """A line item as payment to a supplier; its order is the payment id."""
    return t["lineitem"].select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_suppkey").alias("staff_id"),
        F.col("l_orderkey").alias("payment_id"),
        money(F.col("l_extendedprice")).alias("amount"),
        F.col("l_shipdate").alias("payment_date"),
    )


def payments_by_type(t: ParquetTables) -> DataFrame:
    kinds = t["part"].select("p_partkey", F.col("p_type").alias("category_name"))
    return t["lineitem"].join(kinds, F.col("l_partkey") == F.col("p_partkey"), "inner").select(
        "category_name", money(F.col("l_extendedprice")).alias("amount"), F.col("l_shipdate").alias("payment_date")
    )


_RATING = """CASE WHEN p_size <= 10 THEN 'G' WHEN p_size <= 20 THEN 'PG' WHEN p_size <= 30 THEN 'pg-13'
                  WHEN p_size <= 40 THEN 'R' WHEN p_size <= 45 THEN 'NC-17' ELSE 'X' END"""


@case(
    "r10_catalogue",
    """
    SELECT p_name AS movie_name FROM part
    WHERE upper(p_type) = upper('promo') AND p_size BETWEEN 17 AND 19 AND p_retailprice > 905 ORDER BY 1
    """,
)
def r10(t: ParquetTables) -> DataFrame:
    return rental.catalogue(rated_films(t), "promo", 17, 19, 905)


@case(
    "r11_address_revenue",
    """
    SELECT trim(n_name || ' ' || coalesce(nullif(r_name, 'ASIA'), '')) AS entire_address,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey
    WHERE l_shipdate >= DATE '1997-04-01' GROUP BY 1 ORDER BY 2 DESC
    """,
)
def r11(t: ParquetTables) -> DataFrame:
    stores = (
        t["supplier"]
        .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"), "inner")
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"), "inner")
        .select(
            F.col("s_suppkey").alias("store_id"),
            F.col("n_name").alias("address"),
            F.nullif(F.col("r_name"), F.lit("ASIA")).alias("address2"),
        )
    )
    return shown(rental.revenue_by_address(payments(t), stores, dt.date(1997, 4, 1)))


@case(
    "r12_top5_suppliers",
    """
    SELECT s_suppkey AS actor_id, n_name AS first_name, s_name AS last_name, count(p_partkey) AS number_movies
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
                  JOIN nation ON s_nationkey = n_nationkey
    WHERE p_size > 15 GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1 LIMIT 5
    """,
)
def r12(t: ParquetTables) -> DataFrame:
    credits = t["lineitem"].select(F.col("l_suppkey").alias("actor_id"), F.col("l_partkey").alias("film_id"))
    return rental.busiest_actors(credits, rated_films(t), actors(t), after_year=15)


@case(
    "r13_segment_counts",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS release_year,
           CAST(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) AS BIGINT) AS n_building,
           CAST(sum(CASE WHEN c_mktsegment = 'Machinery' THEN 1 ELSE 0 END) AS BIGINT) AS n_machinery,
           CAST(sum(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END) AS BIGINT) AS n_household
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE upper(c_mktsegment) IN (upper('BUILDING'), upper('Machinery'), upper('HOUSEHOLD'))
    GROUP BY 1 ORDER BY 1 DESC
    """,
)
def r13(t: ParquetTables) -> DataFrame:
    """One name is spelled in mixed case: its rows pass the filter and its column stays 0."""
    films = (
        t["orders"]
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "inner")
        .select(F.year("o_orderdate").alias("release_year"), F.col("c_mktsegment").alias("category"))
    )
    names = {"BUILDING": "n_building", "Machinery": "n_machinery", "HOUSEHOLD": "n_household"}
    return rental.category_counts_per_year(films, names)


def _top_staff_sql(store: str) -> str:
    return f"""
    WITH revenue AS (
      SELECT l_suppkey AS staff_id, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s
      FROM lineitem WHERE year(l_shipdate) = 1997 GROUP BY 1)
    SELECT staff_id, n_name AS first_name, s_name AS last_name, {store} AS store_id, CAST(s AS DOUBLE) AS total_revenue
    FROM revenue JOIN supplier ON staff_id = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    ORDER BY s DESC, staff_id LIMIT 3
    """


@case(
    "r14_top3_last",
    _top_staff_sql(
        "(SELECT arg_max(l_orderkey, (l_shipdate, l_orderkey)) FROM lineitem WHERE l_suppkey = staff_id)"
    ),
)
def r14(t: ParquetTables) -> DataFrame:
    """Last store = where the latest payment went (here: its order)."""
    latest = payments(t).withColumn("store_id", F.col("payment_id"))
    staff = actors(t).withColumnRenamed("actor_id", "staff_id")
    return shown(rental.top_staff(latest, staff, 1997, last_store="payment"))


@case("r14_top3_staff_store", _top_staff_sql("s_nationkey"))
def r14_staff(t: ParquetTables) -> DataFrame:
    """Last store read from the staff row."""
    staff = actors(t).withColumnRenamed("actor_id", "staff_id")
    return shown(rental.top_staff(payments(t), staff, 1997))


@case(
    "r15_top5_label",
    f"""
    WITH f AS (SELECT p_partkey AS film_id, p_name AS title, {_RATING} AS rating FROM part)
    SELECT film_id, title, count(*) AS rental_count, rating,
           CASE upper(rating) WHEN 'G' THEN 'All ages' WHEN 'PG-13' THEN 'Inappropriate for Children Under 13'
                WHEN 'R' THEN 'Children Under 17 Require Accompanying Adult'
                WHEN 'NC-17' THEN 'Inappropriate for Children Under 17'
                WHEN 'PG' THEN 'Parental Guidance Suggested' ELSE 'unknown' END AS expected_audience_age
    FROM lineitem JOIN f ON l_partkey = film_id GROUP BY 1, 2, 4 ORDER BY 3 DESC, 1 LIMIT 5
    """,
)
def r15(t: ParquetTables) -> DataFrame:
    rentals = t["lineitem"].select(F.col("l_partkey").alias("film_id"))
    return rental.most_rented(rentals, rated_films(t))


@case(
    "r16_inactivity",
    """
    SELECT s_suppkey AS actor_id, n_name AS first_name, s_name AS last_name,
           CAST(max(year(l_shipdate)) AS INTEGER) AS latest_movie_year,
           CAST(2003 - max(year(l_shipdate)) AS INTEGER) AS years_since_last_movie
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY 1, 2, 3 ORDER BY 5 DESC, 1
    """,
)
def r16(t: ParquetTables) -> DataFrame:
    credits = t["lineitem"].select(F.col("l_suppkey").alias("actor_id"), F.year("l_shipdate").alias("release_year"))
    return rental.inactivity(credits, actors(t), dt.date(2003, 6, 30))


_QUARTER_REVENUE = """
    SELECT p_type AS category_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales_revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE year(l_shipdate) = 2001 AND quarter(l_shipdate) = 2 GROUP BY 1 HAVING sum(l_extendedprice) > 0
    ORDER BY 2 DESC
    """


@case("r17_quarter_revenue", _QUARTER_REVENUE)
def r17(t: ParquetTables) -> DataFrame:
    return shown(rental.quarter_revenue(payments_by_type(t), dt.date(2001, 5, 20)))


@case("g01_quarter_revenue_function", _QUARTER_REVENUE)
def g01(t: ParquetTables) -> DataFrame:
    """The function form: a required date and a declared revenue type."""
    return shown(rental.get_quarter_revenue(payments_by_type(t), dt.date(2001, 4, 1), "decimal(22,2)"))


@case(
    "r17_quarter_coverage",
    """
    SELECT count(*) AS payments_this_quarter, strftime(min(l_shipdate), '%Y-%m-%d') AS earliest_payment,
           strftime(max(l_shipdate), '%Y-%m-%d') AS latest_payment
    FROM lineitem WHERE year(l_shipdate) = 2001 AND quarter(l_shipdate) = 4
    """,
)
def r17_coverage(t: ParquetTables) -> DataFrame:
    return shown(rental.quarter_coverage(payments(t), dt.date(2001, 12, 31)))


@case(
    "r18_popular_by_nation",
    f"""
    WITH c AS (
      SELECT upper(n_name) AS country_name, p_name AS film_title, {_RATING} AS rating, p_type AS language,
             p_size AS length, p_size AS release_year, count(*) AS rental_count
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
                    JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
      WHERE upper(n_name) IN (SELECT upper(x) FROM (VALUES ('nation_3'), ('Nation_7'), ('NATION_12')) v(x))
      GROUP BY 1, 2, 3, 4, 5, 6)
    SELECT country_name, film_title, rating, language, length, release_year, rental_count
    FROM (SELECT *, rank() OVER (PARTITION BY country_name ORDER BY rental_count DESC) AS rk FROM c) WHERE rk = 1
    """,
)
def r18(t: ParquetTables) -> DataFrame:
    home = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    rentals = (
        t["lineitem"]
        .join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"), "inner")
        .join(home, F.col("o_custkey") == F.col("c_custkey"), "inner")
        .select(F.col("n_name").alias("country"), F.col("l_partkey").alias("film_id"))
    )
    return rental.popular_by_country(rentals, rated_films(t), ["nation_3", "Nation_7", "NATION_12"])


@case(
    "r19_in_stock",
    """
    WITH r AS (
      SELECT l_partkey AS inventory_id, o_custkey AS customer_id, l_shipdate AS rental_date,
             CASE WHEN l_linestatus = 'O' AND l_quantity >= 49 THEN NULL ELSE l_shipdate END AS return_date
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'N'),
    listed AS (
      SELECT p_name AS film_title, p_type AS language, p_partkey AS inventory_id, rental_date, customer_id,
             concat(c_name, ' ', nullif(c_mktsegment, 'BUILDING')) AS customer_name
      FROM part LEFT JOIN r ON p_partkey = inventory_id LEFT JOIN customer ON customer_id = c_custkey
      WHERE p_name ILIKE '%RING%'
        AND p_partkey NOT IN (SELECT inventory_id FROM r WHERE return_date IS NULL))
    SELECT row_number() OVER (ORDER BY film_title, inventory_id, rental_date NULLS LAST, customer_id NULLS LAST)
             AS row_num,
           film_title, language, inventory_id, customer_name, strftime(rental_date, '%Y-%m-%d') AS rental_date
    FROM listed
    """,
)
def r19(t: ParquetTables) -> DataFrame:
    """A line not marked N is a rental; an open line of at least 49 is still out."""
    open_line = (F.col("l_linestatus") == "O") & (F.col("l_quantity") >= 49)
    rentals = (
        t["lineitem"]
        .filter(F.col("l_returnflag") != "N")
        .join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"), "inner")
        .select(
            F.col("l_partkey").alias("inventory_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_shipdate").alias("rental_date"),
            F.when(~open_line, F.col("l_shipdate")).alias("return_date"),
        )
    )
    copies = t["part"].select(F.col("p_partkey").alias("inventory_id"), F.col("p_partkey").alias("film_id"))
    customers = t["customer"].select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("last_name"),
    )
    return shown(rental.films_in_stock(copies, rated_films(t), rentals, customers, " %RING% "))


def stations(t: ParquetTables) -> DataFrame:
    return t["supplier"].select(F.col("s_suppkey").alias("station_id"), F.col("s_name").alias("name"))


def fuels(t: ParquetTables) -> DataFrame:
    return t["part"].select(F.col("p_partkey").alias("fuel_type_id"), F.col("p_type").alias("fuel_name"))


@case(
    "r20_prev_quarter",
    """
    SELECT s_name AS station_name, p_type AS fuel_name, count(*) AS total_transactions,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_quantity_sold,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
    WHERE l_shipdate >= date_trunc('quarter', DATE '2001-08-15' - INTERVAL 3 MONTH)
      AND l_shipdate < date_trunc('quarter', DATE '2001-08-15')
    GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def r20(t: ParquetTables) -> DataFrame:
    transactions = t["lineitem"].select(
        F.col("l_suppkey").alias("station_id"),
        F.col("l_partkey").alias("fuel_type_id"),
        F.col("l_shipdate").alias("transaction_date"),
        F.col("l_quantity").alias("quantity_sold"),
        F.col("l_extendedprice").alias("total_amount"),
    )
    return shown(fuel.previous_quarter(transactions, stations(t), fuels(t), dt.date(2001, 8, 15)))


_COUNTS = " UNION ".join(f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}" for name in ALL_TABLES)


@case("r21_row_counts", _COUNTS)
def r21(t: ParquetTables) -> DataFrame:
    return row_counts({name: t[name] for name in ALL_TABLES})


@case(
    "r22_late_fee",
    """
    WITH r AS (
      SELECT l_orderkey, l_linenumber, CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS days, p_size,
             CAST(4.99 AS DECIMAL(18,2)) AS rate, CAST(p_retailprice AS DECIMAL(18,2)) AS cost
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
    SELECT l_orderkey, l_linenumber, days,
           CAST(CASE WHEN days <= p_size THEN rate WHEN days > 3 * p_size THEN cost ELSE rate + (days - p_size) END
                AS DOUBLE) AS amount
    FROM r
    """,
)
def r22(t: ParquetTables) -> DataFrame:
    rentals = (
        t["lineitem"]
        .join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"), "inner")
        .select(
            "l_orderkey",
            "l_linenumber",
            F.col("l_partkey").alias("film_id"),
            F.col("o_orderdate").alias("rental_date"),
            F.col("l_shipdate").alias("return_date"),
        )
    )
    terms = t["part"].select(
        F.col("p_partkey").alias("film_id"),
        F.col("p_size").alias("rental_duration"),
        F.lit("4.99").cast("decimal(18,2)").alias("rental_rate"),
        F.col("p_retailprice").alias("replacement_cost"),
    )
    return shown(rental.rental_charges(rentals, terms).select("l_orderkey", "l_linenumber", "days", "amount"))


@case(
    "r23_heavy_customers",
    """
    WITH p AS (SELECT o_custkey, count(DISTINCT l_partkey) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
               GROUP BY 1),
    r AS (SELECT o_custkey, count(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1)
    SELECT r.o_custkey AS customer_id, r.n AS n_rentals, p.n AS n_payments
    FROM r JOIN p ON r.o_custkey = p.o_custkey WHERE r.n >= 12 AND p.n >= 43
    """,
)
def r23(t: ParquetTables) -> DataFrame:
    orders = t["orders"].select(F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("rental_id"))
    parts = t["lineitem"].join(orders, F.col("l_orderkey") == F.col("rental_id"), "inner").select(
        "customer_id", F.col("l_partkey").alias("payment_id")
    )
    return rental.heavy_customers(orders, parts, 12, 43)


@case(
    "r24_history",
    """
    SELECT c_mktsegment AS first_name, n_name AS last_name, min(c_custkey) AS customer_id
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
      AND c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey
                        WHERE o_orderstatus = 'P' AND l_returnflag = 'R')
    GROUP BY 1, 2
    """,
)
def r24(t: ParquetTables) -> DataFrame:
    """For every segment and nation, the first customer with finished orders and returned lines."""
    customers = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "inner").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("first_name"),
        F.col("n_name").alias("last_name"),
    )
    orders = t["orders"].withColumnRenamed("o_custkey", "customer_id")
    finished = orders.filter(F.col("o_orderstatus") == "F")
    returned = t["lineitem"].filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    partial = orders.filter(F.col("o_orderstatus") == "P").join(returned, "o_orderkey", "left_semi")
    return rental.customers_with_history(customers, finished, partial)


@case(
    "r27_latest",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
    FROM orders ORDER BY o_orderkey DESC LIMIT 1
    """,
)
def r27(t: ParquetTables) -> DataFrame:
    latest = fuel.latest_transaction(t["orders"], "o_orderkey")
    return shown(latest.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"))


@case(
    "r27_stock_of",
    """
    SELECT CAST(l_quantity AS DOUBLE) AS quantity_available
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
    WHERE s_name = 'Supplier#000000007' AND p_type = 'PROMO'
    """,
)
def r27_stock(t: ParquetTables) -> DataFrame:
    inventory = t["lineitem"].select(
        F.col("l_suppkey").alias("station_id"),
        F.col("l_partkey").alias("fuel_type_id"),
        F.col("l_quantity").alias("quantity_available"),
    )
    return fuel.stock_of(inventory, stations(t), fuels(t), "Supplier#000000007", "PROMO")
