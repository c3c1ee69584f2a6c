"""Entries for what the other modules leave out: the turn of the year, gaps, truncation, generated rows, views, SQL functions."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.operators import mutate
from ledgerline.operators.ordering import random_pick
from ledgerline.operators.patterns import TrigramIndex
from ledgerline.plans import rental, sales, sql_surface
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources import sinks
from ledgerline.sources.footers import column_figures, footers
from ledgerline.sources.footprint import footprint
from ledgerline.sources.kept_view import KeptView, signed
from ledgerline.sources.tables import ParquetTables, sequence_rows
from ledgerline.testbed import mapping as m
from ledgerline.testbed.registry import ORACLE, case, shown
from ledgerline.testbed.rental_cases import ALL_TABLES, payments_by_type, rated_films
from ledgerline.testbed.sales_cases import _DAILY, _ROUNDED


def _weekly(year: int, first: int, last: int) -> str:
    return f"""
    WITH {_DAILY},
    weeks AS (SELECT * FROM daily WHERE year(d) = {year} AND w BETWEEN {first} AND {last})
    SELECT w AS calendar_week_number, strftime(d, '%Y-%m-%d') AS time_id, n AS day_name, CAST(s AS DOUBLE) AS sales,
           CAST(sum(s) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cum_sum,
           CAST({_ROUNDED} AS DOUBLE) AS centered_3_day_avg
    FROM weeks WINDOW o AS (ORDER BY d) ORDER BY d
    """


@case("r02_turn_of_year", _weekly(2000, 49, 52))
def r02_turn(t: ParquetTables) -> DataFrame:
    """1 and 2 January 2000 belong to week 52."""
    return shown(sales.weekly_sales_report(m.dated_orders(t), 2000, 49, 52))


@case("r02_turn_of_year_calendar", _weekly(2000, 49, 52))
def r02_turn_calendar(t: ParquetTables) -> DataFrame:
    """The same with the attributes of a calendar table."""
    return shown(sales.weekly_sales_report(cal.with_calendar(m.dated_orders(t)), 2000, 49, 52))


@case(
    "r03_week_one",
    f"""
    WITH {_DAILY},
    week AS (SELECT * FROM daily WHERE year(d) = 2001 AND w = 1)
    SELECT strftime(d, '%Y-%m-%d') AS time_id, n AS day_name, CAST(s AS DOUBLE) AS daily_sales,
           CAST(sum(s) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_total_rows
    FROM week ORDER BY d
    """,
)
def r03_week_one(t: ParquetTables) -> DataFrame:
    """31 December 2001 belongs to week 1."""
    return shown(sales.running_total_rows(m.dated_orders(t), 2001, 1))


@case(
    "r02_neighbours_beyond_gaps",
    f"""
    WITH {_DAILY.replace("FROM orders", "FROM (SELECT * FROM orders WHERE day(o_orderdate) IN (6, 13, 25))")},
    averaged AS (SELECT *, CAST({_ROUNDED} AS DOUBLE) AS avg3 FROM daily WINDOW o AS (ORDER BY d))
    SELECT w AS calendar_week_number, strftime(d, '%Y-%m-%d') AS time_id, n AS day_name, CAST(s AS DOUBLE) AS sales,
           CAST(sum(s) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cum_sum, avg3 AS centered_3_day_avg
    FROM averaged WHERE year(d) = 1999 AND w BETWEEN 45 AND 51 ORDER BY d
    """,
)
def r02_gaps(t: ParquetTables) -> DataFrame:
    """Sales on three days a month: the neighbours of a day are more than a week away."""
    few = m.dated_orders(t).filter(F.dayofmonth("time_id").isin(6, 13, 25))
    return shown(sales.weekly_sales_report(few, 1999, 45, 51, neighbours_outside=True))


REFERENCES = [
    mutate.Reference("nation", ("n_regionkey",), "region", ("r_regionkey",)),
    mutate.Reference("customer", ("c_nationkey",), "nation", ("n_nationkey",)),
    mutate.Reference("supplier", ("s_nationkey",), "nation", ("n_nationkey",)),
    mutate.Reference("orders", ("o_custkey",), "customer", ("c_custkey",)),
    mutate.Reference("lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
]


@case(
    "m18_truncate_cascade",
    """
    SELECT 'region' AS table_name, count(*) AS n_rows FROM region UNION ALL SELECT 'nation', count(*) FROM nation
    UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part
    UNION ALL SELECT 'customer', 0 UNION ALL SELECT 'orders', 0 UNION ALL SELECT 'lineitem', 0
    """,
)
def m18_cascade(t: ParquetTables) -> DataFrame:
    """Emptying customers empties orders and lines, and nothing else."""
    names = ("region", "nation", "supplier", "part", "customer", "orders", "lineitem")
    left = mutate.cascade_truncate({n: t[n] for n in names}, REFERENCES, ["customer"])
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in left.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


@case("k06_random_pick", "SELECT c_custkey, c_name FROM customer ORDER BY md5('11:' || c_custkey), c_custkey LIMIT 1")
def k06(t: ParquetTables) -> DataFrame:
    """One customer at random, by the least digest of seed and key."""
    return random_pick(t["customer"].select("c_custkey", "c_name"), 11, ["c_custkey"])


_LINE_KEPT = "l_linenumber <= 4 OR l_returnflag <> 'R'"


@case(
    "s08_kept_view",
    f"""
    SELECT (year(l_shipdate) * 4 + quarter(l_shipdate))::BIGINT AS part, l_suppkey, l_returnflag, count(*) AS n_rows,
      CAST(sum(CASE WHEN l_linenumber = 2 AND l_discount > 0.05 THEN 2 ELSE 1 END * CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM lineitem WHERE {_LINE_KEPT} GROUP BY 1, 2, 3
    """,
)
def s08_kept(t: ParquetTables) -> DataFrame:
    """Sales by quarter, supplier and flag, kept through a load, insertions, deletions and changed quantities."""
    lines = t["lineitem"].select("l_linenumber", "l_suppkey", "l_returnflag", "l_shipdate", "l_discount", F.col("l_quantity").cast("decimal(18,2)").alias("q"))
    quarter = F.year("l_shipdate") * 4 + F.quarter("l_shipdate")
    root = f"{ensure_checkpoint_dir(t.spark)}/kept-view-{uuid.uuid4().hex}"
    view = KeptView(t.spark, root, quarter, ["l_suppkey", "l_returnflag"], {"quantity": F.col("q")})
    view.apply(signed(lines.filter("l_linenumber <= 5")), 0)
    old = lines.filter("l_linenumber = 2 and l_discount > 0.05")
    view.apply(signed(lines.filter("l_linenumber > 5").unionByName(old.withColumn("q", (F.col("q") * 2).cast("decimal(18,2)"))), old), 1)
    view.apply(signed(deleted=lines.filter(f"not ({_LINE_KEPT})")), 2)
    return view.read().select("part", "l_suppkey", "l_returnflag", "n_rows", F.col("quantity").cast("double").alias("quantity"))


PATTERNS = ("%RED%", "small%r_ng", "b%t%", "%ot gea%", "%zzz%", "_e%")


@case(
    "p16_pattern_postings",
    " UNION ALL ".join(f"SELECT '{p}' AS pattern, p_partkey, p_name FROM part WHERE p_name ILIKE '{p}'" for p in PATTERNS),
)
def p16_postings(t: ParquetTables) -> DataFrame:
    """Parts by pattern through stored trigrams; patterns without three letters in a row scan."""
    index = TrigramIndex(t.spark, f"{ensure_checkpoint_dir(t.spark)}/trigrams-{uuid.uuid4().hex}")
    parts = t["part"].select("p_partkey", "p_name")
    index.extend(parts, "p_partkey", "p_name")
    out = None
    for pattern in PATTERNS:
        found = index.search(parts, "p_partkey", "p_name", pattern).select(F.lit(pattern).alias("pattern"), "p_partkey", "p_name")
        out = found if out is None else out.unionByName(found)
    return out


@case(
    "s14_footprint",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows, true AS has_bytes FROM {n}" for n in ALL_TABLES
    ),
)
def s14(t: ParquetTables) -> DataFrame:
    """Files and rows of every table; of the sizes, that there are any."""
    report = footprint({n: t[n] for n in ALL_TABLES})
    return report.select("table_name", "n_files", "n_rows", (F.col("total_bytes") > 0).alias("has_bytes"))


#: Whole-number columns, whose bounds every writer states.
NUMBERED = {
    "region": "r_regionkey", "nation": "n_nationkey n_regionkey", "supplier": "s_suppkey s_nationkey", "customer": "c_custkey c_nationkey",
    "part": "p_partkey p_size", "orders": "o_orderkey o_custkey", "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber", "documents": "doc_id n_chars",
}


@case(
    "s14_column_footers",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n_values, count(*) - count({c}) AS n_nulls, "
        f"min({c})::BIGINT AS least, max({c})::BIGINT AS greatest FROM {t}"
        for t, columns in NUMBERED.items()
        for c in columns.split()
    ),
)
def s14_columns(t: ParquetTables) -> DataFrame:
    """Counts and bounds of whole-number columns from footers alone; no row is read."""
    parts = [
        column_figures(footers(t.spark, t.path(name)).filter(F.col("column_name").isin(columns.split())), "bigint").withColumn("table_name", F.lit(name))
        for name, columns in NUMBERED.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("table_name", "column_name", "n_values", "n_nulls", "least", "greatest")


@case(
    "s03_missing_order_numbers",
    """
    SELECT x FROM (SELECT unnest(generate_series(CAST(0 AS BIGINT), (SELECT max(o_orderkey) + 10 FROM orders))) AS x)
    WHERE x NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey % 7 <> 0)
    """,
)
def s03(t: ParquetTables) -> DataFrame:
    """A generated sequence against the order keys: the numbers that orders of most customers leave free."""
    last = t["orders"].agg(F.max("o_orderkey")).first()[0] or 0
    used = t["orders"].filter(F.col("o_custkey") % 7 != 0).select(F.col("o_orderkey").alias("x"))
    return sequence_rows(t.spark, 0, last + 10).join(used, "x", "left_anti")


@case(
    "s08_view",
    "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 HAVING count(*) > 3",
)
def s08(t: ParquetTables) -> DataFrame:
    """A stored query over two tables, asked through SQL."""
    joined = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    sinks.publish_view(joined.select("n_name", "c_custkey"), "customers_of_nations")
    return t.spark.sql("SELECT n_name, count(*) AS customers FROM customers_of_nations GROUP BY n_name HAVING count(*) > 3")


@case(
    "f27_array_length",
    """
    SELECT c_custkey, CAST(len([x FOR x IN [c_mktsegment, c_name] IF x LIKE 'B%']) AS INTEGER) AS n FROM customer
    """,
)
def f27(t: ParquetTables) -> DataFrame:
    """Length of an array that is often empty, which counts 0."""
    kept = F.filter(F.array("c_mktsegment", "c_name"), lambda x: x.startswith("B"))
    return t["customer"].select("c_custkey", F.size(kept).alias("n"))


def _rental_tables(t: ParquetTables, all_lines: bool = False) -> rental.RentalTables:
    """The driver's tables in the base tables of the rental schema: a line (not marked N) is a rental, paid on shipping."""
    chosen = t["lineitem"] if all_lines else t["lineitem"].filter(F.col("l_returnflag") != "N")
    lines = chosen.join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    out = (F.col("l_linestatus") == "O") & (F.col("l_quantity") >= 49)
    number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    shipped = F.col("l_shipdate").cast("timestamp_ntz")
    rented = lines.select(
        number.alias("rental_id"), F.col("l_partkey").cast("bigint").alias("inventory_id"), F.col("o_custkey").alias("customer_id"),
        shipped.alias("rental_date"), F.when(~out, shipped).alias("return_date"), F.col("l_suppkey").alias("staff_id"),
    )
    films = rated_films(t)
    kinds = films.select("language").distinct()
    return rental.RentalTables(
        film=films.select(
            "film_id", "title", "rating", "length", "release_year", F.xxhash64("language").alias("language_id"), "rental_rate"
        ),
        language=kinds.select(F.xxhash64("language").alias("language_id"), F.col("language").alias("name")),
        category=kinds.select(F.xxhash64("language").alias("category_id"), F.col("language").alias("name")),
        film_category=films.select("film_id", F.xxhash64("language").alias("category_id")),
        inventory=t["part"].select(
            F.col("p_partkey").cast("bigint").alias("inventory_id"), F.col("p_partkey").alias("film_id"), F.lit(1).alias("store_id")
        ),
        rental=rented,
        payment=lines.select(
            number.alias("payment_id"), number.alias("rental_id"), F.col("o_custkey").alias("customer_id"),
            F.col("l_suppkey").alias("staff_id"), F.col("l_extendedprice").cast("decimal(10,2)").alias("amount"),
            F.col("l_shipdate").alias("payment_date"),
        ),
        customer=t["customer"].select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("first_name"),
            F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("last_name"), F.col("c_nationkey").alias("address_id"),
        ),
        address=t["nation"].select(F.col("n_nationkey").alias("address_id"), F.col("n_nationkey").alias("city_id")),
        city=t["nation"].select(F.col("n_nationkey").alias("city_id"), F.col("n_nationkey").alias("country_id")),
        country=t["nation"].select(F.col("n_nationkey").alias("country_id"), F.col("n_name").alias("country")),
    )


@case("g02_sql_popular_films", ORACLE["r18_popular_by_nation"].replace("release_year, rental_count\n    FROM (SELECT *", "release_year\n    FROM (SELECT *"))
def g02_sql(t: ParquetTables) -> DataFrame:
    """The SQL table function, on base tables of the rental schema."""
    sql_surface.publish_rental(t.spark, _rental_tables(t, all_lines=True), dt.date(2001, 5, 20))
    return t.spark.sql("SELECT * FROM most_popular_films_by_countries(array('nation_3', 'Nation_7', 'NATION_12'))")


@case("g03_sql_in_stock", ORACLE["r19_in_stock"])
def g03_sql(t: ParquetTables) -> DataFrame:
    """The SQL table function with its row numbers."""
    sql_surface.publish_rental(t.spark, _rental_tables(t), dt.date(2001, 5, 20))
    return shown(t.spark.sql("SELECT * FROM films_in_stock_by_title(' %RING% ')"))
