"""Sales reports and window frames on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions.numbers import MONEY, percent_of
from ledgerline.operators import windows
from ledgerline.operators.ordering import ascending, top_n_per_group, top_rank_per_group
from ledgerline.plans import sales
from ledgerline.sources.tables import ParquetTables
from ledgerline.testbed import mapping as m
from ledgerline.testbed.registry import case, shown

REGIONS = ("AMERICA", "ASIA", "EUROPE")


@case(
    "r01_channel_share",
    """
    WITH sold AS (
      SELECT r_name AS country_region, CAST(year(o_orderdate) AS INTEGER) AS calendar_year,
             o_orderpriority AS channel_desc, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount_sold
      FROM orders JOIN customer ON o_custkey = c_custkey
                  JOIN nation ON c_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey
      WHERE year(o_orderdate) BETWEEN 1999 AND 2001 AND r_name IN ('AMERICA', 'ASIA', 'EUROPE')
      GROUP BY 1, 2, 3),
    shares AS (
      SELECT *, round(100.0 * CAST(amount_sold AS DOUBLE)
                      / CAST(sum(amount_sold) OVER (PARTITION BY country_region, calendar_year) AS DOUBLE), 2) AS pct
      FROM sold),
    lagged AS (
      SELECT *, coalesce(lag(pct) OVER (PARTITION BY country_region, channel_desc ORDER BY calendar_year), 0) AS prev
      FROM shares)
    SELECT country_region, calendar_year, channel_desc, CAST(amount_sold AS DOUBLE) AS amount_sold,
           CAST(pct AS DOUBLE) AS pct_by_channels, CAST(prev AS DOUBLE) AS pct_previous_period,
           CAST(round(CAST(pct AS DECIMAL(18,2)) - CAST(prev AS DECIMAL(18,2)), 2) AS DOUBLE) AS pct_diff
    FROM lagged ORDER BY country_region, calendar_year, channel_desc
    """,
)
def r01(t: ParquetTables) -> DataFrame:
    return shown(sales.channel_share(m.order_lines(t), regions=REGIONS))


_DAILY = """
    daily AS (
      SELECT CAST(o_orderdate AS DATE) AS d, CAST(weekofyear(o_orderdate) AS INTEGER) AS w,
             dayname(o_orderdate) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s
      FROM orders GROUP BY 1, 2, 3)"""
_AVERAGE = """
      CASE n WHEN 'Monday' THEN (coalesce(lag(s, 2) OVER o, 0) + coalesce(lag(s, 1) OVER o, 0) + s
                                 + coalesce(lead(s, 1) OVER o, 0)) * CAST(0.25 AS DECIMAL(3,2))
             WHEN 'Friday' THEN (coalesce(lag(s, 1) OVER o, 0) + s + coalesce(lead(s, 1) OVER o, 0)
                                 + coalesce(lead(s, 2) OVER o, 0)) * CAST(0.25 AS DECIMAL(3,2))
             END"""
# A quarter of an amount may end in half a cent, so Mondays and Fridays stay decimal.
_ROUNDED = f"""
      coalesce(CAST(round({_AVERAGE}, 2) AS DOUBLE),
               round((coalesce(lag(s, 1) OVER o, 0) + s + coalesce(lead(s, 1) OVER o, 0)) / 3.0, 2))"""


@case(
    "r02_centered_avg",
    f"""
    WITH {_DAILY},
    weeks AS (SELECT * FROM daily WHERE year(d) = 1999 AND w BETWEEN 49 AND 51)
    SELECT w AS calendar_week_number, strftime(d, '%Y-%m-%d') AS time_id, n AS day_name, CAST(s AS DOUBLE) AS sales,
           CAST(sum(s) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cum_sum,
           CAST({_ROUNDED} AS DOUBLE) AS centered_3_day_avg
    FROM weeks WINDOW o AS (ORDER BY d) ORDER BY d
    """,
)
def r02(t: ParquetTables) -> DataFrame:
    return shown(sales.weekly_sales_report(m.dated_orders(t)))


@case(
    "r02_week_reset",
    f"""
    WITH {_DAILY},
    averaged AS (SELECT *, CAST({_ROUNDED} AS DOUBLE) AS avg3 FROM daily WINDOW o AS (ORDER BY d))
    SELECT w AS calendar_week_number, strftime(d, '%Y-%m-%d') AS time_id, n AS day_name, CAST(s AS DOUBLE) AS sales,
           CAST(sum(s) OVER (PARTITION BY w ORDER BY d ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cum_sum,
           avg3 AS centered_3_day_avg
    FROM averaged WHERE year(d) = 1999 AND w BETWEEN 49 AND 51 ORDER BY d
    """,
)
def r02_week_reset(t: ParquetTables) -> DataFrame:
    """The running sum starts anew each week, and edge days see their neighbours."""
    return shown(sales.weekly_sales_report(m.dated_orders(t), reset_each_week=True, neighbours_outside=True))


def _frame_sql(name: str, order: str, mode: str) -> str:
    return f"""
    WITH {_DAILY},
    week AS (SELECT * FROM daily WHERE year(d) = 1999 AND w = 49)
    SELECT strftime(d, '%Y-%m-%d') AS time_id, n AS day_name, CAST(s AS DOUBLE) AS daily_sales,
           CAST(sum(s) OVER (ORDER BY {order} {mode} BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS {name}
    FROM week ORDER BY {order}
    """


@case("r03_rows", _frame_sql("running_total_rows", "d", "ROWS"))
def r03(t: ParquetTables) -> DataFrame:
    return shown(sales.running_total_rows(m.dated_orders(t)))


@case("r04_range", _frame_sql("running_total_range", "d", "RANGE"))
def r04(t: ParquetTables) -> DataFrame:
    return shown(sales.running_total_range(m.dated_orders(t)))


@case("r05_groups", _frame_sql("running_group_total", "s", "GROUPS"))
def r05(t: ParquetTables) -> DataFrame:
    return shown(sales.running_total_groups(m.dated_orders(t)))


@case(
    "r06_top5_share",
    """
    WITH sold AS (
      SELECT o_orderpriority AS channel_desc, c_name AS cust_last_name, c_mktsegment AS cust_first_name,
             sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
    ranked AS (
      SELECT *, sum(amount) OVER (PARTITION BY channel_desc) AS whole,
             row_number() OVER (PARTITION BY channel_desc ORDER BY amount DESC, cust_last_name, cust_first_name) AS rn
      FROM sold)
    SELECT channel_desc, cust_last_name, cust_first_name, CAST(amount AS DOUBLE) AS amount_sold,
           printf('%.4f', round(100.0 * CAST(amount AS DOUBLE) / CAST(whole AS DOUBLE), 4)) || ' %' AS sales_percentage
    FROM ranked WHERE rn <= 5
    """,
)
def r06(t: ParquetTables) -> DataFrame:
    return shown(sales.top_customers_per_channel(m.customer_lines(t)))


_ITEMS = """
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
                    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                    JOIN region ON n_regionkey = r_regionkey"""


@case(
    "r07_quarter_pivot",
    f"""
    WITH sold AS (
      SELECT p_name AS product_name, quarter(l_shipdate) AS q, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s
      {_ITEMS}
      WHERE p_type = 'PROMO' AND r_name = 'ASIA' AND year(l_shipdate) = 2000 GROUP BY 1, 2),
    wide AS (
      SELECT product_name, sum(s) FILTER (q = 1) AS q1, sum(s) FILTER (q = 2) AS q2,
             sum(s) FILTER (q = 3) AS q3, sum(s) FILTER (q = 4) AS q4
      FROM sold GROUP BY 1)
    SELECT product_name, CAST(q1 AS DOUBLE) AS q1, CAST(q2 AS DOUBLE) AS q2, CAST(q3 AS DOUBLE) AS q3,
           CAST(q4 AS DOUBLE) AS q4,
           CAST(coalesce(q1, 0) + coalesce(q2, 0) + coalesce(q3, 0) + coalesce(q4, 0) AS DOUBLE) AS year_sum
    FROM wide
    """,
)
def r07(t: ParquetTables) -> DataFrame:
    return shown(sales.product_quarter_pivot(m.item_lines(t), category="PROMO", region="ASIA"))


def _top300_sql(partition: str, having: str = "") -> str:
    return f"""
    WITH sold AS (
      SELECT o_orderpriority AS channel_desc, o_custkey AS cust_id, c_name AS cust_last_name,
             c_mktsegment AS cust_first_name, year(o_orderdate) AS y, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s
      FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE year(o_orderdate) IN (1998, 1999, 2001) GROUP BY 1, 2, 3, 4, 5),
    ranked AS (SELECT *, rank() OVER (PARTITION BY {partition} ORDER BY s DESC) AS rk FROM sold)
    SELECT channel_desc, cust_id, cust_last_name, cust_first_name,
           lpad(format('{{:t,.2f}}', CAST(sum(s) AS DECIMAL(18,2))), 15, ' ') AS amount_sold
    FROM ranked WHERE rk <= 300 GROUP BY 1, 2, 3, 4 {having}
    """


@case("r08_top300", _top300_sql("y"))
def r08(t: ParquetTables) -> DataFrame:
    return shown(sales.yearly_top_customers(m.customer_lines(t)))


@case("r08_top300_every_year", _top300_sql("y, channel_desc", "HAVING count(*) = 3"))
def r08_every(t: ParquetTables) -> DataFrame:
    """Ranked within each channel, and in the list in all three years."""
    return shown(sales.yearly_top_customers(m.customer_lines(t), rank_within_channel=True, in_every_year=True))


@case(
    "r09_month_region",
    f"""
    SELECT strftime(l_shipdate, '%Y-%m') AS calendar_month_desc, p_type AS prod_category,
           CAST(sum(CASE WHEN r_name = 'AMERICA' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE)
             AS "Americas SALES",
           CAST(sum(CASE WHEN r_name = 'EUROPE' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE)
             AS "Europe SALES"
    {_ITEMS}
    WHERE strftime(l_shipdate, '%Y-%m') IN ('2000-01', '2000-02', '2000-03') AND r_name IN ('AMERICA', 'EUROPE')
    GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def r09(t: ParquetTables) -> DataFrame:
    columns = {"AMERICA": "Americas SALES", "EUROPE": "Europe SALES"}
    return shown(sales.month_category_report(m.item_lines(t), regions=columns))


# -- windows over whole tables -------------------------------------------------


@case(
    "w01_partition_total",
    """
    SELECT n_regionkey AS region, n_name AS nation, CAST(b AS DOUBLE) AS balance,
           CAST(sum(b) OVER (PARTITION BY n_regionkey) AS DOUBLE) AS region_balance
    FROM (SELECT n_regionkey, n_name, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS b
          FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
    """,
)
def w01(t: ParquetTables) -> DataFrame:
    """Partition total over an aggregate."""
    balances = (
        t["customer"]
        .groupBy("c_nationkey")
        .agg(F.sum(F.col("c_acctbal").cast(MONEY)).alias("balance"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .select(F.col("n_regionkey").alias("region"), F.col("n_name").alias("nation"), "balance")
    )
    return shown(balances.withColumn("region_balance", windows.partition_total("balance", ["region"])))


@case(
    "w04_lag_lead",
    """
    WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s
               FROM orders GROUP BY 1)
    SELECT month, CAST(s AS DOUBLE) AS sales, CAST(lag(s, 1) OVER o AS DOUBLE) AS lag1,
           CAST(lag(s, 2) OVER o AS DOUBLE) AS lag2, CAST(lead(s, 1) OVER o AS DOUBLE) AS lead1,
           CAST(lead(s, 2) OVER o AS DOUBLE) AS lead2
    FROM m WINDOW o AS (ORDER BY month)
    """,
)
def w04(t: ParquetTables) -> DataFrame:
    """Neighbouring months; one row per month is what the single window sorts."""
    from pyspark.sql import Window as W

    months = m.dated_orders(t).groupBy(cal.month_text(F.col("time_id")).alias("month")).agg(
        F.sum("amount_sold").alias("sales")
    )
    o = W.orderBy(*ascending("month"))
    return shown(
        months.select(
            "month",
            "sales",
            F.lag("sales", 1).over(o).alias("lag1"),
            F.lag("sales", 2).over(o).alias("lag2"),
            F.lead("sales", 1).over(o).alias("lead1"),
            F.lead("sales", 2).over(o).alias("lead2"),
        )
    )


@case(
    "w05_row_number",
    """
    SELECT c_nationkey, c_custkey, CAST(c_acctbal AS DOUBLE) AS c_acctbal, CAST(rn AS INTEGER) AS rn
    FROM (SELECT c_nationkey, c_custkey, c_acctbal,
                 row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer)
    WHERE rn <= 10
    """,
)
def w05(t: ParquetTables) -> DataFrame:
    order = [F.col("c_acctbal").desc_nulls_first(), F.col("c_custkey").asc_nulls_last()]
    best = top_n_per_group(t["customer"], ["c_nationkey"], order, 10)
    return shown(best.select("c_nationkey", "c_custkey", "c_acctbal", "rn"))


@case(
    "w06_rank",
    """
    SELECT CAST(y AS INTEGER) AS y, p_type, CAST(n AS BIGINT) AS n, CAST(rk AS INTEGER) AS rk
    FROM (SELECT y, p_type, n, rank() OVER (PARTITION BY y ORDER BY n DESC) AS rk
          FROM (SELECT year(l_shipdate) AS y, p_type, count(*) AS n
                FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2))
    WHERE rk <= 3
    """,
)
def w06(t: ParquetTables) -> DataFrame:
    """Rank over an aggregate, per year of the date."""
    counts = (
        t["lineitem"]
        .groupBy(F.year("l_shipdate").alias("y"), "l_partkey")
        .agg(F.count(F.lit(1)).alias("c"))
        .join(t["part"].select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"), "inner")
        .groupBy("y", "p_type")
        .agg(F.sum("c").alias("n"))
    )
    return top_rank_per_group(counts, ["y"], [F.col("n").desc_nulls_first()], 3).select("y", "p_type", "n", "rk")


_ORDER_BUCKETS = {
    "b_year": lambda: F.year("o_orderdate"),
    "b_day": lambda: F.to_date("o_orderdate"),
    "b_key": lambda: F.floor(F.col("o_orderkey") / F.lit(1_000_000)),
}


def _buckets() -> dict:
    return {name: make() for name, make in _ORDER_BUCKETS.items()}


@case(
    "w07_rows_all_orders",
    """
    SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (
             ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
             AS running_total
    FROM orders
    """,
)
def w07(t: ParquetTables) -> DataFrame:
    """Running total over every order, bucketed by year, day and key range."""
    orders = t["orders"].select("o_orderkey", "o_orderdate", "o_totalprice")
    total = windows.running_total(
        orders, F.col("o_totalprice").cast(MONEY), ascending("o_orderdate", "o_orderkey"), _buckets()
    )
    return shown(total.select("o_orderkey", "running_total"))


@case(
    "w08_range_all_orders",
    """
    SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (
             PARTITION BY o_orderpriority ORDER BY o_orderdate
             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
    FROM orders
    """,
)
def w08(t: ParquetTables) -> DataFrame:
    """RANGE total per priority over every order: peers of a date share one figure."""
    orders = t["orders"].select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    total = windows.running_groups_total(
        orders,
        F.col("o_totalprice").cast(MONEY),
        "o_orderdate",
        "running_total",
        {"b_year": F.year("o_orderdate")},
        ["o_orderpriority"],
    )
    return shown(total.select("o_orderkey", "running_total"))


_TYPE_SIZE = """
    WITH c AS (SELECT p_type, p_size, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


@case(
    "w09_groups_frames",
    f"""{_TYPE_SIZE}
    SELECT p_type, p_size, CAST(n AS BIGINT) AS n,
           CAST(sum(n) OVER (PARTITION BY p_type ORDER BY n GROUPS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                AS BIGINT) AS up_to_here,
           CAST(sum(n) OVER (PARTITION BY p_type ORDER BY n GROUPS BETWEEN 1 PRECEDING AND 1 FOLLOWING)
                AS BIGINT) AS around,
           CAST(sum(n) OVER (PARTITION BY p_type ORDER BY n GROUPS BETWEEN 2 FOLLOWING AND UNBOUNDED FOLLOWING)
                AS BIGINT) AS beyond
    FROM c
    """,
)
def w09(t: ParquetTables) -> DataFrame:
    """Three GROUPS frames over counts that have ties."""
    per_part = t["lineitem"].groupBy("l_partkey").agg(F.count(F.lit(1)).alias("c"))
    counts = (
        per_part.join(t["part"].select("p_partkey", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey"), "inner")
        .groupBy("p_type", "p_size")
        .agg(F.sum("c").alias("n"))
    )
    n = F.col("n")
    framed = counts
    for name, lower, upper in (("up_to_here", None, 0), ("around", -1, 1), ("beyond", 2, None)):
        framed = windows.groups_frame(framed, n, "n", name, lower, upper, ["p_type"], "bigint")
    return framed.select("p_type", "p_size", "n", "up_to_here", "around", "beyond")


@case(
    "w09_groups_all_orders",
    """
    SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (
             ORDER BY o_totalprice GROUPS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
    FROM orders
    """,
)
def w09_all(t: ParquetTables) -> DataFrame:
    """GROUPS total ordered by the amount, over every order and without a partition key."""
    orders = t["orders"].select("o_orderkey", F.col("o_totalprice").cast(MONEY).alias("amount"))
    total = windows.running_groups_total(
        orders,
        F.col("amount"),
        "amount",
        "running_total",
        {"b_thousand": F.floor(F.col("amount") / 1000)},
    )
    return shown(total.select("o_orderkey", "running_total"))


@case(
    "w09_groups_around_all_lines",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (
             PARTITION BY l_returnflag ORDER BY l_orderkey GROUPS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS DOUBLE)
             AS around
    FROM lineitem
    """,
)
def w09_around(t: ParquetTables) -> DataFrame:
    """A GROUPS frame with two bounded sides over three large partitions."""
    lines = t["lineitem"].select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").cast(MONEY).alias("amount")
    )
    framed = windows.large_groups_frame(
        lines,
        F.col("amount"),
        "l_orderkey",
        "around",
        -2,
        1,
        ["l_returnflag"],
        buckets={"b_key": F.floor(F.col("l_orderkey") / 100_000)},
    )
    return shown(framed.select("l_orderkey", "l_linenumber", "l_partkey", "around"))


@case(
    "w11_row_numbers",
    """
    SELECT CAST(row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                            l_extendedprice) AS BIGINT) AS row_num,
           l_orderkey, l_linenumber, l_partkey, l_suppkey
    FROM lineitem
    """,
)
def w11(t: ParquetTables) -> DataFrame:
    """A dense number for every line in one declared order, over sampled ranges."""
    columns = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    numbered = windows.number_rows(t["lineitem"].select(*columns), ascending(*columns))
    return numbered.select("row_num", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@case(
    "w13_share",
    """
    SELECT c_mktsegment, CAST(s AS DOUBLE) AS sales,
           CAST(round(100.0 * CAST(s AS DOUBLE) / CAST(sum(s) OVER () AS DOUBLE), 2) AS DOUBLE) AS pct
    FROM (SELECT c_mktsegment, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
    """,
)
def w13(t: ParquetTables) -> DataFrame:
    """Share of the grand total; customers are summed before they meet their segment."""
    per_customer = t["orders"].groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("s"))
    sold = (
        per_customer.join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "inner")
        .groupBy("c_mktsegment")
        .agg(F.sum("s").alias("sales"))
    )
    whole = windows.partition_total("sales", [])
    return shown(sold.select("c_mktsegment", "sales", percent_of(F.col("sales"), whole, 2).alias("pct")))
