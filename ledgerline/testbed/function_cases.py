"""Scalar functions, predicates, joins and sets on the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions import numbers as num
from ledgerline.functions import text
from ledgerline.operators import lookup, pivot
from ledgerline.operators.ordering import ascending, descending, first_per_key, top_k
from ledgerline.operators.windows import number_rows
from ledgerline.sources.tables import ParquetTables, array_rows, inline
from ledgerline.testbed.registry import case, shown

# -- scalar functions ----------------------------------------------------------


@case(
    "f_text",
    """
    WITH c AS (SELECT c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') AS seg, c_acctbal FROM customer)
    SELECT c_custkey, c_name || ' ' || seg AS or_null, concat(c_name, ' ', seg) AS skipping,
           trim('  ' || c_name || ' ') AS trimmed, upper(c_name) AS up, lower(seg) AS low,
           replace(c_name, 'Customer#', '') AS replaced,
           lpad(format('{:t,.2f}', CAST(c_acctbal AS DECIMAL(18,2))), 15, ' ') AS amount,
           printf('%.4f', c_acctbal / 100) || ' %' AS pct,
           printf('client_%s_%d', lower(seg), c_custkey) AS msg,
           concat_ws(', ', c_name, seg) AS listed,
           CAST(replace(c_name, 'Customer#', '') AS BIGINT) AS number
    FROM c
    """,
)
def f_text(t: ParquetTables) -> DataFrame:
    seg = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    c = t["customer"].withColumn("seg", seg)
    name = F.col("c_name")
    return c.select(
        "c_custkey",
        text.join_or_null(name, F.lit(" "), F.col("seg")).alias("or_null"),
        text.join_skipping_nulls(name, F.lit(" "), F.col("seg")).alias("skipping"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.upper(name).alias("up"),
        F.lower("seg").alias("low"),
        F.replace(name, F.lit("Customer#"), F.lit("")).alias("replaced"),
        text.amount_text(num.money(F.col("c_acctbal"))).alias("amount"),
        text.percent_text(num.money(F.col("c_acctbal")) / F.lit(100)).alias("pct"),
        F.when(F.col("seg").isNotNull(), text.message("client_%s_%d", F.lower("seg"), F.col("c_custkey"))).alias("msg"),
        text.list_text(F.array("c_name", "seg")).alias("listed"),
        text.number_after_prefix(name, "Customer#").alias("number"),
    )


@case(
    "f_size_text",
    """
    WITH b AS (SELECT o_orderkey, o_orderkey * o_orderkey * 100003 AS n FROM orders)
    SELECT o_orderkey, CASE
      WHEN n < 10240 THEN n || ' bytes'
      WHEN CAST(round(n / 1024.0) AS BIGINT) < 10240 THEN CAST(round(n / 1024.0) AS BIGINT) || ' kB'
      WHEN CAST(round(n / 1048576.0) AS BIGINT) < 10240 THEN CAST(round(n / 1048576.0) AS BIGINT) || ' MB'
      WHEN CAST(round(n / 1073741824.0) AS BIGINT) < 10240 THEN CAST(round(n / 1073741824.0) AS BIGINT) || ' GB'
      ELSE CAST(round(n / 1099511627776.0) AS BIGINT) || ' TB' END AS size
    FROM b
    """,
)
def f_size(t: ParquetTables) -> DataFrame:
    """Bytes as text, over magnitudes from bytes to terabytes; from some ten million keys on no ``bigint`` holds them."""
    key = F.col("o_orderkey").cast("decimal(19,0)")
    sizes = t["orders"].select("o_orderkey", (key * key * F.lit(100003)).alias("n"))
    return sizes.select("o_orderkey", text.size_text(F.col("n"), largest="TB").alias("size"))


@case(
    "f_calendar",
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q,
           strftime(o_orderdate, '%Y-%m') AS month, CAST(weekofyear(o_orderdate) AS INTEGER) AS week,
           dayname(o_orderdate) AS day, strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') AS quarter_start,
           strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d') AS due,
           strftime(o_orderdate - INTERVAL 3 MONTH, '%Y-%m-%d') AS three_months_ago,
           CAST(date_diff('day', o_orderdate, DATE '2001-12-31') AS INTEGER) AS days_left,
           CAST(2001 - year(o_orderdate) AS INTEGER) AS years_ago, o_orderdate >= DATE '1998-01-01' AS recent
    FROM orders
    """,
)
def f_calendar(t: ParquetTables) -> DataFrame:
    d = F.col("o_orderdate")
    end = F.lit(dt.date(2001, 12, 31))
    orders = cal.with_calendar(t["orders"].select("o_orderkey", "o_orderdate"), "o_orderdate")
    return shown(
        orders.select(
            "o_orderkey",
            F.col("calendar_year").alias("y"),
            F.col("calendar_quarter_number").alias("q"),
            F.col("calendar_month_desc").alias("month"),
            F.col("calendar_week_number").alias("week"),
            F.col("day_name").alias("day"),
            F.to_date(F.date_trunc("quarter", d)).alias("quarter_start"),
            F.date_add(d, 7).alias("due"),
            F.add_months(d, -3).alias("three_months_ago"),
            cal.days_between(end, d).alias("days_left"),
            (F.year(end) - F.year(d)).alias("years_ago"),
            (d >= F.lit(dt.date(1998, 1, 1))).alias("recent"),
        )
    )


@case(
    "f_numbers",
    """
    SELECT l_orderkey, l_linenumber, CAST(p * (1 - d) AS DOUBLE) AS net, CAST(p + q AS DOUBLE) AS plus,
           CAST(p - q AS DOUBLE) AS minus, ((CAST(p * 100 AS BIGINT) * 200 + CAST(q * 100 AS BIGINT)) // (CAST(q * 100 AS BIGINT) * 2)) / 100.0 AS unit,
           CAST(round(p, 1) AS DOUBLE) AS rounded, l_orderkey % 7 AS rest, power(l_linenumber, 2.0) AS squared,
           CAST(coalesce(nullif(l_linenumber, 1), 0) AS INTEGER) AS filled
    FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS p, CAST(l_discount AS DECIMAL(18,2)) AS d,
                 CAST(l_quantity AS DECIMAL(18,2)) AS q FROM lineitem)
    """,
)
def f_numbers(t: ParquetTables) -> DataFrame:
    """Decimal arithmetic, rounded half up; the twin divides in whole cents to stay exact."""
    p, d, q = (num.money(F.col(c)) for c in ("l_extendedprice", "l_discount", "l_quantity"))
    return shown(
        t["lineitem"].select(
            "l_orderkey",
            "l_linenumber",
            (p * (1 - d)).alias("net"),
            (p + q).alias("plus"),
            (p - q).alias("minus"),
            F.round(p / q, 2).alias("unit"),
            F.round(p, 1).alias("rounded"),
            (F.col("l_orderkey") % 7).alias("rest"),
            num.power(F.col("l_linenumber"), F.lit(2.0)).alias("squared"),
            F.coalesce(F.nullif(F.col("l_linenumber"), F.lit(1)), F.lit(0)).alias("filled"),
        )
    )


@case(
    "f_arrays",
    """
    WITH a AS (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part)
    SELECT p_partkey, CAST(len(words) AS INTEGER) AS n_words, array_to_string(words, ', ') AS listed, words[1] AS first_word
    FROM a
    """,
)
def f_arrays(t: ParquetTables) -> DataFrame:
    words = F.split("p_name", " ")
    return t["part"].select(
        "p_partkey",
        F.size(words).alias("n_words"),
        text.list_text(words).alias("listed"),
        words.getItem(0).alias("first_word"),
    )


@case(
    "s04_unnest",
    """
    SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1
    """,
)
def s04(t: ParquetTables) -> DataFrame:
    """Array elements as rows."""
    return array_rows(t["part"], F.split("p_name", " "), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@case(
    "s02_inline_relation",
    """
    SELECT label, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM orders JOIN (VALUES ('1-URGENT', 'today'), ('2-HIGH', 'this week'), ('9-NEVER', 'never')) v(priority, label)
      ON o_orderpriority = priority
    GROUP BY 1
    """,
)
def s02(t: ParquetTables) -> DataFrame:
    """Orders against an inline relation."""
    labels = inline(
        t.spark, "priority string, label string",
        ("1-URGENT", "today"), ("2-HIGH", "this week"), ("9-NEVER", "never"),
    )
    joined = t["orders"].join(labels, F.col("o_orderpriority") == F.col("priority"), "inner")
    return shown(
        joined.groupBy("label").agg(
            F.count(F.lit(1)).alias("n_orders"), F.sum(num.money(F.col("o_totalprice"))).alias("amount")
        )
    )


# -- predicates ----------------------------------------------------------------


@case(
    "p_predicates",
    """
    WITH o AS (SELECT *, nullif(o_orderpriority, '5-LOW') AS prio FROM orders)
    SELECT count(*) FILTER (o_totalprice > 250000) AS gt, count(*) FILTER (o_totalprice <= 250000) AS le,
           count(*) FILTER (o_totalprice BETWEEN 100000 AND 200000) AS between_,
           count(*) FILTER (prio IN ('1-URGENT', '2-HIGH')) AS in_list,
           count(*) FILTER (prio NOT IN ('1-URGENT', '2-HIGH')) AS not_in_list,
           count(*) FILTER (prio IS NULL) AS is_null, count(*) FILTER (prio IS NOT NULL) AS is_not_null,
           count(*) FILTER (prio LIKE '%HIGH%') AS like_, count(*) FILTER (prio ILIKE '%medium') AS ilike_,
           count(*) FILTER (upper(prio) = upper('1-urgent')) AS same_text,
           count(*) FILTER (o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1999-01-01') AS half_open,
           count(*) FILTER (year(o_orderdate) BETWEEN 1996 AND 1997) AS years,
           count(*) FILTER (year(o_orderdate) = 1999 AND weekofyear(o_orderdate) BETWEEN 49 AND 52) AS weeks,
           count(*) FILTER (o_orderkey % 3 = 0) AS modulo,
           CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2 ELSE 0 END) AS BIGINT) AS cases
    FROM o
    """,
)
def p_predicates(t: ParquetTables) -> DataFrame:
    """Every predicate form, counted over all orders in one pass."""
    price, day, prio = F.col("o_totalprice"), F.col("o_orderdate"), F.col("prio")
    tests = {
        "gt": price > 250000,
        "le": price <= 250000,
        "between_": price.between(100000, 200000),
        "in_list": prio.isin("1-URGENT", "2-HIGH"),
        "not_in_list": ~prio.isin("1-URGENT", "2-HIGH"),
        "is_null": prio.isNull(),
        "is_not_null": prio.isNotNull(),
        "like_": prio.like("%HIGH%"),
        "ilike_": prio.ilike("%medium"),
        "same_text": text.same_text(prio, "1-urgent"),
        "half_open": cal.in_range(day, dt.date(1998, 1, 1), dt.date(1999, 1, 1)),
        "years": cal.in_years(day, 1996, 1997),
        "weeks": cal.in_iso_weeks(day, 1999, 49, 52),
        "modulo": F.col("o_orderkey") % 3 == 0,
    }
    status = F.col("o_orderstatus")
    cases = F.when(status == "F", 1).when(status == "O", 2).otherwise(0)
    orders = t["orders"].withColumn("prio", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    return orders.agg(
        *[F.count(F.when(test, 1)).alias(name) for name, test in tests.items()], F.sum(cases).alias("cases")
    )


@case(
    "p07_in_subquery",
    """
    SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
    """,
)
def p07(t: ParquetTables) -> DataFrame:
    large = t["orders"].filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    return lookup.present(t["customer"], large, ["c_custkey"]).select("c_custkey")


@case(
    "p08_not_in",
    """
    SELECT c_custkey FROM customer
    WHERE nullif(c_nationkey, 3) NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
    """,
)
def p08(t: ParquetTables) -> DataFrame:
    """NOT IN with NULLs on the left: those rows are dropped."""
    rich = t["supplier"].filter(F.col("s_acctbal") > 5000)
    customers = t["customer"].withColumn("nation", F.nullif(F.col("c_nationkey"), F.lit(3)))
    return lookup.not_in(customers, "nation", rich, "s_nationkey").select("c_custkey")


@case(
    "p08_not_in_null_list",
    """
    SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT nullif(s_nationkey, 3) FROM supplier)
    """,
)
def p08_null(t: ParquetTables) -> DataFrame:
    """NOT IN a list that holds a NULL: no row qualifies."""
    nations = t["supplier"].select(F.nullif(F.col("s_nationkey"), F.lit(3)).alias("nation"))
    return lookup.not_in(t["customer"], "c_nationkey", nations, "nation").select("c_custkey")


@case(
    "p10_not_exists",
    """
    SELECT c_custkey FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= DATE '2001-01-01')
    """,
)
def p10(t: ParquetTables) -> DataFrame:
    recent = t["orders"].filter(F.col("o_orderdate") >= F.lit(dt.date(2001, 1, 1)))
    return lookup.absent(
        t["customer"], recent.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"]
    ).select("c_custkey")


@case(
    "p13_in_pairs",
    """
    SELECT p_partkey, p_brand, p_type FROM part
    WHERE (p_brand, p_type) IN (('Brand#1', 'PROMO'), ('Brand#2', 'SMALL'), ('Brand#3', 'nothing'))
    """,
)
def p13(t: ParquetTables) -> DataFrame:
    """Row-value IN over a literal list."""
    pairs = [("Brand#1", "PROMO"), ("Brand#2", "SMALL"), ("Brand#3", "nothing")]
    return lookup.in_pairs(t["part"], ["p_brand", "p_type"], pairs).select("p_partkey", "p_brand", "p_type")


# -- joins ---------------------------------------------------------------------


@case(
    "j01_inner_join",
    """
    SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 300000
    """,
)
def j01(t: ParquetTables) -> DataFrame:
    return (
        t["orders"]
        .filter(F.col("o_totalprice") > 300000)
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "inner")
        .select("o_orderkey", "c_name")
    )


@case(
    "j05_left_join",
    """
    SELECT c_custkey, o_orderkey FROM customer
    LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000) ON o_custkey = c_custkey
    """,
)
def j05(t: ParquetTables) -> DataFrame:
    """All customers, with their large finished orders where there are any."""
    large = t["orders"].filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000))
    named = large.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return lookup.left_join_many(t["customer"].select("c_custkey"), named, ["c_custkey"])


@case(
    "j11_latest_row",
    """
    SELECT o_custkey, max(o_orderkey) AS last_order, CAST(arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS DOUBLE)
             AS last_amount
    FROM orders GROUP BY 1
    """,
)
def j11(t: ParquetTables) -> DataFrame:
    """Amount of each customer's latest order."""
    return t["orders"].groupBy("o_custkey").agg(
        F.max("o_orderkey").alias("last_order"),
        lookup.latest_value("o_totalprice", "o_orderdate", "o_orderkey").alias("last_amount"),
    )


@case(
    "j13_key_lookup",
    """
    SELECT c_custkey, n_nationkey AS nation_id
    FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'nowhere' ELSE 'NATION_' || c_nationkey END AS nation
          FROM customer)
    LEFT JOIN nation ON n_name = nation
    """,
)
def j13(t: ParquetTables) -> DataFrame:
    """Natural key to surrogate key; an unknown name leaves NULL."""
    nation = F.when(F.col("c_acctbal") < 0, "nowhere").otherwise(
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))
    )
    named = t["customer"].select("c_custkey", nation.alias("nation"))
    return lookup.resolve_key(named, t["nation"], {"nation": "n_name"}, "n_nationkey", "nation_id").select(
        "c_custkey", "nation_id"
    )


# -- aggregates, order, sets ---------------------------------------------------


@case(
    "a_aggregates",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n, count(nullif(l_linenumber, 1)) AS n_numbered,
           count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_suppliers,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
           CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS price,
           CAST(sum(CASE WHEN l_tax > 0.04 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS taxed,
           strftime(min(l_shipdate), '%Y-%m-%d') AS first_ship, strftime(max(l_shipdate), '%Y-%m-%d') AS last_ship
    FROM lineitem GROUP BY 1, 2
    """,
)
def a_aggregates(t: ParquetTables) -> DataFrame:
    price = num.money(F.col("l_extendedprice"))
    return shown(
        t["lineitem"]
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.nullif(F.col("l_linenumber"), F.lit(1))).alias("n_numbered"),
            F.countDistinct("l_partkey").alias("n_parts"),
            F.countDistinct("l_suppkey").alias("n_suppliers"),
            num.total(F.col("l_quantity")).alias("quantity"),
            F.round(num.total(F.col("l_extendedprice")), 0).alias("price"),
            pivot.sum_if(F.col("l_tax") > 0.04, price).alias("taxed"),
            F.min("l_shipdate").alias("first_ship"),
            F.max("l_shipdate").alias("last_ship"),
        )
    )


@case(
    "a09_global",
    """
    SELECT count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount, max(o_orderkey) AS last_key
    FROM orders
    """,
)
def a09(t: ParquetTables) -> DataFrame:
    return shown(
        t["orders"].agg(
            F.count(F.lit(1)).alias("n"), num.total(F.col("o_totalprice")).alias("amount"),
            F.max("o_orderkey").alias("last_key"),
        )
    )


@case(
    "a11_pivot",
    """
    SELECT c_mktsegment, sum(n) FILTER (s = 'F')::BIGINT AS finished, sum(n) FILTER (s = 'O')::BIGINT AS open_
    FROM (SELECT c_mktsegment, o_orderstatus AS s, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
          WHERE o_totalprice > 490000 GROUP BY 1, 2) GROUP BY 1
    """,
)
def a11(t: ParquetTables) -> DataFrame:
    """A status outside the list is dropped; a segment without one of the listed shows NULL."""
    large = t["orders"].filter(F.col("o_totalprice") > 490000).join(
        t["customer"], F.col("o_custkey") == F.col("c_custkey"), "inner"
    )
    return pivot.crosstab(
        large, ["c_mktsegment"], "o_orderstatus", {"F": "finished", "O": "open_"}, F.count(F.lit(1))
    )


@case(
    "k01_null_order",
    """
    SELECT c_custkey, CAST(row_number() OVER (ORDER BY seg NULLS LAST, c_custkey) AS INTEGER) AS up,
           CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY seg DESC NULLS FIRST, c_custkey DESC) AS INTEGER)
             AS down
    FROM (SELECT *, nullif(c_mktsegment, 'MACHINERY') AS seg FROM customer)
    """,
)
def k01(t: ParquetTables) -> DataFrame:
    """NULL last going up and first going down."""
    c = t["customer"].select("c_custkey", "c_nationkey", F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("seg"))
    buckets = {"b_segment": F.col("seg"), "b_key": F.floor(F.col("c_custkey") / 100_000)}
    up = number_rows(c, ascending("seg", "c_custkey"), buckets, "up")
    both = number_rows(up, descending("seg", "c_custkey"), None, "down", partition_by=["c_nationkey"], unique_order=True)
    return both.select("c_custkey", F.col("up").cast("int").alias("up"), F.col("down").cast("int").alias("down"))


@case(
    "k03_top_k",
    """
    SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 25
    """,
)
def k03(t: ParquetTables) -> DataFrame:
    best = top_k(t["orders"], 25, *descending("o_totalprice"), *ascending("o_orderkey"))
    return best.select("o_orderkey", "o_totalprice")


@case(
    "k05_any_one",
    """
    SELECT c_mktsegment, c_nationkey, min(c_custkey) AS c_custkey FROM customer GROUP BY 1, 2
    """,
)
def k05(t: ParquetTables) -> DataFrame:
    """Any one customer per segment and nation, made definite: the first key."""
    one = first_per_key(t["customer"], ["c_mktsegment", "c_nationkey"], ascending("c_custkey"))
    return one.select("c_mktsegment", "c_nationkey", "c_custkey")


@case(
    "u01_union",
    """
    SELECT c_nationkey AS nationkey, c_mktsegment AS kind FROM customer
    UNION SELECT s_nationkey, 'SUPPLIER' FROM supplier
    UNION SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0
    """,
)
def u01(t: ParquetTables) -> DataFrame:
    """UNION keeps one copy of each row."""
    buyers = t["customer"].select(F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("kind"))
    sellers = t["supplier"].select(F.col("s_nationkey").alias("nationkey"), F.lit("SUPPLIER").alias("kind"))
    in_debt = t["customer"].filter(F.col("c_acctbal") < 0).select("c_nationkey", "c_mktsegment")
    return buyers.union(sellers).union(in_debt).distinct()
