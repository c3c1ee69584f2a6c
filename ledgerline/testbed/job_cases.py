"""Table jobs, ingest rules and row visibility on the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import calendar as cal
from ledgerline.functions.numbers import money
from ledgerline.functions.text import number_after_prefix
from ledgerline.operators import ingest, mutate
from ledgerline.operators.lookup import only_value
from ledgerline.operators.ordering import ascending
from ledgerline.operators.quality import row_counts
from ledgerline.operators.visibility import rows_per_user, visible_rows
from ledgerline.plans import fuel, rental
from ledgerline.sources.tables import ParquetTables
from ledgerline.testbed.registry import case, shown

LABEL = "a_rather_long_order_label_"


def lines_with_orders(t: ParquetTables) -> DataFrame:
    return t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"), "inner")


# -- inserts -------------------------------------------------------------------


@case(
    "m01_insert_absent",
    """
    WITH target AS (SELECT min(p_partkey) AS kind_id, p_brand, p_type FROM part WHERE p_size <= 5 GROUP BY 2, 3),
    fresh AS (SELECT DISTINCT p_brand, p_type FROM part p
              WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.p_brand = p.p_brand AND t.p_type = p.p_type))
    SELECT (SELECT coalesce(max(kind_id), 0) FROM target) + row_number() OVER (ORDER BY p_brand, p_type) AS kind_id,
           p_brand, p_type
    FROM fresh
    """,
)
def m01(t: ParquetTables) -> DataFrame:
    """Brand and type pairs the small parts do not have yet, with new keys."""
    pairs = t["part"].select("p_brand", "p_type", "p_size", "p_partkey")
    target = pairs.filter(F.col("p_size") <= 5).groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("kind_id"))
    fresh = mutate.insert_absent(target, pairs.select("p_brand", "p_type"), ["p_brand", "p_type"])
    keyed = mutate.assign_keys(fresh, target, "kind_id", ascending("p_brand", "p_type"), {"b": F.col("p_brand")})
    return keyed.select("kind_id", "p_brand", "p_type")


@case(
    "m02_child_insert",
    """
    WITH target AS (SELECT * FROM supplier WHERE s_acctbal < 0),
    batch AS (SELECT s_name, CASE WHEN s_acctbal > 9000 THEN 'ATLANTIS' ELSE n_name END AS nation_name
              FROM supplier JOIN nation ON s_nationkey = n_nationkey),
    fresh AS (SELECT s_name, n_nationkey AS s_nationkey FROM batch JOIN nation ON n_name = nation_name
              WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.s_name = batch.s_name AND t.s_nationkey = n_nationkey))
    SELECT (SELECT coalesce(max(s_suppkey), 0) FROM target) + row_number() OVER (ORDER BY s_name) AS s_suppkey, s_name, s_nationkey
    FROM fresh
    """,
)
def m02(t: ParquetTables) -> DataFrame:
    """Suppliers with the nation found by name; an unknown nation adds nothing."""
    target = t["supplier"].filter(F.col("s_acctbal") < 0)
    batch = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"), "inner").select(
        "s_name", F.when(F.col("s_acctbal") > 9000, "ATLANTIS").otherwise(F.col("n_name")).alias("nation_name")
    )
    fresh = mutate.insert_absent_child(
        target, batch, t["nation"], {"nation_name": "n_name"}, "n_nationkey", "s_nationkey", ["s_name"]
    )
    return mutate.assign_keys(fresh, target, "s_suppkey", ascending("s_name")).select(
        "s_suppkey", "s_name", "s_nationkey"
    )


@case(
    "m03_bridge",
    """
    WITH l AS (SELECT l_suppkey AS s_suppkey, o_custkey AS c_custkey, l_shipdate
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT DISTINCT s_suppkey, c_custkey FROM l WHERE l_shipdate >= DATE '2001-01-01'
      AND NOT EXISTS (SELECT 1 FROM l o WHERE o.l_shipdate < DATE '2001-01-01'
                      AND o.s_suppkey = l.s_suppkey AND o.c_custkey = l.c_custkey)
    """,
)
def m03(t: ParquetTables) -> DataFrame:
    """Supplier - customer links of 2001 given by name pairs, without those known before."""
    lines = lines_with_orders(t).select("l_suppkey", "o_custkey", "l_shipdate")
    new_year = F.lit(dt.date(2001, 1, 1))
    pairs = (
        lines.filter(F.col("l_shipdate") >= new_year)
        .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"), "inner")
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "inner")
        .select("s_name", "c_name")
    )
    existing = lines.filter(F.col("l_shipdate") < new_year).select(
        F.col("l_suppkey").alias("s_suppkey"), F.col("o_custkey").alias("c_custkey")
    )
    return mutate.bridge_rows(
        pairs, t["supplier"], {"s_name": "s_name"}, "s_suppkey", t["customer"], {"c_name": "c_name"}, "c_custkey", existing
    )


@case(
    "m04_cross_fill",
    """
    SELECT p_partkey, n_nationkey FROM part, nation
    WHERE p_name IN ('red ring', 'cold rod', 'no such part')
      AND NOT EXISTS (SELECT 1 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                      WHERE l_partkey = p_partkey AND s_nationkey = n_nationkey)
    """,
)
def m04(t: ParquetTables) -> DataFrame:
    """Nations that do not hold one of the named parts yet."""
    existing = t["lineitem"].join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"), "inner").select(
        F.col("l_partkey").alias("p_partkey"), F.col("s_nationkey").alias("n_nationkey")
    )
    names = ["red ring", "cold rod", "no such part"]
    return mutate.missing_pairs(t["part"], "p_partkey", "p_name", names, t["nation"], "n_nationkey", existing)


# -- updates -------------------------------------------------------------------


@case(
    "m05_upsert",
    """
    WITH target AS (SELECT c_custkey, c_name, c_mktsegment, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal
                    FROM customer WHERE c_acctbal >= 0),
    change AS (SELECT o_custkey, 'from orders' AS c_name, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS c_acctbal
               FROM orders GROUP BY 1)
    SELECT coalesce(c_custkey, o_custkey) AS c_custkey,
           CASE WHEN c_custkey IS NULL THEN change.c_name ELSE target.c_name END AS c_name, c_mktsegment,
           CAST(CASE WHEN o_custkey IS NULL THEN target.c_acctbal ELSE change.c_acctbal END AS DOUBLE) AS c_acctbal
    FROM target FULL JOIN change ON c_custkey = o_custkey
    """,
)
def m05(t: ParquetTables) -> DataFrame:
    """Order totals replace the balance of known customers and add the unknown ones."""
    target = t["customer"].filter(F.col("c_acctbal") >= 0).select(
        "c_custkey", "c_name", "c_mktsegment", money(F.col("c_acctbal")).alias("c_acctbal")
    )
    changes = (
        t["orders"]
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum(money(F.col("o_totalprice"))).alias("c_acctbal"))
        .withColumn("c_name", F.lit("from orders"))
    )
    return shown(mutate.upsert(target, changes, ["c_custkey"], ["c_acctbal"]))


@case(
    "m06_update",
    """
    SELECT c_custkey, CASE WHEN hit THEN 'LOYAL' ELSE c_mktsegment END AS c_mktsegment,
           CASE WHEN hit THEN (SELECT min(n_nationkey) FROM nation JOIN region ON n_regionkey = r_regionkey
                               WHERE r_name = 'EUROPE') ELSE c_nationkey END AS c_nationkey
    FROM (SELECT *, c_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 12) AS hit FROM customer)
    """,
)
def m06(t: ParquetTables) -> DataFrame:
    """Customers with at least twelve orders get a new segment and nation."""
    loyal = t["orders"].groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    europe = t["nation"].join(
        t["region"].filter(F.col("r_name") == "EUROPE"), F.col("n_regionkey") == F.col("r_regionkey"), "left_semi"
    )
    home = only_value(europe.agg(F.min("n_nationkey").alias("k")), "k")
    updated = mutate.update_where_key(
        t["customer"], loyal.filter(F.col("n") >= 12), "c_custkey", {"c_mktsegment": F.lit("LOYAL"), "c_nationkey": home}
    )
    return updated.select("c_custkey", "c_mktsegment", "c_nationkey")


# -- deletes -------------------------------------------------------------------


@case(
    "m07_delete_third",
    f"""
    SELECT col FROM (SELECT '{LABEL}' || o_orderkey AS col FROM orders)
    WHERE CAST(replace(col, '{LABEL}', '') AS BIGINT) % 3 <> 0
    """,
)
def m07(t: ParquetTables) -> DataFrame:
    """Labels whose number three divides are deleted; the rest is the new snapshot."""
    labels = t["orders"].select(F.concat(F.lit(LABEL), F.col("o_orderkey").cast("string")).alias("col"))
    return mutate.delete_where(labels, number_after_prefix(F.col("col"), LABEL) % 3 == 0)


@case(
    "m07_delete_by_subquery",
    """
    SELECT o_orderkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """,
)
def m07_subquery(t: ParquetTables) -> DataFrame:
    gone = t["customer"].filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return mutate.delete_keys(t["orders"], gone, ["o_custkey"]).select("o_orderkey")


_CASCADE = (
    mutate.Reference("nation", ("n_regionkey",), "region", ("r_regionkey",)),
    mutate.Reference("customer", ("c_nationkey",), "nation", ("n_nationkey",)),
    mutate.Reference("supplier", ("s_nationkey",), "nation", ("n_nationkey",)),
    mutate.Reference("orders", ("o_custkey",), "customer", ("c_custkey",)),
    mutate.Reference("lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
    mutate.Reference("lineitem", ("l_suppkey",), "supplier", ("s_suppkey",)),
)


@case(
    "m08_cascade",
    """
    WITH r AS (SELECT * FROM region WHERE r_name <> 'ASIA'),
    n AS (SELECT * FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM r)),
    c AS (SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM n)),
    s AS (SELECT * FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n)),
    o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
    l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o) AND l_suppkey IN (SELECT s_suppkey FROM s))
    SELECT 'region' AS table_name, count(*) AS n_rows FROM r UNION ALL SELECT 'nation', count(*) FROM n
    UNION ALL SELECT 'customer', count(*) FROM c UNION ALL SELECT 'supplier', count(*) FROM s
    UNION ALL SELECT 'orders', count(*) FROM o UNION ALL SELECT 'lineitem', count(*) FROM l
    """,
)
def m08(t: ParquetTables) -> DataFrame:
    """Rows left in every table after one region goes; a line has two parents."""
    names = ["region", "nation", "customer", "supplier", "orders", "lineitem"]
    tables = {n: t[n] for n in names}
    doomed = t["region"].filter(F.col("r_name") == "ASIA").select("r_regionkey")
    return row_counts(mutate.cascade_delete(tables, _CASCADE, "region", doomed))


@case(
    "m08_cascade_lines",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
                             JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
                             WHERE r_name = 'ASIA')
      AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
                            JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')
    """,
)
def m08_lines(t: ParquetTables) -> DataFrame:
    """The surviving lines themselves, with the key sets written once."""
    names = ["region", "nation", "customer", "supplier", "orders", "lineitem"]
    doomed = t["region"].filter(F.col("r_name") == "ASIA").select("r_regionkey")
    kept = mutate.cascade_delete({n: t[n] for n in names}, _CASCADE, "region", doomed, materialise=True)
    return kept["lineitem"].select("l_orderkey", "l_linenumber", "l_suppkey")


@case(
    "m18_truncate",
    """
    SELECT 'before' AS table_name, count(*) AS n_rows FROM orders UNION ALL SELECT 'after', 0
    """,
)
def m18(t: ParquetTables) -> DataFrame:
    return row_counts({"before": t["orders"], "after": mutate.truncated(t["orders"])})


# -- keys and columns ----------------------------------------------------------


@case(
    "m09_keys",
    """
    SELECT (SELECT coalesce(max(event_id), 0) FROM events) + row_number() OVER (ORDER BY o_orderdate, o_orderkey)
             AS event_id, o_orderkey
    FROM orders
    """,
)
def m09(t: ParquetTables) -> DataFrame:
    """Every order as a new event, numbered by date after the largest event id."""
    buckets = {
        "b_year": F.year("o_orderdate"),
        "b_day": F.to_date("o_orderdate"),
        "b_key": F.floor(F.col("o_orderkey") / F.lit(1_000_000)),
    }
    rows = t["orders"].select("o_orderkey", "o_orderdate")
    keyed = mutate.assign_keys(rows, t["events"], "event_id", ascending("o_orderdate", "o_orderkey"), buckets)
    return keyed.select("event_id", "o_orderkey")


@case(
    "m09_unordered_keys",
    """
    SELECT count(*) AS n, count(DISTINCT c_custkey) AS n_keys, max(event_id) + 1 AS first_key,
           max(event_id) + count(*) AS last_key
    FROM customer, (SELECT max(event_id) AS event_id FROM events) GROUP BY event_id
    """,
)
def m09_unordered(t: ParquetTables) -> DataFrame:
    """Hash-bucketed keys: dense and unique, their order is free."""
    rows = t["customer"].select("c_name")
    keyed = mutate.assign_unordered_keys(rows, t["events"], "event_id", ["c_name"])
    return keyed.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("event_id").alias("n_keys"),
        F.min("event_id").alias("first_key"),
        F.max("event_id").alias("last_key"),
    )


@case(
    "m14_add_default",
    """
    SELECT event_id, '2024-02-01' AS record_ts, coalesce(CASE WHEN event_type <> 'error' THEN value END, 0.0) AS value
    FROM events
    """,
)
def m14(t: ParquetTables) -> DataFrame:
    """A new column filled by its default, and an existing one with its gaps filled."""
    gaps = t["events"].withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    dated = mutate.add_column(gaps, "record_ts", F.lit(dt.date(2024, 2, 1)))
    filled = mutate.fill_nulls(dated, {"value": F.lit(0.0)})
    return shown(filled.select("event_id", "record_ts", "value"))


@case(
    "m15_generated",
    """
    SELECT l_orderkey, l_linenumber, CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS duration_days,
           nullif(o_orderpriority, '5-LOW') || ' ' || l_returnflag AS full_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def m15(t: ParquetTables) -> DataFrame:
    """Generated columns: days between two dates, and a name that is NULL when a part is."""
    rows = lines_with_orders(t).select(
        "l_orderkey",
        "l_linenumber",
        cal.days_between(F.col("l_shipdate"), F.col("o_orderdate")).alias("duration_days"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("first_name"),
        F.col("l_returnflag").alias("last_name"),
    )
    return fuel.with_full_name(rows).drop("first_name", "last_name")


@case(
    "m16_defaults",
    """
    SELECT s_suppkey, 3 AS experience_years, CASE WHEN s_acctbal >= 0 THEN 'positive' END AS standing FROM supplier
    """,
)
def m16(t: ParquetTables) -> DataFrame:
    """A column the batch lacks takes its default; an explicit NULL stays."""
    batch = t["supplier"].select("s_suppkey", F.when(F.col("s_acctbal") >= 0, "positive").alias("standing"))
    return mutate.with_defaults(batch, {"experience_years": F.lit(3), "standing": F.lit("unknown")})


@case(
    "m17_due_dates",
    """
    SELECT '2001-06-01' AS rental_date, c_custkey AS inventory_id,
           (SELECT c_custkey FROM customer WHERE c_name = 'Customer#000000005') AS customer_id,
           s.n_nationkey AS staff_id, '2001-06-08' AS return_date, '2001-06-01' AS last_update
    FROM customer JOIN nation h ON c_nationkey = h.n_nationkey JOIN nation s ON s.n_regionkey = h.n_regionkey
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
    """,
)
def m17(t: ParquetTables) -> DataFrame:
    """One rental per copy and staff member of its store, due a week later."""
    copies = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "inner").select(
        F.col("c_custkey").alias("inventory_id"), F.col("c_custkey").alias("film_id"),
        F.col("n_regionkey").alias("store_id"),
    )
    film = t["customer"].select(F.col("c_custkey").alias("film_id"), F.col("c_mktsegment").alias("title"))
    staff = t["nation"].select(F.col("n_nationkey").alias("staff_id"), F.col("n_regionkey").alias("store_id"))
    renter = only_value(t["customer"].filter(F.col("c_name") == "Customer#000000005"), "c_custkey")
    return shown(rental.rent_titles(copies, film, staff, renter, ["BUILDING", "MACHINERY"], dt.date(2001, 6, 1)))


# -- validated jobs ------------------------------------------------------------


@case(
    "m11_validated_insert",
    """
    WITH film AS (SELECT min(c_custkey) AS film_id, c_mktsegment || ' ' || right(c_name, 2) AS title
                  FROM customer WHERE c_acctbal > 9000 GROUP BY 2),
    lang AS (SELECT n_nationkey AS language_id, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey
             WHERE r_name <> 'AFRICA'),
    batch AS (
      SELECT c_custkey AS seq, n_name AS language,
             CASE WHEN c_acctbal < -900 THEN '   ' WHEN c_acctbal < 0 THEN lower(c_mktsegment || ' ' || right(c_name, 2))
                  ELSE c_mktsegment || ' ' || right(c_name, 2) END AS title
      FROM customer JOIN nation ON c_nationkey = n_nationkey),
    checked AS (
      SELECT seq, b.title, language_id, trim(b.title) = '' AS blank,
             upper(b.title) IN (SELECT upper(title) FROM film) AS taken
      FROM batch b LEFT JOIN lang ON upper(lang.name) = upper(b.language)),
    judged AS (
      SELECT *, min(CASE WHEN NOT blank AND NOT taken AND language_id IS NOT NULL THEN seq END)
                  OVER (PARTITION BY upper(title)) AS first_seq FROM checked),
    decided AS (
      SELECT seq, title, CASE WHEN blank THEN 'title is empty' WHEN taken OR seq > first_seq THEN 'title exists'
                              WHEN language_id IS NULL THEN 'unknown language' ELSE 'inserted' END AS status
      FROM judged)
    SELECT seq, title, status,
           CASE WHEN status = 'inserted' THEN (SELECT coalesce(max(film_id), 0) FROM film)
             + row_number() OVER (PARTITION BY status ORDER BY seq) END AS film_id
    FROM decided
    """,
)
def m11(t: ParquetTables) -> DataFrame:
    """Titles entered one batch at a time: blank, taken, repeated or in an unknown language are refused."""
    title = F.concat("c_mktsegment", F.lit(" "), F.right(F.col("c_name"), F.lit(2)))
    film = (
        t["customer"]
        .filter(F.col("c_acctbal") > 9000)
        .groupBy(title.alias("title"))
        .agg(F.min("c_custkey").alias("film_id"))
    )
    language = t["nation"].join(
        t["region"].filter(F.col("r_name") != "AFRICA"), F.col("n_regionkey") == F.col("r_regionkey"), "left_semi"
    ).select(F.col("n_nationkey").alias("language_id"), F.col("n_name").alias("name"))
    batch = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "inner").select(
        F.col("c_custkey").alias("seq"),
        F.when(F.col("c_acctbal") < -900, "   ").when(F.col("c_acctbal") < 0, F.lower(title)).otherwise(title).alias("title"),
        F.col("n_name").alias("language"),
    )
    inserted, refused = rental.new_films(film, language, batch, dt.date(2001, 1, 1))
    return inserted.select("seq", "title", F.lit("inserted").alias("status"), "film_id").unionByName(
        refused.select("seq", "title", F.col("reason").alias("status"), F.lit(None).cast("bigint").alias("film_id"))
    )


def station_patches(t: ParquetTables) -> DataFrame:
    column = (
        F.when(F.col("o_orderstatus") == "F", "name").when(F.col("o_orderstatus") == "O", "location").otherwise("colour")
    )
    value = F.when(
        F.col("o_orderpriority") != "5-LOW", F.concat("o_orderpriority", F.lit(" "), F.col("o_orderkey").cast("string"))
    )
    return t["orders"].select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_custkey").alias("station_id"),
        column.alias("column_name"),
        value.alias("new_value"),
    )


def station_table(t: ParquetTables) -> DataFrame:
    return t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"), "inner").select(
        F.col("s_suppkey").alias("station_id"), F.col("s_name").alias("name"), F.col("n_name").alias("location")
    )


_PATCHES = """
    p AS (SELECT o_orderkey AS seq, o_custkey AS station_id,
                 CASE o_orderstatus WHEN 'F' THEN 'name' WHEN 'O' THEN 'location' ELSE 'colour' END AS column_name,
                 CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority || ' ' || o_orderkey END AS new_value
          FROM orders)"""


@case(
    "m12_patch",
    f"""
    WITH {_PATCHES}
    SELECT seq, station_id, column_name, new_value,
           CASE WHEN column_name NOT IN ('name', 'location')
                  THEN 'Error: Invalid column name. Must be one of: name, location'
                WHEN new_value IS NULL THEN 'Error: New value cannot be NULL for column ' || column_name
                WHEN station_id NOT IN (SELECT s_suppkey FROM supplier)
                  THEN 'Error: No row found with station_id = ' || station_id
                ELSE 'Success: Updated ' || column_name || ' for station_id = ' || station_id || ' to ' || new_value
           END AS status
    FROM p
    """,
)
def m12(t: ParquetTables) -> DataFrame:
    return fuel.patch_rows(station_table(t), station_patches(t))[1]


@case(
    "m12_patched_rows",
    f"""
    WITH {_PATCHES},
    last AS (SELECT station_id, column_name, arg_max(new_value, seq) AS v FROM p
             WHERE new_value IS NOT NULL AND column_name <> 'colour' GROUP BY 1, 2)
    SELECT s_suppkey AS station_id, coalesce(a.v, s_name) AS name, coalesce(b.v, n_name) AS location
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN last a ON a.station_id = s_suppkey AND a.column_name = 'name'
    LEFT JOIN last b ON b.station_id = s_suppkey AND b.column_name = 'location'
    """,
)
def m12_rows(t: ParquetTables) -> DataFrame:
    return fuel.patch_rows(station_table(t), station_patches(t))[0]


@case(
    "m13_fact_load",
    """
    WITH st AS (SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal >= 0),
    fu AS (SELECT min(p_partkey) AS id, p_type, max(CAST(p_retailprice AS DECIMAL(18,2))) AS price
           FROM part WHERE p_type <> 'SMALL' GROUP BY 2),
    cu AS (SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0)
    SELECT l_orderkey, l_linenumber, st.s_suppkey AS station_id, fu.id AS fuel_type_id, cu.c_custkey AS customer_id,
           CAST(round(CAST(l_quantity AS DECIMAL(18,2)) * fu.price, 2) AS DOUBLE) AS total_amount,
           st.s_suppkey IS NOT NULL AND fu.id IS NOT NULL AND cu.c_custkey IS NOT NULL AS inserted,
           CASE WHEN st.s_suppkey IS NULL THEN '❌ Station not found' WHEN fu.id IS NULL THEN '❌ Fuel type not found'
                WHEN cu.c_custkey IS NULL THEN '❌ Customer not found'
                ELSE '✅ Transaction inserted for ' || c.c_name || ' on ' || strftime(l_shipdate, '%Y-%m-%d') || ': '
                     || CAST(CAST(l_quantity AS DECIMAL(10,2)) AS VARCHAR) || ' L of ' || p.p_type || ' paid by '
                     || l_returnflag END AS status
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer c ON o_custkey = c.c_custkey
    JOIN supplier s ON l_suppkey = s.s_suppkey JOIN part p ON l_partkey = p.p_partkey
    LEFT JOIN st ON st.s_name = s.s_name LEFT JOIN fu ON fu.p_type = p.p_type LEFT JOIN cu ON cu.c_name = c.c_name
    """,
)
def m13(t: ParquetTables) -> DataFrame:
    """Sales that name station, fuel and customer; a third of the names is not in the dimensions."""
    incoming = (
        lines_with_orders(t)
        .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "inner")
        .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"), "inner")
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"), "inner")
        .select(
            "l_orderkey",
            "l_linenumber",
            F.col("s_name").alias("station_name"),
            F.col("p_type").alias("fuel_name"),
            F.col("c_name").alias("customer_full_name"),
            F.col("l_shipdate").alias("transaction_date"),
            F.col("l_quantity").alias("quantity_sold"),
            F.col("l_returnflag").alias("payment_method"),
        )
    )
    stations = t["supplier"].filter(F.col("s_acctbal") >= 0).select(
        F.col("s_suppkey").alias("station_id"), F.col("s_name").alias("name")
    )
    fuels = (
        t["part"]
        .filter(F.col("p_type") != "SMALL")
        .groupBy(F.col("p_type").alias("fuel_name"))
        .agg(F.min("p_partkey").alias("fuel_type_id"), F.max(money(F.col("p_retailprice"))).alias("price_per_liter"))
    )
    customers = t["customer"].filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name")
    )
    loaded = fuel.load_transactions(incoming, stations, fuels, customers)
    return shown(
        loaded.select(
            "l_orderkey", "l_linenumber", "station_id", "fuel_type_id", "customer_id", "total_amount", "inserted", "status"
        )
    )


@case(
    "m13_record_sales",
    """
    WITH fu AS (SELECT min(o_orderkey) AS id, o_orderpriority AS name FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 2),
    inc AS (
      SELECT o_orderkey AS seq, n_nationkey AS station_id, fu.id AS fuel_id, k.c_custkey AS customer_id,
             CAST(o_orderdate + INTERVAL 324 MONTH AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS q, o_orderstatus
      FROM orders JOIN customer c ON o_custkey = c.c_custkey JOIN nation ON c.c_nationkey = n_nationkey
      LEFT JOIN fu ON fu.name = o_orderpriority
      LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) k ON k.c_name = c.c_name),
    judged AS (
      SELECT *, CASE WHEN fuel_id IS NULL THEN '❌ Fuel type not found' WHEN customer_id IS NULL THEN '❌ Customer not found'
                     WHEN NOT day > DATE '2024-01-01' THEN 'transaction_date > 2024-01-01'
                     WHEN o_orderstatus = 'P' THEN 'payment_method not in list' END AS reason FROM inc),
    stock AS (SELECT station_id, fuel_id, sum(q) AS q FROM inc
              WHERE fuel_id IS NOT NULL AND o_orderstatus = 'F' GROUP BY 1, 2),
    sold AS (SELECT station_id, fuel_id, sum(q) AS q FROM judged WHERE reason IS NULL GROUP BY 1, 2),
    bad AS (SELECT stock.station_id, stock.fuel_id FROM stock JOIN sold ON stock.station_id = sold.station_id
            AND stock.fuel_id = sold.fuel_id WHERE sold.q > stock.q),
    final AS (
      SELECT judged.*, CASE WHEN reason IS NOT NULL THEN reason
                            WHEN bad.fuel_id IS NOT NULL THEN 'stock would fall below zero' END AS verdict
      FROM judged LEFT JOIN bad ON bad.station_id = judged.station_id AND bad.fuel_id = judged.fuel_id)
    SELECT CASE WHEN verdict IS NULL THEN (SELECT max(o_orderkey) FROM orders)
             + row_number() OVER (PARTITION BY verdict IS NULL ORDER BY seq) ELSE seq END AS id,
           coalesce(verdict, 'recorded') AS result,
           CASE WHEN verdict IS NULL THEN CAST(round(q * 1.50, 2) AS DOUBLE) END AS total_amount
    FROM final
    """,
)
def m13_record(t: ParquetTables) -> DataFrame:
    """Orders, moved to the twenties, through the whole write path: names, amounts, rules, balance, keys."""
    named = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "inner").join(
        t["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "inner"
    )
    status = F.col("o_orderstatus")
    incoming = named.select(
        F.col("o_orderkey").alias("seq"),
        F.col("n_name").alias("station_name"),
        F.col("o_orderpriority").alias("fuel_name"),
        F.col("c_name").alias("customer_full_name"),
        F.add_months("o_orderdate", 324).alias("transaction_date"),
        money(F.col("o_totalprice")).alias("quantity_sold"),
        F.when(status == "F", "cash").when(status == "O", "card").otherwise("cheque").alias("payment_method"),
    )
    stations = t["nation"].select(F.col("n_nationkey").alias("station_id"), F.col("n_name").alias("name"))
    fuels = (
        t["orders"]
        .filter(F.col("o_orderpriority") != "5-LOW")
        .groupBy(F.col("o_orderpriority").alias("fuel_name"))
        .agg(F.min("o_orderkey").alias("fuel_type_id"))
        .withColumn("price_per_liter", F.lit("1.50").cast("decimal(10,2)"))
    )
    customers = t["customer"].filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name")
    )
    stock = (
        named.filter(status == "F")
        .join(fuels, F.col("o_orderpriority") == F.col("fuel_name"), "inner")
        .groupBy(F.col("n_nationkey").alias("station_id"), "fuel_type_id")
        .agg(F.sum(money(F.col("o_totalprice"))).alias("quantity_available"))
    )
    existing = t["orders"].select(
        F.col("o_orderkey").alias("transaction_id"),
        *[
            F.lit(None).cast(kind).alias(name)
            for name, kind in (
                ("station_id", "int"),
                ("fuel_type_id", "bigint"),
                ("customer_id", "bigint"),
                ("transaction_date", "date"),
                ("quantity_sold", "decimal(18,2)"),
                ("payment_method", "string"),
                ("total_amount", "decimal(18,2)"),
            )
        ],
    )
    new, refused, _ = fuel.record_sales(incoming, stations, fuels, customers, existing, stock, reject="key")
    return shown(
        new.select(F.col("transaction_id").alias("id"), F.lit("recorded").alias("result"), "total_amount").unionByName(
            refused.select(F.col("seq").alias("id"), F.col("reason").alias("result")), allowMissingColumns=True
        )
    )


# -- incoming facts ------------------------------------------------------------


@case(
    "t1_price_enrich",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS DOUBLE) AS quantity,
           CAST(round(CAST(l_quantity AS DECIMAL(18,2)) * CAST(p_retailprice AS DECIMAL(18,2)), 2) AS DOUBLE)
             AS total_amount,
           CASE WHEN p_partkey IS NULL THEN 'price not found' END AS reason
    FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 45) ON l_partkey = p_partkey
    """,
)
def t1(t: ParquetTables) -> DataFrame:
    """Every line gets quantity times price, whatever amount it brought; large parts have no price."""
    facts = t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
    )
    prices = t["part"].filter(F.col("p_size") <= 45).select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").alias("price")
    )
    priced = ingest.price_facts(facts, prices, "l_partkey")
    accepted, rejected = ingest.split_rejects(
        priced, ingest.first_failure((F.col("total_amount").isNull(), "price not found"))
    )
    both = accepted.withColumn("reason", F.lit(None).cast("string")).unionByName(rejected)
    return shown(both.select("l_orderkey", "l_linenumber", "l_partkey", "quantity", "total_amount", "reason"))


def _stock_and_sales(t: ParquetTables) -> tuple[DataFrame, DataFrame]:
    turn = F.lit(dt.date(2001, 1, 1))
    lines = t["lineitem"].select("l_suppkey", "l_partkey", F.col("l_quantity").alias("quantity"), "l_shipdate")
    stock = (
        lines.filter(F.col("l_shipdate") < turn)
        .groupBy("l_suppkey", "l_partkey")
        .agg((2 * F.sum(F.col("quantity").cast("decimal(18,2)"))).alias("quantity_available"))
    )
    return stock, lines.filter(F.col("l_shipdate") >= turn)


@case(
    "t2_stock_fold",
    """
    WITH st AS (SELECT l_suppkey, l_partkey, 2 * sum(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem
                WHERE l_shipdate < DATE '2001-01-01' GROUP BY 1, 2),
    sold AS (SELECT l_suppkey, l_partkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS s FROM lineitem
             WHERE l_shipdate >= DATE '2001-01-01' GROUP BY 1, 2)
    SELECT st.l_suppkey, st.l_partkey, CAST(q - coalesce(s, 0) AS DOUBLE) AS quantity_available
    FROM st LEFT JOIN sold ON st.l_suppkey = sold.l_suppkey AND st.l_partkey = sold.l_partkey
    """,
)
def t2(t: ParquetTables) -> DataFrame:
    """Stock of supplier and part after the sales of 2001; a sale without stock changes nothing."""
    stock, sales = _stock_and_sales(t)
    return shown(ingest.fold_stock(stock, sales, ["l_suppkey", "l_partkey"]))


_BALANCE = """
    st AS (SELECT l_partkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
    sold AS (SELECT l_partkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS s FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1),
    bad AS (SELECT st.l_partkey, q - s AS b FROM st JOIN sold ON st.l_partkey = sold.l_partkey WHERE q - s < 0)"""


def _balance_inputs(t: ParquetTables) -> tuple[DataFrame, DataFrame]:
    quantity = F.col("l_quantity").cast("decimal(18,2)")
    stock = (
        t["lineitem"].filter(F.col("l_returnflag") == "R").groupBy("l_partkey").agg(F.sum(quantity).alias("quantity_available"))
    )
    facts = t["lineitem"].filter(F.col("l_returnflag") == "N").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("quantity")
    )
    return stock, facts


@case("q10_balance", f"WITH {_BALANCE} SELECT l_partkey, CAST(b AS DOUBLE) AS quantity_available FROM bad")
def q10(t: ParquetTables) -> DataFrame:
    """Parts whose balance would fall below zero."""
    stock, facts = _balance_inputs(t)
    return shown(ingest.overdrawn(ingest.fold_stock(stock, facts, ["l_partkey"])))


@case(
    "q10_accept_by_key",
    f"""
    WITH {_BALANCE}
    SELECT l_orderkey, l_linenumber, l_partkey, l_partkey NOT IN (SELECT l_partkey FROM bad) AS accepted
    FROM lineitem WHERE l_returnflag = 'N'
    """,
)
def q10_key(t: ParquetTables) -> DataFrame:
    stock, facts = _balance_inputs(t)
    judged = ingest.accept_batch(stock, facts, ["l_partkey"], reject="key")
    return judged.select("l_orderkey", "l_linenumber", "l_partkey", "accepted")


@case(
    "q10_accept_batch",
    f"""
    WITH {_BALANCE}
    SELECT (SELECT count(*) FROM bad) = 0 AS accepted, count(*) AS n FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1
    """,
)
def q10_batch(t: ParquetTables) -> DataFrame:
    """One overdrawn part refuses the whole batch."""
    stock, facts = _balance_inputs(t)
    judged = ingest.accept_batch(stock, facts, ["l_partkey"])
    return judged.groupBy("accepted").agg(F.count(F.lit(1)).alias("n"))


_ROWS = """
    st AS (SELECT l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) / 4 AS DECIMAL(18,2)) AS b FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
    n AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS DECIMAL(18,2)) AS q,
          row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_quantity) AS i FROM lineitem WHERE l_returnflag = 'N'),
    f AS (
      SELECT n.*, b IS NULL OR q <= b AS accepted, CASE WHEN q <= b THEN b - q ELSE b END AS b FROM n LEFT JOIN st USING (l_partkey) WHERE i = 1
      UNION ALL
      SELECT n.*, f.b IS NULL OR n.q <= f.b, CASE WHEN n.q <= f.b THEN f.b - n.q ELSE f.b END
      FROM n JOIN f ON n.l_partkey = f.l_partkey AND n.i = f.i + 1)"""


def _row_inputs(t: ParquetTables) -> tuple[DataFrame, DataFrame]:
    """A quarter of what came back is in stock, so that many parts run short."""
    stock, facts = _balance_inputs(t)
    return stock.withColumn("quantity_available", (F.col("quantity_available") / 4).cast("decimal(18,2)")), facts


@case("q10_accept_rows", f"WITH RECURSIVE {_ROWS} SELECT l_orderkey, l_linenumber, l_partkey, accepted FROM f")
def q10_rows(t: ParquetTables) -> DataFrame:
    """Each sale by itself: refused if the part's stock does not cover it, and then taking nothing."""
    stock, facts = _row_inputs(t)
    judged = ingest.accept_rows(stock, facts, ["l_partkey"], ["l_orderkey", "l_linenumber"])
    return judged.select("l_orderkey", "l_linenumber", "l_partkey", "accepted")


@case(
    "q10_accept_rows_large",
    """
    WITH RECURSIVE st AS (SELECT l_suppkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) / 4 AS DECIMAL(18,2)) AS b FROM lineitem GROUP BY 1),
    n AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)) AS q,
          row_number() OVER (PARTITION BY l_suppkey ORDER BY l_linenumber, l_orderkey, l_quantity) AS i FROM lineitem),
    f AS (
      SELECT n.l_suppkey, n.i, q <= b AS accepted, CASE WHEN q <= b THEN b - q ELSE b END AS b, l_orderkey, l_linenumber FROM n JOIN st USING (l_suppkey) WHERE i = 1
      UNION ALL
      SELECT n.l_suppkey, n.i, n.q <= f.b, CASE WHEN n.q <= f.b THEN f.b - n.q ELSE f.b END, n.l_orderkey, n.l_linenumber
      FROM f JOIN n ON n.l_suppkey = f.l_suppkey AND n.i = f.i + 1)
    SELECT l_orderkey, l_linenumber, l_suppkey, accepted FROM f
    """,
)
def q10_rows_large(t: ParquetTables) -> DataFrame:
    """The same with few keys: most suppliers have more sales than one task is given to fold."""
    quantity = F.col("l_quantity").cast("decimal(18,2)")
    sales = t["lineitem"].select("l_orderkey", "l_linenumber", "l_suppkey", quantity.alias("quantity"))
    stock = sales.groupBy("l_suppkey").agg((F.sum("quantity") / 4).cast("decimal(18,2)").alias("quantity_available"))
    judged = ingest.accept_rows(stock, sales, ["l_suppkey"], ["l_linenumber", "l_orderkey"], fold_rows=300)
    return judged.select("l_orderkey", "l_linenumber", "l_suppkey", "accepted")


# -- visibility ----------------------------------------------------------------


def entitlements(t: ParquetTables) -> DataFrame:
    return t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"), "inner").select(
        F.concat(F.lit("client_"), F.lower("n_name")).alias("user_name"), F.col("c_custkey").alias("customer_id")
    )


@case(
    "v1_row_filter",
    """
    SELECT o_custkey AS customer_id, o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey
                        WHERE 'client_' || lower(n_name) = 'client_nation_3')
    """,
)
def v1(t: ParquetTables) -> DataFrame:
    orders = t["orders"].select(F.col("o_custkey").alias("customer_id"), "o_orderkey", "o_totalprice")
    return visible_rows(orders, entitlements(t), "client_nation_3")


@case(
    "v1_all_users",
    """
    SELECT 'client_' || lower(n_name) AS user_name, count(*) AS n_rows
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
    """,
)
def v1_all(t: ParquetTables) -> DataFrame:
    orders = t["orders"].select(F.col("o_custkey").alias("customer_id"), "o_orderkey")
    return rows_per_user(orders, entitlements(t)).groupBy("user_name").agg(F.count(F.lit(1)).alias("n_rows"))
