"""Integrity rules on the driver's tables. The rules are chosen so that part of the rows break them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import quality as q
from ledgerline.operators.lookup import only_value
from ledgerline.sources.footprint import footprint
from ledgerline.sources.tables import ParquetTables
from ledgerline.testbed.rental_cases import ALL_TABLES
from ledgerline.testbed.registry import case


def customers_with_gaps(t: ParquetTables) -> DataFrame:
    """Customers without a segment where it is FURNITURE and without a balance where it is above 9000."""
    return t["customer"].withColumns(
        {
            "c_mktsegment": F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")),
            "c_acctbal": F.when(F.col("c_acctbal") <= 9000, F.col("c_acctbal")),
        }
    )


def _row_sql(table: str, rule: str, key: str, reason: str, source: str, where: str) -> str:
    return f"""
    SELECT '{table}' AS table_name, '{rule}' AS rule, {key} AS key, '{reason}' AS reason, CAST(1 AS BIGINT) AS n_rows
    FROM {source} WHERE {where}
    """


_GAPS = """(SELECT c_custkey, c_name, c_nationkey, nullif(c_mktsegment, 'FURNITURE') AS c_mktsegment,
                   CASE WHEN c_acctbal <= 9000 THEN c_acctbal END AS c_acctbal FROM customer)"""
_CUSTKEY = "CAST(c_custkey AS VARCHAR)"


@case(
    "q01_not_null",
    _row_sql("customer", "not_null", _CUSTKEY, "c_mktsegment is null", _GAPS, "c_mktsegment IS NULL"),
)
def q01(t: ParquetTables) -> DataFrame:
    return q.row_violations("customer", customers_with_gaps(t), ["c_custkey"], [q.not_null("c_mktsegment")])


@case(
    "q02_range",
    _row_sql("customer", "check", _CUSTKEY, "c_acctbal >= 0", _GAPS, "c_acctbal < 0")
    + " UNION ALL "
    + _row_sql(
        "orders", "check", "CAST(o_orderkey AS VARCHAR)", "o_orderdate > 1995-06-30", "orders",
        "NOT o_orderdate > DATE '1995-06-30'",
    ),
)
def q02(t: ParquetTables) -> DataFrame:
    """Sign and date checks; an unknown balance passes."""
    balance = q.check("c_acctbal >= 0", F.col("c_acctbal") >= 0)
    day = q.check("o_orderdate > 1995-06-30", F.col("o_orderdate") > F.lit(dt.date(1995, 6, 30)))
    return q.row_violations("customer", customers_with_gaps(t), ["c_custkey"], [balance]).unionByName(
        q.row_violations("orders", t["orders"], ["o_orderkey"], [day])
    )


@case(
    "q03_domain",
    _row_sql(
        "customer", "domain", _CUSTKEY, "c_mktsegment not in list", _GAPS,
        "c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')",
    ),
)
def q03(t: ParquetTables) -> DataFrame:
    rule = q.one_of("c_mktsegment", ["BUILDING", "MACHINERY", "HOUSEHOLD"])
    return q.row_violations("customer", customers_with_gaps(t), ["c_custkey"], [rule])


def _lines_with_gaps(t: ParquetTables) -> DataFrame:
    return t["lineitem"].withColumn("l_linenumber", F.nullif(F.col("l_linenumber"), F.lit(1)))


_LINES = "(SELECT l_orderkey, nullif(l_linenumber, 1) AS l_linenumber FROM lineitem)"


def _duplicates_sql(rule: str) -> str:
    return f"""
    SELECT 'lineitem' AS table_name, '{rule}' AS rule, l_orderkey || '|' || l_linenumber AS key,
           'duplicate l_orderkey, l_linenumber' AS reason, count(*) AS n_rows
    FROM {_LINES} WHERE l_linenumber IS NOT NULL
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """


@case("q04_unique", _duplicates_sql("unique"))
def q04(t: ParquetTables) -> DataFrame:
    """Repeated line keys; a line without a number never conflicts."""
    return q.unique_violations("lineitem", _lines_with_gaps(t), ["l_orderkey", "l_linenumber"])


@case(
    "q05_primary_key",
    _duplicates_sql("primary_key")
    + " UNION ALL "
    + _row_sql(
        "lineitem", "primary_key", "l_orderkey || '|NULL'", "l_linenumber is null", _LINES, "l_linenumber IS NULL"
    ),
)
def q05(t: ParquetTables) -> DataFrame:
    return q.primary_key_violations("lineitem", _lines_with_gaps(t), ["l_orderkey", "l_linenumber"])


@case(
    "q06_foreign_key",
    """
    SELECT 'orders' AS table_name, 'foreign_key' AS rule, CAST(o_custkey AS VARCHAR) AS key,
           'no customer row for o_custkey' AS reason, count(*) AS n_rows
    FROM orders WHERE o_orderpriority <> '5-LOW' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
    GROUP BY o_custkey
    """,
)
def q06(t: ParquetTables) -> DataFrame:
    """Orders against the customers in credit; an order without a customer (5-LOW) passes."""
    orders = t["orders"].withColumn("o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")))
    parent = t["customer"].filter(F.col("c_acctbal") >= 0)
    return q.foreign_key_violations("orders", orders, ["o_custkey"], parent, ["c_custkey"], "customer")


@case(
    "q07_length",
    _row_sql("part", "length", "CAST(p_partkey AS VARCHAR)", "p_name longer than 9", "part", "length(p_name) > 9"),
)
def q07(t: ParquetTables) -> DataFrame:
    return q.row_violations("part", t["part"], ["p_partkey"], [q.max_length("p_name", 9)])


@case(
    "q08_precision",
    _row_sql(
        "orders", "precision", "CAST(o_orderkey AS VARCHAR)", "o_totalprice exceeds decimal(7,2)", "orders",
        "TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL",
    ),
)
def q08(t: ParquetTables) -> DataFrame:
    return q.row_violations("orders", t["orders"], ["o_orderkey"], [q.fits_decimal("o_totalprice", 7, 2)])


@case(
    "q09_row_counts",
    " UNION ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in ALL_TABLES),
)
def q09(t: ParquetTables) -> DataFrame:
    return q.row_counts({n: t[n] for n in ALL_TABLES})


@case(
    "q_all_rules",
    f"""
    SELECT table_name, rule, reason, CAST(sum(n_rows) AS BIGINT) AS n_rows, count(*) AS n_violations FROM (
      {_row_sql("customer", "not_null", _CUSTKEY, "c_mktsegment is null", _GAPS, "c_mktsegment IS NULL")}
      UNION ALL {_row_sql("customer", "check", _CUSTKEY, "c_acctbal >= 0", _GAPS, "c_acctbal < 0")}
      UNION ALL {_row_sql("customer", "domain", _CUSTKEY, "c_mktsegment not in list", _GAPS,
                          "c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')")}
      UNION ALL SELECT 'customer', 'unique', c_mktsegment || '|' || c_nationkey, 'duplicate c_mktsegment, c_nationkey',
                       count(*) FROM {_GAPS} WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment, c_nationkey
                       HAVING count(*) > 1
      UNION ALL SELECT 'orders', 'foreign_key', CAST(o_custkey AS VARCHAR), 'no customer row for o_custkey', count(*)
                FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey)
    GROUP BY 1, 2, 3
    """,
)
def q_all(t: ParquetTables) -> DataFrame:
    """Several rules of a small model in one report."""
    rules = {
        "customer": q.TableRules(
            ("c_custkey",),
            (
                q.not_null("c_mktsegment"),
                q.check("c_acctbal >= 0", F.col("c_acctbal") >= 0),
                q.one_of("c_mktsegment", ["BUILDING", "MACHINERY", "HOUSEHOLD"]),
            ),
            unique=(q.Unique(("c_mktsegment", "c_nationkey")),),
        ),
        "orders": q.TableRules(
            ("o_orderkey",), foreign=(q.ForeignKey(("o_custkey",), "customer", ("c_custkey",)),)
        ),
    }
    found = q.violations(t.spark, {"customer": customers_with_gaps(t), "orders": t["orders"]}, rules)
    return found.groupBy("table_name", "rule", "reason").agg(
        F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_violations")
    )


@case(
    "s14_footprint_rows",
    """
    SELECT 'orders' AS table_name, CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'customer', CAST(1 AS BIGINT), count(*) FROM customer
    """,
)
def s14_rows(t: ParquetTables) -> DataFrame:
    """The comparable part of the storage report, for table names that match ``%er%s%`` or ``%er``."""
    tables = {n: t[n] for n in ("orders", "customer", "part")}
    both = footprint(tables, "%er").unionByName(footprint(tables, "%ders%"))
    return both.select("table_name", "n_files", "n_rows")


@case(
    "p20_scalar_subquery",
    """
    SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders
    WHERE o_totalprice > (SELECT max(c_acctbal) * 45 FROM customer)
    """,
)
def p20(t: ParquetTables) -> DataFrame:
    """Orders above a figure taken from another table."""
    bound = only_value(t["customer"].agg((F.max("c_acctbal") * 45).alias("bound")), "bound")
    return t["orders"].filter(F.col("o_totalprice") > bound).select("o_orderkey", "o_totalprice")
