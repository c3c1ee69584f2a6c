"""The driver's tables in the roles the reports expect.

orders or lineitem is the sales fact, order priority the channel, customer -
nation - region the geography, part the product or film, supplier the actor,
staff member, store or station.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numbers import money
from ledgerline.sources.tables import ParquetTables


def geography(t: ParquetTables) -> DataFrame:
    """``n_nationkey, n_name, country_region``."""
    regions = t["region"].select("r_regionkey", F.col("r_name").alias("country_region"))
    return t["nation"].join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "inner").select(
        "n_nationkey", "n_name", "country_region"
    )


def order_lines(t: ParquetTables) -> DataFrame:
    """One sales line per order, with channel and customer."""
    customers = t["customer"].select(
        "c_custkey", "c_nationkey", F.col("c_mktsegment").alias("cust_first_name"), F.col("c_name").alias("cust_last_name")
    )
    return (
        t["orders"]
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "inner")
        .join(geography(t), F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .select(
            F.col("o_orderdate").alias("time_id"),
            money(F.col("o_totalprice")).alias("amount_sold"),
            F.col("o_custkey").alias("cust_id"),
            "cust_first_name",
            "cust_last_name",
            F.col("o_orderpriority").alias("channel_desc"),
            "country_region",
        )
    )


def customer_lines(t: ParquetTables) -> DataFrame:
    """As ``order_lines`` without the geography, for reports that do not ask for a region."""
    customers = t["customer"].select(
        "c_custkey", F.col("c_mktsegment").alias("cust_first_name"), F.col("c_name").alias("cust_last_name")
    )
    return (
        t["orders"]
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "inner")
        .select(
            F.col("o_orderdate").alias("time_id"),
            money(F.col("o_totalprice")).alias("amount_sold"),
            F.col("o_custkey").alias("cust_id"),
            "cust_first_name",
            "cust_last_name",
            F.col("o_orderpriority").alias("channel_desc"),
        )
    )


def dated_orders(t: ParquetTables) -> DataFrame:
    """Date and amount only, for the daily reports."""
    return t["orders"].select(
        F.col("o_orderdate").alias("time_id"), money(F.col("o_totalprice")).alias("amount_sold")
    )


def item_lines(t: ParquetTables) -> DataFrame:
    """One sales line per line item, with product and region."""
    buyers = t["customer"].select("c_custkey", "c_nationkey").join(
        geography(t), F.col("c_nationkey") == F.col("n_nationkey"), "inner"
    )
    products = t["part"].select(
        "p_partkey", F.col("p_name").alias("prod_name"), F.col("p_type").alias("prod_category")
    )
    return (
        t["lineitem"]
        .join(products, F.col("l_partkey") == F.col("p_partkey"), "inner")
        .join(t["orders"].select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"), "inner")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"), "inner")
        .select(
            F.col("l_shipdate").alias("time_id"),
            money(F.col("l_extendedprice")).alias("amount_sold"),
            "prod_name",
            "prod_category",
            "country_region",
        )
    )
