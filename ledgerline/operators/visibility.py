"""Row visibility by owner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.lookup import present


def visible_rows(rows: DataFrame, entitlements: DataFrame, user: str, owner: str = "customer_id") -> DataFrame:
    """Rows whose owner ``user`` may see."""
    mine = entitlements.filter(F.col("user_name") == user).select(owner)
    return present(rows, mine, [owner]).select(*rows.columns)


def rows_per_user(rows: DataFrame, entitlements: DataFrame, owner: str = "customer_id") -> DataFrame:
    """All users at once: each row appears for every user who may see it."""
    return rows.join(entitlements.select("user_name", owner).distinct(), owner, "inner")


def entitle(customers: DataFrame, first_name: str, last_name: str) -> DataFrame:
    """The client entitlement for a customer found by name: the smallest id if several share it."""
    found = customers.filter((F.col("first_name") == first_name) & (F.col("last_name") == last_name))
    user = f"client_{first_name.lower()}_{last_name.lower()}"
    one = found.agg(F.min("customer_id").alias("customer_id")).filter(F.col("customer_id").isNotNull())
    return one.select(F.lit(user).alias("user_name"), "customer_id")
