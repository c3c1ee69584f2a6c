"""The shape of the physical plans: what reaches the scan, what is shuffled, what never appears."""

import datetime as dt
import os
import re
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerline.testbed import load_cases  # noqa: E402
from ledgerline.operators import lookup, windows  # noqa: E402
from ledgerline.operators.ordering import ascending  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES = load_cases()[0]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(autouse=True)
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text, table):
    return re.findall(rf"FileScan parquet \[([^\]]*)\].*?/{table}\.parquet.*?PushedFilters: \[(.*?)\], ReadSchema", text)


def plan_without_broadcast(spark, name):
    """As on tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(QUERIES[name](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_or_cartesian_product_or_python(spark, name):
    """Also with large inputs no plan compares every row with every row, and none runs Python, but for the reader of footers."""
    text = re.sub(r"BatchScan parquet_footers.*", "", plan_without_broadcast(spark, name))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "MapInArrow"):
        assert bad not in text, text


@pytest.mark.parametrize(
    "name, table, column",
    [
        ("r01_channel_share", "orders", "o_orderdate"),
        ("r02_centered_avg", "orders", "o_orderdate"),
        ("r03_rows", "orders", "o_orderdate"),
        ("r07_quarter_pivot", "lineitem", "l_shipdate"),
        ("r09_month_region", "lineitem", "l_shipdate"),
        ("r11_address_revenue", "lineitem", "l_shipdate"),
        ("r14_top3_staff_store", "lineitem", "l_shipdate"),
        ("r17_quarter_revenue", "lineitem", "l_shipdate"),
        ("r20_prev_quarter", "lineitem", "l_shipdate"),
    ],
)
def test_date_range_reaches_the_scan(spark, name, table, column):
    found = scans(plan(QUERIES[name](spark, FOLDER)), table)
    assert found
    assert any(f"GreaterThanOrEqual({column}" in pushed for _, pushed in found), found


@pytest.mark.parametrize(
    "name, table, width",
    [("r01_channel_share", "orders", 4), ("r15_top5_label", "lineitem", 1), ("r06_top5_share", "orders", 3), ("r23_heavy_customers", "lineitem", 2)],
)
def test_only_used_columns_are_read(spark, name, table, width):
    found = scans(plan(QUERIES[name](spark, FOLDER)), table)
    assert found and all(len(columns.split(",")) <= width for columns, _ in found), found


@pytest.mark.parametrize("name", ["r06_top5_share", "r08_top300", "r18_popular_by_nation", "w05_row_number", "k05_any_one"])
def test_top_n_is_cut_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("name", ["r12_top5_suppliers", "r15_top5_label", "k03_top_k", "r27_latest"])
def test_top_k_needs_no_global_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, FOLDER))


def test_random_pick_keeps_one_row_a_task(spark):
    text = plan(QUERIES["k06_random_pick"](spark, FOLDER))
    assert "partial_min_by" in text and "TakeOrdered" not in text and "Exchange rangepartitioning" not in text


def single_partition_inputs(text):
    """The line below each exchange to one partition."""
    lines = text.splitlines()
    return [lines[i + 1] for i, line in enumerate(lines) if "Exchange SinglePartition" in line]


@pytest.mark.parametrize("name", ["w07_rows_all_orders", "w08_range_all_orders", "w09_groups_all_orders", "m09_keys"])
def test_whole_table_totals_send_only_aggregates_to_one_task(spark, name):
    inputs = single_partition_inputs(plan(QUERIES[name](spark, FOLDER)))
    assert inputs or name == "w08_range_all_orders"
    assert all("HashAggregate" in line for line in inputs), inputs


def test_running_total_shuffles_the_rows_once(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    df = windows.running_total(
        orders, F.col("o_totalprice"), ascending("o_orderkey"), {"b": F.floor(F.col("o_orderkey") / 100)}
    )
    text = plan(df)
    wide = [s for s in scans(text, "orders") if "o_orderpriority" in s[0]]
    assert len(wide) == 1
    assert "SortMergeJoin" not in text and text.count("Window [") == 2


def test_not_in_is_an_equi_join_even_without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.read.parquet(f"{FOLDER}/orders.parquet")
        b = spark.read.parquet(f"{FOLDER}/customer.parquet").filter(F.col("c_acctbal") > 0)
        text = plan(lookup.not_in(a, "o_custkey", b, "c_custkey"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "LeftAnti" in text and "SortMergeJoin" in text


def test_row_rules_share_one_scan(spark):
    from ledgerline.operators import quality as q

    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    rules = [q.not_null("o_custkey"), q.max_length("o_orderstatus", 1), q.check("d", F.col("o_orderdate") > F.lit(dt.date(1996, 1, 1)))]
    text = plan(q.row_violations("orders", orders, ["o_orderkey"], rules))
    assert text.count("FileScan") == 1 and "Exchange" not in text
