import datetime as dt
from decimal import Decimal

import pytest
from conftest import row_set, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators import windows
from ledgerline.operators.ordering import (
    ascending,
    descending,
    first_per_key,
    random_pick,
    top_k,
    top_n_per_group,
    top_rank_per_group,
)
from ledgerline.plans import sales

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
BOUND = st.one_of(st.none(), st.integers(-3, 3))


@pytest.fixture
def many_ranges(spark):
    """Small data would be joined into one range."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def day_frame(frame, values, start=dt.date(2024, 1, 1)):
    """Days from a Monday on, one value each."""
    data = [
        (start + dt.timedelta(days=i), (start + dt.timedelta(days=i)).strftime("%A"), Decimal(v))
        for i, v in enumerate(values)
    ]
    return frame("time_id date, day_name string, sales decimal(18,2)", *data)


def test_three_frames_on_ties(frame):
    df = frame("k int, v decimal(18,2)", (10, Decimal(10)), (10, Decimal(10)), (30, Decimal(30)))
    by_rows = windows.daily_running_total(df, "v", "k", "t").orderBy("t")
    by_range = windows.daily_range_total(df, "v", "k", "t").orderBy("t")
    by_groups = windows.groups_frame(df, F.col("v"), "k", "t").orderBy("t")
    assert [int(r.t) for r in by_rows.collect()] == [10, 20, 50]
    assert [int(r.t) for r in by_range.collect()] == [20, 20, 50]
    assert [int(r.t) for r in by_groups.collect()] == [20, 20, 50]


def brute_groups(data, lower, upper):
    keys = sorted({k for k, _ in data}, key=lambda k: (k is None, k))
    result = []
    for k, v in data:
        i = keys.index(k)
        lo = 0 if lower is None else max(0, i + lower)
        hi = len(keys) - 1 if upper is None else min(len(keys) - 1, i + upper)
        inside = [w for key, w in data if key in keys[lo : hi + 1]] if lo <= hi else []
        result.append((k, v, sum(inside) if inside else None))
    return sorted(result, key=str)


@SLOW
@given(
    data=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(-9, 9)), min_size=1, max_size=12),
    bounds=st.tuples(BOUND, BOUND).filter(lambda b: None in b or b[0] <= b[1]),
)
def test_groups_frame_against_brute_force(spark, data, bounds):
    df = spark.createDataFrame(data, "k int, v int")
    got = windows.groups_frame(df, F.col("v"), "k", "t", *bounds, value_type="bigint")
    assert sorted(rows(got, "k", "v", "t"), key=str) == brute_groups(data, *bounds)
    buckets = {"b": F.floor(F.col("k") / 2)}
    large = windows.large_groups_frame(df, F.col("v"), "k", "t", *bounds, value_type="bigint", buckets=buckets)
    assert sorted(rows(large, "k", "v", "t"), key=str) == brute_groups(data, *bounds)


def test_large_groups_frame_per_partition_and_with_null_values(spark, many_ranges):
    data = [("a", 1, 1), ("a", 1, None), ("a", 2, None), ("a", 5, 4), ("b", 2, 7), (None, 3, 8), ("a", None, 9)]
    df = spark.createDataFrame(data, "p string, k int, v int")
    for bounds in ((None, 0), (-1, 1), (1, 2), (-3, -1), (0, 0), (None, None), (2, None)):
        plain = windows.groups_frame(df, F.col("v"), "k", "t", *bounds, ["p"], "bigint")
        large = windows.large_groups_frame(df, F.col("v"), "k", "t", *bounds, ["p"], "bigint", {"b": F.floor(F.col("k") / 2)})
        sampled = windows.large_groups_frame(df, F.col("v"), "k", "t", *bounds, ["p"], "bigint")
        assert row_set(plain) == row_set(large) == row_set(sampled), bounds


@SLOW
@given(data=st.lists(st.tuples(st.integers(0, 40), st.integers(-9, 9)), min_size=1, max_size=40, unique_by=lambda r: r[0]))
def test_running_total_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, v int")
    buckets = {"b1": F.floor(F.col("k") / 20), "b2": F.floor(F.col("k") / 5)}
    got = windows.running_total(df, F.col("v"), ascending("k"), buckets, value_type="bigint")
    want, total = [], 0
    for k, v in sorted(data):
        total += v
        want.append((k, v, total))
    assert sorted(rows(got)) == want


def test_sampled_ranges_cut_a_hot_key(spark, many_ranges):
    df = spark.range(900).select(F.when(F.col("id") < 600, 7).otherwise(F.col("id")).alias("k"))
    sizes = windows.range_buckets(df, ascending("k")).groupBy("__range").count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 450


def test_running_total_over_sampled_ranges_with_a_hot_key(spark, many_ranges):
    """Two thirds of the rows share one key; the tie-break cuts them, and nothing is lost."""
    df = spark.range(900).select(F.when(F.col("id") < 600, 7).otherwise(F.col("id")).alias("k"), F.lit(1).alias("v"))
    got = windows.running_total(df, F.col("v"), ascending("k"), None, "n", value_type="bigint")
    assert sorted(r.n for r in got.collect()) == list(range(1, 901))
    last_hot = got.filter("k = 7").agg(F.max("n")).first()[0]
    assert last_hot == 600
    assert "__tie" not in got.columns and "__range" not in got.columns


def test_running_total_with_partitions_and_null_buckets(frame):
    df = frame("p string, k int, v int", ("a", 1, 1), ("a", None, 2), ("b", 5, 3), ("a", 30, 4))
    got = windows.running_total(
        df, F.col("v"), ascending("k"), {"b": F.floor(F.col("k") / 10)}, "t", ["p"], "bigint"
    )
    assert row_set(got) == [("a", 1, 1, 1), ("a", 30, 4, 5), ("a", None, 2, 7), ("b", 5, 3, 3)]


@pytest.mark.parametrize("buckets", [None, {"b": F.lit}])
def test_number_rows_starts_after(frame, buckets):
    df = frame("k int", (3,), (1,), (2,))
    levels = None if buckets is None else {"b": F.floor(F.col("k") / 2)}
    got = windows.number_rows(df, ascending("k"), levels, "n", 10)
    assert sorted(rows(got)) == [(1, 11), (2, 12), (3, 13)]


def test_running_groups_total_equals_groups_frame(spark):
    df = spark.range(200).select(F.pmod(F.xxhash64("id"), F.lit(17)).alias("k"), F.col("id").alias("v"))
    a = windows.groups_frame(df, F.col("v"), "k", "t", value_type="bigint")
    b = windows.running_groups_total(df, F.col("v"), "k", "t", {"b": F.floor(F.col("k") / 4)}, value_type="bigint")
    assert sorted(rows(a, "v", "t")) == sorted(rows(b, "v", "t"))


def test_rows_equals_range_on_a_unique_key(spark):
    df = spark.range(50).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 3)
    a = windows.daily_running_total(df, "v", "k", "t")
    b = windows.daily_range_total(df, "v", "k", "t")
    assert sorted(rows(a)) == sorted(rows(b))


def test_weekday_centered_average(frame):
    days = day_frame(frame, [10] * 7)
    average = windows.weekday_centered_average("sales", "time_id", "day_name")
    got = [float(r[0]) for r in rows(days.orderBy("time_id").select(average))]
    assert got == [5.0, 10.0, 10.0, 10.0, 10.0, 10.0, 6.67]


def test_top_n_keeps_a_definite_row_and_rank_keeps_ties(frame):
    df = frame("g string, k int, v int", ("a", 1, 5), ("a", 2, 5), ("a", 3, 1), ("b", 4, 2))
    one = top_n_per_group(df, ["g"], [*descending("v"), *ascending("k")], 1)
    assert row_set(one, "g", "k") == [("a", 1), ("b", 4)]
    ties = top_rank_per_group(df, ["g"], descending("v"), 1)
    assert row_set(ties, "g", "k") == [("a", 1), ("a", 2), ("b", 4)]
    assert row_set(first_per_key(df, ["g"], ascending("k"))) == [("a", 1, 5), ("b", 4, 2)]


def test_null_order_and_top_k(frame):
    df = frame("v int", (1,), (None,), (2,))
    assert rows(df.orderBy(*ascending("v"))) == [(1,), (2,), (None,)]
    assert rows(top_k(df, 2, *descending("v"))) == [(None,), (2,)]


def test_random_pick_repeats_for_a_seed(spark):
    df = spark.range(100)
    assert rows(random_pick(df, 3)) == rows(random_pick(df, 3))
    assert random_pick(df, 3).count() == 1
    assert rows(random_pick(df.repartition(7), 3)) == rows(random_pick(df, 3))
    assert random_pick(df.limit(0), 3).collect() == []


def test_random_pick_gives_each_row_its_chance(frame):
    df = frame("a int, `b.c` string", (1, "x"), (2, None), (3, "z"), (None, None))
    got = [rows(random_pick(df, seed))[0] for seed in range(60)]
    assert {g[0] for g in got} == {1, 2, 3, None} and max(sum(g[0] == k for g in got) for k in (1, 2, 3, None)) < 35


# -- sales reports on a small star ---------------------------------------------


@pytest.fixture
def star(frame):
    d = dt.date
    return sales.SalesStar(
        sales=frame(
            "time_id date, cust_id int, channel_id int, prod_id int, amount_sold decimal(10,2)",
            (d(1999, 1, 5), 1, 1, 1, Decimal("75.00")),
            (d(1999, 2, 5), 1, 2, 1, Decimal("25.00")),
            (d(2000, 1, 5), 1, 1, 1, Decimal("50.00")),
            (d(2000, 8, 5), 1, 2, 2, Decimal("50.00")),
            (d(1998, 1, 5), 1, 1, 1, Decimal("99.00")),
            (d(2000, 2, 7), 2, 1, 1, Decimal("10.00")),
            (d(2000, 7, 7), 2, 1, 1, Decimal("20.00")),
            (d(2000, 7, 8), 3, 1, 2, Decimal("7.00")),
        ),
        customers=frame(
            "cust_id int, cust_first_name string, cust_last_name string, country_id int",
            (1, "Ada", "Moss", 1),
            (2, "Bo", "Reed", 2),
            (3, "Bo", "Reed", 2),
        ),
        countries=frame("country_id int, country_region string", (1, "Americas"), (2, "Asia")),
        channels=frame("channel_id int, channel_desc string", (1, "Shop"), (2, "Web")),
        products=frame(
            "prod_id int, prod_name string, prod_category string", (1, "lens", "Photo"), (2, "bag", "Other")
        ),
    )


def test_channel_share(star):
    got = rows(sales.channel_share(star.lines("country_region", "channel_desc"), regions=["Americas"]))
    assert [(r[0], r[1], r[2], *map(float, r[4:])) for r in got] == [
        ("Americas", 1999, "Shop", 75.0, 0.0, 75.0),
        ("Americas", 1999, "Web", 25.0, 0.0, 25.0),
        ("Americas", 2000, "Shop", 50.0, 75.0, -25.0),
        ("Americas", 2000, "Web", 50.0, 25.0, 25.0),
    ]


def test_quarter_pivot_leaves_null(star):
    got = rows(sales.product_quarter_pivot(star.lines("prod_name", "prod_category", "country_region")))
    assert [tuple(None if v is None else (v if isinstance(v, str) else float(v)) for v in r) for r in got] == [
        ("lens", 10.0, None, 20.0, None, 30.0)
    ]


def test_namesakes_merge_in_the_top_list(star):
    lines = star.lines("channel_desc", "cust_first_name", "cust_last_name")
    got = {(r.channel_desc, r.cust_last_name): float(r.amount_sold) for r in sales.top_customers_per_channel(lines).collect()}
    assert got[("Shop", "Reed")] == 37.0
    shares = [r.sales_percentage for r in sales.top_customers_per_channel(lines).collect()]
    assert all(s.endswith(" %") for s in shares)
    assert sum(float(s[:-2]) for s in shares) == pytest.approx(200, abs=0.001)


def test_yearly_top_sums_only_qualifying_years(star):
    lines = star.lines("channel_desc", "cust_id", "cust_first_name", "cust_last_name")
    got = rows(sales.yearly_top_customers(lines, years=(1998, 1999, 2000), limit=1))
    # 1998 and 1999: Shop of customer 1; 2000: two totals of 50 tie for the first rank.
    assert [(r[0], r[1], r[4].strip()) for r in got] == [("Shop", 1, "224.00"), ("Web", 1, "50.00")]
    every = sales.yearly_top_customers(lines, (1998, 1999, 2000), 1, rank_within_channel=True, in_every_year=True)
    assert [(r[0], r[1]) for r in rows(every)] == [("Shop", 1)]


def test_month_report_shows_zero(star):
    lines = star.lines("prod_category", "country_region")
    regions = {"Americas": "Americas SALES", "Asia": "Asia SALES"}
    got = rows(sales.month_category_report(lines, regions=regions))
    assert [(r[0], r[1], float(r[2]), float(r[3])) for r in got] == [
        ("2000-01", "Photo", 50.0, 0.0),
        ("2000-02", "Photo", 0.0, 10.0),
    ]


def test_own_times_dimension_is_used(star, frame):
    """A times table with a shifted year wins over the date."""
    times = frame("time_id date, calendar_year int", (dt.date(1998, 1, 5), 1999))
    shifted = sales.SalesStar(star.sales, star.customers, star.countries, star.channels, star.products, times)
    got = rows(sales.channel_share(shifted.lines("country_region", "channel_desc")))
    assert [(r[1], r[2], float(r[3])) for r in got] == [(1999, "Shop", 99.0)]


def test_weekly_report_variants(frame):
    days = [dt.date(1999, 12, 1) + dt.timedelta(days=i) for i in range(31)]
    lines = frame("time_id date, amount_sold decimal(10,2)", *[(d, Decimal(10)) for d in days])
    plain = rows(sales.weekly_sales_report(lines))
    assert len(plain) == 21
    assert [float(plain[0][5]), float(plain[-1][5])] == [5.0, 6.67]
    assert float(plain[-1][4]) == 210.0
    reset = rows(sales.weekly_sales_report(lines, reset_each_week=True, neighbours_outside=True))
    assert [float(r[4]) for r in reset[6:8]] == [70.0, 10.0]
    assert {float(r[5]) for r in reset} == {10.0}
