"""One key holds a third of the rows, and no table is small enough to broadcast."""

import re

import pytest
from conftest import row_set
from pyspark.sql import functions as F

from ledgerline.operators import ingest, lookup, mutate, quality, visibility
from ledgerline.operators.ordering import ascending, first_per_key
from ledgerline.plans import fuel

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}
N = 60_000


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    facts = spark.range(0, N, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"), F.lit(2).alias("quantity")
    )
    yield facts
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_rows(df):
    """Largest number of rows any shuffle of the finished plan carried, from Spark's own counters."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "isFinalPlan=true" in text
    sizes = []
    stages = [plan.finalPhysicalPlan()] if hasattr(plan, "finalPhysicalPlan") else [plan]
    while stages:
        node = stages.pop()
        name = node.nodeName()
        if name in ("ShuffleQueryStage", "TableCacheQueryStage", "BroadcastQueryStage"):
            stages.append(node.plan())
            continue
        if name == "Exchange":
            metric = node.metrics().get("shuffleRecordsWritten")
            sizes.append(metric.get().value())
        children = node.children()
        stages.extend(children.apply(i) for i in range(children.size()))
    return sizes


def test_fact_side_of_a_lookup_is_split(spark, skewed):
    prices = spark.range(1000).select(F.col("id").alias("k"), F.lit("1.50").cast("decimal(10,2)").alias("price"))
    priced = ingest.price_facts(skewed, prices, "k")
    assert "skew=true" in final_plan(priced)
    assert priced.count() == N


def test_many_side_of_a_left_join_is_split(spark, skewed):
    left = spark.range(2000).select(F.col("id").alias("k"))
    joined = lookup.left_join_many(left, skewed, ["k"])
    assert "skew=true" in final_plan(joined)
    native = left.join(skewed, "k", "left")
    assert joined.count() == native.count()
    assert row_set(joined.filter("k > 1990"), "k", "id") == row_set(native.filter("k > 1990"), "k", "id")


def test_not_in_splits_the_left_and_thins_the_right(spark, skewed):
    wanted = spark.range(500).select(F.col("id").alias("x"))
    kept = lookup.not_in(skewed, "k", wanted, "x")
    assert "skew=true" in final_plan(kept)
    assert kept.count() == skewed.filter("k >= 500").count()
    # The other way round the hot key is one row per task before the shuffle.
    assert max(shuffle_rows(lookup.not_in(wanted, "x", skewed, "k"))) <= 8 * 1000


@pytest.mark.parametrize("check", ["unique", "foreign", "stock", "first", "present"])
def test_hot_key_is_combined_before_the_shuffle(spark, skewed, check):
    parent = spark.range(990).select(F.col("id").alias("k"))
    df = {
        "unique": lambda: quality.unique_violations("t", skewed, ["k"]),
        "foreign": lambda: quality.foreign_key_violations("t", skewed, ["k"], parent, ["k"], "p"),
        "stock": lambda: ingest.fold_stock(parent.withColumn("quantity_available", F.lit(10**6)), skewed, ["k"]),
        "first": lambda: first_per_key(skewed, ["k"], ascending("id")),
        "present": lambda: lookup.present(parent, skewed, ["k"]),
    }[check]()
    assert max(shuffle_rows(df)) <= 8 * 1000


def _repeating(spark, name="k"):
    """A list that holds each of its keys three times."""
    return spark.range(1500).select((F.col("id") % 500).alias(name), F.lit(1).alias("value"))


@pytest.mark.parametrize(
    "check", ["present", "absent", "not_in", "resolve", "update", "delete", "accept", "child", "patch", "visible", "prices"]
)
def test_a_hot_key_is_split_against_a_list_that_repeats_keys(spark, skewed, check):
    listed = _repeating(spark)
    reference = mutate.Reference("c", ("k",), "p", ("pk",))
    df = {
        "present": lambda: lookup.present(skewed, listed, ["k"]),
        "absent": lambda: lookup.absent(skewed, listed, ["k"]),
        "not_in": lambda: lookup.not_in(skewed, "k", listed, "k"),
        "resolve": lambda: lookup.resolve_key(skewed, listed.withColumnRenamed("k", "d"), {"k": "d"}, "value", "key"),
        "update": lambda: mutate.update_where_key(skewed, listed, "k", {"quantity": F.lit(0)}),
        "delete": lambda: mutate.delete_keys(skewed, listed, ["k"]),
        "accept": lambda: ingest.accept_batch(
            spark.range(900).select(F.col("id").alias("k"), F.lit(10).alias("quantity_available")), skewed, ["k"], reject="key"
        ),
        "child": lambda: skewed.join(mutate._as_child(listed.withColumnRenamed("k", "pk"), reference), ["k"], "left_anti"),
        "patch": lambda: fuel.patch_rows(
            listed.withColumn("name", F.lit("a")),
            skewed.select(F.col("id").alias("seq"), "k", F.lit("name").alias("column_name"), F.lit("b").alias("new_value")),
            key="k",
            columns=("name",),
        )[1],
        "visible": lambda: visibility.visible_rows(skewed, listed.withColumn("user_name", F.lit("u")), "u", "k"),
        "prices": lambda: ingest.price_facts(skewed, listed.distinct().withColumnRenamed("value", "price"), "k"),
    }[check]()
    assert "skew=true" in final_plan(df)


def test_thin_keeps_one_row_per_key(spark):
    listed = _repeating(spark).unionByName(spark.createDataFrame([(None, 1), (None, 2)], "k long, value int"))
    assert row_set(lookup.thin(listed, ["k"])) == row_set(listed.select("k").distinct())
    sums = lookup.thin(listed, ["k"], F.sum("value").alias("s"))
    assert row_set(sums) == row_set(listed.groupBy("k").agg(F.sum("value").alias("s")))


def test_plan_text_names_the_split(spark, skewed):
    """The marker the tests above look for is the one Spark prints."""
    dim = spark.range(1000).select(F.col("id").alias("k"))
    text = final_plan(skewed.join(dim, "k", "inner"))
    assert re.search(r"SortMergeJoin\(skew=true\)", text)
