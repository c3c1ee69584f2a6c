"""Sources, sinks, the storage report, and the stream forms of the ingest rules."""

import glob
import os
from decimal import Decimal as D

import pytest
from conftest import row_set, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerline.operators.ingest import fold_stock, price_facts
from ledgerline.session import cut_lineage, drop_intermediate, ensure_checkpoint_dir
from ledgerline.sources import sinks
from ledgerline.sources.footprint import footprint
from ledgerline.sources.tables import ParquetTables, array_rows, inline, labelled_rows, sequence_rows
from ledgerline.streaming import ingest as stream


def test_sources(spark, tmp_path):
    assert rows(inline(spark, "a int, b string", (1, "x"))) == [(1, "x")]
    assert [r.x for r in sequence_rows(spark, 3, 5).collect()] == [3, 4, 5]
    assert rows(labelled_rows(spark, 2, "p_")) == [("p_1",), ("p_2",)]
    assert rows(array_rows(spark.range(1), F.array(F.lit("u"), F.lit("v")), "w", ["id"])) == [(0, "u"), (0, "v")]
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert ParquetTables(spark, str(tmp_path))["t"].count() == 3


def test_create_append_truncate(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_new(spark.range(5), path)
    with pytest.raises(AnalysisException):
        sinks.write_new(spark.range(5), path)
    sinks.append(spark.range(2), path)
    assert spark.read.parquet(path).count() == 7
    sinks.truncate_path(spark, path)
    emptied = spark.read.parquet(path)
    assert emptied.count() == 0 and emptied.columns == ["id"]


def test_table_life(spark, tmp_path):
    sinks.drop_table(spark, "life")
    sinks.create_table_as(spark.range(4), "life", str(tmp_path / "life"))
    with pytest.raises(AnalysisException):
        sinks.create_table_as(spark.range(4), "life")
    assert spark.table("life").count() == 4
    sinks.drop_table(spark, "life")
    sinks.create_table_as(spark.range(4), "managed_life")
    sinks.truncate_table(spark, "managed_life")
    assert spark.table("managed_life").count() == 0
    sinks.drop_table(spark, "managed_life")
    assert not spark.catalog.tableExists("managed_life")


def test_view_is_evaluated_when_read(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_new(spark.range(1), path)
    view = sinks.publish_view(spark.read.parquet(path).filter("id >= 0"), "late_view")
    assert view.count() == 1
    sinks.drop_view(spark, "late_view")
    assert not spark.catalog.tableExists("late_view")


def test_partition_writes_touch_only_their_partition(spark, frame, tmp_path):
    path = str(tmp_path / "payment")
    sinks.append_partitions(frame("year int, month int, v int", (2017, 1, 1), (2017, 2, 2)), path, ["year", "month"])
    sinks.append_partitions(frame("year int, month int, v int", (2017, 1, 3)), path, ["year", "month"])
    assert row_set(spark.read.parquet(path), "month", "v") == [(1, 1), (1, 3), (2, 2)]
    sinks.overwrite_partitions(frame("year int, month int, v int", (2017, 1, 9)), path, ["year", "month"])
    assert row_set(spark.read.parquet(path), "month", "v") == [(1, 9), (2, 2)]
    plan = spark.read.parquet(path).filter("month = 2")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_snapshot_versions(spark, tmp_path):
    root = str(tmp_path / "s")
    sinks.publish_snapshot(spark.range(2), root, 1)
    again = sinks.publish_snapshot(spark.range(3), root, 1)
    assert again.count() == 3
    assert sinks.publish_snapshot(again.filter("id > 0"), root, 2).count() == 2
    # The same version read and written at a time.
    current = sinks.read_snapshot(spark, root)
    assert sinks.publish_snapshot(current.filter("id > 1"), root, 2).count() == 1
    assert current.count() == 2 and sinks.read_snapshot(spark, root).count() == 1


def test_a_failed_write_leaves_the_old_snapshot(spark, tmp_path):
    root = str(tmp_path / "s")
    sinks.publish_snapshot(spark.range(3), root, 1)
    with pytest.raises(Exception):
        sinks.publish_snapshot(spark.range(3).select(F.raise_error(F.lit("stop")).alias("id")), root, 2)
    assert sinks.read_snapshot(spark, root).count() == 3
    with pytest.raises(FileNotFoundError):
        sinks.read_snapshot(spark, str(tmp_path / "none"))


def test_footprint_adds_up_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 4).write.parquet(path)
    sizes = [os.path.getsize(p) for p in glob.glob(path + "/*.parquet")]
    report = rows(footprint({"t": spark.read.parquet(path), "other": spark.read.parquet(path)}, "t%"))
    assert report == [("t", 4, 1000, sum(sizes), f"{sum(sizes)} bytes" if sum(sizes) < 10240 else report[0][4])]


def test_intermediate_tables_are_removed_on_request(spark):
    drop_intermediate(spark)
    table = cut_lineage(spark.range(3).toDF("id"))
    assert table.count() == 3
    folder = table.inputFiles()[0].rpartition("/")[0].removeprefix("file://")
    assert os.path.isdir(folder)
    assert drop_intermediate(spark) == 1 and not os.path.isdir(folder)


def test_checkpoint_dir_of_the_session_wins(spark):
    folder = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == folder == spark.sparkContext.getCheckpointDir()


# -- streams -----------------------------------------------------------------------

SCHEMA = "n int, k int, quantity decimal(10,2), total_amount decimal(10,2)"


@pytest.fixture
def arriving(spark, frame, tmp_path):
    """Three files of sales, one micro-batch each."""
    path = str(tmp_path / "in")
    for part in (
        [(1, 1, D(6), D(0)), (2, 2, D(1), D(0))],
        [(3, 1, D(2), D(0)), (4, 9, D(4), D(0))],
        [(5, 2, D(3), D(0))],
    ):
        frame(SCHEMA, *part).coalesce(1).write.mode("append").parquet(path)
    return path


def test_priced_stream_equals_the_batch(spark, frame, arriving, tmp_path):
    prices = frame("k int, price decimal(10,2)", (1, D("2.50")), (2, D("4.00")))
    facts = stream.read_facts(spark, arriving, SCHEMA, files_per_batch=1)
    out = str(tmp_path / "out")
    query = (
        stream.priced_stream(facts, prices, "k")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    batch = price_facts(spark.read.parquet(arriving), prices, "k")
    got = row_set(spark.read.parquet(out), "n", "total_amount")
    assert got == row_set(batch, "n", "total_amount")
    assert [(n, None if a is None else float(a)) for n, a in got] == [(1, 15.0), (2, 4.0), (3, 5.0), (4, None), (5, 12.0)]


def test_stock_ledger_equals_the_batch_and_survives_a_replay(spark, frame, arriving, tmp_path):
    stock = frame("k int, quantity_available decimal(10,2)", (1, D(10)), (2, D(10)), (3, D(10)))
    ledger = stream.StockLedger(str(tmp_path / "ledger"), ["k"])
    facts = stream.read_facts(spark, arriving, SCHEMA, files_per_batch=1)
    stream.run_available(facts, ledger, str(tmp_path / "cp"))
    want = row_set(fold_stock(stock, spark.read.parquet(arriving), ["k"]))
    assert row_set(ledger.stock(stock)) == want
    assert len(os.listdir(tmp_path / "ledger")) == 3
    # A batch written again after a failure replaces itself.
    first = spark.read.parquet(str(tmp_path / "ledger")).filter("batch_id = 0").select("k", F.col("sold").alias("quantity"))
    ledger.record(spark.createDataFrame(first.collect(), first.schema), 0)
    assert row_set(ledger.stock(stock)) == want
    # A new file comes, only its batch is added; then the ledger is folded into a base.
    frame(SCHEMA, (6, 3, D(7), D(0))).write.mode("append").parquet(arriving)
    stream.run_available(facts, ledger, str(tmp_path / "cp"))
    final = [(k, float(v)) for k, v in row_set(ledger.stock(stock))]
    assert final == [(1, 2.0), (2, 6.0), (3, 3.0)]
    base, last = ledger.compact(stock, str(tmp_path / "base"))
    assert [(k, float(v)) for k, v in row_set(base)] == final
    assert [(k, float(v)) for k, v in row_set(ledger.stock(base, after_batch=last))] == final
    # Again without a new batch: nothing is written, and the base stays.
    same, still = ledger.compact(base, str(tmp_path / "base"), after_batch=last)
    assert still == last and [(k, float(v)) for k, v in row_set(same)] == final
    assert [(k, float(v)) for k, v in row_set(sinks.read_snapshot(spark, str(tmp_path / "base")))] == final
    ledger.retire(spark, last)
    assert os.listdir(tmp_path / "ledger") == []
    assert [(k, float(v)) for k, v in row_set(ledger.stock(base, after_batch=last))] == final


def test_a_ledger_without_batches_is_the_base(spark, frame, tmp_path):
    stock = frame("k int, quantity_available decimal(10,2)", (1, D(10)))
    ledger = stream.StockLedger(str(tmp_path / "ledger"), ["k"])
    assert row_set(ledger.stock(stock)) == [(1, D("10.00"))]
    base, last = ledger.compact(stock, str(tmp_path / "base"))
    assert last == -1 and row_set(base) == row_set(stock)


def test_events_stream_smoke(spark, tmp_path):
    """The driver's event table as a stream of sales."""
    source = "/root/testdata/sf0.001/events.parquet"
    if not os.path.exists(source):
        pytest.skip("driver tables are not here")
    events = spark.read.parquet(source).select(
        F.col("event_type").alias("k"), F.col("value").cast("decimal(10,2)").alias("quantity")
    )
    path = str(tmp_path / "in")
    events.repartition(3).write.parquet(path)
    ledger = stream.StockLedger(str(tmp_path / "ledger"), ["k"])
    facts = stream.read_facts(spark, path, "k string, quantity decimal(10,2)", files_per_batch=1)
    stream.run_available(facts, ledger, str(tmp_path / "cp"))
    stock = events.select("k").distinct().withColumn("quantity_available", F.lit(D("100000.00")))
    assert row_set(ledger.stock(stock)) == row_set(fold_stock(stock, events, ["k"]))
