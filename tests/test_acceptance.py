"""Sales judged one after another, in batch and on a stream."""

import random
from decimal import Decimal as D

import pytest
from conftest import row_set
from pyspark.sql import functions as F

from ledgerline.operators import ingest
from ledgerline.streaming import acceptance
from ledgerline.streaming.ingest import read_facts


def by_hand(stock, facts):
    """``n -> accepted`` for facts ``(n, key, quantity)`` in order of n."""
    left = {}
    for k, b in stock:
        if k is not None:
            left[k] = min(b, left.get(k, b))
    out = {}
    for n, k, q in sorted(facts, key=lambda f: f[0]):
        q = D(0) if q is None else q
        out[n] = q >= 0 and (k not in left or q <= left[k])
        if out[n] and k in left:
            left[k] -= q
    return out


def judged(spark, stock, facts, **options):
    s = spark.createDataFrame(stock, "k int, quantity_available decimal(12,2)")
    f = spark.createDataFrame([(*x, "a", 1) for x in facts], "n int, k int, quantity decimal(10,2), row string, `c0.at` int")
    df = ingest.accept_rows(s, f, ["k"], ["n"], **options)
    assert df.columns == ["n", "k", "quantity", "row", "c0.at", "accepted"]
    got = df.collect()
    assert len(got) == len(facts) and {(r.row, r["c0.at"]) for r in got} <= {("a", 1)}
    return {r.n: r.accepted for r in got}


def test_a_refused_sale_takes_nothing_and_a_smaller_one_passes(spark):
    facts = [(1, 1, D(6)), (2, 1, D(6)), (3, 1, D(4)), (4, 1, D("0.01")), (5, 2, D(1))]
    assert judged(spark, [(1, D(10)), (2, D("0.99"))], facts) == {1: True, 2: False, 3: True, 4: False, 5: False}


def test_nulls_missing_stock_repeated_stock_and_negative_quantities(spark):
    stock = [(1, D(10)), (1, D(7)), (None, D(0))]
    facts = [(1, 1, D(5)), (2, 1, None), (3, 1, D(3)), (4, 1, D(2)), (5, 9, D(1000)), (6, None, D(1000)), (7, 1, D(-1)), (8, 9, D(-1))]
    got = judged(spark, stock, facts)
    assert got == by_hand(stock, facts) == {1: True, 2: True, 3: False, 4: True, 5: True, 6: True, 7: False, 8: False}


@pytest.mark.parametrize("fold_rows", [1, 20, 2000])
def test_a_key_with_a_third_of_the_rows(spark, fold_rows):
    rng = random.Random(fold_rows)
    facts = [(n, 0 if n % 3 == 0 else rng.randrange(1, 40), D(rng.randrange(1, 5000)) / 100) for n in range(3000)]
    stock = [(k, D(rng.randrange(100, 30_000)) / 100) for k in range(38)]
    assert judged(spark, stock, facts, fold_rows=fold_rows) == by_hand(stock, facts)


def test_alternating_small_and_large_sales_need_many_rounds(spark):
    """Each round takes one small sale and refuses one large one, and still ends."""
    facts = [(2 * i + j, 1, D(1) if j == 0 else D(40 - i)) for i in range(12) for j in (0, 1)]
    assert judged(spark, [(1, D(40))], facts, fold_rows=2) == by_hand([(1, D(40))], facts)


def test_empty_tables(spark):
    assert judged(spark, [(1, D(1))], []) == {}
    assert judged(spark, [], [(1, 1, D(5))]) == {1: True}


@pytest.fixture
def state_store(spark):
    name, value = acceptance.STATE_STORE
    spark.conf.set(name, value)
    yield
    spark.conf.unset(name)


FACTS = "n int, k int, quantity decimal(10,2), label string"


def test_stream_gives_the_rows_of_the_batch_after_restart_and_replay(spark, state_store, tmp_path):
    rng = random.Random(11)
    facts = [(n, rng.choice((0, 0, 1, 2, 9, None)), D(rng.randrange(1, 900)) / 100, None if n % 5 else "x") for n in range(240)]
    stock = spark.createDataFrame([(0, D(60)), (1, D(40)), (2, D(5)), (2, D(9))], "k int, quantity_available decimal(12,2)")
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))

    def arrive(part):
        rows = facts[part * 60 : part * 60 + 60]
        rng.shuffle(rows)
        spark.createDataFrame(rows, FACTS).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = read_facts(spark, source, FACTS, files_per_batch=1)
        acceptance.run_judged(acceptance.judged_stream(stream, stock, ["k"], ["n"]), out, checkpoint)

    arrive(0)
    arrive(1)
    run()
    # A batch whose end was not recorded is done again from its own state.
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    arrive(2)
    run()
    arrive(3)
    run()
    got = spark.read.parquet(out)
    table = spark.createDataFrame(facts, FACTS)
    batch = ingest.accept_rows(stock, table, ["k"], ["n"])
    columns = ["n", "k", "quantity", "label", "accepted"]
    assert row_set(got, *columns) == row_set(batch, *columns)
    least = got.filter("k = 0").agg(F.min("balance_cents")).first()[0]
    sold = sum(int(q * 100) for n, k, q, _ in facts if k == 0 and {r.n: r.accepted for r in got.select("n", "accepted").collect()}[n])
    assert least == 6000 - sold >= 0
    assert got.filter("k = 9").agg(F.max("balance_cents")).first()[0] is None
