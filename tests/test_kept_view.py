"""A view kept by signed changes against its recomputation."""

import random
from decimal import Decimal as D

import pytest
from conftest import row_set
from pyspark.sql import functions as F

from ledgerline.sources.kept_view import KeptView, signed

SCHEMA = "id int, quarter int, station int, fuel string, quantity decimal(10,2)"


def view(spark, path):
    amount = F.col("quantity") * 2
    return KeptView(spark, str(path / "v"), F.col("quarter"), ["station", "fuel"], {"quantity": F.col("quantity"), "amount": amount})


def recomputed(rows):
    out = {}
    for _, p, s, f, q in rows:
        n, total = out.get((p, s, f), (0, D(0)))
        out[p, s, f] = n + 1, total + (q or 0)
    return sorted(((*k, n, t, 2 * t) for k, (n, t) in out.items()), key=lambda r: tuple((v is None, str(v)) for v in r))


def shown(df):
    return [(*r[:4], D(r[4]).quantize(D("0.01")), D(r[5]).quantize(D("0.01"))) for r in row_set(df, "part", "station", "fuel", "n_rows", "quantity", "amount")]


def test_equals_recomputation_after_random_changes(spark, tmp_path):
    rng = random.Random(8)

    def row(i):
        return (i, rng.randrange(6), rng.choice((1, 2, None)), rng.choice("ab"), rng.choice((None, D(rng.randrange(1, 999)) / 100)))

    kept, table = view(spark, tmp_path), {i: row(i) for i in range(80)}
    kept.apply(signed(spark.createDataFrame(list(table.values()), SCHEMA)), 0)
    for batch in range(1, 5):
        out = rng.sample(sorted(table), 12)
        gone = [table.pop(i) for i in out]
        back = [row(i) for i in out[:6]] + [row(1000 * batch + k) for k in range(5)]
        table.update({r[0]: r for r in back})
        changes = signed(spark.createDataFrame(back, SCHEMA), spark.createDataFrame(gone, SCHEMA))
        assert set(kept.apply(changes, batch)) <= {r[1] for r in back + gone}
        assert shown(kept.read()) == recomputed(table.values())
        assert kept.apply(changes, batch) == [] and kept.last_batch() == batch
    assert shown(kept.read([2, 3, 77])) == [r for r in recomputed(table.values()) if r[0] in (2, 3)]
    kept.retire()
    assert shown(kept.read()) == recomputed(table.values())


def test_untouched_parts_are_neither_read_nor_written(spark, tmp_path):
    kept = view(spark, tmp_path)
    kept.apply(signed(spark.createDataFrame([(i, i % 4, 1, "a", D(1)) for i in range(40)], SCHEMA)), 0)
    before = {f for f in kept.read().inputFiles()}
    broken = [f for f in before if "/p=3/" in f]
    # What a batch does not touch may even be unreadable.
    for f in broken:
        with open(f.removeprefix("file://"), "wb") as out:
            out.write(b"no parquet")
    (tmp_path / "v").exists()
    crc = [p for p in (tmp_path / "v" / "data").rglob(".*.crc") if "p=3" in str(p)]
    for p in crc:
        p.unlink()
    assert kept.apply(signed(deleted=spark.createDataFrame([(1, 1, 1, "a", D(1))], SCHEMA)), 1) == [1]
    after = {f for f in kept.read([0, 1, 2]).inputFiles()}
    assert {f for f in before if "/p=1/" not in f and "/p=3/" not in f} < after and not {f for f in before if "/p=1/" in f} & after
    assert [(r[0], r[3]) for r in shown(kept.read([0, 1, 2]))] == [(0, 10), (1, 9), (2, 10)]


def test_changes_that_cancel_and_groups_that_vanish(spark, tmp_path):
    kept = view(spark, tmp_path)
    rows = spark.createDataFrame([(1, 1, 1, "a", D(1)), (2, 2, 1, "a", D(1))], SCHEMA)
    kept.apply(signed(rows), 0)
    assert kept.apply(signed(rows, rows), 1) == []
    assert kept.apply(signed(deleted=rows.filter("id = 2")), 2) == [2]
    assert [r[0] for r in shown(kept.read())] == [1]
    kept.apply(signed(deleted=rows.filter("id = 1")), 3)
    assert kept.last_batch() == 3
    with pytest.raises(FileNotFoundError):
        kept.read()


def test_errors(spark, tmp_path):
    kept = view(spark, tmp_path)
    with pytest.raises(ValueError, match="no part"):
        kept.apply(signed(spark.createDataFrame([(1, None, 1, "a", D(1))], SCHEMA)), 0)
    with pytest.raises(Exception, match="was not there"):
        kept.apply(signed(deleted=spark.createDataFrame([(1, 1, 1, "a", D(1))], SCHEMA)), 0)
    assert kept.last_batch() == -1
    with pytest.raises(ValueError):
        signed()
