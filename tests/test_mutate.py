import datetime as dt
from decimal import Decimal as D

import pytest
from conftest import row_set, rows
from pyspark.sql import functions as F

from ledgerline.operators import lookup, mutate
from ledgerline.operators.ordering import ascending, descending
from ledgerline.operators.pivot import conditional_sums, crosstab


def test_insert_absent_dedupes_the_batch_and_is_rerunnable(frame):
    table = frame("id int, name string", (1, "a"))
    batch = frame("name string, note string", ("a", "x"), ("b", "2"), ("b", "1"), ("c", "x"))
    fresh = mutate.insert_absent(table, batch, ["name"], ascending("note"))
    assert row_set(fresh) == [("b", "1"), ("c", "x")]
    keyed = mutate.assign_keys(fresh, table, "id", ascending("name"), {"b": F.lit(0)})
    grown = table.unionByName(keyed.select("id", "name"))
    assert row_set(grown) == [(1, "a"), (2, "b"), (3, "c")]
    assert mutate.insert_absent(grown, batch, ["name"]).count() == 0


def test_keys_of_an_empty_table_start_at_one(frame):
    keyed = mutate.assign_keys(frame("name string", ("x",)), frame("id int, name string"), "id", ascending("name"))
    assert rows(keyed, "id", "name") == [(1, "x")]


def test_unordered_keys_are_dense(spark, frame):
    batch = spark.range(1000).select(F.concat(F.lit("n"), F.col("id")).alias("name"))
    keyed = mutate.assign_unordered_keys(batch, frame("id int, name string", (7, "x")), "id", ["name"], spread=16)
    assert sorted(r.id for r in keyed.collect()) == list(range(8, 1008))


def test_child_needs_its_parent(frame):
    parent = frame("pid int, pname string", (1, "p"), (2, "q"))
    child = frame("id int, name string, pid int", (1, "a", 1))
    batch = frame("name string, of string", ("a", "p"), ("a", "q"), ("b", "none"), ("c", None))
    fresh = mutate.insert_absent_child(child, batch, parent, {"of": "pname"}, "pid", "pid", ["name"])
    assert row_set(fresh, "name", "pid") == [("a", 2)]


def test_bridge_from_name_pairs(frame):
    people = frame("actor_id int, first_name string, last_name string", (1, "A", "Anca"), (2, "B", "Q"), (3, "B", "Q"))
    films = frame("film_id int, title string", (10, "F"), (11, "G"))
    pairs = frame(
        "first string, last string, film string", ("A", "Ancă", "F"), ("B", "Q", "F"), ("B", "Q", "F"), ("B", "Q", "none")
    )
    existing = frame("actor_id int, film_id int", (3, 10))
    got = mutate.bridge_rows(
        pairs, people, {"first": "first_name", "last": "last_name"}, "actor_id", films, {"film": "title"}, "film_id", existing
    )
    # The accent keeps the first pair from matching; one of the two namesakes is linked already.
    assert row_set(got) == [(2, 10)]


def test_missing_pairs(frame):
    films = frame("film_id int, title string", (1, "F"), (2, "G"), (3, "F"))
    stores = frame("store_id int", (1,), (2,))
    kept = frame("film_id int, store_id int", (1, 1), (3, 2))
    got = mutate.missing_pairs(films, "film_id", "title", ["F", "none", "F"], stores, "store_id", kept)
    assert row_set(got) == [(1, 2), (3, 1)]


def test_upsert_takes_null_and_keeps_other_columns(frame):
    table = frame("k int, a string, b string", (1, "old", "keep"), (2, "old", "keep"))
    changes = frame("k int, a string, b string, n int", (1, None, "drop", 1), (3, "new", "new", 1), (1, "later", "x", 2))
    got = mutate.upsert(table, changes, ["k"], ["a"], ascending("n"))
    assert row_set(got) == [(1, None, "keep"), (2, "old", "keep"), (3, "new", "new")]


def test_update_and_fill(frame):
    table = frame("k int, v string", (1, "a"), (2, None), (None, "c"))
    hit = mutate.update_where_key(table, frame("k int", (1,), (1,), (None,)), "k", {"v": F.lit("new")})
    assert row_set(hit) == [(1, "new"), (2, None), (None, "c")]
    assert row_set(mutate.fill_nulls(table, {"v": F.lit("z")})) == [(1, "a"), (2, "z"), (None, "c")]


def test_delete_keeps_unknown(frame):
    table = frame("v int", (1,), (3,), (None,))
    assert row_set(mutate.delete_where(table, F.col("v") % 3 == 0)) == [(1,), (None,)]
    assert row_set(mutate.delete_keys(table, frame("v int", (1,), (None,)), ["v"])) == [(3,), (None,)]


def test_snapshots_keep_the_column_order(frame):
    table = frame("a int, k int, b int", (1, 1, 1), (2, 2, 2))
    keys = frame("k int", (1,))
    for df in (
        mutate.delete_keys(table, keys, ["k"]),
        lookup.present(table, keys, ["k"]),
        mutate.update_where_key(table, keys, "k", {"b": F.lit(9)}),
        mutate.upsert(table, table, ["k"], ["b"]),
        mutate.cascade_delete({"t": table}, [], "t", keys)["t"],
    ):
        assert df.columns == ["a", "k", "b"]


def test_delete_a_third(spark):
    from ledgerline.functions.text import number_after_prefix
    from ledgerline.sources.tables import labelled_rows

    n = 100_000
    labels = labelled_rows(spark, n, "label_")
    kept = mutate.delete_where(labels, number_after_prefix(F.col("col"), "label_") % 3 == 0)
    assert kept.count() == n - n // 3


def test_columns(frame):
    table = frame("k int", (1,))
    day = dt.date(2024, 1, 1)
    once = mutate.add_column(table, "d", F.lit(day))
    assert rows(mutate.add_column(once, "d", F.lit(dt.date(2025, 1, 1)))) == [(1, day)]
    assert mutate.truncated(once).schema == once.schema
    assert mutate.truncated(once).count() == 0


# -- lookups ---------------------------------------------------------------------


@pytest.mark.parametrize("listed, kept", [([(1,)], [2]), ([(1,), (None,)], []), ([], [1, 2, None]), ([(9,)], [1, 2])])
def test_not_in_follows_null_logic(spark, frame, listed, kept):
    df = frame("x int", (1,), (2,), (None,))
    other = frame("y int", *listed)
    got = lookup.not_in(df, "x", other, "y")
    assert sorted(map(str, (r.x for r in got.collect()))) == sorted(map(str, kept))
    df.createOrReplaceTempView("lefts")
    other.createOrReplaceTempView("rights")
    native = spark.sql("SELECT x FROM lefts WHERE x NOT IN (SELECT y FROM rights)")
    assert row_set(native) == row_set(got)


def test_pairs_and_membership(frame):
    df = frame("a string, b int", ("x", 1), ("x", 2), ("y", 1), (None, 1))
    assert row_set(lookup.in_pairs(df, ["a", "b"], [("x", 1), ("y", 2), ("x", 1)])) == [("x", 1)]
    other = frame("a string", ("x",), (None,))
    assert row_set(lookup.present(df, other, ["a"])) == [("x", 1), ("x", 2)]
    assert row_set(lookup.absent(df, other, ["a"])) == [("y", 1), (None, 1)]


def test_resolve_key_takes_the_smallest(frame):
    facts = frame("n string", ("p",), ("q",), (None,))
    dim = frame("id int, name string", (5, "p"), (3, "p"), (4, None))
    assert row_set(lookup.resolve_key(facts, dim, {"n": "name"}, "id")) == [("p", 3), ("q", None), (None, None)]


def test_only_value(spark, frame):
    df = frame("x int", (1,), (2,))
    one = lookup.only_value(df.filter("x = 1"), "x")
    assert rows(spark.range(1).select(one)) == [(1,)]
    assert rows(spark.range(1).select(lookup.only_value(df.filter("x = 9"), "x"))) == [(None,)]
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        spark.range(1).select(lookup.only_value(df, "x")).collect()


def test_latest_value_breaks_ties(frame):
    df = frame("g int, t int, k int, v string", (1, 5, 1, "a"), (1, 5, 2, "b"), (1, 4, 9, "c"))
    assert rows(df.groupBy("g").agg(lookup.latest_value("v", "t", "k"))) == [(1, "b")]


def test_pivots(frame):
    df = frame("k string, q int, v decimal(10,2)", ("a", 1, D(2)), ("a", 3, D(5)), ("a", 9, D(100)), ("b", 1, D(1)))
    wide = crosstab(df, ["k"], "q", {1: "q1", 2: "q2", 3: "q3"}, F.sum("v"))
    assert [(r[0], *(None if x is None else float(x) for x in r[1:])) for r in row_set(wide)] == [
        ("a", 2.0, None, 5.0),
        ("b", 1.0, None, None),
    ]
    zero = conditional_sums(df, ["k"], "q", {1: "q1", 2: "q2"}, F.col("v"))
    assert [(r[0], float(r[1]), float(r[2])) for r in row_set(zero)] == [("a", 2.0, 0.0), ("b", 1.0, 0.0)]


def test_descending_default(frame):
    assert rows(frame("v int", (1,), (None,), (3,)).orderBy(*descending("v"))) == [(None,), (3,), (1,)]


def test_rows_with_a_null_natural_key_are_all_new(frame):
    table = frame("k string, v int", ("a", 1))
    batch = frame("k string, v int", (None, 2), (None, 3), ("a", 4), ("b", 5), ("b", 6))
    assert row_set(mutate.insert_absent(table, batch, ["k"])) == [("b", 5), (None, 2), (None, 3)]


def test_upsert_refuses_a_key_that_changes_twice(frame):
    table = frame("k int, v int", (1, 1), (2, 2))
    changes = frame("k int, v int", (1, 5), (1, 6))
    with pytest.raises(Exception, match="changed twice"):
        mutate.upsert(table, changes, ["k"], ["v"]).collect()
    ordered = mutate.upsert(table, changes, ["k"], ["v"], [F.col("v").desc()])
    assert row_set(ordered) == [(1, 6), (2, 2)]


def test_cascading_truncate_empties_everything_below(frame):
    names = ("region", "nation", "customer", "part")
    tables = {n: frame("id int", (1,), (2,)) for n in names}
    references = [
        mutate.Reference("nation", ("id",), "region", ("id",)),
        mutate.Reference("customer", ("id",), "nation", ("id",)),
    ]
    left = {n: df.count() for n, df in mutate.cascade_truncate(tables, references, ["nation"]).items()}
    assert left == {"region": 2, "nation": 0, "customer": 0, "part": 2}
