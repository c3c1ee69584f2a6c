from conftest import row_set
from pyspark.sql import functions as F

from ledgerline.operators import quality as q


def test_null_passes_checks_and_domains(frame):
    df = frame("k int, v int, s string", (1, -1, "x"), (2, None, None), (3, 5, "a"))
    rules = [q.check("v >= 0", F.col("v") >= 0), q.one_of("s", ["a", "b"]), q.max_length("s", 1)]
    assert row_set(q.row_violations("t", df, ["k"], rules), "rule", "key") == [("check", "1"), ("domain", "1")]


def test_one_row_can_break_several_rules(frame):
    df = frame("k int, s string", (1, "long text"), (2, None))
    rules = [q.max_length("s", 4), q.one_of("s", ["a"]), q.not_null("s")]
    assert row_set(q.row_violations("t", df, ["k"], rules), "key", "rule") == [
        ("1", "domain"),
        ("1", "length"),
        ("2", "not_null"),
    ]


def test_null_keys_never_conflict_but_are_no_primary_key(frame):
    df = frame("a int, b int", (1, None), (1, None), (2, 2), (2, 2), (None, None))
    assert row_set(q.unique_violations("t", df, ["a", "b"]), "key", "n_rows") == [("2|2", 2)]
    found = q.primary_key_violations("t", df, ["a", "b"])
    assert row_set(found, "key", "reason", "n_rows") == [
        ("1|NULL", "b is null", 1),
        ("1|NULL", "b is null", 1),
        ("2|2", "duplicate a, b", 2),
        ("NULL|NULL", "a is null", 1),
        ("NULL|NULL", "b is null", 1),
    ]


def test_foreign_key_counts_orphans_once_per_value(frame):
    child = frame("p int", (1,), (9,), (9,), (None,))
    parent = frame("id int", (1,))
    found = q.foreign_key_violations("c", child, ["p"], parent, ["id"], "parent")
    assert row_set(found, "key", "reason", "n_rows") == [("9", "no parent row for p", 2)]


def test_precision(frame):
    df = frame("k int, v string", (1, "99999999.99"), (2, "100000000"), (3, "1.999"), (4, None), (5, "text"))
    assert row_set(q.row_violations("t", df, ["k"], [q.fits_decimal("v", 10, 2)]), "key") == [("2",), ("5",)]


def test_rows_in_equal_accepted_plus_rejected(spark):
    from ledgerline.operators.ingest import first_failure, split_rejects

    df = spark.range(100)
    good, bad = split_rejects(df, first_failure((F.col("id") % 7 == 0, "seven"), (F.col("id") % 2 == 0, "even")))
    assert good.count() + bad.count() == 100
    assert bad.filter("id = 14").first().reason == "seven"
