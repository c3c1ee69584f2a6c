"""Pattern search through stored trigrams."""

import re

import pytest
from conftest import row_set
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators.patterns import TrigramIndex, literal_runs, trigrams

TEXTS = [(1, "Green Light"), (2, "evergreen"), (3, "gree"), (4, None), (5, ""), (6, "100% green_ish"), (None, "green at no key"), (1, "agreeneen"), (7, "ÉCOLE verte"), (8, "ab")]
PATTERNS = ["%green%", "GREEN%", "%gre_n%", "gr%", "%g%r%e%", "%", "_b", "%100\\% gr%", "%green\\_%", "%école%", "%een%een%", "%absent%"]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(TEXTS, "id int, title string")


@pytest.mark.parametrize("any_case", [True, False])
def test_equals_a_scan(spark, table, tmp_path, any_case):
    index = TrigramIndex(spark, str(tmp_path / "p"), any_case, buckets=5)
    index.extend(table.filter("id <= 4 or id is null"), "id", "title")
    index.extend(table.filter("id > 4"), "id", "title")
    for pattern in PATTERNS:
        fits = F.col("title").ilike(pattern) if any_case else F.col("title").like(pattern)
        assert row_set(index.search(table, "id", "title", pattern)) == row_set(table.filter(fits)), pattern


def test_only_folders_and_runs_of_the_pattern_are_read(spark, table, tmp_path):
    index = TrigramIndex(spark, str(tmp_path / "p"), buckets=64)
    index.extend(table, "id", "title")
    plan = index.keys("%Green%")._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN", plan) or re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    assert re.search(r"PushedFilters: \[[^\n]*In\(gram, \[[a-z,]*een", plan)
    assert index.keys("%gr%") is None


def test_deleted_and_changed_rows(spark, table, tmp_path):
    index = TrigramIndex(spark, str(tmp_path / "p"))
    index.extend(table, "id", "title")
    now = spark.createDataFrame([(1, "red light"), (9, "new green")], "id int, title string")
    assert row_set(index.search(now, "id", "title", "%green%")) == []
    index.extend(now, "id", "title")
    assert row_set(index.search(now, "id", "title", "%green%")) == [(9, "new green")]


def test_trigrams(frame):
    df = frame("t string", ("abcab",), ("ab",), (None,), ("aaaa",))
    assert [r[0] for r in df.select(trigrams(F.col("t"))).collect()] == [["abc", "bca", "cab"], [], None, ["aaa"]]


@settings(max_examples=60, deadline=None)
@given(st.text("ab%_\\", max_size=8))
def test_runs_are_in_every_text_that_fits(pattern):
    runs = literal_runs(pattern)
    assert all(runs) and "".join(runs) == re.sub(r"\\(.)|[%_]", lambda m: m.group(1) or "", pattern + ("" if not re.fullmatch(r"(?:[^\\]|\\.)*\\", pattern) else ""))
