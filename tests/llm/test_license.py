import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import license_scan as s

ROWS = [
    (1, "a/LICENSE", "Some notes\nReleased under the MIT License.\nmore text here"),
    (2, "a/b/c/x.txt", "nothing of the kind"),
    (3, "a/b/LICENSE", "Licensed under the Apache License, Version 2.0"),
    (4, "a/b/y.txt", None),
    (5, "z/y.txt", "the of and the of and this is the work"),
    (6, "a/q.txt", ""),
    (7, "plain.txt", "Licensed under CC BY-NC 4.0."),
    (8, None, "x"),
    (9, "a/b/c/d/e/deep.txt", "word " * 20_000),
    (2, "a/b/c/x.txt", "nothing of the kind"),
    (10, "ab/x.txt", "a directory whose name only begins alike"),
    (11, "g/COPYING", "This work is licensed under the\nGNU General Public License, version 3"),
    (12, "a/LICENSE2", "Licensed under CC BY-NC 4.0."),
    (1, "a/LICENSE", "Some notes\nReleased under the MIT License.\nmore text here"),
]


def tokens(text):
    return re.findall("[a-z0-9]+", text.lower())


def own(rows, least=0.7):
    """Best license and score per row, by comparing every unit with every template."""
    templates = {k: Counter(tokens(v)) for k, v in s.TEMPLATES.items()}
    vocabulary = {w for t in templates.values() for w in t}
    units = []
    for i, (_, _, text) in enumerate(rows):
        lines = (text or "").split("\n") if text is not None else []
        units += [(i, tokens(x)) for x in (lines + [text] if len(lines) > 1 else lines)]
    n = sum(len((t or "").split("\n")) + (len((t or "").split("\n")) > 1) for _, _, t in rows if t is not None)
    df = Counter(w for _, ws in units for w in set(ws) if w in vocabulary)
    idf = {w: math.log((1 + n) / (1 + df[w])) + 1 for w in vocabulary}
    other = math.log(1 + n) + 1
    best = {}
    for i, ws in units:
        tf = Counter(w for w in ws if w in vocabulary)
        norm = math.sqrt(sum((c * idf[w]) ** 2 for w, c in tf.items()) + (len(ws) - sum(tf.values())) * other**2)
        for name, t in templates.items():
            dot = sum(c * t[w] * idf[w] ** 2 for w, c in tf.items())
            if dot:
                score = round(dot / norm / math.sqrt(sum((c * idf[w]) ** 2 for w, c in t.items())), 6)
                if score >= least and (-score, name) < best.get(i, (0, "")):
                    best[i] = (-score, name)
    return {i: (name, -score) for i, (score, name) in best.items()}


def scanned(spark, rows, **options):
    files = spark.createDataFrame([(*r, "x", "y") for r in rows], "id bigint, path string, text string, row string, license string")
    return s.scan_licenses(files, s.template_table(spark), "id", **options).collect()


def test_equals_comparing_everything(spark):
    got = scanned(spark, ROWS)
    want = own(ROWS)
    assert {want[0][0], want[2][0], want[6][0], want[11][0]} == {"MIT", "Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0"}
    expected = sorted(((r[0], want.get(i, (None, None))[0], want.get(i, (None, None))[1]) for i, r in enumerate(ROWS)), key=str)
    assert sorted(((r.id, r.own_license, r.own_score) for r in got), key=str) == expected


def test_nearest_directory(spark):
    got = {r.id: (r.license, r.inherited_from) for r in scanned(spark, ROWS)}
    assert got[1] == ("MIT", None) and got[3] == ("Apache-2.0", None)
    assert got[2] == ("Apache-2.0", "a/b") and got[4] == ("Apache-2.0", "a/b") and got[9] == ("Apache-2.0", "a/b")
    assert got[6] == ("MIT", "a") and got[12] == ("CC-BY-NC-4.0", None)
    assert got[5] == got[8] == got[10] == (None, None)


def test_only_some_files_speak(spark):
    got = {r.id: r.license for r in scanned(spark, ROWS, speaks=F.col("path").endswith("/LICENSE2"))}
    assert got[2] == got[6] == "CC-BY-NC-4.0"


def test_common_words_alone_match_no_template():
    weights = [("the", 90, 1.1), ("of", 80, 1.2), ("rare", 2, 4.0), ("odd", 1, 4.5)]
    templates = {"t": {"the": 1, "of": 1, "rare": 1, "odd": 1}}
    # The first three words together are a little less than 0.7 of the template, so a match needs "odd".
    assert s.distinctive(weights, templates, 0.7) == ["odd"]
    assert s.distinctive(weights, templates, 0.6) == ["odd", "rare"]
    assert s.distinctive(weights, {"t": {"the": 1}}, 0.7)[-1] == "the"


def test_no_python_in_the_plan(spark):
    files = spark.createDataFrame(ROWS, "id bigint, path string, text string")
    plan = s.scan_licenses(files, s.template_table(spark), "id")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("templates", [None, {}])
def test_empty_tables(spark, templates):
    files = spark.createDataFrame(ROWS, "id bigint, path string, text string")
    table = s.template_table(spark, templates)
    got = s.scan_licenses(files if templates == {} else files.limit(0), table, "id").collect()
    assert all(r.license is None for r in got) and len(got) == (len(ROWS) if templates == {} else 0)
