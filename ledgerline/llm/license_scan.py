"""License scans with DataFrame functions alone.

Every line of a file, and the file as a whole, is compared with license templates by the cosine of sparse TF-IDF vectors. The
vocabulary is that of the templates; any other word of a text is a dimension of its own, with the weight of a word that
occurs nowhere. Document frequencies are counted over all units (lines and whole files). A unit whose words can't reach the
threshold is left out before any vector is built: words are taken as common, most frequent first, as long as no template
could be matched by them alone, and a unit needs a word that is not common.

A file's own license is its best match. A directory's license is that of the first file directly in it that has one
and may speak for it; every other file gets the license of the nearest directory above it that has one. Nearest directories
are found once per directory, by a join of each one's ancestors, and then joined to the files.

Nulls and odd rows: a null or empty text has no license of its own; a null path has no directory and inherits nothing;
ties go to the license that sorts first; repeated rows each get a row; an empty table gives no rows; no template, no
license.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.scratch import stored

#: Short texts by which licenses are declared.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def template_table(spark: SparkSession, templates: dict[str, str] | None = None) -> DataFrame:
    rows = sorted((TEMPLATES if templates is None else templates).items())
    return spark.createDataFrame(rows, "license string, text string")


def words_of(text: str) -> Column:
    """Runs of ASCII letters and digits in lower case."""
    return F.filter(F.split(F.regexp_replace(F.lower(F.col(text)), "[^a-z0-9]+", " "), " "), lambda w: w != "")


def units(files: DataFrame, text: str) -> DataFrame:
    """``row, unit, words``: every line and, as unit -1, the whole text where it has several lines."""
    lines = F.split(F.col(text), "\n")
    split = files.select("row", text).select("row", F.posexplode(F.when(F.size(lines) > 1, F.array_append(lines, F.col(text))).otherwise(lines)).alias("unit", "line"))
    return split.select("row", "unit", words_of("line").alias("words")).filter(F.size("words") > 0)


def _weights(vocabulary: DataFrame, counted: DataFrame, n_units: int) -> DataFrame:
    """``word, df, idf`` of every template word."""
    known = vocabulary.select("word").distinct().join(counted, "word", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    return known.withColumn("idf", F.log((1 + F.lit(float(n_units))) / (1 + F.col("df"))) + 1)


def distinctive(weights: list[tuple[str, int, float]], templates: dict[str, dict[str, int]], least: float) -> list[str]:
    """Template words without the most frequent ones, which alone can match no template to ``least``."""
    idf = {w: i for w, _, i in weights}
    norm = {t: sum((n * idf[w]) ** 2 for w, n in words.items()) for t, words in templates.items()}
    common: set[str] = set()
    for word, _, _ in sorted(weights, key=lambda x: (-x[1], x[0])):
        trial = common | {word}
        if any(sum((n * idf[w]) ** 2 for w, n in ws.items() if w in trial) >= 0.999 * least**2 * norm[t] for t, ws in templates.items()):
            break
        common = trial
    return sorted(set(idf) - common)


def own_licenses(files: DataFrame, templates: DataFrame, text: str = "text", least: float = 0.7) -> DataFrame:
    """``row, license, score`` of the files that declare one; ``files`` has a unique column ``row``."""
    vocabulary = templates.select("license", F.explode(words_of("text")).alias("word"))
    vocabulary = stored(vocabulary.groupBy("license", "word").agg(F.count(F.lit(1)).alias("tf")), "license-words")
    every = units(files, text)
    in_unit = every.select(F.explode(F.array_distinct("words")).alias("word"))
    counted = in_unit.join(vocabulary.select("word").distinct(), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    n_units = files.select(F.split(F.col(text), "\n").alias("l")).agg(F.sum(F.size("l") + F.when(F.size("l") > 1, 1).otherwise(0))).first()[0] or 0
    weights = stored(_weights(vocabulary, counted, n_units), "license-weights")
    # Both lists are as long as the templates, which are a parameter.
    per_template: dict[str, dict[str, int]] = {}
    for t, w, n in vocabulary.collect():
        per_template.setdefault(t, {})[w] = n
    rare = distinctive([tuple(r) for r in weights.select("word", "df", "idf").collect()], per_template, least)
    if not rare:
        return files.select("row", F.lit(None).cast("string").alias("license"), F.lit(None).cast("double").alias("score")).limit(0)
    near = every.filter(F.arrays_overlap("words", F.array(*[F.lit(w) for w in rare])))
    near = stored(near.dropDuplicates(["row", "unit"]), "license-units")
    other_idf = F.log(F.lit(1.0 + n_units)) + 1
    sized = near.select("row", "unit", "words", F.size("words").alias("n"))
    tf = sized.select("row", "unit", "n", F.explode("words").alias("word"))
    tf = tf.join(weights.select("word", "idf"), "word").groupBy("row", "unit", "n", "word", "idf").agg(F.count(F.lit(1)).alias("c"))
    tf = stored(tf, "license-tf")
    known = F.sum(F.col("c") * F.col("c") * F.col("idf") * F.col("idf"))
    length = tf.groupBy("row", "unit", "n").agg((known + (F.col("n") - F.sum("c")) * other_idf * other_idf).alias("norm2"))
    target = vocabulary.join(weights, "word")
    target_norm = target.groupBy("license").agg(F.sum(F.pow(F.col("tf") * F.col("idf"), 2)).alias("t2"))
    dots = tf.join(vocabulary, "word").groupBy("row", "unit", "license").agg(F.sum(F.col("c") * F.col("tf") * F.col("idf") * F.col("idf")).alias("dot"))
    scored = dots.join(length.select("row", "unit", "norm2"), ["row", "unit"]).join(target_norm, "license")
    scored = scored.withColumn("score", F.round(F.col("dot") / F.sqrt(F.col("norm2") * F.col("t2")), 6)).filter(F.col("score") >= least)
    best = scored.groupBy("row", "license").agg(F.max("score").alias("score"))
    top = best.groupBy("row").agg(F.max("score").alias("score"))
    tied = best.join(top.select(F.col("row").alias("r"), F.col("score").alias("s")), (F.col("row") == F.col("r")) & (F.col("score") == F.col("s")))
    return tied.groupBy("row").agg(F.min("license").alias("license"), F.max("score").alias("score"))


def ancestors(directory: str) -> Column:
    """``depth, above``: a directory and all those above it."""
    parts = F.split(F.col(directory), "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, F.lit(1), i), "/").alias("above")),
    )


def nearest_license(directories: DataFrame, declared: DataFrame) -> DataFrame:
    """``directory, inherited, inherited_from`` for the directories that have a declaring one at or above them.

    ``declared`` has one row per ``directory`` with its ``license``.
    """
    up = directories.select("directory", F.explode(ancestors("directory")).alias("a")).select("directory", "a.depth", "a.above")
    met = up.join(declared.select(F.col("directory").alias("above"), "license"), "above")
    top = met.groupBy("directory").agg(F.max(F.struct("depth", "above", "license")).alias("m"))
    return top.select("directory", F.col("m.license").alias("inherited"), F.col("m.above").alias("inherited_from"))


def scan_licenses(
    files: DataFrame, templates: DataFrame, key: str, path: str = "path", text: str = "text", speaks: Column | None = None, least: float = 0.7
) -> DataFrame:
    """``key, path, own_license, own_score, license, inherited_from`` of every file.

    ``speaks`` says which files may declare the license of their directory; by default any that has one.
    """
    may = F.lit(True) if speaks is None else F.coalesce(speaks, F.lit(False))
    rows = files.select(
        F.col(key).alias("key"), F.col(path).alias("path"), F.col(text).alias("text"), may.alias("speaks")
    ).withColumn("row", F.struct("key", "path", F.xxhash64("text").alias("td")))
    named = rows.withColumn("directory", F.when(F.col("path").contains("/"), F.regexp_extract("path", "^(.*)/[^/]*$", 1)))
    own = stored(own_licenses(rows.select("row", "text"), templates, "text", least), "own-licenses")
    facts = named.select("row", "directory", "speaks")
    joined = stored(
        facts.join(own.select(F.col("row").alias("r"), F.col("license").alias("own"), "score"), F.col("row").eqNullSafe(F.col("r")), "left").drop("r"),
        "files",
    )
    declaring = joined.filter(F.col("speaks") & F.col("own").isNotNull() & F.col("directory").isNotNull())
    declared = declaring.groupBy("directory").agg(F.min(F.struct("row.key", "row.path", "own")).alias("d"))
    declared = stored(declared.select("directory", F.col("d.own").alias("license")), "declared")
    found = nearest_license(joined.select("directory").filter(F.col("directory").isNotNull()).distinct(), declared)
    found = stored(found, "nearest")
    out = joined.join(found.withColumnRenamed("directory", "dir"), F.col("directory") == F.col("dir"), "left")
    return out.select(
        F.col("row.key").alias(key),
        F.col("row.path").alias(path),
        F.col("own").alias("own_license"),
        F.col("score").alias("own_score"),
        F.coalesce("own", "inherited").alias("license"),
        F.when(F.col("own").isNull(), F.col("inherited_from")).alias("inherited_from"),
    )
