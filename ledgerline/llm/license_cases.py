"""Query for license scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import license_scan
from ledgerline.llm.text_cases import documents


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as files of a tree: document 1234 of a source is the file ``source/1/2/3/1234``."""
    digits = F.transform(F.sequence(F.lit(1), F.length("id") - 1), lambda i: F.substr(F.col("id"), i, F.lit(1)))
    path = F.array_join(
        F.concat(F.array(F.coalesce("source", F.lit("none"))), F.when(F.length("id") > 1, digits).otherwise(F.array().cast("array<string>")), F.array("id")), "/"
    )
    docs = documents(spark, sf_dir).withColumn("id", F.col("doc_id").cast("string")).withColumn("path", path)
    return license_scan.scan_licenses(docs, license_scan.template_table(spark), "doc_id")


_VALUES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in license_scan.TEMPLATES.items())

LICENSE_SQL = rf"""
WITH templates(license, text) AS (VALUES {_VALUES}),
vocab AS (
  SELECT license, word, count(*) AS tf
  FROM (SELECT license, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM templates) GROUP BY ALL
),
files AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, 'none') AS source, doc_id::VARCHAR AS id FROM documents
),
paths AS (
  SELECT doc_id, text, array_to_string(list_concat([source], [x FOR x IN string_split(id[1:length(id) - 1], '') IF x <> ''], [id]), '/') AS path,
    array_to_string(list_concat([source], [x FOR x IN string_split(id[1:length(id) - 1], '') IF x <> '']), '/') AS directory
  FROM files
),
raw AS (
  SELECT doc_id, unnest(range(len(l))) AS unit, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM files)
  UNION ALL SELECT doc_id, -1, text FROM files WHERE contains(text, chr(10))
),
units AS (SELECT doc_id, unit, regexp_extract_all(lower(line), '[a-z0-9]+') AS words FROM raw),
total AS (SELECT count(*)::DOUBLE AS n FROM raw),
tokens AS (SELECT doc_id, unit, len(words) AS n, unnest(words) AS word FROM units),
tf AS (
  SELECT doc_id, unit, n, word, count(*) AS c FROM tokens WHERE word IN (SELECT word FROM vocab) GROUP BY ALL
),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY word),
idf AS (
  SELECT v.word, ln((1 + (SELECT n FROM total)) / (1 + coalesce(df.df, 0))) + 1 AS idf
  FROM (SELECT DISTINCT word FROM vocab) v LEFT JOIN df ON df.word = v.word
),
norms AS (
  SELECT doc_id, unit, sum((c * idf) ** 2) + (any_value(n) - sum(c)) * (ln(1 + (SELECT n FROM total)) + 1) ** 2 AS norm2
  FROM tf JOIN idf USING (word) GROUP BY doc_id, unit
),
tnorms AS (SELECT license, sum((tf * idf) ** 2) AS t2 FROM vocab JOIN idf USING (word) GROUP BY license),
dots AS (
  SELECT doc_id, unit, license, sum(c * vocab.tf * idf * idf) AS dot FROM tf JOIN idf USING (word) JOIN vocab USING (word) GROUP BY ALL
),
scored AS (
  SELECT doc_id, license, max(round(dot / sqrt(norm2 * t2), 6)) AS score FROM dots JOIN norms USING (doc_id, unit) JOIN tnorms USING (license)
  GROUP BY doc_id, license
),
own AS (
  SELECT doc_id, license, score FROM scored WHERE score >= 0.7
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1
),
declared AS (
  SELECT directory, license FROM paths JOIN own USING (doc_id)
  QUALIFY row_number() OVER (PARTITION BY directory ORDER BY doc_id) = 1
),
near AS (
  SELECT p.doc_id, d.license, d.directory FROM paths p JOIN declared d ON starts_with(p.directory || '/', d.directory || '/')
  QUALIFY row_number() OVER (PARTITION BY p.doc_id ORDER BY length(d.directory) DESC) = 1
)
SELECT p.doc_id, p.path, own.license AS own_license, own.score AS own_score, coalesce(own.license, near.license) AS license,
  CASE WHEN own.license IS NULL THEN near.directory END AS inherited_from
FROM paths p LEFT JOIN own USING (doc_id) LEFT JOIN near ON near.doc_id = p.doc_id
"""

QUERIES = {"op2_license_scan": licenses}
ORACLE = {"op2_license_scan": LICENSE_SQL}
