"""Query for ranked lexical search and the same as SQL."""

from __future__ import annotations

import os
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import lexical
from ledgerline.llm.text_cases import documents


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    items = spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))
    index = lexical.build_index(documents(spark, sf_dir))
    return lexical.search(index, items, k=50).withColumnRenamed("doc", "doc_id")


def _terms(table: str, key: str) -> str:
    return f"SELECT {key}, regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), '{lexical.TERM}') AS w FROM {table}"


SEARCH_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, w, len(w) AS n FROM ({_terms("documents", "doc_id")}) WHERE len(w) > 0),
corpus AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS l FROM d),
p AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
f AS (SELECT t, floor(1000 * ln((2.0::DOUBLE * nn + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM p, corpus GROUP BY t, nn),
q AS (SELECT DISTINCT item_id, unnest(w) AS t FROM ({_terms("benchmark", "item_id")})),
m AS (SELECT r, doc_id, 50 + (50 * n * nn) // l AS m FROM d, corpus),
s AS (
  SELECT q.item_id, m.doc_id, m.r, sum(f.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * m.m)))::BIGINT AS score
  FROM q JOIN p USING (t) JOIN f USING (t) JOIN m USING (r) GROUP BY q.item_id, m.doc_id, m.r
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50
"""

QUERIES = {"op11_ranked_search": ranked_search}
ORACLE = {"op11_ranked_search": SEARCH_SQL}
