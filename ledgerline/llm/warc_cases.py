"""Query for web archives."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import warc
from ledgerline.llm.scratch import new_path


def warc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back: digests and sizes of responses from the payloads that were read."""
    pages = spark.read.parquet(os.path.join(sf_dir, "pages.parquet"))
    folder = new_path(spark, "warc")
    warc.write_warc(warc.page_records(pages, date="2024-01-01T00:00:00Z"), folder)
    responses = warc.read_warc(spark, folder).filter(F.col("record_type") == "response").withColumns(
        {"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("bigint")}
    )
    revisits = warc.read_warc(spark, folder, payload=False).filter(F.col("record_type") == "revisit")
    columns = [
        warc.page_key("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_key("refers_to").alias("refers_to"),
    ]
    return responses.select(*columns).unionByName(revisits.select(*columns))


WARC_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages
),
g AS (SELECT d, max(page_id) AS newest FROM p WHERE n >= 1000 GROUP BY d)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.d AS payload_digest,
  CASE WHEN g.newest IS NULL OR g.newest = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN g.newest <> p.page_id THEN g.newest END AS refers_to
FROM p LEFT JOIN g ON g.d = p.d AND p.n >= 1000
"""

QUERIES = {"op1_warc_pages": warc_pages}
ORACLE = {"op1_warc_pages": WARC_SQL}
