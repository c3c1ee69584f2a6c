"""Query for the Merkle manifest and the same as SQL."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import merkle
from ledgerline.llm.text_cases import documents

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the root that a partly tampered copy leads to."""
    docs = documents(spark, sf_dir).select(*COLUMNS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    values = [F.col(c) for c in COLUMNS]
    other = F.when(tampered, merkle.leaf_digest([*values[:-1], lowered]))
    manifest = merkle.build(docs, F.col("source"), F.col("doc_id"), merkle.leaf_digest(values), other)
    return merkle.prove(manifest).withColumnRenamed("key", "doc_id")


#: Levels that the SQL unrolls: 16**5 leaves a group, and as many groups.
SQL_LEVELS = 5


def _tree_sql(name: str, leaves: str) -> str:
    """CTEs over ``leaves`` (g, i, d): the nodes of each level, and the siblings and place of each leaf at each level."""
    parts = [f"{name}_0 AS (SELECT g, i, d, count(*) OVER (PARTITION BY g) AS m FROM {leaves})"]
    for k in range(SQL_LEVELS):
        parts.append(f"""{name}_{k + 1} AS (
  SELECT g, i, d, count(*) OVER (PARTITION BY g) AS m FROM (
    SELECT g, i // 16 AS i, CASE WHEN max(m) > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE max(d) END AS d
    FROM {name}_{k} GROUP BY g, i // 16))""")
    for k in range(SQL_LEVELS):
        parts.append(f"""{name}_s{k} AS (
  SELECT a.g, a.i, max(a.m) AS m, coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l,
    coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r
  FROM {name}_{k} a JOIN {name}_{k} b ON a.g = b.g AND a.i // 16 = b.i // 16 GROUP BY a.g, a.i)""")
    return ",\n".join(parts)


def _climb(name: str, start: str, carried: str, place: str, group: str) -> tuple[list[str], str]:
    """CTEs that fold a column ``f`` and add the siblings to ``p``, level by level."""
    parts, before = [], start
    for k in range(SQL_LEVELS):
        parts.append(f"""{name}_c{k} AS (
  SELECT {carried}, c.p || CASE WHEN s.m > 1 THEN s.l || s.r ELSE '' END AS p,
    CASE WHEN s.m > 1 THEN sha256(s.l || c.f || s.r) ELSE c.f END AS f
  FROM {before} c JOIN {name}_s{k} s ON s.g = {group} AND s.i = {place} // {16**k})""")
        before = f"{name}_c{k}"
    return parts, before


def _sql() -> str:
    def field(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in (*COLUMNS[:-1], text)) + ")"

    bit = "xor(x >> 1, 3988292384 * (x & 1))"
    crc = (
        "xor(4294967295, list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),"
        f" lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)::UBIGINT[]), lambda x, y: {bit})))"
    )
    low = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"
    up, top = _climb("t", "started", "c.rid, c.doc_id, c.leaf, c.g, c.i", "c.i", "c.g")
    over, end = _climb("q", "grouped", "c.rid, c.doc_id, c.leaf, c.subroot, c.gi", "c.gi", "0")
    return f"""WITH hashed AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS g, {leaf("text")} AS leaf,
    CASE WHEN {crc} % 5 = 0 THEN {leaf(low)} END AS other
  FROM documents
),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM hashed),
tree AS (SELECT g, i, leaf AS d FROM leaves),
{_tree_sql("t", "tree")},
subroots AS (SELECT g, d, row_number() OVER (ORDER BY g) - 1 AS gi FROM t_{SQL_LEVELS}),
tops AS (SELECT 0 AS g, gi AS i, d FROM subroots),
{_tree_sql("q", "tops")},
started AS (SELECT rid, doc_id, leaf, g, i, '' AS p, coalesce(other, leaf) AS f FROM leaves),
{", ".join(up)},
grouped AS (SELECT c.*, s.d AS subroot, s.gi FROM {top} c JOIN subroots s USING (g)),
{", ".join(over)}
SELECT doc_id, leaf, subroot, r.d AS root, sha256(p) AS proof_sha256, f AS folded_root, f = r.d AS verified
FROM {end}, q_{SQL_LEVELS} r"""


QUERIES = {"op12_merkle_manifest": merkle_manifest}
ORACLE = {"op12_merkle_manifest": _sql()}
