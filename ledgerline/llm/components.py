"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.scratch import drop_path, new_path, write_table


def _is_stars(edges: DataFrame) -> bool:
    """Every node hangs on one other, and none hangs on a node that itself hangs on another."""
    if not edges.groupBy("u").count().filter("count > 1").isEmpty():
        return False
    hung = edges.select(F.col("u").alias("w"))
    return edges.join(hung, F.col("v") == F.col("w"), "left_semi").isEmpty()


def _nearest(rows: DataFrame, path: str) -> DataFrame:
    """The smallest neighbour of every node, as a table: joins against it can split a node with very many links."""
    return write_table(rows.groupBy("u").agg(F.min("v").alias("m")), path)


def connected_components(links: DataFrame, a: str, b: str, node: str = "node", component: str = "component") -> DataFrame:
    """``node, component`` for every node that has a link to another; the component is its smallest node.

    Large-star and small-star steps by turns: the first hangs all larger neighbours of a node on its smallest
    neighbour, the second does so with the smaller ones. Both keep the components and only lower the targets; when
    the links are stars, every node hangs on the smallest of its component. Steps are written to the checkpoint folder, and
    the tables of a finished step are dropped. Null ends and links of a node to itself are ignored; repeated
    links count once; no links give no rows.
    """
    spark = links.sparkSession
    x, y = F.col(a), F.col(b)
    first = links.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    at = new_path(spark, "links")
    edges = write_table(first, at)
    while not _is_stars(edges):
        near_at, large_at = new_path(spark, "near"), new_path(spark, "large")
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = _nearest(both, near_at)
        # A node's smallest neighbour may be larger than itself: then the neighbours hang on the node.
        target = F.least("m", "u")
        large = both.join(near, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), target.alias("v"))
        large = write_table(large.distinct(), large_at)
        small_near_at, small_at = new_path(spark, "near"), new_path(spark, "small")
        near = _nearest(large, small_near_at)
        moved = large.join(near, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = near.select("u", F.col("m").alias("v"))
        edges = write_table(moved.unionByName(hung).distinct(), small_at)
        for done in (at, near_at, large_at, small_near_at):
            drop_path(spark, done)
        at = small_at
    found = edges.select(F.col("u").alias(node), F.col("v").alias(component))
    roots = edges.select(F.col("v").alias(node), F.col("v").alias(component)).distinct()
    return found.unionByName(roots)
