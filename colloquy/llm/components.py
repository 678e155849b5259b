"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, discard, release


def components(links: DataFrame) -> DataFrame:
    """(node, component): every node of the links (a, b), and the smallest node
    it is connected with.

    Large stars and small stars alternate until nothing changes: each joins a
    node's neighbours to the smallest one, which at least halves the distance
    to it. Work and shuffles are linear in the links; a node with very many
    links is aggregated before it is shuffled, and its join can be split. Links
    may repeat and come in either direction; nulls are not links."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = written(links.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
                        .select(high.alias("u"), low.alias("v")).distinct())
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        discard(large)
        discard(edges)
        edges = after
        release(edges.sparkSession)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, which itself has none."""
    roles = edges.select("u", F.lit(1).alias("below")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("below")))
    held = roles.groupBy("u").agg(F.sum("below").alias("below"), F.min("below").alias("above"))
    return held.where("below > 1 OR below = 1 AND above = 0").isEmpty()


def written(df: DataFrame) -> DataFrame:
    """``cut_lineage`` with about two files for each core: link tables are small
    beside the documents, and every later step starts as many tasks."""
    return cut_lineage(df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism))
