"""Connected components of a graph that is a DataFrame of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept


def components(edges: DataFrame) -> DataFrame:
    """node and root, the least node connected with it, for edges (a, b) with a != b.

    Each step links every node's neighbours to the least of them, first to the larger side and
    then to the smaller; it ends when a step changes nothing, after about log(n) steps. Every step
    is a written table.
    """
    links = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    links, before = kept(links, "components"), None
    while (now := _mark(links)) != before:
        before = now
        both = links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("least"))
        large = both.join(least, "node").filter(F.col("root") > F.col("node")).select(
            F.col("root").alias("node"), F.least("least", "node").alias("root")
        ).distinct()
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node")
        links = kept(
            small.filter(F.col("root") != F.col("least"))
            .select(F.col("root").alias("node"), F.col("least").alias("root"))
            .unionByName(least.withColumnRenamed("least", "root"))
            .distinct(),
            "components",
        )
    return links


def _mark(links: DataFrame) -> tuple:
    """Tells whether two sets of links are the same."""
    return tuple(links.agg(
        F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("root", "node"))
    ).first())
