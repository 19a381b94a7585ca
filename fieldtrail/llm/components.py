"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, keep


def _star(both: DataFrame, larger_only: bool) -> DataFrame:
    """``both`` has each node u_ with its neighbours v_. Links the chosen neighbours to the smallest of u_ and them."""
    least = both.groupBy("u_").agg(F.min("v_").alias("m_")).withColumn("m_", F.least("u_", "m_"))
    joined = both.join(least, "u_")
    if larger_only:
        return joined.where("v_ > u_").select(F.col("v_").alias("u_"), F.col("m_").alias("v_"))
    own = least.where("u_ <> m_").select("u_", F.col("m_").alias("v_"))
    return joined.where("v_ <> m_").select(F.col("v_").alias("u_"), F.col("m_").alias("v_")).unionByName(own)


def components(links: DataFrame) -> DataFrame:
    """node_, component_ (its smallest node) for every node of ``links`` (a_, b_).

    Each round shrinks the paths to a smallest node, so their number follows the logarithm of the longest path. The
    links are never gathered by node; the join of a node with a third of all links can be split.
    """
    links = keep(
        links.where("a_ <> b_").select(F.greatest("a_", "b_").alias("u_"), F.least("a_", "b_").alias("v_")).distinct()
    )
    before = None
    while True:
        swapped = links.select(F.col("v_").alias("u_"), F.col("u_").alias("v_"))
        large = _star(links.unionByName(swapped), True).where("u_ <> v_").distinct()
        # In the small step, each node sees its smaller neighbours only.
        small = keep(_star(large, False).where("u_ <> v_").distinct())
        now = small.agg(F.count("*"), F.sum(F.hash("u_", "v_").cast("long")), F.max("u_")).first()
        discard(links)
        links = small
        if now == before:
            break
        before = now
    roots = links.select(F.col("v_").alias("node_"), F.col("v_").alias("component_")).distinct()
    return links.select(F.col("u_").alias("node_"), F.col("v_").alias("component_")).unionByName(roots)
