"""Connected components of a link table, distributed (alternating large-star and small-star steps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeweave.llm.common import if_small, materialize

#: Rows up to which a step's moves are broadcast (some 40 MB); beyond, they are joined by a shuffle of two written tables, whose hot keys adaptive execution splits.
MOST_SENT = 1_000_000


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` of any type that has an order to ``(id, component)`` for every linked id; the component is its smallest id.

    Edges point from the larger to the smaller id.  A step only has to know the vertices that move something: for a large-star those that are
    both a smaller and a larger end, for a small-star those with several smaller neighbours.  They come from map-side combined groups, so a hub
    costs a row a task, and the hub's own edges stay where they are.  When no vertex moves, the edges are a forest of stars.
    The table is written in the shared folder in each round; rounds grow with the logarithm of the longest chain.
    """
    edges = materialize(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        below = edges.groupBy("a").agg(F.min("b").alias("m"))
        inner = materialize(below.join(edges.select(F.col("b").alias("a")).distinct(), "a").withColumnsRenamed({"a": "u"}), "inner")
        over = not inner.isEmpty()
        if over:
            moved = edges.join(if_small(inner, F.lit(0), MOST_SENT), F.col("b") == F.col("u"), "left")
            edges = materialize(moved.select("a", F.coalesce("m", "b").alias("b")).distinct(), "edges")
        many = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        many = materialize(many, "many")
        if many.isEmpty():
            if not over:
                break
            continue
        moved = edges.join(if_small(many, F.lit(0), MOST_SENT), F.col("a") == F.col("u"), "left")
        edges = materialize(moved.select(F.when(F.col("m") < F.col("b"), F.col("b")).otherwise(F.col("a")).alias("a"), F.coalesce("m", "b").alias("b")).distinct(), "edges")
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
