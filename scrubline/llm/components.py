"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.storage import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest id around each centre; ``edges`` hold u, v."""
    around = edges if not large else edges.union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v")
    if not large:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = around.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("_m"))
    low = low.select("c", F.least("c", "_m").alias("m"))
    met = around.join(low, F.col("u") == F.col("c"))
    if large:
        out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select(F.col("c").alias("u"), F.col("m").alias("v"))
        )
    return out.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every id of ``links(a, b)``; the component is its smallest id.

    Each round writes its edges to the shared folder.  Stops when a round changes nothing,
    so chains of any length come out whole; rounds grow with the logarithm of their length.
    """
    edges = stored(links.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
    seen = None
    while True:
        edges = stored(_stars(_stars(edges, True), False))
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == seen or not state[0]:
            break
        seen = state
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
