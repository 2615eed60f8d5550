"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import computed_once


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``v, root`` for every vertex of ``edges(v, u)``: the root is the smallest vertex of its component.

    Null and looping edges are ignored.  Each round is two aggregations joined back; hubs are met by map-side
    combination and split joins.  Every round is a written table, so lineage stays short.
    """
    edges = computed_once(edges.where("v IS NOT NULL AND u IS NOT NULL AND v <> u").select("v", "u").distinct(), "edges")
    mark = None
    for _ in range(rounds):
        both = edges.select("v", "u").unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.where("v <> u").distinct()
        down = large.select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u"))
        least = down.groupBy("v").agg(F.min("u").alias("m"))
        small = down.join(least, "v").select("v", "u", "m")
        edges = computed_once(
            small.select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(small.select("v", F.col("m").alias("u"))).where("v <> u").distinct(), "edges",
        )
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("h")).first()
        if mark == tuple(now):
            break
        mark = tuple(now)
    stars = edges.select("v", F.col("u").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("v"), "root").distinct()).distinct()
