"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for each node on an edge; ``root`` is the least node of its component.

    Large-star and small-star rounds (Kiveris et al. 2014): every node points its larger, then its smaller neighbours at
    the least one it knows, until nothing changes. A round is two aggregations with a join each and is
    written to the shared folder, so lineage stays short. No group of neighbours is ever gathered.
    """
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    now = materialize(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        now = materialize(small.filter("u <> v").distinct(), "edges")
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
