"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b): root is the least node of its component. Alternates large-star
    and small-star rounds, whose tables are cut off in the shared folder, until the edges stand still."""
    now = materialise(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: smaller neighbours, and the node itself, point at the least of them
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(small, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a != b").distinct()
        now = materialise(star, "edges")
        # order-free sum of the edges: unchanged only at a fixed point
        sign = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == seen or sign[0] == 0:
            break
        seen = sign
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
