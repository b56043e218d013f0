"""Connected components of a link table, wholly on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm.common import written


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(v, root)`` for every vertex of ``links(u, v)``; root is the smallest vertex of its component.

    Large-star / small-star: every round hangs each vertex's larger
    neighbours, then its smaller ones, on its smallest neighbour, until only
    stars are left (a number of rounds logarithmic in the vertices). Each
    round is written, so a round never recomputes the ones before it; a hub's
    many edges are a skewed join side that is split at run time.
    """
    edges = written(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges"
    )
    state = None
    for _ in range(max_rounds):
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct()
        )
        edges = written(small, "edges")
        # an order-free fingerprint of the edge set: one row to the driver
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == state:
            roots = edges.select(F.col("v").alias("root")).distinct()
            return edges.select(F.col("u").alias("v"), F.col("v").alias("root")).union(roots.select(F.col("root").alias("v"), "root"))
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
