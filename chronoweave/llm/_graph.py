"""Connected components by alternating large and small stars (Kiveris et al., 2014), as joins and minimum aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import release, written

#: Edges that a file of a round holds, about.
ROWS = 200_000


def components(edges: DataFrame, src: str, dst: str, most_rounds: int = 60) -> tuple[DataFrame, int]:
    """One row (``id``, ``component``) for every vertex with an edge, and at least their number; component: its smallest vertex.

    Vertices are longs. Edges may repeat, run either way and be loops; they are read several times, so pass a written table.
    Neighbour lists are never gathered: each star is a minimum (pre-aggregated before the shuffle) joined back, so a hub's edges
    can be split by adaptive skew joins.
    """
    a, b = F.col(src), F.col(dst)
    e, n = edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")), None
    for _ in range(most_rounds):
        # done when every vertex hangs on exactly one root: none has two parents, and none is parent and child
        ends = e.select(F.col("u").alias("x"), F.col("v").alias("parent"), F.lit(0).alias("inner")).unionByName(e.select(F.col("v").alias("x"), F.lit(None).cast("long").alias("parent"), F.lit(1).alias("inner")))
        ends = ends.groupBy("x").agg(F.min("parent").alias("lo"), F.max("parent").alias("hi"), F.max("inner").alias("inner"))
        found = ends.agg(F.count("*").alias("n"), F.count_if((F.col("lo") < F.col("hi")) | F.col("lo").isNotNull() & (F.col("inner") == 1)).alias("open")).first()
        if not found["open"]:
            break
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, (e, n) = (e if n is not None else None), written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc", found["n"] // ROWS + 1)
        if before is not None:
            release(before)
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct(), found["n"]
