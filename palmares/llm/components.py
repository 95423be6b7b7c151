"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame, u: str, v: str, max_rounds: int = 60) -> DataFrame:
    """Rows (node, root): every node of an edge and the least node it is linked with.

    Large and small stars alternate until the edges are stars around their roots; each round is
    written, so a lost executor costs a round at most. Loops and repeated edges count once;
    null ends are dropped. An empty edge table gives an empty result. Nodes can be of any orderable type.
    """
    kept = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v")
    kept = written(kept.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        # large star: neighbours above u go to the least node around u
        both = _both(kept)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: neighbours at or below u, and u, go to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        kept = written(moved.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        n, total = kept.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, total) == state:
            break
        state = (n, total)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = kept.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return kept.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
