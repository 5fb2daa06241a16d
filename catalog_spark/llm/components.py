"""Connected components by alternating star operations on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import forget, materialise


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Link the neighbours of each node ``u`` to the least node around it; ``both``: only the larger neighbours.

    Least nodes come from an aggregation with map-side combining and return by a join, whose hot keys adaptive
    execution splits; no node's neighbours are gathered in one task.
    """
    if both:
        near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge, ``root`` being the least node reachable.

    Rows with a null end and loops link nothing and give no node (callers keep lone nodes by a left join); repeated
    edges count once; an empty table gives no rows. The number of rounds is logarithmic; each round is written to
    the shared folder, so no lineage builds up, and so is the result.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    now = materialise(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        state = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == seen or state[0] == 0:
            out = materialise(now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v"), F.col("v")).distinct()))
            forget(now)
            return out
        seen = state
        then = materialise(_star(_star(now, True), False))
        forget(now)
        now = then
