"""Connected components of an edge table, by alternating star contraction.

Each round links every node's larger neighbours to the smallest node it sees
(large star), then every node's smaller neighbours likewise (small star),
until the edges are stars around each component's smallest node.  The rounds
needed grow with the logarithm of the graph's size.  Every round is a few
shuffles of two-column rows, written to the shared folder; the driver sees a
count and a checksum only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import save


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node that has an edge to another node; label is
    the smallest node of its component.  Self edges, repeated edges and edges
    with a null end are ignored; no edges give an empty result."""
    x, y = F.col(a), F.col(b)
    now = save(edges.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
               .distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now, before = save(small, "edges"), mark
        mark = _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
