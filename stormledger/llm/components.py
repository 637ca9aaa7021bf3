"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormledger.storage import durable


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Tie the neighbours of every node to the smallest of them and itself.

    Large stars tie the neighbours above the node, small stars those below and itself.
    """
    if larger:
        sides = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    met = sides.join(least, "a")
    if larger:
        made = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        made = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return made.where("a <> b").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root): every node of an edge (a, b) with the smallest node it reaches.

    Large and small stars in turn (Kiveris et al.) until nothing changes; each round writes
    its edges, so a lost executor costs one round. Hot nodes are thinned by partial
    aggregation, and their join is split by adaptive execution.
    """
    edges = durable(edges.where("a <> b").select("a", "b").distinct())
    before = None
    while True:
        edges = durable(_star(_star(edges, True), False))
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            tops = edges.select("b", "b").distinct()
            return edges.union(tops).toDF("node", "root")
        before = now
