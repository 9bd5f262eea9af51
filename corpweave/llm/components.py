"""Connected components of an edge table, as rounds of joins; nothing but a count reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave.llm.common import stored

MOST_ROUNDS = 60


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node reachable.

    ``edges`` has the columns a and b, of one orderable type. Alternating star rounds: every node links its larger
    neighbours (large star), then its smaller ones (small star), to the smallest node it sees. The smallest is a
    minimum with partial aggregation, and a hub's edges are joined to it by an equi-join that adaptive execution may
    split, so no hub is gathered in one task. Each round is written to the shared folder, which cuts the lineage.
    Self-loops, repeated edges and either direction are fine; null ends are left out.
    """
    links = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    links = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    links = stored(links, name)
    before = None
    for _ in range(MOST_ROUNDS):
        links = stored(_star(_star(links, large=True), large=False), name)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if state == before:
            return links
        before = state
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (node, root) with root <= node, after one star round."""
    both = links.select(F.col("node").alias("n"), F.col("root").alias("v"))
    if large:
        both = both.unionAll(links.select(F.col("root").alias("n"), F.col("node").alias("v")))
    least = both.groupBy("n").agg(F.least(F.min("v"), F.first("n")).alias("m"))
    joined = both.join(least, "n")
    if large:
        out = joined.where("v >= n").select(F.col("v").alias("node"), F.col("m").alias("root"))
        own = least.select(F.col("n").alias("node"), F.col("m").alias("root"))
    else:
        out = joined.select(F.col("v").alias("node"), F.col("m").alias("root"))
        own = least.select(F.col("n").alias("node"), F.col("m").alias("root"))
    return out.unionAll(own).distinct()
