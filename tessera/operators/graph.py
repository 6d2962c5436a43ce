"""Link ranking (PageRank) as an iterated join + aggregate.

Per iteration: ``edges(src, dst, out_degree) JOIN ranks ON src`` gives each edge
its contribution ``rank / out_degree``; contributions are summed per ``dst`` with
a partial aggregate (a node with a third of all in-links is one row per task
before the shuffle). Hubs -- sources with more than a thousandth of all edges, so
fewer than a thousand -- get their rank by broadcast, and their edges stay spread
over all tasks; all other edges are partitioned on ``src`` once and keep that
partitioning over the rounds (``tessera.operators.skew``).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.skew import HotKeys, hot_keys, join_by_key
from tessera.session import checkpoint

# Damping and base of the update rank = BASE + DAMPING * sum(contributions).
DAMPING = 0.85
BASE = 0.15


def out_links(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct edges with the out-degree of their source: ``(src, dst, deg)``."""
    links = checkpoint(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct())
    return _with_degree(links, hot_keys(links, "src"))


def _with_degree(links: DataFrame, hubs: HotKeys) -> DataFrame:
    return join_by_key(links, links.groupBy("src").agg(F.count(F.lit(1)).alias("deg")), "src", hubs)


def pagerank(edges: DataFrame, iterations: int, src: str = "src", dst: str = "dst",
             keep_all_nodes: bool = False, checkpoint_every: int = 2) -> DataFrame:
    """``(node, rank)`` after ``iterations`` rounds.

    Default semantics of the classic example: every node with out-links starts at
    1.0; after a round only nodes that *receive* a contribution have a rank
    (nodes without in-links drop out; nodes without out-links keep a rank but
    pass nothing on). ``keep_all_nodes=True`` gives every node ``BASE`` at least.
    Lineage is cut with a reliable checkpoint every ``checkpoint_every`` rounds.

    """
    links = checkpoint(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).distinct())
    hubs = hot_keys(links, "src").keys
    degrees = checkpoint(links.groupBy("src").agg(F.count(F.lit(1)).alias("deg")))
    # the edges of hubs as they lie, the others partitioned on src, both for all rounds
    of_hubs = links.join(F.broadcast(degrees.join(F.broadcast(hubs), "src", "left_semi")), "src").persist(StorageLevel.MEMORY_AND_DISK)
    others = links.join(F.broadcast(hubs), "src", "left_anti").join(degrees, "src").persist(StorageLevel.MEMORY_AND_DISK)
    ranks = degrees.select("src", F.lit(1.0).alias("rank"))
    nodes = None
    if keep_all_nodes:
        nodes = checkpoint(links.select(F.col("src").alias("node"))
                           .union(links.select(F.col("dst").alias("node"))).distinct())  # once, not per round
    for it in range(iterations):
        of_round = ranks.join(F.broadcast(hubs), "src", "left_semi")  # fewer than a thousand rows
        joined = of_hubs.join(F.broadcast(of_round), "src").unionByName(others.join(ranks, "src"))
        contribs = joined.select(F.col("dst").alias("node"), (F.col("rank") / F.col("deg")).alias("c"))
        summed = contribs.groupBy("node").agg(F.sum("c").alias("s"))
        if keep_all_nodes:
            summed = nodes.join(summed, "node", "left").fillna(0.0, subset=["s"])
        ranks = summed.select(F.col("node").alias("src"), (F.lit(BASE) + F.lit(DAMPING) * F.col("s")).alias("rank"))
        if checkpoint_every and (it + 1) % checkpoint_every == 0 and it + 1 < iterations:
            ranks = checkpoint(ranks)
    ranks = checkpoint(ranks.withColumnRenamed("src", "node"))  # one row per node, written to the shared folder
    of_hubs.unpersist()
    others.unpersist()
    return ranks
