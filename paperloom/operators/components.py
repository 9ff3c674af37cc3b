"""Connected components of an edge table by alternating large-star and small-star rounds, without a task for a whole hub."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import with_checkpoints

#: A node of more edges than this is a hub, whose edges stay where they are; there are at most ``HUBS``, which are broadcast.
HUB, HUBS = 1_000_000, 50_000


def _star(edges: DataFrame, hub: int | None) -> DataFrame:
    """Edges (u, v) with every u's smallest neighbour, itself included, as m.

    Minima are partial aggregates. They go to the edges by hash, but a hub's is broadcast: its edges, which one key would
    bring together, aren't moved. ``hub`` is None where there are too few edges for any.
    """
    if hub is None:
        least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        return edges.join(least, edges["u"] == least["k"]).select("u", "v", "m")
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"), "n")
    hubs = least.where(F.col("n") > hub).select(F.col("k").alias("hub"), F.col("m").alias("hub_m"))
    marked = edges.join(F.broadcast(hubs), edges["u"] == hubs["hub"], "left")
    near = marked.where("hub is not null").select("u", "v", F.col("hub_m").alias("m"))
    rest = marked.where("hub is null").select("u", "v")
    others = least.where(F.col("n") <= hub)
    return rest.join(others, rest["u"] == others["k"]).select("u", "v", "m").union(near)


def components(edges: DataFrame, store: Callable[[DataFrame], DataFrame] | None = None, hub: int = HUB, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long); root: the smallest node it reaches.

    Self-loops, repeated and reversed edges are allowed; rows with a null end are ignored.  Each round's table is cut from its lineage by
    ``store``, a checkpoint by default.
    """
    if store is None:
        with_checkpoints(edges.sparkSession)
        store = lambda df: df.checkpoint()
    edges, last = store(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()), None
    for _ in range(max_rounds):
        # Each edge is counted at both ends, so more than ``HUBS`` nodes can't have so many.
        ends = 2 * edges.count()
        least_hub = max(hub, ends // HUBS) if ends > hub else None
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, least_hub).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _star(large, least_hub)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = store(small.where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components didn't settle")
    nodes = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
