"""Graph assembly, shortest paths, components, levels and digests."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlab.plans.materialize import cut

#: Edges up to which the local strategy sends the graph to each task.
LOCAL_EDGES = 5_000_000


def assemble(builders: list[DataFrame], exclude: str | None = None) -> DataFrame:
    """Union of edge lists (src, dst, w, mode), less an excluded mode. Bad weights and repeated pairs are errors, never merged."""
    edges = reduce(lambda a, b: a.unionByName(b), builders)
    if exclude is not None:
        edges = edges.filter(F.col("mode") != exclude)
    edges = cut(edges, "edges")  # read for the check and again by the caller
    bad = edge_faults(edges).first()
    if bad["duplicates"] or bad["bad_weights"]:
        raise ValueError(f"{bad['duplicates']} repeated pairs, {bad['bad_weights']} weights that are not positive numbers")
    return edges


def edge_faults(edges: DataFrame) -> DataFrame:
    per = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("w").isNull() | F.isnan(F.col("w").cast("double")) | (F.col("w") <= 0) | (F.col("w") == float("inf"))).cast("long")).alias("bad"))
    return per.agg(F.coalesce(F.sum((F.col("n") > 1).cast("long")), F.lit(0)).alias("duplicates"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_weights"))


def shortest_paths(edges: DataFrame, sources: DataFrame, limit: float | None = None, strategy: str = "auto") -> DataFrame:
    """origin, node, d, prev of all nodes that each origin reaches (within limit); a source has no prev.

    edges: src, dst, w > 0, one per pair. sources: origin, node; several nodes of an origin start together. prev is the
    smallest node on a shortest path's last step. "local" sends the graph to the tasks, an origin's solve in one task, and is
    taken up to LOCAL_EDGES edges; "frontier" relaxes all origins' frontiers by joins and has no bound but the rounds.
    """
    e = cut(edges.select("src", "dst", F.col("w").cast("double").alias("w")), "edges")  # every round reads it
    if strategy == "auto":
        strategy = "local" if e.limit(LOCAL_EDGES + 1).count() <= LOCAL_EDGES else "frontier"
    best = _local(e, sources, limit) if strategy == "local" else _frontier(e, sources, limit)
    best = cut(best, "sp")
    a = best.select("origin", F.col("node").alias("src"), F.col("d").alias("da"))
    b = best.select("origin", F.col("node").alias("dst"), F.col("d").alias("db"))
    prev = a.join(e, "src").join(b, ["origin", "dst"]).filter(F.abs(F.col("da") + F.col("w") - F.col("db")) <= 1e-9 * F.greatest(F.col("db"), F.lit(1.0)))
    prev = prev.groupBy("origin", F.col("dst").alias("node")).agg(F.min("src").alias("prev"))
    # weights are positive, so what is at distance 0 is a source and has no step before it
    out = best.join(prev, ["origin", "node"], "left")
    return out.select("origin", "node", "d", F.when(F.col("d") > 0, F.col("prev")).alias("prev"))


def _local(edges: DataFrame, sources: DataFrame, limit: float | None) -> DataFrame:
    rows = edges.toPandas()  # LOCAL_EDGES at most
    graph: dict = {}
    for s, t, w in zip(rows["src"].tolist(), rows["dst"].tolist(), rows["w"].tolist(), strict=True):
        graph.setdefault(s, []).append((t, w))
    shared = edges.sparkSession.sparkContext.broadcast(graph)

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        adjacent, done, heap = shared.value, {}, [(0.0, n) for n in set(group["node"].tolist())]
        heapq.heapify(heap)
        while heap:
            d, n = heapq.heappop(heap)
            if n in done or limit is not None and d > limit:
                continue
            done[n] = d
            for t, w in adjacent.get(n, ()):
                if t not in done:
                    heapq.heappush(heap, (d + w, t))
        return pd.DataFrame({"origin": group["origin"].iloc[0], "node": list(done), "d": list(done.values())})

    kinds = dict(sources.dtypes)
    return sources.select("origin", "node").groupBy("origin").applyInPandas(solve, f"origin {kinds['origin']}, node {kinds['node']}, d double")


def _frontier(edges: DataFrame, sources: DataFrame, limit: float | None) -> DataFrame:
    best = cut(sources.select("origin", "node", F.lit(0.0).alias("d")).distinct(), "frontier")
    front = best
    while True:
        step = front.select("origin", F.col("node").alias("src"), "d").join(edges, "src").select("origin", F.col("dst").alias("node"), (F.col("d") + F.col("w")).alias("d"))
        if limit is not None:
            step = step.filter(F.col("d") <= limit)
        step = step.groupBy("origin", "node").agg(F.min("d").alias("d"))
        old = best.select("origin", "node", F.col("d").alias("__old"))
        front = cut(step.join(old, ["origin", "node"], "left").filter("__old IS NULL OR d < __old").select("origin", "node", "d"), "frontier")
        if front.isEmpty():
            return best
        best = cut(best.unionByName(front).groupBy("origin", "node").agg(F.min("d").alias("d")), "frontier")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) over undirected edges: labels flow to neighbours and jump to their labels' labels."""
    both = cut(edges.select(F.col("src").alias("a"), F.col("dst").alias("b")).unionByName(edges.select(F.col("dst").alias("a"), F.col("src").alias("b"))).filter("a <> b").distinct(), "cc")
    labels = cut(nodes.select("node", F.col("node").alias("component")), "cc")
    while True:
        low = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m"))
        step = labels.join(low, "node", "left").select("node", F.least("component", F.coalesce("m", "component")).alias("c1"))
        jump = step.select(F.col("node").alias("c1"), F.col("c1").alias("c2"))
        new = cut(step.join(jump, "c1", "left").select("node", F.least("c1", F.coalesce("c2", "c1")).alias("component")), "cc")
        if new.join(labels, ["node", "component"], "left_anti").isEmpty():
            return new
        labels = new


def levels(edges: DataFrame, seeds: DataFrame, depth: int | None = None) -> DataFrame:
    """node, level: hops from the seeds along directed edges, up to depth."""
    seen = cut(seeds.select("node", F.lit(0).alias("level")).distinct(), "bfs")
    front, k = seen, 0
    while depth is None or k < depth:
        k += 1
        front = front.select(F.col("node").alias("src")).join(edges.select("src", "dst"), "src").select(F.col("dst").alias("node")).distinct().join(seen, "node", "left_anti")
        front = cut(front.withColumn("level", F.lit(k)), "bfs")
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def degrees(edges: DataFrame) -> DataFrame:
    """node, out_degree, in_degree, neighbours (different ones, either way)."""
    ends = edges.select(F.col("src").alias("node"), F.col("dst").alias("o"), F.lit(1).alias("out"), F.lit(0).alias("inn")).unionByName(edges.select(F.col("dst").alias("node"), F.col("src").alias("o"), F.lit(0).alias("out"), F.lit(1).alias("inn")))
    per = ends.groupBy("node", "o").agg(F.sum("out").alias("out"), F.sum("inn").alias("inn"))
    return per.groupBy("node").agg(F.sum("out").alias("out_degree"), F.sum("inn").alias("in_degree"), F.count(F.lit(1)).alias("neighbours"))


def digest(edges: DataFrame) -> DataFrame:
    """One row that changes with any edge and with no order: count and two sums of independent hashes."""
    own = F.struct("src", "dst", F.col("w").cast("double").alias("w"))
    return edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(own).cast("decimal(38,0)")).alias("h1"), F.sum(F.xxhash64(F.lit(1), own).cast("decimal(38,0)")).alias("h2"))


def variant_faults(full: DataFrame, variant: DataFrame, eps: float = 1e-6) -> DataFrame:
    """How many nodes a graph with fewer edges reaches sooner than the full one (must be none), or reaches alone."""
    v = variant.select("origin", "node", F.col("d").alias("dv"))
    both = v.join(full.select("origin", "node", "d"), ["origin", "node"], "left")
    return both.agg(F.count(F.lit(1)).alias("compared"), F.coalesce(F.sum((F.col("d").isNull() | (F.col("dv") < F.col("d") - eps)).cast("long")), F.lit(0)).alias("faster"))
