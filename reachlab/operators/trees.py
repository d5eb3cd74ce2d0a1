"""Operators on shortest-path trees: (origin, node, d, prev) with prev null at roots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachlab.plans.materialize import cut

KEY = ["origin", "node"]


def doubled(tree: DataFrame, values: dict[str, Column], merge) -> DataFrame:
    """Pointer doubling: after k rounds every node's values cover 2^k steps up. merge(own, upper) joins two values by name."""
    names = list(values)
    state = cut(tree.select("origin", "node", F.col("prev").alias("up"), *[v.alias(n) for n, v in values.items()]), "tree")
    while not state.filter("up IS NOT NULL").isEmpty():
        upper = state.select("origin", F.col("node").alias("up"), F.col("up").alias("__up"), *[F.col(n).alias(f"__{n}") for n in names])
        joined = state.join(upper, ["origin", "up"], "left")
        state = cut(joined.select("origin", "node", F.col("__up").alias("up"), *[F.when(F.col("up").isNull(), F.col(n)).otherwise(merge(n, F.col(n), F.col(f"__{n}"))).alias(n) for n in names]), "tree")
    return state.drop("up")


def depth(tree: DataFrame) -> DataFrame:
    """origin, node, depth: steps to the root."""
    return doubled(tree, {"depth": F.col("prev").isNotNull().cast("int")}, lambda n, own, up: own + up)


def nearest_marked(tree: DataFrame, marked: Column) -> DataFrame:
    """origin, node, ancestor: the nearest marked node upwards, itself included; null if none is."""
    return doubled(tree, {"ancestor": F.when(marked, F.col("node"))}, lambda n, own, up: F.coalesce(own, up))


def path_sums(tree: DataFrame, values: dict[str, Column]) -> DataFrame:
    """origin, node and each value summed over the path from the root. A value belongs to the step into its node."""
    return doubled(tree, {n: F.when(F.col("prev").isNull(), F.lit(0.0)).otherwise(v) for n, v in values.items()}, lambda n, own, up: own + up)


def paths(tree: DataFrame) -> DataFrame:
    """origin, node, path: nodes from the root down to the node."""
    return doubled(tree, {"path": F.array("node")}, lambda n, own, up: F.concat(up, own))


def journey_legs(steps: DataFrame, kind: Column) -> DataFrame:
    """Legs of journeys: steps (journey, k, u, v, at_u, at_v) are grouped into runs of one kind if it is surface; flights and connections stand alone.

    Minutes are rounded at nodes, so that legs add up to the rounded total.
    """
    w = Window.partitionBy("journey").orderBy("k")
    s = steps.withColumn("kind", kind).withColumn("m", F.rint("at_v") - F.rint("at_u"))
    new = (F.col("kind") != "surface") | (F.coalesce(F.lag("kind").over(w), F.lit("")) != "surface")
    s = s.withColumn("__new", new.cast("int")).withColumn("leg", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    legs = s.groupBy("journey", "leg").agg(F.min("kind").alias("kind"), F.min_by("u", "k").alias("from_node"), F.max_by("v", "k").alias("to_node"), F.sum("m").cast("long").alias("minutes"))
    return legs


def representative(cells: DataFrame, parent: str, cell: str, minutes: str, centre: str | None = None) -> DataFrame:
    """One cell per parent: its centre child if there, else the fastest, the smaller id of equals."""
    fast = F.min(F.struct(F.coalesce(F.col(minutes), F.lit(float("inf"))).alias("m"), F.col(cell).alias("c")))
    middle = F.min(F.when(F.col(cell) == F.col(centre), F.col(cell))) if centre else F.lit(None)
    got = cells.groupBy(parent).agg(fast.alias("f"), middle.alias("mid"))
    return got.select(parent, F.coalesce(F.col("mid"), F.col("f.c")).alias("representative"))


def overrides(cells: DataFrame, reps: DataFrame, parent: str) -> DataFrame:
    """Cells whose journey differs from their representative's: other airport, 15 minutes more or less by rail or ferry, another zone, or over an hour and half as long again."""
    r = reps.select(parent, *[F.col(x).alias(f"r_{x}") for x in ("airport", "rail", "ferry", "zone", "minutes")])
    j = cells.join(r, parent)
    differs = ~F.col("airport").eqNullSafe(F.col("r_airport")) | (F.abs(F.col("rail") - F.col("r_rail")) >= 15) | (F.abs(F.col("ferry") - F.col("r_ferry")) >= 15) | (F.col("zone") != F.col("r_zone"))
    gap = F.abs(F.col("minutes") - F.col("r_minutes"))
    return j.filter(F.coalesce(differs, F.lit(False)) | ((gap > 60) & (gap > 0.5 * F.col("r_minutes"))))


def tie_set(rides: DataFrame, keys: list[str], minutes: str, name: str, step: float = 0.01) -> DataFrame:
    """The names whose minutes, in units of step, are the least of their hop, sorted."""
    q = rides.withColumn("__q", F.rint(F.col(minutes) / step))
    low = q.groupBy(*keys).agg(F.min("__q").alias("__low"))
    return q.join(low, keys).filter("__q = __low").groupBy(*keys).agg(F.array_sort(F.collect_set(name)).alias("names"), F.min(minutes).alias(minutes))
