"""Bands, rings and levels of detail over cells with adjacency pairs (a, b)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlab.plans.materialize import cut

#: Fixed: zoom range, ring width in cells and whether coarse parents are painted.
LOD = ((7, 14, 0, False), (5, 6, 1, False), (3, 4, 3, False), (0, 2, 0, True))


def sea_rings(values: DataFrame, pairs: DataFrame, universe: DataFrame, rings: int) -> DataFrame:
    """cell, value, ring: cells without a value take the least of their inner neighbours', ring by ring. universe: cell."""
    known = cut(values.select("cell", "value", F.lit(0).alias("ring")), "rings")
    for k in range(1, rings + 1):
        edge = known.filter(F.col("ring") == k - 1).select(F.col("cell").alias("a"), "value").join(pairs, "a").groupBy(F.col("b").alias("cell")).agg(F.min("value").alias("value"))
        new = cut(edge.join(universe, "cell", "left_semi").join(known, "cell", "left_anti").withColumn("ring", F.lit(k)), "rings")
        known = known.unionByName(new)
    return known


def rim_max(values: DataFrame, pairs: DataFrame, hops: int) -> DataFrame:
    """cell, value: the greatest value within so many hops."""
    for _ in range(hops):
        near = pairs.join(values.select(F.col("cell").alias("b"), "value"), "b").groupBy(F.col("a").alias("cell")).agg(F.max("value").alias("__m"))
        values = cut(values.join(near, "cell", "left").select("cell", F.greatest("value", F.coalesce("__m", "value")).alias("value")), "rim")
    return values


def cumulative(cells: DataFrame, top: int) -> DataFrame:
    """band, cell: each band's cells and those of all bands below, as a row for each band from the cell's own on."""
    return cells.filter("band >= 0").select(F.explode(F.sequence(F.col("band"), F.lit(top))).alias("level"), "cell", "band")


def band_rows(cells: DataFrame, edges: tuple[int, ...]) -> DataFrame:
    """band, max_minutes (null: open or unreachable), cells (count)."""
    limit = F.get(F.array(*map(F.lit, edges)), F.when(F.col("band") >= 0, F.col("band")))
    return cells.groupBy("band").agg(F.count(F.lit(1)).alias("cells")).withColumn("max_minutes", limit)
