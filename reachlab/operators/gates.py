"""Validation gates: each gives one row (gate, ok, observed, bound)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row(df: DataFrame, gate: str, observed: Column, bound: float, at_least: bool) -> DataFrame:
    out = df.agg(F.round(F.coalesce(observed.cast("double"), F.lit(0.0)), 9).alias("observed")).withColumn("bound", F.lit(float(bound)))
    ok = F.col("observed") >= F.col("bound") if at_least else F.col("observed") <= F.col("bound")
    return out.select(F.lit(gate).alias("gate"), ok.alias("ok"), "observed", "bound")


def coverage(cells: DataFrame, reached: Column, counted: Column, least: float = 0.9) -> DataFrame:
    """Share of counted rows that are reached; of nothing it is 0."""
    return _row(cells.filter(counted), "coverage", F.avg(reached.cast("double")), least, True)


def relaxed(solved: DataFrame, edges: DataFrame, eps: float = 1e-6) -> DataFrame:
    """Edges that a solve should have used and did not: none may be left."""
    a = solved.select("origin", F.col("node").alias("src"), F.col("d").alias("da")).join(edges, "src")
    b = solved.select("origin", F.col("node").alias("dst"), F.col("d").alias("db"))
    bad = a.join(b, ["origin", "dst"], "left").select((F.col("db").isNull() | (F.col("db") > F.col("da") + F.col("w") + eps)).cast("long").alias("bad"))
    return _row(bad, "relaxed", F.sum("bad"), 0, False)


def connectivity(components: DataFrame, most: float = 0.01) -> DataFrame:
    """Share of nodes outside the largest component (of equals that of the smaller label)."""
    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    return _row(sizes, "connectivity", 1 - F.max("n") / F.sum("n"), most, False)


def no_faults(faults: DataFrame) -> DataFrame:
    return _row(faults, "edges", F.sum(F.col("duplicates") + F.col("bad_weights")), 0, False)


def floor(df: DataFrame, gate: str, least: int) -> DataFrame:
    return _row(df, gate, F.count(F.lit(1)), least, True)


def fraction(reasoned: DataFrame, reason: str, gate: str, most: float, skip_below: int = 0) -> DataFrame:
    """Share of rows with a reason to be dropped; tables under skip_below rows pass as 0."""
    share = F.when(F.count(F.lit(1)) >= skip_below, F.avg(F.col(reason).isNotNull().cast("double")))
    return _row(reasoned, gate, share, most, False)


def enforce(gates: DataFrame) -> None:
    """Raises if a gate failed, naming all that did."""
    if bad := gates.filter(~F.col("ok")).collect():  # a row a gate
        raise ValueError("; ".join(f"{r.gate}: {r.observed} against {r.bound}" for r in bad))
