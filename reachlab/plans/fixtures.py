"""Stand-ins for the domain's inputs on the test tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachlab.operators.relational import keep_first


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def with_point(df: DataFrame, key: str) -> DataFrame:
    k = F.col(key)
    return df.withColumn("lat", (k * 7919) % 17000 / 100.0 - 85).withColumn("lon", (k * 104729) % 36000 / 100.0 - 180)


def points(spark: SparkSession, d: str, table: str = "supplier", key: str = "s_suppkey") -> DataFrame:
    return with_point(t(spark, d, table).select(F.col(key).cast("long").alias("k")), "k")


def points_sql(table: str = "supplier", key: str = "s_suppkey") -> str:
    return f"SELECT {key}::BIGINT AS k, ({key}::BIGINT * 7919) % 17000 / 100.0 - 85 AS lat, ({key}::BIGINT * 104729) % 36000 / 100.0 - 180 AS lon FROM {table}"


def _legs(spark: SparkSession, d: str, keys: list[str]) -> DataFrame:
    line = t(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", F.col("l_quantity").cast("long").alias("q"))
    orders = t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    cust = t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("dst"))
    supp = t(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("src"))
    flow = line.join(orders, "l_orderkey").join(cust, "o_custkey").join(supp, "l_suppkey").filter("src <> dst")
    return flow.groupBy(*keys).agg((10 + (F.sum("q") * 7 + F.count(F.lit(1)) * 13) % 241).cast("double").alias("w"))


def legs(spark: SparkSession, d: str) -> DataFrame:
    """src, dst, w: the three cheapest of each source."""
    flow = _legs(spark, d, ["src", "dst"])
    from pyspark.sql import Window

    return flow.withColumn("n", F.row_number().over(Window.partitionBy("src").orderBy("w", "dst"))).filter("n <= 3").select("src", "dst", "w")


def legs_by_mode(spark: SparkSession, d: str) -> DataFrame:
    """src, dst, w, mode: each mode's three cheapest of each source, and of a pair the cheapest mode."""
    from pyspark.sql import Window

    flow = _legs(spark, d, ["src", "dst", "l_returnflag"]).withColumnRenamed("l_returnflag", "mode")
    flow = flow.withColumn("n", F.row_number().over(Window.partitionBy("src", "mode").orderBy("w", "dst"))).filter("n <= 3").drop("n")
    return keep_first(flow, ["src", "dst"], [F.col("w"), F.col("mode")]).select("src", "dst", "w", "mode")


_FLOW = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey <> c_nationkey"
_W = "(10 + (sum(l_quantity::BIGINT) * 7 + count(*) * 13) % 241)::DOUBLE AS w"
LEGS = f"legs AS (SELECT src, dst, w FROM (SELECT s_nationkey AS src, c_nationkey AS dst, {_W} {_FLOW} GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY src ORDER BY w, dst) <= 3)"
MODES = (
    f"mode_all AS (SELECT s_nationkey AS src, c_nationkey AS dst, l_returnflag AS mode, {_W} {_FLOW} GROUP BY ALL), "
    "mode_low AS (SELECT * FROM mode_all QUALIFY row_number() OVER (PARTITION BY src, mode ORDER BY w, dst) <= 3), "
    "legs_by_mode AS (SELECT src, dst, w, mode FROM mode_low QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY w, mode) = 1)"
)


def solve_sql(edges: str, name: str = "sp", sources: str = "SELECT 0 AS origin, 0 AS node") -> str:
    """A CTE (origin, node, d) by relaxation until nothing improves; to stand in WITH RECURSIVE."""
    return f"""{name}(origin, node, d) USING KEY (origin, node) AS (
  SELECT origin, node, 0.0::DOUBLE FROM ({sources})
  UNION (SELECT s.origin, e.dst, min(s.d + e.w) FROM {name} s JOIN {edges} e ON e.src = s.node LEFT JOIN recurring.{name} r ON r.origin = s.origin AND r.node = e.dst
    WHERE r.node IS NULL OR s.d + e.w < r.d GROUP BY s.origin, e.dst))"""


def tree_sql(edges: str, solved: str = "sp", name: str = "tree") -> str:
    return f"""{name} AS (SELECT b.origin, b.node, b.d, CASE WHEN b.d > 0 THEN (SELECT min(e.src) FROM {edges} e JOIN {solved} a ON a.node = e.src AND a.origin = b.origin WHERE e.dst = b.node AND abs(a.d + e.w - b.d) < 1e-9) END AS prev FROM {solved} b)"""


#: Order lines, one per order and line number: the table repeats numbers.
LINE = "(SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey, l_partkey, l_quantity, l_extendedprice) = 1)"


def lines(spark: SparkSession, d: str) -> DataFrame:
    return keep_first(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col(c) for c in ("l_suppkey", "l_partkey", "l_quantity", "l_extendedprice")])


def stops(spark: SparkSession, d: str) -> DataFrame:
    return lines(spark, d).select(F.col("l_orderkey").alias("route"), F.col("l_linenumber").alias("seq"), F.col("l_suppkey").alias("stop"), F.col("l_quantity").alias("qty"))


def one_origin(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit(0).alias("origin"), F.lit(0).alias("node"))
