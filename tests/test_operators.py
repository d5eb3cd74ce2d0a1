"""Operators on hand-built inputs, and strategies against each other on random graphs."""

import heapq
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reachlab.functions import cost
from reachlab.operators import calib, gates
from reachlab.operators import graph as G
from reachlab.operators import relational as R
from reachlab.operators import spatial as S
from reachlab.operators import trees as T
from reachlab.plans import materialize as X
from reachlab.streaming import sessions


def edges(spark, rows):
    return spark.createDataFrame(rows, "src int, dst int, w double")


def sources(spark, *nodes):
    return spark.createDataFrame([(n, n) for n in nodes], "origin int, node int")


def test_paths_are_directed_and_shortest(spark):
    e = edges(spark, [(0, 1, 5.0), (1, 2, 2.0), (0, 2, 20.0)])
    for how in ("local", "frontier"):
        got = {r.node: (r.d, r.prev) for r in G.shortest_paths(e, sources(spark, 0), strategy=how).collect()}
        assert got == {0: (0.0, None), 1: (5.0, 0), 2: (7.0, 1)}
    assert {r.node for r in G.shortest_paths(e, sources(spark, 1)).collect()} == {1, 2}


@pytest.mark.parametrize("seed", [1, 2])
def test_strategies_agree_with_dijkstra(spark, seed):
    rng = random.Random(seed)
    rows = {(rng.randrange(25), rng.randrange(25)): float(rng.randint(1, 30)) for _ in range(60)}
    e = [(a, b, w) for (a, b), w in rows.items() if a != b]
    want = {}
    for o in (0, 7):
        done, heap = {}, [(0.0, o)]
        while heap:
            d, n = heapq.heappop(heap)
            if n in done:
                continue
            done[n] = d
            for a, b, w in e:
                if a == n:
                    heapq.heappush(heap, (d + w, b))
        want |= {(o, n): d for n, d in done.items()}
    for how in ("local", "frontier"):
        tree = G.shortest_paths(edges(spark, e), sources(spark, 0, 7), strategy=how)
        assert {(r.origin, r.node): r.d for r in tree.collect()} == want
    depth = {(r.origin, r.node): r.depth for r in T.depth(tree).collect()}
    paths = {(r.origin, r.node): r.path for r in T.paths(tree).collect()}
    assert all(len(paths[k]) - 1 == depth[k] and paths[k][0] == k[0] and paths[k][-1] == k[1] for k in want)
    assert gates.relaxed(tree, edges(spark, e)).first().ok


def test_bad_edges_are_refused(spark):
    for rows in ([(0, 1, 1.0), (0, 1, 2.0)], [(0, 1, 0.0)], [(0, 1, float("nan"))]):
        with pytest.raises(ValueError):
            G.assemble([edges(spark, rows).withColumn("mode", F.lit("x"))])


def test_components(spark):
    e = edges(spark, [(i, i + 1, 1.0) for i in range(40)] + [(60, 61, 1.0)])
    nodes = spark.range(70).select(F.col("id").cast("int").alias("node"))
    got = {r.node: r.component for r in G.components(nodes, e).collect()}
    assert [got[i] for i in (0, 20, 40, 60, 61, 65)] == [0, 0, 0, 60, 60, 65]


def test_within_km_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(-89.9, 89.9, 120), rng.uniform(-180, 180, 120), strict=True))] + [(200, 10.0, 179.9), (201, 10.0, -179.9), (202, 89.5, 0.0), (203, 89.5, 180.0)]
    p = spark.createDataFrame(pts, "k int, lat double, lon double")
    for km in (60.0, 1500.0):
        got = {(r.k, r.k2) for r in S.within_km(p, p.select(F.col("k").alias("k2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2")), km).collect()}
        a = np.radians([[x[1], x[2]] for x in pts])
        h = np.sin((a[:, None, 0] - a[None, :, 0]) / 2) ** 2 + np.cos(a[:, None, 0]) * np.cos(a[None, :, 0]) * np.sin((a[:, None, 1] - a[None, :, 1]) / 2) ** 2
        d = 2 * 6371.0088 * np.arcsin(np.sqrt(np.minimum(h, 1)))
        assert got == {(pts[i][0], pts[j][0]) for i, j in zip(*np.nonzero(d <= km), strict=True)}


def test_thinning_is_the_greedy_one(spark):
    rng = np.random.default_rng(4)
    pts = [(i, int(rng.integers(1, 9)), float(rng.uniform(-20, 20)), float(rng.uniform(-20, 20))) for i in range(60)]
    kept = []
    for k, s, y, x in sorted(pts, key=lambda p: (-p[1], p[0])):
        far = lambda q, y=y, x=x: 2 * 6371.0088 * np.arcsin(np.sqrt(np.sin(np.radians(q[2] - y) / 2) ** 2 + np.cos(np.radians(y)) * np.cos(np.radians(q[2])) * np.sin(np.radians(q[3] - x) / 2) ** 2)) > 500
        if all(map(far, kept)):
            kept.append((k, s, y, x))
    got = R.thin(spark.createDataFrame(pts, "k int, s int, lat double, lon double"), "s", "lat", "lon", 500.0, "k")
    assert {r.k for r in got.collect()} == {k[0] for k in kept}


def test_strict_values_are_errors(spark):
    df = spark.createDataFrame([("x",)], "v string")
    for col in (R.recode(F.col("v"), {"a": "b"}), cost.pick("v", {"a": 1.0})):
        with pytest.raises(Exception, match="x"):
            df.select(col).collect()
    with pytest.raises(ValueError, match="missing"):
        R.required_columns(df, ["w"])


def test_coverage_of_nothing_is_zero(spark):
    df = spark.createDataFrame([], "d double")
    assert gates.coverage(df, F.col("d").isNotNull(), F.lit(True)).first().observed == 0.0
    with pytest.raises(ValueError, match="coverage"):
        gates.enforce(gates.coverage(df, F.col("d").isNotNull(), F.lit(True)))


def test_fits(spark):
    rows = [(i, float(i % 50 + 1), 15 + 60 * float(i % 50 + 1) / 800) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, km double, m double")
    penalty, kmh = calib.airborne(df, "km", "m")
    assert abs(penalty - 15) < 1e-6 and abs(kmh - 800) < 1e-3
    assert max(r.mae for r in calib.out_of_fold(df, "k", "km", "m").collect()) < 1e-6
    slopes = [r.slope for r in calib.bootstrap(df, "k", "km", "m", 10).collect()]
    assert len(slopes) == 10 and max(abs(s - 0.075) for s in slopes) < 1e-6
    x = np.linspace(1, 100, 50)
    assert np.allclose(calib.log_error_fit(x, 11 + 2 * x, (1, 1), (0, 0), (100, 100)), (11, 2), atol=1e-3)


def test_keyed_tables_and_publishing(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert X.keyed(spark, str(tmp_path), "t", {"a": 1}, compute).count() == 3
    assert len(calls) == 1
    with pytest.raises(TypeError):
        X.params_hash({"a": {1}})
    spark.range(2).write.parquet(f"{tmp_path}/stage/a")
    with pytest.raises(RuntimeError, match="b"):
        X.publish(spark, f"{tmp_path}/stage", f"{tmp_path}/out", ["a", "b"])
    X.publish(spark, f"{tmp_path}/stage", f"{tmp_path}/out", ["a"])
    assert spark.read.parquet(f"{tmp_path}/out/a").count() == 2


def test_streamed_sessions(spark, tmp_path):
    spark.createDataFrame([("a", 0), ("a", 100), ("a", 5000), ("b", 0)], "k string, s long").select("k", F.timestamp_seconds("s").alias("ts")).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k string, ts timestamp").parquet(f"{tmp_path}/in")
    q = sessions.session_counts(stream, "k", "ts").writeStream.format("memory").queryName("sess").outputMode("complete").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.k, r.n) for r in spark.table("sess").collect()) == [("a", 1), ("a", 2), ("b", 1)]
    rows = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "k int, v int, s string")
    for b in (rows, spark.createDataFrame([(1, 1, "old"), (2, 1, "z")], "k int, v int, s string")):
        sessions.upsert_latest(b, f"{tmp_path}/latest", "k", "v")
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/latest").select("k", "v", "s").collect()) == [(1, 2, "y"), (2, 1, "z")]
