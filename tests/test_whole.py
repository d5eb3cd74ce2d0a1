"""Queries over all rows of their tables, held against brute force in Python."""

import math
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from reachlab.functions.columns import R_MEAN
from reachlab.operators import spatial as S
from reachlab.plans import catalog
from reachlab.plans.fixtures import LINE

catalog.load()
D = "/root/testdata/sf0.001"


def read(sql):
    con = duckdb.connect()
    for t in ("nation", "customer", "supplier", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return con.execute(sql).fetchall()


def run(spark, name):
    return catalog.QUERIES[name](spark, D).collect()


@pytest.fixture(scope="module")
def routes():
    out = defaultdict(list)
    for order, number, stop, part in read(f"SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM {LINE} ORDER BY 1, 2"):
        out[order].append((number, stop, number * 10 + part % 7))
    return out


def place(k):
    return (k * 7919) % 17000 / 100.0 - 85, (k * 104729) % 36000 / 100.0 - 180


def km(a, b):
    (y1, x1), (y2, x2) = ([math.radians(v) for v in place(k)] for k in (a, b))
    h = math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2
    return 2 * R_MEAN * math.asin(math.sqrt(min(1.0, h)))


@pytest.fixture(scope="module")
def keys():
    return [[r[0] for r in read(f"SELECT {k} FROM {t} ORDER BY 1")] for t, k in (("customer", "c_custkey"), ("supplier", "s_suppkey"))]


def test_pairs_of_every_route(spark, routes):
    want = sorted((o, i, a, j, b) for o, s in routes.items() for i, a, _ in s for j, b, _ in s if i < j)
    assert sorted((r.route, r.i, r.from_stop, r.j, r.to_stop) for r in run(spark, "s20_pairs_in_order")) == want


def test_timetable_of_every_trip(spark, routes):
    want = defaultdict(list)
    for s in routes.values():
        for i, a, p in s:
            for j, b, q in s:
                if i < j and q > p and a != b:
                    want[a, b].append(q - p)
    assert {(r.a, r.b): (r.minutes, r.trips) for r in run(spark, "m22_timetabled_pairs")} == {k: (min(v), len(v)) for k, v in want.items()}


def test_every_customer_is_judged(spark, keys):
    customers, suppliers = keys
    want = {}
    for c in customers:
        if (o := c % 40 + 1) in suppliers:
            want[c] = km(c, o) > 5000 and min(km(c, s) for s in suppliers) < 0.5 * km(c, o)
    assert {r.k: r.wrong for r in run(spark, "p9_misresolved")} == want


def test_nearest_of_all_suppliers(spark, keys):
    customers, suppliers = keys
    want = {c: min((round(km(c, s), 6), s) for s in suppliers) for c in customers}
    got = {r.k: r for r in run(spark, "j10_nearest_any")}
    assert {k: r.o for k, r in got.items()} == {k: s for k, (_, s) in want.items()}
    assert all(abs(r.km - want[k][0]) < 2e-3 for k, r in got.items())


def test_nearest_widens_from_a_small_radius(spark, keys):
    customers, suppliers = keys
    at = lambda ks, *names: spark.createDataFrame([(k, *place(k)) for k in ks], f"{names[0]} long, {names[1]} double, {names[2]} double")
    got = S.nearest_any(at(customers[:20], "k", "lat", "lon"), at(suppliers, "o", "lat2", "lon2"), "k", "o", 300.0).collect()
    assert {r.k: r.o for r in got} == {c: min((km(c, s), s) for s in suppliers)[1] for c in customers[:20]}


def test_polygons_of_all_suppliers(spark, keys):
    customers, suppliers = keys
    inside = lambda p, q: q[0] <= p[0] < q[0] + 20 and q[1] <= p[1] < q[1] + 40
    held = {c: [s for s in suppliers if inside(place(c), place(s))] for c in customers}
    assert {r.k: r.polygon for r in run(spark, "j12_point_in_polygon")} == {c: min(v) for c, v in held.items() if v}


def test_components_of_all_lines(spark):
    pairs = read("SELECT DISTINCT s_nationkey, c_nationkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey")
    want = {n: n for (n,) in read("SELECT n_nationkey FROM nation")}
    for _ in want:
        for a, b in pairs:
            want[a] = want[b] = min(want[a], want[b])
    assert {r.node: r.component for r in run(spark, "g5_components")} == want
    largest = max(list(want.values()).count(c) for c in want.values())
    gate = run(spark, "v4_connectivity")[0]
    assert abs(gate.observed - (1 - largest / len(want))) < 1e-9 and gate.ok == (gate.observed <= 0.01)


def test_band_of_the_unreached_is_there_if_all_is_reached(spark, tmp_path):
    con = duckdb.connect()
    tables = {
        "nation": "SELECT i::INT AS n_nationkey FROM range(3) r(i)",
        "supplier": "SELECT i AS s_suppkey, i::INT AS s_nationkey FROM range(3) r(i)",
        "customer": "SELECT i AS c_custkey, i::INT AS c_nationkey FROM range(3) r(i)",
        "orders": "SELECT i AS o_orderkey, i AS o_custkey FROM range(3) r(i)",
        "lineitem": "SELECT i AS l_orderkey, j AS l_suppkey, 'N' AS l_returnflag, 5.0::DOUBLE AS l_quantity FROM range(3) r(i), range(3) s(j)",
    }
    for name, sql in tables.items():
        con.execute(f"COPY ({sql}) TO '{tmp_path}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet')")
    got = {r.band: r.nodes for r in catalog.QUERIES["b1_nodes_per_band"](spark, str(tmp_path)).collect()}
    assert got == dict(con.execute(catalog.ORACLE_SQL["b1_nodes_per_band"]).fetchall()) and got[-1] == 0


def met_pairs(monkeypatch):
    """A list that gets the number of pairs each radius search returns, nearest and farther ones."""
    sizes, whole = [], S.within_km

    def counted(*a, **k):
        out = whole(*a, **k)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(S, "within_km", counted)
    return sizes


@pytest.fixture(scope="module")
def crowd(tmp_path_factory):
    path = tmp_path_factory.mktemp("crowd")
    for t, k in (("customer", "c_custkey"), ("supplier", "s_suppkey")):
        duckdb.sql(f"COPY (SELECT i AS {k} FROM range(3000) r(i)) TO '{path}/{t}.parquet'")
    return str(path)


def agrees(spark, name, path, tables=("customer", "supplier")):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    cur = con.execute(catalog.ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    return sorted(map(tuple, catalog.QUERIES[name](spark, path).select(names).collect())) == sorted(cur.fetchall())


def test_nearest_of_many_meets_few_pairs(spark, monkeypatch, crowd):
    sizes = met_pairs(monkeypatch)
    assert agrees(spark, "j10_nearest_any", crowd)
    assert sum(sizes) < 40 * 3000, sizes


def test_polygons_are_met_by_their_boxes_only(spark, monkeypatch):
    monkeypatch.setattr(S, "ROUNDS", (5, 20))
    rng = random.Random(3)
    rings = []
    for i in range(60):
        y, x, size = rng.uniform(-80, 70), rng.uniform(-170, 150), 10 ** rng.uniform(-2, 1.4)
        n = rng.randint(3, 7)
        rings.append([(y + size * math.sin(2 * math.pi * j / n), x + size * math.cos(2 * math.pi * j / n)) for j in range(n)])
    at = [(rng.uniform(-85, 85), rng.uniform(-180, 180)) for _ in range(200)] + [tuple(sum(p[d] for p in r) / len(r) for d in (0, 1)) for r in rings]
    want = {}
    for k, (lat, lon) in enumerate(at):
        for i, r in enumerate(rings):
            cuts = [(y1 > lat) != (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 for (y1, x1), (y2, x2) in zip(r, r[1:] + r[:1], strict=True)]
            if sum(cuts) % 2:
                want.setdefault(k, i)
    points = spark.createDataFrame([(k, *p) for k, p in enumerate(at)], "k long, lat double, lon double")
    edges = spark.createDataFrame([(i, *p, *q) for i, r in enumerate(rings) for p, q in zip(r, r[1:] + r[:1], strict=True)], "polygon long, y1 double, x1 double, y2 double, x2 double")
    sizes, whole = [], S._boxed_in

    def counted(*a):
        out = whole(*a)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(S, "_boxed_in", counted)
    assert {r.k: r.polygon for r in S.point_in_polygon(points, edges, "k", "polygon").collect()} == want
    assert len(sizes) == 3 and sum(sizes) < 20 * len(at)
    assert S.point_in_polygon(points, edges.limit(0), "k", "polygon").count() == 0


def test_every_customer_is_judged_by_few_pairs(spark, monkeypatch, crowd):
    sizes = met_pairs(monkeypatch)
    assert agrees(spark, "p9_misresolved", crowd)
    assert sum(sizes) < 40 * 3000, sizes
