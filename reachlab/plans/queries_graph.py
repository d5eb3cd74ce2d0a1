"""Graphs, trees, bands, served queries, gates and fits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachlab.functions import cells as K
from reachlab.functions import columns as C
from reachlab.operators import bands as B
from reachlab.operators import calib, gates
from reachlab.operators import graph as G
from reachlab.operators import trees as Tr
from reachlab.plans.catalog import query
from reachlab.plans.fixtures import LEGS, MODES, legs, legs_by_mode, one_origin, points_sql, solve_sql, t, tree_sql, with_point
from reachlab.plans.queries_scalar import _CELLS, _EDGES, _cells

SP = f"WITH RECURSIVE {LEGS}, {solve_sql('legs')}"
TREE = f"{SP}, {tree_sql('legs')}"
_ALL = "SELECT n_nationkey AS origin, n_nationkey AS node FROM nation"


def solved(spark: SparkSession, d: str) -> DataFrame:
    return G.shortest_paths(legs(spark, d), one_origin(spark))


def _nations(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "nation").select(F.col("n_nationkey").alias("origin"), F.col("n_nationkey").alias("node"))


# -- graphs


@query("g1_route_network", f"WITH {LEGS} SELECT * FROM legs")
def g1(spark: SparkSession, d: str) -> DataFrame:
    return G.assemble([legs(spark, d).withColumn("mode", F.lit("air"))]).select("src", "dst", "w")


@query("g2_shortest_paths", f"{SP} SELECT node, d FROM sp")
def g2(spark: SparkSession, d: str) -> DataFrame:
    return solved(spark, d).select("node", "d")


@query("g2_frontier", f"{SP} SELECT node, d FROM sp")
def g2f(spark: SparkSession, d: str) -> DataFrame:
    return G.shortest_paths(legs(spark, d), one_origin(spark), strategy="frontier").select("node", "d")


@query("g2_predecessors", f"{TREE} SELECT node, prev FROM tree")
def g2p(spark: SparkSession, d: str) -> DataFrame:
    return solved(spark, d).select("node", "prev")


@query("g3_nearest_source", f"WITH RECURSIVE {LEGS}, {solve_sql('legs', sources='SELECT 0 AS origin, n_nationkey AS node FROM nation WHERE n_nationkey % 8 = 0')} SELECT node, d FROM sp WHERE d <= 60")
def g3(spark: SparkSession, d: str) -> DataFrame:
    sources = t(spark, d, "nation").filter("n_nationkey % 8 = 0").select(F.lit(0).alias("origin"), F.col("n_nationkey").alias("node"))
    return G.shortest_paths(legs(spark, d), sources, limit=60.0).select("node", "d")


@query("g4_many_origins", f"WITH RECURSIVE {LEGS}, {solve_sql('legs', sources=_ALL)} SELECT origin, node, d FROM sp")
def g4(spark: SparkSession, d: str) -> DataFrame:
    return G.shortest_paths(legs(spark, d), _nations(spark, d)).select("origin", "node", "d")


_THIN = "thin AS (SELECT DISTINCT s_nationkey AS src, c_nationkey AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"


def _flows(spark: SparkSession, d: str) -> DataFrame:
    line = t(spark, d, "lineitem").join(t(spark, d, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    line = line.join(t(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(t(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return line.select(F.col("s_nationkey").alias("src"), F.col("c_nationkey").alias("dst")).distinct()


@query("g5_components", f"""WITH RECURSIVE {_THIN}, both_ways AS (SELECT src, dst FROM thin UNION SELECT dst, src FROM thin),
c(node, component) USING KEY (node) AS (SELECT n_nationkey, n_nationkey FROM nation UNION (SELECT e.dst, min(c.component) FROM c JOIN both_ways e ON e.src = c.node LEFT JOIN recurring.c r ON r.node = e.dst WHERE c.component < r.component GROUP BY e.dst)) SELECT node, component FROM c""")
def g5(spark: SparkSession, d: str) -> DataFrame:
    return G.components(_nations(spark, d).select("node"), _flows(spark, d))


@query("g6_degrees", f"WITH {LEGS}, e AS (SELECT src AS node, dst AS o, 1 AS out, 0 AS inn FROM legs UNION ALL SELECT dst, src, 0, 1 FROM legs) SELECT node, sum(out)::BIGINT AS out_degree, sum(inn)::BIGINT AS in_degree, count(DISTINCT o) AS neighbours FROM e GROUP BY 1")
def g6(spark: SparkSession, d: str) -> DataFrame:
    return G.degrees(legs(spark, d))


@query("g7_levels", f"WITH RECURSIVE {LEGS}, b(node, level) AS (SELECT 0, 0 UNION SELECT dst, level + 1 FROM b JOIN legs ON src = node WHERE level < 4) SELECT node, min(level) AS level FROM b GROUP BY 1")
def g7(spark: SparkSession, d: str) -> DataFrame:
    return G.levels(legs(spark, d), one_origin(spark), depth=4)


@query("g8_bounded", f"{SP} SELECT node, d FROM sp WHERE d <= 50")
def g8(spark: SparkSession, d: str) -> DataFrame:
    return G.shortest_paths(legs(spark, d), one_origin(spark), limit=50.0, strategy="frontier").select("node", "d")


@query("g9_digest", f"WITH {LEGS} SELECT count(*) AS n, true AS orderless FROM legs")
def g9(spark: SparkSession, d: str) -> DataFrame:
    e = legs(spark, d)
    a, b = G.digest(e), G.digest(e.orderBy(F.desc("w"), "dst"))
    return a.alias("a").join(b.alias("b"), F.col("a.n") == F.col("b.n")).select(F.col("a.n").alias("n"), ((F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2"))).alias("orderless"))


@query("g10_variant_monotone", f"WITH RECURSIVE {MODES}, less AS (SELECT src, dst, w FROM legs_by_mode WHERE mode <> 'R'), {solve_sql('legs_by_mode', 'full_sp')}, {solve_sql('less', 'less_sp')} SELECT count(*) AS compared, count(*) FILTER (f.d IS NULL OR l.d < f.d - 1e-6) AS faster FROM less_sp l LEFT JOIN full_sp f USING (node)")
def g10(spark: SparkSession, d: str) -> DataFrame:
    e = legs_by_mode(spark, d)
    full = G.shortest_paths(G.assemble([e]), one_origin(spark))
    return G.variant_faults(full, G.shortest_paths(G.assemble([e], exclude="R"), one_origin(spark)))


@query("g11_node_ids", "SELECT n_nationkey AS ordinal, kind, base + n_nationkey AS id FROM nation, (VALUES ('dep', 1000), ('arr', 1025), ('station', 1050)) v(kind, base)")
def g11(spark: SparkSession, d: str) -> DataFrame:
    base = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).alias("base")) for k, v in (("dep", 1000), ("arr", 1025), ("station", 1050))])
    return t(spark, d, "nation").select(F.col("n_nationkey").alias("ordinal"), F.explode(base).alias("b")).select("ordinal", "b.kind", (F.col("b.base") + F.col("ordinal")).alias("id"))


# -- trees

_DEPTH = "p(node, depth, path, air, total) AS (SELECT node, 0, [node], 0.0::DOUBLE, 0.0::DOUBLE FROM tree WHERE prev IS NULL UNION ALL SELECT c.node, p.depth + 1, list_append(p.path, c.node), p.air + CASE WHEN c.node % 2 = 0 THEN c.d - u.d ELSE 0 END, p.total + c.d - u.d FROM tree c JOIN p ON p.node = c.prev JOIN tree u ON u.node = c.prev)"
WALK = f"{TREE}, {_DEPTH}"


@query("t1_tree_depth", f"{WALK} SELECT node, depth FROM p")
def t1(spark: SparkSession, d: str) -> DataFrame:
    return Tr.depth(solved(spark, d)).select("node", "depth")


@query("t2_marked_ancestor", f"{WALK} SELECT node, list_filter(path, lambda x: x % 3 = 1)[-1] AS ancestor FROM p")
def t2(spark: SparkSession, d: str) -> DataFrame:
    return Tr.nearest_marked(solved(spark, d), F.col("node") % 3 == 1).select("node", "ancestor")


@query("t3_by_level", f"{WALK} SELECT depth, count(*) AS n FROM p GROUP BY 1")
def t3(spark: SparkSession, d: str) -> DataFrame:
    return Tr.depth(solved(spark, d)).groupBy("depth").agg(F.count(F.lit(1)).alias("n"))


@query("t4_mode_minutes", f"{WALK} SELECT node, air, total - air AS surface FROM p")
def t4(spark: SparkSession, d: str) -> DataFrame:
    tree = solved(spark, d)
    step = tree.join(tree.select("origin", F.col("node").alias("prev"), F.col("d").alias("du")), ["origin", "prev"], "left").withColumn("w", F.col("d") - F.coalesce("du", "d"))
    return Tr.path_sums(step, {"air": F.when(F.col("node") % 2 == 0, F.col("w")).otherwise(0.0), "surface": F.when(F.col("node") % 2 == 0, 0.0).otherwise(F.col("w"))}).select("node", "air", "surface")


@query("t6_paths", f"{WALK} SELECT node, array_to_string(path, '>') AS path FROM p")
def t6(spark: SparkSession, d: str) -> DataFrame:
    return Tr.paths(solved(spark, d)).select("node", F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("path"))


_STEPS = "st AS (SELECT node AS journey, unnest(range(1, len(path))) AS k, path FROM p), s2 AS (SELECT journey, k, path[k] AS u, path[k + 1] AS v, CASE WHEN path[k + 1] % 5 = 0 THEN 'fly' ELSE 'surface' END AS kind FROM st), s3 AS (SELECT s2.*, round_even(b.d, 0) - round_even(a.d, 0) AS m FROM s2 JOIN tree a ON a.node = u JOIN tree b ON b.node = v), s4 AS (SELECT *, sum((kind <> 'surface' OR coalesce(pk, '') <> 'surface')::INT) OVER (PARTITION BY journey ORDER BY k) AS leg FROM (SELECT *, lag(kind) OVER (PARTITION BY journey ORDER BY k) AS pk FROM s3))"


@query("t7_journey_legs", f"{WALK}, {_STEPS} SELECT journey, leg::BIGINT AS leg, min(kind) AS kind, arg_min(u, k) AS from_node, arg_max(v, k) AS to_node, sum(m)::BIGINT AS minutes FROM s4 GROUP BY 1, 2")
def t7(spark: SparkSession, d: str) -> DataFrame:
    tree = solved(spark, d)
    p = Tr.paths(tree).select(F.col("node").alias("journey"), "path")
    k = p.select("journey", F.posexplode("path").alias("k", "v"), "path").filter("k > 0").withColumn("u", F.expr("path[k - 1]"))
    at = tree.select("node", "d")
    s = k.join(at.select(F.col("node").alias("u"), F.col("d").alias("at_u")), "u").join(at.select(F.col("node").alias("v"), F.col("d").alias("at_v")), "v")
    return Tr.journey_legs(s, F.when(F.col("v") % 5 == 0, "fly").otherwise("surface"))


@query("t8_tie_set", "WITH r AS (SELECT l_suppkey AS a, l_partkey % 15 AS b, l_shipmode AS x FROM (SELECT *, l_returnflag || l_linenumber AS l_shipmode FROM lineitem)), q AS (SELECT l_suppkey AS a, l_partkey % 15 AS b, l_returnflag || l_linenumber AS name, l_quantity FROM lineitem), m AS (SELECT a, b, min(l_quantity) AS low FROM q GROUP BY 1, 2) SELECT q.a, q.b, array_to_string(list_sort(list(DISTINCT name)), ',') AS names, min(l_quantity) AS minutes FROM q JOIN m ON m.a = q.a AND m.b = q.b AND l_quantity = low GROUP BY 1, 2")
def t8(spark: SparkSession, d: str) -> DataFrame:
    r = t(spark, d, "lineitem").select(F.col("l_suppkey").alias("a"), (F.col("l_partkey") % 15).alias("b"), F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("name"), F.col("l_quantity").alias("minutes"))
    return Tr.tie_set(r, ["a", "b"], "minutes", "name").select("a", "b", F.array_join("names", ",").alias("names"), "minutes")


@query("t9_pick_route", "WITH r AS (SELECT l_suppkey % 20 AS hop, l_orderkey AS route, count(*) AS covered, min(l_linenumber) AS stops FROM lineitem GROUP BY 1, 2) SELECT hop, route FROM r QUALIFY row_number() OVER (PARTITION BY hop ORDER BY covered DESC, stops, route) = 1")
def t9(spark: SparkSession, d: str) -> DataFrame:
    r = t(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 20).alias("hop"), F.col("l_orderkey").alias("route")).agg(F.count(F.lit(1)).alias("covered"), F.min("l_linenumber").alias("stops"))
    return r.groupBy("hop").agg(F.min(F.struct((-F.col("covered")).alias("c"), "stops", "route")).alias("b")).select("hop", F.col("b.route").alias("route"))


@query("t10_route_tree_json", f"""{TREE} SELECT '{{"id":' || node || ',"min":' || round_even(d, 0)::BIGINT || CASE WHEN prev IS NULL THEN '' ELSE ',"prev":' || prev END || '}}' AS body FROM tree""")
def t10(spark: SparkSession, d: str) -> DataFrame:
    return solved(spark, d).select(F.to_json(F.struct(F.col("node").alias("id"), F.rint("d").cast("long").alias("min"), "prev")).alias("body"))


@query("t11_representative", "WITH c AS (SELECT c_custkey AS cell, c_custkey // 7 AS parent, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS m FROM customer) SELECT parent, coalesce(min(cell) FILTER (cell = parent * 7 + 3), arg_min(cell, (coalesce(m, 'inf'::DOUBLE), cell))) AS representative FROM c GROUP BY 1")
def t11(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("cell"), F.expr("c_custkey div 7").alias("parent"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("m"))
    return Tr.representative(c.withColumn("centre", F.col("parent") * 7 + 3), "parent", "cell", "m", "centre")


@query("t12_reading_source", "SELECT c_custkey // 7 AS parent, arg_min(c_custkey, (NOT c_nationkey % 2 = 0, c_acctbal, c_custkey)) AS cell FROM customer GROUP BY 1")
def t12(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "customer").groupBy(F.expr("c_custkey div 7").alias("parent")).agg(F.min_by("c_custkey", F.struct((F.col("c_nationkey") % 2 != 0).alias("z"), "c_acctbal", "c_custkey")).alias("cell"))


_OV = "SELECT c_custkey AS cell, c_custkey // 7 AS parent, (c_custkey * 3) % 9 AS airport, ((c_custkey * 7) % 40)::DOUBLE AS rail, ((c_custkey * 11) % 30)::DOUBLE AS ferry, c_nationkey % 3 AS zone, abs(c_acctbal) / 20 AS minutes FROM customer"


@query("t13_overrides", f"WITH c AS ({_OV}) SELECT c.cell FROM c JOIN c r ON r.parent = c.parent AND r.cell = c.parent * 7 + 3 WHERE c.airport <> r.airport OR abs(c.rail - r.rail) >= 15 OR abs(c.ferry - r.ferry) >= 15 OR c.zone <> r.zone OR (abs(c.minutes - r.minutes) > 60 AND abs(c.minutes - r.minutes) > 0.5 * r.minutes)")
def t13(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    c = t(spark, d, "customer").select(k.alias("cell"), F.expr("c_custkey div 7").alias("parent"), (k * 3 % 9).alias("airport"), (k * 7 % 40).cast("double").alias("rail"), (k * 11 % 30).cast("double").alias("ferry"), (F.col("c_nationkey") % 3).alias("zone"), (F.abs("c_acctbal") / 20).alias("minutes"))
    return Tr.overrides(c, c.filter("cell = parent * 7 + 3").drop("cell"), "parent").select("cell")


# -- bands and rings

_XY = f"{_CELLS}, x AS (SELECT cell, k, (cell >> 26) & 67108863 AS y, cell & 67108863 AS x FROM cells), pr AS (SELECT a.cell AS a, b.cell AS b FROM x a JOIN x b ON abs(a.y - b.y) <= 1 AND (abs(a.x - b.x) <= 1 OR abs(a.x - b.x) = 127) AND a.cell <> b.cell)"


def _adjacent(c: DataFrame) -> DataFrame:
    near = c.select(F.col("cell").alias("a"), F.explode(K.quad_disk("cell", 6, 1)).alias("b")).filter("a <> b")
    return near.join(c.select(F.col("cell").alias("b")), "b", "left_semi").select("a", "b")


@query("b2_sea_rings", f"WITH {_XY}, v0 AS (SELECT cell, k AS value, 0 AS ring FROM x WHERE k % 3 = 0), v1 AS (SELECT b AS cell, min(value) AS value, 1 AS ring FROM v0 JOIN pr ON a = cell WHERE b NOT IN (SELECT cell FROM v0) GROUP BY 1), v2 AS (SELECT b AS cell, min(value) AS value, 2 AS ring FROM v1 JOIN pr ON a = cell WHERE b NOT IN (SELECT cell FROM v0 UNION ALL SELECT cell FROM v1) GROUP BY 1) SELECT * FROM v0 UNION ALL SELECT * FROM v1 UNION ALL SELECT * FROM v2")
def b2(spark: SparkSession, d: str) -> DataFrame:
    c = _cells(spark, d)
    return B.sea_rings(c.filter("k % 3 = 0").select("cell", F.col("k").alias("value")), _adjacent(c), c.select("cell"), 2)


@query("b3_adjacency_complete", f"WITH {_XY} SELECT x.cell, count(pr.b) = 8 AS complete, count(pr.b) AS n FROM x LEFT JOIN pr ON pr.a = x.cell GROUP BY 1")
def b3(spark: SparkSession, d: str) -> DataFrame:
    c = _cells(spark, d)
    per = _adjacent(c).groupBy(F.col("a").alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    return c.select("cell").join(per, "cell", "left").select("cell", (F.coalesce("n", F.lit(0)) == 8).alias("complete"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("b4_rim_max", f"WITH {_XY}, m1 AS (SELECT x.cell, greatest(x.k, coalesce(max(y.k), x.k)) AS v FROM x LEFT JOIN pr ON a = x.cell LEFT JOIN x y ON y.cell = b GROUP BY x.cell, x.k) SELECT m.cell, greatest(m.v, coalesce(max(o.v), m.v)) AS value FROM m1 m LEFT JOIN pr ON a = m.cell LEFT JOIN m1 o ON o.cell = b GROUP BY m.cell, m.v")
def b4(spark: SparkSession, d: str) -> DataFrame:
    c = _cells(spark, d)
    return B.rim_max(c.select("cell", F.col("k").alias("value")), _adjacent(c), 2)


_BAND = f"len(list_filter({_EDGES}, lambda e: k > e))::INT"


@query("b5_cumulative", f"WITH {_CELLS}, v AS (SELECT cell, {_BAND} AS band FROM cells) SELECT level, count(*) AS cells FROM v, range(0, 37) r(level) WHERE band <= level GROUP BY 1")
def b5(spark: SparkSession, d: str) -> DataFrame:
    c = _cells(spark, d).select("cell", C.band_of("k").alias("band"))
    return B.cumulative(c, 36).groupBy(F.col("level").cast("long").alias("level")).agg(F.count(F.lit(1)).alias("cells"))


@query("b6_coarse_parents", f"WITH {_CELLS} SELECT (4::BIGINT << 52) | ((((cell >> 26) & 67108863) >> 2) << 26) | ((cell & 67108863) >> 2) AS parent, min({_BAND}) AS band, max({_BAND}) AS slowest FROM cells GROUP BY 1")
def b6(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d).groupBy(K.quad_parent("cell", 2).alias("parent")).agg(F.min(C.band_of("k")).alias("band"), F.max(C.band_of("k")).alias("slowest"))


@query("b10_band_rows", f"WITH {_CELLS}, v AS (SELECT cell, {_BAND} AS band FROM cells) SELECT band, count(*) AS cells, {_EDGES}[band + 1] AS max_minutes FROM v GROUP BY 1")
def b10(spark: SparkSession, d: str) -> DataFrame:
    return B.band_rows(_cells(spark, d).select("cell", C.band_of("k").alias("band")), C.BAND_EDGES)


@query("b1_nodes_per_band", f"{SP} SELECT len(list_filter({_EDGES}, lambda e: d > e))::INT AS band, count(*) AS nodes FROM sp GROUP BY 1 UNION ALL SELECT -1, (SELECT count(*) FROM nation) - (SELECT count(*) FROM sp)")
def nodes_per_band(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: route network, one solve, bands, with what is not reached as band -1."""
    nodes = t(spark, d, "nation").select(F.col("n_nationkey").alias("node"))
    per = nodes.join(solved(spark, d).select("node", "d"), "node", "left").select(C.band_of("d").alias("band"), F.lit(1).cast("long").alias("n"))
    none = spark.range(1).select(F.lit(-1).alias("band"), F.lit(0).cast("long").alias("n"))  # band -1 is there even if all is reached
    return per.unionByName(none).groupBy("band").agg(F.sum("n").alias("nodes"))


# -- served queries


@query("q2_solve_one", f"{WALK} SELECT 24 AS node, total AS minutes, len(path) - 1 AS steps FROM p WHERE node = 24")
def q2(spark: SparkSession, d: str) -> DataFrame:
    tree = solved(spark, d)
    return Tr.paths(tree).filter("node = 24").join(tree.select("origin", "node", "d"), ["origin", "node"]).select("node", F.col("d").alias("minutes"), (F.size("path") - 1).cast("long").alias("steps"))


@query("q3_map_codes", f"{SP} SELECT n_nationkey AS node, coalesce(floor(d)::INT, 65535) AS code FROM nation LEFT JOIN sp ON node = n_nationkey")
def q3(spark: SparkSession, d: str) -> DataFrame:
    nodes = t(spark, d, "nation").select(F.col("n_nationkey").alias("node"))
    return nodes.join(solved(spark, d).select("node", "d"), "node", "left").select("node", C.encode_u16("d").alias("code"))


@query("q4_block_slots", f"WITH {_CELLS}, b AS (SELECT *, (3::BIGINT << 52) | ((((cell >> 26) & 67108863) >> 3) << 26) | ((cell & 67108863) >> 3) AS block, (((cell >> 26) & 67108863) % 8) * 8 + (cell & 67108863) % 8 AS slot FROM cells), one AS (SELECT min(block) AS block FROM b) SELECT s.slot, coalesce(b.k, 65535) AS code FROM range(0, 64) s(slot) LEFT JOIN (SELECT * FROM b JOIN one USING (block)) b USING (slot)")
def q4(spark: SparkSession, d: str) -> DataFrame:
    c = _cells(spark, d).withColumn("block", K.quad_parent("cell", 3)).withColumn("slot", K.quad_slot("cell", 3).cast("long"))
    one = c.agg(F.min("block")).first()[0]
    return spark.range(64).withColumnRenamed("id", "slot").join(c.filter(F.col("block") == one), "slot", "left").select("slot", F.coalesce("k", F.lit(65535).cast("long")).alias("code"))


@query("q8_leg_contract", f"{WALK}, {_STEPS} SELECT journey, sum(m)::BIGINT = round_even(max(total), 0)::BIGINT AS exact FROM s4 JOIN p ON p.node = journey GROUP BY 1")
def q8(spark: SparkSession, d: str) -> DataFrame:
    total = solved(spark, d).select(F.col("node").alias("journey"), F.rint("d").cast("long").alias("total"))
    return t7(spark, d).groupBy("journey").agg(F.sum("minutes").alias("m")).join(total, "journey").select("journey", (F.col("m") == F.col("total")).alias("exact"))


@query("l2_fallback_chain", "SELECT p_partkey AS k, coalesce(CASE WHEN p_size % 3 = 0 THEN p_size END, CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 100 END, -1)::BIGINT AS minutes FROM part")
def l2(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "part").select(F.col("p_partkey").alias("k"), "p_size")
    fine = p.filter("p_size % 3 = 0").select("k", F.col("p_size").cast("long").alias("fine"))
    coarse = p.filter("k % 2 = 0").select("k", (F.col("k") % 100).alias("coarse"))
    return p.join(fine, "k", "left").join(coarse, "k", "left").select("k", F.coalesce("fine", "coarse", F.lit(-1).cast("long")).alias("minutes"))


@query("l5_nearest_place", f"WITH a AS ({points_sql('customer', 'c_custkey')}), b AS ({points_sql()}), m AS (SELECT a.k, b.k AS o, sqrt(pow((b.lat - a.lat) * 111.32, 2) + pow((fmod(b.lon - a.lon + 540.0, 360.0) - 180.0) * 111.32 * cos(radians(a.lat)), 2)) AS km FROM a, b) SELECT k, arg_min(o, (round(km, 6), o)) AS o FROM m WHERE km <= 500 GROUP BY 1")
def l5(spark: SparkSession, d: str) -> DataFrame:
    band = 500 / 111.32
    a = with_point(t(spark, d, "customer").select(F.col("c_custkey").alias("k")), "k").withColumn("y", F.floor((F.col("lat") + 90) / band))
    b = with_point(t(spark, d, "supplier").select(F.col("s_suppkey").alias("k")), "k").select(F.col("k").alias("o"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    b = b.withColumn("y", F.explode(F.array(*[F.floor((F.col("lat2") + 90) / band) + i for i in (-1, 0, 1)])))  # latitude prunes exactly
    m = a.join(b, "y").withColumn("km", C.flat_km("lat", "lon", "lat2", "lon2", 111.32, True)).filter("km <= 500")
    return m.groupBy("k").agg(F.min_by("o", F.struct(F.round("km", 6), "o")).alias("o"))


@query("l7_search", "SELECT p_partkey, row_number() OVER (ORDER BY rank, p_name, p_partkey) AS pos FROM (SELECT p_partkey, p_name, CASE WHEN starts_with(lower(p_name), 'b') THEN 1 WHEN contains(' ' || lower(p_name), ' b') THEN 2 ELSE 3 END AS rank FROM part WHERE contains(lower(p_name), 'b')) QUALIFY pos <= 20")
def l7(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    from reachlab.operators.relational import search_rank

    r = t(spark, d, "part").select("p_partkey", "p_name", search_rank(F.lower("p_name"), "b").alias("rank")).filter("rank IS NOT NULL")
    top = r.orderBy("rank", "p_name", "p_partkey").limit(20)  # a top-20 report
    return top.select("p_partkey", F.row_number().over(Window.orderBy("rank", "p_name", "p_partkey")).cast("long").alias("pos"))


@query("l8_reach_shares", f"{SP} SELECT cut, round(count(*) FILTER (d <= cut) / count(*), 9) AS share FROM (SELECT n_nationkey, d FROM nation LEFT JOIN sp ON node = n_nationkey), (VALUES (30), (60), (90), (120)) v(cut) GROUP BY 1")
def l8(spark: SparkSession, d: str) -> DataFrame:
    nodes = t(spark, d, "nation").select(F.col("n_nationkey").alias("node")).join(solved(spark, d).select("node", "d"), "node", "left")
    shares = nodes.select("d", F.explode(F.array(*map(F.lit, (30, 60, 90, 120)))).alias("cut"))
    return shares.groupBy("cut").agg(F.round(F.avg(F.coalesce((F.col("d") <= F.col("cut")).cast("double"), F.lit(0.0))), 9).alias("share"))


# -- gates


@query("v1_coverage", f"{SP} SELECT 'coverage' AS gate, avg((d IS NOT NULL)::INT) >= 0.9 AS ok, round(avg((d IS NOT NULL)::INT), 9) AS observed, 0.9::DOUBLE AS bound FROM nation LEFT JOIN sp ON node = n_nationkey")
def v1(spark: SparkSession, d: str) -> DataFrame:
    nodes = t(spark, d, "nation").select(F.col("n_nationkey").alias("node")).join(solved(spark, d).select("node", "d"), "node", "left")
    return gates.coverage(nodes, F.col("d").isNotNull(), F.lit(True))


@query("v3_relaxation", f"{SP} SELECT 'relaxed' AS gate, count(*) FILTER (b.d IS NULL OR b.d > a.d + w + 1e-6) = 0 AS ok, (count(*) FILTER (b.d IS NULL OR b.d > a.d + w + 1e-6))::DOUBLE AS observed, 0.0::DOUBLE AS bound FROM sp a JOIN legs ON src = a.node LEFT JOIN sp b ON b.node = dst")
def v3(spark: SparkSession, d: str) -> DataFrame:
    return gates.relaxed(solved(spark, d), legs(spark, d).select("src", "dst", "w"))


@query("v4_connectivity", f"""WITH RECURSIVE {_THIN}, both_ways AS (SELECT src, dst FROM thin UNION SELECT dst, src FROM thin),
c(node, component) USING KEY (node) AS (SELECT n_nationkey, n_nationkey FROM nation UNION (SELECT e.dst, min(c.component) FROM c JOIN both_ways e ON e.src = c.node LEFT JOIN recurring.c r ON r.node = e.dst WHERE c.component < r.component GROUP BY e.dst)),
s AS (SELECT component, count(*) AS n FROM c GROUP BY 1) SELECT 'connectivity' AS gate, 1 - max(n) / sum(n) <= 0.01 AS ok, round(1 - max(n) / sum(n), 9) AS observed, 0.01::DOUBLE AS bound FROM s""")
def v4(spark: SparkSession, d: str) -> DataFrame:
    return gates.connectivity(g5(spark, d))


@query("v5_edge_faults", f"WITH {LEGS} SELECT (SELECT count(*) FROM (SELECT 1 FROM legs GROUP BY src, dst HAVING count(*) > 1))::BIGINT AS duplicates, count(*) FILTER (w IS NULL OR w <= 0)::BIGINT AS bad_weights FROM legs")
def v5(spark: SparkSession, d: str) -> DataFrame:
    return G.edge_faults(legs(spark, d))


@query("v6_floor", "SELECT 'orders' AS gate, count(*) >= 100 AS ok, count(*)::DOUBLE AS observed, 100.0::DOUBLE AS bound FROM orders")
def v6(spark: SparkSession, d: str) -> DataFrame:
    return gates.floor(t(spark, d, "orders"), "orders", 100)


@query("v8_fraction", "SELECT 'cheap' AS gate, avg((o_totalprice < 1000)::INT) <= 0.02 AS ok, round(avg((o_totalprice < 1000)::INT), 9) AS observed, 0.02::DOUBLE AS bound FROM orders")
def v8(spark: SparkSession, d: str) -> DataFrame:
    return gates.fraction(t(spark, d, "orders").withColumn("r", F.when(F.col("o_totalprice") < 1000, "cheap")), "r", "cheap", 0.02)


@query("v11_bad_origins", "SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)")
def v11(spark: SparkSession, d: str) -> DataFrame:
    near = t(spark, d, "supplier").filter("s_acctbal > 9000").select(F.col("s_nationkey").alias("c_nationkey"))
    return t(spark, d, "customer").join(near, "c_nationkey", "left_anti").select("c_custkey")


# -- fits


@query("c1_line_fit", "SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept, regr_count(l_extendedprice, l_quantity)::BIGINT AS n FROM lineitem")
def c1(spark: SparkSession, d: str) -> DataFrame:
    return calib.line_fit(t(spark, d, "lineitem"), "l_quantity", "l_extendedprice").select(F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"), "n")


@query("c2_holdout_mae", "WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem WHERE l_orderkey % 5 <> 0) SELECT count(*) AS n, round(avg(abs(l_extendedprice - a - b * l_quantity)), 3) AS mae FROM lineitem, f WHERE l_orderkey % 5 = 0")
def c2(spark: SparkSession, d: str) -> DataFrame:
    return calib.holdout_mae(t(spark, d, "lineitem"), "l_quantity", "l_extendedprice", F.col("l_orderkey") % 5 == 0).select("n", F.round("mae", 3).alias("mae"))


@query("c6_out_of_fold", "WITH f AS (SELECT k AS fold, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem, range(0, 5) r(k) WHERE l_orderkey % 5 <> k GROUP BY 1) SELECT fold, count(*) AS n, round(avg(abs(l_extendedprice - a - b * l_quantity)), 3) AS mae FROM lineitem JOIN f ON fold = l_orderkey % 5 GROUP BY 1")
def c6(spark: SparkSession, d: str) -> DataFrame:
    return calib.out_of_fold(t(spark, d, "lineitem"), "l_orderkey", "l_quantity", "l_extendedprice").select("fold", "n", F.round("mae", 3).alias("mae"))


@query("c7_flight_legs", "WITH s AS (SELECT user_id, event_id, epoch(date_trunc('second', ts))::BIGINT AS sec, value FROM events), g AS (SELECT *, coalesce(sec - lag(sec) OVER w > 7200, true)::INT AS new FROM s WINDOW w AS (PARTITION BY user_id ORDER BY sec, event_id)), i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY sec, event_id) AS leg FROM g) SELECT user_id, leg::BIGINT AS leg, max(sec) - min(sec) AS seconds, count(*) AS n FROM i GROUP BY 1, 2 HAVING count(*) >= 2")
def c7(spark: SparkSession, d: str) -> DataFrame:
    from reachlab.operators.relational import sessions

    e = t(spark, d, "events").withColumn("ts", F.date_trunc("second", F.col("ts").cast("timestamp")))
    s = sessions(e, "user_id", "ts", 7200, ["ts", "event_id"]).withColumn("at", F.unix_seconds("ts"))
    return s.groupBy("user_id", F.col("session").alias("leg")).agg((F.max("at") - F.min("at")).alias("seconds"), F.count(F.lit(1)).alias("n")).filter("n >= 2")


@query("c9_apply_fit", "SELECT p_partkey, round(p_size * [4, 95, 70, 50, 35][p_size % 5 + 1] / 100.0, 6)::DOUBLE AS predicted FROM part")
def c9(spark: SparkSession, d: str) -> DataFrame:
    coef = spark.createDataFrame([(i, float(v)) for i, v in enumerate((4, 95, 70, 50, 35))], "cls int, v double")  # a row a class
    p = t(spark, d, "part").withColumn("cls", F.col("p_size") % 5)
    return p.join(F.broadcast(coef), "cls").select("p_partkey", F.round(F.col("p_size") * F.col("v") / 100.0, 6).alias("predicted"))


@query("c3_gravity")
def c3(spark: SparkSession, d: str) -> DataFrame:
    b = calib.gravity(t(spark, d, "part").withColumn("n", F.col("p_retailprice")), "n", F.col("p_size") + 1.0, F.col("p_partkey") % 7 + 1.0, "p_partkey")
    return spark.createDataFrame([(i, float(round(x, 9))) for i, x in enumerate(b)], "i int, coefficient double")


# -- builds


@query("x2_pending", "SELECT o_orderkey FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderkey % 4 <> 0)")
def x2(spark: SparkSession, d: str) -> DataFrame:
    from reachlab.plans.materialize import pending

    wanted = t(spark, d, "orders").select("o_orderkey", F.lit("v1").alias("digest"), "o_orderstatus")
    done = wanted.select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, "v0").otherwise("v1").alias("digest"), (F.col("o_orderstatus") == "F").alias("complete"))
    return pending(wanted, done, "o_orderkey", "digest").select("o_orderkey")


@query("x7_build_identity", "SELECT 'orders' AS input, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys FROM orders UNION ALL SELECT 'customer', count(*), sum(c_custkey)::BIGINT FROM customer")
def x7(spark: SparkSession, d: str) -> DataFrame:
    a = t(spark, d, "orders").agg(F.lit("orders").alias("input"), F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))
    return a.unionByName(t(spark, d, "customer").agg(F.lit("customer").alias("input"), F.count(F.lit(1)).alias("rows"), F.sum("c_custkey").alias("keys")))
