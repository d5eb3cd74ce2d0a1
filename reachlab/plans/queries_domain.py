"""Edge builders, refinement, gathers, page-side queries and builds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reachlab.functions import cells as K
from reachlab.operators import graph as G
from reachlab.operators import relational as R
from reachlab.operators import rules
from reachlab.operators import spatial as S
from reachlab.operators import trees as Tr
from reachlab.plans.catalog import query
from reachlab.plans.fixtures import LEGS, LINE, legs, lines, points, points_sql, t
from reachlab.plans.queries_graph import TREE, WALK, solved
from reachlab.plans.queries_relational import hav
from reachlab.plans.queries_scalar import _CELLS, _QC, _cells
from reachlab.sources import listings

_PLACES = "places AS (SELECT n_nationkey AS airport, CASE WHEN n_regionkey = 3 THEN '' ELSE 'z' || n_regionkey END AS zone FROM nation)"


def _places(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "nation").select(F.col("n_nationkey").alias("airport"), F.when(F.col("n_regionkey") == 3, "").otherwise(F.concat(F.lit("z"), F.col("n_regionkey").cast("string"))).alias("zone"))


_X = "a.zone <> '' AND b.zone <> '' AND a.zone <> b.zone"


@query("m7_two_layers", f"WITH {LEGS}, {_PLACES}, r AS (SELECT src, dst, w, {_X} AS x FROM legs JOIN places a ON a.airport = src JOIN places b ON b.airport = dst) SELECT l1 || ':dep:' || src AS src, l2 || ':arr:' || dst AS dst, w + extra AS w FROM r JOIN (VALUES (false, 'dom', 'dom', 0), (false, 'intl', 'intl', 0), (true, 'dom', 'intl', 25), (true, 'intl', 'intl', 0)) v(x2, l1, l2, extra) ON x = x2")
def m7(spark: SparkSession, d: str) -> DataFrame:
    return rules.route_edges(legs(spark, d), _places(spark, d), 25.0).select("src", "dst", "w")


@query("m9_cell_class", "WITH c AS (SELECT p_partkey AS k, nullif(p_size % 6, 0) AS best, p_size % 4 = 0 AS town, p_size % 7 = 0 AS trunk, p_size = 49 AS motorway FROM part), a AS (SELECT *, CASE WHEN town AND coalesce(best, 0) = 0 THEN 4 ELSE coalesce(best, 0) END AS v FROM c) SELECT k, (CASE WHEN motorway THEN 6 WHEN trunk AND v IN (0, 4, 5) THEN 2 ELSE v END)::INT AS cls FROM a")
def m9(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("p_size")
    c = t(spark, d, "part").select(F.col("p_partkey").alias("k"), F.nullif(s % 6, F.lit(0)).alias("best"), (s % 4 == 0).alias("town"), (s % 7 == 0).alias("trunk"), (s == 49).alias("motorway"))
    return c.select("k", rules.cell_class(c).cast("int").alias("cls"))


@query("m11_port_override", f"WITH p AS ({points_sql('customer', 'c_custkey')}) SELECT k, CASE WHEN lat BETWEEN 10 AND 30 AND lon BETWEEN -50 AND 50 AND k NOT IN (SELECT s_suppkey * 10 FROM supplier) THEN 'port' ELSE 'z' || k % 3 END AS zone FROM p")
def m11(spark: SparkSession, d: str) -> DataFrame:
    p = points(spark, d, "customer", "c_custkey")
    land = t(spark, d, "supplier").select((F.col("s_suppkey") * 10).alias("k"))
    ports = p.filter(F.col("lat").between(10, 30) & F.col("lon").between(-50, 50)).join(land, "k", "left_anti").select("k", F.lit("port").alias("port"))
    return p.join(ports, "k", "left").select("k", F.coalesce("port", F.concat(F.lit("z"), (F.col("k") % 3).cast("string"))).alias("zone"))


@query("m13_income_region", "SELECT c_custkey, (CASE WHEN n_regionkey = 1 THEN 4 WHEN n_regionkey = 3 THEN 3 ELSE n_regionkey % 3 END)::INT AS income, CASE WHEN n_name IN ('UNITED STATES', 'CANADA') OR n_regionkey = 1 THEN 'north' ELSE 'rest' END AS region FROM customer JOIN nation ON n_nationkey = c_nationkey")
def m13(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("n_regionkey")
    n = t(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.when(r == 1, 4).when(r == 3, 3).otherwise(r % 3).cast("int").alias("income"), F.when(F.col("n_name").isin("UNITED STATES", "CANADA") | (r == 1), "north").otherwise("rest").alias("region"))
    return t(spark, d, "customer").join(F.broadcast(n), "c_nationkey").select("c_custkey", "income", "region")


_HOPS = f"h AS (SELECT l_suppkey AS a, lead(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS b, l_quantity AS minutes, l_returnflag = 'R' AS timed FROM {LINE})"


@query("m15_ride_edges", f"WITH {_HOPS} SELECT a, b, min(minutes) AS minutes, bool_or(timed) AS timed FROM h WHERE b IS NOT NULL AND (timed OR (a, b) NOT IN (SELECT (a, b) FROM h WHERE timed AND b IS NOT NULL)) GROUP BY 1, 2")
def m15(spark: SparkSession, d: str) -> DataFrame:
    h = lines(spark, d).select(F.col("l_suppkey").alias("a"), F.lead("l_suppkey").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber")).alias("b"), F.col("l_quantity").alias("minutes"), (F.col("l_returnflag") == "R").alias("timed"))
    return rules.ride_edges(h.filter("b IS NOT NULL"))


@query("m16_station_twins", f"WITH s AS (SELECT k, {_QC} AS cell FROM ({points_sql()})) SELECT cell::VARCHAR || CASE WHEN k % 5 = 0 THEN '~a' ELSE '' END AS station, count(*) AS stops FROM s GROUP BY 1")
def m16(spark: SparkSession, d: str) -> DataFrame:
    s = points(spark, d).select("k", K.quad_cell("lat", "lon", 6).cast("string").alias("cell"))
    return s.groupBy(F.concat("cell", F.when(F.col("k") % 5 == 0, "~a").otherwise("")).alias("station")).agg(F.count(F.lit(1)).alias("stops"))


_FERRY = "f AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_quantity * 100 AS km, l_tax > 0.07 AS severed, CASE WHEN l_suppkey % 11 > 0 THEN l_suppkey END AS cell_a, CASE WHEN l_partkey % 13 > 0 THEN l_partkey % 40 END AS cell_b, l_discount > 0.09 AS closed, l_extendedprice AS minutes FROM lineitem), r AS (SELECT *, CASE WHEN NOT km BETWEEN 1 AND 4000 AND NOT severed THEN 'length' WHEN cell_a IS NULL OR cell_b IS NULL THEN 'off mask' WHEN cell_a = cell_b THEN 'one cell' WHEN closed THEN 'closed' END AS reason FROM f)"


def _ferry(spark: SparkSession, d: str) -> DataFrame:
    f = t(spark, d, "lineitem").select((F.col("l_quantity") * 100).alias("km"), (F.col("l_tax") > 0.07).alias("severed"), F.when(F.col("l_suppkey") % 11 > 0, F.col("l_suppkey")).alias("cell_a"), F.when(F.col("l_partkey") % 13 > 0, F.col("l_partkey") % 40).alias("cell_b"), (F.col("l_discount") > 0.09).alias("closed"), F.col("l_extendedprice").alias("minutes"))
    return rules.ferry_rows(f)


@query("m18_ferry_reasons", f"WITH {_FERRY} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM r GROUP BY 1")
def m18(spark: SparkSession, d: str) -> DataFrame:
    return _ferry(spark, d).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("m18_ferry_edges", f"WITH {_FERRY}, m AS (SELECT least(cell_a, cell_b) AS a, greatest(cell_a, cell_b) AS b, min(minutes) AS w FROM r WHERE reason IS NULL GROUP BY 1, 2) SELECT a AS src, b AS dst, w FROM m UNION ALL SELECT b, a, w FROM m")
def m18e(spark: SparkSession, d: str) -> DataFrame:
    return rules.ferry_edges(_ferry(spark, d))


@query("m20_overfly", "WITH l AS (SELECT l_suppkey AS airline, l_linenumber AS src, l_partkey % 30 AS dst, l_partkey % 17 AS country FROM lineitem), h AS (SELECT DISTINCT airline FROM l WHERE country IN (2, 3) AND airline % 3 = 0) SELECT src, dst, bool_or(h.airline IS NOT NULL) AS overfly FROM l LEFT JOIN h USING (airline) GROUP BY 1, 2")
def m20(spark: SparkSession, d: str) -> DataFrame:
    country = F.when(F.col("l_suppkey") % 3 == 0, (F.col("l_partkey") % 17).cast("string"))
    l = t(spark, d, "lineitem").select(F.col("l_suppkey").alias("airline"), F.col("l_linenumber").alias("src"), (F.col("l_partkey") % 30).alias("dst"), country.alias("country"))
    return rules.overflies(l, ["2", "3"])


@query("m22_timetabled_pairs", f"WITH c AS (SELECT l_orderkey AS trip, l_linenumber AS seq, l_suppkey AS stop, l_linenumber * 10 + l_partkey % 7 AS minute FROM {LINE}) SELECT a.stop AS a, b.stop AS b, min(b.minute - a.minute)::BIGINT AS minutes, count(*) AS trips FROM c a JOIN c b ON a.trip = b.trip AND a.seq < b.seq WHERE b.minute > a.minute AND a.stop <> b.stop GROUP BY 1, 2")
def m22(spark: SparkSession, d: str) -> DataFrame:
    c = lines(spark, d).select(F.col("l_orderkey").alias("trip"), F.col("l_linenumber").alias("seq"), F.col("l_suppkey").alias("stop"), (F.col("l_linenumber") * 10 + F.col("l_partkey") % 7).alias("minute"))
    return rules.timetabled_pairs(c)


@query("m25_zone_of_cell", f"WITH {_CELLS}, {_PLACES} SELECT cell, coalesce(zone, '') AS zone FROM cells LEFT JOIN places ON airport = k % 30")
def m25(spark: SparkSession, d: str) -> DataFrame:
    c = _cells(spark, d).withColumn("airport", (F.col("k") % 30).cast("int"))
    return c.join(F.broadcast(_places(spark, d)), "airport", "left").select("cell", F.coalesce("zone", F.lit("")).alias("zone"))


@query("m26_border_rules", f"WITH {LEGS}, {_PLACES} SELECT src, dst, CASE WHEN {_X} THEN w + 30 ELSE w END AS w FROM legs JOIN places a ON a.airport = src JOIN places b ON b.airport = dst WHERE (least(src, dst), greatest(src, dst)) NOT IN ((1, 2), (0, 4))")
def m26(spark: SparkSession, d: str) -> DataFrame:
    closed = spark.createDataFrame([(2, 1), (0, 4)], "p int, q int")
    e = rules.without_pairs(rules.with_ends(legs(spark, d), _places(spark, d), "airport", ["zone"]), closed, "src", "dst")
    return e.select("src", "dst", F.when(rules.crosses(), F.col("w") + 30).otherwise(F.col("w")).alias("w"))


@query("m28_flown_distance", f"WITH {LEGS} SELECT src, dst, greatest(w, coalesce(flown, w)) AS km FROM legs LEFT JOIN (SELECT s_nationkey AS src, min(s_acctbal) / 20 AS flown FROM supplier WHERE s_nationkey % 2 = 0 GROUP BY 1) USING (src)")
def m28(spark: SparkSession, d: str) -> DataFrame:
    flown = t(spark, d, "supplier").filter("s_nationkey % 2 = 0").groupBy(F.col("s_nationkey").alias("src")).agg((F.min("s_acctbal") / 20).alias("flown"))
    return legs(spark, d).join(flown, "src", "left").select("src", "dst", F.greatest("w", F.coalesce("flown", "w")).alias("km"))


@query("m29_rail_edges", f"WITH r AS (SELECT DISTINCT ON (src, dst) src, dst, w FROM legs ORDER BY src, dst, w), {LEGS} SELECT 'st:' || src AS src, 'st:' || dst AS dst, w FROM legs UNION ALL SELECT 'cell:' || n_nationkey % 7, 'st:' || n_nationkey, 8 FROM nation UNION ALL SELECT 'st:' || n_nationkey, 'cell:' || n_nationkey % 7, 3 FROM nation".replace("r AS (SELECT DISTINCT ON (src, dst) src, dst, w FROM legs ORDER BY src, dst, w), ", ""))
def m29(spark: SparkSession, d: str) -> DataFrame:
    rides = legs(spark, d).select(F.col("src").alias("a"), F.col("dst").alias("b"), F.col("w").alias("minutes"))
    stations = t(spark, d, "nation").select(F.col("n_nationkey").alias("station"), (F.col("n_nationkey") % 7).alias("cell"))
    return rules.rail_edges(rides, stations, 8.0, 3.0).select("src", "dst", "w")


@query("m30_access_edges", "WITH a AS (SELECT n_nationkey AS k, n_nationkey % 7 AS cell, CASE n_nationkey % 3 WHEN 0 THEN 70 WHEN 1 THEN 55 ELSE 40 END + 5.0::DOUBLE AS go, CASE n_nationkey % 3 WHEN 0 THEN 30 WHEN 1 THEN 22 ELSE 15 END + 5.0::DOUBLE AS leave FROM nation) SELECT 'cell:' || cell AS src, 'dom:dep:' || k AS dst, go AS w FROM a UNION ALL SELECT 'dom:arr:' || k, 'cell:' || cell, leave FROM a UNION ALL SELECT 'intl:arr:' || k, 'cell:' || cell, leave FROM a")
def m30(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    a = t(spark, d, "nation").select(k.alias("airport"), (k % 7).alias("cell"), F.when(k % 3 == 0, "large").when(k % 3 == 1, "medium").otherwise("small").alias("size"))
    return rules.access_edges(a, 10.0).select("src", "dst", "w")


# -- refinement and placement


@query("r4_joined_pairs", f"WITH {_CELLS}, x AS (SELECT cell, k, (cell >> 26) & 67108863 AS y, cell & 67108863 AS x FROM cells) SELECT a.cell AS a, b.cell AS b FROM x a JOIN x b ON abs(a.y - b.y) <= 1 AND (abs(a.x - b.x) <= 1 OR abs(a.x - b.x) = 127) AND a.cell <> b.cell WHERE NOT (a.k % 3 = 0 AND b.k % 3 = 1) UNION SELECT a.cell, b.cell FROM x a JOIN x b ON b.k = a.k + 7 WHERE a.k % 10 = 0")
def r4(spark: SparkSession, d: str) -> DataFrame:
    c = _cells(spark, d)
    near = c.select(F.col("cell").alias("a"), F.col("k").alias("ka"), F.explode(K.quad_disk("cell", 6, 1)).alias("b")).filter("a <> b").join(c.select(F.col("cell").alias("b"), F.col("k").alias("kb")), "b")
    severed = near.filter("ka % 3 = 0 AND kb % 3 = 1").select("a", "b")
    spans = c.filter("k % 10 = 0").select(F.col("cell").alias("a"), (F.col("k") + 7).alias("k")).join(c.select(F.col("cell").alias("b"), "k"), "k").select("a", "b")
    return near.select("a", "b").join(severed, ["a", "b"], "left_anti").unionByName(spans).distinct()


@query("r11_crossings", "WITH c AS (SELECT l_orderkey AS component, l_returnflag AS part FROM lineitem) SELECT component FROM c GROUP BY 1 HAVING count(DISTINCT part) >= 2")
def r11(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("component")).agg(F.count_distinct("l_returnflag").alias("n")).filter("n >= 2").select("component")


@query("r12_seams", f"WITH {_CELLS}, x AS (SELECT cell, k % 3 AS part, (cell >> 26) & 67108863 AS y, cell & 67108863 AS x FROM cells) SELECT a.cell FROM x a JOIN x b ON abs(a.y - b.y) <= 2 AND (abs(a.x - b.x) <= 2 OR abs(a.x - b.x) >= 126) GROUP BY 1 HAVING count(DISTINCT b.part) > 1")
def r12(spark: SparkSession, d: str) -> DataFrame:
    c = _cells(spark, d)
    near = c.select("cell", F.explode(K.quad_disk("cell", 6, 2)).alias("b")).join(c.select(F.col("cell").alias("b"), (F.col("k") % 3).alias("part")), "b")
    return near.groupBy("cell").agg(F.count_distinct("part").alias("n")).filter("n > 1").select("cell")


@query("r14_place_on_cells", f"WITH {_CELLS}, p AS (SELECT k, {_QC} AS own FROM ({points_sql()})), x AS (SELECT p.k, own, c.cell IS NOT NULL AS exact FROM p LEFT JOIN cells c ON c.cell = own) SELECT k, CASE WHEN exact THEN 'exact' WHEN EXISTS (SELECT 1 FROM cells c WHERE abs(((c.cell >> 26) & 67108863) - ((own >> 26) & 67108863)) <= 2 AND (abs((c.cell & 67108863) - (own & 67108863)) <= 2 OR abs((c.cell & 67108863) - (own & 67108863)) >= 126)) THEN 'snapped' ELSE 'dropped' END AS how FROM x")
def r14(spark: SparkSession, d: str) -> DataFrame:
    cells = _cells(spark, d).select("cell")
    p = points(spark, d).select("k", K.quad_cell("lat", "lon", 6).alias("own"))
    met = p.select("k", "own", F.explode(K.quad_disk("own", 6, 2)).alias("cell")).join(cells, "cell").groupBy("k").agg(F.bool_or(F.col("cell") == F.col("own")).alias("exact"))
    return p.join(met, "k", "left").select("k", F.when(F.col("exact"), "exact").when(F.col("exact").isNotNull(), "snapped").otherwise("dropped").alias("how"))


@query("b7_slowest_child", f"WITH {_CELLS} SELECT (5::BIGINT << 52) | ((((cell >> 26) & 67108863) >> 1) << 26) | ((cell & 67108863) >> 1) AS parent, max(k) AS slowest, count(*) AS children FROM cells GROUP BY 1")
def b7(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d).groupBy(K.quad_parent("cell").alias("parent")).agg(F.max("k").alias("slowest"), F.count(F.lit(1)).alias("children"))


@query("a21_limit_per_cell", f"WITH s AS (SELECT {_QC} AS cell, l_quantity AS lim FROM lineitem JOIN ({points_sql()}) ON k = l_suppkey) SELECT cell, max(lim) AS lim FROM s GROUP BY 1")
def a21(spark: SparkSession, d: str) -> DataFrame:
    at = points(spark, d).select(F.col("k").alias("l_suppkey"), K.quad_cell("lat", "lon", 6).alias("cell"))
    return t(spark, d, "lineitem").join(at, "l_suppkey").groupBy("cell").agg(F.max("l_quantity").alias("lim"))


_OWN = hav("own", "o").replace("o.lat", "own.y").replace("o.lon", "own.x")


@query("p9_misresolved", f"WITH a AS ({points_sql('customer', 'c_custkey')}), b AS ({points_sql()}), own AS (SELECT a.*, b.lat AS y, b.lon AS x FROM a JOIN b ON b.k = a.k % 40 + 1), n AS (SELECT a.k, min({hav('a', 'b')}) AS near FROM a, b GROUP BY 1) SELECT own.k, {_OWN} > 5000 AND near < 0.5 * {_OWN} AS wrong FROM own JOIN n USING (k)")
def p9(spark: SparkSession, d: str) -> DataFrame:
    from reachlab.functions.columns import haversine_km

    a = points(spark, d, "customer", "c_custkey")
    b = points(spark, d).select(F.col("k").alias("o"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    near = S.nearest_any(a, b, "k", "o", 2000.0).select("k", F.col("km").alias("near"))
    own = a.withColumn("o", F.col("k") % 40 + 1).join(b, "o").withColumn("km", haversine_km("lat", "lon", "lat2", "lon2"))
    return own.join(near, "k").select("k", ((F.col("km") > 5000) & (F.col("near") < 0.5 * F.col("km"))).alias("wrong"))


# -- trees and page-side queries


@query("t5_last_marked_of_path", f"{WALK} SELECT node, list_filter(path, lambda x: x % 4 = 2)[-1] AS arrival FROM p WHERE node <> 0")
def t5(spark: SparkSession, d: str) -> DataFrame:
    return Tr.nearest_marked(solved(spark, d), F.col("node") % 4 == 2).filter("node <> 0").select("node", F.col("ancestor").alias("arrival"))


@query("g13_own_parent", f"{TREE} SELECT node, coalesce(prev, node) AS parent FROM tree")
def g13(spark: SparkSession, d: str) -> DataFrame:
    return solved(spark, d).select("node", F.coalesce("prev", "node").alias("parent"))


@query("l1_hover_ordinal", f"WITH {_CELLS}, o AS (SELECT cell, row_number() OVER (ORDER BY cell) - 1 AS ordinal FROM cells) SELECT p.k, coalesce(ordinal, -1) AS ordinal FROM (SELECT k, {_QC} AS cell FROM ({points_sql()})) p LEFT JOIN o USING (cell)")
def l1(spark: SparkSession, d: str) -> DataFrame:
    from reachlab.sources.tables import ordinals

    o = ordinals(_cells(spark, d).select("cell"), "cell", "ordinal")
    return points(spark, d).select("k", K.quad_cell("lat", "lon", 6).alias("cell")).join(o, "cell", "left").select("k", F.coalesce("ordinal", F.lit(-1).cast("long")).alias("ordinal"))


@query("l3_slot_override", "SELECT p_partkey AS slot, coalesce(o.airport, p_partkey % 9) AS airport FROM part LEFT JOIN (SELECT s_suppkey * 7 AS slot, min(s_nationkey)::BIGINT AS airport FROM supplier GROUP BY 1) o ON o.slot = p_partkey")
def l3(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "supplier").groupBy((F.col("s_suppkey") * 7).alias("slot")).agg(F.min("s_nationkey").cast("long").alias("airport"))
    return t(spark, d, "part").select(F.col("p_partkey").alias("slot")).join(o, "slot", "left").select("slot", F.coalesce("airport", F.col("slot") % 9).alias("airport"))


@query("l4_spliced_itinerary", f"{WALK} SELECT node, array_to_string(list_concat(['start'], list_transform(path, lambda x: x::VARCHAR)), '>') AS chain, len(path) > 24 AS partial FROM p")
def l4(spark: SparkSession, d: str) -> DataFrame:
    p = Tr.paths(solved(spark, d))
    return p.select("node", F.array_join(F.concat(F.array(F.lit("start")), F.transform("path", lambda x: x.cast("string"))), ">").alias("chain"), (F.size("path") > 24).alias("partial"))


@query("l6_one_row_per_city", f"WITH a AS ({points_sql()}), b AS ({points_sql('customer', 'c_custkey')}), m AS (SELECT a.k AS city, b.k AS place, {hav('a', 'b')} AS km FROM a, b) SELECT city, arg_min(place, (round(km, 9), place)) AS place FROM m WHERE km <= 400 GROUP BY 1")
def l6(spark: SparkSession, d: str) -> DataFrame:
    b = points(spark, d, "customer", "c_custkey").select(F.col("k").alias("place"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    return S.nearest(points(spark, d), b, "k", "place", 400.0).select(F.col("k").alias("city"), "place")


@query("l9_block_range", f"WITH {_CELLS}, b AS (SELECT (3::BIGINT << 52) | ((((cell >> 26) & 67108863) >> 3) << 26) | ((cell & 67108863) >> 3) AS block, k FROM cells), o AS (SELECT DISTINCT block FROM b ORDER BY block LIMIT 32) SELECT block, count(*) AS n, sum(k)::BIGINT AS total FROM b JOIN o USING (block) GROUP BY 1")
def l9(spark: SparkSession, d: str) -> DataFrame:
    b = _cells(spark, d).select(K.quad_parent("cell", 3).alias("block"), "k")
    wanted = b.select("block").distinct().orderBy("block").limit(32)  # a request's blocks
    return b.join(F.broadcast(wanted), "block", "left_semi").groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))


@query("l10_path_or_turns", f"WITH {LEGS} SELECT src, dst, CASE WHEN (src + dst) % 4 = 0 THEN 'turns' ELSE 'arc' END AS shape FROM legs")
def l10(spark: SparkSession, d: str) -> DataFrame:
    e = legs(spark, d)
    turns = e.filter((F.col("src") + F.col("dst")) % 4 == 0).select("src", "dst", F.lit("turns").alias("shape"))
    return e.join(turns, ["src", "dst"], "left").select("src", "dst", F.coalesce("shape", F.lit("arc")).alias("shape"))


# -- listings, gates, builds

_ARTICLES = [
    ("A", "== Airlines and destinations ==\n=== Passenger ===\n{{list|X|[[Paris]], [[Rome#T1|Rome]] (begins 3 May 2026)<br>'''Seasonal:''' [[Oslo]], [[Bergen]] (both end October 2026)|Y|[[Lima]] (suspended)}}\n=== Cargo ===\n[[Freight Hub]]\n== History ==\n[[Old]]"),
    ("B", "no list"),
]
_LISTED = [("A", "Paris", "scheduled", None, None), ("A", "Rome", "scheduled", "begins", "2026-05-03"), ("A", "Oslo", "seasonal", "ends", "2026-10-01"), ("A", "Bergen", "seasonal", "ends", "2026-10-01"), ("A", "Lima", "scheduled", "suspended", None)]


@query("s10_listings", "SELECT article, title, service, change, day::DATE AS day FROM (VALUES " + ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in r) + ")" for r in _LISTED) + ") v(article, title, service, change, day)")
def s10(spark: SparkSession, d: str) -> DataFrame:
    return listings.listings(spark.createDataFrame(_ARTICLES, "article string, text string")).withColumnRenamed("on", "day")


@query("s17_bundle_counts", f"WITH {LEGS} SELECT count(*) AS edges, (SELECT count(*) FROM (SELECT src FROM legs UNION SELECT dst FROM legs)) AS nodes, max(w) AS longest FROM legs")
def s17(spark: SparkSession, d: str) -> DataFrame:
    e = legs(spark, d)
    nodes = e.select("src").union(e.select("dst")).distinct().agg(F.count(F.lit(1)).alias("nodes"))
    return e.agg(F.count(F.lit(1)).alias("edges"), F.max("w").alias("longest")).join(nodes, F.col("edges") >= 0).select("edges", "nodes", "longest")


@query("s23_latest_version", "SELECT user_id, max(ts) AS ts, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1")
def s23(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("ts"), F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type"))


@query("s28_union_of_extracts", "WITH x AS (SELECT c_nationkey % 7 AS extract, c_custkey AS id, c_name FROM customer UNION ALL SELECT c_nationkey % 5, c_custkey, c_name FROM customer) SELECT id, min(extract)::INT AS extract FROM x GROUP BY 1")
def s28(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "customer")
    part = lambda m: c.select((F.col("c_nationkey") % m).cast("int").alias("extract"), F.col("c_custkey").alias("id"), "c_name")
    return R.keep_first(part(7).unionByName(part(5)), ["id"], [F.col("extract")]).select("id", "extract")


@query("v7_schema_drift", "SELECT column_name AS missing FROM (VALUES ('n_population')) v(column_name)")
def v7(spark: SparkSession, d: str) -> DataFrame:
    want = spark.createDataFrame([("n_name",), ("n_regionkey",), ("n_population",)], "missing string")
    have = spark.createDataFrame([(c,) for c in t(spark, d, "nation").columns], "missing string")
    return want.join(have, "missing", "left_anti")


@query("v9_audit", "SELECT c_nationkey AS nation, count(*) * 2 AS bytes, count(DISTINCT c_mktsegment) <= 5 AS ok FROM customer GROUP BY 1")
def v9(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg((F.count(F.lit(1)) * 2).alias("bytes"), (F.count_distinct("c_mktsegment") <= 5).alias("ok"))


@query("c4_class_speeds")
def c4(spark: SparkSession, d: str) -> DataFrame:
    from reachlab.operators import calib

    j = t(spark, d, "lineitem").select(*[F.when(F.col("l_linenumber") % 3 == i, F.col("l_quantity")).otherwise(F.col("l_quantity") / 5).alias(f"k{i}") for i in range(3)])
    j = j.withColumn("m", 60 * (F.col("k0") / 90 + F.col("k1") / 60 + F.col("k2") / 30))
    v = calib.class_speeds(j, ["k0", "k1", "k2"], "m")
    return spark.createDataFrame([(i, round(float(x), 6)) for i, x in enumerate(v)], "cls int, kmh double")


@query("c8_stratified_sample", "SELECT o_orderpriority AS stratum, count(*) AS n FROM (SELECT o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS i FROM orders) WHERE i <= 40 GROUP BY 1")
def c8(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_orderpriority").orderBy(F.xxhash64("o_orderkey"), "o_orderkey")
    return t(spark, d, "orders").withColumn("i", F.row_number().over(w)).filter("i <= 40").groupBy(F.col("o_orderpriority").alias("stratum")).agg(F.count(F.lit(1)).alias("n"))  # a sampling operator


@query("x10_input_check", "SELECT name, present FROM (VALUES ('documents', true), ('nation', true), ('orders', true), ('roads', false)) v(name, present)")
def x10(spark: SparkSession, d: str) -> DataFrame:
    from reachlab.plans.materialize import exists

    return spark.createDataFrame([(n, exists(spark, f"{d}/{n}.parquet")) for n in ("documents", "nation", "orders", "roads")], "name string, present boolean")


@query("g12_per_origin_build", "SELECT n_nationkey AS origin, true AS complete FROM nation")
def g12(spark: SparkSession, d: str) -> DataFrame:
    from reachlab.plans.fixtures import t as table

    origins = table(spark, d, "nation").select(F.col("n_nationkey").alias("origin"), F.col("n_nationkey").alias("node"))
    e = legs(spark, d)
    tree = G.shortest_paths(e, origins)
    late = tree.select("origin", F.col("node").alias("src"), F.col("d").alias("da")).join(e, "src").join(tree.select("origin", F.col("node").alias("dst"), F.col("d").alias("db")), ["origin", "dst"], "left")
    bad = late.groupBy("origin").agg(F.bool_and(F.col("db") <= F.col("da") + F.col("w") + 1e-6).alias("ok"))
    return origins.select("origin").join(bad, "origin", "left").select("origin", F.coalesce("ok", F.lit(True)).alias("complete"))
