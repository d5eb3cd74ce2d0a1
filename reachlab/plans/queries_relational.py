"""Sources, predicates, joins, aggregates, windows, sorts and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reachlab.functions import columns as C
from reachlab.operators import relational as R
from reachlab.operators import spatial as S
from reachlab.plans.catalog import query
from reachlab.plans.fixtures import LEGS, LINE, legs, lines, points, points_sql, stops, t, with_point
from reachlab.plans.materialize import keyed, shared_dir
from reachlab.sources import tables as T

_P = points_sql()
_C = points_sql("customer", "c_custkey")
_HAV = "2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))"


def hav(a: str, b: str) -> str:
    return _HAV.format(a=a, b=b)


# -- sources and sinks


@query("s1_csv_scan", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name, n_regionkey::BIGINT AS n_regionkey FROM nation")
def s1(spark: SparkSession, d: str) -> DataFrame:
    path = f"{shared_dir(spark)}/csv-nation"
    t(spark, d, "nation").coalesce(1).write.mode("overwrite").csv(path, header=True)
    return T.csv(spark, path, ["n_nationkey", "n_name", "n_regionkey"]).select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("long").alias("n_regionkey"))


@query("s2_keyed_table", "SELECT c_mktsegment, count(*) AS n, sum(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END)::BIGINT AS in_debt FROM customer GROUP BY 1")
def s2(spark: SparkSession, d: str) -> DataFrame:
    compute = lambda: t(spark, d, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("c_acctbal") < 0).cast("long")).alias("in_debt"))
    return keyed(spark, f"{shared_dir(spark)}/keyed", "segments", {"input": d, "app": spark.sparkContext.applicationId}, compute)


@query("s3_tsv_in_zip", "SELECT r_regionkey::BIGINT AS id, r_name AS name FROM region")
def s3(spark: SparkSession, d: str) -> DataFrame:
    rows = ["# id\tname", *[f"{r.r_regionkey}\t{r.r_name}" for r in t(spark, d, "region").orderBy("r_regionkey").collect()]]  # five rows
    path = T.write_zip(spark, "regions.zip", {"regions.txt": "\n".join(rows) + "\n"})
    return T.zip_lines(spark, path, "regions.txt").filter(~F.col("line").startswith("#")).select(F.split("line", "\t")[0].cast("long").alias("id"), F.split("line", "\t")[1].alias("name"))


@query("s4_taken_stop_times", f"SELECT l_orderkey AS trip, l_linenumber AS seq, l_suppkey AS stop FROM {LINE} WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def s4(spark: SparkSession, d: str) -> DataFrame:
    trips = t(spark, d, "orders").select(F.col("o_orderkey").alias("trip"), F.col("o_orderpriority").alias("route"))
    times = stops(spark, d).select(F.col("route").alias("trip"), "seq", "stop")
    return T.taken_stop_times(times, trips, F.col("route") == "1-URGENT")


_GRID = "grid AS (SELECT (l_partkey % 40)::INT AS row, (l_suppkey % 40)::INT AS col, l_linenumber AS cls, l_quantity AS density FROM lineitem)"


def _grid(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").select((F.col("l_partkey") % 40).cast("int").alias("row"), (F.col("l_suppkey") % 40).cast("int").alias("col"), F.col("l_linenumber").alias("cls"), F.col("l_quantity").alias("density"))


@query("s6_best_class_grid", f"WITH {_GRID} SELECT row, col, min(cls) FILTER (density >= 20) AS best, sum(density)::BIGINT AS total FROM grid GROUP BY 1, 2")
def s6(spark: SparkSession, d: str) -> DataFrame:
    return T.class_grid(_grid(spark, d), 20).select("row", "col", "best", F.col("total").cast("long").alias("total"))


@query("s13_json_lines", """SELECT '{"id":' || n_nationkey || ',"name":"' || n_name || '","region":' || n_regionkey || '}' AS line FROM nation""")
def s13(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "nation").select(F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))).alias("line"))


_U16 = "substr(printf('%04x', {v}), 3, 2) || substr(printf('%04x', {v}), 1, 2)"


@query("s15_u16_rows", f"SELECT c_nationkey AS nation, string_agg({_U16.format(v='m')}, '' ORDER BY c_custkey) AS bytes FROM (SELECT *, CASE WHEN c_acctbal >= 0 AND c_acctbal < 65534 THEN floor(c_acctbal)::INT ELSE 65535 END AS m FROM customer) GROUP BY 1")
def s15(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "customer").select("c_nationkey", "c_custkey", C.u16_hex(C.encode_u16("c_acctbal")).alias("h"))
    return T.packed_rows(rows, "c_nationkey", "c_custkey", "h").select(F.col("c_nationkey").alias("nation"), F.col("packed").alias("bytes"))


@query("s18_positional_manifest", """SELECT r_name AS name, '["' || string_agg(n_name, '","' ORDER BY n_nationkey) || '"]' AS fields FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1""")
def s18(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "nation").join(F.broadcast(t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"])
    return n.groupBy(F.col("r_name").alias("name")).agg(F.to_json(ordered).alias("fields"))


@query("s20_pairs_in_order", f"SELECT a.l_orderkey AS route, a.l_linenumber AS i, a.l_suppkey AS from_stop, b.l_linenumber AS j, b.l_suppkey AS to_stop FROM {LINE} a JOIN {LINE} b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber")
def s20(spark: SparkSession, d: str) -> DataFrame:
    return R.pairs_in_order(stops(spark, d), "route", "seq", "stop")


@query("s21_range_directory", "SELECT p_size AS block, count(*) AS n, (sum(count(*)) OVER (ORDER BY p_size) - count(*))::BIGINT AS first FROM part GROUP BY 1")
def s21(spark: SparkSession, d: str) -> DataFrame:
    return T.range_directory(t(spark, d, "part").select(F.col("p_size").alias("block")), "block")


@query("s25_interned_codes", "SELECT p_partkey, (dense_rank() OVER (ORDER BY p_brand) - 1)::INT AS code FROM part")
def s25(spark: SparkSession, d: str) -> DataFrame:
    return T.interned(t(spark, d, "part"), "p_brand", "code").select("p_partkey", "code")


@query("s26_dense_slots", "SELECT c_custkey, (dense_rank() OVER (ORDER BY c_nationkey) - 1) * 343 + c_custkey % 343 AS slot FROM customer")
def s26(spark: SparkSession, d: str) -> DataFrame:
    return T.interned(t(spark, d, "customer"), "c_nationkey", "block").select("c_custkey", (F.col("block").cast("long") * 343 + F.col("c_custkey") % 343).alias("slot"))


@query("s27_prose_facts", "SELECT 'Segment ' || c_mktsegment || ' has ' || count(*) || ' customers in ' || count(DISTINCT c_nationkey) || ' countries.' AS fact FROM customer GROUP BY c_mktsegment")
def s27(spark: SparkSession, d: str) -> DataFrame:
    g = t(spark, d, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c_nationkey").alias("k"))
    return g.select(F.format_string("Segment %s has %d customers in %d countries.", "c_mktsegment", "n", "k").alias("fact"))


# -- projections and predicates


@query("p1_conjunctive_filter", "SELECT p_partkey, p_size FROM part WHERE p_brand IN ('Brand#11', 'Brand#23', 'Brand#45') AND p_size = 15 AND p_type IS NOT NULL AND length(p_name) >= 5")
def p1(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "part").filter(F.col("p_brand").isin("Brand#11", "Brand#23", "Brand#45") & (F.col("p_size") == 15) & F.col("p_type").isNotNull() & (F.length("p_name") >= 5)).select("p_partkey", "p_size")


@query("p2_strict_recode", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS status FROM orders")
def p2(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").select("o_orderkey", R.recode(F.col("o_orderstatus"), {"F": "finished", "O": "open", "P": "partial"}).alias("status"))


@query("p3_conditional", "SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size FROM part")
def p3(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "part").select("p_partkey", F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "medium").otherwise("large").alias("size"))


@query("p4_null_handling", "SELECT event_id, coalesce(nullif(value, 0), -1) AS value FROM events WHERE user_id IS NOT NULL")
def p4(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").na.drop(subset=["user_id"]).select("event_id", F.coalesce(F.nullif("value", F.lit(0.0)), F.lit(-1.0)).alias("value"))


_RULE = {"narrow": "p_size < 5", "middle": "p_size < 5 OR p_size > 45", "wide": "p_size < 5 OR p_size > 45 OR p_retailprice > 1800"}


@query("p5_rule_predicate", " UNION ALL ".join(f"SELECT '{k}' AS rule, count(*) AS n FROM part WHERE {v}" for k, v in _RULE.items()))
def p5(spark: SparkSession, d: str) -> DataFrame:
    part, held = t(spark, d, "part"), {k: F.expr(v) for k, v in _RULE.items()}
    rules = F.array(*[F.when(c, F.lit(k)) for k, c in held.items()])
    return part.select(F.explode(F.array_compact(rules)).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query("p6_first_rule", "SELECT p_partkey, CASE WHEN regexp_matches(p_type, 'BRASS$') THEN 'brass' WHEN regexp_matches(p_type, '^PROMO') THEN NULL WHEN regexp_matches(p_name, '^[a-h]') THEN 'early' ELSE 'late' END AS tier FROM part")
def p6(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "part").select("p_partkey", R.first_rule([(F.col("p_type").rlike("BRASS$"), "brass"), (F.col("p_type").rlike("^PROMO"), None), (F.col("p_name").rlike("^[a-h]"), "early"), (F.lit(True), "late")]).alias("tier"))


@query("p8_closed_pairs", f"WITH {LEGS} SELECT src, dst FROM legs WHERE (least(src, dst), greatest(src, dst)) NOT IN ((0, 11), (3, 5), (2, 22))")
def p8(spark: SparkSession, d: str) -> DataFrame:
    closed = spark.createDataFrame([(0, 11), (3, 5), (2, 22)], "a int, b int")  # three rows
    return legs(spark, d).join(F.broadcast(closed), (F.least("src", "dst") == F.col("a")) & (F.greatest("src", "dst") == F.col("b")), "left_anti").select("src", "dst")


@query("p10_reasons", "SELECT coalesce(CASE WHEN o_totalprice < 1000 THEN 'cheap' WHEN o_orderstatus = 'P' THEN 'partial' WHEN o_orderpriority = '5-LOW' THEN 'low' END, 'kept') AS reason, count(*) AS n FROM orders GROUP BY 1")
def p10(spark: SparkSession, d: str) -> DataFrame:
    r = R.reasons(t(spark, d, "orders"), [("cheap", F.col("o_totalprice") < 1000), ("partial", F.col("o_orderstatus") == "P"), ("low", F.col("o_orderpriority") == "5-LOW")])
    return r.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("p11_collapsed_calls", f"SELECT route, count(*) AS calls FROM (SELECT l_orderkey AS route, l_suppkey % 10 AS stop, lag(l_suppkey % 10) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS before FROM {LINE}) WHERE before IS NULL OR before <> stop GROUP BY 1")
def p11(spark: SparkSession, d: str) -> DataFrame:
    s = stops(spark, d).withColumn("stop", F.col("stop") % 10)
    s = s.withColumn("before", F.lag("stop").over(Window.partitionBy("route").orderBy("seq")))
    return s.filter(~F.col("before").eqNullSafe(F.col("stop"))).groupBy("route").agg(F.count(F.lit(1)).alias("calls"))


@query("p12_speed_sanity", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 0 AND l_extendedprice / 100 * 60 / (l_quantity + 1) <= 320")
def p12(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").filter((F.col("l_quantity") > 0) & (F.col("l_extendedprice") / 100 * 60 / (F.col("l_quantity") + 1) <= 320)).select("l_orderkey", "l_linenumber")


@query("p13_tag_predicates", """SELECT event_id FROM events WHERE json_extract_string(props, '$.page') IS NOT NULL OR event_type IN ('signup', 'purchase')""")
def p13(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").filter(F.get_json_object("props", "$.page").isNotNull() | F.col("event_type").isin("signup", "purchase")).select("event_id")


@query("p14_superseded", "SELECT p_partkey FROM part WHERE NOT (regexp_matches(p_brand, '#[12]') AND p_size IN (1, 2, 3)) AND NOT (regexp_matches(p_brand, '#3') AND p_size = 9)")
def p14(spark: SparkSession, d: str) -> DataFrame:
    gone = (F.col("p_brand").rlike("#[12]") & F.col("p_size").isin(1, 2, 3)) | (F.col("p_brand").rlike("#3") & (F.col("p_size") == 9))
    return t(spark, d, "part").filter(~gone).select("p_partkey")


@query("p15_guarded_corrections", "SELECT n_nationkey, CASE WHEN n_nationkey = 3 AND n_regionkey = 1 THEN 'CORRECTED' ELSE n_name END AS name FROM nation")
def p15(spark: SparkSession, d: str) -> DataFrame:
    fixes = spark.createDataFrame([(3, 1, "CORRECTED"), (4, 99, "NEVER")], "n_nationkey int, __found int, __new string")
    n = t(spark, d, "nation").join(F.broadcast(fixes), "n_nationkey", "left")
    return n.select("n_nationkey", F.when(F.col("__found") == F.col("n_regionkey"), F.col("__new")).otherwise(F.col("n_name")).alias("name"))


# -- joins


@query("j1_inner", "SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P'")
def j1(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").filter("o_orderstatus = 'P'").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_mktsegment")


_COVERED = f"pairs AS (SELECT l_suppkey AS a, lead(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS b, l_returnflag = 'R' AS timed FROM {LINE})"


def _hops(spark: SparkSession, d: str) -> DataFrame:
    s = lines(spark, d).select(F.col("l_suppkey").alias("a"), F.lead("l_suppkey").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber")).alias("b"), (F.col("l_returnflag") == "R").alias("timed"))
    return s.filter("b IS NOT NULL")


@query("j2_covered_flag", f"WITH {_COVERED}, c AS (SELECT DISTINCT a, b FROM pairs WHERE timed AND b IS NOT NULL) SELECT p.a, p.b, count(*) AS n, bool_or(c.a IS NOT NULL) AS covered FROM pairs p LEFT JOIN c USING (a, b) WHERE p.b IS NOT NULL GROUP BY 1, 2")
def j2(spark: SparkSession, d: str) -> DataFrame:
    h = _hops(spark, d)
    return h.join(h.filter("timed").select("a", "b", F.lit(True).alias("c")).distinct(), ["a", "b"], "left").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bool_or("c"), F.lit(False)).alias("covered"))


@query("j3_anti", f"WITH {_COVERED} SELECT a, b, count(*) AS n FROM pairs p WHERE b IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pairs q WHERE q.timed AND q.a = p.a AND q.b = p.b) GROUP BY 1, 2")
def j3(spark: SparkSession, d: str) -> DataFrame:
    h = _hops(spark, d)
    return h.join(h.filter("timed").select("a", "b"), ["a", "b"], "left_anti").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


@query("j4_semi", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def j4(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "customer").join(t(spark, d, "orders").filter("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("j5_lookup", "SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def j5(spark: SparkSession, d: str) -> DataFrame:
    places = t(spark, d, "nation").join(F.broadcast(t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return t(spark, d, "customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")  # 25 rows by the schema


@query("j6_position_lookup", "WITH s AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS pos FROM (SELECT DISTINCT l_suppkey * 3 AS k FROM lineitem)) SELECT p_partkey, coalesce(pos, -1) AS pos FROM part LEFT JOIN s ON s.k = p_partkey")
def j6(spark: SparkSession, d: str) -> DataFrame:
    ids = T.ordinals(t(spark, d, "lineitem").select((F.col("l_suppkey") * 3).alias("p_partkey")).distinct(), "p_partkey", "pos")
    return t(spark, d, "part").join(ids, "p_partkey", "left").select("p_partkey", F.coalesce("pos", F.lit(-1)).cast("long").alias("pos"))


_QC = "((5::BIGINT << 52) | (least(greatest(floor((lat + 90) * 32 / 180.0), 0), 31)::BIGINT << 26) | (floor((lon + 180) * 32 / 180.0)::BIGINT % 64))"


@query("j7_ring_neighbours", f"WITH p AS (SELECT DISTINCT {_QC} AS cell FROM ({_P})), x AS (SELECT cell, (cell >> 26) & 67108863 AS y, cell & 67108863 AS x FROM p), n AS (SELECT cell, (5::BIGINT << 52) | ((y + i) << 26) | ((x + j + 64) % 64) AS b FROM x, range(-1, 2) a(i), range(-1, 2) c(j) WHERE y + i BETWEEN 0 AND 31 AND (i <> 0 OR j <> 0)) SELECT n.cell AS a, n.b FROM n JOIN p ON p.cell = n.b")
def j7(spark: SparkSession, d: str) -> DataFrame:
    from reachlab.functions import cells as K

    cells = points(spark, d).select(K.quad_cell("lat", "lon", 5).alias("cell")).distinct()
    near = cells.select(F.col("cell").alias("a"), F.explode(K.quad_disk("cell", 5, 1)).alias("b")).filter("a <> b")
    return near.join(cells.withColumnRenamed("cell", "b"), "b", "left_semi").select("a", "b")


@query("j8_nearest_within", f"WITH a AS ({_C}), b AS ({_P}), m AS (SELECT a.k, b.k AS o, round({hav('a', 'b')}, 9) AS km FROM a, b) SELECT k, arg_min(o, struct_pack(km := km, o := o)) AS o, round(min(km), 6) AS km FROM m WHERE km <= 800 GROUP BY k")
def j8(spark: SparkSession, d: str) -> DataFrame:
    left, right = points(spark, d, "customer", "c_custkey"), points(spark, d).select(F.col("k").alias("o"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    return S.nearest(left, right, "k", "o", 800.0).withColumn("km", F.round("km", 6))


@query("j10_nearest_any", f"WITH a AS ({_C}), b AS ({_P}), m AS (SELECT a.k, b.k AS o, round({hav('a', 'b')}, 9) AS km FROM a, b) SELECT k, arg_min(o, struct_pack(km := km, o := o)) AS o, round(min(km), 3) AS km FROM m GROUP BY k")
def j10(spark: SparkSession, d: str) -> DataFrame:
    right = points(spark, d).select(F.col("k").alias("o"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    return S.nearest_any(points(spark, d, "customer", "c_custkey"), right, "k", "o", 2000.0).withColumn("km", F.round("km", 3))


@query("j11_radius_pairs", f"WITH a AS ({_P}) SELECT a.k AS a, b.k AS b, round({hav('a', 'b')}, 6) AS km FROM a, a b WHERE a.k < b.k AND {hav('a', 'b')} <= 1200")
def j11(spark: SparkSession, d: str) -> DataFrame:
    p = points(spark, d)
    return S.within_km(p, p.select(F.col("k").alias("k2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2")), 1200.0).filter("k < k2").select(F.col("k").alias("a"), F.col("k2").alias("b"), F.round("km", 6).alias("km"))


@query("j12_point_in_polygon", f"WITH p AS ({_C}), q AS (SELECT s_suppkey AS id, lat AS y, lon AS x FROM (SELECT s_suppkey, ((s_suppkey * 7919) % 17000) / 100.0 - 85 AS lat, ((s_suppkey * 104729) % 36000) / 100.0 - 180 AS lon FROM supplier)) SELECT p.k, min(q.id)::BIGINT AS polygon FROM p JOIN q ON p.lat >= q.y AND p.lat < q.y + 20 AND p.lon < q.x + 40 AND p.lon >= q.x GROUP BY 1")
def j12(spark: SparkSession, d: str) -> DataFrame:
    c = points(spark, d)
    y, x = F.col("lat"), F.col("lon")
    ring = [(y, x), (y, x + 40), (y + 20, x + 40), (y + 20, x)]
    edges = c.select(F.col("k").alias("polygon"), F.explode(F.array(*[F.struct(ring[i][0].alias("y1"), ring[i][1].alias("x1"), ring[(i + 1) % 4][0].alias("y2"), ring[(i + 1) % 4][1].alias("x2")) for i in range(4)])).alias("e")).select("polygon", "e.*")
    return S.point_in_polygon(points(spark, d, "customer", "c_custkey"), edges, "k", "polygon")


@query("j14_discs", f"WITH a AS ({_C}), b AS ({_P}), m AS (SELECT a.k, b.k AS o, {hav('a', 'b')} / (200 + b.k % 7 * 100) AS s FROM a, b) SELECT k, round(min(s), 6) AS nearest, arg_min(o, struct_pack(s := round(s, 9), o := o)) AS city FROM m WHERE s <= 1 GROUP BY k")
def j14(spark: SparkSession, d: str) -> DataFrame:
    right = points(spark, d).select(F.col("k").alias("o"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    m = S.within_km(points(spark, d, "customer", "c_custkey"), right, 800.0).withColumn("s", F.col("km") / (200 + F.col("o") % 7 * 100)).filter("s <= 1")
    return m.groupBy("k").agg(F.round(F.min("s"), 6).alias("nearest"), F.min_by("o", F.struct(F.round("s", 9), "o")).alias("city"))


_LINKS = "l AS (SELECT a.k AS id, a.lat AS alat, a.lon AS alon, b.lat AS blat, b.lon AS blon FROM pts a JOIN pts b ON b.k = a.k * 3 % 50 + 1)"


@query("j15_corridor", f"WITH pts AS ({_P}), {_LINKS}, r AS (SELECT a.k AS row_no, a.lat AS plat, a.lon AS plon, b.lat AS qlat, b.lon AS qlon FROM pts a JOIN pts b ON b.k = a.k % 50 + 1) SELECT id, min(row_no) AS row_no FROM l, r WHERE "
       + " OR ".join(f"({_HAV.replace('{a}.', 'l.a').replace('{b}.', f'r.{p}')} <= 4000 AND {_HAV.replace('{a}.', 'l.b').replace('{b}.', f'r.{q}')} <= 4000)" for p, q in (("p", "q"), ("q", "p"))) + " GROUP BY 1")
def j15(spark: SparkSession, d: str) -> DataFrame:
    p = points(spark, d)
    a = p.select(F.col("k").alias("ka"), F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"))
    b = p.select(F.col("k").alias("kb"), F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"))
    links = p.select(F.col("k").alias("id"), F.col("k").alias("ka"), (F.col("k") * 3 % 50 + 1).alias("kb")).join(a, "ka").join(b, "kb")
    rows = p.select(F.col("k").alias("row_no"), F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"), (F.col("k") % 50 + 1).alias("kq")).join(p.select(F.col("k").alias("kq"), F.col("lat").alias("q_lat"), F.col("lon").alias("q_lon")), "kq")
    return S.corridor(links, rows, 4000.0)


@query("j16_options", "WITH o AS (SELECT o_custkey AS c, o_orderkey % 5 AS u, o_orderkey % 3 AS v FROM orders) SELECT DISTINCT a.c, a.u, b.v FROM o a JOIN o b ON a.c = b.c")
def j16(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c")).agg(F.collect_set(F.col("o_orderkey") % 5).alias("us"), F.collect_set(F.col("o_orderkey") % 3).alias("vs"))
    return o.select("c", F.explode("us").alias("u"), "vs").select("c", "u", F.explode("vs").alias("v"))


@query("j17_effective", "SELECT o_orderkey FROM orders WHERE CASE o_orderstatus WHEN 'O' THEN o_orderdate::DATE <= DATE '1996-06-30' WHEN 'F' THEN o_orderdate::DATE > DATE '1996-06-30' ELSE o_orderpriority = '5-LOW' END")
def j17(spark: SparkSession, d: str) -> DataFrame:
    change = F.when(F.col("o_orderstatus") == "O", "begins").when(F.col("o_orderstatus") == "F", "ends").when(F.col("o_orderpriority") != "5-LOW", "suspended")
    o = t(spark, d, "orders").select("o_orderkey", change.alias("change"), F.col("o_orderdate").cast("date").alias("on"))
    return R.effective(o, "change", "on", "1996-06-30").select("o_orderkey")


_RW = "least(greatest(floor((90.0 - ({})) * 40 / 180.0), 0), 39)::INT"
_CL = "least(greatest(floor((({}) + 180.0) * 40 / 360.0), 0), 39)::INT"


@query("j18_raster_window", f"WITH {_GRID}, b AS (SELECT row, col, min(cls) AS cls FROM grid GROUP BY 1, 2), p AS ({_C}), w AS (SELECT k, {_RW.format('lat + 5')} AS r0, {_RW.format('lat - 5')} AS r1, {_CL.format('lon - 5')} AS c0, {_CL.format('lon + 5')} AS c1 FROM p) SELECT k, min(cls) AS cls FROM w JOIN b ON row BETWEEN r0 AND r1 AND col BETWEEN c0 AND c1 GROUP BY 1")
def j18(spark: SparkSession, d: str) -> DataFrame:
    grid = _grid(spark, d).groupBy("row", "col").agg(F.min("cls").alias("cls"))
    return S.raster_window(points(spark, d, "customer", "c_custkey"), grid, 5.0, 40, 40, "cls")


@query("j19_symmetrise", f"WITH {LEGS}, s AS (SELECT least(src, dst) AS a, greatest(src, dst) AS b, min(w) AS w FROM legs GROUP BY 1, 2) SELECT a AS src, b AS dst, w FROM s UNION ALL SELECT b, a, w FROM s")
def j19(spark: SparkSession, d: str) -> DataFrame:
    return R.symmetrise(legs(spark, d), "src", "dst", "w")


# -- aggregates


@query("a1_min_any", "SELECT l_suppkey, l_partkey % 20 AS p, min(l_quantity) AS fastest, bool_or(l_returnflag = 'R') AS timed FROM lineitem GROUP BY 1, 2")
def a1(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").groupBy("l_suppkey", (F.col("l_partkey") % 20).alias("p")).agg(F.min("l_quantity").alias("fastest"), F.bool_or(F.col("l_returnflag") == "R").alias("timed"))


@query("a2_centroid", f"SELECT c_nationkey AS nation, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon, arg_min(c_name, c_custkey) AS name FROM customer JOIN ({_C}) ON k = c_custkey GROUP BY 1")
def a2(spark: SparkSession, d: str) -> DataFrame:
    c = with_point(t(spark, d, "customer"), "c_custkey")
    return c.groupBy(F.col("c_nationkey").alias("nation")).agg(F.round(F.avg("lat"), 6).alias("lat"), F.round(F.avg("lon"), 6).alias("lon"), F.min_by("c_name", "c_custkey").alias("name"))


@query("a3_counts", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def a3(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("a4_first_of_group", "SELECT o_custkey, min(o_orderkey) AS first, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS priority FROM orders GROUP BY 1")
def a4(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first"), F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("priority"))


@query("a5_keep_first", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def a5(spark: SparkSession, d: str) -> DataFrame:
    return R.keep_first(t(spark, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("a6_best_extract", "WITH c AS (SELECT l_suppkey AS k, l_returnflag AS g, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT k, g, n FROM c QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, g) = 1")
def a6(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_returnflag").alias("g"))
    return R.pick_group(rows, "k", "g").groupBy("k", "g").agg(F.count(F.lit(1)).alias("n"))


@query("a7_median", "SELECT s_nationkey AS nation, median(s_acctbal) AS med FROM supplier GROUP BY 1")
def a7(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.median("s_acctbal").alias("med"))


@query("a8_majority_fill", "WITH c AS (SELECT o_custkey AS k, o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1, 2) SELECT k, v FROM c QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, v) = 1")
def a8(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("k").agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("b")).select("k", F.col("b.v").alias("v"))


@query("a9_scatter_min_max", "SELECT l_partkey % 100 AS target, min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem GROUP BY 1")
def a9(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").groupBy((F.col("l_partkey") % 100).alias("target")).agg(F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"))


@query("a11_head_of_group", "SELECT l_suppkey, min(l_quantity) AS least, arg_min(id, (l_quantity, id)) AS id FROM (SELECT *, l_orderkey * 10 + l_linenumber AS id FROM lineitem) GROUP BY 1")
def a11(spark: SparkSession, d: str) -> DataFrame:
    b = t(spark, d, "lineitem").groupBy("l_suppkey").agg(F.min(F.struct("l_quantity", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))).alias("b"))
    return b.select("l_suppkey", F.col("b.l_quantity").alias("least"), F.col("b.id").alias("id"))


@query("a13_distinct_having", "SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) >= 2")
def a13(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_distinct("l_returnflag").alias("n")).filter("n >= 2").select("l_orderkey")


@query("a15_harmonic_mean", "SELECT l_orderkey, round(sum(l_quantity) FILTER (l_tax > 0) / sum(l_quantity / (l_tax * 100)) FILTER (l_tax > 0), 6) AS speed, round(coalesce(sum(l_quantity) FILTER (l_tax > 0), 0) / sum(l_quantity), 6) AS cover FROM lineitem GROUP BY 1")
def a15(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("l_tax") * 100
    return t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.round(R.harmonic_mean(F.col("l_quantity"), v), 6).alias("speed"), F.round(F.coalesce(F.sum(F.when(v > 0, F.col("l_quantity"))), F.lit(0.0)) / F.sum("l_quantity"), 6).alias("cover"))


@query("a16_boolean_fold", "WITH a AS (SELECT l_suppkey AS pair, l_linenumber AS airline, bool_and(l_discount <= 0.08) AS yearround FROM lineitem GROUP BY 1, 2) SELECT pair, bool_or(yearround) AS kept FROM a GROUP BY 1")
def a16(spark: SparkSession, d: str) -> DataFrame:
    a = t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("pair"), "l_linenumber").agg(F.bool_and(F.col("l_discount") <= 0.08).alias("y"))
    return a.groupBy("pair").agg(F.bool_or("y").alias("kept"))


@query("a17_set_valued", "SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS priorities FROM orders GROUP BY 1")
def a17(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities"))


@query("a18_fraction", "SELECT event_type, coalesce(avg((value > 50)::INT) FILTER (user_id > 10), 0) AS share FROM events GROUP BY 1")
def a18(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").groupBy("event_type").agg(F.coalesce(F.avg(F.when(F.col("user_id") > 10, (F.col("value") > 50).cast("double"))), F.lit(0.0)).alias("share"))


@query("a19_trimmed_range", "SELECT event_type, l[1 + floor(0.05 * n)::INT] AS low, l[n - floor(0.05 * n)::INT] AS high FROM (SELECT event_type, list_sort(list(value)) AS l, count(value) AS n FROM events GROUP BY 1)")
def a19(spark: SparkSession, d: str) -> DataFrame:
    # the row at a rank, by counts of distinct values: no group is gathered
    per = t(spark, d, "events").filter("value IS NOT NULL").groupBy("event_type", "value").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("event_type").orderBy("value")
    per = per.withColumn("upto", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy("event_type")))
    cut = F.floor(0.05 * F.col("n"))
    return per.groupBy("event_type").agg(F.min(F.when(F.col("upto") >= 1 + cut, F.col("value"))).alias("low"), F.min(F.when(F.col("upto") >= F.col("n") - cut, F.col("value"))).alias("high"))


@query("a20_pattern_merge", f"WITH p AS (SELECT l_orderkey, string_agg((l_suppkey % 4)::VARCHAR, '-' ORDER BY l_linenumber) AS pattern, sum(l_quantity) AS q FROM {LINE} GROUP BY 1) SELECT pattern, count(*) AS trips, min(q)::BIGINT AS least FROM p GROUP BY 1")
def a20(spark: SparkSession, d: str) -> DataFrame:
    p = stops(spark, d).groupBy("route").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "stop"))), lambda x: (x["stop"] % 4).cast("string")), "-").alias("pattern"), F.sum("qty").alias("q"))
    return p.groupBy("pattern").agg(F.count(F.lit(1)).alias("trips"), F.min("q").cast("long").alias("least"))


# -- windows


@query("w1_next_stop", f"SELECT l_orderkey AS route, l_linenumber AS seq, lead(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS next FROM {LINE}")
def w1(spark: SparkSession, d: str) -> DataFrame:
    return R.next_in(stops(spark, d), "route", "seq", "stop", "next").select("route", "seq", "next")


@query("w2_any_over", "SELECT l_orderkey, l_linenumber, bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS covers FROM lineitem")
def w2(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.bool_or(F.col("l_returnflag") == "R").over(Window.partitionBy("l_orderkey")).alias("covers"))


@query("w3_top_one", "SELECT c_nationkey, c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) = 1")
def w3(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "customer").withColumn("n", F.row_number().over(Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey"))).filter("n = 1").select("c_nationkey", "c_custkey")


@query("w4_cumulative", f"SELECT l_orderkey, l_linenumber, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber)::BIGINT AS km FROM {LINE}")
def w4(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber").rowsBetween(Window.unboundedPreceding, 0)
    return lines(spark, d).select("l_orderkey", "l_linenumber", F.sum("l_quantity").over(w).cast("long").alias("km"))


@query("w5_sessions", "WITH g AS (SELECT *, coalesce(epoch(ts)::BIGINT - lag(epoch(ts)::BIGINT) OVER (PARTITION BY user_id ORDER BY ts, event_id) > 900, true)::INT AS new FROM (SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM events)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g) SELECT user_id, session::BIGINT AS session, count(*) AS n, min(event_id) AS first FROM s GROUP BY 1, 2")
def w5(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events").withColumn("ts", F.date_trunc("second", F.col("ts").cast("timestamp")))
    return R.sessions(e, "user_id", "ts", 900, ["ts", "event_id"]).groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"))


@query("w7_rollover", f"WITH c AS (SELECT l_orderkey AS route, l_linenumber AS seq, (l_partkey * 37 % 1440)::BIGINT AS clock FROM {LINE}), b AS (SELECT *, coalesce(clock < lag(clock) OVER (PARTITION BY route ORDER BY seq), false)::INT AS back FROM c) SELECT route, seq, (clock + 1440 * sum(back) OVER (PARTITION BY route ORDER BY seq))::BIGINT AS minutes FROM b")
def w7(spark: SparkSession, d: str) -> DataFrame:
    c = lines(spark, d).select(F.col("l_orderkey").alias("route"), F.col("l_linenumber").alias("seq"), (F.col("l_partkey") * 37 % 1440).alias("clock"))
    return R.rollover(c, "route", "seq", "clock", "minutes").select("route", "seq", "minutes")


@query("w8_search_rank", "SELECT p_partkey, CASE WHEN n = 'the' THEN 0 WHEN starts_with(n, 'al') THEN 1 WHEN contains(' ' || n, ' al') THEN 2 WHEN contains(n, 'al') THEN 3 END AS rank FROM (SELECT p_partkey, lower(p_name) AS n FROM part) WHERE contains(n, 'al')")
def w8(spark: SparkSession, d: str) -> DataFrame:
    r = t(spark, d, "part").select("p_partkey", R.search_rank(F.lower("p_name"), "al").alias("rank"))
    return r.filter("rank IS NOT NULL")


# -- sorts and sets


@query("o1_multi_key_sort", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey) AS pos FROM orders QUALIFY pos <= 100")
def o1(spark: SparkSession, d: str) -> DataFrame:
    top = t(spark, d, "orders").orderBy(F.desc("o_orderpriority"), "o_totalprice", "o_orderkey").limit(100)  # a top-100 report
    return top.select("o_orderkey", F.row_number().over(Window.orderBy(F.desc("o_orderpriority"), "o_totalprice", "o_orderkey")).cast("long").alias("pos"))


@query("o2_ordinals", "SELECT l_partkey AS id, row_number() OVER (ORDER BY l_partkey) - 1 AS ordinal FROM (SELECT DISTINCT l_partkey FROM lineitem)")
def o2(spark: SparkSession, d: str) -> DataFrame:
    return T.ordinals(t(spark, d, "lineitem").select(F.col("l_partkey").alias("id")).distinct(), "id", "ordinal")


@query("o3_top_then_name", "SELECT p_partkey, p_name FROM (SELECT * FROM part ORDER BY p_retailprice, p_partkey LIMIT 60) UNION ALL SELECT -1, 'origin'")
def o3(spark: SparkSession, d: str) -> DataFrame:
    top = t(spark, d, "part").orderBy("p_retailprice", "p_partkey").limit(60).select("p_partkey", "p_name")  # a top-60 report
    return top.unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("p_partkey"), F.lit("origin").alias("p_name"))).orderBy("p_name", "p_partkey")


@query("o4_ranked_gazetteer", "SELECT s_suppkey, rank() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS rank FROM supplier")
def o4(spark: SparkSession, d: str) -> DataFrame:
    return T.ordinals(t(spark, d, "supplier").select("s_suppkey", "s_acctbal"), [F.desc("s_acctbal"), F.col("s_suppkey")], "rank").select("s_suppkey", (F.col("rank") + 1).alias("rank"))


@query("o5_only", "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (1, 5, 9)")
def o5(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "nation").filter(F.col("n_nationkey").isin(1, 5, 9)).select("n_nationkey", "n_name")


@query("o6_thin")
def o6(spark: SparkSession, d: str) -> DataFrame:
    p = with_point(t(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("size")), "k")
    return R.thin(p, "size", "lat", "lon", 1500.0, "k").select("k")


@query("u1_union_by_name", "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def u1(spark: SparkSession, d: str) -> DataFrame:
    a = t(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(t(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), allowMissingColumns=True)


@query("u2_set_difference", "SELECT DISTINCT l_suppkey AS a, l_partkey % 500 AS b FROM lineitem WHERE l_returnflag = 'A' EXCEPT SELECT l_suppkey, l_partkey % 500 FROM lineitem WHERE l_returnflag = 'N'")
def u2(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "lineitem").select(F.col("l_suppkey").alias("a"), (F.col("l_partkey") % 500).alias("b"), "l_returnflag")
    return p.filter("l_returnflag = 'A'").select("a", "b").distinct().join(p.filter("l_returnflag = 'N'"), ["a", "b"], "left_anti")


@query("u3_reverse_union", f"WITH {LEGS} SELECT src, dst FROM legs UNION SELECT dst, src FROM legs")
def u3(spark: SparkSession, d: str) -> DataFrame:
    e = legs(spark, d)
    return e.select("src", "dst").unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


@query("u4_overlap", "WITH s AS (SELECT l_orderkey AS k, list(DISTINCT l_suppkey % 30) AS v FROM lineitem GROUP BY 1) SELECT a.k, list_has_any(a.v, b.v) AS shares FROM s a JOIN s b ON b.k = a.k + 1")
def u4(spark: SparkSession, d: str) -> DataFrame:
    s = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set(F.col("l_suppkey") % 30).alias("v"))
    return s.join(s.select((F.col("k") - 1).alias("k"), F.col("v").alias("o")), "k").select("k", F.arrays_overlap("v", "o").alias("shares"))
