"""Scalar functions, cells and the cost model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reachlab.functions import cells as K
from reachlab.functions import columns as C
from reachlab.functions import cost as M
from reachlab.operators import spatial as S
from reachlab.plans.catalog import query
from reachlab.plans.fixtures import LINE, lines, points, points_sql, t, with_point
from reachlab.plans.queries_relational import hav

_P, _C = points_sql(), points_sql("customer", "c_custkey")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each customer with the supplier of number c_custkey % 40 + 1."""
    a = with_point(t(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_nationkey"), "k")
    b = points(spark, d).select(F.col("k").alias("o"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    return a.withColumn("o", F.col("k") % 10 + 1).join(b, "o")


_PAIRS = f"a AS (SELECT p.*, p.k % 10 + 1 AS o FROM ({_C}) p), b AS ({_P})"
_JOIN = "FROM a JOIN b ON b.k = a.o"


@query("f1_haversine", f"WITH {_PAIRS} SELECT a.k, round({hav('a', 'b')}, 3) AS km, round({hav('a', 'b')} / 6371.0088 * 6371.0, 3) AS km_round {_JOIN}")
def f1(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("k", F.round(C.haversine_km("lat", "lon", "lat2", "lon2"), 3).alias("km"), F.round(C.haversine_km("lat", "lon", "lat2", "lon2", C.R_ROUND), 3).alias("km_round"))


@query("f2_flat_distance", f"WITH {_PAIRS} SELECT a.k, round(sqrt(pow((b.lat - a.lat) * 111.0, 2) + pow((b.lon - a.lon) * 111.0 * cos(radians(a.lat)), 2)), 6) AS km, round(sqrt(pow((b.lat - a.lat) * 111.32, 2) + pow((fmod(b.lon - a.lon + 540.0, 360.0) - 180.0) * 111.32 * cos(radians(a.lat)), 2)), 6) AS wrapped {_JOIN}")
def f2(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("k", F.round(C.flat_km("lat", "lon", "lat2", "lon2"), 6).alias("km"), F.round(C.flat_km("lat", "lon", "lat2", "lon2", 111.32, True), 6).alias("wrapped"))


@query("f3_great_circle_points", f"""WITH {_PAIRS}, m AS (SELECT a.k, a.lat AS y1, a.lon AS x1, b.lat AS y2, b.lon AS x2, {hav('a', 'b')} / 6371.0088 AS d {_JOIN}),
s AS (SELECT *, unnest(range(0, 5)) AS i FROM m), w AS (SELECT *, sin((1 - i / 4.0) * d) / sin(d) AS p, sin(i / 4.0 * d) / sin(d) AS q FROM s),
v AS (SELECT k, i, p * cos(radians(y1)) * cos(radians(x1)) + q * cos(radians(y2)) * cos(radians(x2)) AS x, p * cos(radians(y1)) * sin(radians(x1)) + q * cos(radians(y2)) * sin(radians(x2)) AS y, p * sin(radians(y1)) + q * sin(radians(y2)) AS z FROM w)
SELECT k, i, round(degrees(atan2(z, sqrt(x * x + y * y))), 5) AS lat, round(degrees(atan2(y, x)), 5) AS lon FROM v""")
def f3(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d).select("k", F.posexplode(C.great_circle("lat", "lon", "lat2", "lon2", F.lit(4))).alias("i", "p"))
    return p.select("k", F.col("i").cast("long").alias("i"), F.round("p.lat", 5).alias("lat"), F.round("p.lon", 5).alias("lon"))


@query("f4_unit_vectors", f"SELECT k, round(cos(radians(lat)) * cos(radians(lon)), 9) AS x, round(cos(radians(lat)) * sin(radians(lon)), 9) AS y, round(sin(radians(lat)), 9) AS z FROM ({_C})")
def f4(spark: SparkSession, d: str) -> DataFrame:
    return points(spark, d, "customer", "c_custkey").select("k", C.unit_xyz("lat", "lon").alias("v")).select("k", *[F.round(f"v.{i}", 9).alias(i) for i in "xyz"])


_HEX = "((1::BIGINT << 59) | (6::BIGINT << 52) | ((k % 122) << 45) | (((k // 7) % 7) << 42) | ((k % 7) << 39) | (((k * 3) % 7) << 36) | (((k * 5) % 7) << 33) | (((k // 3) % 7) << 30) | (((k // 11) % 7) << 27) | 134217727)"


def _hex(spark: SparkSession, d: str) -> DataFrame:
    k = lambda e: F.expr(f"cast({e} as bigint)")
    digits = ["(k div 7) % 7", "k % 7", "(k * 3) % 7", "(k * 5) % 7", "(k div 3) % 7", "(k div 11) % 7"]
    cell = F.lit((1 << 59) | (6 << 52) | 134217727).cast("long").bitwiseOR(F.shiftleft(k("k % 122"), 45))
    for r, e in enumerate(digits, 1):
        cell = cell.bitwiseOR(F.shiftleft(k(e), 45 - 3 * r))
    return t(spark, d, "customer").select(F.col("c_custkey").alias("k")).withColumn("cell", cell)


@query("f5_hex_parent_slot", f"WITH c AS (SELECT k, {_HEX} AS cell FROM (SELECT c_custkey AS k FROM customer)) SELECT k, (cell & ~(15::BIGINT << 52)) | (3::BIGINT << 52) | 68719476735 AS parent, ((((cell >> 33) & 7) * 7 + ((cell >> 30) & 7)) * 7 + ((cell >> 27) & 7))::INT AS slot, ((cell >> 52) & 15)::INT AS res, true AS valid FROM c")
def f5(spark: SparkSession, d: str) -> DataFrame:
    return _hex(spark, d).select("k", K.hex_parent("cell", 3).alias("parent"), K.hex_slot("cell", 3, 6).alias("slot"), K.hex_resolution("cell").alias("res"), K.hex_valid("cell").alias("valid"))


@query("f5_hex_children", f"WITH c AS (SELECT k, {_HEX} AS cell FROM (SELECT c_custkey AS k FROM customer)) SELECT k, i AS digit, (cell & ~(15::BIGINT << 52) & ~(7::BIGINT << 24)) | (7::BIGINT << 52) | (i << 24) AS child FROM c, range(0, 7) r(i)")
def f5c(spark: SparkSession, d: str) -> DataFrame:
    return _hex(spark, d).select("k", F.posexplode(K.hex_children("cell", 7)).alias("digit", "child")).withColumn("digit", F.col("digit").cast("long"))


@query("f5_center_child", f"WITH c AS (SELECT k, {_HEX} AS cell FROM (SELECT c_custkey AS k FROM customer)) SELECT k, (cell & ~(15::BIGINT << 52) & ~(63::BIGINT << 21)) | (8::BIGINT << 52) AS child FROM c")
def f5m(spark: SparkSession, d: str) -> DataFrame:
    return _hex(spark, d).select("k", K.hex_center_child("cell", 8).alias("child"))


_QC = "((6::BIGINT << 52) | (least(greatest(floor((lat + 90) * 64 / 180.0), 0), 63)::BIGINT << 26) | (floor((lon + 180) * 64 / 180.0)::BIGINT % 128))"


@query("f6_quad_cells", f"WITH c AS (SELECT k, {_QC} AS cell FROM ({_C})) SELECT k, cell, (4::BIGINT << 52) | ((((cell >> 26) & 67108863) >> 2) << 26) | ((cell & 67108863) >> 2) AS parent, ((((cell >> 26) & 67108863) % 4) * 4 + (cell & 67108863) % 4)::INT AS slot FROM c")
def f6(spark: SparkSession, d: str) -> DataFrame:
    c = points(spark, d, "customer", "c_custkey").select("k", K.quad_cell("lat", "lon", 6).alias("cell"))
    return c.select("k", "cell", K.quad_parent("cell", 2).alias("parent"), K.quad_slot("cell", 2).alias("slot"))


_EDGES = "[" + ", ".join(map(str, C.BAND_EDGES)) + "]"


@query("f7_band_of", f"SELECT c_custkey, coalesce(len(list_filter({_EDGES}, lambda e: m > e)), -1)::INT AS band FROM (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 2) END AS m FROM customer) WHERE m IS NOT NULL UNION ALL SELECT c_custkey, -1 FROM customer WHERE c_acctbal < 0")
def f7(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "customer").select("c_custkey", C.band_of(F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 2))).alias("band"))


@query("f8_band_exclusive", f"SELECT o_orderkey, len(list_filter({_EDGES}, lambda e: (o_orderkey % 5000) >= e))::INT AS band FROM orders")
def f8(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").select("o_orderkey", C.band_exclusive(F.col("o_orderkey") % 5000).alias("band"))


@query("f9_bucket_right", "SELECT l_quantity AS q, (l_quantity >= 10)::INT + (l_quantity >= 20)::INT + (l_quantity >= 40)::INT AS bucket, count(*) AS n FROM lineitem GROUP BY 1, 2")
def f9(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").groupBy(F.col("l_quantity").alias("q"), C.bucket_right("l_quantity", (10, 20, 40)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def _cases(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _values(rows: list[tuple], names: str) -> str:
    lit = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"
    return f"(VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) v({names})"


# literal cases with their expected values: the tables hold no such strings
_MIN = [("1:30", 90.0), ("144:00", 8640.0), ("0:00:30", 0.5), ("45", 45.0), ("PT2H30M", 150.0), ("P1DT1H", 1500.0), ("P", None), ("On request", None), ("1:75", None), (" 2:05 ", 125.0), ("PT1.5H", 90.0), (None, None), ("", None)]


@query("f10_parse_minutes", f"SELECT raw, minutes::DOUBLE AS minutes, (SELECT count(*) FROM orders) AS n FROM {_values(_MIN, 'raw, minutes')}")
def f10(spark: SparkSession, d: str) -> DataFrame:
    return _cases(spark, [(r,) for r, _ in _MIN], "raw string").select("raw", C.parse_minutes("raw").alias("minutes"), F.lit(t(spark, d, "orders").count()).alias("n"))


_SERVICE = [("", "24/7", 1.0), ("yes", "", 5 / 12), ("summer", "", 0.25), ("spring;summer;autumn", "", 0.75), ("no", "", 1.0), ("", "Apr-Oct Mo-Fr 08:00", 7 / 12), ("november - march", "", 5 / 12), ("limited", "", 1.0), (None, None, 1.0), ("1", None, 5 / 12)]


@query("f11_service_fraction", f"SELECT seasonal, hours, round(share, 9)::DOUBLE AS share FROM {_values([(*r[:2], float(r[2])) for r in _SERVICE], 'seasonal, hours, share')}")
def f11(spark: SparkSession, d: str) -> DataFrame:
    return _cases(spark, [r[:2] for r in _SERVICE], "seasonal string, hours string").select("seasonal", "hours", F.round(C.service_fraction("seasonal", "hours"), 9).alias("share"))


_SPEED = [("100", 100.0), ("70 mph", 112.65408), ("100;80", 100.0), ("none", None), (None, None), ("80.5 km/h", 80.5), (" 60", 60.0), ("RU:urban", None)]


@query("f12_maxspeed", f"SELECT raw, kmh::DOUBLE AS kmh FROM {_values(_SPEED, 'raw, kmh')}")
def f12(spark: SparkSession, d: str) -> DataFrame:
    return _cases(spark, [(r,) for r, _ in _SPEED], "raw string").select("raw", F.round(C.parse_maxspeed("raw"), 6).alias("kmh"))


@query("f13_clock_minutes", "SELECT o_orderkey, (o_orderkey % 30) * 60 + o_orderkey % 60 + 0.5 AS minutes FROM orders")
def f13(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").select("o_orderkey", C.clock_minutes(F.format_string("%d:%02d:30", F.col("o_orderkey") % 30, F.col("o_orderkey") % 60)).alias("minutes"))


_DATES = [("from 25 October 2026", False, "2026-10-25"), ("October 25, 2026", False, "2026-10-25"), ("begins Oct 2026", False, "2026-10-31"), ("ends February 2028", True, "2028-02-01"), ("2027", False, "2027-12-31"), ("2027", True, "2027-01-01"), ("31 June 2026", False, None), ("Foo 2026", False, None), ("soon", False, None), ("4 july, 2025", True, "2025-07-04")]


@query("f14_change_date", f"SELECT raw, ends, CAST(d AS DATE) AS day FROM {_values(_DATES, 'raw, ends, d')}")
def f14(spark: SparkSession, d: str) -> DataFrame:
    return _cases(spark, [r[:2] for r in _DATES], "raw string, ends boolean").select("raw", "ends", C.change_date("raw", F.col("ends")).alias("day"))


_CHANGES = [("begins", "begins"), ("Starts", "begins"), ("commences", "begins"), ("ends", "ends"), ("resumes", "resumes"), ("suspended until May 2026", "resumes"), ("suspended", "suspended"), ("Terminated", "suspended"), ("cancelled", "suspended"), ("temporarily suspended", "suspended"), ("temporarily suspended until May 2026", "resumes"), ("other", None)]


@query("f15_change_kind", f"SELECT word, kind FROM {_values(_CHANGES, 'word, kind')}")
def f15(spark: SparkSession, d: str) -> DataFrame:
    return _cases(spark, [(w,) for w, _ in _CHANGES], "word string").select("word", C.change_kind("word").alias("kind"))


_LABELS = [("Seasonal:", "seasonal"), ("Seasonal charter", "seasonal charter"), ("Charter:", "charter"), ("Year-round", "scheduled"), ("Scheduled:", "scheduled"), ("Cargo", "other")]


@query("f16_service_of", f"SELECT label, kind FROM {_values(_LABELS, 'label, kind')}")
def f16(spark: SparkSession, d: str) -> DataFrame:
    return _cases(spark, [(w,) for w, _ in _LABELS], "label string").select("label", C.service_of("label").alias("kind"))


@query("f17_article_title", "SELECT page_id, replace(url_decode(regexp_extract(regexp_replace(url, '[#?].*$', ''), '([^/]*)$', 1)), ' ', '_') AS title FROM pages")
def f17(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "pages").select("page_id", C.article_title("url").alias("title"))


_TIERS = [("regional", False, "regional"), ("long_distance;commuter", False, "commuter"), ("x", False, "default"), (None, False, "default"), ("commuter", True, "high_speed"), ("high_speed; regional", False, "regional"), ("suburban", False, "commuter"), ("national; international", False, "long_distance"), ("tourist;night", False, "tourism"), ("default", False, "default")]


@query("f18_service_tier", f"SELECT raw, fast, tier FROM {_values(_TIERS, 'raw, fast, tier')}")
def f18(spark: SparkSession, d: str) -> DataFrame:
    return _cases(spark, [r[:2] for r in _TIERS], "raw string, fast boolean").select("raw", "fast", C.service_tier("raw", F.col("fast")).alias("tier"))


@query("f19_fold", r"SELECT doc_id, trim(regexp_replace(strip_accents(lower(text)), '[^\p{L}\p{N}]+', ' ', 'g')) AS folded FROM documents")
def f19(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", C.fold("text").alias("folded"))


@query("f20_drop_false_via", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_name || ' (via ' || n_name || ')' ELSE s_name END AS label FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def f20(spark: SparkSession, d: str) -> DataFrame:
    s = t(spark, d, "supplier").join(F.broadcast(t(spark, d, "nation")), F.col("n_nationkey") == F.col("s_nationkey"))
    label = F.concat("s_name", F.lit(" (via "), "n_name", F.lit(")"))
    path = F.when(F.col("s_suppkey") % 3 == 0, F.array("n_name", F.lit("x"))).otherwise(F.array(F.lit("x")))
    via = F.split(F.regexp_extract(label, r"\(via ([^()]*)\)", 1), ", ")
    return s.select("s_suppkey", F.when(F.size(F.array_except(via, path)) == 0, label).otherwise(F.regexp_replace(label, r"\s*\(via [^()]*\)", "")).alias("label"))


@query("f21_encode_minutes", "SELECT o_orderkey, CASE WHEN o_totalprice >= 0 AND o_totalprice < 65534 THEN floor(o_totalprice)::INT ELSE 65535 END AS code FROM orders")
def f21(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").select("o_orderkey", C.encode_u16("o_totalprice").alias("code"))


@query("f22_half_even", "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS r FROM lineitem")
def f22(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", C.half_even(F.col("l_quantity") / 2).alias("r"))


@query("f23_params_hash", """SELECT n_nationkey, sha256('{"id":' || n_nationkey || ',"name":"' || n_name || '"}') AS digest FROM nation""")
def f23(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "nation").select("n_nationkey", F.sha2(F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))), 256).alias("digest"))


@query("f24_route_id", "SELECT c_custkey, -(('0x' || substr(sha1(c_name || '|' || c_mktsegment), 1, 12))::BIGINT + 1) AS id FROM customer")
def f24(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "customer").select("c_custkey", C.route_id("c_name", "c_mktsegment").alias("id"))


@query("f25_densify", f"WITH {_PAIRS}, m AS (SELECT a.k, a.lat AS y1, a.lon AS x1, b.lat AS y2, b.lon AS x2, greatest(ceil({hav('a', 'b')} / 500.0), 1)::BIGINT AS n {_JOIN}) SELECT k, count(*) AS points, round(sum(y), 4) AS lats FROM (SELECT k, y1 + (y2 - y1) * i / n AS y FROM (SELECT *, unnest(range(0, CASE WHEN abs(x2 - x1) > 180 THEN 1 ELSE n END)) AS i FROM m) UNION ALL SELECT k, y2 FROM m) GROUP BY k")
def f25(spark: SparkSession, d: str) -> DataFrame:
    line = F.array(F.struct("lat", "lon"), F.struct(F.col("lat2").alias("lat"), F.col("lon2").alias("lon")))
    p = _pairs(spark, d).select("k", F.explode(C.densify(line, 500.0)).alias("p"))
    return p.groupBy("k").agg(F.count(F.lit(1)).alias("points"), F.round(F.sum("p.lat"), 4).alias("lats"))


@query("f26_arrays", "SELECT doc_id, len(string_split(text, ' ')) AS words, string_split(text, ' ')[1] AS first FROM documents")
def f26(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", F.size(F.split("text", " ")).cast("long").alias("words"), F.split("text", " ")[0].alias("first"))


@query("f27_antimeridian", f"WITH {_PAIRS} SELECT a.k, abs(b.lon - a.lon) > 180 AS crosses, round(b.lon - 360 * round_even((b.lon - a.lon) / 360, 0), 6) AS unwrapped {_JOIN}")
def f27(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("k", C.crosses_antimeridian(F.array("lon", "lon2")).alias("crosses"), F.round(C.unwrap_lon("lon2", "lon"), 6).alias("unwrapped"))


@query("f28_urban_radius", "SELECT p_partkey, round(sqrt(p_retailprice * 1000 / (pi() * 4000)), 6) AS km FROM part")
def f28(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "part").select("p_partkey", F.round(C.urban_radius_km(F.col("p_retailprice") * 1000, 4000.0), 6).alias("km"))


@query("f29_format_time", "SELECT o_orderkey, CASE WHEN m IS NULL THEN '—' WHEN m < 60 THEN m || ' min' WHEN m % 60 = 0 THEN m // 60 || ' h' ELSE m // 60 || ' h ' || m % 60 || ' min' END AS shown, CASE WHEN m < 60 THEN m || ' min' WHEN m % 60 = 0 THEN m // 60 || ' h' ELSE m // 60 || ' h ' || printf('%02d', m % 60) END AS tick FROM (SELECT o_orderkey, o_orderkey % 1500 AS m FROM orders)")
def f29(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").select("o_orderkey", C.format_time(F.col("o_orderkey") % 1500).alias("shown"), C.format_tick(F.col("o_orderkey") % 1500).alias("tick"))


@query("f30_base64_body", "SELECT n_nationkey, to_base64(n_name::BLOB) AS body FROM nation")
def f30(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "nation").select("n_nationkey", F.base64(F.col("n_name").cast("binary")).alias("body"))


@query("f31_solar_morning", "SELECT o_orderkey, make_timestamp((epoch(day) * 1000000)::BIGINT + 36000000000 - (floor(lon * 240) * 1000000)::BIGINT) AS at FROM (SELECT o_orderkey, (o_orderkey * 104729) % 36000 / 100.0 - 180 AS lon, d + ((8 - isodow(d) + 1) % 7)::INT AS day FROM (SELECT *, (o_orderdate::DATE + 2) AS d FROM orders))")
def f31(spark: SparkSession, d: str) -> DataFrame:
    lon = F.col("o_orderkey") * 104729 % 36000 / 100.0 - 180
    return t(spark, d, "orders").select("o_orderkey", C.weekday_morning_utc("o_orderdate", lon).cast("timestamp_ntz").alias("at"))


# -- cost model

_SIZE = "CASE WHEN {k} % 3 = 0 THEN 'large' WHEN {k} % 3 = 1 THEN 'medium' ELSE 'small' END"


def _size(k) -> F.Column:
    return F.when(F.col(k) % 3 == 0, "large").when(F.col(k) % 3 == 1, "medium").otherwise("small")


_AIR = f"m AS (SELECT a.k, {_SIZE.format(k='a.k')} AS dep, {_SIZE.format(k='a.o')} AS arr, {hav('a', 'b')} AS km {_JOIN})"


def _air(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("k", _size("k").alias("dep"), _size("o").alias("arr"), C.haversine_km("lat", "lon", "lat2", "lon2").alias("km"))


def _map(col: str, **v: float) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN {x}" for k, x in v.items()) + " END"


@query("m1_block_time", f"WITH {_PAIRS}, {_AIR} SELECT k, round_even({_map('dep', large=17.0, medium=12.0, small=8.0)} + 15 + 60 * km / 844 + {_map('arr', large=9.0, medium=6.0, small=4.0)}, 0)::DOUBLE AS minutes FROM m")
def m1(spark: SparkSession, d: str) -> DataFrame:
    return _air(spark, d).select("k", M.block_time_min("km", "dep", "arr").alias("minutes"))


_FREQ = f"greatest(300000.0::DOUBLE * {_map('dep', large=1.0, medium=0.55, small=0.25)} * {_map('arr', large=1.0, medium=0.55, small=0.25)} * pow(greatest(km, 400.0), -1.10), 0.5)"


@query("m2_frequency", f"WITH {_PAIRS}, {_AIR} SELECT k, round({_FREQ}, 6)::DOUBLE AS per_week FROM m")
def m2(spark: SparkSession, d: str) -> DataFrame:
    return _air(spark, d).select("k", F.round(M.flights_per_week("km", "dep", "arr"), 6).alias("per_week"))


@query("m3_expected_wait", f"WITH {_PAIRS}, {_AIR} SELECT k, round_even(10080 / {_FREQ} / 2, 0)::DOUBLE AS wait FROM m")
def m3(spark: SparkSession, d: str) -> DataFrame:
    return _air(spark, d).select("k", M.expected_wait_min(M.flights_per_week("km", "dep", "arr")).alias("wait"))


@query("m4_transfer", f"WITH {_PAIRS}, {_AIR} SELECT dep, greatest(max({_map('dep', large=75.0, medium=50.0, small=35.0)}), median(round_even(10080 / {_FREQ} / 2, 0)))::DOUBLE AS minutes FROM m GROUP BY dep")
def m4(spark: SparkSession, d: str) -> DataFrame:
    w = _air(spark, d).withColumn("wait", M.expected_wait_min(M.flights_per_week("km", "dep", "arr")))
    least = F.max(M.pick("dep", M.AIR.connection))
    return w.groupBy("dep").agg(least.alias("least"), F.median("wait").alias("wait")).select("dep", M.transfer_min("least", "wait").alias("minutes"))


@query("m5_access_egress", f"SELECT k, {_map('size', large=70.0, medium=55.0, small=40.0)}::DOUBLE + 5 AS access, {_map('size', large=30.0, medium=22.0, small=15.0)}::DOUBLE + 5 AS egress FROM (SELECT k, {_SIZE.format(k='k')} AS size FROM ({_P}))")
def m5(spark: SparkSession, d: str) -> DataFrame:
    s = points(spark, d).select("k", _size("k").alias("size"))
    return s.select("k", (M.pick("size", M.AIR.processing) + 5).alias("access"), (M.pick("size", M.AIR.disembark) + 5).alias("egress"))


@query("m6_zones", "SELECT n_nationkey, CASE WHEN n_regionkey IN (2, 3) THEN 'common' ELSE 'z' || n_nationkey END AS zone FROM nation")
def m6(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "nation").select("n_nationkey", F.when(F.col("n_regionkey").isin(2, 3), "common").otherwise(F.concat(F.lit("z"), F.col("n_nationkey").cast("string"))).alias("zone"))


@query("p7_plausible_routes", f"WITH {_PAIRS}, {_AIR} SELECT k, km <= 15400 AND (km <= 8000 OR dep = 'large' OR arr = 'large') AS ok FROM m")
def p7(spark: SparkSession, d: str) -> DataFrame:
    return _air(spark, d).select("k", M.plausible_route("km", "dep", "arr").alias("ok"))


_BY_CLASS, _BY_LIMIT, _BY_INCOME = (4, 95, 70, 50, 35, 25, 100), (80, 100, 115), (0.7, 0.8, 0.9, 1.0, 1.1)


@query("m8_cell_speed", "WITH c AS (SELECT p_partkey AS k, p_size % 7 AS cls, 60 + p_size AS lim, p_partkey % 5 AS inc, (p_partkey % 30) / 10.0 AS dist FROM part), "
       "a AS (SELECT *, CASE WHEN cls = 6 THEN [80, 100, 115][1 + (lim >= 90)::INT + (lim >= 110)::INT] ELSE [4, 95, 70, 50, 35, 25, 100][cls + 1] END::DOUBLE AS v FROM c), "
       "b AS (SELECT *, v * CASE WHEN cls IN (2, 3, 4) THEN [0.7, 0.8, 0.9, 1.0, 1.1][inc + 1] ELSE 1 END AS w FROM a) "
       "SELECT k, round(w / (CASE WHEN cls > 0 AND dist < 1 THEN 1.5 ELSE 1 END) / (CASE WHEN cls > 0 AND dist < 0.5 THEN 1.2 ELSE 1 END), 6)::DOUBLE AS kmh FROM b")  # fmt: skip
def m8(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "part").select(F.col("p_partkey").alias("k"), (F.col("p_size") % 7).alias("cls"), (60 + F.col("p_size")).alias("lim"), (F.col("p_partkey") % 5).alias("inc"), (F.col("p_partkey") % 30 / 10.0).alias("dist"))
    return c.select("k", F.round(M.cell_speed_kmh("cls", "lim", "inc", "dist", _BY_CLASS, _BY_LIMIT, _BY_INCOME, (2, 3, 4), 1.5, 1.2), 6).alias("kmh"))


@query("m10_ground_edges", f"WITH {_PAIRS}, z AS (SELECT a.k, {hav('a', 'b')} AS km, 20 + a.o AS v, CASE WHEN a.k % 4 = 0 THEN '' ELSE 'z' || a.k % 3 END AS za, 'z' || a.o % 3 AS zb {_JOIN}) SELECT k, round(km / v * 60 + CASE WHEN za <> zb AND za <> '' AND zb <> '' THEN 30 ELSE 0 END, 6)::DOUBLE AS minutes FROM z")
def m10(spark: SparkSession, d: str) -> DataFrame:
    z = _pairs(spark, d).select("k", C.haversine_km("lat", "lon", "lat2", "lon2").alias("km"), (20 + F.col("o")).alias("v"), F.when(F.col("k") % 4 == 0, "").otherwise(F.concat(F.lit("z"), (F.col("k") % 3).cast("string"))).alias("za"), F.concat(F.lit("z"), (F.col("o") % 3).cast("string")).alias("zb"))
    return z.select("k", F.round(M.ground_edge_min("km", "v", "za", "zb", 30.0), 6).alias("minutes"))


_RAIL = {"high_speed": (214.7, 5.1), "regional": (86.7, 2.2), "commuter": (73.8, 1.3)}


@query("m14_rail_legs", f"WITH c AS (SELECT l_orderkey, l_linenumber, l_quantity AS km, CASE l_returnflag WHEN 'R' THEN 'high_speed' WHEN 'A' THEN 'regional' ELSE 'commuter' END AS tier, CASE WHEN l_linenumber = 7 THEN l_quantity / 100 END AS h FROM lineitem) SELECT l_orderkey, l_linenumber, round(CASE WHEN h IS NOT NULL THEN 60 * h / 0.9 ELSE {_map('tier', high_speed=5.1, regional=2.2, commuter=1.3)}::DOUBLE + 60 * km * 1.2 / {_map('tier', high_speed=214.7, regional=86.7, commuter=73.8)}::DOUBLE END, 6) AS minutes FROM c")
def m14(spark: SparkSession, d: str) -> DataFrame:
    tier = F.when(F.col("l_returnflag") == "R", "high_speed").when(F.col("l_returnflag") == "A", "regional").otherwise("commuter")
    c = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("km"), tier.alias("tier"), F.when(F.col("l_linenumber") == 7, F.col("l_quantity") / 100).alias("h"))
    return c.select("l_orderkey", "l_linenumber", F.round(M.rail_leg_min("tier", "km", "h", _RAIL, 1.2, 0.9), 6).alias("minutes"))


@query("m17_ferry_crossing", "WITH c AS (SELECT o_orderkey AS k, (o_orderkey % 900 + 1)::DOUBLE AS km, CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 400)::DOUBLE END AS tagged, CASE WHEN o_orderkey % 4 = 0 THEN (o_orderkey % 3000)::DOUBLE END AS every, (o_orderkey % 13) / 12.0::DOUBLE AS share FROM orders), "
       "s AS (SELECT *, CASE WHEN tagged > 0 AND 60 * km / tagged BETWEEN 5 AND 120 THEN tagged ELSE 11.2::DOUBLE + 60 * km / 29.1::DOUBLE END AS sail, greatest(10080 / CASE WHEN every BETWEEN 5 AND 527040 THEN every ELSE 60 * 0.008915::DOUBLE * pow(greatest(km, 8.0), 1.5137) END * share, 0.1) AS n FROM c) SELECT k, round(round_even(10080 / n / 2, 0) + sail + 30 + 10, 6)::DOUBLE AS minutes FROM s")  # fmt: skip
def m17(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    c = t(spark, d, "orders").select(k.alias("k"), (k % 900 + 1).cast("double").alias("km"), F.when(k % 3 == 0, (k % 400).cast("double")).alias("tagged"), F.when(k % 4 == 0, (k % 3000).cast("double")).alias("every"), ((k % 13) / F.lit(12.0)).alias("share"))
    return c.select("k", F.round(M.crossing_min("km", "tagged", "every", "share", F.lit(10.0)), 6).alias("minutes"))


@query("m21_covers", "SELECT l_orderkey AS route, bool_or(n_regionkey = 3) AS covers FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1")
def m21(spark: SparkSession, d: str) -> DataFrame:
    home = t(spark, d, "supplier").join(F.broadcast(t(spark, d, "nation")), F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), (F.col("n_regionkey") == 3).alias("home"))
    return t(spark, d, "lineitem").join(home, "l_suppkey").groupBy(F.col("l_orderkey").alias("route")).agg(F.bool_or("home").alias("covers"))


@query("m23_door_ends", "SELECT o_orderkey AS k, (o_orderkey % 500)::DOUBLE + CASE WHEN o_orderkey = 1 THEN 0 WHEN o_orderkey % 2 = 0 THEN 10 ELSE 5 END AS minutes FROM orders")
def m23(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return t(spark, d, "orders").select(k.alias("k"), M.with_door_ends((k % 500).cast("double"), k == 1, k % 2 == 0, 10.0).alias("minutes"))


@query("m24_carry_on", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN greatest((o_orderkey % 50)::DOUBLE - 15, 0) ELSE (o_orderkey % 50)::DOUBLE END AS minutes FROM orders")
def m24(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return t(spark, d, "orders").select(k.alias("k"), M.carry_on((k % 50).cast("double"), k % 3 == 0, 15.0).alias("minutes"))


# -- refinement

_CELLS = f"cells AS (SELECT {_QC} AS cell, min(k) AS k, count(*) AS n FROM ({_C}) GROUP BY 1)"


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return points(spark, d, "customer", "c_custkey").groupBy(K.quad_cell("lat", "lon", 6).alias("cell")).agg(F.min("k").alias("k"), F.count(F.lit(1)).alias("n"))


@query("r2_refine", f"WITH {_CELLS} SELECT cell, cell AS base, false AS fine FROM cells WHERE n < 2 UNION ALL SELECT (7::BIGINT << 52) | ((((cell >> 26) & 67108863) * 2 + i) << 26) | ((cell & 67108863) * 2 + j), cell, true FROM cells, range(0, 2) a(i), range(0, 2) b(j) WHERE n >= 2")
def r2(spark: SparkSession, d: str) -> DataFrame:
    c = _cells(spark, d)
    whole = c.filter("n < 2").select("cell", F.col("cell").alias("base"), F.lit(False).alias("fine"))
    return whole.unionByName(c.filter("n >= 2").select(F.explode(K.quad_children("cell")).alias("cell"), F.col("cell").alias("base"), F.lit(True).alias("fine")))


@query("r5_linked_cells", f"WITH s AS (SELECT l_orderkey AS way, l_linenumber AS i, {_QC} AS cell FROM {LINE} JOIN ({_P}) ON k = l_suppkey), n AS (SELECT cell AS a, lead(cell) OVER (PARTITION BY way ORDER BY i) AS b FROM s), p AS (SELECT a, b FROM n WHERE b IS NOT NULL AND a <> b) SELECT a, b FROM p UNION SELECT b, a FROM p")
def r5(spark: SparkSession, d: str) -> DataFrame:
    at = points(spark, d).select(F.col("k").alias("l_suppkey"), K.quad_cell("lat", "lon", 6).alias("cell"))
    s = lines(spark, d).join(at, "l_suppkey").select(F.col("l_orderkey").alias("way"), F.col("l_linenumber").alias("i"), "cell")
    return S.linked_cells(s, "way", "i", "cell")


@query("r6_severed_pairs", f"WITH {_CELLS}, x AS (SELECT cell, (cell >> 26) & 67108863 AS y, cell & 67108863 AS x, k % 3 AS land FROM cells), p AS (SELECT a.cell AS a, b.cell AS b, a.land AS la, b.land AS lb FROM x a JOIN x b ON abs(a.y - b.y) <= 1 AND (abs(a.x - b.x) <= 1 OR abs(a.x - b.x) = 127) AND a.cell <> b.cell) SELECT a, b FROM p WHERE la <> lb")
def r6(spark: SparkSession, d: str) -> DataFrame:
    c = _cells(spark, d).withColumn("land", F.array(F.col("k") % 3))
    near = c.select(F.col("cell").alias("a"), F.col("land").alias("la"), F.explode(K.quad_disk("cell", 6, 1)).alias("b")).filter("a <> b")
    return near.join(c.select(F.col("cell").alias("b"), F.col("land").alias("lb")), "b").filter(~F.arrays_overlap("la", "lb")).select("a", "b")


@query("m12_neighbour_fill", f"WITH {_CELLS}, x AS (SELECT cell, (cell >> 26) & 67108863 AS y, cell & 67108863 AS x, CASE WHEN k % 2 = 0 THEN k % 5 END AS v FROM cells), "
       "p AS (SELECT a.cell, b.v, count(*) AS n FROM x a JOIN x b ON abs(a.y - b.y) <= 1 AND (abs(a.x - b.x) <= 1 OR abs(a.x - b.x) = 127) AND a.cell <> b.cell WHERE a.v IS NULL AND b.v IS NOT NULL GROUP BY 1, 2), w AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY cell ORDER BY n DESC, v) = 1) SELECT x.cell, coalesce(x.v, w.v) AS v FROM x LEFT JOIN w USING (cell)")  # fmt: skip
def m12(spark: SparkSession, d: str) -> DataFrame:
    c = _cells(spark, d).select("cell", F.when(F.col("k") % 2 == 0, F.col("k") % 5).alias("v"))
    pairs = c.select("cell", F.explode(K.quad_disk("cell", 6, 1)).alias("other")).filter("cell <> other")
    return S.majority_of_neighbours(c, pairs, "cell", "v")


@query("r3_expand", f"WITH {_CELLS} SELECT (7::BIGINT << 52) | ((((cell >> 26) & 67108863) * 2 + i) << 26) | ((cell & 67108863) * 2 + j) AS cell, k AS value FROM cells, range(0, 2) a(i), range(0, 2) b(j)")
def r3(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d).select(F.explode(K.quad_children("cell")).alias("cell"), F.col("k").alias("value"))


@query("r1_dense_and_straddling", "SELECT l_suppkey AS cell, min(l_linenumber) <= 1 OR count(*) > 600 AS dense, count(DISTINCT l_returnflag) > 1 AS straddles FROM lineitem GROUP BY 1")
def r1(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("cell")).agg(F.min("l_linenumber").alias("best"), F.count(F.lit(1)).alias("n"), F.collect_set("l_returnflag").alias("parts"))
    return c.select("cell", ((F.col("best") <= 1) | (F.col("n") > 600)).alias("dense"), (F.size("parts") > 1).alias("straddles"))


@query("w6_last_marked", "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS purchase FROM events")
def w6(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return t(spark, d, "events").select("event_id", F.last(F.when(F.col("event_type") == "purchase", F.col("event_id")), ignorenulls=True).over(w).alias("purchase"))
