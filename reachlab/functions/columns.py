"""Scalar functions as Column expressions: distances, bands, encodings, and parsers of tagged text."""

from __future__ import annotations

import sys
import unicodedata
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

# Radii, band edges, the sentinel, names and tiers that results must agree on.
R_MEAN, R_ROUND = 6371.0088, 6371.0
BAND_EDGES = (30, 35, 40, 45, 55, 60, 70, 80, 95, 110, 125, 145, 170, 195, 225, 260, 300, 350, 400, 465, 535, 620, 715, 825, 955, 1100, 1270, 1470, 1695, 1960, 2260, 2615, 3020, 3485, 4025, 4320)
UNREACHABLE = 65535
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH_NAMES = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
SEASONS = ("spring", "summer", "autumn", "fall", "winter", "dry_season", "wet_season")
TIERS = ("tourism", "default", "commuter", "regional", "long_distance", "high_speed")
TIER_NAMES = {
    "high_speed": ("high_speed", "highspeed"),
    "long_distance": ("long_distance", "national", "international"),
    "regional": ("regional",),
    "commuter": ("commuter", "suburban", "local", "urban", "stopping", "ordinary", "light_rail"),
    "tourism": ("tourism", "tourist", "touristic"),
}


def c(x: Column | str | float) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def haversine_km(lat1, lon1, lat2, lon2, radius: float = R_MEAN) -> Column:
    a, b = F.radians(c(lat1)), F.radians(c(lat2))
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(c(lon2) - c(lon1)) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def flat_km(lat1, lon1, lat2, lon2, km_per_degree: float = 111.0, wrap: bool = False) -> Column:
    """Equirectangular distance; wrap takes the shorter way around the globe."""
    dlon = c(lon2) - c(lon1)
    if wrap:
        dlon = (dlon + 540.0) % 360.0 - 180.0
    y, x = (c(lat2) - c(lat1)) * km_per_degree, dlon * km_per_degree * F.cos(F.radians(c(lat1)))
    return F.sqrt(x * x + y * y)


def unit_xyz(lat, lon) -> Column:
    a, o = F.radians(c(lat)), F.radians(c(lon))
    return F.struct((F.cos(a) * F.cos(o)).alias("x"), (F.cos(a) * F.sin(o)).alias("y"), F.sin(a).alias("z"))


def chord_of_km(km, radius: float = R_MEAN) -> Column:
    return 2 * F.sin(c(km) / (2 * radius))


def great_circle(lat1, lon1, lat2, lon2, steps: Column) -> Column:
    """Points at even shares of the arc, both ends included: array of (lat, lon)."""
    p, q = unit_xyz(lat1, lon1), unit_xyz(lat2, lon2)
    d = haversine_km(lat1, lon1, lat2, lon2, 1.0)

    def at(i: Column) -> Column:
        t = i / steps
        a = F.when(d < 1e-12, 1 - t).otherwise(F.sin((1 - t) * d) / F.sin(d))
        b = F.when(d < 1e-12, t).otherwise(F.sin(t * d) / F.sin(d))
        x, y, z = (a * p[k] + b * q[k] for k in "xyz")
        return F.struct(F.degrees(F.atan2(z, F.sqrt(x * x + y * y))).alias("lat"), F.degrees(F.atan2(y, x)).alias("lon"))

    return F.transform(F.sequence(F.lit(0), steps), at)


def densify(points: Column, step_km: float) -> Column:
    """A polyline (array of lat, lon structs) with no stretch above step_km; stretches across the antimeridian are left out."""
    n = F.size(points)

    def stretch(i: Column) -> Column:
        a, b = F.get(points, i), F.get(points, i + 1)
        k = F.greatest(F.ceil(haversine_km(a["lat"], a["lon"], b["lat"], b["lon"]) / step_km).cast("int"), F.lit(1))
        at = F.transform(F.sequence(F.lit(0), k - 1), lambda j: F.struct((a["lat"] + (b["lat"] - a["lat"]) * j / k).alias("lat"), (a["lon"] + (b["lon"] - a["lon"]) * j / k).alias("lon")))
        return F.when(F.abs(b["lon"] - a["lon"]) > 180, F.array(F.struct(a["lat"].alias("lat"), a["lon"].alias("lon")))).otherwise(at)

    inner = F.flatten(F.transform(F.sequence(F.lit(0), n - 2), stretch))
    return F.when(n < 2, points).otherwise(F.concat(inner, F.array(F.element_at(points, -1))))


def crosses_antimeridian(lons: Column) -> Column:
    return F.array_max(lons) - F.array_min(lons) > 180


def unwrap_lon(lon, near) -> Column:
    """lon moved by whole turns to within 180 degrees of near."""
    return c(lon) - 360 * F.rint((c(lon) - c(near)) / 360)


def urban_radius_km(population, per_km2: float) -> Column:
    return F.sqrt(c(population) / (F.pi() * per_km2))


def _past(x: Column, edges, inclusive: bool) -> Column:
    return reduce(Column.__add__, [((x >= e) if inclusive else (x > e)).cast("int") for e in edges])


def band_of(minutes, edges=BAND_EDGES) -> Column:
    """Band number; a value at an edge stays in the band below. Unreachable (null) is -1."""
    return F.coalesce(_past(c(minutes), edges, False), F.lit(-1))


def band_exclusive(minutes, edges=BAND_EDGES) -> Column:
    """As shown by pages: a value at an edge is in the band above."""
    return F.coalesce(_past(c(minutes), edges, True), F.lit(-1))


bucket_right = band_exclusive


def encode_u16(minutes) -> Column:
    """Whole minutes, cut off; what does not fit, or is unreachable, is the sentinel."""
    m = c(minutes)
    return F.when(m.isNotNull() & (m >= 0) & (m < UNREACHABLE - 1), F.floor(m).cast("int")).otherwise(F.lit(UNREACHABLE))


def u16_hex(value: Column) -> Column:
    """Little-endian hex of an unsigned 16-bit number."""
    h = F.lpad(F.lower(F.hex(value)), 4, "0")
    return F.concat(F.substring(h, 3, 2), F.substring(h, 1, 2))


def half_even(x) -> Column:
    return F.rint(c(x))


def _digits(text: Column, most: int) -> Column:
    """Whether a text is one to `most` ASCII digits."""
    return (F.length(text).between(1, most)) & (F.translate(text, "0123456789", "") == "")


def _number(text: Column) -> Column:
    """The value of digits with digits behind a point, if there is one; else null."""
    whole, point = F.split(text, r"\."), F.length(text) - F.length(F.replace(text, F.lit("."), F.lit("")))
    return F.when((point <= 1) & F.forall(whole, lambda x: _digits(x, 30)), text.cast("double"))


def _take(rest: Column, unit: str) -> tuple[Column, Column, Column]:
    """What stands before the first `unit` as a number (0 without it), what comes after it, and whether that is well formed."""
    there, before = F.instr(rest, unit) > 0, F.substring_index(rest, unit, 1)
    number = _number(before)
    return F.when(there, F.coalesce(number, F.lit(0.0))).otherwise(0.0), F.when(there, F.substr(rest, F.length(before) + 2)).otherwise(rest), ~there | number.isNotNull()


def parse_minutes(raw) -> Column:
    """H:MM[:SS], bare minutes, or an ISO 8601 duration, as minutes; anything else is null."""
    t = F.trim(c(raw))
    clock = F.split(t, ":")
    small = F.forall(F.slice(clock, 2, 2), lambda x: (F.length(x) == 2) & _digits(x, 2) & (x.try_cast("int") < 60))
    told = clock[0].try_cast("double") * 60 + F.get(clock, F.lit(1)).try_cast("double") + F.coalesce(F.get(clock, F.lit(2)).try_cast("double"), F.lit(0.0)) / 60
    halves = F.split(F.substr(t, F.lit(2)), "T")
    days, rest, ok = _take(halves[0], "D")
    ok = ok & (rest == "") & (F.size(halves) <= 2)
    said, rest = days * 1440, F.coalesce(F.get(halves, F.lit(1)), F.lit(""))
    for unit, minutes in (("H", 60.0), ("M", 1.0), ("S", 1 / 60)):
        value, rest, fine = _take(rest, unit)
        said, ok = said + value * minutes, ok & fine
    return (
        F.when(F.size(clock).between(2, 3) & _digits(clock[0], 3) & small, told)
        .when(_digits(t, 5), t.try_cast("double"))
        .when(t.startswith("P") & ok & (rest == "") & (said > 0), said)
    )


def _month_number(word: Column) -> Column:
    """1 to 12 of a month's name or its first letters, at least three; else 0."""
    return F.when(F.length(word) >= 3, F.array_position(F.transform(F.array(*map(F.lit, MONTH_NAMES)), lambda m: m.startswith(word)), True)).otherwise(0).cast("int")


def _months_named(value: Column) -> Column:
    """Months from one to another, both counted, of the first two month words that a dash joins, by their first three letters."""
    sides = F.split(value, "[-\u2013]")
    number = lambda w: F.array_position(F.array(*map(F.lit, MONTHS)), F.left(w, F.lit(3)))
    last = F.transform(sides, lambda x: number(F.element_at(F.split(F.rtrim(x), "[^a-z]"), -1)))
    first = F.transform(sides, lambda x: number(F.element_at(F.split(F.ltrim(x), "[^a-z]"), 1)))
    spans = F.zip_with(last, F.slice(first, 2, 1000), lambda a, b: F.when((a > 0) & (b > 0), F.pmod(b - a, F.lit(12)) + 1))
    return F.element_at(F.concat(F.array_compact(spans), F.array(F.lit(None).cast("bigint"))), 1)


def service_fraction(seasonal, hours) -> Column:
    """Share of the year that a service runs, of its seasonal and opening-hours tags: the most telling of them decides."""
    tag, open_ = F.lower(F.trim(F.coalesce(c(seasonal), F.lit("")))), F.lower(F.trim(F.coalesce(c(hours), F.lit(""))))
    seasons = F.size(F.array_intersect(F.transform(F.split(tag, "[;,]"), F.trim), F.array(*map(F.lit, SEASONS))))
    listed = F.size(F.filter(F.split(tag, "[;,]"), lambda x: F.trim(x).isin(*SEASONS)))
    months = F.coalesce(F.when(open_ == "24/7", 12), _months_named(tag), _months_named(open_), F.when(seasons > 0, F.least(F.lit(12), 3 * listed)), F.when(tag.isin("yes", "1", "true"), 5), F.lit(12))
    return months / 12.0


def parse_maxspeed(raw) -> Column:
    """km/h of the first of several values, miles converted; null if it does not start with a number."""
    first = F.lower(F.ltrim(F.element_at(F.split(F.coalesce(c(raw), F.lit("")), ";"), 1)))
    lead = F.element_at(F.split(first, r"[^0-9.]"), 1)
    whole = F.concat_ws(".", F.slice(F.filter(F.split(lead, r"\."), lambda x: x != ""), 1, 2))
    v = F.when(F.ascii(first).between(48, 57), whole.try_cast("double"))
    return F.when(F.ltrim(F.substr(first, F.length(lead) + 1)).startswith("mph"), v * 1.609344).otherwise(v)


def rail_maxspeed(raw) -> Column:
    """km/h of a value that is a number and its unit only, from 5 to 600."""
    text = F.lower(F.trim(c(raw)))
    bare = F.rtrim(F.replace(F.replace(F.replace(text, F.lit("km/h"), F.lit("")), F.lit("kmh"), F.lit("")), F.lit("mph"), F.lit("")))
    v = F.when(_number(bare).isNotNull() & text.startswith(bare), parse_maxspeed(raw))
    return F.when(v.between(5, 600), v)


def clock_minutes(raw) -> Column:
    """Minutes of H:M:S; hours may pass 24."""
    p = F.split(c(raw), ":")
    return F.element_at(p, 1).cast("double") * 60 + F.element_at(p, 2).cast("double") + F.coalesce(F.get(p, F.lit(2)).cast("double"), F.lit(0.0)) / 60


def change_kind(word) -> Column:
    """begins, ends, resumes or suspended, of the first word that says so; "temporarily" before it changes nothing."""
    w = F.regexp_replace(F.lower(F.trim(c(word))), "^temporarily ", "")
    first = F.element_at(F.split(w, "[^a-z]"), 1)
    kinds = {"begins": ("begin", "start", "commence"), "ends": ("end",), "resumes": ("resume",), "suspended": ("suspend", "terminat", "cancel", "discontinu")}
    stems = F.array(*[F.struct(F.lit(stem).alias("stem"), F.lit(kind).alias("kind")) for kind, stems in kinds.items() for stem in stems])
    kind = F.get(F.filter(stems, lambda x: first.startswith(x["stem"])), F.lit(0))["kind"]
    return F.when((kind == "suspended") & (F.get(F.split(w, r"\s+"), F.lit(1)) == "until"), "resumes").otherwise(kind)


def change_date(text, ends: Column) -> Column:
    """The first date of a text: `3 May 2026`, `May 3, 2026`, or the cautious end of `May 2026` or `2026`.

    That is the last day for a start and the first for an end. The words before the first year are looked at one by one. A word in
    a month's place that is no month, and a day that the month lacks, give null.
    """
    words = F.filter(F.split(F.lower(c(text)), r"[\s.,()]+"), lambda x: x != "")
    at = F.array_position(F.transform(words, lambda x: (F.length(x) == 4) & _digits(x, 4)), True).cast("int")
    before = lambda n: F.coalesce(F.get(words, at - 1 - n), F.lit(""))
    near, far = before(1), before(2)
    day_last = _digits(near, 2) & (_month_number(far) > 0)  # May 3, 2026
    word = F.when(day_last, far).when(F.length(near).between(3, 9) & (F.translate(near, "abcdefghijklmnopqrstuvwxyz", "") == ""), near)
    month = F.nullif(_month_number(word), F.lit(0))
    day = F.when(day_last, near.try_cast("int")).when(_digits(far, 2), far.try_cast("int"))
    year = F.when(at > 0, F.get(words, at - 1).try_cast("int"))
    first = F.make_date(year, F.coalesce(month, F.lit(1)), F.lit(1))
    last = F.when(month.isNull(), F.make_date(year, F.lit(12), F.lit(31))).otherwise(F.last_day(first))
    whole = F.when(ends, first).otherwise(last)
    exact = F.when(day.between(1, F.dayofmonth(F.last_day(first))), F.date_add(first, day - 1))
    return F.when(year.isNotNull() & (word.isNull() | month.isNotNull()), F.when(day.isNotNull() & month.isNotNull(), exact).otherwise(whole))


def service_of(label) -> Column:
    """Kind of service that a label names: the kinds it holds, or scheduled if it says just that, or other."""
    words = F.filter(F.split(F.lower(c(label)), "[^a-z]+"), lambda x: x != "")
    said = F.array(F.when(F.exists(words, lambda x: x.startswith("seasonal")), "seasonal"), F.when(F.exists(words, lambda x: x.rlike("^ch[ae]rter")), "charter"))
    plain = F.array_join(words, " ").isin("year round", "scheduled")
    return F.coalesce(F.nullif(F.array_join(said, " "), F.lit("")), F.when(plain, "scheduled"), F.lit("other"))


def article_title(url) -> Column:
    """Title of an article's address: unquoted, without fragment, spaces as underscores."""
    last = F.element_at(F.split(F.regexp_replace(c(url), "[#?].*$", ""), "/"), -1)
    return F.replace(F.try_url_decode(last), F.lit(" "), F.lit("_"))


def service_tier(value, high_speed: Column) -> Column:
    """Slowest of the tiers a value names; a high-speed flag comes first, nothing known is the default tier."""
    names = F.create_map(*[F.lit(x) for tier, own in TIER_NAMES.items() for name in own for x in (name, tier)])
    tiers = F.transform(F.split(F.coalesce(F.lower(F.trim(c(value))), F.lit("")), r"\s*;\s*"), lambda x: F.try_element_at(names, x))
    low = F.array_min(F.filter(F.transform(tiers, lambda x: F.array_position(F.array(*map(F.lit, TIERS)), x)), lambda x: x > 0)).cast("int")
    return F.when(high_speed, "high_speed").when(low.isNull(), "default").otherwise(F.element_at(F.array(*map(F.lit, TIERS)), low))


def _unmarked(texts: pd.Series) -> pd.Series:
    """Letters without their marks: compatible decomposition would change more, so canonical."""
    return texts.map(lambda t: None if t is None else "".join(x for x in unicodedata.normalize("NFD", t) if not unicodedata.combining(x)))


def fold(text) -> Column:
    """Lower case without marks of any script, and with white space and punctuation as single spaces: what search compares.

    Plain ASCII needs no Python; other texts are decomposed in Arrow batches.
    """
    low = F.lower(c(text))
    plain = F.when(F.octet_length(low) == F.length(low), low).otherwise(F.pandas_udf(_unmarked, "string")(F.when(F.octet_length(low) > F.length(low), low)))
    return F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "))


def slugify(text) -> Column:
    return F.replace(fold(text), F.lit(" "), F.lit("-"))


def route_id(*key) -> Column:
    """A stable negative id of 48 bits of a SHA-1."""
    return -(F.conv(F.substring(F.sha1(F.concat_ws("|", *map(c, key)).cast("binary")), 1, 12), 16, 10).cast("long") + 1)


def format_time(minutes) -> Column:
    """`45 min`, `2 h`, `2 h 5 min`, rounded half up; a dash for null, and the infinity sign for what cannot be reached."""
    m = F.floor(c(minutes) + 0.5).cast("long")
    h, r = F.floor(m / 60).cast("long"), m % 60
    shown = F.when(m < 60, F.format_string("%d min", m)).when(r == 0, F.format_string("%d h", h)).otherwise(F.format_string("%d h %d min", h, r))
    return F.when(c(minutes).isNull(), "\u2014").when(c(minutes) >= UNREACHABLE - 1, "\u221e no scheduled route").otherwise(shown)


def format_tick(minutes) -> Column:
    """As on a legend: `45 min`, `3 h 05`, `16 h`."""
    m = F.floor(c(minutes) + 0.5).cast("long")
    h, r = F.floor(m / 60).cast("long"), m % 60
    return F.when(m < 60, F.format_string("%d min", m)).when(r == 0, F.format_string("%d h", h)).otherwise(F.format_string("%d h %02d", h, r))


def weekday_morning_utc(today, lon, hour: int = 10) -> Column:
    """UTC time of `hour` o'clock solar time (15 degrees an hour) on the next Tuesday at least two days off."""
    day = F.date_add(c(today).cast("date"), 2)
    day = F.date_add(day, F.pmod(1 - F.weekday(day), F.lit(7)))
    return F.timestamp_seconds(F.unix_date(day) * 86400 + hour * 3600 - F.floor(c(lon) * 240))
