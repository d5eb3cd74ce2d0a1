"""The cost model's rules as Column expressions over named constants."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from reachlab.functions.columns import c

MINUTES_PER_WEEK = 10080


def pick(key, values: dict[str, float]) -> Column:
    """The value of a key in a small fixed map; an unknown key is an error that names it."""
    k = c(key)
    out = None
    for name, v in values.items():
        out = F.when(k == name, F.lit(float(v))) if out is None else out.when(k == name, F.lit(float(v)))
    return out.otherwise(F.raise_error(F.concat(F.lit("no value for "), F.coalesce(k, F.lit("null")))).cast("double"))


@dataclass(frozen=True)
class Air:
    """Fixed calibration values of flights."""

    penalty_min: float = 15.0
    cruise_kmh: float = 844.0
    taxi_out: dict = field(default_factory=lambda: {"large": 17.0, "medium": 12.0, "small": 8.0})
    taxi_in: dict = field(default_factory=lambda: {"large": 9.0, "medium": 6.0, "small": 4.0})
    base: float = 300000.0
    decay: float = -1.10
    knee_km: float = 400.0
    least_per_week: float = 0.5
    weight: dict = field(default_factory=lambda: {"large": 1.0, "medium": 0.55, "small": 0.25})
    processing: dict = field(default_factory=lambda: {"large": 70.0, "medium": 55.0, "small": 40.0})
    disembark: dict = field(default_factory=lambda: {"large": 30.0, "medium": 22.0, "small": 15.0})
    connection: dict = field(default_factory=lambda: {"large": 75.0, "medium": 50.0, "small": 35.0})


AIR = Air()


def block_time_min(km, dep, arr, cal: Air = AIR) -> Column:
    return F.rint(pick(dep, cal.taxi_out) + cal.penalty_min + 60.0 * c(km) / cal.cruise_kmh + pick(arr, cal.taxi_in))


def flights_per_week(km, dep, arr, cal: Air = AIR) -> Column:
    return F.greatest(cal.base * pick(dep, cal.weight) * pick(arr, cal.weight) * F.pow(F.greatest(c(km), F.lit(cal.knee_km)), cal.decay), F.lit(cal.least_per_week))


def expected_wait_min(per_week) -> Column:
    """Half the headway, rounded half to even; no service at all is a prohibitive wait."""
    w = c(per_week)
    return F.when(w > 0, F.rint(MINUTES_PER_WEEK / w / 2)).otherwise(1e7)


def plausible_route(km, dep, arr) -> Column:
    """At most 15,400 km, and beyond 8,000 km only where an end is large."""
    return (c(km) <= 15400) & ((c(km) <= 8000) | (c(dep) == "large") | (c(arr) == "large"))


def transfer_min(least, wait) -> Column:
    """The longer of connection time and wait, not their sum."""
    return F.greatest(c(least), F.coalesce(c(wait), c(least)))


@dataclass(frozen=True)
class Ferry:
    """Fixed calibration values of ferries."""

    speed_kmh: float = 29.1
    berth_min: float = 11.2
    terminal_min: float = 30.0
    interval_base_h: float = 0.008915
    interval_decay: float = 1.5137
    knee_km: float = 8.0
    trusted_kmh: tuple = (5.0, 120.0)
    interval_min: tuple = (5.0, 527040.0)
    least_per_week: float = 0.1


FERRY = Ferry()


def sailing_min(km, tagged, cal: Ferry = FERRY) -> Column:
    """A tagged duration if the speed it means is possible, else a fixed time plus distance at service speed."""
    kmh = F.try_divide(60.0 * c(km), c(tagged))
    return F.when((c(tagged) > 0) & kmh.between(*cal.trusted_kmh), c(tagged)).otherwise(cal.berth_min + 60.0 * c(km) / cal.speed_kmh)


def sailings_per_week(km, interval, share, cal: Ferry = FERRY) -> Column:
    prior = 60.0 * cal.interval_base_h * F.pow(F.greatest(c(km), F.lit(cal.knee_km)), cal.interval_decay)
    usable = F.when(c(interval).between(*cal.interval_min), c(interval)).otherwise(prior)
    return F.greatest(MINUTES_PER_WEEK / usable * F.greatest(c(share), F.lit(0.0)), F.lit(cal.least_per_week))


def crossing_min(km, tagged, interval, share, border, cal: Ferry = FERRY) -> Column:
    return expected_wait_min(sailings_per_week(km, interval, share, cal)) + sailing_min(km, tagged, cal) + cal.terminal_min + c(border)


def rail_leg_min(tier, km, line_h, tiers: dict[str, tuple[float, float]], detour: float, link_factor: float) -> Column:
    """A link's hours at line speed; else the tier's stop overhead and detoured distance at its speed. Unknown tiers are errors."""
    speed, stop = pick(tier, {k: v[0] for k, v in tiers.items()}), pick(tier, {k: v[1] for k, v in tiers.items()})
    return F.when(c(line_h).isNotNull(), 60.0 * c(line_h) / link_factor).otherwise(stop + 60.0 * c(km) * detour / speed)


def cell_speed_kmh(cls, limit, income, distance, by_class, by_limit, by_income, scaled, factor: float, core: float, limits=(90, 110)) -> Column:
    """Class speed; motorways by signed limit; scaled classes by income; roads slower in built-up areas, and again in cores."""
    v = F.element_at(F.array(*map(F.lit, map(float, by_class))), c(cls).cast("int") + 1)
    band = sum(((c(limit) >= e).cast("int") for e in limits), F.lit(0))
    v = F.when(c(cls) == len(by_class) - 1, F.element_at(F.array(*map(F.lit, map(float, by_limit))), F.coalesce(band, F.lit(0)) + 1)).otherwise(v)
    v = F.when(c(cls).isin(*scaled), v * F.element_at(F.array(*map(F.lit, map(float, by_income))), c(income).cast("int") + 1)).otherwise(v)
    v = F.when((c(cls) > 0) & (c(distance) < 1.0), v / factor).otherwise(v)
    return F.when((c(cls) > 0) & (c(distance) < 0.5), v / core).otherwise(v)


def ground_edge_min(km, speed_at_end, zone_a, zone_b, border: float) -> Column:
    """A hop is priced at the speed of its end, so the two ways differ; a border costs only between two known zones."""
    crosses = (c(zone_a) != c(zone_b)) & (F.coalesce(c(zone_a), F.lit("")) != "") & (F.coalesce(c(zone_b), F.lit("")) != "")
    return c(km) / c(speed_at_end) * 60.0 + F.when(crosses, F.lit(border)).otherwise(0.0)


def with_door_ends(minutes, is_source: Column, is_cell: Column, end_min: float) -> Column:
    """Half at the departure for all but the source, and half at the destination for cells."""
    return F.when(is_source, c(minutes)).otherwise(c(minutes) + end_min / 2 + F.when(is_cell, end_min / 2).otherwise(0.0))


def carry_on(minutes, flew: Column, saving: float) -> Column:
    return F.when(flew, F.greatest(c(minutes) - saving, F.lit(0.0))).otherwise(c(minutes))
