"""Edge builders: the business rules that turn tables of links into edges (src, dst, w, mode)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachlab.functions import cost


def with_ends(links: DataFrame, places: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Attributes of both ends, under the prefixes a_ and b_: the shared border rules read them. links: src, dst."""
    side = lambda p, end: places.select(F.col(key).alias(end), *[F.col(c).alias(f"{p}_{c}") for c in cols])
    return links.join(side("a", "src"), "src").join(side("b", "dst"), "dst")


def crosses(a: str = "a_zone", b: str = "b_zone") -> Column:
    """Two known zones that differ."""
    return (F.coalesce(F.col(a), F.lit("")) != "") & (F.coalesce(F.col(b), F.lit("")) != "") & (F.col(a) != F.col(b))


def without_pairs(edges: DataFrame, closed: DataFrame, a: str, b: str) -> DataFrame:
    """Edges whose unordered (a, b) is not in closed (p, q)."""
    c = closed.select(F.least("p", "q").alias("__p"), F.greatest("p", "q").alias("__q")).distinct()
    return edges.join(c, (F.least(a, b) == F.col("__p")) & (F.greatest(a, b) == F.col("__q")), "left_anti")


def route_edges(routes: DataFrame, airports: DataFrame, border_min: float) -> DataFrame:
    """Flights on two layers of airport nodes, so that a journey pays a border once between landings.

    Domestic flights run on each layer; a flight that crosses zones pays on the way from the domestic departure to the
    international arrival, and nothing more between international nodes. routes: src, dst, w.
    """
    r = with_ends(routes, airports, "airport", ["zone"]).withColumn("x", crosses())
    node = lambda layer, side, col: F.concat(F.lit(f"{layer}:{side}:"), F.col(col).cast("string"))
    row = lambda df, l1, l2, w: df.select(node(l1, "dep", "src").alias("src"), node(l2, "arr", "dst").alias("dst"), w.cast("double").alias("w"), F.lit("air").alias("mode"))
    home = r.filter(~F.col("x"))
    abroad = r.filter("x")
    return row(home, "dom", "dom", F.col("w")).unionByName(row(home, "intl", "intl", F.col("w"))).unionByName(row(abroad, "dom", "intl", F.col("w") + border_min)).unionByName(row(abroad, "intl", "intl", F.col("w")))


def access_edges(airports: DataFrame, end_min: float = 0.0) -> DataFrame:
    """Cell to departure, arrivals of both layers to cell. airports: airport, cell, size."""
    k = F.col("airport").cast("string")
    cell = F.concat(F.lit("cell:"), F.col("cell").cast("string"))
    go = cost.pick("size", cost.AIR.processing) + end_min / 2
    leave = cost.pick("size", cost.AIR.disembark) + end_min / 2
    edge = lambda a, b, w: airports.select(a.alias("src"), b.alias("dst"), w.alias("w"), F.lit("access").alias("mode"))
    return edge(cell, F.concat(F.lit("dom:dep:"), k), go).unionByName(edge(F.concat(F.lit("dom:arr:"), k), cell, leave)).unionByName(edge(F.concat(F.lit("intl:arr:"), k), cell, leave))


def rail_edges(rides: DataFrame, stations: DataFrame, boarding: float, alighting: float) -> DataFrame:
    """Rides, boarding and alighting. rides: a, b, minutes; stations: station, cell."""
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edge = lambda df, a, b, w: df.select(a.alias("src"), b.alias("dst"), w.cast("double").alias("w"), F.lit("rail").alias("mode"))
    out = edge(rides, name("st:", "a"), name("st:", "b"), F.col("minutes"))
    return out.unionByName(edge(stations, name("cell:", "cell"), name("st:", "station"), F.lit(boarding))).unionByName(edge(stations, name("st:", "station"), name("cell:", "cell"), F.lit(alighting)))


def ride_edges(hops: DataFrame) -> DataFrame:
    """Fastest hop of each pair (a, b, minutes, timed); a pair with a timetable drops its estimates."""
    timed = hops.filter("timed").select("a", "b").distinct().withColumn("__t", F.lit(True))
    return hops.join(timed, ["a", "b"], "left").filter("timed OR __t IS NULL").groupBy("a", "b").agg(F.min("minutes").alias("minutes"), F.bool_or("timed").alias("timed"))


def ferry_rows(links: DataFrame, least_km: float = 1.0, most_km: float = 4000.0) -> DataFrame:
    """Links with the reason that refuses them, or null: length (unless over water that parts land), off the mask, one cell, a closed pair."""
    from reachlab.operators.relational import reasons

    return reasons(links, [
        ("length", ~F.col("km").between(least_km, most_km) & ~F.col("severed")), ("off mask", F.col("cell_a").isNull() | F.col("cell_b").isNull()),
        ("one cell", F.col("cell_a") == F.col("cell_b")), ("closed", F.col("closed")),
    ])


def ferry_edges(rows: DataFrame) -> DataFrame:
    """Both ways of the cheapest accepted link of each pair of cells."""
    from reachlab.operators.relational import symmetrise

    return symmetrise(rows.filter("reason IS NULL").select(F.col("cell_a").alias("src"), F.col("cell_b").alias("dst"), F.col("minutes").alias("w")), "src", "dst", "w")


def overflies(listings: DataFrame, home: list[str]) -> DataFrame:
    """Pairs that an airline serves that also flies to one of the home countries. listings: airline, src, dst, country."""
    flyers = listings.filter(F.col("country").isin(*home)).select("airline").distinct()
    return listings.join(flyers.withColumn("__o", F.lit(True)), "airline", "left").groupBy("src", "dst").agg(F.coalesce(F.bool_or("__o"), F.lit(False)).alias("overfly"))


def timetabled_pairs(calls: DataFrame) -> DataFrame:
    """Fastest minutes of each ordered pair of stops of a trip. calls: trip, seq, stop, minute."""
    from reachlab.operators.relational import pairs_in_order

    p = pairs_in_order(calls.withColumn("s", F.struct("stop", "minute")), "trip", "seq", "s")
    return p.select(F.col("from_stop.stop").alias("a"), F.col("to_stop.stop").alias("b"), (F.col("to_stop.minute") - F.col("from_stop.minute")).alias("m")).filter("m > 0 AND a <> b").groupBy("a", "b").agg(F.min("m").alias("minutes"), F.count(F.lit(1)).alias("trips"))


def cell_class(cells: DataFrame) -> Column:
    """Best class of the footprint; towns have at least a minor road; trunk roads lift poor classes; motorways come first."""
    best = F.coalesce(F.col("best"), F.lit(0))
    v = F.when(F.col("town") & (best == 0), 4).otherwise(best)
    v = F.when(F.col("trunk") & v.isin(0, 4, 5), 2).otherwise(v)
    return F.when(F.col("motorway"), 6).otherwise(v)
