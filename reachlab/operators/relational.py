"""Relational helpers: deterministic dedup, islands, ranked search, reason-coded filters, symmetric pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def required_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Schema drift is an error that names what is missing."""
    if missing := sorted(set(names) - set(df.columns)):
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group by an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def pick_group(df: DataFrame, key: str, group: str) -> DataFrame:
    """Of the groups (extracts) that hold a key, the rows of the one with the most rows, then the smaller name."""
    sizes = df.groupBy(key, group).agg(F.count(F.lit(1)).alias("__n"))
    best = sizes.groupBy(key).agg(F.min(F.struct((-F.col("__n")).alias("n"), F.col(group).alias("g"))).alias("__b")).select(key, F.col("__b.g").alias(group))
    return df.join(best, [key, group], "left_semi")


def recode(col: Column, values: dict[str, str]) -> Column:
    """Strict dictionary recode: an unknown value is an error, null stays null."""
    known = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return F.when(col.isNull(), None).otherwise(F.coalesce(known[col], F.raise_error(F.concat(F.lit("unknown value "), col)).cast("string")))


def first_rule(rules: list[tuple[Column, str | None]]) -> Column:
    """Value of the first rule that holds; a rule with value None refuses."""
    out = F.when(rules[0][0], F.lit(rules[0][1]))
    for cond, value in rules[1:]:
        out = out.when(cond, F.lit(value))
    return out


def next_in(df: DataFrame, group: str, order: str, col: str, alias: str) -> DataFrame:
    return df.withColumn(alias, F.lead(col).over(Window.partitionBy(group).orderBy(order)))


def islands(df: DataFrame, group: str, order: list[str], new: Column, alias: str = "island") -> DataFrame:
    """Numbers runs: `new` says at which row another run begins; the first row of a group always does."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("__new", F.coalesce(new, F.lit(True)).cast("int")).withColumn(alias, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def sessions(df: DataFrame, group: str, ts: str, gap_seconds: int, order: list[str] | None = None) -> DataFrame:
    """Runs of rows less than or exactly gap_seconds apart."""
    order = order or [ts]
    seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
    w = Window.partitionBy(group).orderBy(*order)
    return islands(df, group, order, seconds - F.lag(seconds).over(w) > gap_seconds, "session")


def rollover(df: DataFrame, group: str, order: str, clock: str, alias: str, day: int = 1440) -> DataFrame:
    """A clock that goes back has passed midnight: whole days are added from there on."""
    w = Window.partitionBy(group).orderBy(order)
    back = F.coalesce((F.col(clock) < F.lag(clock).over(w)).cast("int"), F.lit(0))
    return df.withColumn("__back", back).withColumn(alias, F.col(clock) + day * F.sum("__back").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__back")


def search_rank(name: Column, query: str) -> Column:
    """0 exact, 1 prefix, 2 start of a later word, 3 inside; null if absent. Both are to be folded before."""
    n, q = name, F.lit(query)
    return F.when(n == q, 0).when(n.startswith(q), 1).when(F.concat(F.lit(" "), n).contains(F.concat(F.lit(" "), q)), 2).when(n.contains(q), 3)


def reasons(df: DataFrame, checks: list[tuple[str, Column]], alias: str = "reason") -> DataFrame:
    """The first check that a row fails, or null: nothing is dropped without a reason to count."""
    out = None
    for name, bad in checks:
        bad = F.coalesce(bad, F.lit(False))
        out = F.when(bad, name) if out is None else out.when(bad, name)
    return df.withColumn(alias, out)


def symmetrise(df: DataFrame, a: str, b: str, value: str) -> DataFrame:
    """Least value of each unordered pair, both ways."""
    low = df.groupBy(F.least(a, b).alias("__a"), F.greatest(a, b).alias("__b")).agg(F.min(value).alias(value))
    return low.select(F.col("__a").alias(a), F.col("__b").alias(b), value).unionByName(low.select(F.col("__b").alias(a), F.col("__a").alias(b), value))


def effective(df: DataFrame, change: str, on: str, day: str) -> DataFrame:
    """Rows in force on a day: begun or resumed by then, or ending after it; undated changes and suspensions are not; unchanged rows are."""
    d = F.to_date(F.lit(day))
    ok = F.when(F.col(change).isNull(), True).when(F.col(change).isin("begins", "resumes"), F.col(on) <= d).when(F.col(change) == "ends", F.col(on) > d)
    return df.filter(F.coalesce(ok, F.lit(False)))


def pairs_in_order(df: DataFrame, group: str, seq: str, stop: str) -> DataFrame:
    """All ordered pairs of stops of each (short) sequence: one row per start, its later stops from the gathered rest."""
    rest = F.collect_list(F.struct(seq, stop)).over(Window.partitionBy(group).orderBy(seq).rowsBetween(1, Window.unboundedFollowing))
    return df.withColumn("__rest", rest).select(group, F.col(seq).alias("i"), F.col(stop).alias("from_stop"), F.explode("__rest").alias("__r")).select(group, "i", "from_stop", F.col(f"__r.{seq}").alias("j"), F.col(f"__r.{stop}").alias("to_stop"))


def harmonic_mean(km: Column, speed: Column) -> Column:
    """Length-weighted: distance over time, of the stretches whose speed is known."""
    known = F.when(speed > 0, km)
    return F.sum(known) / F.sum(known / speed)


def thin(df: DataFrame, size: str, lat: str, lon: str, near_km: float, key: str) -> DataFrame:
    """Greedy thinning: largest first, what is within near_km of a kept one goes.

    Each round keeps the rows that no larger undecided neighbour precedes, and drops their neighbours; neighbours come
    from a bucket join, so a round is a few joins over the pairs that are near. The result is the sequential one.
    """
    from reachlab.operators.spatial import within_km
    from reachlab.plans.materialize import cut

    own = df.select(F.col(key).alias("k"), F.col(size).alias("s"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))
    near = within_km(own, own.select(F.col("k").alias("k2"), F.col("s").alias("s2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2")), near_km).filter("k <> k2")
    before = cut(near.filter("s2 > s OR (s2 = s AND k2 < k)").select("k", "k2"), "thin")  # k2 is looked at before k
    open_, kept = cut(own.select("k"), "thin"), None
    while not open_.isEmpty():
        live = before.join(open_, "k", "left_semi").join(open_.withColumnRenamed("k", "k2"), "k2", "left_semi")
        now = cut(open_.join(live.select("k"), "k", "left_anti"), "thin")
        gone = before.join(now.withColumnRenamed("k", "k2"), "k2", "left_semi").select("k")
        kept = now if kept is None else kept.unionByName(now)
        open_ = cut(open_.join(now, "k", "left_anti").join(gone, "k", "left_anti"), "thin")
    return df.join(kept.withColumnRenamed("k", "__k"), F.col(key) == F.col("__k"), "left_semi") if kept is not None else df.limit(0)
