"""Fits of the cost model's constants: sums on the cluster, small systems on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def line_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """slope, intercept, n of y = intercept + slope x."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_count(y, x).alias("n"))


def airborne(df: DataFrame, km: str, minutes: str) -> tuple[float, float]:
    """(penalty, cruise km/h); a slope that is not positive is an error."""
    r = line_fit(df, km, minutes).first()
    if r.slope is None or r.slope <= 0:
        raise ValueError(f"time does not rise with distance: {r.slope}")
    return r.intercept, 60.0 / r.slope


def fold(key: str, folds: int) -> Column:
    return F.pmod(F.col(key), F.lit(folds))


def holdout_mae(df: DataFrame, x: str, y: str, held: Column) -> DataFrame:
    """n, mae of the held rows, by a line fitted to the others."""
    r = line_fit(df.filter(~held), x, y).first()
    return df.filter(held).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col(y) - (F.lit(r.intercept) + F.lit(r.slope) * F.col(x)))).alias("mae"))


def out_of_fold(df: DataFrame, group: str, x: str, y: str, folds: int = 5) -> DataFrame:
    """fold, n, mae: each fold of whole groups is predicted by the line fitted to the rest. One pass gathers all folds' sums."""
    own = df.select(F.pmod(F.col(group), F.lit(folds)).alias("fold"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    sums = own.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"), F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("x") * F.col("y")).alias("sxy"))
    parts = np.array([tuple(r) for r in sums.collect()], float)  # a row a fold
    rest = parts[:, 1:].sum(0) - parts[:, 1:]
    slope = (rest[:, 0] * rest[:, 4] - rest[:, 1] * rest[:, 2]) / (rest[:, 0] * rest[:, 3] - rest[:, 1] ** 2)
    intercept = (rest[:, 2] - slope * rest[:, 1]) / rest[:, 0]
    fits = F.create_map(*[F.lit(v) for f, a, b in zip(parts[:, 0], intercept, slope, strict=True) for v in (int(f), float(a))]), F.create_map(*[F.lit(v) for f, b in zip(parts[:, 0], slope, strict=True) for v in (int(f), float(b))])
    f = F.col("fold").cast("int")
    return own.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col("y") - fits[0][f] - fits[1][f] * F.col("x"))).alias("mae"))


def least_squares(df: DataFrame, columns: list[Column], y: Column, weight: Column | None = None) -> np.ndarray:
    """Coefficients by normal equations: products are summed on the cluster, the small system is solved here."""
    w, k = weight if weight is not None else F.lit(1.0), len(columns)
    products = [F.sum(w * columns[i] * columns[j]).alias(f"p{i}_{j}") for i in range(k) for j in range(i, k)] + [F.sum(w * columns[i] * y).alias(f"q{i}") for i in range(k)]
    r = df.agg(*products).first()
    gram = np.array([[r[f"p{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)], float)
    return np.linalg.lstsq(gram, np.array([r[f"q{i}"] for i in range(k)], float), rcond=None)[0]


def gravity(df: DataFrame, per_week: str, weight_a: Column, weight_b: Column, km: str) -> np.ndarray:
    """log(per week) = c0 + c1 log(weight a) + c2 log(weight b) + c3 log(km)."""
    return least_squares(df, [F.lit(1.0), F.log(weight_a), F.log(weight_b), F.log(F.col(km))], F.log(F.col(per_week)))


def class_speeds(df: DataFrame, km: list[str], minutes: str, support_km: float = 2000.0, support_n: int = 30) -> list[float]:
    """km/h of each class from journeys' km by class, as 60 over the fitted minutes a km; too little support gives NaN."""
    sums = df.agg(*[F.sum(k).alias(f"k_{k}") for k in km], *[F.sum((F.col(k) > 0).cast("long")).alias(f"n_{k}") for k in km]).first()
    fitted = [k for k in km if (sums[f"k_{k}"] or 0) >= support_km and (sums[f"n_{k}"] or 0) >= support_n]
    per_km = dict(zip(fitted, least_squares(df, [F.col(k).cast("double") for k in fitted], F.col(minutes)), strict=True)) if fitted else {}
    return [60.0 / per_km[k] if per_km.get(k, 0) > 0 else float("nan") for k in km]


def log_error_fit(x: np.ndarray, y: np.ndarray, start: tuple[float, ...], low: tuple[float, ...], high: tuple[float, ...], rounds: int = 100) -> np.ndarray:
    """Bounded Gauss-Newton on log residuals of y = a + b x; for samples that fit one machine."""
    p = np.array(start, float)
    lam = 1e-3
    loss = lambda q: float(((np.log(np.maximum(q[0] + q[1] * x, 1e-9)) - np.log(y)) ** 2).sum())
    for _ in range(rounds):
        f = np.maximum(p[0] + p[1] * x, 1e-9)
        j = np.c_[1 / f, x / f]
        r = np.log(f) - np.log(y)
        step = np.linalg.solve(j.T @ j + lam * np.diag((j * j).sum(0) + 1e-12), -j.T @ r)
        new = np.clip(p + step, low, high)
        if loss(new) < loss(p):
            done, p, lam = np.abs(new - p).max() < 1e-10, new, lam / 3
            if done:
                break
        else:
            lam *= 5
            if lam > 1e12:
                break
    return p


def bootstrap(df: DataFrame, key: str, x: str, y: str, samples: int = 50) -> DataFrame:
    """sample, slope: each row counts a Poisson number of times, drawn from a hash of key and sample, so no order matters."""
    draws = F.transform(F.sequence(F.lit(1), F.lit(samples)), lambda s: F.struct(s.alias("sample"), (F.pmod(F.xxhash64(F.col(key), s), F.lit(1_000_000)) / 1e6).alias("u")))
    d = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), F.explode(draws).alias("d"))
    cdf = (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582)  # Poisson(1)
    w = sum(((F.col("d.u") >= p).cast("int") for p in cdf), F.lit(0))
    s = d.withColumn("w", w).groupBy("d.sample").agg(*[F.sum(e).alias(n) for n, e in (("n", F.col("w")), ("sx", F.col("w") * F.col("x")), ("sy", F.col("w") * F.col("y")), ("sxx", F.col("w") * F.col("x") * F.col("x")), ("sxy", F.col("w") * F.col("x") * F.col("y")))])
    return s.select("sample", ((F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))).alias("slope"))
