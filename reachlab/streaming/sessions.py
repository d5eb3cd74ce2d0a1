"""Structured Streaming forms, an extension: sessions of traces, and the latest version of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_counts(stream: DataFrame, key: str, ts: str, gap: str = "15 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions per key: start, end, n. State older than the watermark is dropped, so memory is bounded by what may still be late."""
    s = stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return s.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def upsert_latest(batch: DataFrame, target: str, key: str, version: str) -> None:
    """For foreachBatch: the newest row of each key of what is there and what comes, written beside and then swapped in."""
    spark = batch.sparkSession
    from reachlab.plans.materialize import _fs, exists

    old = spark.read.parquet(target) if exists(spark, f"{target}/_SUCCESS") else None
    both = batch if old is None else batch.unionByName(old)
    cols = [c for c in both.columns if c != key]
    latest = both.groupBy(key).agg(F.max(F.struct(version, *[c for c in cols if c != version])).alias("__r")).select(key, *[F.col(f"__r.{c}").alias(c) for c in cols])
    latest.write.mode("overwrite").parquet(f"{target}.new")
    fs, dst = _fs(spark, target)
    fs.delete(dst, True)
    fs.rename(_fs(spark, f"{target}.new")[1], dst)
