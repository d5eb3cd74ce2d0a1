"""Shared-folder tables: lineage cuts, content-keyed results, resumable and all-or-nothing builds."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share; a local one is set only where it is unset."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = "/tmp/checkpoints/reachlab"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def cut(df: DataFrame, what: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: iterations keep short plans and survive lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def params_hash(params: dict) -> str:
    """SHA-256 of canonical JSON; sets have no order and are refused."""

    def check(x: object) -> None:
        if isinstance(x, (set, frozenset)):
            raise TypeError("a set has no canonical order; give a sorted list")
        if isinstance(x, dict):
            for v in x.values():
                check(v)
        elif isinstance(x, (list, tuple)):
            for v in x:
                check(v)

    check(params)
    return hashlib.sha256(json.dumps(params, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def keyed(spark: SparkSession, root: str, name: str, params: dict, compute: Callable[[], DataFrame]) -> DataFrame:
    """The table of these parameters: read if a complete one is there, else computed and written (complete means _SUCCESS)."""
    path = f"{root}/{name}-{params_hash(params)[:16]}"
    if not exists(spark, f"{path}/_SUCCESS"):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def pending(wanted: DataFrame, done: DataFrame, key: str, digest: str) -> DataFrame:
    """Rows of wanted whose record is missing, incomplete, or of another input digest."""
    complete = done.filter("complete").select(key, digest)
    return wanted.join(complete, [key, digest], "left_anti")


def publish(spark: SparkSession, staging: str, target: str, parts: list[str]) -> None:
    """Moves a staged build into place only if all its parts are complete; the manifest is written last."""
    missing = [p for p in parts if not exists(spark, f"{staging}/{p}/_SUCCESS")]
    if missing:
        raise RuntimeError(f"not published, incomplete: {', '.join(missing)}")
    fs, t = _fs(spark, target)
    fs.mkdirs(t)
    for p in parts:
        _, src = _fs(spark, f"{staging}/{p}")
        _, dst = _fs(spark, f"{target}/{p}")
        fs.delete(dst, True)
        if not fs.rename(src, dst):
            raise RuntimeError(f"{p} could not be moved")
    spark.createDataFrame([(json.dumps({"parts": parts}, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{target}/manifest")
