"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed by the operators' contracts: what separates words.
SPACES = r"[\x20\x09-\x0D]+"
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows up to which a lookup table is broadcast; beyond it a salted shuffle join is used.
BROADCAST_ROWS = 500_000
SALTS = 16


def ship(module: str) -> None:
    """Sends a module's functions to the executors by value, so that they need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders made so far in this process, until clean() removes them.
MADE: list[str] = []


def work_dir(spark: SparkSession, what: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which driver and executors share.

    Where it is unset, a local folder serves if all runs on this machine; on a cluster that is an error.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "/tmp/checkpoints/reachlab"
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"
    MADE.append(path)
    return path


def clean(spark: SparkSession, since: int = 0) -> None:
    """Removes the folders made after the first `since`; what was read from them must be done with."""
    while len(MADE) > since:
        drop_path(spark, MADE.pop())


def boxed(df: DataFrame, **named: Column) -> DataFrame:
    """The named columns, and all of df's own as one struct "row": names of the two cannot clash. unboxed() takes them out again."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), *[v.alias(k) for k, v in named.items()])


def unboxed(df: DataFrame, **changed: Column) -> DataFrame:
    """The columns of a struct "row", those named by `changed` replaced."""
    return df.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in df.schema["row"].dataType.names])


def staged(df: DataFrame, what: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: the lineage ends there, and a lost executor loses nothing."""
    path = work_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. lower() does just that on pure ASCII text and is many times faster than translate()."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column, separators: str) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def shifted(array: Column, n: int) -> Column:
    """Windows of n consecutive elements, as structs of n fields named "0" to "n-1"."""
    count = F.greatest(F.size(array) - (n - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(array, i + 1, count).alias(str(i)) for i in range(n)])


def hash128(*cols: Column) -> Column:
    """Two chained 64-bit hashes with unrelated seeds; together 128 bits, so that equal hashes mean equal values."""
    return F.struct(F.xxhash64(*cols).alias("h1"), F.xxhash64(F.lit(7), *cols).alias("h2"))


def lookup_join(left: DataFrame, right: DataFrame, on: list[str], how: str, spread: Column) -> DataFrame:
    """Joins to a table whose keys are distinct, best a staged one, as it is counted first. It is broadcast only if that shows that it is small.

    Otherwise both sides are shuffled on key and salt: left rows of a hot key are dealt over SALTS tasks by
    ``spread``, and each right row is copied SALTS times.
    """
    if right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), on, how)
    left = left.withColumn("__salt", F.pmod(F.hash(spread), F.lit(SALTS)))
    right = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right.hint("shuffle_merge"), [*on, "__salt"], how).drop("__salt")


def trim() -> None:
    """Gives free memory back to the system: Python workers outlive their tasks, and what they hold counts against their executor."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def parts(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts in a column have about size bytes, a longer text alone, so that no more is unpacked at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + size, "right")))
        yield batch.slice(i, j - i)
        i = j
