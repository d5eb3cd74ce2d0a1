"""Table-shaped sources and sinks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reachlab.operators.relational import required_columns
from reachlab.plans.materialize import shared_dir


def csv(spark: SparkSession, path: str, required: list[str], sep: str = ",") -> DataFrame:
    return required_columns(spark.read.csv(path, header=True, inferSchema=True, sep=sep), required)


def write_zip(spark: SparkSession, name: str, members: dict[str, str]) -> str:
    """A small archive in the shared folder, written through the cluster's own file system."""
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        for k, v in members.items():
            z.writestr(k, v)
    path = f"{shared_dir(spark)}/{name}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(raw.getvalue()))
    out.close()
    return path


def zip_lines(spark: SparkSession, path: str, member: str) -> DataFrame:
    """line, number of one member of each archive; lines are streamed, the member is never whole in memory."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(member) as f:
                    rows: list[tuple[str, int]] = []
                    for i, line in enumerate(io.TextIOWrapper(f, "utf-8", newline="\n")):
                        rows.append((line.rstrip("\r\n"), i))
                        if len(rows) == 50_000:
                            yield pd.DataFrame(rows, columns=["line", "number"])
                            rows = []
                    yield pd.DataFrame(rows, columns=["line", "number"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "line string, number long")


def taken_stop_times(times: DataFrame, trips: DataFrame, wanted: Column) -> DataFrame:
    """Stop times of wanted trips only: the trips are filtered first, so the large table is semi-joined while it is read."""
    return times.join(trips.filter(wanted).select("trip"), "trip", "left_semi")


def class_grid(cells: DataFrame, least: float) -> DataFrame:
    """row, col, best (the best class of at least that density), total density."""
    return cells.groupBy("row", "col").agg(F.min(F.when(F.col("density") >= least, F.col("cls"))).alias("best"), F.sum("density").alias("total"))


def packed_rows(df: DataFrame, key: str, order: str, hex_col: str) -> DataFrame:
    """One string of packed values per key, in order."""
    return df.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, hex_col))), lambda x: x[hex_col]), "").alias("packed"))


def ordinals(df: DataFrame, order, alias: str) -> DataFrame:
    """Numbers rows from 0 in an order, without gathering them in one task: rows are range-partitioned and sorted, partitions counted, and each
    row gets its partition's offset and its place in it."""
    order = order if isinstance(order, list) else [order]
    own = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    from reachlab.plans.materialize import cut

    own = cut(own, "ordinals")  # ids of partitions hold only for what was written
    counts = sorted((r["__p"], r["n"]) for r in own.groupBy("__p").agg(F.count(F.lit(1)).alias("n")).collect())  # a row a partition
    offsets, total = {}, 0
    for p, n in counts:
        offsets[p], total = total, total + n
    table = F.create_map(*[F.lit(x) for p, o in offsets.items() for x in (p, o)]) if offsets else F.create_map(F.lit(0), F.lit(0))
    return own.withColumn(alias, (F.col("__i") + table[F.col("__p")]).cast("long")).drop("__p", "__i")


def interned(df: DataFrame, col: str, alias: str) -> DataFrame:
    """A dense code of each distinct value, in the values' order."""
    codes = ordinals(df.select(col).distinct(), col, alias)
    return df.join(codes, df[col].eqNullSafe(codes[col]), "left").drop(codes[col]).withColumn(alias, F.col(alias).cast("int"))


def range_directory(df: DataFrame, block: str) -> DataFrame:
    """block, n, first: how many rows each block has and how many come before it."""
    per = df.groupBy(block).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn("first", F.coalesce(F.sum("n").over(w), F.lit(0)))  # a row a block, already counted
