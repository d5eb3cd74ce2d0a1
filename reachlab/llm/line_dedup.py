"""Line dedup on levelled sorted runs of line hashes, with DataFrame functions only.

A store holds runs: tables of 128-bit line hashes, bucketed and sorted by hash, each hash in one run only. A batch of
documents is bucketed likewise and merge-anti-joined with the runs, bucket by bucket, so that no run is ever shuffled:
hashes they lack become a run of level 0, those they hold go to a log of repeats. FANOUT runs of a level are merged into one
of the next. The store can be kept and named, so that later documents are held against all earlier ones.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reachlab.llm._common import BROADCAST_ROWS, ascii_lower, boxed, drop_path, lookup_join, staged, unboxed, work_dir

MIN_CHARS = 40
MIN_DOCS = 5
#: Batches that a table is taken in at least, and bytes of a batch at most, by the optimizer's estimate.
BATCHES, BATCH_BYTES = 4, 1 << 38
#: The optimizer's estimates from here on mean that it does not know.
UNKNOWN = 1 << 60
FANOUT = 2
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(" \t\n\x0b\f\r")))


def _hashes(lines: Column, min_chars: int) -> Column:
    """Two hashes of each line's key; null for keys too short to count."""
    return F.transform(F.transform(lines, line_key), lambda k: F.when(F.length(k) >= min_chars, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(7), k).alias("h2"))))


class LineRuns:
    """The store: runs by level, and the log of repeats, in one folder that all executors share.

    All its tables have the same buckets; a bucket is one sorted file. The list of tables is written after each batch:
    opening a folder again goes on from the last batch that was added whole.
    """

    def __init__(self, spark: SparkSession, path: str, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), fanout
        self.levels: dict[int, list[str]] = {}
        self.repeats: list[str] = []
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._n = 0
        list_ = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/list.json")
        files = list_.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(list_):
            stream = files.open(list_)
            known = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            stream.close()
            self.levels, self.repeats, self.buckets, self._n = {int(k): v for k, v in known["levels"].items()}, known["repeats"], known["buckets"], known["n"]

    def _name(self, kind: str) -> str:
        self._n += 1
        return f"{kind}_{self._n}"

    def _table(self, name: str) -> str:
        return f"lines_{abs(hash(self.path)):x}_{name}"

    def _write(self, df: DataFrame, kind: str) -> str:
        name = self._name(kind)
        df.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.path}/{name}").mode("overwrite").saveAsTable(self._table(name))
        return name

    def read(self, name: str) -> DataFrame:
        if not self.spark.catalog.tableExists(self._table(name)):
            self.spark.sql(f"CREATE TABLE {self._table(name)} (h1 BIGINT, h2 BIGINT, n BIGINT, keep BIGINT) USING PARQUET CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}'")
        return self.spark.table(self._table(name))

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
            drop_path(self.spark, f"{self.path}/{name}")

    def _merged(self, names: list[str]) -> DataFrame:
        """One row per hash of several tables, joined bucket by bucket: counts summed, the largest id kept.

        Not by a union: Spark 4.1 takes a union of bucketed tables for bucketed and groups it without an exchange, but its
        tasks do not hold the same bucket of each table, so a hash that is in two tables would stay two rows.
        """
        merged = self.read(names[0])
        for name in names[1:]:
            other = self.read(name).select(*KEY, F.col("n").alias("n2"), F.col("keep").alias("keep2"))
            merged = merged.join(other.hint("merge"), KEY, "full_outer").select(*KEY, (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n"), F.greatest("keep", "keep2").alias("keep"))
        return merged

    def runs(self) -> list[str]:
        return [p for level in sorted(self.levels) for p in self.levels[level]]

    def add(self, lines: DataFrame) -> None:
        """lines: h1, h2, id; a batch must hold all rows of its ids."""
        # first by document, so that a hash found in a third of all of them is spread and then summed up before it moves
        once = lines.groupBy(*KEY, "id").agg(F.lit(1).alias("one"))
        batch = once.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keep"))
        gone: list[str] = []
        if self.runs():
            own = self._write(batch, "batch")
            fresh = self.read(own)
            for run in self.runs():
                fresh = fresh.join(self.read(run).select(*KEY).hint("merge"), KEY, "left_anti")
            new = self._write(fresh, "run")
            self.repeats.append(self._write(self.read(own).join(self.read(new).select(*KEY).hint("merge"), KEY, "left_anti"), "repeats"))
            gone.append(own)
        else:
            new = self._write(batch, "run")
        self.levels.setdefault(0, []).append(new)
        level = 0
        while len(self.levels.get(level, [])) >= self.fanout:
            old = self.levels.pop(level)
            self.levels.setdefault(level + 1, []).append(self._write(self._merged(old), "run"))
            gone += old
            level += 1
        self._save()
        self._drop(gone)

    def _save(self) -> None:
        state = json.dumps({"n": self._n, "levels": self.levels, "repeats": self.repeats, "buckets": self.buckets})
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/list.json")
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(state.encode()))
        out.close()

    def frequent(self, min_docs: int) -> DataFrame:
        """h1, h2, keep of the hashes found in at least min_docs documents."""
        found = self.spark.createDataFrame([], "h1 long, h2 long, keep long")
        if not self.runs():
            return found
        if self.repeats:
            while len(self.repeats) > 1:  # pair by pair; summed up, the log says the same
                old = self.repeats
                self.repeats = [self._write(self._merged(old[i : i + 2]), "log") if i + 1 < len(old) else old[i] for i in range(0, len(old), 2)]
                self._save()
                self._drop([name for name in old if name not in self.repeats])
        for run in self.runs():
            own = self.read(run)
            if self.repeats:
                log = self.read(self.repeats[0]).select(*KEY, F.col("n").alias("n2"), F.col("keep").alias("keep2"))
                own = own.join(log.hint("merge"), KEY, "left").select(*KEY, (F.col("n") + F.coalesce("n2", F.lit(0))).alias("n"), F.greatest("keep", F.coalesce("keep2", "keep")).alias("keep"))
            found = found.unionByName(own.filter(F.col("n") >= min_docs).select(*KEY, "keep"))
        return found

    def remove(self) -> None:
        self._drop([*self.runs(), *self.repeats])
        drop_path(self.spark, self.path)


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None, store: str | None = None) -> DataFrame:
    """row (a struct of all of docs' columns), lines (array), kept (the text after dropping) and dropped (long).

    Lines are what \\n separates; a null or empty text is one empty line. A line's key is the line stripped of ASCII
    white space, A-Z lower-cased. Keys of at least min_chars code points found in at least min_docs documents (ids)
    lose all their lines except in the row or rows of the largest id. A row whose id is null keeps its lines and
    counts for none. Repeated rows of an id are one document. Very long texts are taken whole; an empty table gives no rows;
    all columns of docs pass through, whatever their names. With store, a shared folder, the hashes are added to those it holds
    already, earlier documents count too, and the folder stays; docs must then be none of those.
    """
    spark = docs.sparkSession
    path = work_dir(spark, "lines")
    lines = lambda t: F.split(F.coalesce(t, F.lit("")), "\n")
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    batches = batches or (max(BATCHES, math.ceil(size / BATCH_BYTES)) if size < UNKNOWN else BATCHES)
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.explode(F.array_distinct(F.array_compact(_hashes(lines(F.col(text_col)), min_chars)))).alias("h"))
    keyed = keyed.filter(F.col("id").isNotNull()).select(F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int").alias("batch"), F.col("h.h1").alias("h1"), F.col("h.h2").alias("h2"), "id")
    keyed.write.partitionBy("batch").parquet(f"{path}/keys")
    keys = spark.read.schema("h1 long, h2 long, id long, batch int").parquet(f"{path}/keys")
    runs = LineRuns(spark, store or f"{path}/store")
    for b in range(batches):
        runs.add(keys.filter(F.col("batch") == b))
    frequent = staged(runs.frequent(min_docs), "lines-frequent")
    if store is None:
        runs.remove()
    hits = lookup_join(keys.select(*KEY, "id"), frequent, KEY, "inner", F.col("id")).filter(F.col("id") != F.col("keep"))
    drop = staged(hits.groupBy(F.col("id").alias("k")).agg(F.collect_set(F.struct("h1", "h2")).alias("drop")), "lines-drop")
    drop_path(spark, f"{path}/keys")
    size = drop.agg(F.sum(F.size("drop"))).first()[0] or 0
    drop = F.broadcast(drop) if size <= BROADCAST_ROWS else drop.hint("merge")  # so the texts move only if they have to
    own = boxed(docs, k=F.col(id_col).cast("long"))
    out = own.join(drop, "k", "left").withColumn("lines", lines(F.col("row")[text_col]))
    pairs = F.arrays_zip(F.col("lines").alias("l"), _hashes(F.col("lines"), min_chars).alias("h"))
    stay = F.transform(F.filter(pairs, lambda x: x["h"].isNull() | ~F.array_contains("drop", x["h"])), lambda x: x["l"])
    out = out.withColumn("stay", F.when(F.col("drop").isNull(), F.col("lines")).otherwise(stay))
    return out.select("row", "lines", F.array_join("stay", "\n").alias("kept"), (F.size("lines") - F.size("stay")).cast("long").alias("dropped"))


def report(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """One row per input row: id, n_lines, n_dropped, kept_sha256. See mark() for every edge."""
    m = mark(docs, id_col=id_col, **how)
    return m.select(F.col("row")[id_col].alias(id_col), F.size("lines").cast("long").alias("n_lines"), F.col("dropped").alias("n_dropped"), F.sha2("kept", 256).alias("kept_sha256"))


def rewrite(docs: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """docs with the repeated lines cut out of the texts; texts that lose nothing stay as they are, null included. See mark() for every edge."""
    m = mark(docs, text_col=text_col, **how)
    text = F.when(F.col("dropped") == 0, F.col("row")[text_col]).otherwise(F.col("kept"))
    return unboxed(m, **{text_col: text})
