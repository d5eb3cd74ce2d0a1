"""What the trained operators share: the held-out rule, fitting on a bounded labelled sample, and logistic calibration."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from reachlab.llm._common import lookup_join, parts, ship, staged, trim

ship(__name__)


def remainder(id_col: str, modulus: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def fitted(docs: DataFrame, labels: DataFrame, label: str, keep: Column, per_class: int, fit: Callable[[pd.DataFrame], object], id_col: str = "doc_id", text_col: str = "text") -> object:
    """What fit makes of a frame id, text, label, weight: at most per_class labelled ids of each class, the first by a hash of the id.

    Fitting is bounded by per_class, a documented parameter of each operator; everything else covers all rows. weight
    is how many labelled ids each chosen one stands for, so that calibration sees the classes' true shares. Of an id with
    several labels the largest counts. The sample goes to one task, which fits; only the model comes back.
    """
    own = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & keep).groupBy(F.col(id_col).alias("__i")).agg(F.max(label).alias("__l"))
    own = staged(own, "labelled")
    sizes = {r[0]: r[1] for r in own.groupBy("__l").count().collect()}  # a row a class
    # hashes are even, so the first per_class of a class lie in a share of their range that holds over twice as many: no more is sorted
    hashed, order = own.withColumn("__h", F.xxhash64("__i")), Window.partitionBy("__l").orderBy("__h", "__i")
    share = F.create_map(*[F.lit(x) for c, n in sizes.items() for x in (c, min(1.0, (2 * per_class + 200) / n))]) if sizes else F.create_map()
    few = hashed.filter(F.col("__h") / float(1 << 64) + 0.5 <= share[F.col("__l")]) if sizes else hashed
    chosen = staged(few.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= per_class).select("__i", "__l"), "labelled-sample")
    rows = docs.select(F.col(id_col).alias("__i"), F.col(text_col).alias("text"))
    rows = lookup_join(rows, chosen, ["__i"], "inner", F.col("__i"))
    rows = rows.select(F.col("__i").alias("id"), "text", F.col("__l").alias("label"))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        got = pd.concat(parts).fillna({"text": ""}).sort_values(["id", "text"], kind="stable").drop_duplicates(["id"]).reset_index(drop=True)
        found = got["label"].value_counts()
        got["weight"] = [sizes[v] / found[v] for v in got["label"]]
        yield pd.DataFrame({"model": [cloudpickle.dumps(fit(got))]})
        trim()

    made = rows.repartition(1).mapInPandas(learn, "model binary").collect()
    return cloudpickle.loads(bytes(made[0][0])) if made else fit(pd.DataFrame({"id": [], "text": [], "label": [], "weight": []}))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights of [1, x] by Newton's method; one class only gives a constant."""
    a = np.c_[np.ones(len(x)), x]
    c = np.ones(len(y)) if weight is None else weight / weight.mean() if len(y) else np.ones(0)
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return np.r_[np.log(rate / (1 - rate)), np.zeros(a.shape[1] - 1)]
    w = np.zeros(a.shape[1])
    penalty = np.r_[0, np.full(a.shape[1] - 1, ridge * len(y))]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (c * p * (1 - p) + 1e-6)[:, None]).T @ a + np.diag(penalty) + 1e-9 * np.eye(len(w)), a.T @ (c * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))


def scored(docs: DataFrame, score: Callable[[list[str]], dict[str, object]], columns: str, id_col: str, text_col: str, held_out: Column, chars: int = 1_000_000) -> DataFrame:
    """id, held_out and what score() gives for the texts, about chars characters at a time; null texts are given as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, 2, chars):
                texts = [t or "" for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_pandas(pd.DataFrame({"__id": part.column(0).to_pandas(integer_object_nulls=True), "held_out": part.column(1).to_pandas()} | score(texts)), schema, preserve_index=False)
            trim()

    own = docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("__text"))
    kinds = f"__id long, held_out boolean, {columns}"
    schema = to_arrow_schema(StructType.fromDDL(kinds))
    return own.mapInArrow(run, kinds).withColumnRenamed("__id", id_col)
