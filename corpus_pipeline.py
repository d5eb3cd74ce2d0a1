"""The training-data pipeline: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reachlab.llm import decontam, line_dedup, simhash, spm, toxicity
from reachlab.llm._common import MADE, clean, drop_path, table, work_dir


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents scored as toxic go."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: lines that many documents share stay in one; n_chars follows the text."""
    return _recount(docs, line_dedup.rewrite(docs))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each group of near copies the smallest id stays; rows without an id stay."""
    return simhash.keep_one(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that hold a benchmark passage go; null and empty texts stay."""
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"), unit="documents")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: token counts, ids, and digests of the ids and of the text decoded from them."""
    return spm.encode(docs, spm.model_path(), outputs=("ids", "ids_sha256", "decoded_sha256"))


def _recount(before: DataFrame, after: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    n = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")) if "n_chars" in before.columns else None
    return after if n is None else after.withColumn("n_chars", n.cast(before.schema["n_chars"].dataType))


STAGES = [
    ("toxicity", toxic_out),
    ("line dedup", lines_once),
    ("SimHash near-dedup", near_copies_out),
    ("benchmark decontamination", benchmark_out),
    ("SentencePiece", encoded),
]

#: A trained machine, XXH64 and merge rounds are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again; a stage's working folders and its input go once it is written.

    Rows with null ids or texts, empty texts, repeated rows and further columns pass through as each operator's docstring says.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        made = len(MADE)
        out = stage(spark, docs, sf_dir)
        path = f"{work_dir(spark, 'pipeline')}/{name.replace(' ', '-')}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        own = MADE.pop()
        clean(spark, made)
        if before:
            drop_path(spark, before)
        before = own
    return docs
