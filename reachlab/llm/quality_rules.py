"""Quality rules with host verdicts, with DataFrame functions only.

Per document, counts of whole texts decide base rules. Failures are added up by host (the document's source),
host rates are shrunk with a beta prior fitted to all hosts by moments, and the verdict is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachlab.llm._common import SPACES, lookup_join, staged, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host is refused if its shrunk failure rate exceeds this share.
MAX_HOST_RATE = 0.5


def _keyed_windows(w: Column) -> Column:
    """3-word windows as (h, i), sorted by hash, so that equal windows stand side by side."""
    count = F.greatest(F.size(w) - 2, F.lit(0))
    windows = F.arrays_zip(F.slice(w, 1, count).alias("a"), F.slice(w, 2, count).alias("b"), F.slice(w, 3, count).alias("c"))
    return F.sort_array(F.transform(windows, lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("i"))))


def count_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed. Null or empty texts count 0."""
    return _counts(docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("__text"))).drop("__text")


def _counts(rows: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("__text"), F.lit(""))
    rows = rows.withColumn("__w", words(text, SPACES)).withColumn("__k", _keyed_windows(F.col("__w")))
    k = F.col("__k")
    near = lambda x, i: F.get(k, i + 1)["h"].eqNullSafe(x["h"]) | F.get(k, i - 1)["h"].eqNullSafe(x["h"])
    rows = rows.withColumn("__p", F.transform(F.filter(k, near), lambda x: x["i"]))
    p = F.col("__p")
    covered = F.size(F.array_distinct(F.concat(p, F.transform(p, lambda x: x + 1), F.transform(p, lambda x: x + 2))))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("__lines", lines)
    out = rows.select(
        *[c for c in rows.columns if c not in ("__w", "__k", "__p", "__lines")],
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, SPACES, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_rates(judged: DataFrame, host: str = "__host") -> DataFrame:
    """Host, n, failed, rate (shrunk). The prior is a beta distribution with the mean and variance of the hosts' own rates.

    Few hosts, or hosts that all fail alike, give no variance to fit; the prior then weighs as much as 100 documents.
    """
    hosts = judged.groupBy(host).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    own = F.col("failed") / F.col("n")
    m, v, noise = hosts.agg(F.avg(own), F.var_samp(own), F.avg(own * (1 - own) / F.col("n"))).first()  # three numbers
    between = (v or 0.0) - (noise or 0.0)  # what the hosts' sizes alone explain is not between them
    m = m or 0.0
    weight = min(max(m * (1 - m) / between - 1, 2.0), 1e6) if between > 0 else 100.0
    rate = (F.col("failed") + m * weight) / (F.col("n") + m * weight + (1 - m) * weight)
    return hosts.select(host, "n", "failed", rate.alias("rate"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per input row: id, counts, base_failed, host_rate, kept.

    kept is false if the base rules fail, and else false if the host's shrunk rate exceeds max_rate. A null host
    is a host of its own. Rows are judged one by one, repeated ids included; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(host_col).cast("string"), F.lit("\u0000null")).alias("__host"), F.col(text_col).alias("__text"))
    judged = staged(_counts(rows).drop("__text"), "rules")  # read twice; counting the texts is the costly part
    verdicts = host_rates(judged).select("__host", F.col("rate").alias("host_rate"))
    out = lookup_join(judged, verdicts, ["__host"], "left", F.col("__id"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return out.select(F.col("__id").alias(id_col), *counts, F.round("host_rate", 9).alias("host_rate"), (~F.col("base_failed") & (F.col("host_rate") <= max_rate)).alias("kept"))
