"""Benchmark decontamination with DataFrame functions only.

The benchmark's n-grams of normalised words become a hash table, broadcast if counting shows that it is small
and shuffled otherwise. Every window of every training text is hashed and probed; a hit counts only if its words
equal the gram's. Hit words are summed up per row, and spans or whole documents are removed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachlab.llm._common import BROADCAST_ROWS, NON_WORD, SALTS, ascii_lower, boxed, shifted, staged, unboxed, words

NGRAM = 10


def gram_table(benchmark: DataFrame, n: int = NGRAM, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows: __hash, __gram (its words), __items (ids that hold it). Items of fewer words are one window; of none, none.

    Null texts have no words. A null id still marks words as hit, but is never listed.
    """
    items = benchmark.select(F.col(id_col).cast("string").alias("__item"), words(ascii_lower(F.col(text_col)), NON_WORD).alias("__w"))
    size = F.size("__w")
    starts = F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1)))
    grams = items.filter(size > 0).select("__item", F.explode(F.transform(starts, lambda i: F.slice("__w", i, F.least(F.lit(n), F.size("__w"))))).alias("__gram"))
    grams = grams.groupBy("__gram").agg(F.collect_set("__item").alias("__items"))
    return grams.withColumn("__hash", F.xxhash64("__gram"))


def _hits(texts: DataFrame, keys: list[str], grams: DataFrame, n: int) -> DataFrame | None:
    """keys, __pos, __len, __items of every occurrence of a gram.

    Up to BROADCAST_ROWS grams the table is broadcast. Beyond, windows and grams are shuffled on hash and salt, so that a
    window that very many texts share is dealt over SALTS tasks.
    """
    grams = staged(grams, "grams")
    lengths = sorted(r[0] for r in grams.select(F.size("__gram")).distinct().collect())  # n values at most
    if not lengths:
        return None
    found = []
    small = grams.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    for k in lengths:
        # shifted slices: no lambda is called for a window, and hashing and probing stay in generated code
        windows = texts.select(*keys, F.posexplode(shifted(F.col("__w"), k)).alias("__pos", "__win"))
        windows = windows.select(*keys, "__pos", *[F.col("__win").getField(str(i)).alias(f"__w{i}") for i in range(k)])
        hashed = windows.withColumn("__h", F.xxhash64(*[f"__w{i}" for i in range(k)]))  # as Spark hashes the array of them
        same = reduce(Column.__and__, [F.col(f"__w{i}") == F.col("__gram")[i] for i in range(k)])
        own = grams.filter(F.size("__gram") == k)
        if small:
            met = hashed.join(F.broadcast(own), F.col("__h") == F.col("__hash"), "inner")
        else:
            hashed = hashed.withColumn("__s", F.pmod(F.hash("__pos"), F.lit(SALTS)))
            salted = own.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            met = hashed.join(salted.hint("shuffle_merge"), (F.col("__h") == F.col("__hash")) & (F.col("__s") == F.col("__salt")), "inner")
        found.append(met.filter(same).select(*keys, "__pos", F.lit(k).alias("__len"), "__items"))
    return reduce(DataFrame.unionByName, found)


def measure(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, n_hit, items (sorted array of strings), spans (sorted array of pos, len).

    Rows are told apart by id and text: rows equal in both get equal results, a repeated id with another text is
    judged by its own text. Null or empty texts have no words and no hits. An empty benchmark hits nothing.
    Other columns of the inputs are not touched, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col)).alias("__t"), words(ascii_lower(F.col(text_col)), NON_WORD).alias("__w"))
    base = rows.select("__id", "__t", F.size("__w").cast("long").alias("n_words"))
    hits = _hits(rows, ["__id", "__t"], gram_table(benchmark, n, item_col, item_text_col), n)
    if hits is None:
        none = base.select(F.col("__id").alias("k_id"), F.col("__t").alias("k_t")).limit(0)
        summed = none.select("k_id", "k_t", F.array().cast("array<string>").alias("items"), F.array().cast("array<struct<pos:int,len:int>>").alias("spans"))
    else:
        summed = hits.groupBy(F.col("__id").alias("k_id"), F.col("__t").alias("k_t")).agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("__items")))).alias("items"),
            F.array_sort(F.collect_set(F.struct(F.col("__pos").alias("pos"), F.col("__len").alias("len")))).alias("spans"),
        )
    covered = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"], s["pos"] + s["len"] - 1)))))
    summed = summed.withColumn("n_hit", covered.cast("long"))
    out = base.join(summed, F.col("__id").eqNullSafe(F.col("k_id")) & (F.col("__t") == F.col("k_t")), "left")
    return out.select(
        F.col("__id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<pos:int,len:int>>")).alias("spans"), F.col("__t"),
    )


def report(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """measure() as digests: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    m = measure(docs, benchmark, **how)
    return m.select(
        m.columns[0], "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, unit: str = "documents", n: int = NGRAM, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without what the benchmark holds, all columns kept.

    unit "documents" drops every row with a hit word; "spans" cuts each run of hit words out of the text, with the
    separators inside the run. Untouched rows stay as they are, repeated and null ones included.
    """
    if unit not in ("documents", "spans"):
        raise ValueError(f"unit must be documents or spans, not {unit!r}")
    m = measure(docs, benchmark, n=n, id_col=id_col, text_col=text_col, **how).filter("n_hit > 0")
    m = m.select(F.col(id_col).alias("k"), F.col("__t").alias("kt"), "spans").dropDuplicates(["k", "kt"])
    own = boxed(docs, id=F.col(id_col), t=F.xxhash64(F.col(text_col)))
    on = F.col("id").eqNullSafe(F.col("k")) & (F.col("t") == F.col("kt"))
    if unit == "documents":
        return unboxed(own.join(m, on, "left_anti"))
    joined = own.join(m, on, "left")
    # the text as word and separator pieces by turns: words[i] follows seps[i]
    whole = F.col("row")[text_col]
    seps = F.split(whole, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    pieces = words(whole, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    hit = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"], s["pos"] + s["len"] - 1))))
    piece = lambda w, i: F.when(F.array_contains(hit, i), F.when(F.array_contains(hit, i - 1), F.lit("")).otherwise(F.get(seps, i))).otherwise(F.concat(F.get(seps, i), w))
    cut = F.concat(F.array_join(F.transform(pieces, piece), ""), F.element_at(seps, -1))
    return unboxed(joined, **{text_col: F.when(F.col("spans").isNull(), whole).otherwise(cut)})
