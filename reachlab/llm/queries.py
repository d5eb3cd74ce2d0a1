"""The ten operators as registered queries, and their DuckDB equivalents where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reachlab.llm import decontam, html_extract, langid, line_dedup, quality_clf, quality_rules, simhash, spm, toxicity, warc
from reachlab.llm._common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.encode(table(spark, sf_dir, "documents"), spm.model_path(), outputs=("ids_sha256", "decoded_sha256"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_clf.classify(docs, quality_clf.train(docs, table(spark, sf_dir, "labels")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontaminate, op2_line_dedup, op3_warc, op4_langid, op5_sentencepiece, op6_html, op7_quality, op8_simhash, op9_quality_rules, op10_toxicity)
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TRIM = r"regexp_replace({}, '\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z', '', 'g')"

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
g AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i:i + 9])) AS gram FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(gram) AS k FROM g),
p AS (SELECT r, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM d, sizes WHERE len(w) >= k),
h AS (SELECT r, i, k, item_id FROM (SELECT r, i, k, w[i:i + k - 1] AS gram FROM p) JOIN g USING (gram)),
c AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + k)) AS j FROM h) GROUP BY r),
s AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (item_id IS NOT NULL)) AS items FROM h GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN s USING (r)""",
    "op2_line_dedup": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT r, doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM d),
k AS (SELECT *, {_LOWER.format(_TRIM.format('line'))} AS key FROM x),
f AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 40 AND doc_id IS NOT NULL GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, coalesce(k.doc_id <> f.keep, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r""",
    "op3_warc": """
WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS h FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top, sha1(h) AS s FROM p),
b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(('0x' || s[i:i])::INT), 4, '0')), '') AS bits FROM t)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(0, 5), lambda j: bits[5 * i + j + 1:5 * i + j + 1]::INT * (16 // (1 << j))))::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM b""",
    "op9_quality_rules": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(0) || 'null') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS gram FROM w WHERE len(w) >= 3),
n AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 3)) AS j FROM n WHERE c >= 2) GROUP BY r),
c AS (SELECT r, doc_id, host, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (r)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
h AS (SELECT host, count(*) AS n, count(*) FILTER (base_failed) AS failed, count(*) FILTER (base_failed) / count(*) AS own FROM j GROUP BY host),
p AS (SELECT avg(own) AS m, var_samp(own) - avg(own * (1 - own) / n) AS v FROM h),
q AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 2.0), 1e6) ELSE 100.0 END AS s FROM p),
s AS (SELECT host, (failed + m * s) / (n + m * s + (1 - m) * s) AS rate FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(rate, 9) AS host_rate, NOT base_failed AND rate <= 0.5 AS kept
FROM j JOIN s USING (host)""",
}
