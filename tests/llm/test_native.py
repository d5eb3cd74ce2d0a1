"""Decontamination, line dedup and quality rules: brute force on small cases, and the edges."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from reachlab.llm import decontam, line_dedup, quality_rules, queries

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, source string, __w string, n_hit string"


def lower(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "s", "x", "y") for i, t in rows], DOCS)


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


G = "one Two three FOUR five six seven eight nine ten eleven"
ITEMS = [(1, G), (22, "Éclair über alles"), (3, None), (4, "..."), (5, ""), (6, "tiny"), (22, "Éclair über alles")]
TEXTS = [(1, f"before {G.lower()}, after"), (2, None), (3, ""), (4, "a b c"), (5, "x Éclair ÜBER alles"), (6, "x Éclair über, ALLES y tiny"), (6, "x Éclair über, ALLES y tiny"), (None, "tiny"), (8, ("w " * 3000) + G + " " + G), (9, "one two three four five six seven eight nine"), (6, "other")]


def brute(text):
    w = WORD.findall(lower(text or ""))
    hit, items = set(), set()
    for i, t in ITEMS:
        g = WORD.findall(lower(t or ""))
        for k in range(max(1, len(g) - 9)) if g else ():
            gram = g[k : k + 10]
            for j in range(len(w) - len(gram) + 1):
                if w[j : j + len(gram)] == gram:
                    hit |= set(range(j, j + len(gram)))
                    items.add(str(i))
    return len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)


def test_decontamination_against_brute_force(spark):
    got = decontam.report(docs(spark, TEXTS), bench(spark, ITEMS)).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(repr((i, *brute(t))) for i, t in TEXTS)


def test_decontamination_shuffled_path_agrees(spark, monkeypatch):
    want = sorted(map(repr, decontam.report(docs(spark, TEXTS), bench(spark, ITEMS)).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert sorted(map(repr, decontam.report(docs(spark, TEXTS), bench(spark, ITEMS)).collect())) == want


def test_removal(spark):
    d = docs(spark, TEXTS)
    clash = d.select("*", *[F.lit(1).alias(c) for c in ("row", "id", "t", "k", "kt", "spans", "__k", "__kt", "__spans")])
    kept = decontam.remove(clash, bench(spark, ITEMS))
    assert kept.columns == clash.columns and decontam.remove(clash, bench(spark, ITEMS), unit="spans").columns == clash.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 6, 9]
    cut = {r.doc_id: r.text for r in decontam.remove(d, bench(spark, ITEMS), unit="spans").filter("text <> 'other'").collect()}
    assert cut[1] == "before , after" and cut[6] == "x  y " and cut[4] == "a b c" and cut[9] == TEXTS[9][1]
    with pytest.raises(ValueError):
        decontam.remove(d, bench(spark, ITEMS), unit="words")


def test_decontamination_of_nothing(spark):
    assert decontam.report(docs(spark, []), bench(spark, ITEMS)).count() == 0
    assert {r.n_hit for r in decontam.report(docs(spark, TEXTS), bench(spark, [])).collect()} == {0}


LONG = "This line is shared by many documents, and long enough."


def line_cases():
    rows = [(i, f"own {i}\n  {LONG.upper() if i % 2 else LONG}\t\n{LONG}\nend") for i in range(1, 8)]
    return [*rows, (8, None), (9, ""), (10, "\n"), (3, rows[2][1]), (None, LONG), (11, "short\nshort"), (12, "ab" * 50_000)]


def brute_lines(rows):
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    found = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 40:
                found.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        ls = (t or "").split("\n")
        stay = [x for x in ls if i is None or len(found.get(key(x), ())) < 5 or i == max(found[key(x)])]
        out.append((i, len(ls), len(ls) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return out


@pytest.mark.parametrize(("batches", "bound"), [(1, None), (4, None), (3, 0)])
def test_lines_against_brute_force(spark, monkeypatch, batches, bound):
    if bound is not None:
        monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", bound)
        monkeypatch.setattr("reachlab.llm._common.BROADCAST_ROWS", bound)
    rows = line_cases()
    got = [tuple(r) for r in line_dedup.report(docs(spark, rows), batches=batches).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_lines(rows)))


def test_rewriting_keeps_columns_and_nulls(spark):
    d = docs(spark, line_cases())
    out = line_dedup.rewrite(d)
    assert out.columns == d.columns
    clash = d.select("*", *[F.lit(1).alias(c) for c in ("row", "lines", "kept", "dropped", "k", "drop", "stay", "h1", "__lines", "__k", "__drop", "__stay")])
    assert sorted(map(repr, line_dedup.rewrite(clash).select(d.columns).collect())) == sorted(map(repr, out.collect()))
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[8] is None and texts[1] == "own 1\nend" and LONG in texts[7]
    assert line_dedup.report(docs(spark, [])).count() == 0


def test_lines_of_later_batches_meet_a_kept_store(spark, tmp_path):
    store = str(tmp_path / "store")
    first, later = [(i, LONG) for i in range(1, 5)], [(9, LONG), (10, "other")]
    assert {r.n_dropped for r in line_dedup.report(docs(spark, first), store=store).collect()} == {0}
    got = {r.doc_id: r.n_dropped for r in line_dedup.report(docs(spark, later), store=store).collect()}
    assert got == {9: 0, 10: 0}
    assert {r.doc_id: r.n_dropped for r in line_dedup.report(docs(spark, [(6, LONG)]), store=store).collect()} == {6: 1}


def test_runs_are_not_shuffled(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, str(tmp_path / "runs"), fanout=10)
    for k in range(3):
        runs.add(spark.range(1000).select((F.col("id") % 700).alias("h1"), F.lit(1).cast("long").alias("h2"), (F.col("id") * 7 + k).alias("id")))
    fresh = runs.read(runs.runs()[2])
    for name in runs.runs()[:2]:
        fresh = fresh.join(runs.read(name).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_repeats_of_several_batches_are_summed_up(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, str(tmp_path / "summed"))
    for k in range(5):
        runs.add(spark.range(500).select("id", F.lit(1).cast("long").alias("h2"), F.lit(k + 1).cast("long").alias("doc")).select(F.col("id").alias("h1"), "h2", F.col("doc").alias("id")))
    got = [tuple(r) for r in runs.frequent(5).collect()]
    assert sorted(got) == [(h, 1, 5) for h in range(500)]
    assert len(runs.repeats) == 1


def test_lines_match_the_sql_on_a_whole_table(spark):
    path = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet')")
    cur = con.execute(queries.ORACLE_SQL["op2_line_dedup"])
    names = [c[0] for c in cur.description]
    got = [tuple(r) for r in queries.op2_line_dedup(spark, path).select(names).collect()]
    assert sorted(got) == sorted(cur.fetchall())


def brute_rules(t):
    w = [x for x in re.split("[\x20\x09-\x0d]+", t or "") if x]
    g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    rep = {j for i, x in enumerate(g) if g.count(x) > 1 for j in (i, i + 1, i + 2)}
    ls = [x for x in (t or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(ls) - len(set(ls)), len(rep)


def test_rules_against_brute_force(spark):
    texts = [None, "", "  \n ", "a b c a b c x", "é#*| <é>\né#*| <é>\n\n\n", "w " * 200, " ".join(f"w{i}" for i in range(60)), "a b " * 30 + "\n" + "a b " * 30, "one two"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, ""), (None, "x y z")]
    got = quality_rules.judge(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {repr((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got}
    assert by == {repr((i, *brute_rules(t))) for i, t in rows}
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_hosts_that_mostly_fail_are_refused(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(k * 1000 + i, good if i >= bad else "bad", f"h{k}") for k, bad in enumerate((95, 5, 5, 6, 4)) for i in range(100)] + [(9999, good, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(d).collect()}
    assert not kept[99] and kept[1099] and kept[9999] and sum(kept.values()) == 381
    assert quality_rules.judge(d.limit(0)).count() == 0
    assert quality_rules.judge(d.withColumn("__host", F.lit(1)).withColumn("rate", F.lit(2))).count() == len(rows)
