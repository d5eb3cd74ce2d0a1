"""The trained operators: held-out accuracy on the test tables, and the edges."""

import numpy as np
from pyspark.sql import functions as F

from reachlab.llm import langid, quality_clf, queries, toxicity

D = "/root/testdata/sf0.01"
EDGE = [(1, None), (2, ""), (3, "123 !!! ..."), (None, "The thing and the other."), (5, "x" * 100_000), (6, "a b"), (6, "a b")]


def edge(spark):
    return spark.createDataFrame([(i, t, 1.0, "z") for i, t in EDGE], "doc_id long, text string, score double, held_out string")


def split(spark, m):
    return spark.read.parquet(f"{D}/documents.parquet").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % m[0] == m[1])


def test_languages_of_held_out_texts(spark):
    out = queries.op4_langid(spark, D).join(split(spark, (5, 0)).select("doc_id", "lang"), "doc_id").collect()
    assert out and all(r.held_out for r in out) and np.mean([r.lang == r.lang_pred for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_language_edges(spark):
    model = langid.fit(["the thing and that", "der die und das"] * 20, ["en", "de"] * 20, list(range(40)))
    got = langid.identify(edge(spark), model).collect()
    assert len(got) == len(EDGE)
    by = {r.doc_id: r for r in got}
    assert by[1].lang_pred == by[2].lang_pred == by[3].lang_pred == "und" and by[3].score == 0.0
    assert by[5].lang_pred in ("en", "de") and by[None].lang_pred == "en" and not by[None].held_out
    assert langid.identify(edge(spark).limit(0), model).count() == 0
    none = edge(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(none, langid.train(none)).collect()} == {"und"}


def test_scores_do_not_depend_on_neighbours():
    model = langid.fit(["the thing and that", "der die und das"] * 20, ["en", "de"] * 20, list(range(40)))
    texts = ["the", "das ist", "", "and thing " * 50]
    alone = np.concatenate([model.probabilities([t]) for t in texts])
    assert np.allclose(alone, model.probabilities(texts))


def check_labels(out, truth, least_recall, most_false):
    rows = out.join(truth, "doc_id").collect()
    hit = [r.predicted for r in rows if r.label == 1]
    false = [r.predicted for r in rows if r.label == 0]
    assert all((r.score >= 0.3) == bool(r.predicted) and 0 <= r.score <= 1 and r.held_out for r in rows)
    assert np.mean(hit) >= least_recall and np.mean(false) <= most_false


def test_quality_of_held_out_texts(spark):
    labels = spark.read.parquet(f"{D}/labels.parquet")
    out = queries.op7_quality(spark, D)
    check_labels(out, split(spark, (5, 0)).join(labels, "doc_id").select("doc_id", F.col("quality").alias("label")), 0.95, 0.35)


def test_toxicity_of_held_out_texts(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    out = toxicity.classify(docs, toxicity.train(docs, labels))
    held = labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).select("doc_id", F.col("toxic").alias("label"))
    check_labels(out, held, 0.75, 0.05)


def test_classifier_edges(spark):
    for module, good in ((toxicity, "you idiot"), (quality_clf, "fine words here")):
        empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
        model = module.train(edge(spark), empty)
        got = module.classify(edge(spark), model).collect()
        assert len(got) == len(EDGE) and len({round(r.score, 9) for r in got}) == 1
        assert module.classify(edge(spark).limit(0), model).count() == 0
        model = module.fit([good, "other text entirely"] * 30, [1, 0] * 30, list(range(60)))
        assert all(0 <= r.score <= 1 for r in module.classify(edge(spark), model).collect())


def test_insults_with_gaps_and_clean_rows_kept(spark):
    rng = np.random.default_rng(2)
    clean = [" ".join("".join(rng.choice(list("aeioulnrstm"), 5)) for _ in range(12)) for _ in range(300)]
    bad = [f"{a} {w} {b}" for a, b, w in zip(clean[:100], clean[100:200], ["blockhead", "dimwitted"] * 50, strict=True)]
    texts, labels = clean + bad, [0] * 300 + [1] * 100
    model = toxicity.fit(texts, labels, list(range(400)))
    low = model.score(["lorem anaus", ""])
    for t in ("you blockhead", "b l o c k h e a d", "b.l.o.c.k.h.e.a.d", "block-head", "blockkhead", "BLOCKHEAD!!"):
        assert model.score([t])[0] >= 0.3 > low.max(), t
    d = spark.createDataFrame([(1, "you blockhead"), (2, clean[5]), (3, None), (4, "")], "doc_id long, text string")
    assert sorted(r.doc_id for r in toxicity.keep_clean(d, model).collect()) == [2, 3, 4]


def test_kernel_counts_gapped_subsequences():
    def slow(s, t, n=toxicity.KERNEL, lam=toxicity.DECAY):
        from itertools import combinations

        a, b = ({}, {})
        for w, out in ((s, a), (t, b)):
            for ix in combinations(range(len(w)), n):
                u = "".join(w[i] for i in ix)
                out[u] = out.get(u, 0) + lam ** (ix[-1] - ix[0] + 1)
        return sum(v * b.get(u, 0) for u, v in a.items())

    pairs = [("idiot", "idixot"), ("scum", "scum"), ("abc", "xaybzc"), ("abcabc", "aabbcc")]
    got = toxicity._pair_kernel(toxicity._codes([p[0] for p in pairs]), toxicity._codes([p[1] for p in pairs]))
    assert np.allclose(got, [slow(*p) for p in pairs], rtol=1e-4)


def test_insults_joined_by_marks():
    rng = np.random.default_rng(2)
    clean = [" ".join("".join(rng.choice(list("aeioulnrstm"), 5)) for _ in range(12)) for _ in range(300)]
    bad = [f"{a} {w} {b}" for a, b, w in zip(clean[:100], clean[100:200], ["blockhead", "dimwitted"] * 50, strict=True)]
    model = toxicity.fit(clean + bad, [0] * 300 + [1] * 100, list(range(400)))
    for t in ("dimwitted,blockhead", "blockhead/dimwitted", "blockhead—dimwitted", "|dimwitted|thething|", "blockhead_7_thething"):
        assert model.score([t])[0] >= 0.3 > model.score(["lorem,anaus"])[0], t


def test_spoilt_insults_score_as_toxic(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    model = toxicity.train(docs, labels)
    for t in ("you idiot", "you idixot", "you ixdxixoxt", "you iddddiiiioooot", "you id iot", "stupid/moron", "stupidmoron", "w.o.r.t.h.l.e.s.s"):
        assert model.score([t])[0] >= 0.3, t
    assert model.score(["is the or on", "they are anon"]).max() < 0.1


def test_kernel_values_equal_those_of_a_slow_version():
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdeo"), rng.integers(4, 14))) for _ in range(60)]
    windows = [w for x in words for w in toxicity._windows(x)]
    marks = windows[:9]
    got = toxicity.Kernel(marks)(windows)
    raw = lambda a, b: float(toxicity._pair_kernel(toxicity._codes([a]), toxicity._codes([b]))[0])

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = _step(row, x, b)
        return row[-1]

    def _step(row, x, b):
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        return new

    for i, a in enumerate(windows):
        for j, b in enumerate(marks):
            alike = common(a, b) >= max(toxicity.KERNEL, np.ceil(toxicity.PART * len(b)))
            want = raw(a, b) / (raw(a, a) * raw(b, b)) ** toxicity.NORM if alike else 0.0
            assert np.isclose(got[i, j], want, rtol=1e-3, atol=1e-6)
