"""SimHash, SentencePiece, WARC, HTML extraction and the pipeline."""

import base64
import hashlib
import random
import re

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from reachlab.llm import html_extract as H
from reachlab.llm import simhash as S
from reachlab.llm import spm, warc

D = "/root/testdata/sf0.001"


def fingerprint(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if x]
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in h) > len(h))


def brute_groups(rows):
    f = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (f[a] ^ f[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    low = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            low[find(a)] = min(low.get(find(a), i), i)
    return [(i, f"{f[a]:016x}", low.get(find(a))) for a, (i, _) in enumerate(rows)]


def test_simhash_against_brute_force(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(400)}" for _ in range(150)] for _ in range(8)]
    rows = [(k * 100 + j, " ".join(w if rng.random() > 0.01 * (j > 0) else "Changed" for w in b)) for k, b in enumerate(base) for j in range(6)]
    rows += [(5000, None), (5001, ""), (5002, " \t "), (5003, "a b"), (5004, "A  b"), (5003, "a b"), (None, "a b"), (5005, "x " * 20_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, "q", 1) for i, t in rows], "doc_id long, text string, fp string, component long")
    got = [tuple(r) for r in S.report(df).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_groups(rows)))
    kept = S.keep_one(df.selectExpr("*", "1 AS `row`", "2 AS own", "3 AS gone", "4 AS __gone", "5 AS id", "6 AS copy")).select(df.columns)
    want = {c for _, _, c in brute_groups(rows)}
    assert {r.doc_id for r in kept.collect()} - {None} == want
    assert S.report(df.limit(0)).count() == 0


def test_only_the_near_copy_of_a_repeated_id_goes(spark):
    copy, other = " ".join(f"w{k}" for k in range(150)), " ".join(f"v{k}" for k in range(150))
    rows = [(1, copy), (7, copy), (7, other), (7, other), (8, copy), (None, copy)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(repr, map(tuple, S.keep_one(df).collect()))) == sorted(map(repr, [rows[0], rows[2], rows[3], rows[5]]))


@pytest.mark.parametrize("bucket", [64, 4])
def test_links_connect_all_near_fingerprints(spark, monkeypatch, bucket):
    monkeypatch.setattr(S, "BUCKET", bucket)
    rng = np.random.default_rng(1)
    pts = set()
    for c in rng.integers(0, 2**63, 6, dtype=np.uint64).tolist():
        for _ in range(25):
            x = c
            for k in rng.choice(64, rng.integers(0, 5), replace=False):
                x ^= 1 << int(k)
            pts.add(x)
    v = np.array(sorted(pts), np.uint64)
    links = S.links(spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long")).collect()
    near = [(a, b) for a in range(len(v)) for b in range(a) if (int(v[a]) ^ int(v[b])).bit_count() <= 3]
    place = {int(x): i for i, x in enumerate(v.view(np.int64))}

    def parts(edges):
        root = list(range(len(v)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            root[find(a)] = find(b)
        return {frozenset(i for i in range(len(v)) if find(i) == r) for r in {find(i) for i in range(len(v))}}

    got = [(place[r.a], place[r.b]) for r in links]
    assert all((int(v[a]) ^ int(v[b])).bit_count() <= 3 for a, b in got)
    assert parts(got) == parts(near)


@pytest.fixture(scope="module")
def coders():
    path = spm.model_path()
    return spm.PieceBpe(path), sentencepiece.SentencePieceProcessor(model_file=path)


def test_sentencepiece_is_exact(coders):
    own, lib = coders
    rng = random.Random(1)
    alphabet = "ab the\n\t  ▁é日😀\x00<s>01\r �ñ--==__  "
    texts = ["字" * 50 + "漢字仮名交じり文は空白を置かない" * 40, "abababab" * 200, "thethethe" * 50, "mississippi" * 30, "", " ", "  ", "\n\n", "a" * 3000, " " * 700, "-" * 300 + "=" * 70, "<s></s><0x0A><unk>", "▁▁a ▁", "the " * 2000]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 200))) for _ in range(500)]
    for t in texts:
        ids = lib.encode(t, add_eos=True)
        assert own.encode(t) == ids and own.decode(ids) == lib.decode(ids)
    for _ in range(500):
        ids = [rng.choice([rng.randint(0, 31999), rng.randint(0, 258)]) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == lib.decode(ids)


def test_sentencepiece_table(spark, coders):
    rows = [(1, None), (2, ""), (3, "Hello  wörld\n"), (3, "Hello  wörld\n"), (None, "x"), (4, "ab " * 30_000)]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, ids string")
    got = spm.encode(df, spm.model_path()).collect()
    want = [(i, len(ids), ids, t or "") for i, t in rows for ids in [coders[1].encode(t or "", add_eos=True)]]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert spm.encode(df.limit(0), spm.model_path(), outputs=("ids_sha256",)).count() == 0


PAGES = [(1, "http://www.A.example/x?q=1#f", "<p>one</p>"), (2, "https://a.example:443/", None), (3, None, ""), (4, "not a url", "<p>one</p>"), (5, "http://b.example/ä b", "é" * 50_000), (5, "http://b.example/ä b", "é" * 50_000), (6, "http://[bad", "z"), (None, "http://c.example/", "<p>one</p>"), (None, None, "alone")]


def test_warc_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, payload_digest string")
    directory = warc.write(df, str(tmp_path / "w"))
    got = sorted((tuple(r) for r in warc.read(directory, str(tmp_path / "w")).drop("url").collect()), key=repr)
    top = {}
    for i, _, h in PAGES:
        top[h or ""] = max((x for x in (top.get(h or ""), i) if x is not None), default=None)
    want = []
    for i, _, h in PAGES:
        raw = (h or "").encode()
        t = top[h or ""]
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if i == t else "revisit", None if i == t else t))
    assert got == sorted(want, key=repr)
    found = warc.lookup(directory, str(tmp_path / "w"), "https://www.a.example/x?q=1")
    assert [r["warc"]["WARC-Record-ID"] for r in found] == ["<urn:page:1>"]
    assert warc.lookup(directory, str(tmp_path / "w"), "http://none.example/") == []
    assert warc.report(df.limit(0)).count() == 0
    small = {r.page_id: r.record_type for r in warc.report(df, min_bytes=20).collect()}
    assert small[1] == "response"


def test_index_is_searched_by_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 5)
    df = spark.createDataFrame([(i, f"http://h{i % 3}.example/{i:03d}", f"t{i}") for i in range(60)], "page_id long, url string, html string")
    directory = warc.write(df, str(tmp_path / "v"))
    assert directory.count() >= 12
    for i in (0, 17, 59):
        (r,) = warc.lookup(directory, str(tmp_path / "v"), f"http://h{i % 3}.example/{i:03d}")
        assert r["payload"] == f"t{i}".encode()


def page(i, body):
    return f'<html><head><title>t</title><script>var a="<p>no</p>";</script></head><body><header>top</header><nav><ul><li>menu</ul></nav><div class="ad">buy</div><article><p class="n">Subscribe now</p>{body}</article><aside>side</aside><form><p>f</p></form><div id="comments"><p>me too</p></div><footer>foot {i}</footer></body></html>'


def test_html_extraction(spark):
    rows = [(i, f"http://h.example/{i}", page(i, f"<h1>Title&nbsp;{i}</h1><p>First  <b>part</b>\n{i}<br>next<p>Second {i * 7} &amp; last words here")) for i in range(8)]
    rows += [(20, "http://x.example/", None), (21, None, ""), (22, "http://y.example", "plain text &lt;b&gt;"), (23, "http://y.example", "<div>" * 3000 + "deep"), (24, "u", "<p>a<p>b</nope>"), (24, "u", "<p>a<p>b</nope>")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in H.extract_pages(df).collect()}
    for i in range(8):
        t = f"Title {i} First part {i} next Second {i * 7} & last words here"
        assert got[i] == (t, len(t))
    assert got[20] == got[21] == ("", 0) and got[22][0] == "plain text <b>" and got[23][0] == "deep" and got[24][0] == "a b"
    assert H.extract_pages(df).count() == len(rows) and H.extract_pages(df.limit(0)).count() == 0


def test_copies_make_no_template():
    same = [page(i, "<p>The same long story on every page, word for word, as copies are.</p>") for i in range(8)]
    assert H.induce(same) == []


NOTICE = "Join our list of readers today"


def story(i, first="", n=None):
    body = "".join(f"<p>Part {j} of story {i}, told as on no other page: {i * 31 + j}.</p>" for j in range(n or 2 + i % 5))
    return f"<html><body><nav>menu</nav><article>{first}{body}</article></body></html>"


def texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in H.extract_pages(df).collect()}


def test_templates_come_from_all_pages(spark):
    ids = [r.id for r in spark.range(40).orderBy(F.xxhash64("id"), "id").collect()]  # as pages were once sampled
    rows = [(i, f"http://all.example/{i}", story(i, f"<p>{NOTICE}</p>" if n % 10 else "")) for n, i in enumerate(ids)]  # on 36 of 40
    rows += [(100 + i, f"http://few.example/{i}", story(i, "<p>A line of these pages alone</p>" if n < 12 else "", 3)) for n, i in enumerate([r.id - 100 for r in spark.range(100, 140).orderBy(F.xxhash64("id"), "id").collect()])]  # on 12 of 40
    got = texts(spark, rows)
    assert not any(NOTICE in got[i] for i in range(40)) and all("Part 1" in t for t in got.values())
    assert sum("A line of these pages alone" in got[100 + i] for i in range(40)) == 12


def test_templates_of_large_and_deep_pages(spark):
    rows = [(i, f"http://l.example/{i}", story(i, f"<p>{NOTICE}</p>", 1600)) for i in range(8)]
    rows += [(10 + i, f"http://d.example/{i}", story(i, "<div>" * 1500 + f"<p>{NOTICE}</p>" + "</div>" * 1500)) for i in range(8)]
    got = texts(spark, rows)
    assert len(got) == 16 and not any(NOTICE in t for t in got.values()) and all(t.startswith("Part 0") for t in got.values())


def test_templates_are_of_a_layout_and_as_induced(spark):
    rng = random.Random(2)
    rows = []
    for i in range(150):
        parts = [f"<p>{NOTICE}</p>"] * (rng.random() < 0.9) + [f"<div class='x'>Written by the desk<br>{i}</div>"] * (rng.random() < 0.9) + [f"<p>Own {i * 7 + j}</p>" for j in range(rng.randint(8, 12))]
        if i % 3 == 0:
            rng.shuffle(parts)  # out of place
        tag = ("article", "main", "div class='story'")[i % 3]
        rows.append((i, f"http://h{i % 2}.example/{i}", f"<{tag}>{''.join(parts)}<footer>f</footer><p>Thank you for reading</p></{tag.split()[0]}>"))
    rows += [(200 + i, url, html) for i, (_, url, html) in enumerate(rows[:30])]  # copies count once
    df = spark.createDataFrame([(u[7:17], h) for _, u, h in rows], "__host string, __html string")
    got = {r[0]: sorted(r[1]) for r in H.templates(df).collect()}
    want = {h: H.induce([p for _, u, p in rows if u[7:17] == h], h) for h in got}
    assert got == want and len(got) == 2 and all(want.values())
    out = texts(spark, rows)
    assert not any("Thank you" in t for t in out.values())
    assert not any(NOTICE in out[i] for i in range(150) if i % 3)  # in the other layout it has no place


def test_simple_tree_matching():
    leaf = lambda x: (x, [], x, x)
    a, b = ("r", [leaf("a"), leaf("b"), leaf("c")], "", ""), ("r", [leaf("x"), leaf("a"), leaf("c")], "", "")
    n, pairs = H.tree_match(a, b)
    assert n == 3 and [(p[0], q[0]) for p, q in pairs[1:]] == [("c", "c"), ("a", "a")]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, D)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == before.columns and out.dtypes == before.dtypes
            assert 0.5 * docs.count() < out.count() <= docs.count()
        docs = out
    assert docs.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert docs.count() == docs.select("doc_id").distinct().count()
