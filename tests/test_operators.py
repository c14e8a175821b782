import json
import os

from pyspark.sql import functions as F

from sedimenta.operators import graph, identity, quality, search
from sedimenta.sources import documents, snapshots


def rows(df, *order):
    return sorted(map(tuple, df.select(*(order or df.columns)).collect()), key=str)


def test_closure_adjacency_diamond_and_cycle(spark):
    edges = spark.createDataFrame([("A", "B"), ("B", "C"), ("A", "M"), ("M", "C"), ("C", "A")], "parent string, child string")
    nodes = spark.createDataFrame([("A",), ("B",), ("C",), ("M",)], "node string")
    closed = graph.closure(nodes, edges)
    assert closed.count() == 16 and closed.where("ancestor = 'A' and descendant = 'C'").first().depth == 2
    tree = spark.createDataFrame([("A", "B"), ("B", "C"), ("A", "M")], "parent string, child string")
    closed = graph.closure(nodes, tree)
    assert rows(graph.adjacent(closed, "C")) == [("A", "ancestor", 2), ("B", "ancestor", 1), ("C", "exact", 0)]
    assert rows(graph.adjacent(closed, "C", 1)) == [("B", "ancestor", 1), ("C", "exact", 0)]
    assert rows(graph.adjacent(closed, "A")) == [("A", "exact", 0), ("B", "descendant", 1), ("C", "descendant", 2), ("M", "descendant", 1)]
    anchors = spark.createDataFrame([("B", "b", 2), ("A", "a", 1)], "node string, area string, priority int")
    assert dict(rows(graph.anchored_area(closed, anchors, "none"))) == {"A": "a", "B": "a", "C": "a", "M": "a"}


def test_identity_groups_over_a_chain(spark):
    chain = [(f"n{i:02d}", k) for i in range(40) for k in (f"k{i}", f"k{i + 1}")] + [("z", ""), ("y", None)]
    got = dict(rows(graph.identity_groups(spark.createDataFrame(chain, "name string, key string"))))
    assert {v for n, v in got.items() if n[0] == "n"} == {"n00"} and got["z"] == "z" and got["y"] == "y"


def test_neighbours_and_hubs(spark, day):
    target = spark.createDataFrame([("a", "t"), ("b", "t"), ("c", "u")], "member string, key string")
    indication = spark.createDataFrame([("a", "i"), ("b", "i"), ("c", "i")], "member string, key string")
    born = spark.createDataFrame([("a", day(1)), ("b", day(3))], "member string, born_on timestamp_ntz")
    assert rows(graph.neighbours(F.lit("a"), target, indication, born)) == [("b", "mechanism", 1.0, day(3)), ("c", "competitive", 0.7, day(1))]
    assert rows(graph.shared_groups(target, "mechanism", 1.0)) == [("t", "a", "a", "mechanism", 1.0), ("t", "b", "a", "mechanism", 1.0)]


def test_fusion_keeps_unranked(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "id string")
    rank = lambda *xs: spark.createDataFrame([(x, i) for i, x in enumerate(xs)], "id string, rank int")
    got = search.fused(ids, rank("a", "b", "c"), rank("a", "b", "d")).orderBy(F.desc("score"), "id").collect()
    assert [r.id for r in got] == ["a", "b", "c", "d", "e"] and got[-1].score == 0.0
    assert search.fused(ids).where("score = 0").count() == 5


def test_verdicts(spark):
    cases = [
        ((0, 0, None, False, None), ("fail", 0.98)), ((10, 20, 10, True, None), ("pass", 0.82)), ((10, 20, 19, True, None), ("warn", 0.88)),
        ((10, 20, 50, True, None), ("fail", 0.95)), ((10, 20, 50, False, None), ("warn", 0.8)), ((5, 5, None, False, 10), ("fail", 0.93)), ((5, 5, None, False, 4), ("pass", 0.82)),
    ]
    df = spark.createDataFrame([(i, *c[0]) for i, c in enumerate(cases)], "i int, a int, p int, e int, k boolean, o int")
    got = df.orderBy("i").select(quality.verdict(*[F.col(c) for c in "apeko"]).alias("v")).select("v.verdict", "v.confidence").collect()
    assert [tuple(r) for r in got] == [c[1] for c in cases]
    pair = df.limit(1).select(quality.merged(F.struct(F.lit("warn").alias("verdict"), F.lit(0.8).alias("confidence"), F.lit(None).cast("string").alias("action")), F.struct(F.lit("fail").alias("verdict"), F.lit(0.7).alias("confidence"), F.lit("x").alias("action"))).alias("m")).select("m.*").first()
    assert tuple(pair) == ("fail", 0.8, "x")


def test_scores_with_empty_sides(spark):
    facts = lambda xs: spark.createDataFrame([("c", x) for x in xs], "category string, value string")
    got = quality.gate(quality.scores(facts(["a", "b", "b"]), facts(["b", "c"]), ["category", "value"], ["category"])).first()
    assert (got.tp, got.fp, got.fn, got.precision, got.f1, got.passed) == (1, 1, 1, 0.5, 0.5, False)
    assert quality.scores(facts([]), facts(["a"]), ["category", "value"], ["category"]).first().precision == 1.0


def test_keyed_writes_and_resolution(spark):
    df = lambda xs: spark.createDataFrame(xs, "k string, a string, b string")
    old, new = df([("x", "1", None), ("y", None, "2")]), df([("y", "9", "9"), ("z", "3", "3"), ("z", "4", "4")])
    assert rows(identity.missing(new, old, ["k"])) == [("z", "3", "3")]
    assert rows(identity.upserted(old, new, ["k"])) == [("x", "1", None), ("y", "9", "9"), ("z", "3", "3")]
    assert rows(identity.filled(old, new, ["k"], ["a", "b"])) == [("x", "1", None), ("y", "9", "2")]
    assert rows(identity.without(old, new, "k")) == [("x", "1", None)]
    names = lambda xs: spark.createDataFrame(xs, "name string, asset_id string")
    got = dict(rows(identity.resolved(names([("Foo", ""), ("FOO-1", ""), ("?", ""), ("bar", "")]), names([("Foo", "al")]), names([("foo", "sy"), ("foo 1", "n2"), ("foo1", "n1"), ("Bar", "b")]))))
    assert got == {"Foo": "al", "FOO-1": "n1", "?": None, "bar": "b"}


def test_facts(spark):
    schema = documents.EXTRACTION["assets"].dataType.elementType
    asset = ("Foo-1", ["f"], "mAb", None, None, None, [("P Inc", None, None)], [("NSCLC", "Ph2", "active", []), ("AML", "Removed", None, [])], [])
    df = spark.createDataFrame([asset], schema).withColumn("doc", F.lit("d"))
    assert {tuple(r)[1:] for r in quality.asset_facts(df, active_only=True).collect()} == {
        ("asset", "foo1", "", ""), ("modality", "foo1", "mab", ""), ("program", "foo1", "nsclc", ""), ("phase", "foo1", "nsclc", "phase2"), ("partner", "foo1", "pinc", "")
    }


def test_sources(spark, tmp_path, day):
    (tmp_path / "a.csv").write_text("﻿name;n\nx;1\ny;2\n", encoding="utf-8")
    assert rows(documents.read_delimited(spark, str(tmp_path / "a.csv"))) == [("x", "1"), ("y", "2")]
    kinds = spark.createDataFrame([("text/csv; charset=x", ""), (None, ".XLSX"), ("x", ".y")], "c string, e string").select(documents.document_kind(F.col("c"), F.col("e"))).collect()
    assert [r[0] for r in kinds] == ["csv", "xlsx", None]
    raw = spark.createDataFrame([(1, json.dumps({"assets": [{"preferred_name": "a", "synonyms": ["b"]}]})), (2, "broken"), (3, None)], "id int, raw_json string")
    parsed = documents.parsed_extractions(raw)
    assert rows(parsed, "id", "ok") == [(1, True), (2, False), (3, False)]
    assert [r.preferred_name for r in documents.exploded_assets(parsed, "id").collect()] == ["a"]
    for slug, labeled in (("one", True), ("two", False)):
        os.makedirs(tmp_path / "gold" / slug)
        (tmp_path / "gold" / slug / "meta.json").write_text(json.dumps({"company": slug, "labeled": labeled}))
        (tmp_path / "gold" / slug / "expected.json").write_text(json.dumps({"assets": []}))
    assert [r.slug for r in documents.read_golden(spark, str(tmp_path / "gold")).collect()] == ["one"]
    os.makedirs(tmp_path / "caps")
    (tmp_path / "caps" / "c.json").write_text(json.dumps({"captured": "2022-01-01", "period": "Q1", "assets": [{"asset_id": "a", "partners": ["x"]}]}))
    assert documents.read_captures(spark, str(tmp_path / "caps")).count() == 1


def test_hash_skip_and_rebuild(spark, tmp_path, day):
    pages = spark.createDataFrame([("s", "1", day(1), "a b"), ("s", "2", day(2), "a  b"), ("s", "3", day(3), "c")], "source_id string, snapshot_id string, fetched_at timestamp_ntz, text string")
    first = snapshots.marked_snapshots(pages, None)
    assert [(r.changed, r.artifact) for r in first.orderBy("snapshot_id").collect()] == [(True, "a b"), (False, None), (True, "c")]
    folder = str(tmp_path / "snaps")
    snapshots.append_snapshots(first, folder)
    later = spark.createDataFrame([("s", "4", day(4), "c ")], pages.schema)
    assert [r.changed for r in snapshots.marked_snapshots(later, spark.read.parquet(folder)).collect()] == [False]
    out = str(tmp_path / "feed")
    snapshots.rebuild_partitions(spark.createDataFrame([("a", 1), ("b", 1)], "g string, n int"), out, "g")
    snapshots.rebuild_partitions(spark.createDataFrame([("b", 2)], "g string, n int"), out, "g")
    assert rows(spark.read.parquet(out), "g", "n") == [("a", 1), ("b", 2)]
