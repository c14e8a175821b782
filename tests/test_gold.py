import numpy as np
from pyspark.sql import functions as F

from sedimenta.functions import web
from sedimenta.operators import graph, identity, search
from sedimenta.sources import documents, snapshots


def test_vector_search_equals_brute_force_in_any_number_of_passes(spark):
    rng = np.random.default_rng(3)
    vectors = [[float(x) for x in rng.normal(size=6)] for _ in range(300)]
    vectors[7] = vectors[8] = vectors[9]
    data = list(enumerate(vectors)) + [(900, [0.0] * 6), (901, None), (902, [1.0]), (None, vectors[0])]
    rows = spark.createDataFrame(data, "id long, embedding array<double>").withColumn("rank", F.lit(1))
    queries = rows.where("id % 20 = 0 or id = 8")
    m = np.array(vectors)
    unit = m / np.linalg.norm(m, axis=1)[:, None]
    for per_pass in (4, 1_000):
        got = {}
        for r in search.vector_search(rows, queries, 5, per_pass).collect():
            got.setdefault(r.query, {})[r["rank"]] = r.id
        assert set(got) == {8, *range(0, 300, 20)}
        for q, ranked in got.items():
            d = np.round(1 - unit @ unit[q], 9) + 0.0
            assert [ranked[i] for i in range(5)] == sorted(range(300), key=lambda i: (d[i], i))[:5]
    assert search.vector_search(rows, queries.limit(0), 5).count() == 0 and search.vector_search(rows.limit(0), queries, 5).count() == 0


def test_lexical_search_ties_blanks_and_repeats(spark):
    rows = spark.createDataFrame([(1, "blue steel"), (2, "Blue, STEEL!"), (3, "blue"), (4, None), (5, ""), (6, "zzz"), (7, "steel " * 20_000), (None, "blue")], "id long, text string")
    got = search.lexical_search(rows, rows.where("id in (1, 4)"), 3, per_pass=1).orderBy("rank").collect()
    assert [(r.query, r.id) for r in got] == [(1, 1), (1, 2), (1, 7)] and got[0].similarity == 1.0
    assert search.grams("Ab") == {"  a", " ab", "ab "} and search.grams(None) == set()
    fused = search.fused_search(2, search.lexical_search(rows, rows.where("id = 1"), 3), search.lexical_search(rows, rows.where("id = 1"), 3)).orderBy("place").collect()
    assert [r.id for r in fused] == [1, 2] and abs(fused[0].score - 2 / 60) < 1e-9


def test_walk_up_stops_and_survives_cycles(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "c"), ("a", "d"), ("x", "b"), (None, "a")], "parent string, child string")
    seeds = spark.createDataFrame([("a",), (None,)], "node string")
    walk = lambda **k: {r.node: r.depth for r in graph.walk_up(seeds, edges, k.pop("max_depth", 9), k.pop("max_nodes", 99), **k).collect()}
    assert walk() == {"a": 0, "b": 1, "c": 2, "x": 2, "d": 3}
    assert walk(max_depth=1) == {"a": 0, "b": 1} and walk(stop=["b"]) == {"a": 0, "b": 1}
    assert "x" not in walk(keep=lambda n: n != "x") and walk(max_nodes=2) == {"a": 0, "b": 1}


def test_edge_groups_hold_the_edges_of_all_pairs(spark):
    data = [("p", ["t1"], ["i1"]), ("q", ["t1", "t2", None], ["i2", "i2"]), ("r", ["t3"], ["i1", "i2"]), ("s", None, ["i9"]), ("u", ["t3"], None), ("v", [], ["i1"])]
    got = graph.edge_groups(spark.createDataFrame(data, "member string, t array<string>, i array<string>").withColumn("_x", F.lit(1)), "t", "i").collect()
    edges = set()
    for x in got:
        for y in got:
            if (x.kind, x.key) == (y.kind, y.key) and x.member < y.member and not set(x.apart) & set(y.apart):
                edges.add((x.member, y.member, x.kind, x.weight))
    true = set()
    for a, ta, ia in data:
        for b, tb, ib in data:
            if a < b:
                same, near = set(ta or []) & set(tb or []) - {None}, set(ia or []) & set(ib or [])
                if same or near:
                    true.add((a, b, "mechanism", 1.0) if same else (a, b, "competitive", 0.7))
    assert edges == true and len(got) == 9


def test_pages(spark):
    html = """<a href='/a/x.PDF?v=1'></a><a href="data.csv"></a><a href="about"></a><a href="pipeline"></a><a href="data.csv"></a><IMG alt="Our Pipeline" src='p.png'><img src="logo.png"><img data-src="/clinical.png">"""
    df = spark.createDataFrame([("https://e.org/b/i.html", html), ("https://e.org/", None)], "base string, html string")
    got = df.select(web.discovered(F.col("base"), F.col("html")).alias("l"), web.image_urls(F.col("base"), F.col("html")).alias("i")).collect()
    assert [(x.url, x.type) for x in got[0].l] == [("https://e.org/b/data.csv", "csv_doc"), ("https://e.org/a/x.PDF?v=1", "pdf_doc"), ("https://e.org/b/pipeline", "pipeline_page")]
    assert got[0].i == ["https://e.org/b/p.png", "https://e.org/clinical.png"] and got[1].l == [] and got[1].i == []
    card = '<div class="card"><h4>A<sup>1</sup> &amp; B</h4><i>x</i><b>Phase 1</b><u>n1</u><u></u></div><div class="card"><h4></h4><i>y</i><b>z</b></div>'
    read = spark.createDataFrame([(card,)], "h string").select(web.cards(F.col("h"), r'(?s)<div class="card">(.*?)</div>', "<h4>(.*?)</h4>", "<i>(.*?)</i>", "<b>(.*?)</b>", "<u>(.*?)</u>").alias("c")).first().c
    assert [tuple(x) for x in read] == [("A1 & B", "x", "Phase 1", "n1")]
    pages = spark.createDataFrame([(200, "phase 1 phase 2 phase 3", 0), (200, "", 0), (200, "", 1), (403, "phase 1 phase 2 phase 3", 0), (404, "", 0), (None, None, 0)], "s int, t string, i int")
    decide = web.render_decision(F.col("s"), F.col("t"), F.col("i") > 0)
    assert [r[0] for r in pages.select(decide).collect()] == ["keep", "fallback", "keep", "fallback", "give_up", "fallback"]


def test_workbooks_and_artifacts(spark, tmp_path):
    folder = f"file://{tmp_path}/books"
    content = documents.xlsx_bytes({"A & B": [["x", "", " y "], ["", ""], ["<z>"]], "S2": [["1"]]})
    snapshots.put_artifact(spark, f"{folder}/a.xlsx", content)
    snapshots.put_artifact(spark, f"{folder}/b.xlsx", b"broken")
    rows = documents.read_xlsx(spark, folder)
    assert sorted((r.sheet, r.row, r.cells) for r in rows.where("error is null").collect()) == [("A & B", 0, ["x", "", "y"]), ("A & B", 2, ["<z>"]), ("S2", 0, ["1"])]
    assert rows.where("error is not null").count() == 1
    assert {bytes(r.content) for r in snapshots.get_artifacts(spark, folder).collect()} == {content, b"broken"}


def test_first_rows_of_a_key_of_any_size(spark):
    rows = [(k, (i * 7919) % 5000, ["x", None][i % 2]) for i in range(5000) for k in ("hot",)] + [("a", 3, None), ("a", 2, "b"), (None, 9, "n"), (None, 8, "m")]
    df = spark.createDataFrame(rows, "k string, n int, v string").withColumn("_n0", F.lit(1))
    got = {(r.k, r.n) for r in identity.first_per_key(df, ["k"], F.desc("n")).collect()}
    assert got == {("hot", 4999), ("a", 3), (None, 9)}
    assert identity.first_per_key(df.limit(0), ["k"], "n").columns == df.columns


def test_settings_are_merged_without_repeats(spark):
    df = spark.createDataFrame([(100, ["b", "a"]), (9_000, None), (None, [])], "w int, s array<string>")
    got = df.select(web.merged_config(F.col("w"), F.col("s"), ["a", "c"]).alias("m")).collect()
    assert [(r.m.wait_ms, r.m.full_page, r.m.selectors) for r in got] == [(3500, True, ["b", "a", "c"]), (9000, True, ["a", "c"]), (3500, True, ["a", "c"])]
