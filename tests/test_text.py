import pytest
from pyspark.sql import functions as F

from sedimenta.functions import similarity, text, web


def values(spark, function, inputs, *more):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"), *more)).collect()]


@pytest.mark.parametrize(
    ("function", "pairs"),
    [
        (text.preclean, [("Phase III *", "phase iii"), ("Registration (EU, JP)", "registration"), ("Phase 3 in Progress", "phase 3"), (" a ", "a")]),
        (text.phase_identity, [("Ph2", "phase2"), ("Phase II", "phase2"), ("Phase 2 in Progress", "phase2"), ("Regulatory approval achieved", "approved"), ("odd", "odd"), (None, "")]),
        (text.partner_display, [("Janssen Pharmaceuticals, Inc.", "Johnson & Johnson"), ("Acme Therapeutics, Inc.", "Acme"), ("Merck", "Merck"), ("Inc.", None), (None, None)]),
        (text.clean_indication, [("2L+ NSCLC (PD-L1)", "NSCLC"), ("first-line second-line AML", "AML"), ("AML in combination with x", "AML"), ("Asthma, adults", "Asthma"), ("Plain", "Plain")]),
        (text.therapeutic_area, [("Lymphoma", "Oncology"), ("Beta-Thalassemia", "Hematology (non-malignant)"), (None, text.AREA_OTHER), ("Crohn's", "Immunology & Inflammation"), ("x", text.AREA_OTHER)]),
        (text.name_key, [("ABC-1 x", "abc1x"), ("日本", ""), (None, "")]),
        (text.core_name, [("Foo® (bar) 12", "foo12")]),
        (text.slug, [("Foo & Bar, Inc.", "foo-bar-inc"), ("--", "")]),
        (text.expected_count, [("the pipeline includes 12 assets, 7 programs", 7), ("999 assets", None), ("none", None), (None, None)]),
        (text.phase_hits, [("Phase 1, phase II and approved", 3), ("", 0), (None, 0)]),
        (text.without_stage_words, [("Locally advanced or metastatic AML", "or aml")]),
        (text.without_possessive, [("Alzheimer's disease", "Alzheimer disease")]),
        (web.url_type, [("http://x/pipeline.xlsx", "xlsx_doc"), ("http://x/data.csv?v=2", "csv_doc"), ("http://x/p.PDF#a", "pdf_doc"), ("http://x/p", None)]),
        (web.url_extension, [("http://x/file.XLSX?q=1#f", ".xlsx"), ("http://x.org/a", "")]),
        (web.company_token, [("The Bristol Squibb", "bristol"), ("X", "x")]),
        (web.plain_html, [("<b>a</b>&amp;b<sup>1</sup>  c", "a &b1 c")]),
        (web.is_press_release, [("(Business Wire) x", True), ("x", False), (None, False)]),
    ],
)
def test_vectors(spark, function, pairs):
    assert values(spark, function, [a for a, _ in pairs]) == [b for _, b in pairs]


def test_statuses_hash_and_clamp(spark):
    df = spark.createDataFrame([("on hold", "Phase 1", None), ("", "Terminated", None), (None, None, "discontinued"), ("active", "x", None)], "s string, p string, c string")
    assert [r[0] for r in df.select(text.development_status(F.col("s"), F.col("p"), F.col("c"))).collect()] == ["paused", "discontinued", "discontinued", "active"]
    h = values(spark, text.content_hash, ["a  b\n", "a b", "a c"])
    assert h[0] == h[1] != h[2]
    assert values(spark, lambda c: text.clamped(c, 4), ["abcd", "abcde"]) == ["abcd", "abc…"]
    assert values(spark, lambda c: F.array_join(text.development_codes(c), ","), ["BMS-986 and cc 1234, CD3"]) == ["BMS986,CC1234"]
    assert values(spark, lambda c: text.embedding_text(c, F.lit(" "), F.lit("x")), ["a", None]) == ["a | x", "x"]


def test_pages_and_links(spark):
    html = '<table><tr><tr><tr><tr></table> <a href="/pipeline.xlsx">x</a> <a href=\'sub/p\'>y</a>'
    df = spark.createDataFrame([(html, "Phase 1 phase 2 filed"), ("<p>", "Phase 1 phase 2 filed"), ("<p>", "x")], "h string, t string")
    kinds = [tuple(r) for r in df.select(web.page_class(F.col("h"), F.col("t"), F.lit(False)), web.page_class(F.col("h"), F.col("t"), F.lit(True))).collect()]
    assert kinds == [("html_table", "html_table"), ("js_cards", "js_cards"), ("pipeline_page", "image_page")]
    urls = df.limit(1).select(F.transform(web.links(F.col("h")), lambda x: web.absolute_url(F.lit("https://a.org/b/c?d"), x))).first()[0]
    assert urls == ["https://a.org/pipeline.xlsx", "https://a.org/b/sub/p"]
    promo = spark.createDataFrame([("https://a.org/pipeline.xlsx", "xlsx_doc"), ("https://a.org/annual.pdf", "pdf_doc")], "u string, t string")
    assert [r[0] for r in promo.select(web.is_promotable(F.col("u"), F.col("t"), F.lit("pipeline_page"))).collect()] == [True, False]


def test_similarities(spark):
    df = spark.createDataFrame([("word", "two words", [1.0, 0.0], [0.0, 2.0]), ("abc", "abc", [1.0, 1.0], [2.0, 2.0])], "a string, b string, x array<double>, y array<double>")
    rows = df.select(F.round(similarity.trigram_similarity(F.col("a"), F.col("b")), 6), F.round(similarity.cosine_distance(F.col("x"), F.col("y")), 6)).collect()
    assert [tuple(r) for r in rows] == [(0.363636, 1.0), (1.0, 0.0)]


def test_markdown_and_hash_material(spark):
    df = spark.createDataFrame([([["a", "b"], [" ", None], ["c"]],), ([[""]],)], "r array<array<string>>")
    assert [r[0] for r in df.select(text.markdown_table(F.col("r"))).collect()] == ["| a | b |\n| --- | --- |\n| c |  |", None]
    parts = spark.createDataFrame([("a b", ["y", "x", None]), ("a  b", ["x", "y"])], "t string, p array<string>")
    first, second = (r[0] for r in parts.select(text.hash_material(F.col("t"), F.col("p"))).collect())
    assert first == second
