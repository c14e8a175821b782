import pytest

from sedimenta.llm.edits import typing_distance
from sedimenta.llm.minhash import MinHash, banding, bands_for, collision, edit_similarity, qgrams
from sedimenta.llm.names import ACCEPT, asset_forms, asset_similarity, banding_recall, candidate_pairs, name_clusters, organisation_form, organisation_similarity, variant_pairs
from sedimenta.llm.star import star_clusters

SCHEMA = "expected_id long, preferred_name string, synonyms array<string>, partners array<struct<name:string,role:string,territory:string>>"


def test_typing_distance():
    assert typing_distance("abc", "abc") == 0 and typing_distance("abcd", "abdc") == 1 and typing_distance("abc", "abbc") == 1
    assert typing_distance("cat", "cst") == 1 and typing_distance("cat", "cpt") == 2 and typing_distance("", "ab") == 2
    assert typing_distance("kitten", "sitting", 2.0) > 2


def test_bands_reach_their_recall():
    s = edit_similarity(11, 3, 4)
    bands = bands_for(s, 0.99, 3)
    assert collision(s, bands, 3) >= 0.99 > collision(s, bands - 1, 3)
    hasher = MinHash(bands, 3, 3)
    words = [f"{a}{b}{c}holt" for a in ("bafe", "kito", "romu", "zepi") for b in ("lan", "gor", "vek") for c in ("di", "pu", "sa")]
    met = [bool(set(hasher.keys(w)) & set(hasher.keys(w[:4] + w[5] + w[4] + w[6:]))) for w in words]
    assert sum(met) / len(met) >= 0.9
    assert qgrams("ab", 3) == {"\x02\x02a", "\x02ab", "ab\x03", "b\x03\x03"}


def test_banding_follows_the_collision_curve_of_a_length():
    for n in range(5, 20):
        s = edit_similarity(n, 2, 3)
        bands, rows = banding(s, 0.99, 40)
        assert collision(s, bands, rows) >= 0.99 and bands <= 40 and bands_for(s, 0.99, rows + 1) > 40


def test_banding_recall_counts_near_tokens(spark):
    rows = [(1, "zimofarotinib", ["zimofaortinib", "dalemucetol", "dalemucetoll"], [("Zolaremi Tekabor Labs", None, None), ("Zolraemi Tekabor Labs", None, None), (None, None, None)]), (2, None, None, None)]
    got = banding_recall(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.kind, r.length): r.pairs for r in got} == {("asset", 13): 1, ("asset", 12): 1, ("partner", 8): 1} and all(0 <= r.met <= r.pairs for r in got)
    assert banding_recall(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(
    "variant",
    ["ZOLAREMI TEKABOR BIOSCIENCES", "Zolaremi &amp; Tekabor Biosciences", "Tekabor, Zolaremi (Biosci.)", "Zolaremi-Tekabor Bioscience, Inc.", "Zolarémi T. Biosciences", "Zolaremi", "Zolraemi Tekabor Biosciences*", "ZTB / Zolaremi Tekabor", "Zolaremi Biosci.", "Zolaremitekabor Biosciences"],
)
def test_variants_of_an_organisation(variant):
    form = organisation_form("Zolaremi Tekabor Biosciences")
    other = organisation_form(variant)
    assert other == form or organisation_similarity(form, other) >= 0.8


@pytest.mark.parametrize("other", ["Zolaremi Gadofar Biosciences", "Zolaremi Tekabor Oncology", "Kanumesi Tekabor Biosciences", "Zolaremi G. Biosciences"])
def test_likeness_alone_is_no_match(other):
    assert organisation_similarity(organisation_form("Zolaremi Tekabor Biosciences"), organisation_form(other)) < 0.8


def test_persons_and_placeholders():
    assert organisation_form("Institute of Betty Gorovan") == organisation_form("Elizabeth Gorovan Inst.")
    assert organisation_similarity(organisation_form("E. Gorovan Institute"), organisation_form("Elizabeth Gorovan Institute")) >= 0.8
    assert organisation_similarity(organisation_form("Robert Gorovan Institute"), organisation_form("Elizabeth Gorovan Institute")) == 0
    assert [organisation_form(x) for x in (None, "", " ", "n/a", "Partner TBD", "-", "multiple partners")] == [None] * 7


def test_asset_forms():
    assert asset_forms("abc–123*") == asset_forms("ABC 123") == asset_forms("ABC-123 (XYZ1 inhibitor)") == ["d|abc123"]
    assert asset_forms("FOOBAR® (zimotinib sodium)") == ["w|foobar", "w|zimotinib"]
    assert asset_forms("zimotinib + kolurmab") == asset_forms("Kolurmab plus zimotinib") == ["m|kolurmab zimotinib"]
    assert asset_forms("n/a") == asset_forms(None) == []
    assert asset_similarity("w|zimofarotinib", "w|zimofaortinib") > 0.8
    assert asset_similarity("d|abc123", "d|abc124") == 0 and asset_similarity("w|zimotinib", "m|kolurmab zimotinib") == 0


def test_clusters_and_pairs(spark):
    rows = [
        (1, "ABC-123", ["zimofarotinib"], [("Zolaremi Tekabor Biosciences", None, None), ("n/a", None, None)]),
        (1, "ABC-123", ["zimofarotinib"], [("Zolaremi Tekabor Biosciences", None, None), ("n/a", None, None)]),
        (2, "abc 123", [], [("Tekabor Zolaremi Biosci.", None, None), (None, None, None)]),
        (3, "zimofaortinib tosylate", None, None),
        (4, "ABC-124", ["zimofarotinib + kolurmabex"], []),
        (5, "kolurmabex plus zimofarotinib", ["zimofarotinib + kolurmabex"], []),
        (6, None, [None, "TBD"], []),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("expected_id", "kind")
    got = {tuple(r) for r in variant_pairs(name_clusters(df)).collect()}
    assert ("asset", "ABC-123", "zimofarotinib") in got and ("asset", "ABC-123", "zimofaortinib tosylate") in got and ("asset", "ABC-123", "abc 123") in got
    assert ("asset", "kolurmabex plus zimofarotinib", "zimofarotinib + kolurmabex") in got
    assert ("partner", "Tekabor Zolaremi Biosci.", "Zolaremi Tekabor Biosciences") in got
    assert not any({"ABC-123", "ABC-124"} <= set(p[1:]) or "TBD" in p or "n/a" in p for p in got)
    assert variant_pairs(name_clusters(spark.createDataFrame([], SCHEMA))).count() == 0


def test_stars_follow_the_greedy_pass(spark):
    import random

    rnd = random.Random(4)
    edges = {tuple(sorted(rnd.sample(range(60), 2))): round(rnd.random(), 3) for _ in range(90)}
    near = {}
    for (a, b), s in edges.items():
        near.setdefault(a, {})[b] = s
        near.setdefault(b, {})[a] = s
    order = sorted(near, key=lambda n: (len(near[n]), n), reverse=True)
    centers = []
    for n in order:
        if not any(c in near[n] for c in centers):
            centers.append(n)
    expected = {n: n if n in centers else max((near[n][c], len(near[c]), c) for c in centers if c in near[n])[2] for n in near}
    e = spark.createDataFrame([(a, b, s) for (a, b), s in edges.items()], "a long, b long, sim double")
    p = spark.createDataFrame([(n, (len(near[n]), n)) for n in near], "node long, prio struct<degree:int,id:long>")
    assert {r.node: r.center for r in star_clusters(e, p).collect()} == expected
    assert star_clusters(e.limit(0), p).count() == 0


def missed(spark, kind, forms, similarity):
    """Pairs that the verification accepts and that are no candidates, and how many it accepts."""
    forms = sorted(set(forms))
    df = spark.createDataFrame([(kind, f) for f in forms], "kind string, form string")
    met = {(r.a, r.b) for r in candidate_pairs(df, kind).collect()}
    true = {(a, b) for i, a in enumerate(forms) for b in forms[i + 1 :] if similarity(a, b) >= ACCEPT}
    return true - met, len(true)


def test_a_crowded_token_loses_no_pair(spark):
    tails = [a + b + c for a in ("novam", "bexor", "tiluk", "garod", "pimez", "sufan") for b in ("ed", "il", "or") for c in ("an", "ux", "ip", "eth", "yl", "ok", "um", "ars", "int", "ob", "eg", "olf", "ax")]
    names = [f"Kestrel {t}" for t in tails] + ["Kestrel", "Kestrle Ltd", "Kestrel Inc", "N. Kestrel", "B. Kesterl", "Kestrel P.", "Kestrelnovamedan"]
    names += [f"Kestrel {t[:3]}{t[4]}{t[3]}{t[5:]}" for t in tails[::9]] + [f"Keestrel {t}" for t in tails[::11]] + [f"Catherine {t}" for t in tails[::20]] + [f"C. {t}" for t in tails[::20]]
    lost, n = missed(spark, "partner", [organisation_form(x) for x in names], organisation_similarity)
    assert n > 800 and not lost


def test_a_slip_in_a_token_of_any_length_is_met(spark):
    words = [(a + b + c)[:n] for n in (4, 5, 6, 7, 8, 9, 11, 13) for a in ("baf", "kit", "rom", "zep") for b in ("eloni", "uvari", "ocade") for c in ("dimur", "pusel")]
    names = words + [w[:1] + w[2] + w[1] + w[3:] for w in words] + [w[:-2] + w[-1] + w[-2] for w in words] + [w[0] + w[2:] for w in words]
    names += [w[:1] + w[2] + w[1] + w[3:-2] + w[-1] + w[-2] for w in words if len(w) >= 8]
    lost, n = missed(spark, "partner", [f for x in names if (f := organisation_form(x))], organisation_similarity)
    assert n > 200 and not lost
    lost, n = missed(spark, "asset", ["w|" + x for x in names], asset_similarity)
    assert n > 100 and not lost


def test_reordered_assets_and_given_names_meet(spark):
    lost, n = missed(spark, "asset", ["w|zimofarotinib dalemucetol", "w|dalemucetol zimofarotinib", "w|dalemucetol zimofaortinib"], asset_similarity)
    assert n == 3 and not lost
    names = ["Martha Therapeutics Inc.", "Martha Therapeutics", "Henry James Institute", "Henry James Inst. Ltd", "Henry J. Institute", "Martha Oncology", "Martha", "Matthew Therapeutics"]
    lost, n = missed(spark, "partner", [organisation_form(x) for x in names], organisation_similarity)
    assert n == 2 and not lost
