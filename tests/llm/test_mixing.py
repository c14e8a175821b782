import random

import numpy as np
import pandas as pd

from sedimenta.llm.mixing import _quotas, drawn, rake, share_report

DOCS = "doc_id long, source string, lang string, topic string, tokens long"
TARGETS = "source string, target_share double, max_repeats int"


def test_raking_meets_sources_and_leans_to_the_marginals():
    rnd = np.random.default_rng(1)
    cells = pd.DataFrame([(s, l, t, float(rnd.integers(100, 5000))) for s in "abc" for l in ("en", "de") for t in ("x", "y", "z")], columns=["source", "lang", "topic", "tokens"])
    raked = rake(cells, {"a": (0.5, 2), "b": (0.3, 1), "c": (0.2, 3), "d": (0.1, 1)})
    made = (raked["uses"] * raked["tokens"]).groupby(raked["source"]).sum()
    assert np.allclose(made / made.sum(), [0.5, 0.3, 0.2], atol=1e-6)
    assert (raked["uses"] <= raked["source"].map({"a": 2, "b": 1, "c": 3}) + 1e-9).all()
    lang = lambda w: (raked[w] * raked["tokens"] if w else raked["tokens"]).groupby(raked["lang"]).sum().pipe(lambda s: s / s.sum())
    assert np.allclose(lang("uses"), lang(None), atol=0.05)
    assert rake(cells.head(0), {"a": (1.0, 1)}).empty
    short = rake(cells, {"a": (0.5, 1), "b": (0.5, 1)}, total=1e9)
    assert np.allclose(short["uses"], 1.0)


def test_drawn_shares_caps_and_ties(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["big"] * 6 + ["mid"] * 3 + ["tiny", "none"]), rnd.choice(["en", "de", None]), rnd.choice(["x", None]), rnd.choice([40, 40, 40, 300, 2000])) for i in range(1500)]
    rows += [(9001, None, "en", "x", 5), (9002, "big", "en", "x", 0), (9003, "big", "en", "x", None)]
    targets = spark.createDataFrame([("big", 0.4, 1), ("mid", 0.35, 2), ("tiny", 0.2, 4), ("absent", 0.05, 2), (None, 0.1, 1)], TARGETS)
    df = spark.createDataFrame(rows, DOCS).withColumnRenamed("nothing", "n")
    corpus = drawn(df, targets)
    got = corpus.collect()
    assert len({r.doc_id for r in got}) == len(got) and not {9001, 9002, 9003} & {r.doc_id for r in got} and {r.source for r in got} == {"big", "mid", "tiny"}
    shares = share_report(corpus, df, targets).collect()
    report = {r.name: r for r in shares if r.margin == "source"}
    for r in shares:
        assert r.margin == "source" or abs(r.actual_share - r.target_share) < 0.03
    for source, share, cap in (("big", 0.4, 1), ("mid", 0.35, 2), ("tiny", 0.2, 4)):
        assert abs(report[source].actual_share - share / 0.95) < 0.01 and report[source].most_copies <= cap
    assert report["absent"].actual_share == 0 and report["absent"].documents == 0
    assert drawn(df.limit(0), targets).count() == 0 and drawn(df, targets.limit(0)).count() == 0


def test_every_cell_ends_within_a_document_of_its_share():
    rnd = np.random.default_rng(7)
    rows = [(s, l, t, int(n), int(k)) for s in "abc" for l in ("en", "de") for t in "xyz" for n, k in zip(rnd.integers(20, 900, 6), rnd.integers(1, 9, 6), strict=True)]
    groups = pd.DataFrame(rows, columns=["source", "lang", "topic", "length", "n"]).groupby(["source", "lang", "topic", "length"], as_index=False)["n"].sum()
    groups["tokens"] = groups["length"] * groups["n"]
    cell = ["source", "lang", "topic"]
    targets = {"a": (0.5, 2), "b": (0.3, 1), "c": (0.2, 3)}
    raked = rake(groups.groupby(cell, as_index=False)["tokens"].sum(), targets)
    plan = _quotas(groups.merge(raked[[*cell, "uses"]], on=cell), targets)
    assert (plan["m"] <= plan["n"] * plan["source"].map({"a": 2, "b": 1, "c": 3})).all() and (plan["m"] >= 0).all()
    made = plan.assign(t=plan["m"] * plan["length"]).groupby(cell, as_index=False).agg(t=("t", "sum"), shortest=("length", "min")).merge(raked, on=cell)
    off = made["t"] - made["uses"] * made["tokens"]
    assert (off.abs() <= 1.5 * made["shortest"] + 1).all()
    assert (off.groupby(made["source"]).sum().abs() <= groups["length"].min()).all()
