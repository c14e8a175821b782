import itertools
import random

import pandas as pd

from sedimenta.llm.subjects import OTHER, Scorer, agreed_labels, bound_of, makeup, mine_rules, patterns, pruned, sentence_items, subject_shares

WORDS = {"law": ["appeal court", "patent claims", "court ruling"], "sport": ["league match", "penalty kick", "relay team"], "sea": ["coral reef", "tidal current", "deep trench"]}
FRAMES = ["The report deals with {a} and {b}.", "What remains is {a}.", "After {n} days {a} was compared with {b}."]
FORMAL = ["Visitors may park on level {n}.", "Details follow in due course.", "The list has {n} entries."]


def document(rnd, parts):
    out = []
    for area, n in parts:
        for _ in range(n):
            a, b = rnd.choice(WORDS[area]), rnd.choice(WORDS[area])
            out.append(rnd.choice(FRAMES).format(a=a, b=b, n=rnd.randrange(99)))
    out += [rnd.choice(FORMAL).format(n=rnd.randrange(99)) for _ in range(3)]
    rnd.shuffle(out)
    return " ".join(out)


def test_rules_recover_the_areas(spark):
    rnd = random.Random(6)
    docs, labels, truth = [], [], {}
    for i in range(240):
        kind = rnd.choice(["one", "one", "one", "two", "none"])
        areas = {"one": rnd.sample(list(WORDS), 1), "two": rnd.sample(list(WORDS), 2), "none": []}[kind]
        text = document(rnd, [(a, 5) for a in areas] + ([(rnd.choice(list(WORDS)), 1)] if kind == "one" else []))
        docs.append((i, text))
        truth[i] = set(areas) or {OTHER}
        if i % 2 == 0:
            said = areas or [OTHER]
            if rnd.random() < 0.05:
                said = [rnd.choice(list(WORDS))]
            labels += [(i, "ann1", a) for a in said] + ([(i, "ann2", a) for a in said] if i % 4 == 0 else [])
    docs += [(900, ""), (901, None), (902, "Visitors may park on level 2. " * 3000), (None, "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    l = spark.createDataFrame(labels, "doc_id long, annotator string, area string")
    shares = subject_shares(d, l)
    got = {}
    for r in shares.collect():
        got.setdefault(r.doc_id, set()).add(r.area)
    held_out = [i for i in truth if i % 2]
    assert sum(got[i] == truth[i] for i in held_out) / len(held_out) >= 0.9
    assert got[900] == got[901] == got[902] == {OTHER} and None not in got
    assert makeup(shares).where("documents > 0").count() >= 3
    nothing = subject_shares(d, l.limit(0))
    assert {r.area for r in nothing.collect()} == {OTHER}
    assert subject_shares(d.limit(0), l).count() == 0 and mine_rules(d.limit(0), l).empty


def test_labels_have_to_agree(spark):
    rows = [(1, "a", "x"), (1, "b", "x"), (2, "a", "x"), (2, "b", "y"), (3, "a", "x"), (3, "a", "y"), (None, "a", "x"), (4, "a", None), (5, None, "x"), (5, None, "x")]
    got = {r.doc_id: r.areas for r in agreed_labels(spark.createDataFrame(rows, "doc_id long, annotator string, area string")).collect()}
    assert got == {1: ["x"], 3: ["x", "y"], 5: ["x"]}


def test_patterns_grow_by_documents_and_no_further_than_allowed():
    rnd = random.Random(2)
    rows = [(rnd.randrange(30), rnd.choice([["x"], ["x"], ["y"], ["x", "y"]]), sorted(rnd.sample("abcdefgh", rnd.randrange(1, 6)))) for _ in range(120)]
    areas = {}
    rows = [(d, areas.setdefault(d, a), b) for d, a, b in rows]
    group = pd.DataFrame([("z", 0.1, d, a, b) for d, a, b in rows], columns=["last", "bound", "doc_id", "areas", "beside"])
    got = {(tuple(i), a): b for i, a, b in patterns(group, 3)}
    for size in (1, 2, 3):
        for items in itertools.combinations("abcdefgh", size):
            docs = {d: a for d, a, b in rows if set(items) <= set(b)}
            ks = {x: sum(x in a for a in docs.values()) for x in "xy"}
            best = max(ks, key=lambda x: (ks[x], x))
            sure = len(docs) >= 3 and bound_of(ks[best], len(docs)) >= 0.5
            assert ((tuple(sorted([*items, "z"])), best) in got) == (sure and size < 3)
    assert len(got) > 20


def test_pruning_and_evidence():
    rules = pruned(pd.DataFrame({"items": [["a"], ["a", "b"], ["c", "d"]], "area": ["x", "x", "y"], "bound": [0.9, 0.9, 0.8]}))
    assert [list(i) for i in rules["items"]] == [["a"], ["c", "d"]]
    scorer = Scorer(rules)
    assert scorer.area({"a", "b"}) == "x" and scorer.area({"c"}) is None and scorer.area({"c", "d"}) == "y"
    assert sentence_items("A b cd. EF<br>gh &amp; ij") == [{"cd"}, {"ef", "gh", "ij", "ef gh", "gh ij"}] and sentence_items(None) == []
    assert sum(len([i for i in x if " " not in i]) for x in sentence_items(" ".join(f"w{a}{b}{c}" for a in "abcde" for b in "abcdef" for c in "abcdef"))) == 180
