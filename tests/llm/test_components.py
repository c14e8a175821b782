import random

from sedimenta.llm.components import alias_groups, components, mapped, smallest_labels

ALIAS = "alias_row_id long, canonical string, members array<string>"
PAIR = "pair_id long, left_id long, right_id long, status string"


def union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_against_union_find(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5000, 5000 + i) for i in range(40)] + [(7, 7), (9999, 9999)]
    expected = union_find({x for e in edges for x in e}, edges)
    df = spark.createDataFrame([(a, b) for a, b in edges] + [(None, 1), (2, None)], "a long, b long")
    got = {r.node: r.group for r in smallest_labels(components(df)).collect()}
    assert got == expected
    named = spark.createDataFrame([(f"n{a:05d}", f"n{b:05d}") for a, b in edges], "a string, b string")
    assert {int(r.node[1:]): int(r.group[1:]) for r in smallest_labels(components(named)).collect()} == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hot_values_are_mapped_apart(spark):
    df = spark.createDataFrame([(1, i) for i in range(300)] + [(i, 0) for i in range(2, 30)], "k long, v long")
    keys = spark.createDataFrame([(i, i * 10) for i in range(40)], "k long, w long")
    plain = sorted(map(tuple, df.join(keys, "k").collect()))
    assert sorted(map(tuple, mapped(df, "k", keys, "w", hot_rows=50).select("k", "v", "w").collect())) == plain


def test_alias_groups_rules(spark):
    rows = [
        (1, "a", ["b", None, "b"]), (2, "b", None), (2, "c", []), (3, "C", ["c "]), (4, None, None), (5, "", []), (6, "", ["x"]), (7, "q", ["q"]), (8, "c", None), (8, "c", None), (None, "a", ["q"]),
    ]
    pairs = [(1, 3, 7, "accepted"), (2, 7, 3, "rejected"), (3, 4, 99, "accepted"), (4, 99, 3, "accepted"), (5, 4, None, "accepted"), (6, 4, 4, "accepted"), (7, 1, 4, "pending")]
    groups = lambda a, p: sorted(map(tuple, alias_groups(spark.createDataFrame(a, ALIAS), spark.createDataFrame(p, PAIR)).collect()))
    assert groups(rows, pairs) == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 5), (7, 3), (8, 1)]
    assert groups([], []) == [] and groups(rows[:1], []) == [(1, 1)]
