import random

from sedimenta.operators.snapshot_diff import snapshot_changes

SCHEMA = "capture_id string, source_id string, captured_at timestamp_ntz, loaded_at timestamp_ntz, asset_id string, phase_code string, partners array<string>"


def found(spark, rows, extra=""):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.withColumn("leaf", df["asset_id"]).withColumn("pair", df["asset_id"]).withColumn("n", df["asset_id"])
    return sorted(map(tuple, snapshot_changes(df).collect()))


def brute(rows):
    current, when = {}, {}
    for c, s, at, loaded, a, p, ps in rows:
        if a is None or not a.strip():
            continue
        when[c] = (s, at)
        p = p.strip().lower() if p and p.strip() else None
        ps = tuple(sorted({x for x in ps or [] if x is not None}))
        key = (loaded is not None, loaded, p or "", ps)
        if (c, a) not in current or key > current[c, a][0]:
            current[c, a] = (key, p, set(ps))
    out = set()
    for s in {w[0] for w in when.values()}:
        order = sorted((at, c) for c, (x, at) in when.items() if x == s)
        for (_, before), (_, after) in zip(order, order[1:]):
            assets = {a for c, a in current if c in (before, after)}
            for a in assets:
                x, y = current.get((before, a)), current.get((after, a))
                if x is None:
                    out.add((after, a, "asset_added"))
                elif y is None:
                    out.add((after, a, "asset_left_pipeline"))
                else:
                    if x[1] != y[1]:
                        out.add((after, a, "asset_phase_changed"))
                    if y[2] - x[2]:
                        out.add((after, a, "partner_added"))
                    if x[2] - y[2]:
                        out.add((after, a, "partner_removed"))
    return sorted(out)


def test_against_brute_force_with_a_source_of_a_third_of_the_rows(spark, day):
    rnd = random.Random(3)
    rows = []
    for c in range(60):
        s = "hot" if c % 3 == 0 else f"s{c % 7}"
        for a in range(rnd.randrange(0, 25)):
            rows.append((f"c{c}", s, day(c), day(c, rnd.randrange(5)), rnd.choice([f"a{a}", f"a{a}", None, " "]), rnd.choice(["P1", "p1 ", "p2", None, " "]), rnd.choice([None, [], ["x"], ["y", "x", "x"], [None, "y"]])))
    rows += rows[::5]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, extra="clashing") == brute(rows)


def test_equal_snapshots_redelivery_and_nothing(spark, day):
    assert found(spark, []) == []
    same = [("c1", "s", day(1), day(1), "a", "P1", ["x", "y"]), ("c2", "s", day(2), day(2), "a", " p1", ["y", "x", "y"])]
    assert found(spark, same) == []
    redelivered = [*same, ("c2", "s", day(2), day(3), "a", "p2", None)]
    assert found(spark, redelivered) == [("c2", "a", "asset_phase_changed"), ("c2", "a", "partner_removed")]
    # A capture without keyed rows doesn't exist: c3 is compared with c1.
    gap = [same[0], ("c2", "s", day(2), day(2), None, "p9", None), ("c3", "s", day(3), None, "b", None, None)]
    assert found(spark, gap) == [("c3", "a", "asset_left_pipeline"), ("c3", "b", "asset_added")]
