import random

from pyspark.sql import functions as F

from sedimenta.operators.history import as_of, build_history, latest_known, merge_batch, program_history

OBS = "observation_id long, program_id string, indication_id string, company_id string, phase string, status string, observed_at timestamp_ntz, recorded_at timestamp_ntz"


def test_blocks_of_a_hot_key_change_nothing(spark, day):
    rnd = random.Random(5)
    rows = [(rnd.choice(["k"] * 5 + ["l", None]), rnd.choice(["a", "b", None]), day(0, h)) for h in range(1200)]
    df = spark.createDataFrame(rows, "k string, a string, at timestamp_ntz")
    runs = {}
    expected = []
    for k, a, at in sorted(rows, key=lambda r: r[2]):
        if k in runs and runs[k][1] == a:
            continue
        if k in runs:
            expected.append((k, runs[k][1], runs[k][0], at))
        runs[k] = (at, a)
    expected += [(k, a, at, None) for k, (at, a) in runs.items()]
    for block in (40, 10**6):
        got = [tuple(r) for r in build_history(df, ["k"], ["a"], "at", rows_per_block=block).collect()]
        assert sorted(got, key=str) == sorted(expected, key=str)


def test_program_history_rules(spark, day):
    rows = [
        (1, "p", "i", "c", "Phase_1 ", "ACTIVE", day(1), day(1)),
        (1, "p", "i", "c", "Phase_1 ", "ACTIVE", day(1), day(1)),
        (2, "p", "i", "c", None, None, day(2), day(2)),
        (3, "p", "i", "c", "phase_1", "active", day(3), day(3)),
        (4, "p", "i", "c", "phase_2", "active", day(4), day(9)),
        (5, "p", "i", "c", "phase_3", "active", day(4), day(5)),
        (6, "p", "i", "c", "phase_2", None, day(6), None),
        (7, "q", None, "c", "filed", "active", day(1), day(1)),
        (8, "q", None, "c", "filed", "active", None, day(1)),
    ]
    got = sorted(map(tuple, program_history(spark.createDataFrame(rows, OBS).withColumn("_blk", F.lit("clash"))).collect()), key=str)
    t = lambda n: day(n).strftime("%Y-%m-%d %H:%M:%S")
    assert got == sorted(
        [
            ("p", "i", "c", "phase_1", "active", t(1), t(4)),
            ("p", "i", "c", "phase_2", "active", t(4), t(6)),
            ("p", "i", "c", "phase_2", None, t(6), ""),
            ("q", None, "c", "filed", "active", t(1), ""),
        ],
        key=str,
    )
    assert program_history(spark.createDataFrame([], OBS)).count() == 0


def test_merge_equals_rebuild_and_reads_as_of(spark, day):
    rnd = random.Random(8)
    rows = [(rnd.choice(["k0", "k1", "k2", "k3", None]), rnd.choice("aab"), day(n)) for n in range(200)] + [("k9", "a", day(1)), ("k9", "b", day(150))]
    df = spark.createDataFrame(rows, "k string, a string, at timestamp_ntz").withColumn("extra", F.lit("x"))
    cut_at = F.lit(day(120)).cast("timestamp_ntz")
    early, later = df.where(F.col("at") < cut_at), df.where(F.col("at") >= cut_at)
    whole = build_history(df, ["k"], ["a"], "at")
    for block in (10, 10**6):
        merged = merge_batch(build_history(early, ["k"], ["a"], "at"), later, early, ["k"], ["a"], "at", rows_per_block=block)
        assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert as_of(whole, F.lit(day(150)).cast("timestamp_ntz")).groupBy("k").count().where("count > 1").count() == 0


def test_late_rows_and_corrections_split_versions(spark, day):
    schema = "k string, a string, at timestamp_ntz"
    earlier = spark.createDataFrame([("p", "a", day(1)), ("p", "a", day(3)), ("p", "a", day(5)), ("q", "a", day(1)), ("r", "a", day(1)), ("r", "b", day(4))], schema)
    batch = spark.createDataFrame([("p", "b", day(2)), ("p", "c", day(5)), ("q", "a", day(2)), ("q", "b", day(7)), ("new", "z", day(9)), ("new", "z", None)], schema)
    got = merge_batch(build_history(earlier, ["k"], ["a"], "at"), batch, earlier, ["k"], ["a"], "at")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [
            ("p", "a", day(1), day(2)), ("p", "b", day(2), day(3)), ("p", "a", day(3), day(5)), ("p", "c", day(5), None),
            ("q", "a", day(1), day(7)), ("q", "b", day(7), None),
            ("r", "a", day(1), day(4)), ("r", "b", day(4), None),
            ("new", "z", day(9), None),
        ],
        key=str,
    )
    none = merge_batch(build_history(earlier, ["k"], ["a"], "at"), batch.limit(0), earlier, ["k"], ["a"], "at")
    assert none.count() == 4 and merge_batch(none.limit(0), batch.limit(0), earlier.limit(0), ["k"], ["a"], "at").count() == 0


def test_latest_known_prefers_late_records(spark, day):
    df = spark.createDataFrame([("k", day(1), None, "x"), ("k", day(1), day(2), "a"), ("k", day(1), day(2), "b")], "k string, at timestamp_ntz, known timestamp_ntz, v string")
    assert [r.v for r in latest_known(df, ["k"], "at", "known", ["v"]).collect()] == ["b"]
