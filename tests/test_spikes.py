import numpy as np
from pyspark.sql import functions as F

from sedimenta.operators.spikes import _medians, deviation, implausible_readings, residual, stuck, with_seasons

SCHEMA = "stat_id long, source_id string, captured_at timestamp_ntz, assets int, trail_median double"


def flags(spark, day, series, trail=None, source="s", **more):
    rows = [(i, source, day(7 * i), v, (trail or {}).get(i, None if v is None else 100.0)) for i, v in enumerate(series)]
    df = spark.createDataFrame(rows + rows[:3], SCHEMA).withColumnRenamed("nothing", "x")
    return sorted((r.stat_id, r.field) for r in implausible_readings(df, **more).collect())


def noisy(n, level=100, seed=1):
    return [int(x) for x in level + np.random.default_rng(seed).integers(-3, 4, n)]


def test_medians_residual_and_scatter():
    x = np.random.default_rng(0).normal(size=400)
    for k in (3, 5, 7):
        naive = [np.median(x[max(0, i - k) : i]) if i else np.nan for i in range(len(x) + 1)]
        assert np.allclose(_medians(x, k), naive, equal_nan=True)
    near = [np.median(np.r_[x[max(0, i - 3) : i], x[i + 1 : i + 4]]) for i in range(len(x))]
    assert np.allclose(residual(x), x - near)
    assert deviation(np.random.default_rng(2).normal(size=20_000)).max() < 6
    assert len(deviation(np.array([]))) == 0 and list(stuck(np.array([1.0] * 7))) == [False] + [True] * 6


def test_spikes_but_no_lasting_change(spark, day):
    s = noisy(60)
    s[10], s[30], s[31], s[45] = 10, 400, 380, 135
    assert flags(spark, day, s) == [(10, "assets"), (30, "assets"), (31, "assets"), (45, "assets")]
    level = noisy(30) + noisy(30, 160, 2)
    assert flags(spark, day, level) == []
    end = noisy(30) + [10]
    assert flags(spark, day, end) == []


def test_stuck_only_where_readings_vary(spark, day):
    s = noisy(60)
    s[20:30] = [101] * 10
    s[19], s[30] = 99, 98
    assert flags(spark, day, s) == [(i, "assets") for i in range(21, 30)]
    quiet = [100] * 30 + [101] * 20
    assert flags(spark, day, quiet) == []


def test_impossible_values_nulls_and_ends(spark, day):
    s = noisy(40)
    s[5], s[6], s[7] = -1, None, 2**31 - 1
    assert flags(spark, day, s, {9: 99.3, 12: -1.0, 14: float("nan"), 15: None}) == [(5, "assets"), (7, "assets"), (9, "trail_median"), (12, "trail_median"), (14, "trail_median")]
    assert flags(spark, day, []) == []
    assert flags(spark, day, [5]) == [] and flags(spark, day, [None, None]) == []


def test_blocks_of_a_hot_source_change_nothing(spark, day):
    rng = np.random.default_rng(4)
    s = noisy(900, seed=9)
    for i in rng.choice(900, 40, replace=False):
        s[i] = int(rng.choice([0, 300, 7]))
    s[200:212] = [100] * 12
    whole = flags(spark, day, s)
    assert len(whole) > 30
    assert flags(spark, day, s, rows_per_block=120) == whole


def test_the_fitted_tail_decides(spark, day):
    s = noisy(60)
    s[10], s[30], s[45] = 10, 400, 125
    at = lambda risk: {i for i, _ in flags(spark, day, s, risk=risk)}
    assert at(1e-2) == {10, 30, 45} and at(1e-9) == {10, 30} and at(1e-99) == set()


def test_a_season_is_no_spike_of_its_own(spark, day):
    rows = [("s", i, i % 12 + 1, 2020 + i // 12, 9.0 if i % 12 == 6 else (-1.0) ** i) for i in range(60)] + [("s", 99, 7, 2025, None)]
    df = spark.createDataFrame(rows, "source_id string, stat_id long, season int, year int, a_res double").withColumn("t_res", F.lit(None).cast("double"))
    got = {r.stat_id: r.a_season for r in with_seasons(df).collect()}
    assert got[6] == got[99] == 9.0 * 5 / 13 and abs(got[7]) < 1 and len(got) == 61
    one = with_seasons(df.where("year = 2020")).collect()
    assert {r.a_season for r in one} == {0.0}


def test_a_reading_between_spikes_needs_no_tail_cutoff(spark, day):
    s = noisy(60)
    for i in (5, 12, 40, 47, 54):  # a heavy tail: its cutoff lies far above the exact distance
        s[i] = 300
    s[26:29] = [180, 118, 180]
    assert flags(spark, day, s) == [(i, "assets") for i in (5, 12, 26, 27, 28, 40, 47, 54)]


def test_a_long_freeze_does_not_hide_itself(spark, day):
    assert flags(spark, day, [100, 103] + [98] * 8 + [101, 97]) == [(i, "assets") for i in range(3, 10)]
    s = noisy(60)
    s[10:50] = [101] * 40
    s[9], s[50] = 99, 98
    assert flags(spark, day, s) == [(i, "assets") for i in range(11, 50)]
    quiet = [100] * 12 + [101] + [100] * 9 + [101] + [100] * 20 + [102] + [100] * 9
    assert flags(spark, day, quiet) == []
