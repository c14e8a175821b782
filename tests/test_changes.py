import random

import pytest

from sedimenta.operators.changes import change_feed, guarded_captures

SCHEMA = "group string, capture_id string, captured_at timestamp_ntz, period string, asset_id string, name string, phase_code string, partners array<string>"
BACKGROUND = [(f"bg{i}", "phase_2", []) for i in range(8)]


def frame(spark, day, captures, group="g", background=True):
    rows = []
    for n, assets in enumerate(captures):
        for a, phase, partners in [*assets, *(BACKGROUND if background else [])]:
            rows.append((group, f"c{n:03d}", day(90 * n), f"Q{n}", a, a.upper(), phase, partners))
    return spark.createDataFrame(rows, SCHEMA)


def events(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in change_feed(df).collect()), key=str)


def test_baseline_addition_and_advance(spark, day):
    df = frame(spark, day, [[("a", "phase_1", [])], [("a", "phase_2", []), ("b", None, [])]])
    assert events(df, "type", "asset_id", "from_phase", "to_phase", "direction", "eff_min", "eff_max") == [
        ("asset_added", "b", None, None, None, None, day(90)),
        ("asset_phase_changed", "a", "Phase 1", "Phase 2", "advance", day(0), day(90)),
    ]


def test_exit_is_confirmed_at_the_second_absence_and_dated_to_the_first(spark, day):
    df = frame(spark, day, [[("a", "phase_3", [])], [], []])
    assert events(df, "type", "asset_id", "period", "eff_min", "eff_max", "status", "exit_class") == [
        ("asset_left_pipeline", "a", "Q1", day(0), day(90), "confirmed", "late_stage_exit_ambiguous")
    ]
    provisional = frame(spark, day, [[("a", "filed", [])], []])
    assert events(provisional, "type", "status", "exit_class") == [("asset_left_pipeline", "provisional", "likely_approved_graduated")]


def test_collapse_is_set_aside_and_empty_history_of_absence_is_kept(spark, day):
    df = frame(spark, day, [[("a", "phase_1", [])], [("a", "phase_1", [])]]).unionByName(
        spark.createDataFrame([("g", "c002", day(180), "Q2", "a", "A", "phase_1", None)], SCHEMA)
    )
    assert events(df, "type") == []
    assert [r.accepted for r in guarded_captures(df).orderBy("captured_at").collect()] == [True, True, False]


def test_reappearance_suppresses_differences(spark, day):
    df = frame(spark, day, [[("a", "phase_1", ["x"])], [], [], [("a", "phase_2", ["y"])]])
    assert [e[0] for e in events(df, "type")] == ["asset_left_pipeline", "asset_reappeared"]


def test_interrupted_absence_null_phase_and_partners(spark, day):
    df = frame(spark, day, [[("a", None, ["x", "y"])], [], [("a", "phase_1", ["y", "z", "w"])]])
    assert events(df, "type", "partner", "direction", "from_phase") == sorted(
        [("asset_phase_changed", None, "advance", None), ("partner_added", "w", None, None), ("partner_added", "z", None, None), ("partner_removed", "x", None, None)], key=str
    )


@pytest.mark.parametrize("seed", range(3))
def test_random_grids_against_the_definition(spark, day, seed):
    """Kinds, assets and periods of the events, asset by asset, from the places at which it was seen."""
    rnd = random.Random(seed)
    df, expected = None, []
    for g in range(4):
        captures = [[(f"a{i}", rnd.choice([None, "phase_1", "phase_2", "filed"]), rnd.choice([[], ["x"], ["x", "y"]])) for i in range(12) if rnd.random() < rnd.choice([0.2, 0.8])] for _ in range(14)]
        part = frame(spark, day, captures, group=f"g{g}", background=False)
        df = part if df is None else df.unionByName(part)
        kept = [n for n, ok in sorted((int(r.capture_id[1:]), r.accepted) for r in guarded_captures(part).collect()) if ok]
        for asset in {a for n in kept for a, *_ in captures[n]}:
            rows = [(place, n, next(r for r in captures[n] if r[0] == asset)) for place, n in enumerate(kept) if asset in {a for a, *_ in captures[n]}]
            for (was, _, old), (now, n, new) in zip([(None, None, None), *rows], rows, strict=False):
                if was is None:
                    expected += [(f"g{g}", "asset_added", asset, f"Q{n}")] if now else []
                elif now - was > 2:
                    expected.append((f"g{g}", "asset_reappeared", asset, f"Q{n}"))
                else:
                    expected += [(f"g{g}", "asset_phase_changed", asset, f"Q{n}")] if new[1] not in (None, old[1]) else []
                    expected += [(f"g{g}", "partner_added", asset, f"Q{n}") for _ in set(new[2]) - set(old[2])]
                    expected += [(f"g{g}", "partner_removed", asset, f"Q{n}") for _ in set(old[2]) - set(new[2])]
            ends = [r[0] for r in rows[1:]] + [None]
            expected += [(f"g{g}", "asset_left_pipeline", asset, f"Q{kept[p + 1]}") for (p, *_), after in zip(rows, ends, strict=True) if (after - p > 2 if after is not None else p < len(kept) - 1)]
    assert events(df, "group", "type", "asset_id", "period") == sorted(expected, key=str) and len(expected) > 50
