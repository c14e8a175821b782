import random

import pytest

from sedimenta.operators.asof import event_versions, known_at_event

EV = "event_id long, program_id string, indication_id string, company_id string, event_at timestamp_ntz"
VS = "version_id long, program_id string, indication_id string, company_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, recorded_at timestamp_ntz"
KEYS = ["program_id", "indication_id", "company_id"]


def brute(events, versions):
    out = set()
    for e in events:
        if e[4] is None:
            continue
        fit = [(v[4], v[6], v[0]) for v in versions if v[1:4] == e[1:4] and v[4] <= e[4] and (v[5] is None or v[5] > e[4]) and v[6] <= e[4]]
        if fit:
            out.add((e[0], max(fit)[2]))
    return sorted(out)


@pytest.mark.parametrize("rows_per_slice", [20, 10**6])
def test_against_brute_force_with_a_hot_key(spark, day, rows_per_slice):
    rnd = random.Random(5)
    keys = [("a", "x", "c")] * 6 + [("b", "x", "c"), ("b", "y", "c")]
    events = [(i, *rnd.choice(keys), day(0, rnd.randrange(2000))) for i in range(500)]
    versions = []
    for i in range(400):
        start = rnd.randrange(2000)
        versions.append((i, *rnd.choice(keys), day(0, start), None if rnd.random() < 0.3 else day(0, start + rnd.choice([0, 1, 20, 300, 1500])), day(0, start + rnd.choice([0, 0, 5, 400]))))
    expected = brute(events, versions)
    got = known_at_event(spark.createDataFrame(events + events[:50], EV), spark.createDataFrame(versions + versions[:50], VS), KEYS, rows_per_slice=rows_per_slice, buckets=7)
    assert sorted(map(tuple, got.collect())) == expected


def test_ties_late_versions_and_birth(spark, day):
    versions = [
        (1, "p", "i", "c", day(1), None, day(1)),
        (2, "p", "i", "c", day(1), None, day(1)),
        (3, "p", "i", "c", day(3), None, day(10)),
        (4, "q", "i", "c", day(1), day(5), day(1)),
        (5, None, "i", "c", day(1), None, day(1)),
    ]
    events = [(1, "p", "i", "c", day(5)), (2, "p", "i", "c", day(10)), (3, "q", "i", "c", day(5)), (4, "q", "i", "c", day(4)), (5, "p", "i", "c", None), (6, None, "i", "c", day(4)), (7, "p", "i", "c", day(1))]
    born = [("p", None), ("p", day(2)), ("p", day(5)), ("q", None)]
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    got = event_versions(df(events, EV), df(versions, VS), df(born, "program_id string, born_on timestamp_ntz"))
    assert sorted(map(tuple, got.collect())) == [(1, 2), (2, 3)]
    assert event_versions(df([], EV), df(versions, VS), df(born, "program_id string, born_on timestamp_ntz")).count() == 0
    assert event_versions(df(events, EV), df([], VS), df(born, "program_id string, born_on timestamp_ntz")).count() == 0
