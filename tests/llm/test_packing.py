import random
from collections import defaultdict

from pyspark.sql import functions as F

from sedimenta.llm import tokens
from sedimenta.llm.packing import harmonic_bins, packed, plan, room_report
from sedimenta.llm.ranks import with_rank

SIZES = "doc_id long, tokens long"
CAPS = "capacity_id int, capacity_tokens int"


def test_plan_fills_within_capacity_and_close_to_the_bound():
    rnd = random.Random(1)
    for capacity in (10, 64, 512):
        counts = {s: rnd.randrange(1, 50) for s in rnd.sample(range(1, capacity + 1), min(capacity, 40))}
        segments, bins = plan(counts, capacity)
        room = defaultdict(int)
        placed = defaultdict(int)
        for size, rank, n, per, first in segments:
            assert rank == placed[size]
            placed[size] += n
            for i in range(n):
                room[first + i // per] += size
        assert placed == counts and max(room.values()) <= capacity and set(room) == set(range(bins))
        least = -(-sum(s * n for s, n in counts.items()) // capacity)
        assert bins <= 11 * least / 9 + 1 and bins <= harmonic_bins(counts, capacity)


def test_packed_documents(spark):
    rnd = random.Random(2)
    sizes = [(i, rnd.choice([3, 7, 7, 7, 7, 30, 64])) for i in range(400)] + [(1000, 0), (1001, 200), (1002, None), (None, 5)]
    caps = spark.createDataFrame([(1, 64), (2, 16), (2, 16), (3, 0), (None, 9)], CAPS)
    df = spark.createDataFrame(sizes, SIZES).withColumn("capacity_id", F.lit("clash"))
    rows = packed(df, caps).collect()
    whole, fill = defaultdict(list), defaultdict(int)
    for r in rows:
        whole[r.capacity_id, r.doc_id].append((r.part, r.tokens))
        fill[r.capacity_id, r.container] += r.tokens
    for cap, c in ((1, 64), (2, 16)):
        assert max(v for (i, _), v in fill.items() if i == cap) <= c
        for doc, n in sizes:
            if doc is None or n is None:
                continue
            parts = sorted(whole[cap, doc])
            assert sum(t for _, t in parts) == n and [p for p, _ in parts] == list(range(len(parts))) and len(parts) == max(1, -(-n // c))
    report = {r.capacity_id: r for r in room_report(df, caps).collect()}
    assert set(report) == {1, 2} and all(r.containers >= r.least_containers for r in report.values())
    assert packed(df.limit(0), caps).count() == 0 and packed(df, caps.limit(0)).count() == 0 and room_report(df, caps.limit(0)).count() == 0


def test_ranks_of_a_hot_group(spark):
    rows = [("h", i % 3, i) for i in range(500)] + [("s", 1, 900)]
    got = with_rank(spark.createDataFrame(rows, "g string, o int, id long"), ["g"], ["o"], ["id"]).collect()
    hot = sorted((r["rank"], r.o) for r in got if r.g == "h")
    assert [a for a, _ in hot] == list(range(500)) and [b for _, b in hot] == sorted(b for _, b in hot)


def test_token_counts(spark):
    assert tokens.count_tokens(None) == tokens.count_tokens("") == 0
    text = "The quick brown fox, naïve café 12345 \n\n don't  stop! " * 40 + "x" * 3000
    whole = tokens.count_tokens(text)
    before = tokens.PIECE
    try:
        tokens.PIECE = 500
        assert abs(tokens.count_tokens(text) - whole) <= 8  # only the one word longer than a piece is cut
        plain_text = "The quick brown fox jumps over it. " * 60
        tokens.PIECE = 10**6
        n = tokens.count_tokens(plain_text)
        tokens.PIECE = 37
        assert tokens.count_tokens(plain_text) == n
    finally:
        tokens.PIECE = before
    from tokenizers import Tokenizer

    other = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    assert len(other.encode(text, add_special_tokens=False).ids) == whole
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, tokens.with_token_counts(df, "doc_id long").collect())) == [(1, 2), (2, 0)]
