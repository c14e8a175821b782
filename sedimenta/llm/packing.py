"""Items packed into containers of fixed capacity.

Harmonic packing: lengths fall into reciprocal-capacity classes, and each
container of a class takes a fixed number of its documents, so workers fill
containers independently from a document's rank in its class. Plain classes
(length in (C/(j+1), C/j], j to a container) leave up to half of a container of
long documents empty. So the classes are refined down to single lengths, of
which there are at most C whatever the number of documents, and a container's
pattern, planned best-fit on the counts per length, is a fixed number of
documents from one or several classes. The plan's size depends on the
capacities alone; documents are placed by arithmetic on their rank.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.ranks import with_rank
from sedimenta.session import cut

#: Capacities are planned on the driver: their number and sum are checked.
MAX_CAPACITIES = 100
MAX_CAPACITY_SUM = 2_000_000


def harmonic_bins(counts: dict[int, int], capacity: int) -> int:
    """Containers that plain harmonic classes take: ceil(documents / j) in each class j."""
    classes: dict[int, int] = {}
    for size, n in counts.items():
        classes[capacity // size] = classes.get(capacity // size, 0) + n
    return sum(-(-n // j) for j, n in classes.items())


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Segments (size, first rank, documents, per container, first container) and the number of containers.

    Lengths are taken from the longest; those of one length go, as many to each
    as fit, into the containers with the least room that still fit one, then
    into new ones. Containers of equal room are handled as one range.
    """
    segments: list[tuple[int, int, int, int, int]] = []
    rooms: list[tuple[int, int, int]] = []  # (room, first container, containers), sorted
    bins = 0
    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        while left:
            at = bisect_left(rooms, (size, 0, 0))
            if at < len(rooms):
                room, first, n = rooms.pop(at)
            else:
                room, first = capacity, bins
                n = -(-left // (capacity // size))
                bins += n
            per = room // size
            full = min(n, left // per)
            if full:
                segments.append((size, rank, full * per, per, first))
                rank, left = rank + full * per, left - full * per
                if room - per * size:
                    insort(rooms, (room - per * size, first, full))
            if full < n:
                rest = n - full
                if left:  # fewer than fit one more container
                    segments.append((size, rank, left, left, first + full))
                    if room - left * size:
                        insort(rooms, (room - left * size, first + full, 1))
                    rank, left, rest = rank + left, 0, rest - 1
                if rest:
                    insort(rooms, (room, first + n - rest, rest))
    return segments, bins


def read_capacities(capacities: DataFrame) -> dict[int, int]:
    rows = capacities.where((F.col("capacity_tokens") > 0) & F.col("capacity_id").isNotNull()).select("capacity_id", "capacity_tokens").distinct().limit(MAX_CAPACITIES + 1).collect()
    found = {r["capacity_id"]: r["capacity_tokens"] for r in rows}
    if len(rows) > MAX_CAPACITIES or sum(found.values()) > MAX_CAPACITY_SUM:
        raise ValueError("too many or too large capacities to plan on the driver")
    return found


def pieces(sizes: DataFrame, capacities: dict[int, int]) -> DataFrame:
    """capacity_id, doc_id, part, size: what has to be packed for each capacity.

    A document longer than the capacity is split into full parts and a rest;
    others are one part. Documents without tokens have one part of size 0.
    """
    caps = F.array(*[F.struct(F.lit(i).cast("int").alias("capacity_id"), F.lit(c).cast("long").alias("cap")) for i, c in sorted(capacities.items())])
    each = sizes.select("doc_id", "tokens", F.explode(caps).alias("c")).select("doc_id", "tokens", "c.capacity_id", "c.cap")
    parts = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / F.col("cap"))))
    return each.withColumn("part", F.explode(parts)).select(
        "capacity_id", "doc_id", F.col("part").cast("int").alias("part"), F.least(F.col("cap"), F.col("tokens") - F.col("part") * F.col("cap")).alias("size")
    )


def _plans(parts: DataFrame, capacities: dict[int, int]) -> tuple[dict[int, dict[int, int]], dict[int, tuple[list, int]]]:
    counts: dict[int, dict[int, int]] = {i: {} for i in capacities}
    # At most one row a capacity and length: bounded by the sum of the capacities.
    for r in parts.where(F.col("size") > 0).groupBy("capacity_id", "size").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["capacity_id"]][r["size"]] = r["n"]
    return counts, {i: plan(counts[i], c) for i, c in capacities.items()}


def packed(sizes: DataFrame, capacities: DataFrame) -> DataFrame:
    """capacity_id, container, doc_id, part, tokens: where every part of every document goes.

    ``sizes`` has doc_id (unique) and tokens; ``capacities`` capacity_id and
    capacity_tokens. No document is split unless it alone exceeds the capacity.
    Documents without tokens take no room and are spread over the containers
    (container 0 if there is none). Rows without doc_id or tokens, and
    capacities that aren't positive, are left out.
    """
    caps = read_capacities(capacities)
    spark = sizes.sparkSession
    result = "capacity_id int, container long, doc_id long, part int, tokens long"
    if not caps:
        return spark.createDataFrame([], result)
    parts = cut(pieces(sizes.where(F.col("doc_id").isNotNull() & F.col("tokens").isNotNull()), caps))
    _, plans = _plans(parts, caps)
    ranked = with_rank(parts.where(F.col("size") > 0), ["capacity_id", "size"], [], ["doc_id", "part"])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts: dict[tuple[int, int], list] = {}
        for i, (segments, _) in plans.items():
            for size, rank, _n, per, first in segments:
                starts.setdefault((i, size), []).append((rank, per, first))
        for batch in batches:
            out = []
            for i, doc, part, size, rank in zip(*(batch[c] for c in ("capacity_id", "doc_id", "part", "size", "rank")), strict=True):
                segments = starts[i, size]
                at, per, first = segments[bisect_left(segments, (rank + 1,)) - 1]
                out.append((i, first + (rank - at) // per, doc, part, size))
            yield pd.DataFrame(out, columns=["capacity_id", "container", "doc_id", "part", "tokens"])

    filled = ranked.select("capacity_id", "doc_id", "part", "size", "rank").mapInPandas(place, result)
    bins = F.create_map(*[F.lit(x) for i, (_, n) in plans.items() for x in (i, max(1, n))])
    empty = parts.where(F.col("size") == 0).select(
        "capacity_id", F.pmod(F.xxhash64("doc_id"), bins[F.col("capacity_id")]).cast("long").alias("container"), "doc_id", "part", F.col("size").alias("tokens")
    )
    return filled.unionByName(empty)


def room_report(sizes: DataFrame, capacities: DataFrame) -> DataFrame:
    """capacity_id, capacity_tokens, containers, unused_share, least_containers, harmonic_containers.

    ``least_containers`` is the bound no packing can beat (all tokens over the
    capacity), ``harmonic_containers`` what plain reciprocal classes take.
    """
    caps = read_capacities(capacities)
    counts, plans = _plans(pieces(sizes.where(F.col("doc_id").isNotNull() & F.col("tokens").isNotNull()), caps), caps) if caps else ({}, {})
    rows = []
    for i, c in sorted(caps.items()):
        total = sum(s * n for s, n in counts[i].items())
        bins = plans[i][1]
        rows.append((i, c, bins, 1 - total / (bins * c) if bins else 0.0, -(-total // c), harmonic_bins(counts[i], c)))
    return sizes.sparkSession.createDataFrame(
        rows, "capacity_id int, capacity_tokens int, containers long, unused_share double, least_containers long, harmonic_containers long"
    )
