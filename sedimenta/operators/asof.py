"""Attributes as they were valid, and already known, at each event's time.

Entities are hash-partitioned into buckets and an embedded DuckDB joins each
bucket's events to its entities' current state with ASOF LEFT JOIN. The state
is ordered by availability: it changes where a version becomes available (the
later of valid_from and recorded_at) or ends, and from each such time on it is
the winner among the versions then available, so ties and later versions that
were not known yet are resolved before the join, and the join never looks ahead.

A key of any size is cut at time edges into slices. A version that spans whole
slices would be copied into each of them; instead its span is cut into dyadic
nodes, of which only each node's winner is kept.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.ordered import ROWS_PER_BLOCK, hot_blocks

#: Buckets of one shuffle partition; partitions are set to fit the memory of a task, a bucket is a part of one.
BUCKETS_PER_PARTITION = 2
LEVELS = 9  # 2**8 slices at most, as MAX_BLOCKS


def _dyadic(first: Column, last: Column) -> Column:
    """The nodes (level, node) that exactly cover slices ``first`` .. ``last`` - 1."""
    node = lambda level, x: F.struct(level.cast("int").alias("level"), x.cast("int").alias("node"))
    none = F.array().cast("array<struct<level:int,node:int>>")

    def step(acc: Column, level: Column) -> Column:
        a, b, out = acc["a"], acc["b"], acc["out"]
        inside = a < b
        left, right = inside & (a % 2 == 1), inside & (b % 2 == 1)
        a2 = F.when(left, a + 1).otherwise(a)
        b2 = F.when(right, b - 1).otherwise(b)
        out = F.concat(
            out,
            F.when(left, F.array(node(level, a))).otherwise(none),
            F.when(right & (a2 <= b2), F.array(node(level, b2))).otherwise(none),
        )
        return F.struct(
            F.floor(a2 / 2).cast("int").alias("a"), F.floor(b2 / 2).cast("int").alias("b"), out.alias("out")
        )

    start = F.struct(first.cast("int").alias("a"), last.cast("int").alias("b"), none.alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), start, step)["out"]


def _timeline(versions: pd.DataFrame) -> pd.DataFrame:
    """Per group ``g`` the winner's version_id (null: none) from each time ``t`` on."""
    out_g: list[int] = []
    out_t: list[int] = []
    out_v: list[object] = []
    versions = versions.sort_values(["g", "a"], kind="stable")
    for g, rows in versions.groupby("g", sort=False):
        starts, ends = rows["a"].tolist(), rows["e"].tolist()
        ranks = list(zip(rows["vf"].tolist(), rows["ra"].tolist(), rows["version_id"].tolist(), strict=True))
        times = sorted({*starts, *ends})
        heap: list[tuple] = []
        i = 0
        last: object = ()
        for t in times:
            while i < len(starts) and starts[i] <= t:
                vf, ra, vid = ranks[i]
                heapq.heappush(heap, (-vf, -ra, -vid, ends[i]))
                i += 1
            while heap and heap[0][3] <= t:
                heapq.heappop(heap)
            won = -heap[0][2] if heap else None
            if won != last:
                out_g.append(g)
                out_t.append(t)
                out_v.append(won)
                last = won
    return pd.DataFrame({"g": pd.Series(out_g, dtype="int64"), "t": pd.Series(out_t, dtype="int64"), "version_id": pd.array(out_v, dtype="Int64")})


def _join_bucket(rows: pa.Table) -> pa.Table:
    import duckdb

    schema = pa.schema([("event_id", pa.int64()), ("version_id", pa.int64())])
    is_event = rows["event_id"].is_valid()
    events, versions = rows.filter(is_event), rows.filter(pc.invert(is_event))
    if events.num_rows == 0 or versions.num_rows == 0:
        return schema.empty_table()
    keys = ["k1", "k2", "k3", "slice"]
    v = versions.select([*keys, "version_id", "vf", "ra", "e", "a"]).to_pandas()
    e = events.select([*keys, "event_id", "at"]).to_pandas()
    groups = v[keys].drop_duplicates().reset_index(drop=True)
    groups["g"] = range(len(groups))
    v = v.merge(groups, on=keys)
    e = e.merge(groups, on=keys)
    if e.empty:
        return schema.empty_table()
    state = _timeline(v)  # noqa: F841 (DuckDB reads it by name)
    wanted = e[["g", "event_id", "at"]]  # noqa: F841
    con = duckdb.connect(":memory:", config={"threads": 1})
    try:
        con.register("wanted", wanted)
        con.register("state", state)
        got = con.sql(
            "SELECT w.event_id, s.version_id FROM wanted w ASOF LEFT JOIN state s ON w.g = s.g AND w.at >= s.t"
            " WHERE s.version_id IS NOT NULL"
        ).to_arrow_table()
    finally:
        con.close()
    return got.cast(schema)


def known_at_event(
    events: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    rows_per_slice: int = ROWS_PER_BLOCK,
    buckets: int | None = None,
) -> DataFrame:
    """event_id, version_id: the version of each event's key that was valid and known at event_at.

    ``events`` has event_id, event_at and the three ``keys``; ``versions`` has
    version_id, valid_from, valid_to, recorded_at and the keys. Among versions
    with valid_from <= event_at, valid_to null or later and recorded_at <=
    event_at the one with the greatest valid_from, then recorded_at, then
    version_id wins. Events without one, rows with a null key, event time,
    valid_from, recorded_at or id, and versions that end before they become
    available give no row. Repeated rows count once.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    key = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys, 1)]
    full = lambda *cs: [F.col(c).isNotNull() for c in (*keys, *cs)]

    def where_all(df: DataFrame, conditions: list[Column]) -> DataFrame:
        for c in conditions:
            df = df.where(c)
        return df

    ev = where_all(events, full("event_id", "event_at")).select(*key, F.col("event_id").cast("long").alias("event_id"), micros("event_at").alias("at")).distinct()
    vs = (
        where_all(versions, full("version_id", "valid_from", "recorded_at"))
        .select(
            *key,
            F.col("version_id").cast("long").alias("version_id"),
            micros("valid_from").alias("vf"),
            micros("recorded_at").alias("ra"),
            F.coalesce(micros("valid_to"), F.lit(2**62)).alias("e"),
        )
        .withColumn("a", F.greatest("vf", "ra"))
        .where(F.col("e") > F.col("a"))
        .distinct()
    )
    ks = ["k1", "k2", "k3"]
    none = F.lit(None).cast("long")
    marks = ev.select(*ks, "at", F.lit(True).alias("is_event"), "event_id", *[none.alias(c) for c in ("version_id", "vf", "ra", "e", "a")]).unionByName(
        vs.select(*ks, F.col("a").alias("at"), F.lit(False).alias("is_event"), none.alias("event_id"), "version_id", "vf", "ra", "e", "a")
    )
    # The slice of an event's time and of a version's start; the end's slice needs the same edges.
    edges = hot_blocks(marks, ks, "at", rows_per_slice)
    cut = marks.join(F.broadcast(edges), [F.col(k) == F.col(f"_hot_{k}") for k in ks], "left")
    number = lambda c: F.when(F.col("_edges").isNull(), F.lit(0)).otherwise(
        F.size(F.filter(F.col("_edges"), lambda x: x <= F.col(c)))
    )
    cut = cut.withColumn("slice", number("at")).withColumn(
        "last", F.when(F.col("e") == 2**62, F.coalesce(F.size("_edges"), F.lit(0))).otherwise(number("e"))
    )
    evs = cut.where("is_event").select(*ks, "slice", "event_id", "at")
    spans = cut.where(~F.col("is_event"))
    cols = ["version_id", "vf", "ra", "e", "a"]
    begin = spans.select(*ks, "slice", *cols)
    end = spans.where(F.col("last") > F.col("slice")).select(*ks, F.col("last").alias("slice"), *cols)
    winners = (
        spans.where(F.col("last") > F.col("slice") + 1)
        .select(*ks, F.explode(_dyadic(F.col("slice") + 1, F.col("last"))).alias("d"), F.struct("vf", "ra", "version_id", "e", "a").alias("v"))
        .groupBy(*ks, "d")
        .agg(F.max("v").alias("v"))
        .select(*ks, F.explode(F.expr("sequence(d.node * shiftleft(1, d.level), (d.node + 1) * shiftleft(1, d.level) - 1)")).alias("slice"), "v")
        .groupBy(*ks, "slice")
        .agg(F.max("v").alias("v"))
        .select(*ks, "slice", *[F.col(f"v.{c}").alias(c) for c in cols])
    )
    placed = begin.unionByName(end).unionByName(winners).withColumn("event_id", none).withColumn("at", none)
    rows = placed.unionByName(evs, allowMissingColumns=True)
    # Buckets hold whole (key, slice) groups, so that no more Python groups are made than needed.
    n = buckets or BUCKETS_PER_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.withColumn("bucket", F.pmod(F.xxhash64(*ks, "slice"), F.lit(n)).cast("int"))
        .groupBy("bucket")
        .applyInArrow(_join_bucket, "event_id long, version_id long")
    )


def event_versions(events: DataFrame, versions: DataFrame, born: DataFrame) -> DataFrame:
    """Problem 3: :func:`known_at_event` for events of programs already born.

    The earliest non-null born_on of the event's program has to be at or before
    event_at; programs without one give no rows.
    """
    first = born.where(F.col("born_on").isNotNull()).groupBy("program_id").agg(F.min("born_on").alias("_born"))
    alive = (
        events.select("event_id", "program_id", "indication_id", "company_id", "event_at")
        .join(first, "program_id")
        .where(F.col("_born") <= F.col("event_at"))
        .drop("_born")
    )
    return known_at_event(alive, versions, ["program_id", "indication_id", "company_id"])
