"""Structured Streaming forms: skipping unchanged pages, windows, and changes between snapshots."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sedimenta.functions.text import content_hash


def changed_pages(pages: DataFrame, delay: str = "30 days") -> DataFrame:
    """Pages whose content wasn't seen for their source within ``delay``; pages have source_id, fetched_at, text."""
    hashed = pages.withColumn("content_hash", content_hash(F.col("text"))).withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    return hashed.withWatermark("fetched_at", delay).dropDuplicatesWithinWatermark(["source_id", "content_hash"])


def windowed_counts(events: DataFrame, size: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """window_start, event_type, n, total per tumbling window; events have ts, event_type, value."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    counted = timed.groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


_CHANGES = "source_id string, captured_at timestamp, asset_id string, change_type string"


def _against_state(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    known = json.loads(state.get[0]) if state.exists else None
    rows = pd.concat(list(batches)).sort_values("captured_at", kind="stable")
    out = []
    for at, capture in rows.groupby("captured_at", sort=True):
        current = {a: [p if isinstance(p, str) else None, sorted(set(ps if ps is not None else []))] for a, p, ps in zip(capture["asset_id"], capture["phase_code"], capture["partners"], strict=True)}
        if known is not None:
            out += [(key[0], at, a, "asset_added") for a in current.keys() - known.keys()]
            out += [(key[0], at, a, "asset_left_pipeline") for a in known.keys() - current.keys()]
            for a in current.keys() & known.keys():
                if current[a][0] != known[a][0]:
                    out.append((key[0], at, a, "asset_phase_changed"))
                if set(current[a][1]) - set(known[a][1]):
                    out.append((key[0], at, a, "partner_added"))
                if set(known[a][1]) - set(current[a][1]):
                    out.append((key[0], at, a, "partner_removed"))
        known = current
    state.update((json.dumps(known),))
    yield pd.DataFrame(out, columns=["source_id", "captured_at", "asset_id", "change_type"])


def snapshot_changes_stream(captures: DataFrame) -> DataFrame:
    """Changes of each source's captures against its last one, which is the state.

    ``captures`` has source_id, captured_at, asset_id, phase_code and partners.
    All rows of one capture have to come in one micro-batch, and captures in
    order; a late capture needs the batch operator.
    """
    rows = captures.select("source_id", F.col("captured_at").cast("timestamp").alias("captured_at"), "asset_id", F.lower(F.trim("phase_code")).alias("phase_code"), "partners")
    return rows.groupBy("source_id").applyInPandasWithState(_against_state, _CHANGES, "last string", "append", GroupStateTimeout.NoTimeout)
