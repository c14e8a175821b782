"""Type-two histories: build from observations, merge a batch, read as of a time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.text import stripped
from sedimenta.operators.ordered import ROWS_PER_BLOCK, neighbour, with_blocks
from sedimenta.session import cut


def latest_known(observations: DataFrame, keys: Sequence[str], at: str, known_at: str, attributes: Sequence[str]) -> DataFrame:
    """One row per key and ``at``: the attributes with the latest ``known_at``.

    A null ``known_at`` counts as earliest; equal ones are settled by the
    greatest attributes. Aggregates before the shuffle.
    """
    return (
        observations.groupBy(*keys, at)
        .agg(F.max(F.struct(F.col(known_at).alias("_k"), *attributes)).alias("_s"))
        .select(*keys, at, *[F.col("_s")[a].alias(a) for a in attributes])
    )


def build_history(
    observations: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    at: str,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Versions of ``attributes`` per key: keys, attributes, valid_from, valid_to (null while open).

    The state of the row before is the current version: where the hash of the
    attributes differs from it, that version is closed at this row's time and
    a new one opened. Null equals null. One row per key and ``at`` is expected
    (:func:`latest_known`); rows without ``at`` are left out. Keys compare
    null-safe. A key with very many rows is worked on in blocks.
    """
    state = F.xxhash64(*attributes)
    rows = with_blocks(observations.where(F.col(at).isNotNull()), keys, at, rows_per_block)
    rows = neighbour(rows, keys, [at], F.struct(state.alias("h"), *attributes), "_prev")
    same = (F.col("_prev.h") == state)
    for a in attributes:
        same = same & F.col("_prev")[a].eqNullSafe(F.col(a))
    opened = rows.where(F.col("_prev").isNull() | ~same).drop("_prev")
    opened = neighbour(opened, keys, [at], F.col(at), "valid_to", following=True)
    return opened.select(*keys, *attributes, F.col(at).alias("valid_from"), "valid_to")


def merge_batch(
    current: DataFrame, batch: DataFrame, earlier: DataFrame, keys: Sequence[str], attributes: Sequence[str], at: str, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Merge a delivery of observations into a history of :func:`build_history`'s form.

    ``earlier`` are the observations ``current`` was made of; all three have one
    row per key and time at most. Keys that the batch doesn't hold pass through,
    and so do closed versions. Where the batch is later than all that was known
    of a key, its open version is compared by hash with what the batch says,
    closed where that changed, and new versions are inserted. A batch row at or
    before a key's last known observation splits or corrects a version: it takes
    the place of the observation of its time, and the versions of that key alone
    are made anew. Rows without ``at`` are left out. Keys compare null-safe.
    """
    batch = batch.where(F.col(at).isNotNull()).select(*keys, *attributes, at)
    same_key = [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]
    plain = lambda df, *more: df.select(*keys, *attributes, *more)
    last = earlier.where(F.col(at).isNotNull()).groupBy(*_named(keys)).agg(F.max(at).alias("_last"))
    touched = (
        batch.groupBy(*keys).agg(F.min(at).alias("_first")).join(last, same_key, "left")
        .select(*_named(keys), F.coalesce(F.col("_first") <= F.col("_last"), F.lit(False)).alias("_late"))
    )
    touched = cut(touched)  # a row per key of the batch
    held = cut(current.join(touched, same_key, "left"))
    kept = held.where(F.col("_late").isNull() | (~F.col("_late") & F.col("valid_to").isNotNull()))
    opened = held.where(~F.col("_late") & F.col("valid_to").isNull())
    late = touched.where("_late").drop("_late")
    there = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in [*keys, at]]
    replaced = batch.join(late, same_key, "left_semi").select(*[F.col(k).alias(f"_b_{k}") for k in [*keys, at]])
    before = earlier.where(F.col(at).isNotNull()).join(late, same_key, "left_semi").join(replaced, there, "left_anti")
    rows = cut(plain(opened, F.col("valid_from").alias(at)).unionByName(plain(before, at)).unionByName(batch))  # of the touched keys only
    return plain(kept, "valid_from", "valid_to").unionByName(build_history(rows, keys, attributes, at, rows_per_block))


def _named(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).alias(f"_t_{k}") for k in keys]


def as_of(history: DataFrame, at: Column) -> DataFrame:
    """Versions open at ``at``: valid_from <= at < valid_to, an open end counting as later."""
    return history.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


KEYS = ["program_id", "indication_id", "company_id"]
ATTRIBUTES = ["phase", "status"]
#: What was recorded in so many days before the last record is the delivery merged into the history before it.
DELIVERY_DAYS = 90


def program_states(observations: DataFrame) -> DataFrame:
    """Observations with a phase and a time, phase and status in lower case without blanks around them."""
    clean = lambda c: F.lower(stripped(F.col(c))).alias(c)
    rows = observations.where(F.col("phase").isNotNull() & F.col("observed_at").isNotNull())
    return rows.select(*KEYS, clean("phase"), clean("status"), "observed_at", "recorded_at")


def merged_history(states: DataFrame, until: Sequence[object]) -> DataFrame:
    """Versions of :func:`program_states`, delivered in parts recorded up to each time of ``until``, and the rest."""
    part = lambda rows: latest_known(rows, KEYS, "observed_at", "recorded_at", ATTRIBUTES)
    known = lambda t: F.col("recorded_at").isNull() | (F.col("recorded_at") <= F.lit(t).cast("timestamp_ntz"))
    ends = [known(t) for t in until] + [F.lit(True)]
    history = build_history(part(states.where(ends[0])), KEYS, ATTRIBUTES, "observed_at")
    for before, end in zip(ends, ends[1:], strict=False):
        earlier, batch = part(states.where(before)), cut(part(states.where(end & ~before)))
        history = merge_batch(history, batch, earlier, KEYS, ATTRIBUTES, "observed_at")
    return history


def program_history(observations: DataFrame, delivery_days: int = DELIVERY_DAYS) -> DataFrame:
    """Problem 4's history of phase and status, with times as text.

    The last delivery (``delivery_days`` of recorded_at) is merged into the
    history of what was recorded before. Observations with a null phase are left
    out first; per key and observed_at the latest recorded_at counts. Phase and
    status are lower-cased and stripped. A null observed_at is left out, a null
    status is a value of its own; repeated rows and other columns have no
    effect; an empty table gives no rows.
    """
    states = program_states(observations)
    last = states.agg(F.max("recorded_at")).first()[0]
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return merged_history(states, [last - timedelta(days=delivery_days)] if last else []).select(
        *KEYS, *ATTRIBUTES, text("valid_from").alias("valid_from"), F.coalesce(text("valid_to"), F.lit("")).alias("valid_to")
    )
