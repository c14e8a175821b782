"""Implausible readings in series of measurements, judged per source.

Three rules over readings in order of time:

* peaks over threshold: the tail of a source's seasonal residuals (against the
  local level and the usual residual of the calendar month) is a generalised
  Pareto law above a threshold; its quantile at RISK is the source's cutoff.
  Readings beyond it are candidates, and of these the ones stand that lie away
  from the level before and after by MIN_SCATTERS times the source's scatter and
  by MIN_STEP, the level returning within MAX_RUN readings.
* stuck duration: all but the first of more than MAX_STUCK identical readings,
  in a source whose readings ordinarily vary.
* plausibility: values that such a measurement can't have.

A source of any size is cut into time blocks whose edges overlap by HALO rows,
enough for every rule, so that no source is collected into one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.operators.ordered import ROWS_PER_BLOCK, with_blocks
from sedimenta.session import cut

#: Chance of an ordinary reading to lie beyond its source's cutoff.
RISK = 1e-2
#: The threshold of the tail and the quantiles it is fitted by: half and three quarters of what exceeds it.
TAIL = (0.6, 0.8, 0.9)
#: A source's own tail counts as much as that of all sources when so many readings exceed its threshold.
POOLED_EXCEEDANCES = 200
#: Readings of a returning run this many scatters away are what is looked for and don't shape the tail.
TAIL_SCATTERS = 4.0
#: A month's usual residual counts half at so many readings; it has to be seen in two years.
SEASON_READINGS = 8
MIN_SCATTERS = 6.0
MIN_STEP = 5.0
MAX_RUN = 4
MAX_STUCK = 5
HALO = 32
LEVELS = (3, 7, 11)
#: A reading between two spikes is one itself from this part of the exact distance on.
BETWEEN = 5 / 6
#: Scatter of a residual against the median of six neighbours, in scatters of a reading.
RESIDUAL_SCATTER = 1.12
#: A source ordinarily varies if at least this share of its readings differ from the one before.
VARYING = 0.45
#: A source that long freezes keep below that varies if, with each freeze counted as one reading, at
#: least MIN_LOOSE readings for each freeze are left, LOOSE of them differ from the one before, and
#: there are LOOSE_PER_FREEZE for each freeze or LOOSE_VALUES of them are different values. (Quiet
#: sources blink between a few values and have several long runs.)
MIN_LOOSE = 4
LOOSE = 0.7
LOOSE_PER_FREEZE = 8
LOOSE_VALUES = 0.6
#: 32-bit sentinel for "no value".
INT_MAX = 2**31 - 1

_FEATURES = (
    "source_id string, stat_id long, season int, year int, a_res double, a_dev double, a_side double, a_bad boolean, a_stuck boolean, "
    "pairs int, changes int, freezes int, loose double, t_res double, t_dev double, t_side double, t_bad boolean"
)


def _medians(x: np.ndarray, k: int) -> np.ndarray:
    """Median of the up to k values before each position 0..n; NaN where there are none."""
    padded = np.concatenate([np.full(k, np.nan), x])
    windows = np.lib.stride_tricks.sliding_window_view(padded, k)
    ordered = np.sort(windows, axis=1)  # NaN goes last
    count = np.minimum(np.arange(len(x) + 1), k)
    rows = np.arange(len(x) + 1)
    mid = (ordered[rows, np.maximum(count - 1, 0) // 2] + ordered[rows, count // 2]) / 2
    return np.where(count > 0, mid, np.nan)


def deviation(x: np.ndarray) -> np.ndarray:
    """How far each reading lies from the level around it, 0 where the old level doesn't return.

    The largest distance d such that the reading belongs to a run of at most
    MAX_RUN readings that all keep d from the level before and after the run,
    while these two levels differ by at most d / 2. A level is a median of the
    3, 7 or 11 readings next to the run; two of the three have to say d, so
    neither other spikes nor a lasting change close by are taken for the level.
    """
    n = len(x)
    best = np.zeros(n)
    levels = []
    for k in LEVELS:
        before = _medians(x, k)  # before[s]: level ahead of a run that starts at s
        before[:2] = np.nan
        levels.append((before, _medians(x[::-1], k)[::-1]))  # after[e + 1]: level behind a run that ends at e
    for length in range(1, min(MAX_RUN, n) + 1):
        starts = np.arange(n - length + 1)
        run = np.lib.stride_tricks.sliding_window_view(x, length)
        said = []
        for before, after in levels:
            p, q = before[starts], after[starts + length]
            dev = np.minimum(np.abs(run - p[:, None]), np.abs(run - q[:, None])).min(axis=1)
            said.append(np.where(np.isfinite(dev) & (np.abs(p - q) <= dev / 2), dev, 0.0))
        dev = np.median(said, axis=0)
        for j in range(length):
            best[j : j + len(dev)] = np.maximum(best[j : j + len(dev)], dev)
    return best


def sides(dev: np.ndarray) -> np.ndarray:
    """The smaller deviation of a reading's two neighbours."""
    padded = np.concatenate([[0.0], dev, [0.0]])
    return np.minimum(padded[:-2], padded[2:])


def residual(x: np.ndarray) -> np.ndarray:
    """Each reading less the median of up to three readings on either side."""
    k = 3
    n = len(x)
    if not n:
        return np.zeros(0)
    padded = np.concatenate([np.full(k, np.nan), x, np.full(k, np.nan)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * k + 1)
    around = np.sort(np.delete(windows, k, axis=1), axis=1)
    count = np.isfinite(around).sum(axis=1)
    rows = np.arange(n)
    low = around[rows, np.maximum(count - 1, 0) // 2]
    high = around[rows, np.minimum(count // 2, 2 * k - 1)]
    return np.where(count > 0, x - (low + high) / 2, np.nan)


def stuck(x: np.ndarray) -> np.ndarray:
    """True for all but the first of more than MAX_STUCK identical values in a row."""
    if not len(x):
        return np.zeros(0, bool)
    same = np.concatenate([[False], x[1:] == x[:-1]])
    run = np.cumsum(~same) - 1
    return same & (np.bincount(run)[run] > MAX_STUCK)


def _spread(values: np.ndarray, where: np.ndarray, fill: float | bool) -> np.ndarray:
    out = np.full(len(where), fill)
    out[where] = values
    return out


def _one_series(rows: pd.DataFrame) -> pd.DataFrame:
    a = rows["assets"].to_numpy(float)
    t = rows["trail_median"].to_numpy(float)
    a_bad = ~np.isnan(a) & ((a < 0) | (a >= INT_MAX))
    t_bad = rows["t_nan"].to_numpy(bool) | (
        ~np.isnan(t) & ((t < 0) | (t >= INT_MAX) | ((np.abs(t) < 2**52) & (np.mod(2 * t, 1) != 0)))
    )
    a_ok, t_ok = ~np.isnan(a) & ~a_bad, ~np.isnan(t) & ~t_bad
    a_in = ~np.isnan(a)
    differs = np.concatenate([[False], a[a_in][1:] != a[a_in][:-1]]) if a_in.any() else np.zeros(0, bool)
    has_prev = np.arange(int(a_in.sum())) > 0
    a_dev, t_dev = deviation(a[a_ok]), deviation(t[t_ok])
    a_stuck = _spread(stuck(a[a_in]), a_in, False)
    frozen = a_stuck[a_in]
    begins = frozen & ~np.concatenate([[False], frozen[:-1]])
    out = pd.DataFrame(
        {
            "source_id": rows["source_id"],
            "stat_id": rows["stat_id"],
            "season": rows["season"],
            "year": rows["year"],
            "a_res": _spread(residual(a[a_ok]), a_ok, np.nan),
            "a_dev": _spread(a_dev, a_ok, 0.0),
            "a_side": _spread(sides(a_dev), a_ok, 0.0),
            "a_bad": a_bad,
            "a_stuck": a_stuck,
            "pairs": _spread(has_prev, a_in, False).astype("int32"),
            "changes": _spread(differs, a_in, False).astype("int32"),
            "freezes": _spread(begins, a_in, False).astype("int32"),
            "loose": np.where(a_stuck, np.nan, a),
            "t_res": _spread(residual(t[t_ok]), t_ok, np.nan),
            "t_dev": _spread(t_dev, t_ok, 0.0),
            "t_side": _spread(sides(t_dev), t_ok, 0.0),
            "t_bad": t_bad,
        }
    )
    return out[rows["core"].to_numpy(bool)]


def _series(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole (source, block) series out of sorted batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        key = list(zip(batch["source_id"], batch["_blk"], strict=True))
        if held:
            last = (held[-1]["source_id"].iloc[-1], held[-1]["_blk"].iloc[-1])
            same = next((i for i, k in enumerate(key) if k != last), len(key))
            held.append(batch.iloc[:same])
            if same == len(key):
                continue
            yield _one_series(pd.concat(held, ignore_index=True))
            batch, key, held = batch.iloc[same:], key[same:], []
        starts = [i for i in range(len(key)) if i == 0 or key[i] != key[i - 1]]
        done = [_one_series(batch.iloc[s:e].reset_index(drop=True)) for s, e in zip(starts, starts[1:], strict=False)]
        if done:
            yield pd.concat(done, ignore_index=True)
        held = [batch.iloc[starts[-1] :]]
    if held:
        yield _one_series(pd.concat(held, ignore_index=True))


def reading_features(stats: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Residual, deviation, stuck and plausibility of every reading; see the module's text."""
    rows = (
        stats.where(F.col("source_id").isNotNull() & F.col("stat_id").isNotNull())
        .select(
            "source_id",
            F.col("stat_id").cast("long").alias("stat_id"),
            "captured_at",
            F.col("assets").cast("long").alias("assets"),
            F.col("trail_median").cast("double").alias("trail_median"),
        )
        .distinct()
        .withColumn("t_nan", F.coalesce(F.isnan("trail_median"), F.lit(False)))
        .withColumn("season", F.coalesce(F.month("captured_at"), F.lit(0)))
        .withColumn("year", F.coalesce(F.year("captured_at"), F.lit(0)))
    )
    order = [F.col("captured_at").asc_nulls_first(), F.col("stat_id")]
    rows = with_blocks(rows, ["source_id"], "captured_at", rows_per_block, hot="_hot")
    block = Window.partitionBy("source_id", "_blk")
    edged = (
        rows.where("_hot")
        .withColumn("_up", F.row_number().over(block.orderBy(*order)))
        .withColumn("_down", F.row_number().over(block.orderBy(F.col("captured_at").desc_nulls_last(), F.desc("stat_id"))))
    )
    to = lambda blk, core: F.struct(blk.cast("int").alias("b"), F.lit(core).alias("c"))
    places = F.array_compact(
        F.array(
            to(F.col("_blk"), True),
            F.when((F.col("_up") <= HALO) & (F.col("_blk") > 0), to(F.col("_blk") - 1, False)),
            F.when(F.col("_down") <= HALO, to(F.col("_blk") + 1, False)),
        )
    )
    cols = ["source_id", "stat_id", "captured_at", "assets", "trail_median", "t_nan", "season", "year"]
    placed = (
        edged.select(*cols, F.explode(places).alias("p"))
        .select(*cols, F.col("p.b").alias("_blk"), F.col("p.c").alias("core"))
        .unionByName(rows.where(~F.col("_hot")).select(*cols, "_blk", F.lit(True).alias("core")))
    )
    return (
        placed.repartition("source_id", "_blk")
        .sortWithinPartitions("source_id", "_blk", *order)
        .mapInPandas(_series, _FEATURES)
    )


def with_seasons(features: DataFrame) -> DataFrame:
    """``features`` with a_season and t_season, the usual residual of the reading's source in its calendar month.

    A median, shrunk where the month has few readings and 0 where it was seen in
    one year only, so that a lone spike isn't taken for a season.
    """

    def usual(f: str) -> Column:
        n = F.count(f"{f}_res")
        return F.when(F.countDistinct("year") > 1, F.coalesce(F.percentile_approx(f"{f}_res", 0.5, 1000), F.lit(0.0)) * n / (n + SEASON_READINGS)).otherwise(0.0).alias(f"{f}_season")

    real = features.select("source_id", "season", "year", *[F.nanvl(f"{f}_res", F.lit(None).cast("double")).alias(f"{f}_res") for f in "at"])
    months = real.groupBy("source_id", "season").agg(usual("a"), usual("t"))
    return features.join(months, ["source_id", "season"])


def _cutoff(u: Column, mid: Column, top: Column, risk: float) -> Column:
    """The quantile at ``risk`` of the generalised Pareto tail above ``u`` through two of its quantiles.

    The lightest tail is the exponential one: with a bounded tail no reading
    would be too far out for a small risk.
    """
    ratio = (top - mid) / (mid - u)
    shape = F.when((mid > u) & (top > mid), F.greatest(F.lit(0.0), F.least(F.lit(0.5), F.log2(ratio)))).otherwise(0.0)
    flat = F.abs(shape) < 1e-3
    beyond = risk / (1 - TAIL[0])
    scale = F.when(flat, (mid - u) / np.log(2)).otherwise(shape * (mid - u) / (F.pow(F.lit(2.0), shape) - 1))
    reach = F.when(flat, F.lit(float(-np.log(beyond)))).otherwise((F.pow(F.lit(beyond), -shape) - 1) / shape)
    return u + scale * reach


def source_cutoffs(features: DataFrame, risk: float = RISK) -> DataFrame:
    """Per source: whether it varies, and scatter and peaks-over-threshold cutoff of both fields.

    A year of weekly readings says little about a tail. Residuals are therefore
    measured in scatters of their source, one tail is fitted to those of all
    sources, and a source's own tail counts beside it the more the more readings
    exceed its threshold (half at POOLED_EXCEEDANCES).
    """
    real = lambda c: F.nanvl(c, F.lit(None).cast("double"))
    per = features.groupBy("source_id").agg(
        F.percentile_approx(F.abs(real("a_res")), 0.5, 1000).alias("am"),
        F.percentile_approx(F.abs(real("t_res")), 0.5, 1000).alias("tm"),
        F.sum("pairs").alias("pairs"),
        F.sum("changes").alias("changes"),
        F.sum("freezes").alias("freezes"),
        F.count_if("a_stuck").alias("stuck"),
        F.approx_count_distinct(real("loose"), 0.02).alias("values"),
    )
    loose = F.col("pairs") - F.col("stuck")
    enough = (loose >= LOOSE_PER_FREEZE * F.col("freezes")) | (F.col("values") >= LOOSE_VALUES * loose)
    varies = (F.col("changes") >= VARYING * F.col("pairs")) | ((loose >= MIN_LOOSE * F.greatest(F.lit(1), F.col("freezes"))) & (F.col("changes") >= LOOSE * loose) & enough)
    scatter = lambda m: F.coalesce(1.4826 / RESIDUAL_SCATTER * F.col(m), F.lit(0.0))
    judged = per.select("source_id", varies.alias("varies"), scatter("am").alias("a_scatter"), scatter("tm").alias("t_own"))
    scaled = features.join(judged, "source_id")

    def size(f: str, unit: str) -> Column:
        """A seasonal residual in scatters; null where the source has none or the reading doesn't count."""
        counts = (F.col(unit) > 0) & ~F.col(f"{f}_bad") & (F.col(f"{f}_dev") < TAIL_SCATTERS * F.col(unit))
        return F.when(counts, F.abs(real(F.col(f"{f}_res") - F.col(f"{f}_season"))) / F.col(unit))

    sizes = scaled.select("source_id", size("a", "a_scatter").alias("a"), size("t", "t_own").alias("t"))
    tail = lambda f: F.percentile_approx(f, list(TAIL), 10_000)
    pooled = sizes.agg(tail("a"), tail("t")).first()
    own = sizes.groupBy("source_id").agg(*[x for f in "at" for x in (tail(f).alias(f"{f}q"), F.count(f).alias(f"{f}n"))])

    def cutoff(f: str, unit: str, row: int) -> Column:
        weight = F.col(f"{f}n") * (1 - TAIL[0]) / (F.col(f"{f}n") * (1 - TAIL[0]) + POOLED_EXCEEDANCES)
        mixed = [weight * F.col(f"{f}q")[i] + (1 - weight) * F.lit(q) for i, q in enumerate(pooled[row] or [0.0] * len(TAIL))]
        return F.coalesce(F.col(unit) * _cutoff(*mixed, risk), F.lit(0.0))

    return judged.join(own, "source_id").select(
        F.col("source_id").alias("_source"),
        "varies",
        "a_scatter",
        F.greatest("a_scatter", "t_own").alias("t_scatter"),
        cutoff("a", "a_scatter", 0).alias("a_cutoff"),
        cutoff("t", "t_own", 1).alias("t_cutoff"),
    )


def implausible_readings(stats: DataFrame, rows_per_block: int = ROWS_PER_BLOCK, risk: float = RISK) -> DataFrame:
    """stat_id, field ('assets' or 'trail_median') of the readings that can't be right.

    ``stats`` has stat_id, source_id, captured_at, assets and trail_median;
    other columns are ignored and repeated rows count once. Null readings are
    never flagged and don't interrupt a series; impossible values (negative, a
    32-bit sentinel, not a number, a median that isn't a multiple of a half)
    are flagged and left out of the levels. Rows without stat_id or source_id
    are left out; rows without captured_at come first; equal times follow
    stat_id. An empty table gives no rows. A smaller ``risk`` gives fewer spikes.
    """
    features = with_seasons(cut(reading_features(stats, rows_per_block)))
    wanted = features.where(
        F.col("a_bad") | F.col("t_bad") | F.col("a_stuck") | (F.col("a_dev") >= MIN_STEP) | (F.col("t_dev") >= MIN_STEP)
    )
    judged = wanted.join(source_cutoffs(features, risk), F.col("source_id") == F.col("_source"))

    def spike(f: str) -> Column:
        exact = F.greatest(F.lit(MIN_STEP), MIN_SCATTERS * F.col(f"{f}_scatter"))
        dev = F.col(f"{f}_dev")
        between = (F.col(f"{f}_side") >= exact) & (dev >= F.greatest(F.lit(MIN_STEP), BETWEEN * exact))
        beyond = dev - F.abs(f"{f}_season") >= F.col(f"{f}_cutoff")
        return beyond & ((dev >= exact) | between)

    fields = F.array_compact(
        F.array(
            F.when(F.col("a_bad") | spike("a") | (F.col("a_stuck") & F.col("varies")), F.lit("assets")),
            F.when(F.col("t_bad") | spike("t"), F.lit("trail_median")),
        )
    )
    return judged.select("stat_id", F.explode(fields).alias("field"))
