"""Ordered work within keys of any size.

A plain window puts one key into one task. Here the keys with many rows are cut
into time blocks first, so that a key with a third of all rows is spread over
up to ``MAX_BLOCKS`` tasks; the value that has to cross a block's edge travels
in a table of one row per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key with more rows than this is cut into blocks.
ROWS_PER_BLOCK = 200_000
MAX_BLOCKS = 256
#: At most so many keys are cut, those with the most rows. A key left out holds
#: less than 1/MAX_HOT_KEYS of all rows, so its group stays small against the
#: input, and the broadcast table of hot keys has a proven bound.
MAX_HOT_KEYS = 4_000


def hot_blocks(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Block edges of the keys that exceed ``rows_per_block``: at most MAX_HOT_KEYS rows."""
    counted = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > rows_per_block)
        .orderBy(F.desc("_n"), *keys)
        .limit(MAX_HOT_KEYS)
        .select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    )
    quantiles = [i / MAX_BLOCKS for i in range(1, MAX_BLOCKS)]
    edges = (
        df.join(F.broadcast(counted), [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys], "left_semi")
        .groupBy(*keys)
        .agg(F.percentile_approx(at, quantiles, 10_000).alias("_all"), F.count(F.lit(1)).alias("_rows"))
    )
    step = F.greatest(F.lit(1), F.floor(F.lit(MAX_BLOCKS) * rows_per_block / F.col("_rows"))).cast("int")
    return edges.select(
        *[F.col(k).alias(f"_hot_{k}") for k in keys],
        F.array_distinct(F.filter(F.col("_all"), lambda _, i: (i + 1) % step == 0)).alias("_edges"),
    )


def with_blocks(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    rows_per_block: int = ROWS_PER_BLOCK,
    hot: str | None = None,
) -> DataFrame:
    """Add ``_blk`` (and the flag ``hot``, whether the key was cut): 0, or for a hot key the number of its block edges at or before ``at``.

    Blocks follow ``at``: every row of block n is earlier than every row of
    block n + 1, and equal times share a block. Null ``at`` goes to block 0.
    """
    edges = hot_blocks(df, keys, at, rows_per_block)
    on = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    n = F.size(F.filter(F.col("_edges"), lambda e: e <= F.col(at)))
    joined = df.join(F.broadcast(edges), on, "left")
    if hot:
        joined = joined.withColumn(hot, F.col("_edges").isNotNull())
    return (
        joined.withColumn("_blk", F.when(F.col("_edges").isNull() | F.col(at).isNull(), F.lit(0)).otherwise(n))
        .drop("_edges", *[f"_hot_{k}" for k in keys])
    )


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    following: bool = False,
) -> DataFrame:
    """Add the ``value`` of the row before (or after) in ``order`` within ``keys``.

    ``df`` has ``_blk`` from :func:`with_blocks` on the first column of
    ``order``. Exact over block edges: the last (first) value of each block is
    passed on through a table of one row per block.
    """
    inner = Window.partitionBy(*keys, "_blk").orderBy(*order)
    step = F.lead if following else F.lag
    out = df.withColumn("_v", F.struct(value.alias("v"))).withColumn("_near", step("_v").over(inner))
    by = F.struct(*order)
    edge = (
        out.groupBy(*keys, "_blk")
        .agg((F.min_by if following else F.max_by)("_v", by).alias("_edge"))
        .withColumn("_over", step("_edge").over(Window.partitionBy(*keys).orderBy("_blk")))
        .where(F.col("_over").isNotNull())
        .select(*[F.col(k).alias(f"_e_{k}") for k in keys], F.col("_blk").alias("_e_blk"), "_over")
    )
    on = [F.col(k).eqNullSafe(F.col(f"_e_{k}")) for k in keys] + [F.col("_blk") == F.col("_e_blk")]
    return (
        out.join(edge, on, "left")
        .withColumn(name, F.coalesce("_near", "_over")["v"])
        .drop("_v", "_near", "_over", "_e_blk", *[f"_e_{k}" for k in keys])
    )
