"""Positions within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def with_rank(df: DataFrame, group: Sequence[str], order: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """Add ``rank``, from 0, within ``group`` by the columns ``order``.

    Rows equal in ``order`` are ranked by a hash of ``ties``, which must tell
    them apart. They are spread over SALTS tasks and each salt starts where the
    counts of those before it end, so neither a large group nor many equal rows
    meet in one task; the table of counts has a row per group, order and salt.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*ties), F.lit(SALTS)).cast("int"))
    keys = [*group, *order, "_salt"]
    before = Window.partitionBy(*group).orderBy(*order, "_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        salted.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)], "_start")
    )
    within = Window.partitionBy(*keys).orderBy(F.xxhash64(*ties), *ties)
    on = [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)]
    return (
        salted.withColumn("_in", F.row_number().over(within) - 1)
        .join(starts, on)
        .withColumn("rank", F.col("_start") + F.col("_in"))
        .drop("_salt", "_in", "_start", *[f"_r{i}" for i in range(len(keys))])
    )
