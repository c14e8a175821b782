"""Names resolved to ids, and keyed inserts and updates of tables without row-level writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions.text import name_key


#: Parts of a key's rows that are searched for their first apart, so that a key of any size is no one's task.
SALTS = 64


def first_per_key(df: DataFrame, keys: Sequence[str], *order) -> DataFrame:
    """The first row of each key in ``order``, which should end in a unique column.

    Each of SALTS parts of a key finds its first, then the key the first of those.
    """
    first = lambda rows, by: rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_n = 1").drop("_n")
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c, t in df.dtypes if not t.startswith("map")]), F.lit(SALTS)))
    return first(first(salted, [*keys, "_salt"]), keys).drop("_salt")


def resolved(names: DataFrame, aliases: DataFrame, synonyms: DataFrame) -> DataFrame:
    """name, asset_id: by alias (exact), else by synonym without case, else by letters and digits; null if unknown.

    Where several assets fit at one step the smallest id is taken. ``aliases``
    and ``synonyms`` have name and asset_id.
    """
    step = lambda df, key: df.where(F.col("name").isNotNull()).groupBy(key.alias("_k")).agg(F.min("asset_id").alias("asset_id"))
    low = F.lower(F.trim("name"))
    wanted = names.select("name").distinct()
    out = wanted.join(step(aliases, F.col("name")).withColumnRenamed("asset_id", "_a"), F.col("name") == F.col("_k"), "left").drop("_k")
    out = out.join(step(synonyms, low).withColumnRenamed("asset_id", "_b"), low == F.col("_k"), "left").drop("_k")
    by_key = step(synonyms, name_key(F.col("name"))).where(F.col("_k") != "").withColumnRenamed("asset_id", "_c")
    out = out.join(by_key, name_key(F.col("name")) == F.col("_k"), "left").drop("_k")
    return out.select("name", F.coalesce("_a", "_b", "_c").alias("asset_id"))


def missing(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key ``existing`` lacks, one per key: what an insert that ignores conflicts adds."""
    rows = first_per_key(new, keys, *[F.col(c).asc_nulls_last() for c in new.columns])
    return rows.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def upserted(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` with the rows of ``new`` in place of those of the same key."""
    kept = existing.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(first_per_key(new, keys, *[F.col(c).asc_nulls_last() for c in new.columns]))


def filled(existing: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``existing`` with its null ``columns`` taken from ``new``; what is there stays."""
    other = first_per_key(new, keys, *[F.col(c).asc_nulls_last() for c in columns]).select(*keys, *[F.col(c).alias(f"_{c}") for c in columns])
    rest = [c for c in existing.columns if c not in columns and c not in keys]
    return existing.join(other, list(keys), "left").select(*keys, *rest, *[F.coalesce(c, f"_{c}").alias(c) for c in columns])


def without(existing: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``existing`` without the rows of the keys in ``gone``: a cascading delete's step."""
    return existing.join(gone.select(key).distinct(), key, "left_anti")
