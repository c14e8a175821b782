"""What changed between consecutive full snapshots, by Merkle digests of hash ranges.

Keys of a snapshot fall into LEAVES hash ranges. The digest of a range is the
exclusive-or of its rows' hashes (two independent 64-bit hashes and a count), so
a parent's digest is the same combination of its children's, and comparing two
snapshots top-down (whole, then FAN ranges, then the leaves of the ranges that
differ) leaves row comparison to the leaves whose digests differ.

The digests of one snapshot are at most LEAVES rows, whatever its size, so no
join on snapshots is skewed; rows are only ever keyed by (snapshot, leaf).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.text import stripped
from sedimenta.operators.ordered import neighbour, with_blocks
from sedimenta.session import cut

LEAF_BITS = 12
FAN_BITS = 6


def _blank_to_null(column: Column) -> Column:
    code = F.lower(stripped(column))
    return F.when(code != "", code)


def _digests(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(
        F.bit_xor("d1").alias("d1"), F.bit_xor("d2").alias("d2"), F.sum("n").alias("n")
    )


def _differing(df: DataFrame) -> DataFrame:
    return df.where((F.col("d1") != 0) | (F.col("d2") != 0) | (F.col("n") != 0))


def consecutive_captures(rows: DataFrame) -> DataFrame:
    """capture_id, prev_id of every capture that holds a keyed row and isn't its source's first.

    Of the rows only what names a capture is read; the result is kept, as it is
    used on every level and has one row per capture.
    """
    caps = cut(rows.groupBy("capture_id").agg(F.min("source_id").alias("source_id"), F.min("captured_at").alias("captured_at")))
    placed = with_blocks(caps, ["source_id"], "captured_at")
    pairs = neighbour(placed, ["source_id"], ["captured_at", "capture_id"], F.col("capture_id"), "prev_id")
    return cut(pairs.where(F.col("prev_id").isNotNull()).select("capture_id", "prev_id"))


def snapshot_changes(snapshots: DataFrame) -> DataFrame:
    """Changes of each capture against the one before of the same source.

    ``snapshots`` has capture_id, source_id, captured_at, loaded_at, asset_id,
    phase_code and partners; other columns are ignored. Result: capture_id (the
    later capture), asset_id, change_type.

    Rows with a null or blank asset_id, capture_id or source_id don't count;
    a capture without other rows doesn't exist. Of several rows for one capture
    and asset the latest loaded_at counts (null loaded_at is earliest; of equal
    ones the greatest phase, then partners). Phases compare without case and
    surrounding blanks, blank equals null. Partners compare as sets without
    nulls, null equals empty. Captures at one time follow their capture_id.
    An empty table gives no rows.
    """
    asset = F.col("asset_id")
    rows = (
        snapshots.where(
            asset.isNotNull() & (stripped(asset) != "") & F.col("capture_id").isNotNull() & F.col("source_id").isNotNull()
        )
        .select(
            "capture_id",
            "source_id",
            "captured_at",
            "asset_id",
            "loaded_at",
            _blank_to_null(F.col("phase_code")).alias("phase"),
            F.sort_array(
                F.array_distinct(F.array_compact(F.coalesce("partners", F.array().cast("array<string>"))))
            ).alias("partners"),
            F.shiftrightunsigned(F.xxhash64("asset_id"), 64 - LEAF_BITS).cast("int").alias("leaf"),
        )
    )
    # One exchange of the rows serves the deduplication, the leaf digests and the final fetch.
    current = (
        rows.repartition("capture_id", "leaf")
        .groupBy("capture_id", "leaf", "asset_id")
        .agg(F.max(F.struct("loaded_at", "phase", "partners")).alias("s"))
        .select("capture_id", "leaf", "asset_id", F.col("s.phase").alias("phase"), F.col("s.partners").alias("partners"))
    )
    leaves = (
        current.select(
            "capture_id",
            "leaf",
            F.xxhash64("asset_id", "phase", "partners").alias("d1"),
            F.xxhash64(F.lit("b"), "partners", F.lit("c"), "phase", "asset_id").alias("d2"),
            F.lit(1).alias("n"),
        )
        .transform(lambda df: _digests(df, "capture_id", "leaf"))
    )
    nodes = _digests(leaves.withColumn("node", F.shiftright("leaf", LEAF_BITS - FAN_BITS)), "capture_id", "node")
    sides = consecutive_captures(rows).select(
        F.col("capture_id").alias("pair"),
        F.explode(
            F.array(
                F.struct(F.col("capture_id").alias("cap"), F.lit(1).alias("sign")),
                F.struct(F.col("prev_id").alias("cap"), F.lit(-1).alias("sign")),
            )
        ).alias("x"),
    ).select("pair", F.col("x.cap").alias("capture_id"), F.col("x.sign").alias("sign"))
    signed = lambda df: df.withColumn("n", F.col("n") * F.col("sign"))
    # Each level is built of the one below and met only where the level above differs.
    roots = _digests(nodes, "capture_id")
    changed = _differing(_digests(signed(sides.join(roots, "capture_id")), "pair")).select("pair")
    met = signed(sides.join(changed, "pair", "left_semi").join(nodes, "capture_id"))
    dirty_nodes = _differing(_digests(met, "pair", "node")).select("pair", "node")
    below = sides.join(dirty_nodes, "pair")
    met = signed(leaves.withColumn("node", F.shiftright("leaf", LEAF_BITS - FAN_BITS)).join(below, ["capture_id", "node"]))
    dirty = _differing(_digests(met, "pair", "leaf")).select("pair", "leaf")
    wanted = dirty.join(sides, "pair").select("pair", "capture_id", "leaf", "sign")
    touched = current.join(wanted, ["capture_id", "leaf"])
    side = lambda s: F.max(F.when(F.col("sign") == s, F.struct("phase", "partners")))
    met = touched.groupBy("pair", "asset_id").agg(side(1).alias("b"), side(-1).alias("a"))
    a, b = F.col("a"), F.col("b")
    kept = a.isNotNull() & b.isNotNull()
    kinds = F.array_compact(
        F.array(
            F.when(a.isNull(), F.lit("asset_added")),
            F.when(b.isNull(), F.lit("asset_left_pipeline")),
            F.when(kept & ~a["phase"].eqNullSafe(b["phase"]), F.lit("asset_phase_changed")),
            F.when(kept & (F.size(F.array_except(b["partners"], a["partners"])) > 0), F.lit("partner_added")),
            F.when(kept & (F.size(F.array_except(a["partners"], b["partners"])) > 0), F.lit("partner_removed")),
        )
    )
    return met.select(F.col("pair").alias("capture_id"), "asset_id", F.explode(kinds).alias("change_type"))
