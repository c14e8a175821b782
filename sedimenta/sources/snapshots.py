"""Immutable snapshots with hash-skip, and partition-wise rebuilt tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.functions.text import content_hash


def marked_snapshots(fetched: DataFrame, stored: DataFrame | None) -> DataFrame:
    """``fetched`` (source_id, fetched_at, snapshot_id, text) with content_hash, changed and artifact.

    A page is unchanged if its hash equals that of its source's latest stored
    snapshot; the artifact (the text) is kept only for changed ones. Of several
    fetches of one source each is compared with the one before it.
    """
    hashed = fetched.withColumn("content_hash", content_hash(F.col("text")))
    from pyspark.sql import Window

    w = Window.partitionBy("source_id").orderBy("fetched_at", "snapshot_id")
    before = F.lag("content_hash").over(w)
    if stored is not None:
        latest = stored.groupBy("source_id").agg(F.max_by("content_hash", F.struct("fetched_at", "snapshot_id")).alias("_stored"))
        hashed = hashed.join(latest, "source_id", "left")
        before = F.coalesce(before, F.col("_stored"))
    out = hashed.withColumn("changed", ~F.col("content_hash").eqNullSafe(before))
    return out.select("source_id", "snapshot_id", "fetched_at", "content_hash", "changed", F.when(F.col("changed"), F.col("text")).alias("artifact"))


def append_snapshots(marked: DataFrame, folder: str) -> None:
    marked.write.mode("append").partitionBy("source_id").parquet(folder)


def rebuild_partitions(df: DataFrame, folder: str, by: str) -> None:
    """Replace the partitions that ``df`` holds, leave the others: an idempotent rebuild."""
    df.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(folder)


def _path(spark: SparkSession, path: str) -> tuple[object, object]:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def put_artifact(spark: SparkSession, path: str, content: bytes) -> None:
    """Store the bytes of one artifact under a path of any file system the session knows."""
    fs, at = _path(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def get_artifacts(spark: SparkSession, path: str) -> DataFrame:
    """path, content of the artifacts of a folder."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def publish(relations: dict[str, DataFrame]) -> None:
    """Relations under their names in the session, replacing those of the same names; a later one may read an earlier one."""
    for name, df in relations.items():
        df.createOrReplaceTempView(name)
