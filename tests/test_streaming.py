from pyspark.sql import functions as F

from sedimenta.streaming import feeds


def run(spark, stream, name):
    q = stream.writeStream.format("memory").queryName(name).outputMode("append").start()
    try:
        q.processAllAvailable()
        return spark.table(name).collect()
    finally:
        q.stop()


def test_changed_pages_and_windows(spark, tmp_path, day):
    folder = str(tmp_path / "p")
    spark.createDataFrame([("s", day(1), "a b"), ("s", day(2), "a  b"), ("s", day(3), "c"), ("t", day(1), "a b")], "source_id string, fetched_at timestamp_ntz, text string").write.parquet(folder)
    pages = spark.readStream.schema("source_id string, fetched_at timestamp_ntz, text string").parquet(folder)
    assert len(run(spark, feeds.changed_pages(pages), "pages")) == 3
    events = str(tmp_path / "e")
    spark.createDataFrame([(day(0, h), "view", 1.0) for h in (1, 2, 30)] + [(day(9), "view", 1.0)], "ts timestamp_ntz, event_type string, value double").coalesce(1).write.parquet(events)
    stream = spark.readStream.schema("ts timestamp_ntz, event_type string, value double").parquet(events)
    assert sorted(r.n for r in run(spark, feeds.windowed_counts(stream), "counts")) == [1, 2]


def test_snapshot_changes_keep_state(spark, tmp_path, day):
    folder = str(tmp_path / "c")
    schema = "source_id string, captured_at timestamp_ntz, asset_id string, phase_code string, partners array<string>"
    spark.createDataFrame([("s", day(1), "a", "P1", ["x"]), ("s", day(1), "b", None, None)], schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).parquet(folder)
    q = feeds.snapshot_changes_stream(stream).writeStream.format("memory").queryName("changes").outputMode("append").start()
    try:
        q.processAllAvailable()
        spark.createDataFrame([("s", day(2), "a", "p2", ["y"]), ("s", day(2), "c", None, None)], schema).coalesce(1).write.mode("append").parquet(folder)
        q.processAllAvailable()
        got = sorted((r.asset_id, r.change_type) for r in spark.table("changes").where(F.col("source_id") == "s").collect())
    finally:
        q.stop()
    assert got == [("a", "asset_phase_changed"), ("a", "partner_added"), ("a", "partner_removed"), ("b", "asset_left_pipeline"), ("c", "asset_added")]
