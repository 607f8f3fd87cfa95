import pytest
from pyspark.sql import functions as F

from flowlens.plans import analysis
from flowlens.operators import threshold
from flowlens.streaming import detection
from flowlens.workload import bindings, streams


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    """Events in three files of consecutive days."""
    root = str(tmp_path_factory.mktemp("events"))
    events = bindings.table(spark, sf, "events")
    for low, high in ((0, 300), (300, 700), (700, 1000)):
        events.filter((F.col("event_id") >= low) & (F.col("event_id") < high)).coalesce(1).write.mode("append").parquet(root)
    return root


def stream(spark, folder, sf):
    return detection.file_stream(spark, folder, bindings.table(spark, sf, "events").schema, files_per_batch=1)


def test_alerts_equal_batch(spark, sf, folder, tmp_path):
    judged = detection.score_stream(stream(spark, folder, sf), streams.scored, 0.6)
    found = detection.alert_stream(judged, "event_id", "ts")
    detection.to_batches(found, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    written = spark.read.schema(found.schema).parquet(str(tmp_path / "out" / "epoch=*"))
    assert sorted(r["event_id"] for r in written.collect()) == sorted(r["id"] for r in bindings.alerts(spark, sf, 0.6).collect())


def test_restart_adds_nothing(spark, sf, folder, tmp_path):
    for _ in range(2):
        judged = detection.score_stream(stream(spark, folder, sf), streams.scored, 0.6)
        detection.to_parquet(judged, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1000


def test_adaptive_threshold_uses_earlier_batches(spark, sf, folder, tmp_path):
    flows = streams.scored(stream(spark, folder, sf))
    detection.adaptive_stream(flows, str(tmp_path / "out"), str(tmp_path / "check"), "ts", "event_id", n=200).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out" / "analyses" / "epoch=*"))
    assert rows.count() == 1000
    limits = {}
    for r in rows.groupBy(F.when(F.col("event_id") < 300, 0).when(F.col("event_id") < 700, 1).otherwise(2).alias("part")).agg(
            F.min("threshold").alias("low"), F.max("threshold").alias("high")).collect():
        assert r["low"] == r["high"]
        limits[r["part"]] = r["low"]
    scored = streams.scored(bindings.table(spark, sf, "events"))
    assert limits[0] == 0.45
    for part, before in ((1, 300), (2, 700)):
        past = threshold.recent(scored.filter(F.col("event_id") < before), 200, "ts", "event_id")
        assert abs(limits[part] - threshold.smart_threshold(past).first()["threshold"]) < 1e-12


def test_windows_equal_batch_for_closed_days(spark, sf, folder, tmp_path):
    judged = detection.score_stream(stream(spark, folder, sf), streams.scored, 0.6)
    stats = detection.window_stats(judged, "ts")
    detection.to_parquet(stats, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    closed = {r["window_start"].date(): r["total"] for r in spark.read.schema(stats.schema).parquet(str(tmp_path / "out")).collect()}
    batch = analysis.judge(streams.scored(bindings.table(spark, sf, "events")), 0.6)
    known = {r["day"]: r["count"] for r in batch.groupBy(F.to_date("ts").alias("day")).count().collect()}
    last = max(known)
    assert closed == {day: n for day, n in known.items() if day < last}


def test_streams_of_a_folder_table(spark, sf, folder, tmp_path):
    (tmp_path / "events.parquet").symlink_to(folder)
    assert streams.stream_scores(spark, str(tmp_path)).count() == 1000
    assert streams.stream_alerts(spark, str(tmp_path)).count() == streams.stream_alerts(spark, sf).count()


def test_a_stream_that_writes_nothing_gives_no_rows(spark, sf, tmp_path):
    bindings.table(spark, sf, "events").limit(0).write.parquet(str(tmp_path / "events.parquet"))
    for query in (streams.stream_scores, streams.stream_alerts, streams.stream_adaptive):
        assert query(spark, str(tmp_path)).count() == 0


def test_adaptive_state_stays_small_over_a_restart(spark, sf, tmp_path):
    events = bindings.table(spark, sf, "events").filter("event_id < 400")
    source = str(tmp_path / "in")

    def add(first, last):
        for part in range(first, last):
            events.filter(F.col("event_id").between(50 * part, 50 * part + 49)).coalesce(1).write.mode("append").parquet(source)

    def go():
        flows = streams.scored(detection.file_stream(spark, source, events.schema, "*.parquet", 1))
        detection.adaptive_stream(flows, str(tmp_path / "out"), str(tmp_path / "check"), "ts", "event_id", n=60).awaitTermination()

    add(0, 5)
    go()
    add(5, 8)
    go()
    assert len(list((tmp_path / "out" / "recent").glob("slot=*"))) == detection.KEPT_EPOCHS
    rows = spark.read.parquet(str(tmp_path / "out" / "analyses" / "epoch=*"))
    assert rows.count() == 400
    limits = {r["part"]: (r["low"], r["high"]) for r in rows.groupBy(F.floor(F.col("event_id") / 50).alias("part")).agg(
        F.min("threshold").alias("low"), F.max("threshold").alias("high")).collect()}
    scored = streams.scored(events)
    for part in range(1, 8):
        past = threshold.recent(scored.filter(F.col("event_id") < 50 * part), 60, "ts", "event_id")
        expected = threshold.smart_threshold(past, fallback=0.45).first()["threshold"]
        assert limits[part][0] == limits[part][1] and abs(limits[part][0] - expected) < 1e-12


def test_status_changes_of_later_batches_find_their_alerts(spark, sf, folder, tmp_path):
    """Changes arrive a batch after their alerts; one comes too early, one beyond the horizon, one names no alert."""
    events = bindings.table(spark, sf, "events")
    late = streams.event_changes(events)
    odd = [(f"event_id = {k} AND seq = 1", shift) for k, shift in ((1, "-1"), (2, "1000"))]
    for low, high in ((2000, 2001), (0, 300), (300, 700), (700, 1000)):
        part = late.filter(F.col("event_id").between(low, high - 1))
        for where, hours in odd:
            part = part.withColumn("changed_at", F.when(F.expr(where), F.col("changed_at") + F.expr(f"INTERVAL '{hours}' HOUR")).otherwise(F.col("changed_at")))
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "changes"))
    alerts = detection.alert_stream(detection.score_stream(stream(spark, folder, sf), streams.scored, 0.0), "event_id", "ts")
    changes = detection.file_stream(spark, str(tmp_path / "changes"), late.schema, files_per_batch=1)
    joined = detection.status_stream(alerts, changes, "event_id", horizon="10 days", lateness="400 days")
    detection.to_parquet(joined, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    found = spark.read.schema(joined.schema).parquet(str(tmp_path / "out"))
    expected = {(r["event_id"], r["seq"]) for r in late.collect()} - {(1, 1), (2, 1)}
    assert sorted((r["event_id"], r["seq"]) for r in found.collect()) == sorted(expected)
