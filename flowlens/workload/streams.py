"""Streams over the events file; each runs until the file is used up and gives what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import scratch_path
from flowlens.sources import service_tables
from flowlens.streaming import detection
from flowlens.workload import bindings as b


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table, a single file or a folder of part files, as a stream of files."""
    return detection.file_stream(spark, f"{sf}/events.parquet", b.table(spark, sf, "events").schema)


def scored(events: DataFrame) -> DataFrame:
    return events.select("event_id", "ts", "event_type", F.round(F.col("value") / (F.col("value") + 50), 6).alias("anomaly_score"))


def _finished(query) -> None:
    query.awaitTermination()


def stream_scores(spark, sf):
    """Flow events to judged analyses."""
    path = scratch_path(spark, "stream-scores")
    judged = detection.score_stream(event_stream(spark, sf), scored, b.ALERT_LIMIT)
    _finished(detection.to_parquet(judged, path, f"{path}-checkpoint"))
    return spark.read.schema(judged.schema).parquet(path)


STREAM_SCORES = f"""WITH {b.FLOWS}
SELECT event_id, ts, event_type, anomaly_score,{b.JUDGED.format(limit=b.ALERT_LIMIT)} FROM flows"""


def stream_alerts(spark, sf):
    """Analyses to alerts; every micro-batch replaces itself when repeated."""
    path = scratch_path(spark, "stream-alerts")
    judged = detection.score_stream(event_stream(spark, sf), scored, b.ALERT_LIMIT)
    found = detection.alert_stream(judged, "event_id", "ts")
    _finished(detection.to_batches(found, path, f"{path}-checkpoint"))
    return detection.read_batches(spark, path, found.schema).select(
        "event_id", "time", "label", "anomaly_score", "severity", "action", "status")


STREAM_ALERTS = f"""WITH {b.ANALYSES}
SELECT id AS event_id, created_at AS time, predicted_label AS label, anomaly_score, severity, action, 'New' AS status
FROM analyses WHERE predicted_label = 'ANOMALY'"""


def event_changes(events: DataFrame) -> DataFrame:
    """Two status changes for each event, the second up to four hours after the first."""
    later = F.col("ts") + F.make_interval(hours=(F.col("event_id") % 5).cast("int"))
    last = F.when(F.col("event_id") % 3 == 0, "Resolved").otherwise("New")
    both = F.array(F.struct(F.lit("Acknowledged").alias("status"), F.col("ts").alias("changed_at"), F.lit(1).alias("seq")),
                   F.struct(last.alias("status"), later.alias("changed_at"), F.lit(2).alias("seq")))
    return events.select("event_id", F.explode(both).alias("change")).select("event_id", "change.*")


def stream_status(spark, sf):
    """Alerts and their status changes, joined as streams; the latest status of each alert."""
    path = scratch_path(spark, "stream-status")
    alerts = detection.alert_stream(detection.score_stream(event_stream(spark, sf), scored, b.ALERT_LIMIT), "event_id", "ts")
    _finished(detection.to_batches(alerts, f"{path}/alerts", f"{path}-alerts-checkpoint"))
    changes = detection.status_stream(alerts, event_changes(event_stream(spark, sf)), "event_id")
    _finished(detection.to_parquet(changes, f"{path}/changes", f"{path}-changes-checkpoint"))
    written = detection.read_batches(spark, f"{path}/alerts", alerts.schema).drop("id").withColumnRenamed("event_id", "id")
    joined = spark.read.schema(changes.schema).parquet(f"{path}/changes").withColumnRenamed("event_id", "id")
    return service_tables.current_status(written, joined).select("id", "severity", "status", "anomaly_score", joined.agg(F.count(F.lit(1))).scalar().alias("changes"))


STREAM_STATUS = f"""WITH {b.ANALYSES}, found AS (SELECT id, severity, anomaly_score FROM analyses WHERE predicted_label = 'ANOMALY')
SELECT id, severity, CASE WHEN id % 3 = 0 THEN 'Resolved' ELSE 'New' END AS status, anomaly_score, 2 * (SELECT count(*) FROM found) AS changes FROM found"""


def stream_window_stats(spark, sf):
    """Counts per closed day; the last day stays open."""
    path = scratch_path(spark, "stream-windows")
    judged = detection.score_stream(event_stream(spark, sf), scored, b.ALERT_LIMIT)
    stats = detection.window_stats(judged, "ts")
    _finished(detection.to_parquet(stats, path, f"{path}-checkpoint"))
    return spark.read.schema(stats.schema).parquet(path).select(
        F.col("window_start").cast("date").alias("day"), "total", "anomalies", "normal")


STREAM_WINDOW_STATS = f"""WITH {b.ANALYSES}
SELECT batch_id AS day, count(*) AS total, count(*) FILTER (predicted_label = 'ANOMALY') AS anomalies,
       count(*) FILTER (predicted_label = 'NORMAL') AS normal
FROM analyses GROUP BY batch_id
HAVING batch_id + INTERVAL 1 DAY <= (SELECT max(created_at) FROM analyses) - INTERVAL 1 HOUR"""


def stream_adaptive(spark, sf):
    """Adaptive threshold: the first micro-batch knows no past scores and uses the fallback."""
    path = scratch_path(spark, "stream-adaptive")
    flows = scored(event_stream(spark, sf))
    _finished(detection.adaptive_stream(flows, path, f"{path}-checkpoint", "ts", "event_id"))
    return detection.read_batches(spark, f"{path}/analyses", detection.adaptive_schema(flows)).select(
        "event_id", "anomaly_score", "predicted_label", "severity", "threshold")


STREAM_ADAPTIVE = f"""WITH {b.FLOWS}, judged AS (SELECT event_id, anomaly_score,{b.JUDGED.format(limit=0.45)} FROM flows)
SELECT event_id, anomaly_score, predicted_label, severity, CAST(0.45 AS DOUBLE) AS threshold FROM judged"""

NAMES = ("stream_scores", "stream_alerts", "stream_status", "stream_window_stats", "stream_adaptive")
QUERIES = {name: globals()[name] for name in NAMES}
ORACLES = {name: globals()[name.upper()] for name in NAMES}
