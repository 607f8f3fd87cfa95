"""How the driver tables stand in for flows, analyses, alerts and settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions import labels, scores
from flowlens.plans import analysis

# A past threshold of the alert tables, and the threshold of a plain detector.
ALERT_LIMIT = 0.6
DETECTOR_LIMIT = 0.7


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def flows(spark: SparkSession, sf: str) -> DataFrame:
    """Events as scored flows: errors are the anomalies, the score grows with the value."""
    return table(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        F.when(F.col("event_type") == "error", labels.ANOMALY).otherwise(labels.NORMAL).alias("class"),
        F.round(F.col("value") / (F.col("value") + 50), 6).alias("anomaly_score"))


def analyses(spark: SparkSession, sf: str, limit: float = ALERT_LIMIT) -> DataFrame:
    """Judged flows in the shape of the analyses table, with their plain event number as id."""
    judged = analysis.judge(flows(spark, sf), limit)
    return judged.select(F.col("event_id").alias("id"), "predicted_label", "anomaly_score", "severity", "action",
                         F.col("ts").alias("created_at"), F.to_date("ts").alias("batch_id"))


def alerts(spark: SparkSession, sf: str, limit: float = ALERT_LIMIT) -> DataFrame:
    """Analyses at or above the limit; a new alert per event, older ones acknowledged."""
    found = analyses(spark, sf, limit).filter(F.col("predicted_label") == scores.LABEL_ANOMALY)
    return found.select("id", F.col("created_at").alias("time"), F.col("predicted_label").alias("label"),
                        "anomaly_score", "severity", "action",
                        F.when(F.day("created_at") >= 15, "New").otherwise("Acknowledged").alias("status"))


def detections(spark: SparkSession, sf: str) -> DataFrame:
    """True class and predicted class of every flow."""
    return flows(spark, sf).withColumn(
        "prediction", F.when(F.col("anomaly_score") >= DETECTOR_LIMIT, labels.ANOMALY).otherwise(labels.NORMAL))


def settings_changes(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of settings updates read off the events; the key depends on the event type."""
    kind, value = F.col("event_type"), F.col("value")
    key = (F.when(kind == "click", "anomalyThreshold").when(kind == "view", "autoSmartThreshold")
           .when(kind == "purchase", "apiUrl").otherwise(F.concat(F.lit("other_"), kind)))
    text = (F.when(kind == "click", F.format_string("0.%02d", F.floor(value) % 100))
            .when(kind == "view", F.when(value > 245, "true").otherwise("false"))
            .when(kind == "purchase", F.concat(F.lit('"http://host'), F.col("user_id").cast("string"), F.lit('/predict"')))
            .otherwise(kind))
    return table(spark, sf, "events").select(key.alias("key"), text.alias("value"),
                                             F.col("ts").alias("created_at"), F.col("event_id").alias("seq"))


# The same tables as SQL common table expressions.
FLOWS = """flows AS (
    SELECT event_id, ts, user_id, event_type, value, props,
           CASE WHEN event_type = 'error' THEN 'anomaly' ELSE 'normal' END AS class,
           round(value / (value + 50), 6) AS anomaly_score
    FROM events)"""

JUDGED = """
           CASE WHEN anomaly_score >= {limit} THEN 'ANOMALY' ELSE 'NORMAL' END AS predicted_label,
           CASE WHEN anomaly_score >= 0.85 THEN 'High' WHEN anomaly_score >= 0.7 THEN 'Medium' ELSE 'Low' END AS severity,
           CASE WHEN anomaly_score >= 0.85 THEN 'Block/Isolate host' WHEN anomaly_score >= 0.7 THEN 'Alert SOC' ELSE 'Log only' END AS action"""

ANALYSES = f"""{FLOWS}, analyses AS (
    SELECT event_id AS id, anomaly_score, ts AS created_at, CAST(ts AS DATE) AS batch_id,{JUDGED.format(limit=ALERT_LIMIT)}
    FROM flows)"""

ALERTS = f"""{ANALYSES}, alerts AS (
    SELECT id, created_at AS time, predicted_label AS label, anomaly_score, severity, action,
           CASE WHEN day(created_at) >= 15 THEN 'New' ELSE 'Acknowledged' END AS status
    FROM analyses WHERE predicted_label = 'ANOMALY')"""

DETECTIONS = f"""{FLOWS}, detections AS (
    SELECT *, CASE WHEN anomaly_score >= {DETECTOR_LIMIT} THEN 'anomaly' ELSE 'normal' END AS prediction FROM flows)"""

SETTINGS = """settings_changes AS (
    SELECT CASE event_type WHEN 'click' THEN 'anomalyThreshold' WHEN 'view' THEN 'autoSmartThreshold'
                           WHEN 'purchase' THEN 'apiUrl' ELSE 'other_' || event_type END AS key,
           CASE event_type WHEN 'click' THEN printf('0.%02d', CAST(floor(value) AS BIGINT) % 100)
                           WHEN 'view' THEN CASE WHEN value > 245 THEN 'true' ELSE 'false' END
                           WHEN 'purchase' THEN '"http://host' || user_id || '/predict"'
                           ELSE event_type END AS value,
           ts AS created_at, event_id AS seq
    FROM events), current_settings AS (
    SELECT key, value FROM (
        SELECT *, row_number() OVER (PARTITION BY key ORDER BY created_at DESC, seq DESC) AS place FROM settings_changes)
    WHERE place = 1)"""
