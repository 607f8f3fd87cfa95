"""From scored flows to analyses, alerts and log rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions import scores, text
from flowlens.operators import dashboard, threshold
from flowlens.session import stage
from flowlens.sources import service_tables


class Analysis(NamedTuple):
    """The rows one batch of scored items adds to each table."""

    results: DataFrame
    analyses: DataFrame
    alerts: DataFrame
    logs: DataFrame


def effective_threshold(settings: DataFrame, past: DataFrame) -> DataFrame:
    """One row: ``threshold``, smart over past scores when the setting says so, else the stored one, and the settings beside it.

    ``settings`` is the one-row table of ``effective_settings``; it is planned once, as is ``past``.
    """
    adaptive = threshold.smart_threshold(past, fallback=F.lit(None).cast("double"))
    row = adaptive.withColumn("_s", settings.select(F.struct(*settings.columns)).scalar())
    stored = F.col("_s.anomaly_threshold")
    chosen = F.when(F.col("_s.auto_smart_threshold"), F.coalesce("threshold", stored)).otherwise(stored)
    return row.select(chosen.alias("threshold"), *[F.col(f"_s.{c}").alias(c) for c in settings.columns])


def judge(scored: DataFrame, limit: Column | float, score: str = "anomaly_score") -> DataFrame:
    """Add predicted label, severity and suggested action; a projection only."""
    level = scores.severity(F.col(score))
    return scored.withColumns({
        "predicted_label": scores.threshold_label(F.col(score), limit),
        "severity": level, "action": scores.suggested_action(level)})


def analyse(scored: DataFrame, limit: Column | float, auto_create_alert: Column | bool = True,
            at: str = "created_at") -> Analysis:
    """Analyses for every item, alerts for items at or above the threshold, log rows for all.

    ``scored`` has batch_id, item_no, input_features, anomaly_score, raw_proba and ``at``.
    Identifiers derive from batch and item, so a repeated run gives the same rows.
    """
    key = [F.col("batch_id"), F.col("item_no")]
    results = judge(scored, limit)
    analyses = results.select(
        text.stable_id("analysis", *key).alias("id"), "input_features", "predicted_label", "anomaly_score",
        "raw_proba", F.col(at).alias("created_at"))
    wanted = auto_create_alert if isinstance(auto_create_alert, Column) else F.lit(auto_create_alert)
    alerts = results.filter((F.col("predicted_label") == scores.LABEL_ANOMALY) & wanted).select(
        text.stable_id("alert", *key).alias("id"), F.col(at).alias("time"), F.col("predicted_label").alias("label"),
        "anomaly_score", "severity", "action", F.lit(service_tables.STATUS_NEW).alias("status"),
        F.col("input_features").alias("features"), F.col(at).alias("created_at"))
    requests = results.groupBy("batch_id").agg(F.count(F.lit(1)).alias("items"), F.min(at).alias(at))
    logs = (request_logs(requests, at).unionByName(analysis_logs(analyses)).unionByName(alert_logs(alerts)))
    return Analysis(results, analyses, alerts, logs)


def request_logs(requests: DataFrame, at: str = "created_at") -> DataFrame:
    return service_tables.log_rows(
        requests, "request", text.request_message(F.col("items")),
        F.to_json(F.struct(F.col("items").alias("count"))), F.col(at), F.col("batch_id"))


def analysis_logs(analyses: DataFrame) -> DataFrame:
    return service_tables.log_rows(
        analyses, "analysis", text.analysis_message(F.col("predicted_label"), F.col("anomaly_score")),
        F.to_json(F.struct(F.col("id").alias("analysisId"), F.col("predicted_label").alias("label"))),
        F.col("created_at"), F.col("id"))


def alert_logs(alerts: DataFrame) -> DataFrame:
    return service_tables.log_rows(
        alerts, "alert", text.alert_message(F.col("label"), F.col("severity")),
        F.to_json(F.struct(F.col("id").alias("alertId"), "severity")), F.col("created_at"), F.col("id"))


def status_logs(changes: DataFrame) -> DataFrame:
    """Log rows of status changes (id, status, changed_at, seq)."""
    return service_tables.log_rows(
        changes, "status", text.status_message(F.col("status")),
        F.to_json(F.struct(F.col("id").alias("alertId"), F.col("status").alias("newStatus"))),
        F.col("changed_at"), F.col("id"), F.col("seq"))


def store(analysis: Analysis, root: str) -> None:
    """Add the rows of a batch to the service tables; storing a batch again changes nothing.

    Identifiers derive from batch and item, so rows whose id is there already are left out. The three tables show the batch
    together: a run that is cut off leaves nothing to be seen, and the next one stores the whole batch.
    """
    service_tables.store_together({"analyses": analysis.analyses, "alerts": analysis.alerts, "logs": analysis.logs}, root)


def analyse_and_store(scored: DataFrame, limit: Column | float, root: str,
                      auto_create_alert: Column | bool = True, at: str = "created_at") -> Analysis:
    """Analyse a batch into the service tables; whatever scored it runs once."""
    found = analyse(stage(scored, "scored"), limit, auto_create_alert, at)
    store(found, root)
    return found


def summary(analysis: Analysis) -> DataFrame:
    return dashboard.batch_summary(analysis.results)
