"""Summaries shown on a dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions import labels, scores
from flowlens.operators.threshold import recent

# List sizes of the dashboard.
LATEST = {"alerts": 200, "analyses": 100, "logs": 50, "scores": 1000}
RECENT_WINDOW = 100
CHART_POINTS = 20
EVERYTHING = "all"


def analysis_stats(analyses: DataFrame, label: str = "predicted_label") -> DataFrame:
    """total, anomalies and normal traffic in one pass."""
    return analyses.agg(F.count(F.lit(1)).alias("total_requests"),
                        F.count_if(labels.label_is(F.col(label), scores.LABEL_ANOMALY)).alias("anomalies"),
                        F.count_if(labels.label_is(F.col(label), scores.LABEL_NORMAL)).alias("normal_traffic"))


def alert_stats(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count(F.lit(1)).alias("total_alerts"), F.count_if(F.col("status") == "New").alias("new_alerts"))


def dashboard_stats(analyses: DataFrame, alerts: DataFrame) -> DataFrame:
    """Both summaries in one row."""
    counted = alert_stats(alerts)
    return analysis_stats(analyses).select(
        "*", *[counted.select(c).scalar().alias(c) for c in ("total_alerts", "new_alerts")])


def batch_summary(results: DataFrame, batch: Sequence[str] = ("batch_id",)) -> DataFrame:
    """total, anomalies, normal and mean score per batch; no batch column gives one row."""
    anomalies = F.count_if(F.col("predicted_label") == scores.LABEL_ANOMALY)
    total = F.count(F.lit(1))
    return results.groupBy(*batch).agg(
        total.alias("total"), anomalies.alias("anomalies"), (total - anomalies).alias("normal"),
        F.coalesce(F.avg("anomaly_score"), F.lit(0.0)).alias("avg_score"))


def score_histogram(analyses: DataFrame, score: str = "anomaly_score") -> DataFrame:
    """(band, count) of the five score bands; empty bands show 0."""
    band = scores.score_band(F.col(score))
    cells = [F.struct(F.lit(name).alias("band"), F.count_if(band == name).alias("count"))
             for name in scores.SCORE_BANDS]
    return analyses.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def recent_label_split(analyses: DataFrame, n: int = RECENT_WINDOW, at: str = "created_at", tie: str = "id") -> DataFrame:
    """Anomaly and other rows among the latest n, with percentages."""
    window = recent(analyses, n, at, tie)
    split = window.agg(F.count(F.lit(1)).alias("total"),
                       F.count_if(labels.label_is(F.col("predicted_label"), scores.LABEL_ANOMALY)).alias("anomaly"))
    share = F.when(F.col("total") > 0, 100.0 * F.col("anomaly") / F.col("total")).otherwise(0.0)
    return split.select("total", "anomaly", (F.col("total") - F.col("anomaly")).alias("normal"),
                        F.round(share, 1).alias("anomaly_percent"))


def chart_points(analyses: DataFrame, n: int = CHART_POINTS, at: str = "created_at", tie: str = "id") -> DataFrame:
    """The latest n scores in percent, numbered from the oldest."""
    oldest_first = Window.partitionBy(F.lit(0)).orderBy(F.asc(at), F.desc(tie))
    return recent(analyses, n, at, tie).select(
        F.row_number().over(oldest_first).alias("point"),
        F.round(F.col("anomaly_score") * 100, 2).alias("score"), F.col("predicted_label").alias("label"))


def filter_alerts(alerts: DataFrame, severity: str = EVERYTHING, status: str = EVERYTHING, search: str = "") -> DataFrame:
    """Alerts of one severity and status whose action contains the search text, any case."""
    kept = alerts
    if severity != EVERYTHING:
        kept = kept.filter(F.col("severity") == severity)
    if status != EVERYTHING:
        kept = kept.filter(F.col("status") == status)
    if search:
        kept = kept.filter(F.contains(F.lower("action"), F.lit(search.lower())))
    return kept


def recent_scores(analyses: DataFrame, n: int = LATEST["scores"], at: str = "created_at", tie: str = "id") -> DataFrame:
    """Finite scores of the latest n analyses, with a flag for normal ones."""
    finite = F.abs(F.col("anomaly_score")) < float("inf")
    return (recent(analyses, n, at, tie)
            .select("anomaly_score", labels.label_is(F.col("predicted_label"), scores.LABEL_NORMAL).alias("is_normal"))
            .filter(finite & ~F.isnan("anomaly_score")))


def top_anomalies(scored: DataFrame, n: int = 50, score: str = "anomaly_score", tie: str = "id") -> DataFrame:
    return scored.orderBy(F.desc(score), F.asc(tie)).limit(n)
