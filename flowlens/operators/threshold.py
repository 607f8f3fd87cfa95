"""Alert thresholds from past scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions import labels, numeric
from flowlens.functions.scores import DEFAULT_THRESHOLD
from flowlens.operators import selection

# Spread factor and bounds of both thresholds, quantile of the calibration.
SPREAD = 0.75
SMART_BOUNDS = (0.3, 0.95)
CALIBRATION_BOUNDS = (0.01, 0.99)
CALIBRATION_QUANTILE = 0.99
RECENT_SCORES = 1000


def recent(df: DataFrame, n: int, at: str = "created_at", tie: str = "id") -> DataFrame:
    """The latest n rows; each task keeps n rows, no full sort."""
    return df.orderBy(F.desc(at), F.asc(tie)).limit(n)


def smart_threshold(scores: DataFrame, column: str = "anomaly_score",
                    fallback: float | Column = DEFAULT_THRESHOLD) -> DataFrame:
    """Mean plus 0.75 population deviations, within bounds; no scores give the fallback as is."""
    value = numeric.missing_if_not_finite(F.col(column))
    raw = F.avg(value) + SPREAD * F.stddev_pop(value)
    base = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return scores.agg(F.coalesce(numeric.clamp(raw, *SMART_BOUNDS), base).alias("threshold"),
                      F.count(value).alias("n"))


def calibrate(df: DataFrame, score: str = "score", label: str | None = "label",
              normal_labels=labels.CALIBRATION_NORMAL, anomaly_labels=labels.CALIBRATION_ANOMALY,
              order_rows: int = selection.ORDER_ROWS) -> DataFrame:
    """One row (threshold, sample_count, inverted).

    The threshold is the lower 99th percentile of the normal scores. Scores are inverted first
    when the normal median is above the anomaly median. Rows with other labels are ignored.
    """
    kind = labels.class_for_calibration(F.col(label), normal_labels, anomaly_labels) if label else F.lit(labels.NORMAL)
    value = numeric.to_number(F.col(score))
    normal = F.when(kind == labels.NORMAL, value)
    anomaly = F.when(kind == labels.ANOMALY, value)
    # The inverted percentile is one minus the mirrored rank, so one search serves both cases.
    found = selection.order_statistics(df, {
        "normal_median": (normal, selection.lower_rank(0.5)),
        "anomaly_median": (anomaly, selection.lower_rank(0.5)),
        "upright": (normal, selection.lower_rank(CALIBRATION_QUANTILE)),
        "mirrored": (normal, selection.upper_rank(CALIBRATION_QUANTILE)),
    }, order_rows)

    def pick(name: str, field: str = "value") -> Column:
        return F.max(F.when(F.col("name") == name, F.col(field)))

    flipped = F.coalesce(pick("normal_median") > pick("anomaly_median"), F.lit(False))
    row = found.agg(flipped.alias("inverted"), pick("upright").alias("_up"), pick("mirrored").alias("_mirror"),
                    pick("upright", "n").alias("sample_count"))
    raw = F.when(F.col("inverted"), 1 - F.col("_mirror")).otherwise(F.col("_up"))
    return row.select(F.round(numeric.clamp(raw, *CALIBRATION_BOUNDS), 6).alias("threshold"),
                      "sample_count", "inverted")


def require_normal_rows(calibrated: DataFrame) -> None:
    """Raise when no normal row was found."""
    if not calibrated.first()["sample_count"]:
        raise ValueError("no normal rows found in the calibration data")
