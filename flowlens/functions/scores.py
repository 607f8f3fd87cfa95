"""From an anomaly score to a label, a severity and an action."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity cuts, actions, label names, histogram bands, detector limits.
DEFAULT_THRESHOLD = 0.45
SEVERITY_CUTS = (("High", 0.85), ("Medium", 0.7))
LOWEST_SEVERITY = "Low"
ACTIONS = {"High": "Block/Isolate host", "Medium": "Alert SOC"}
DEFAULT_ACTION = "Log only"
LABEL_ANOMALY = "ANOMALY"
LABEL_NORMAL = "NORMAL"
SCORE_BANDS = ("0-20%", "20-40%", "40-60%", "60-80%", "80-100%")
DETECTOR_LIMITS = {"Flow Byts/s": 500000.0, "Flow Pkts/s": 10000.0, "Tot Fwd Pkts": 100.0}


def severity(score: Column) -> Column:
    (top, top_cut), (middle, middle_cut) = SEVERITY_CUTS
    return (F.when(score >= top_cut, top)
            .when(score >= middle_cut, middle)
            .otherwise(LOWEST_SEVERITY))


def suggested_action(level: Column) -> Column:
    return (F.when(level == "High", ACTIONS["High"])
            .when(level == "Medium", ACTIONS["Medium"])
            .otherwise(DEFAULT_ACTION))


def threshold_label(score: Column, threshold: Column | float) -> Column:
    """ANOMALY at or above the threshold."""
    return F.when(score >= threshold, LABEL_ANOMALY).otherwise(LABEL_NORMAL)


def score_band(score: Column) -> Column:
    """Band of a score in percent: five bands, the last one open above."""
    percent = score * 100
    chain = F.when(percent < 20, SCORE_BANDS[0])
    for upper, name in zip((40, 60, 80), SCORE_BANDS[1:4]):
        chain = chain.when(percent < upper, name)
    return chain.otherwise(SCORE_BANDS[4])


def rule_detector(bytes_per_s: Column, packets_per_s: Column, forward_packets: Column) -> Column:
    """True when any traffic figure is above its limit; missing figures count as quiet."""
    figures = zip((bytes_per_s, packets_per_s, forward_packets), DETECTOR_LIMITS.values())
    over = [F.coalesce(figure > limit, F.lit(False)) for figure, limit in figures]
    return over[0] | over[1] | over[2]


def inverted(score: Column) -> Column:
    return 1 - score
