"""Scoring requests and scoring responses as JSON text."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions import scores

# JSON shapes of requests and responses.
REQUEST = "items array<struct<features: map<string, double>>>"
RESPONSE = """
    results array<struct<predicted_label: string, anomaly_score: double,
                         raw_proba: struct<anomaly: double, normal: double>>>,
    predicted_label string, anomaly_score double,
    raw_proba struct<anomaly: double, normal: double>"""


class Parsed(NamedTuple):
    """Usable rows and rejected rows."""

    accepted: DataFrame
    rejected: DataFrame


def read_requests(df: DataFrame, body: str, keep: Sequence[str] = ()) -> Parsed:
    """One row per request item with ``item_no`` and its ``features`` map.

    A body that is no JSON, or whose first item has no features, is rejected as a whole.
    """
    parsed = df.withColumn("_request", F.from_json(body, REQUEST))
    usable = F.coalesce(F.get("_request.items", F.lit(0))["features"].isNotNull(), F.lit(False))
    # Unusable bodies give no items; a filter would parse every body a second time.
    items = F.when(usable, F.col("_request.items"))
    accepted = (parsed.select(*keep, F.posexplode(items).alias("item_no", "_item"))
                .select(*keep, "item_no", F.col("_item.features").alias("features")))
    rejected = parsed.filter(~usable).select(*keep, F.col(body).alias("body"))
    return Parsed(accepted, rejected)


def align_features(features: Column, names: Sequence[str]) -> Column:
    """Feature array in model order: absent and null features are 0, others are dropped."""
    return F.array(*[F.coalesce(features[name], F.lit(0.0)) for name in names])


def read_responses(df: DataFrame, body: str, threshold: float = scores.DEFAULT_THRESHOLD,
                   keep: Sequence[str] = ()) -> Parsed:
    """Label, score and probabilities of a scoring response.

    The first of ``results`` counts, else the body itself. Without a score and without
    probabilities the response is rejected.
    """
    parsed = df.withColumn("_answer", F.from_json(body, RESPONSE))
    listed = F.coalesce(F.size("_answer.results") > 0, F.lit(False))
    itself = F.struct(*[F.col("_answer")[name].alias(name) for name in ("predicted_label", "anomaly_score", "raw_proba")])
    # Exploding one answer keeps later filters from parsing the body again.
    answer = F.when(listed, F.slice("_answer.results", 1, 1)).otherwise(F.array(itself))
    single = parsed.select(*keep, F.col(body).alias("body"), F.explode(answer).alias("_one"))
    proba = F.col("_one.raw_proba")
    complete = proba["anomaly"].isNotNull() & proba["normal"].isNotNull()
    picked = single.select(*keep, "body", F.col("_one.anomaly_score").alias("_score"),
                           F.when(complete, proba["anomaly"]).alias("_anomaly"),
                           F.when(complete, proba["normal"]).alias("_normal"))
    usable = F.col("_score").isNotNull() | F.col("_anomaly").isNotNull()
    final = F.coalesce("_score", "_anomaly")
    accepted = picked.filter(usable).select(
        *keep, scores.threshold_label(final, threshold).alias("predicted_label"),
        final.alias("anomaly_score"),
        F.create_map(F.lit("anomaly"), F.coalesce("_anomaly", final),
                     F.lit("normal"), F.coalesce("_normal", scores.inverted(final))).alias("raw_proba"))
    rejected = picked.filter(~usable).select(*keep, "body")
    return Parsed(accepted, rejected)
