"""Evaluating a model or a file of predictions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions import labels, text
from flowlens.operators import cleaning, harmonise, matching, metrics
from flowlens.plans import learning
from flowlens.session import stage


class Evaluation(NamedTuple):
    """Predictions, and the metrics document unless the data has no labels."""

    predictions: DataFrame
    document: DataFrame | None


def evaluate(trained: learning.Trained, test: DataFrame, target: str = "class",
             predict_only: bool = False, positive: str = labels.ANOMALY) -> Evaluation:
    """Score a test table; without a label column only predict, if that is allowed."""
    cleaned = cleaning.infinities_to_null(test)
    wanted = target
    if not trained.encoded:
        cleaned, wanted = harmonise.normalise_headers(cleaned, target)
    found = wanted if wanted in cleaned.columns else labels.find_target(cleaned.columns, target)
    if found is None:
        if not predict_only:
            raise ValueError(f"no target column '{target}' and no common alternative")
        scored = learning.predict(trained, cleaned, positive)
        return Evaluation(learning.probability_columns(trained, scored), None)
    scored = learning.predict(trained, cleaned, positive)
    # Matrix and area read what was judged, not the rows: each row is scored once.
    judged = stage(scored.select(text.col(found).alias("_true"), "predicted_label", "raw_proba"), "judged")
    counts = metrics.confusion_counts(judged, "_true", "predicted_label")
    auc = learning.auc_of(trained, judged, "_true", positive)
    return Evaluation(learning.probability_columns(trained, scored), metrics.metrics_document(counts, auc))


def evaluate_against_truth(predictions: DataFrame, truth: DataFrame,
                           outputs: Sequence[str] = ("prediction", "anomaly_score"),
                           positive: str = labels.ANOMALY) -> dict[str, DataFrame]:
    """Metrics of predictions matched to the truth by all feature columns.

    Works on counted feature rows: copies are weighted, not joined pair by pair.
    """
    features = [c for c in predictions.columns if c not in outputs]
    label = labels.label_by_difference(truth.columns, predictions.columns, outputs)
    matched = matching.match_counts(predictions, truth, features, label, ["prediction"])
    named = matched.select(F.lower(text.col(label).cast("string")).alias("_true"),
                           F.lower(F.col("prediction").cast("string")).alias("_predicted"), "pairs")
    counts = metrics.confusion_counts(named, "_true", "_predicted", "pairs")
    return {"coverage": matching.coverage(predictions, matched), "metrics": metrics.binary_metrics(counts, positive),
            "matrix": metrics.confusion_matrix(counts), "report": metrics.classification_report(counts)}
