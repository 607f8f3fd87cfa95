"""Quality classifier by positive-unlabelled learning.

Trusted positives are rows labelled 1; the unlabelled rows are web text without a label. With class prior p
and logistic loss, training minimises the non-negative unbiased risk
p R+(positives) + max(0, R-(unlabelled) - p R-(positives)): while the second term is below zero only its
growth is followed. The prior is estimated first: a classifier tells positives from unlabelled rows, and the least
upper bound of the ratio of the shares above a score, over rows it was not trained on, is the prior.

Both kinds of rows come from bounded samples (``SAMPLE`` each); all texts are scored. A null text is read as the empty
one, whose score is the model's for a text without n-grams. Without positives or unlabelled rows the score is 0.5
everywhere. Rows are independent; repeated rows and null ids are scored like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import batches, features

SAMPLE = 2000
FOLDS, HELD_OUT = 3, 1
STEPS = 120


def prior_bound(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1, gamma: float = 0.01) -> float:
    """Class prior from scores of fresh positives and unlabelled rows: the ratio at the tightest upper bound."""
    scores = np.unique(positive)
    above_p = 1 - np.searchsorted(np.sort(positive), scores, "left") / len(positive)
    above_u = 1 - np.searchsorted(np.sort(unlabelled), scores, "left") / len(unlabelled)
    noise = np.sqrt(np.log(4 / delta) / 2 / len(positive)) + np.sqrt(np.log(4 / delta) / 2 / len(unlabelled))
    bound = above_u / above_p + (1 + gamma) * noise / above_p
    return float(np.clip((above_u / above_p)[np.argmin(bound)], 0.01, 0.99))


def risk_slopes(z: np.ndarray, positive: np.ndarray, per_row: np.ndarray, prior: float) -> np.ndarray:
    """Slope of the non-negative risk at every row's margin; ``per_row`` makes the weights of each kind add to one.

    Where the unlabelled rows' part without the positives among them falls below zero, only that part is followed, upwards.
    """
    p = features.sigmoid(z)
    as_negative = np.logaddexp(0, z)  # loss of calling a row negative
    rest = (per_row * as_negative)[~positive].sum() - prior * (per_row * as_negative)[positive].sum()
    up = np.where(positive, prior * per_row * (p - 1), 0)
    down = per_row * p * np.where(positive, -prior, 1)
    return up + down if rest >= 0 else -down


def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> tuple[features.Linear, float] | None:
    """Model and class prior; labels are read outside the held-out fold only."""
    # Neither the labels of held-out rows nor which of them have one may be known here, so unlabelled rows are taken from the other folds too.
    open_fold = features.fold(F.col("doc_id"), FOLDS) != HELD_OUT
    known = features.labelled(labels, "quality").filter(open_fold)
    trusted = known.filter("label = 1").select("doc_id")
    free = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter(open_fold).join(known, "doc_id", "left_anti")
    picked = (features.first_by_hash(trusted, bound).select("doc_id", F.lit(1).alias("label"))
              .union(features.first_by_hash(free.distinct(), bound).select("doc_id", F.lit(0).alias("label"))))
    sample = features.Sample.gather(picked, docs)
    if len(np.unique(sample.labels)) < 2:
        return None
    back = np.arange(len(sample)) % 3 == 0
    train, held = sample.part(~back), sample.part(back)
    if len(np.unique(held.labels)) < 2 or len(np.unique(train.labels)) < 2:
        train = held = sample
    share = 1 / np.bincount(train.labels, minlength=2)
    told = share[train.labels]
    weights, bias = features.descend(train, lambda z: told * (features.sigmoid(z) - train.labels), steps=40)
    margins = held.margins(weights, bias)
    prior = prior_bound(margins[held.labels == 1], margins[held.labels == 0])

    positive = sample.labels == 1
    per_row = 1 / np.bincount(sample.labels, minlength=2)[sample.labels]

    weights, bias = features.descend(sample, lambda z: risk_slopes(z, positive, per_row, prior), steps=STEPS, decay=1e-4)
    return features.Linear(weights.reshape(features.FAMILIES, -1).astype(np.float32), bias), prior


def _score(model: features.Linear | None):
    def run(parts):
        for batch in parts:
            for chunk in batches.chunks(batch.column("text")):
                score = model.probability(model.margins(chunk)) if model else np.full(len(chunk), 0.5)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(chunk.first, len(chunk)), pa.array(score)], ["doc_id", "score"])
    return run


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``docs``."""
    fitted = fit(docs, labels)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_score(fitted[0] if fitted else None), "doc_id long, score double").select(
        "doc_id", F.coalesce(features.fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
