"""Matching predictions to truth on all feature columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions import text
from flowlens.operators.sampling import repeat_rows


def _packed(df: DataFrame, features: Sequence[str], other: DataFrame) -> Column:
    """One struct key; equal fields match, missing ones match missing ones.

    Numbers are compared as doubles where the two sides differ in type, and −0 as 0.
    """
    fields = []
    for i, name in enumerate(features):
        mine, theirs = df.schema[name].dataType, other.schema[name].dataType
        value = text.col(name)
        if isinstance(mine, (T.DoubleType, T.FloatType)) or (
                mine != theirs and isinstance(mine, T.NumericType) and isinstance(theirs, T.NumericType)):
            value = value.cast("double") + F.lit(0.0)
        elif mine != theirs:
            value = value.cast("string")
        fields.append(value.alias(f"k{i}"))
    return F.struct(*fields)


def match_counts(predictions: DataFrame, truth: DataFrame, features: Sequence[str], label: str,
                 outputs: Sequence[str] = ("prediction",)) -> DataFrame:
    """Distinct (features, outputs, true label) with ``pairs``, the number of joined rows.

    Both sides are counted before the join, so copies of a feature row cost one row each and
    never meet pair by pair.
    """
    left = (predictions.groupBy(_packed(predictions, features, truth).alias("_key"),
                                *[text.col(c) for c in outputs])
            .agg(F.count(F.lit(1)).alias("_predicted")))
    right = (truth.groupBy(_packed(truth, features, predictions).alias("_key"), text.col(label).alias("_true"))
             .agg(F.count(F.lit(1)).alias("_known")))
    true_name = f"{label}_true" if label in (*features, *outputs) else label
    return (left.join(right, "_key")
            .select(*[F.col(f"_key.k{i}").alias(name) for i, name in enumerate(features)],
                    *[text.col(c) for c in outputs], F.col("_true").alias(true_name),
                    (F.col("_predicted") * F.col("_known")).alias("pairs")))


def match_rows(predictions: DataFrame, truth: DataFrame, features: Sequence[str], label: str,
               outputs: Sequence[str] = ("prediction",)) -> DataFrame:
    """The joined rows themselves; large groups of copies unfold in pieces over many tasks.

    Two groups of n copies give n² rows, as any join of them does. Metrics need only the
    counts: use ``match_counts`` for them.
    """
    return repeat_rows(match_counts(predictions, truth, features, label, outputs), "pairs")


def coverage(predictions: DataFrame, matched: DataFrame) -> DataFrame:
    """One row (predictions, matched, complete): joined rows against prediction rows."""
    pairs = matched.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("matched"))
    rows = predictions.agg(F.count(F.lit(1)).alias("predictions"))
    return (rows.withColumn("matched", pairs.scalar())
            .withColumn("complete", F.col("predictions") == F.col("matched")))


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the left side without a partner."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")
