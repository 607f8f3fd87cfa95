"""Fusing labelled datasets into one feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions import labels, text
from flowlens.operators import encoding, harmonise, sampling
from flowlens.plans.ingest import Build

# Rows taken of each dataset for training and for tuning.
TRAINING_CAP = 50_000
TUNING_CAP = 20_000


@dataclass
class Fused:
    """Encoded features with their class, and the feature order a model must keep."""

    table: DataFrame
    features: list[str]
    dropped: list[str]


def fuse(datasets: Mapping[str, DataFrame | Build], cap: int | None = None, label: str = "class",
         keys: Mapping[str, Sequence[str]] | None = None, provenance: Sequence[str] = (),
         keep: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """Datasets with lower-case class and ``dataset``, united by column name.

    All rows are taken unless ``cap`` bounds the rows of each dataset (``TRAINING_CAP`` and ``TUNING_CAP`` are the usual bounds).
    A dataset may be a ``Build``: its source label columns never become features. ``provenance`` names more
    such columns, of plain tables; ``keys`` gives the
    identifying columns of a dataset, used for sampling only unless kept by ``keep``.
    """
    parts = []
    for name, dataset in datasets.items():
        df, own = (dataset.table, dataset.source_labels) if isinstance(dataset, Build) else (dataset, [])
        harmonise.require_column(df, label)
        key = (keys or {}).get(name)
        taken = sampling.cap_rows(df, cap, (), key, seed) if cap is not None else df
        target = F.lower(text.col(label).cast("string")).alias("_class")
        hidden = {*harmonise.NON_FEATURES, "source_label", label, *provenance, *own}
        features = [text.col(c) for c in taken.columns if c not in hidden or c in keep]
        parts.append(taken.select(*features, target).withColumn("dataset", F.lit(name))
                     .withColumnRenamed("_class", "class"))
    return harmonise.union_by_name(*parts)


def encode_fused(fused: DataFrame, limit: int = encoding.MAX_CATEGORIES, count_null: bool = True,
                 keep: Sequence[str] = ("class",)) -> Fused:
    """Numeric columns cleaned, small categories as dummies, large ones dropped."""
    numbers, categories = harmonise.feature_types(fused, exclude=keep)
    dummies = encoding.fit_dummies(fused, categories, limit, count_null)
    table = encoding.encode(fused, numbers, dummies, keep)
    return Fused(table, [*numbers, *dummies.names()], dummies.dropped)


def split_fused(fused: Fused, test: float = 0.2, key: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    known = fused.table.filter(F.col("class").isin(labels.NORMAL, labels.ANOMALY))
    return sampling.stratified_split(known, "class", test, key=key, seed=seed)
