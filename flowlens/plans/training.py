"""Training and tuning runs from start to end, each with one metrics document and one saved bundle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.labels import ANOMALY
from flowlens.operators import metrics, sampling
from flowlens.plans import evaluation, fusion, learning
from flowlens.plans.ingest import Build
from flowlens.sources import sinks


class Run(NamedTuple):
    """The fitted model, the document that was written, and the sizes of the parts or the draws of the search."""

    trained: learning.Trained
    document: DataFrame
    details: DataFrame


def train(df: DataFrame, folder: str, target: str = "class", settings: learning.ForestSettings | None = None,
          key: Sequence[str] | None = None, provenance: Sequence[str] = (), folds: int = learning.FOLDS,
          cv_rows: int | None = None, test: float = 0.2, val: float = 0.1, seed: int = 42) -> Run:
    """Split to files, cross-validate on training rows (all, or at most ``cv_rows``), fit on all of them, report on validation rows.

    ``folder`` gets ``splits``, ``model`` and ``metrics``. The document has ``cv_auc_mean``, ``cv_auc_std``, ``val_auc``,
    ``val_classification_report``, ``val_confusion_matrix`` and ``val_unlabelled``.
    """
    spark = df.sparkSession
    sinks.write_splits(sampling.stratified_split(df, target, test, val, key, seed), f"{folder}/splits")
    parts = spark.read.parquet(f"{folder}/splits")
    rows = parts.filter("split = 'train'").drop("split")
    hidden = [*provenance, *(key or ())]
    areas = learning.cross_validate(rows, target, folds, settings, key, provenance, cv_rows, seed=seed)
    trained = learning.fit(rows, target, settings, hidden)
    trained.save(f"{folder}/model")
    found = evaluation.evaluate(trained, parts.filter("split = 'val'").drop("split"), target).document
    summary = metrics.summary_over_folds(areas).first()
    document = found.select(
        F.lit(summary["auc_mean"]).alias("cv_auc_mean"), F.lit(summary["auc_std"]).alias("cv_auc_std"), F.col("auc").alias("val_auc"),
        F.col("classification_report").alias("val_classification_report"), F.col("confusion_matrix").alias("val_confusion_matrix"),
        F.col("unlabelled").alias("val_unlabelled"))
    sinks.write_metrics(document, f"{folder}/metrics")
    sizes = parts.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
    return Run(trained, spark.read.schema(document.schema).json(f"{folder}/metrics"), sizes)


def tune(datasets: Mapping[str, DataFrame | Build], folder: str, cap: int | None = None, draws: int = learning.SEARCH_DRAWS,
         folds: int = learning.SEARCH_FOLDS, space: Mapping[str, Sequence] = learning.SEARCH_SPACE,
         key: Sequence[str] | None = None, test: float = 0.2, seed: int = 42) -> Run:
    """Cap (if asked), fuse, encode, split 80/20, search on the training rows alone, report on the rest.

    ``folder`` gets ``splits``, ``model`` and ``metrics``; columns in ``key`` identify rows and are no features.
    """
    hidden = list(key or ())
    fused = fusion.fuse(datasets, cap, keys={name: hidden for name in datasets} if hidden else None, keep=hidden, seed=seed)
    encoded = fusion.encode_fused(fused, keep=("class", *hidden))
    split = fusion.split_fused(encoded, test, hidden or None, seed)
    sinks.write_splits(split, f"{folder}/splits")
    parts = fused.sparkSession.read.parquet(f"{folder}/splits")
    trained, table = learning.random_search(parts.filter("split = 'train'").drop("split"), encoded.features, "class", draws, folds, space,
                                            hidden or None, ANOMALY, seed=seed)
    trained.save(f"{folder}/model")
    document = evaluation.evaluate(trained, parts.filter("split = 'test'").drop("split")).document
    sinks.write_metrics(document, f"{folder}/metrics")
    return Run(trained, fused.sparkSession.read.schema(document.schema).json(f"{folder}/metrics"), table)
