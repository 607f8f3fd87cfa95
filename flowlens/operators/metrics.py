"""Classification metrics, all derived from small tables of counts.

The confusion table has one row per pair of labels, the ROC tables one per distinct score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions.labels import ANOMALY, NORMAL
from flowlens.operators import cumulative
from flowlens.session import stage


def ratio(part: Column, whole: Column) -> Column:
    """Quotient, 0 when the divisor is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / F.when(whole != 0, whole))


def confusion_counts(df: DataFrame, truth: str, predicted: str, weight: str | None = None) -> DataFrame:
    """(y_true, y_pred, n) for the pairs that occur."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(F.col(truth).alias("y_true"), F.col(predicted).alias("y_pred")).agg(n.alias("n"))


def confusion_grid(counts: DataFrame) -> DataFrame:
    """Counts of all label pairs, 0 where a pair does not occur."""
    seen = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("y_true", "y_pred")))))
    cells = F.map_from_entries(F.collect_list(F.struct(
        F.struct("y_true", "y_pred").alias("key"), F.col("n").alias("value"))))
    # Labels are few, so all cells fit in one row.
    return (counts.agg(seen.alias("_labels"), cells.alias("_cells"))
            .select("_labels", "_cells", F.explode("_labels").alias("y_true"))
            .select("_cells", "y_true", F.explode("_labels").alias("y_pred"))
            .select("y_true", "y_pred", F.coalesce(
                F.col("_cells")[F.struct("y_true", "y_pred")], F.lit(0)).alias("n")))


def confusion_matrix(counts: DataFrame, labels: Sequence[str] = (ANOMALY, NORMAL)) -> DataFrame:
    """One row per true label in the given order, one ``pred_<label>`` column per prediction."""
    order = F.lit(0)
    for i, label in enumerate(labels):
        order = F.when(F.col("y_true") == label, i).otherwise(order)
    sums = [F.coalesce(F.sum(F.when(F.col("y_pred") == label, F.col("n"))), F.lit(0)).alias(f"pred_{label}")
            for label in labels]
    return (counts.filter(F.col("y_true").isin(*labels)).groupBy("y_true").agg(*sums)
            .orderBy(order))


def binary_metrics(counts: DataFrame, positive: str = ANOMALY) -> DataFrame:
    """One row of tp, fp, fn, tn, accuracy, precision, recall and F1 of the positive label."""
    is_true, is_pred = F.col("y_true") == positive, F.col("y_pred") == positive

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    cells = counts.agg(total(is_true & is_pred).alias("tp"), total(~is_true & is_pred).alias("fp"),
                       total(is_true & ~is_pred).alias("fn"), total(~is_true & ~is_pred).alias("tn"),
                       total(F.col("y_true") == F.col("y_pred")).alias("_hits"), F.sum("n").alias("n"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return cells.select("n", "tp", "fp", "fn", "tn", ratio(F.col("_hits"), F.col("n")).alias("accuracy"),
                        ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
                        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def label_metrics(counts: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support, hits), one row per label."""
    same = F.col("y_true") == F.col("y_pred")
    sides = F.array(
        F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(same, F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("hits")))
    sums = (counts.select(F.inline(sides)).groupBy("label")
            .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")]))
    return sums.select("label", ratio(F.col("hits"), F.col("predicted")).alias("precision"),
                       ratio(F.col("hits"), F.col("support")).alias("recall"),
                       ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
                       "support", "hits")


def classification_report(counts: DataFrame) -> DataFrame:
    """Rows per label, then accuracy, macro avg and weighted avg.

    The accuracy row holds its value in f1 and leaves precision and recall empty.
    """
    n = F.sum("support")

    def weighted(name: str) -> Column:
        return ratio(F.sum(F.col(name) * F.col("support")), n)

    def row(label: Column, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(label.alias("label"), precision.alias("precision"), recall.alias("recall"),
                        f1.alias("f1"), support.cast("long").alias("support"))

    nothing = F.lit(None).cast("double")
    lines = F.collect_list(row(F.col("label"), *[F.col(c) for c in ("precision", "recall", "f1", "support")]))
    closing = F.array(
        row(F.lit("accuracy"), nothing, nothing, ratio(F.sum("hits"), n), n),
        row(F.lit("macro avg"), F.avg("precision"), F.avg("recall"), F.avg("f1"), n),
        row(F.lit("weighted avg"), weighted("precision"), weighted("recall"), weighted("f1"), n))
    return (label_metrics(counts).agg(F.array_sort(lines).alias("lines"), closing.alias("closing"))
            .select(F.inline(F.concat("lines", "closing"))))


def score_counts(df: DataFrame, score: str, positive: Column, by: Sequence[str] = ()) -> DataFrame:
    """(score, pos, neg) per distinct score; copies of a score collapse before the shuffle."""
    return (df.filter(F.col(score).isNotNull() & positive.isNotNull())
            .groupBy(*by, F.col(score).cast("double").alias("score"))
            .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")))


def _ordered_input(counts: DataFrame, bounds: Sequence[float] | None) -> tuple[DataFrame, Sequence[float]]:
    """Counts and their cells. The counts are stored first: whatever scored the rows runs once."""
    if bounds is not None:
        return counts, bounds
    stored = stage(counts, "scores")
    return stored, cumulative.cell_bounds(stored, "score")


def roc_auc(counts: DataFrame, by: Sequence[str] = (), bounds: Sequence[float] | None = None) -> DataFrame:
    """Area under the ROC curve as a rank statistic, ties counted half; null without both classes."""
    counts, cells = _ordered_input(counts, bounds)
    ranked = cumulative.running_totals(counts, "score", ["neg"], by, cells, descending=False)
    pos, neg = F.sum(F.col("pos").cast("double")), F.sum(F.col("neg").cast("double"))
    beaten = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2.0))
    return ranked.groupBy(*by).agg(
        (beaten / F.when((pos > 0) & (neg > 0), pos * neg)).alias("auc"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))


def roc_auc_ovr(df: DataFrame, truth: str, proba: dict[str, Column]) -> DataFrame:
    """(label, auc) of each class against the rest."""
    cells = F.array(*[F.struct(F.lit(label).alias("label"), column.cast("double").alias("_score"),
                               (F.col(truth).cast("string") == label).alias("_positive"))
                      for label, column in proba.items()])
    flat = df.select(F.inline(cells))
    return roc_auc(score_counts(flat, "_score", F.col("_positive"), ["label"]), ["label"])


def mean_auc(per_label: DataFrame) -> DataFrame:
    """Unweighted mean over the classes, null if any class has no area."""
    return per_label.agg(F.when(F.count("auc") == F.count(F.lit(1)), F.avg("auc")).alias("auc"))


def roc_points(counts: DataFrame, by: Sequence[str] = (), bounds: Sequence[float] | None = None,
               drop_intermediate: bool = False) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score.

    ``drop_intermediate`` leaves out points on a straight line between their neighbours.
    """
    counts, cells = _ordered_input(counts, bounds)
    upto = cumulative.running_totals(counts, "score", ["pos", "neg"], by, cells)
    if drop_intermediate:
        upto = _corners(upto, by, cells)
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    if by:
        joined = upto.join(totals, list(by))
        pos, neg = F.col("_pos"), F.col("_neg")
    else:
        joined = upto
        pos, neg = totals.select("_pos").scalar(), totals.select("_neg").scalar()
    return joined.select(*by, F.col("score").alias("threshold"),
                         (F.col("neg_upto") / F.when(neg > 0, neg)).alias("fpr"),
                         (F.col("pos_upto") / F.when(pos > 0, pos)).alias("tpr"))


def _corners(upto: DataFrame, by: Sequence[str], cells: Sequence[float]) -> DataFrame:
    """First and last point, and those where the curve changes direction."""
    stepped = cumulative.with_next(upto, "score", ["pos", "neg"], by, cells)
    first = ((F.col("pos_upto") == F.col("pos")) & (F.col("neg_upto") == F.col("neg")))
    last = F.col("pos_next").isNull()
    turns = (F.col("pos") != F.col("pos_next")) | (F.col("neg") != F.col("neg_next"))
    return stepped.filter(first | last | turns)


def summary_over_folds(folds: DataFrame, value: str = "auc") -> DataFrame:
    """Mean and population deviation over the folds."""
    return folds.agg(F.avg(value).alias(f"{value}_mean"), F.stddev_pop(value).alias(f"{value}_std"),
                     F.count(value).alias("folds"))


def metrics_document(counts: DataFrame, auc: DataFrame | None = None) -> DataFrame:
    """One row: report by label, confusion matrix in label order, rows without a true label, and the area if given.

    Rows without a true label are counted in ``unlabelled`` and take no part in the figures.
    """
    missing = counts.filter("y_true is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    counts = counts.filter("y_true is not null")
    report = classification_report(counts).agg(F.map_from_entries(F.collect_list(F.struct(
        "label", F.struct("precision", "recall", F.col("f1").alias("f1-score"), "support")))).alias("classification_report"))
    in_row = Window.partitionBy("y_true").orderBy("y_pred").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    rows = confusion_grid(counts).select("y_true", F.collect_list("n").over(in_row).alias("cells")).distinct()
    matrix = rows.agg(F.transform(F.array_sort(F.collect_list(F.struct("y_true", "cells"))),
                                  lambda r: r["cells"]).alias("confusion_matrix"))
    document = report.withColumn("confusion_matrix", matrix.scalar()).withColumn("unlabelled", missing.scalar())
    return document.withColumn("auc", auc.select("auc").scalar()) if auc is not None else document
