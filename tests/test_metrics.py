import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from flowlens.operators import cumulative, metrics, selection, threshold


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([("anomaly", "anomaly"), ("anomaly", "normal"), ("normal", "normal"), ("normal", "normal")], "t string, p string")


def test_confusion_and_binary_metrics(pairs):
    counts = metrics.confusion_counts(pairs, "t", "p")
    assert [tuple(r) for r in metrics.confusion_matrix(counts).collect()] == [("anomaly", 1, 1), ("normal", 0, 2)]
    row = metrics.binary_metrics(counts).first()
    assert (row["precision"], row["recall"], round(row["f1"], 4), row["accuracy"]) == (1.0, 0.5, 0.6667, 0.75)


def test_no_predicted_positive_gives_zero(spark):
    df = spark.createDataFrame([("anomaly", "normal"), ("normal", "normal")], "t string, p string")
    row = metrics.binary_metrics(metrics.confusion_counts(df, "t", "p")).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_confusion_grid_shows_zero_pairs(pairs):
    grid = {(r["y_true"], r["y_pred"]): r["n"] for r in metrics.confusion_grid(metrics.confusion_counts(pairs, "t", "p")).collect()}
    assert grid == {("anomaly", "anomaly"): 1, ("anomaly", "normal"): 1, ("normal", "anomaly"): 0, ("normal", "normal"): 2}


def test_report_agrees_with_spark_evaluator(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(float(rng.randrange(3)), float(rng.randrange(3))) for _ in range(500)], "t double, p double")
    report = {r["label"]: r for r in metrics.classification_report(metrics.confusion_counts(
        df.select(F.col("t").cast("string").alias("t"), F.col("p").cast("string").alias("p")), "t", "p")).collect()}
    judge = MulticlassClassificationEvaluator(labelCol="t", predictionCol="p")
    assert math.isclose(report["accuracy"]["f1"], judge.setMetricName("accuracy").evaluate(df))
    assert math.isclose(report["weighted avg"]["f1"], judge.setMetricName("f1").evaluate(df))
    assert math.isclose(report["weighted avg"]["precision"], judge.setMetricName("weightedPrecision").evaluate(df))
    assert report["macro avg"]["support"] == 500


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0.8, True), (0.5, True), (0.5, False), (0.2, False)], "s double, y boolean")
    assert metrics.roc_auc(metrics.score_counts(df, "s", F.col("y"))).first()["auc"] == 0.875


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    rows = [(round(min(1.0, max(0.0, rng.gauss(0.6 if y else 0.4, 0.2))), 3), y) for y in (rng.random() < 0.3 for _ in range(3000))]
    return spark.createDataFrame(rows, "s double, y boolean")


def test_auc_agrees_with_spark_evaluator_and_cells(scored):
    counts = metrics.score_counts(scored, "s", F.col("y"))
    whole = metrics.roc_auc(counts).first()["auc"]
    known = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="l", numBins=0).evaluate(scored.withColumn("l", F.col("y").cast("double")))
    assert math.isclose(whole, known, abs_tol=1e-12)
    bounds = cumulative.cell_bounds(counts, "score", cell_values=50)
    assert len(bounds) > 5
    assert math.isclose(metrics.roc_auc(counts, bounds=bounds).first()["auc"], whole, abs_tol=1e-12)


def test_roc_points_and_corners_are_the_same_with_cells(scored):
    counts = metrics.score_counts(scored, "s", F.col("y"))
    bounds = cumulative.cell_bounds(counts, "score", cell_values=50)
    for drop in (False, True):
        whole = sorted(map(tuple, metrics.roc_points(counts, drop_intermediate=drop).collect()))
        assert whole == sorted(map(tuple, metrics.roc_points(counts, bounds=bounds, drop_intermediate=drop).collect()))
        assert whole[0][1:] == (1.0, 1.0)
    assert len(whole) < counts.count()


def test_auc_needs_both_classes(spark):
    df = spark.createDataFrame([(0.1, True)], "s double, y boolean")
    assert metrics.roc_auc(metrics.score_counts(df, "s", F.col("y"))).first()["auc"] is None


def test_one_against_rest_by_group_matches_single_runs(spark):
    df = spark.createDataFrame([("a", 0.9, 0.1), ("a", 0.4, 0.6), ("b", 0.5, 0.5), ("b", 0.2, 0.8)], "t string, pa double, pb double")
    per_label = {r["label"]: r["auc"] for r in metrics.roc_auc_ovr(df, "t", {"a": F.col("pa"), "b": F.col("pb")}).collect()}
    assert per_label == {"a": 0.75, "b": 0.75}


@pytest.mark.parametrize("q, expected", [(0.99, 5.0), (0.5, 3.0)])
def test_lower_quantile(spark, q, expected):
    assert selection.lower_quantile(spark.range(7).select(F.col("id").cast("double").alias("v")), "v", q).first()["value"] == expected


def test_lower_quantile_edge_cases(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"))
    assert selection.lower_quantile(df, "v", 0.5).first()["value"] == 49.0
    assert tuple(selection.lower_quantile(df.filter("v < 0"), "v", 0.5).first()) == (None, 0)
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (2.0,)], "v double")
    assert tuple(selection.lower_quantile(odd, "v", 0.99).first()) == (2.0, 1)


def test_narrowing_is_exact(spark):
    """A limit far below the row count forces the search that large columns take."""
    rng = random.Random(9)
    values = [rng.choice([0.5, rng.gauss(0, 1e-6), rng.lognormvariate(0, 3)]) for _ in range(30000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(8)
    ordered = sorted(values)
    wanted = {str(q): (F.col("v"), selection.lower_rank(q)) for q in (0.0, 0.2, 0.5, 0.9, 0.99, 1.0)}
    found = {r["name"]: r["value"] for r in selection.order_statistics(df, wanted, order_rows=200).collect()}
    assert found == {name: ordered[math.floor(float(name) * (len(values) - 1))] for name in wanted}


def test_medians_average_the_middle_pair(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 7), (3.0, None), (10.0, None)], "a double, b int")
    assert selection.medians(df, {"a": F.col("a"), "b": F.col("b"), "none": F.lit(None).cast("double")}) == {"a": 2.5, "b": 6.0, "none": None}


def test_smart_threshold(spark):
    def run(values):
        return threshold.smart_threshold(spark.createDataFrame([(v,) for v in values], "anomaly_score double"), fallback=0.45).first()["threshold"]

    assert run([]) == 0.45
    assert run([0.1, 0.1]) == 0.3
    assert run([0.99, 0.99]) == 0.95
    assert math.isclose(run([0.4, 0.6]), 0.5 + 0.75 * 0.1)


@pytest.mark.parametrize("order_rows", [10**6, 1])
def test_calibration(spark, order_rows):
    def run(rows):
        return tuple(threshold.calibrate(spark.createDataFrame(rows, "score double, label string"), order_rows=order_rows).first())

    assert run([(0.8, "normal"), (0.9, "Benign "), (0.1, "attack"), (0.2, "outlier")]) == (0.1, 2, True)
    assert run([(0.0, "normal"), (0.7, "other")]) == (0.01, 1, False)
    assert run([(0.2, "normal"), (0.3, "normal"), (0.9, "anomaly")]) == (0.2, 2, False)
    empty = spark.createDataFrame([(0.5, "anomaly")], "score double, label string")
    with pytest.raises(ValueError):
        threshold.require_normal_rows(threshold.calibrate(empty))


def test_metrics_document(pairs):
    document = metrics.metrics_document(metrics.confusion_counts(pairs, "t", "p")).first()
    assert document["confusion_matrix"] == [[1, 1], [0, 2]]
    assert document["classification_report"]["anomaly"]["recall"] == 0.5
