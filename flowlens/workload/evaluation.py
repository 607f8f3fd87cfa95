"""Metrics, curves, thresholds, and matching of predictions to truth."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions import labels, scores
from flowlens.operators import matching, metrics, sampling, selection, threshold
from flowlens.plans import evaluation
from flowlens.workload import bindings as b

# --- confusion tables ----------------------------------------------------------------------


def counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_counts(b.detections(spark, sf), "class", "prediction")


def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(counts(spark, sf))


CONFUSION_MATRIX = f"""WITH {b.DETECTIONS}
SELECT class AS y_true, count(*) FILTER (prediction = 'anomaly') AS pred_anomaly,
       count(*) FILTER (prediction = 'normal') AS pred_normal FROM detections GROUP BY class"""


def binary_metrics(spark, sf):
    found = metrics.binary_metrics(counts(spark, sf))
    return found.select("n", "tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


BINARY_METRICS = f"""WITH {b.DETECTIONS}, cells AS (
    SELECT count(*) AS n, count(*) FILTER (class = 'anomaly' AND prediction = 'anomaly') AS tp,
           count(*) FILTER (class = 'normal' AND prediction = 'anomaly') AS fp,
           count(*) FILTER (class = 'anomaly' AND prediction = 'normal') AS fn,
           count(*) FILTER (class = 'normal' AND prediction = 'normal') AS tn FROM detections)
SELECT n, tp, fp, fn, tn, round((tp + tn) / n, 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM cells"""

# A five-class guess of the event type from the value, so that every label is confused.
GUESS_SQL = """CASE WHEN value < 10 THEN 'click' WHEN value < 25 THEN 'error' WHEN value < 50 THEN 'purchase'
                    WHEN value < 100 THEN 'signup' ELSE 'view' END"""


def guesses(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "events").select("event_type", F.expr(GUESS_SQL).alias("guess"))


def confusion_grid(spark, sf):
    """Label pairs including those that never occur: alerts can only be guessed as such."""
    rows = b.analyses(spark, sf).select("severity", F.col("predicted_label"))
    return metrics.confusion_grid(metrics.confusion_counts(rows, "severity", "predicted_label"))


CONFUSION_GRID = f"""WITH {b.ANALYSES}, pairs AS (
    SELECT severity AS y_true, predicted_label AS y_pred, count(*) AS n FROM analyses GROUP BY ALL), names AS (
    SELECT y_true AS name FROM pairs UNION SELECT y_pred FROM pairs)
SELECT t.name AS y_true, p.name AS y_pred, coalesce(n, 0) AS n
FROM names t CROSS JOIN names p LEFT JOIN pairs ON y_true = t.name AND y_pred = p.name"""


def _report(counted: DataFrame) -> DataFrame:
    found = metrics.classification_report(counted)
    return found.select("label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


def classification_report(spark, sf):
    return _report(counts(spark, sf))


def _report_sql(source: str, truth: str, predicted: str) -> str:
    return f"""pairs AS (SELECT {truth} AS t, {predicted} AS p FROM {source}), names AS (
    SELECT t AS label FROM pairs UNION SELECT p FROM pairs), cells AS (
    SELECT label, (SELECT count(*) FROM pairs WHERE t = label AND p = label) AS hits,
           (SELECT count(*) FROM pairs WHERE t = label) AS support, (SELECT count(*) FROM pairs WHERE p = label) AS predicted
    FROM names), rates AS (
    SELECT label, coalesce(hits / nullif(predicted, 0), 0) AS precision, coalesce(hits / nullif(support, 0), 0) AS recall,
           2 * hits / (support + predicted) AS f1, support, hits FROM cells)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rates
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hits) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM rates
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM rates
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM rates"""


CLASSIFICATION_REPORT = f"WITH {b.DETECTIONS}, {_report_sql('detections', 'class', 'prediction')}"


def classification_report_multi(spark, sf):
    return _report(metrics.confusion_counts(guesses(spark, sf), "event_type", "guess"))


CLASSIFICATION_REPORT_MULTI = f"""WITH guesses AS (SELECT event_type, {GUESS_SQL} AS guess FROM events),
{_report_sql('guesses', 'event_type', 'guess')}"""


def metrics_document(spark, sf):
    """The JSON document read back: one figure of each part."""
    counted = counts(spark, sf)
    auc = metrics.roc_auc(score_counts(spark, sf))
    document = metrics.metrics_document(counted, auc)
    report = F.col("classification_report")
    return document.select(report["anomaly"]["support"].alias("anomaly_support"),
                           F.round(report["accuracy"]["f1-score"], 6).alias("accuracy"),
                           F.get(F.get("confusion_matrix", F.lit(0)), F.lit(1)).alias("missed"), F.round("auc", 6).alias("auc"))


# --- ROC -----------------------------------------------------------------------------------


def score_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.score_counts(b.flows(spark, sf), "anomaly_score", F.col("class") == labels.ANOMALY)


def auc_binary(spark, sf):
    found = metrics.roc_auc(score_counts(spark, sf))
    return found.select(F.round("auc", 6).alias("auc"), "positives", "negatives")


def _auc_sql(rows: str, by: str = "") -> str:
    """``rows`` must give score, positive and, if grouped, the group column."""
    head, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    return f"""counted AS (SELECT {head}score, count(*) FILTER (positive) AS pos, count(*) FILTER (NOT positive) AS neg
    FROM ({rows}) GROUP BY {head}score), ranked AS (
    SELECT *, sum(neg) OVER ({part}ORDER BY score) AS upto FROM counted), areas AS (
    SELECT {head}sum(pos * (upto - neg / 2)) / nullif(CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE), 0) AS auc,
           CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
    FROM ranked {f'GROUP BY {by}' if by else ''})"""


FLOW_SCORES = "SELECT anomaly_score AS score, class = 'anomaly' AS positive FROM flows"
AUC_BINARY = f"WITH {b.FLOWS}, {_auc_sql(FLOW_SCORES)} SELECT round(auc, 6) AS auc, positives, negatives FROM areas"
METRICS_DOCUMENT = f"""WITH {b.DETECTIONS}, {_auc_sql(FLOW_SCORES)}
SELECT count(*) FILTER (class = 'anomaly') AS anomaly_support, round(count(*) FILTER (class = prediction) / count(*), 6) AS accuracy,
       count(*) FILTER (class = 'anomaly' AND prediction = 'normal') AS missed, (SELECT round(auc, 6) FROM areas) AS auc
FROM detections"""

# Class scores of three classes from quantity, discount and tax of line items.
CLASS_SCORES = {"A": "l_quantity / 100", "N": "l_discount * 5", "R": "l_tax * 10"}


def auc_ovr(spark, sf):
    rows = b.table(spark, sf, "lineitem")
    per_label = metrics.roc_auc_ovr(rows, "l_returnflag", {c: F.expr(e) for c, e in CLASS_SCORES.items()})
    return per_label.select("label", F.round("auc", 6).alias("auc"), "positives", "negatives")


OVR_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS label, {e} AS score, l_returnflag = '{c}' AS positive FROM lineitem" for c, e in CLASS_SCORES.items())
AUC_OVR = f"WITH {_auc_sql(OVR_ROWS, 'label')} SELECT label, round(auc, 6) AS auc, positives, negatives FROM areas"


def auc_ovr_mean(spark, sf):
    rows = b.table(spark, sf, "lineitem")
    per_label = metrics.roc_auc_ovr(rows, "l_returnflag", {c: F.expr(e) for c, e in CLASS_SCORES.items()})
    return metrics.mean_auc(per_label).select(F.round("auc", 6).alias("auc"))


AUC_OVR_MEAN = f"WITH {_auc_sql(OVR_ROWS, 'label')} SELECT round(avg(auc), 6) AS auc FROM areas"


def _rounded_points(points: DataFrame) -> DataFrame:
    return points.select("threshold", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


def roc_points(spark, sf):
    return _rounded_points(metrics.roc_points(score_counts(spark, sf)))


CURVE = f"""{b.FLOWS}, counted AS (
    SELECT score, count(*) FILTER (positive) AS pos, count(*) FILTER (NOT positive) AS neg FROM ({FLOW_SCORES}) GROUP BY score), curve AS (
    SELECT score AS threshold, sum(neg) OVER down / sum(neg) OVER () AS fpr, sum(pos) OVER down / sum(pos) OVER () AS tpr,
           pos, neg, lead(pos) OVER down AS pos_next, lead(neg) OVER down AS neg_next, row_number() OVER down AS place
    FROM counted WINDOW down AS (ORDER BY score DESC))"""
ROC_POINTS = f"WITH {CURVE} SELECT threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM curve"


def roc_corners(spark, sf):
    return _rounded_points(metrics.roc_points(score_counts(spark, sf), drop_intermediate=True))


ROC_CORNERS = f"""WITH {CURVE} SELECT threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM curve
WHERE place = 1 OR pos_next IS NULL OR pos <> pos_next OR neg <> neg_next"""


def fold_auc_summary(spark, sf):
    """Mean and deviation of the area over five stratified folds."""
    folded = sampling.stratified_folds(b.flows(spark, sf).select("event_id", "class", "anomaly_score"), 5, key=["event_id"])
    counted = metrics.score_counts(folded, "anomaly_score", F.col("class") == labels.ANOMALY, ["fold"])
    found = metrics.summary_over_folds(metrics.roc_auc(counted, ["fold"]))
    return found.select(F.round("auc_mean", 6).alias("auc_mean"), F.round("auc_std", 6).alias("auc_std"), "folds")


FOLDED = f"""{b.FLOWS}, ranked_rows AS (
    SELECT *, row_number() OVER (PARTITION BY class ORDER BY md5('42|' || event_id)) - 1 AS place FROM flows), starts AS (
    SELECT class, coalesce(sum(n) OVER (ORDER BY class ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS class_start
    FROM (SELECT class, count(*) AS n FROM flows GROUP BY class)), folded AS (
    SELECT r.*, CAST((class_start + place) % 5 AS INTEGER) AS fold FROM ranked_rows r JOIN starts s ON r.class = s.class)"""
FOLD_AUC_SUMMARY = f"""WITH {FOLDED}, {_auc_sql("SELECT fold, anomaly_score AS score, class = 'anomaly' AS positive FROM folded", 'fold')}
SELECT round(avg(auc), 6) AS auc_mean, round(stddev_pop(auc), 6) AS auc_std, count(*) AS folds FROM areas"""

# --- thresholds ----------------------------------------------------------------------------


def lower_quantile(spark, sf):
    """Quantiles of event values and line item prices by the lower rank rule."""
    events = selection.order_statistics(b.table(spark, sf, "events"), {
        "events 0.5": (F.col("value"), selection.lower_rank(0.5)), "events 0.99": (F.col("value"), selection.lower_rank(0.99))})
    items = selection.order_statistics(b.table(spark, sf, "lineitem"), {
        "lineitem 0.99": (F.col("l_extendedprice"), selection.lower_rank(0.99)),
        "lineitem 0": (F.col("l_extendedprice"), selection.lower_rank(0.0)),
        "lineitem 1": (F.col("l_extendedprice"), selection.lower_rank(1.0))})
    return events.unionByName(items)


def _quantile_sql(name: str, column: str, table: str, q: float) -> str:
    return f"""SELECT '{name} {q:g}' AS name, list_sort(list({column}))[CAST(floor({q} * (count(*) - 1)) AS BIGINT) + 1] AS value,
       count(*) AS n FROM {table}"""


LOWER_QUANTILE = " UNION ALL ".join([
    _quantile_sql("events", "value", "events", 0.5), _quantile_sql("events", "value", "events", 0.99),
    _quantile_sql("lineitem", "l_extendedprice", "lineitem", 0.99), _quantile_sql("lineitem", "l_extendedprice", "lineitem", 0),
    _quantile_sql("lineitem", "l_extendedprice", "lineitem", 1)])


def smart_threshold(spark, sf):
    past = threshold.recent(b.analyses(spark, sf), 1000)
    return threshold.smart_threshold(past).select(F.round("threshold", 6).alias("threshold"), "n")


SMART_THRESHOLD = f"""WITH {b.ANALYSES}, past AS (SELECT * FROM analyses ORDER BY created_at DESC, id LIMIT 1000)
SELECT round(least(0.95, greatest(0.3, avg(anomaly_score) + 0.75 * stddev_pop(anomaly_score))), 6) AS threshold, count(*) AS n FROM past"""

CALIBRATION_LABEL = """CASE event_type WHEN 'error' THEN ' Attack' WHEN 'signup' THEN 'unknown' WHEN 'view' THEN 'BENIGN' ELSE 'normal' END"""


def calibration_rows(spark: SparkSession, sf: str, upside_down: bool) -> DataFrame:
    """Event scores with labels in mixed spelling; upside down, anomalies score lowest."""
    score = F.col("value") / (F.col("value") + 50)
    moved = F.when(F.col("event_type") == "error", score / 2 if upside_down else (score + 1) / 2).otherwise(
        (score + 1) / 2 if upside_down else score / 2)
    return b.table(spark, sf, "events").select(F.round(moved, 6).alias("score"), F.expr(CALIBRATION_LABEL).alias("label"))


def calibrated_threshold(spark, sf):
    return threshold.calibrate(calibration_rows(spark, sf, False))


def calibrated_threshold_inverted(spark, sf):
    return threshold.calibrate(calibration_rows(spark, sf, True))


def _calibration_sql(error: str, other: str) -> str:
    return f"""WITH rows AS (
    SELECT CASE WHEN event_type = 'error' THEN 'anomaly' WHEN event_type = 'signup' THEN NULL ELSE 'normal' END AS kind,
           round(CASE WHEN event_type = 'error' THEN {error} ELSE {other} END, 6) AS score
    FROM (SELECT event_type, value / (value + 50) AS s FROM events)), lists AS (
    SELECT list_sort(list(score) FILTER (kind = 'normal')) AS n, list_sort(list(score) FILTER (kind = 'anomaly')) AS a,
           list_sort(list(1 - score) FILTER (kind = 'normal')) AS i FROM rows), medians AS (
    SELECT *, n[CAST(floor(0.5 * (len(n) - 1)) AS BIGINT) + 1] > a[CAST(floor(0.5 * (len(a) - 1)) AS BIGINT) + 1] AS inverted FROM lists)
SELECT round(least(0.99, greatest(0.01, (CASE WHEN inverted THEN i ELSE n END)[CAST(floor(0.99 * (len(n) - 1)) AS BIGINT) + 1])), 6) AS threshold,
       CAST(len(n) AS BIGINT) AS sample_count, inverted FROM medians"""


CALIBRATED_THRESHOLD = _calibration_sql("(s + 1) / 2", "s / 2")
CALIBRATED_THRESHOLD_INVERTED = _calibration_sql("s / 2", "(s + 1) / 2")

# --- predictions against truth -------------------------------------------------------------

KEYS = ["l_quantity", "l_discount", "tax"]


def item_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Many copies per feature row, and missing feature values."""
    return b.table(spark, sf, "lineitem").select(
        "l_quantity", "l_discount", F.when(F.col("l_linestatus") == "F", F.col("l_tax")).alias("tax"),
        F.when(F.col("l_extendedprice") > 50000, labels.ANOMALY).otherwise(labels.NORMAL).alias("prediction"),
        F.round(F.col("l_extendedprice") / 200000, 6).alias("anomaly_score"))


def item_truth(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "lineitem").select(
        "l_quantity", "l_discount", F.when(F.col("l_linestatus") == "F", F.col("l_tax")).alias("tax"),
        F.when(F.col("l_returnflag") == "A", "Anomaly").otherwise("Normal").alias("class"))


def match_counts(spark, sf):
    return matching.match_counts(item_predictions(spark, sf), item_truth(spark, sf), KEYS, "class")


MATCHED = """sides AS (
    SELECT l_quantity, l_discount, CASE WHEN l_linestatus = 'F' THEN l_tax END AS tax,
           CASE WHEN l_extendedprice > 50000 THEN 'anomaly' ELSE 'normal' END AS prediction,
           CASE WHEN l_returnflag = 'A' THEN 'Anomaly' ELSE 'Normal' END AS class FROM lineitem), matched AS (
    SELECT p.l_quantity, p.l_discount, p.tax, p.prediction, t.class, p.n * t.n AS pairs
    FROM (SELECT l_quantity, l_discount, tax, prediction, count(*) AS n FROM sides GROUP BY ALL) p
    JOIN (SELECT l_quantity, l_discount, tax, class, count(*) AS n FROM sides GROUP BY ALL) t
      ON p.l_quantity = t.l_quantity AND p.l_discount = t.l_discount AND p.tax IS NOT DISTINCT FROM t.tax)"""
MATCH_COUNTS = f"WITH {MATCHED} SELECT * FROM matched"


def match_coverage(spark, sf):
    """Predictions of all items against the truth of finished ones."""
    known = item_truth(spark, sf).filter("tax is not null")
    predicted = item_predictions(spark, sf)
    return matching.coverage(predicted, matching.match_counts(predicted, known, KEYS, "class"))


MATCH_COVERAGE = f"""WITH {MATCHED}
SELECT (SELECT count(*) FROM lineitem) AS predictions, CAST(sum(pairs) AS BIGINT) AS matched,
       (SELECT count(*) FROM lineitem) = sum(pairs) AS complete FROM matched WHERE tax IS NOT NULL"""


def matched_metrics(spark, sf):
    found = evaluation.evaluate_against_truth(item_predictions(spark, sf), item_truth(spark, sf))["metrics"]
    return found.select("n", "tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


MATCHED_METRICS = f"""WITH {MATCHED}, cells AS (
    SELECT sum(pairs) AS n, sum(pairs) FILTER (class = 'Anomaly' AND prediction = 'anomaly') AS tp,
           sum(pairs) FILTER (class = 'Normal' AND prediction = 'anomaly') AS fp,
           sum(pairs) FILTER (class = 'Anomaly' AND prediction = 'normal') AS fn,
           sum(pairs) FILTER (class = 'Normal' AND prediction = 'normal') AS tn FROM matched)
SELECT CAST(n AS BIGINT) AS n, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
       round((tp + tn) / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
       round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM cells"""


def matched_matrix(spark, sf):
    return evaluation.evaluate_against_truth(item_predictions(spark, sf), item_truth(spark, sf))["matrix"]


MATCHED_MATRIX = f"""WITH {MATCHED}
SELECT lower(class) AS y_true, CAST(sum(pairs) FILTER (prediction = 'anomaly') AS BIGINT) AS pred_anomaly,
       CAST(sum(pairs) FILTER (prediction = 'normal') AS BIGINT) AS pred_normal FROM matched GROUP BY 1"""


def document_truth(spark: SparkSession, sf: str) -> DataFrame:
    documents = b.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(b.table(spark, sf, "labels").select("doc_id", "toxic", "quality"), "doc_id", "left")


def truth_pred_join(spark, sf):
    """Documents matched by language, source and known quality; copies are counted."""
    rows = document_truth(spark, sf)
    predicted = rows.select("lang", "source", "quality", F.when(F.col("n_chars") > 2000, "long").otherwise("short").alias("prediction"))
    truth = rows.select("lang", "source", "quality", F.col("toxic").cast("string").alias("class"))
    return matching.match_counts(predicted, truth, ["lang", "source", "quality"], "class")


TRUTH_PRED_JOIN = """WITH rows AS (
    SELECT lang, source, quality, CASE WHEN n_chars > 2000 THEN 'long' ELSE 'short' END AS prediction, CAST(toxic AS VARCHAR) AS class
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT p.lang, p.source, p.quality, p.prediction, t.class, count(*) AS pairs FROM rows p JOIN rows t
  ON p.lang = t.lang AND p.source = t.source AND p.quality IS NOT DISTINCT FROM t.quality
GROUP BY ALL"""

NAMES = ("confusion_matrix", "binary_metrics", "confusion_grid", "classification_report", "classification_report_multi",
         "metrics_document", "auc_binary", "auc_ovr", "auc_ovr_mean", "roc_points", "roc_corners", "fold_auc_summary",
         "lower_quantile", "smart_threshold", "calibrated_threshold", "calibrated_threshold_inverted", "match_counts",
         "match_coverage", "matched_metrics", "matched_matrix", "truth_pred_join")
QUERIES = {name: globals()[name] for name in NAMES}
ORACLES = {name: globals()[name.upper()] for name in NAMES}
