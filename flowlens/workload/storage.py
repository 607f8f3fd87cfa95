"""Files, sinks and service tables: written, read back and counted, next to their SQL."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from flowlens.operators import cleaning, harmonise, metrics, threshold
from flowlens.plans import analysis, fusion, ingest
from flowlens.session import scratch_path
from flowlens.sources import files, service_tables, sinks
from flowlens.workload import bindings as b
from flowlens.workload.alerting import EFFECTIVE, todays_analysis
from flowlens.workload.evaluation import CLASS_SCORES
from flowlens.workload.preparation import SOURCES, sources

# --- scans ---------------------------------------------------------------------------------


def bom_scan(spark, sf):
    """Nations as a CSV whose header begins with a byte order mark and carries blanks."""
    path = scratch_path(spark, "bom")
    rows = b.table(spark, sf, "nation").select(F.concat_ws(",", "n_nationkey", "n_regionkey").alias("value"), F.lit(1).alias("at"))
    header = spark.createDataFrame([("﻿ n_nationkey ,n_regionkey", 0)], "value string, at int")
    header.union(rows).coalesce(1).sortWithinPartitions("at").select("value").write.text(path)
    found = harmonise.strip_headers(files.load_csv(spark, path))
    return found.select(F.col("n_nationkey").cast("long").alias("n_nationkey"), F.col("n_regionkey").cast("long").alias("n_regionkey"))


BOM_SCAN = "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation"


def head_scan(spark, sf):
    """Probing the first rows: never more than asked, all columns there."""
    probe = files.head(b.table(spark, sf, "lineitem"), 500)
    return probe.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(probe.columns)).cast("long").alias("columns"))


HEAD_SCAN = """SELECT least(500, (SELECT count(*) FROM lineitem)) AS rows,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM lineitem)) AS columns"""


def chunk_sample(spark, sf):
    """A tenth of every 5,000-row chunk of the line items as CSV files that follow each other: rows and kept rows per chunk, and the rows of the table."""
    path = scratch_path(spark, "items-csv")
    b.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", F.col("l_returnflag").alias("Label")).repartition(4).write.option("header", True).csv(path)
    built = ingest.build_nfuq(spark, path, 0.1, 5000)
    total = built.table.agg(F.count(F.lit(1))).scalar()
    return built.status.select("chunk", "status", "rows", "kept", total.alias("table_rows"))


CHUNK_SAMPLE = """WITH chunks AS (SELECT c.chunk, least(5000, n - 5000 * c.chunk) AS rows FROM (SELECT count(*) AS n FROM lineitem), range(100000) c(chunk) WHERE 5000 * c.chunk < n)
SELECT chunk, 'ok' AS status, rows, CAST(round_even(rows * 0.1, 0) AS BIGINT) AS kept, CAST(sum(round_even(rows * 0.1, 0)) OVER () AS BIGINT) AS table_rows FROM chunks"""


def paired_files(spark, sf):
    """Data files named after users, label files for some of them, paired by folder and name."""
    users = b.table(spark, sf, "events").select("user_id").distinct()
    name = F.concat(F.lit("/d"), (F.col("user_id") % 7).cast("string"), F.lit("/U"), F.col("user_id").cast("string"))
    listed = (users.select(F.concat(name, F.lit("_dataset.csv")).alias("path"))
              .union(users.filter("user_id % 3 = 0").select(F.concat(name, F.lit("_labels.csv")))))
    return files.pair_label_files(listed).groupBy("scenario").agg(F.count(F.lit(1)).alias("files"), F.count("labels_path").alias("paired"))


PAIRED_FILES = """SELECT 'd' || user_id % 7 AS scenario, count(*) AS files, count(*) FILTER (user_id % 3 = 0) AS paired
FROM (SELECT DISTINCT user_id FROM events) GROUP BY 1"""


def calibration_file(spark, sf):
    """Scores and true classes written as CSV and read as calibration rows."""
    path = scratch_path(spark, "calibration")
    b.flows(spark, sf).select("anomaly_score", F.col("class").alias("ground_truth")).write.option("header", True).csv(path)
    return files.load_calibration(spark, path).groupBy("label").agg(F.count("score").alias("scores"), F.round(F.sum("score"), 4).alias("total"))


CALIBRATION_FILE = f"""WITH {b.FLOWS} SELECT class AS label, count(anomaly_score) AS scores, round(sum(anomaly_score), 4) AS total FROM flows GROUP BY class"""


def upload_count(spark, sf):
    path = scratch_path(spark, "upload")
    b.table(spark, sf, "supplier").write.option("header", True).csv(path)
    return files.upload_preview(spark, path)


UPLOAD_COUNT = "SELECT count(*) AS rows FROM supplier"

# --- columns -------------------------------------------------------------------------------


def zero_filled(spark, sf):
    """Missing amounts as zero; the class stands last."""
    rows = sources(spark, sf)["lineitem"].select("class", "key", F.when(F.col("quantity") > 25, F.col("quantity")).alias("quantity"))
    found = harmonise.class_last(cleaning.fill_zero(rows, ["quantity"]))
    return found.agg(F.round(F.sum("quantity"), 2).alias("total"), F.count_if(F.col("quantity") == 0).alias("zeros"),
                     F.lit(found.columns[-1]).alias("last_column"))


ZERO_FILLED = """SELECT round(sum(CASE WHEN l_quantity > 25 THEN l_quantity ELSE 0 END), 2) AS total,
       count(*) FILTER (NOT l_quantity > 25) AS zeros, 'class' AS last_column FROM lineitem"""


def features_without_target(spark, sf):
    """Features of a fused source: neither its class nor the label the class was made from."""
    names, target = harmonise.features_and_target(sources(spark, sf)["orders"], "class", ["Label"])
    return spark.createDataFrame([(n, target) for n in names], "feature string, target string")


FEATURES_WITHOUT_TARGET = "SELECT unnest(['key', 'amount', 'kind']) AS feature, 'class' AS target"

# --- sinks ---------------------------------------------------------------------------------


def merged_sink(spark, sf):
    """The fused table, one folder per dataset, read back."""
    path = scratch_path(spark, "merged")
    sinks.write_merged(fusion.fuse(sources(spark, sf)), path)
    return spark.read.parquet(path).groupBy("dataset", "class").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("amount"), 2).alias("amount"))


MERGED_SINK = f"WITH {SOURCES} SELECT dataset, class, count(*) AS rows, round(sum(amount), 2) AS amount FROM fused GROUP BY ALL"


def prediction_sink(spark, sf):
    """Predictions as CSV, read back."""
    path = scratch_path(spark, "predictions")
    sinks.write_predictions(b.detections(spark, sf).select("event_id", "prediction", "anomaly_score"), path, "csv")
    return files.load_csv(spark, path, "event_id long, prediction string, anomaly_score double")


PREDICTION_SINK = f"WITH {b.DETECTIONS} SELECT event_id, prediction, anomaly_score FROM detections"


def metrics_sink(spark, sf):
    """The metrics document as JSON, read back; every figure of both classes."""
    path = scratch_path(spark, "metrics")
    counts = metrics.confusion_counts(b.detections(spark, sf), "class", "prediction")
    document = metrics.metrics_document(counts)
    sinks.write_metrics(document, path)
    lines = spark.read.schema(document.schema).json(path).select("unlabelled", F.explode("classification_report").alias("label", "line"))
    return lines.select("label", *[F.round(F.col("line")[c], 6).alias(c.replace("-", "_")) for c in ("precision", "recall", "f1-score")],
                        F.col("line.support").alias("support"), "unlabelled")


METRICS_SINK = f"""WITH {b.DETECTIONS}, names AS (SELECT DISTINCT class AS label FROM detections UNION SELECT DISTINCT prediction FROM detections),
cells AS (SELECT label, count(*) FILTER (class = label) AS support, count(*) FILTER (prediction = label) AS predicted,
        count(*) FILTER (class = label AND prediction = label) AS hits FROM names, detections GROUP BY label),
rates AS (SELECT label, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS p, CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r,
        CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * hits / (support + predicted) END AS f, support, hits FROM cells)
SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1_score, support, CAST(0 AS BIGINT) AS unlabelled FROM rates
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hits) / sum(support), 6), CAST(sum(support) AS BIGINT), 0 FROM rates
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT), 0 FROM rates
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
       round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT), 0 FROM rates"""


def metrics_document_with_nulls(spark, sf):
    """A seventh of the rows has no true label: counted, and left out of matrix and report."""
    rows = b.detections(spark, sf).withColumn("class", F.when(F.col("event_id") % 7 > 0, F.col("class")))
    document = metrics.metrics_document(metrics.confusion_counts(rows, "class", "prediction"))
    total = F.aggregate(F.flatten("confusion_matrix"), F.lit(0).cast("long"), lambda a, n: a + n)
    return document.select("unlabelled", total.alias("labelled"), F.col("classification_report")["anomaly"]["support"].alias("anomalies"))


METRICS_DOCUMENT_WITH_NULLS = f"""WITH {b.DETECTIONS}
SELECT count(*) FILTER (event_id % 7 = 0) AS unlabelled, count(*) FILTER (event_id % 7 > 0) AS labelled,
       count(*) FILTER (event_id % 7 > 0 AND class = 'anomaly') AS anomalies FROM detections"""


def roc_points_ovr(spark, sf):
    """ROC points of every class against the rest."""
    rows = b.table(spark, sf, "lineitem")
    scored = rows.select(F.col("l_returnflag"), F.explode(F.create_map(*[x for c, e in CLASS_SCORES.items() for x in (F.lit(c), F.expr(e))])).alias("label", "score"))
    counts = metrics.score_counts(scored, "score", F.col("l_returnflag") == F.col("label"), ["label"])
    return metrics.roc_points(counts, ["label"]).select("label", F.round("threshold", 6).alias("threshold"), F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


OVR = " UNION ALL ".join(f"SELECT '{c}' AS label, {e} AS score, l_returnflag = '{c}' AS positive FROM lineitem" for c, e in CLASS_SCORES.items())
ROC_POINTS_OVR = f"""WITH counted AS (SELECT label, score, count(*) FILTER (positive) AS pos, count(*) FILTER (NOT positive) AS neg FROM ({OVR}) GROUP BY ALL)
SELECT label, round(score, 6) AS threshold, round(sum(neg) OVER above / nullif(sum(neg) OVER (PARTITION BY label), 0), 6) AS fpr,
       round(sum(pos) OVER above / nullif(sum(pos) OVER (PARTITION BY label), 0), 6) AS tpr
FROM counted WINDOW above AS (PARTITION BY label ORDER BY score DESC)"""

# --- service tables ------------------------------------------------------------------------


def stored_twice(spark, sf):
    """A batch stored twice: each table holds every row once."""
    root = scratch_path(spark, "service")
    found = todays_analysis(spark, sf)
    for _ in range(2):
        analysis.store(found, root)
    parts = [service_tables.read_table(spark, root, name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"))
             for name in ("analyses", "alerts", "logs")]
    return parts[0].union(parts[1]).union(parts[2])


STORED_TWICE = f"""WITH {EFFECTIVE}, counts AS (SELECT count(*) AS n, count(*) FILTER (predicted_label = 'ANOMALY' AND auto_create_alert) AS a, count(DISTINCT batch_id) AS d FROM results)
SELECT 'analyses' AS name, n AS rows, n AS ids FROM counts UNION ALL SELECT 'alerts', a, a FROM counts UNION ALL SELECT 'logs', n + a + d, n + a + d FROM counts"""


def stored_after_cut(spark, sf):
    """A batch whose first run was cut off between two tables, stored by a second run, then compacted: what is seen each time."""
    root = scratch_path(spark, "service")
    found = todays_analysis(spark, sf)
    service_tables.append_new(found.analyses, root, "analyses", under="cut-off")
    cut = service_tables.read_table(spark, root, "analyses").count()
    analysis.store(found, root)
    stored = service_tables.read_table(spark, root, "analyses").count()
    months = [str(r["month"]) for r in found.analyses.select(F.to_date(F.date_trunc("month", "created_at")).alias("month")).distinct().collect()]
    service_tables.compact(spark, root, "analyses", months)
    rows = service_tables.read_table(spark, root, "analyses")
    return rows.groupBy("predicted_label").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"), F.round(F.sum("anomaly_score"), 4).alias("score")).withColumns(
        {"seen_after_cut": F.lit(cut).cast("long"), "seen_after_store": F.lit(stored).cast("long")})


STORED_AFTER_CUT = f"""WITH {EFFECTIVE} SELECT predicted_label, count(*) AS rows, count(*) AS ids, round(sum(anomaly_score), 4) AS score, CAST(0 AS BIGINT) AS seen_after_cut,
       (SELECT count(*) FROM results) AS seen_after_store FROM results GROUP BY predicted_label"""


def cleared_table(spark, sf):
    """A service table written, then emptied."""
    root = scratch_path(spark, "cleared")
    rows = b.alerts(spark, sf).select(F.col("id").cast("string").alias("id"), "time", "label", "anomaly_score", "severity", "action", "status",
                                      F.lit(None).cast("map<string,double>").alias("features"), F.col("time").alias("created_at"))
    service_tables.append_table(rows, root, "alerts")
    before = service_tables.read_table(spark, root, "alerts").count()
    service_tables.clear_table(spark, root, "alerts")
    return service_tables.read_table(spark, root, "alerts").agg(F.lit(before).cast("long").alias("written"), F.count(F.lit(1)).alias("left_over"))


CLEARED_TABLE = f"WITH {b.ALERTS} SELECT count(*) AS written, CAST(0 AS BIGINT) AS left_over FROM alerts"


def calibrated_settings(spark, sf):
    """A calibrated threshold saved as settings: the effective value, and the log row of the update."""
    calibrated = threshold.calibrate(b.flows(spark, sf), "anomaly_score", "class")
    at = datetime.datetime(2026, 1, 1)
    changes = service_tables.calibrated_changes(calibrated, spark, at)
    logs = service_tables.settings_logs(changes)
    found = service_tables.effective_settings(service_tables.current_settings(changes))
    return found.select(F.round("anomaly_threshold", 6).alias("anomaly_threshold"), "auto_smart_threshold",
                        logs.agg(F.count(F.lit(1))).scalar().alias("log_rows"), logs.agg(F.max("message")).scalar().alias("message"))


LOW, HIGH = threshold.CALIBRATION_BOUNDS
CALIBRATED_SETTINGS = f"""WITH {b.FLOWS}, lists AS (
    SELECT list_sort(list(anomaly_score) FILTER (class = 'normal')) AS n, list_sort(list(anomaly_score) FILTER (class = 'anomaly')) AS a,
           list_sort(list(1 - anomaly_score) FILTER (class = 'normal')) AS i FROM flows), picked AS (
    SELECT CASE WHEN n[CAST(floor((len(n) - 1) * 0.5) AS BIGINT) + 1] > a[CAST(floor((len(a) - 1) * 0.5) AS BIGINT) + 1]
                THEN i[CAST(floor((len(i) - 1) * 0.99) AS BIGINT) + 1] ELSE n[CAST(floor((len(n) - 1) * 0.99) AS BIGINT) + 1] END AS t FROM lists)
SELECT round(least({HIGH}, greatest({LOW}, t)), 6) AS anomaly_threshold, false AS auto_smart_threshold, CAST(1 AS BIGINT) AS log_rows, 'Settings updated' AS message
FROM picked"""

NAMES = ("bom_scan", "head_scan", "chunk_sample", "paired_files", "calibration_file", "upload_count", "zero_filled", "features_without_target",
         "merged_sink", "prediction_sink", "metrics_sink", "metrics_document_with_nulls", "roc_points_ovr", "stored_twice", "stored_after_cut", "cleared_table",
         "calibrated_settings")
QUERIES = {name: globals()[name] for name in NAMES}
ORACLES = {name: globals()[name.upper()] for name in NAMES}
