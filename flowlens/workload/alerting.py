"""Scoring requests, alerts, settings, exports and dashboard summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions import scores
from flowlens.operators import dashboard, threshold
from flowlens.plans import analysis
from flowlens.sources import requests, service_tables, sinks
from flowlens.workload import bindings as b

# --- the flagship: settings and past scores decide the threshold of today's batch -----------


def batch(spark: SparkSession, sf: str) -> DataFrame:
    """Scored items, one batch per day."""
    rows = b.flows(spark, sf)
    score = F.col("anomaly_score")
    return rows.select(
        F.to_date("ts").alias("batch_id"), F.col("event_id").alias("item_no"),
        F.create_map(F.lit("value"), "value").alias("input_features"), "anomaly_score",
        F.create_map(F.lit("anomaly"), score, F.lit("normal"), scores.inverted(score)).alias("raw_proba"),
        F.col("ts").alias("created_at"))


def todays_threshold(spark: SparkSession, sf: str) -> DataFrame:
    settings = service_tables.effective_settings(
        service_tables.current_settings(b.settings_changes(spark, sf), seq="seq"))
    past = threshold.recent(b.analyses(spark, sf).select("id", "created_at", "anomaly_score"), 1000)
    return analysis.effective_threshold(settings, past)


def todays_analysis(spark: SparkSession, sf: str) -> analysis.Analysis:
    """Threshold and switch are computed once, before the batch is read."""
    row = todays_threshold(spark, sf).select("threshold", "auto_create_alert").first()
    return analysis.analyse(batch(spark, sf), row["threshold"], row["auto_create_alert"])


def analyse_batch(spark, sf):
    return todays_analysis(spark, sf).results.select(
        "batch_id", "item_no", "anomaly_score", "predicted_label", "severity", "action")


EFFECTIVE = f"""{b.ANALYSES}, {b.SETTINGS}, settings AS (
    SELECT CASE WHEN try_cast(max(value) FILTER (key = 'anomalyThreshold') AS DOUBLE) <> 0
                THEN try_cast(max(value) FILTER (key = 'anomalyThreshold') AS DOUBLE) ELSE 0.45 END AS anomaly_threshold,
           lower(trim(coalesce(max(value) FILTER (key = 'autoCreateAlert'), 'true'))) = 'true' AS auto_create_alert,
           lower(trim(coalesce(max(value) FILTER (key = 'autoSmartThreshold'), 'true'))) = 'true' AS auto_smart_threshold,
           regexp_replace(coalesce(max(value) FILTER (key = 'apiUrl'), '"http://localhost:8000/predict"'), '^"|"$', '', 'g') AS api_url
    FROM current_settings), past AS (
    SELECT anomaly_score FROM analyses ORDER BY created_at DESC, id LIMIT 1000), smart AS (
    SELECT least(0.95, greatest(0.3, avg(anomaly_score) + 0.75 * stddev_pop(anomaly_score))) AS threshold FROM past), effective AS (
    SELECT CASE WHEN auto_smart_threshold THEN threshold ELSE anomaly_threshold END AS threshold, auto_create_alert
    FROM settings, smart), results AS (
    SELECT CAST(ts AS DATE) AS batch_id, event_id AS item_no, anomaly_score, ts AS created_at,
           CASE WHEN anomaly_score >= threshold THEN 'ANOMALY' ELSE 'NORMAL' END AS predicted_label,
           CASE WHEN anomaly_score >= 0.85 THEN 'High' WHEN anomaly_score >= 0.7 THEN 'Medium' ELSE 'Low' END AS severity,
           CASE WHEN anomaly_score >= 0.85 THEN 'Block/Isolate host' WHEN anomaly_score >= 0.7 THEN 'Alert SOC' ELSE 'Log only' END AS action,
           auto_create_alert
    FROM flows, effective)"""

ANALYSE_BATCH = f"""WITH {EFFECTIVE}
SELECT batch_id, item_no, anomaly_score, predicted_label, severity, action FROM results"""


def batch_summary(spark, sf):
    found = analysis.summary(todays_analysis(spark, sf))
    return found.withColumn("avg_score", F.round("avg_score", 6))


BATCH_SUMMARY = f"""WITH {EFFECTIVE}
SELECT batch_id, count(*) AS total, count(*) FILTER (predicted_label = 'ANOMALY') AS anomalies,
       count(*) FILTER (predicted_label <> 'ANOMALY') AS normal, round(avg(anomaly_score), 6) AS avg_score
FROM results GROUP BY batch_id"""


def effective_threshold(spark, sf):
    return todays_threshold(spark, sf).select(F.round("threshold", 6).alias("threshold"))


EFFECTIVE_THRESHOLD = f"WITH {EFFECTIVE} SELECT round(threshold, 6) AS threshold FROM effective"


def alerts_created(spark, sf):
    """Alert rows the batch adds, counted per day, severity and action."""
    return (todays_analysis(spark, sf).alerts.groupBy(F.to_date("time").alias("batch_id"), "severity", "action", "status")
            .agg(F.count(F.lit(1)).alias("alerts"), F.count_distinct("id").alias("ids")))


ALERTS_CREATED = f"""WITH {EFFECTIVE}
SELECT batch_id, severity, action, 'New' AS status, count(*) AS alerts, count(*) AS ids
FROM results WHERE predicted_label = 'ANOMALY' AND auto_create_alert GROUP BY batch_id, severity, action"""


def batch_logs(spark, sf):
    """Log rows of the batch, counted by type and message."""
    return todays_analysis(spark, sf).logs.groupBy("type", "message").agg(F.count(F.lit(1)).alias("rows"))


BATCH_LOGS = f"""WITH {EFFECTIVE}, logs AS (
    SELECT 'request' AS type, 'Request received - analysing ' || count(*) || ' item(s)' AS message FROM results GROUP BY batch_id
    UNION ALL
    SELECT 'analysis', 'Analysis completed: ' || predicted_label || ' (score: 0.' ||
           lpad(CAST((CAST(round(anomaly_score * 1000000) AS BIGINT) + 5000) // 10000 AS VARCHAR), 2, '0') || ')' FROM results
    UNION ALL
    SELECT 'alert', 'Alert created: ' || predicted_label || ' (' || severity || ')'
    FROM results WHERE predicted_label = 'ANOMALY' AND auto_create_alert)
SELECT type, message, count(*) AS rows FROM logs GROUP BY type, message"""


def alert_log_links(spark, sf):
    """Alerts with the log row that names them, counted by day and severity."""
    found = todays_analysis(spark, sf)
    linked = service_tables.linked_logs(found.logs, found.alerts.select("id", "severity", "time"), "alertId")
    return linked.groupBy(F.to_date("time").alias("batch_id"), "severity", "type").agg(F.count(F.lit(1)).alias("links"))


ALERT_LOG_LINKS = f"""WITH {EFFECTIVE}
SELECT batch_id, severity, 'alert' AS type, count(*) AS links
FROM results WHERE predicted_label = 'ANOMALY' AND auto_create_alert GROUP BY batch_id, severity"""


def result_documents(spark, sf):
    """JSON lines of every batch, read back and summed."""
    found = todays_analysis(spark, sf)
    results = found.results.select("batch_id", "item_no", "anomaly_score", "predicted_label")
    documents = sinks.result_documents(results, analysis.summary(found))
    shape = "total bigint, anomalies bigint, item_no bigint, anomaly_score double, predicted_label string"
    parsed = documents.withColumn("d", F.from_json("document", shape))
    return parsed.groupBy("batch_id").agg(
        F.max("d.total").alias("total"), F.max("d.anomalies").alias("anomalies"),
        F.count_if(F.col("kind") == "result").alias("results"), F.count_distinct("d.item_no").alias("items"),
        F.count_if(F.col("kind") == "summary").alias("summaries"),
        F.round(F.sum("d.anomaly_score"), 4).alias("score_sum"))


RESULT_DOCUMENTS = f"""WITH {EFFECTIVE}
SELECT batch_id, count(*) AS total, count(*) FILTER (predicted_label = 'ANOMALY') AS anomalies,
       count(*) AS results, count(*) AS items, CAST(1 AS BIGINT) AS summaries, round(sum(anomaly_score), 4) AS score_sum
FROM results GROUP BY batch_id"""

# --- alert tables --------------------------------------------------------------------------


def alerts_filtered(spark, sf):
    return dashboard.filter_alerts(b.alerts(spark, sf), status="New", search="SOC")


ALERTS_FILTERED = f"""WITH {b.ALERTS}
SELECT * FROM alerts WHERE status = 'New' AND contains(lower(action), 'soc')"""


def alerts_latest(spark, sf):
    return threshold.recent(b.alerts(spark, sf), dashboard.LATEST["alerts"], "time")


ALERTS_LATEST = f"WITH {b.ALERTS} SELECT * FROM alerts ORDER BY time DESC, id LIMIT 200"


def analyses_latest(spark, sf):
    return threshold.recent(b.analyses(spark, sf), dashboard.LATEST["analyses"])


ANALYSES_LATEST = f"""WITH {b.ANALYSES}
SELECT id, predicted_label, anomaly_score, severity, action, created_at, batch_id
FROM analyses ORDER BY created_at DESC, id LIMIT 100"""


def top_anomalies(spark, sf):
    return dashboard.top_anomalies(b.flows(spark, sf).select("event_id", "event_type", "class", "anomaly_score"), tie="event_id")


TOP_ANOMALIES = f"""WITH {b.FLOWS}
SELECT event_id, event_type, class, anomaly_score FROM flows ORDER BY anomaly_score DESC, event_id LIMIT 50"""


def status_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Status updates read off the line items: the order number names the alert."""
    flag = F.col("l_returnflag")
    return b.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.when(flag == "A", "Acknowledged").when(flag == "R", "Resolved").otherwise("New").alias("status"),
        F.col("l_shipdate").alias("changed_at"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("seq"))


def alert_status_current(spark, sf):
    """Latest status of each alert; alerts of sign-up events were deleted."""
    gone = b.table(spark, sf, "events").filter("event_type = 'signup'").select(F.col("event_id").alias("id"))
    return service_tables.current_status(b.alerts(spark, sf), status_changes(spark, sf), gone).select(
        "id", "severity", "status", "anomaly_score")


ALERT_STATUS_CURRENT = f"""WITH {b.ALERTS}, changes AS (
    SELECT l_orderkey AS id, CASE l_returnflag WHEN 'A' THEN 'Acknowledged' WHEN 'R' THEN 'Resolved' ELSE 'New' END AS status,
           l_shipdate AS changed_at, l_partkey * 10 + l_linenumber AS seq FROM lineitem), latest AS (
    SELECT id, status FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY changed_at DESC, seq DESC, status DESC) AS place
                            FROM changes) WHERE place = 1)
SELECT a.id, a.severity, coalesce(l.status, a.status) AS status, a.anomaly_score
FROM alerts a LEFT JOIN latest l ON a.id = l.id
WHERE a.id NOT IN (SELECT event_id FROM events WHERE event_type = 'signup')"""


def status_logs(spark, sf):
    logs = analysis.status_logs(status_changes(spark, sf))
    return logs.groupBy("type", "message", F.get_json_object("metadata", "$.newStatus").alias("new_status")).agg(
        F.count(F.lit(1)).alias("rows"))


STATUS_LOGS = """SELECT 'status' AS type, 'Alert status updated to: ' || status AS message, status AS new_status, count(*) AS rows
FROM (SELECT CASE l_returnflag WHEN 'A' THEN 'Acknowledged' WHEN 'R' THEN 'Resolved' ELSE 'New' END AS status FROM lineitem)
GROUP BY status"""


def alert_export(spark, sf):
    return sinks.alert_export(b.alerts(spark, sf))


ALERT_EXPORT = f"""WITH {b.ALERTS}
SELECT strftime(time, '%d/%m/%Y, %H:%M:%S') AS "Time", label AS "Label", anomaly_score AS "Anomaly Score",
       severity AS "Severity", action AS "Action", status AS "Status" FROM alerts"""


def log_export(spark, sf):
    return sinks.log_export(analysis.status_logs(status_changes(spark, sf)))


LOG_EXPORT = """SELECT strftime(l_shipdate, '%d/%m/%Y, %H:%M:%S') AS "Timestamp", 'status' AS "Type",
       'Alert status updated to: ' || CASE l_returnflag WHEN 'A' THEN 'Acknowledged' WHEN 'R' THEN 'Resolved' ELSE 'New' END AS "Message"
FROM lineitem"""


def rule_detector(spark, sf):
    """Detector over line items as traffic figures, counted by flags."""
    flagged = scores.rule_detector(F.col("l_extendedprice") * 10, F.col("l_quantity") * 250, F.col("l_quantity") * 2)
    return (b.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", flagged.alias("flagged"))
            .groupBy("l_returnflag", "l_linestatus", "flagged").agg(F.count(F.lit(1)).alias("rows")))


RULE_DETECTOR = """SELECT l_returnflag, l_linestatus,
       (l_extendedprice * 10 > 500000 OR l_quantity * 250 > 10000 OR l_quantity * 2 > 100) AS flagged, count(*) AS rows
FROM lineitem GROUP BY 1, 2, 3"""

# --- settings ------------------------------------------------------------------------------


def settings_current(spark, sf):
    return service_tables.current_settings(b.settings_changes(spark, sf), seq="seq")


SETTINGS_CURRENT = f"WITH {b.SETTINGS} SELECT key, value FROM current_settings"


def settings_effective(spark, sf):
    return todays_threshold(spark, sf).drop("threshold")


SETTINGS_EFFECTIVE = f"WITH {EFFECTIVE} SELECT * FROM settings"


def settings_seeded(spark, sf):
    """Stored settings and the defaults that were missing."""
    stored = service_tables.current_settings(b.settings_changes(spark, sf), seq="seq")
    return stored.unionByName(service_tables.seed_settings(stored).select("key", "value"))


SETTINGS_SEEDED = f"""WITH {b.SETTINGS}, defaults(key, value) AS (VALUES
    ('anomalyThreshold', '0.45'), ('autoSmartThreshold', 'true'), ('autoCreateAlert', 'true'),
    ('apiUrl', '"http://localhost:8000/predict"'))
SELECT key, value FROM current_settings
UNION ALL SELECT key, value FROM defaults WHERE key NOT IN (SELECT key FROM current_settings)"""

# --- dashboard -----------------------------------------------------------------------------


def dashboard_stats(spark, sf):
    return dashboard.dashboard_stats(b.analyses(spark, sf), b.alerts(spark, sf))


DASHBOARD_STATS = f"""WITH {b.ALERTS}
SELECT count(*) AS total_requests, count(*) FILTER (predicted_label = 'ANOMALY') AS anomalies,
       count(*) FILTER (predicted_label = 'NORMAL') AS normal_traffic,
       (SELECT count(*) FROM alerts) AS total_alerts, (SELECT count(*) FROM alerts WHERE status = 'New') AS new_alerts
FROM analyses"""


def score_histogram(spark, sf):
    return dashboard.score_histogram(b.analyses(spark, sf))


SCORE_HISTOGRAM = f"""WITH {b.ANALYSES}, bands(band, low, high) AS (VALUES
    ('0-20%', -1e300, 20.0), ('20-40%', 20.0, 40.0), ('40-60%', 40.0, 60.0), ('60-80%', 60.0, 80.0), ('80-100%', 80.0, 1e300))
SELECT band, count(id) AS count
FROM bands LEFT JOIN analyses ON anomaly_score * 100 >= low AND anomaly_score * 100 < high GROUP BY band"""


def recent_label_split(spark, sf):
    return dashboard.recent_label_split(b.analyses(spark, sf))


RECENT_LABEL_SPLIT = f"""WITH {b.ANALYSES}, latest AS (SELECT * FROM analyses ORDER BY created_at DESC, id LIMIT 100)
SELECT count(*) AS total, count(*) FILTER (predicted_label = 'ANOMALY') AS anomaly,
       count(*) FILTER (predicted_label <> 'ANOMALY') AS normal,
       round(100.0 * count(*) FILTER (predicted_label = 'ANOMALY') / count(*), 1) AS anomaly_percent FROM latest"""


def recent_points(spark, sf):
    return dashboard.chart_points(b.analyses(spark, sf))


RECENT_POINTS = f"""WITH {b.ANALYSES}, latest AS (SELECT * FROM analyses ORDER BY created_at DESC, id LIMIT 20)
SELECT CAST(row_number() OVER (ORDER BY created_at, id DESC) AS INTEGER) AS point, round(anomaly_score * 100, 2) AS score,
       predicted_label AS label FROM latest"""


def recent_scores(spark, sf):
    return dashboard.recent_scores(b.analyses(spark, sf))


RECENT_SCORES = f"""WITH {b.ANALYSES}
SELECT anomaly_score, predicted_label = 'NORMAL' AS is_normal
FROM (SELECT * FROM analyses ORDER BY created_at DESC, id LIMIT 1000)"""

# --- requests and responses ----------------------------------------------------------------

FEATURES = ("k", "Flow Duration")


def request_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Two-item requests made of the event properties; sign-ups send a cut-off body."""
    body = F.concat(F.lit('{"items":[{"features":'), "props", F.lit('},{"features":{"Flow Duration":'),
                    F.col("event_id").cast("string"), F.lit(',"unknown":1}}]}'))
    sent = F.when(F.col("event_type") == "signup", F.substring(body, 1, 20)).otherwise(body)
    return b.table(spark, sf, "events").select("event_id", "event_type", sent.alias("body"))


def request_align(spark, sf):
    items = requests.read_requests(request_bodies(spark, sf), "body", ["event_id"]).accepted
    aligned = requests.align_features(F.col("features"), FEATURES)
    return items.select("event_id", "item_no", F.get(aligned, F.lit(0)).alias("k"), F.get(aligned, F.lit(1)).alias("flow_duration"))


REQUEST_ALIGN = """WITH good AS (SELECT * FROM events WHERE event_type <> 'signup')
SELECT event_id, CAST(0 AS INTEGER) AS item_no, coalesce(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS k,
       CAST(0.0 AS DOUBLE) AS flow_duration FROM good
UNION ALL SELECT event_id, 1, 0.0, CAST(event_id AS DOUBLE) FROM good"""


def request_rejects(spark, sf):
    return requests.read_requests(request_bodies(spark, sf), "body", ["event_id", "event_type"]).rejected


REQUEST_REJECTS = """SELECT event_id, event_type,
       substr('{"items":[{"features":' || props || '},{"features":{"Flow Duration":', 1, 20) AS body
FROM events WHERE event_type = 'signup'"""


def response_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Answers of a scoring service in the forms it may use, by event type."""
    score = F.format_string("0.%02d", F.floor("value") % 100)
    rest = F.format_string("0.%02d", F.floor("value") % 50)
    proba = F.concat(F.lit('"raw_proba":{"anomaly":'), score, F.lit(',"normal":'), rest, F.lit("}"))
    kind = F.col("event_type")
    body = (F.when(kind == "click", F.concat(F.lit('{"results":[{"anomaly_score":'), score, F.lit(',"predicted_label":"x",'), proba, F.lit('}]}')))
            .when(kind == "view", F.concat(F.lit('{"anomaly_score":'), score, F.lit('}')))
            .when(kind == "purchase", F.concat(F.lit("{"), proba, F.lit("}")))
            .when(kind == "signup", F.concat(F.lit('{"results":[],"anomaly_score":'), score, F.lit('}')))
            .otherwise(F.concat(F.lit('{"predicted_label":"x","id":'), F.col("event_id").cast("string"), F.lit("}"))))
    return b.table(spark, sf, "events").select("event_id", "event_type", body.alias("body"))


def response_unwrap(spark, sf):
    answers = requests.read_responses(response_bodies(spark, sf), "body", keep=["event_id"]).accepted
    return answers.select("event_id", "predicted_label", "anomaly_score", F.round(F.col("raw_proba")["anomaly"], 6).alias("p_anomaly"),
                          F.round(F.col("raw_proba")["normal"], 6).alias("p_normal"))


RESPONSE_UNWRAP = """WITH answers AS (
    SELECT event_id, event_type, CAST(CAST(floor(value) AS BIGINT) % 100 AS DOUBLE) / 100 AS s,
           CAST(CAST(floor(value) AS BIGINT) % 50 AS DOUBLE) / 100 AS rest FROM events WHERE event_type <> 'error')
SELECT event_id, CASE WHEN s >= 0.45 THEN 'ANOMALY' ELSE 'NORMAL' END AS predicted_label, s AS anomaly_score,
       round(s, 6) AS p_anomaly, round(CASE WHEN event_type IN ('click', 'purchase') THEN rest ELSE 1 - s END, 6) AS p_normal
FROM answers"""


def response_rejects(spark, sf):
    return requests.read_responses(response_bodies(spark, sf), "body", keep=["event_id"]).rejected


RESPONSE_REJECTS = """SELECT event_id, '{"predicted_label":"x","id":' || event_id || '}' AS body
FROM events WHERE event_type = 'error'"""

NAMES = ("analyse_batch", "batch_summary", "effective_threshold", "alerts_created", "batch_logs", "alert_log_links",
         "result_documents", "alerts_filtered", "alerts_latest", "analyses_latest", "top_anomalies", "alert_status_current",
         "status_logs", "alert_export", "log_export", "rule_detector", "settings_current", "settings_effective",
         "settings_seeded", "dashboard_stats", "score_histogram", "recent_label_split", "recent_points", "recent_scores",
         "request_align", "request_rejects", "response_unwrap", "response_rejects")
QUERIES = {name: globals()[name] for name in NAMES}
ORACLES = {name: globals()[name.upper()] for name in NAMES}
