import datetime

from pyspark.sql import functions as F

from flowlens.operators import cleaning, dashboard, matching, profile
from flowlens.plans import analysis
from flowlens.sources import service_tables

NOON = datetime.datetime(2026, 12, 1, 12)


def scored(spark, values):
    rows = [("b", i, {"a": float(i)}, v, {"anomaly": v, "normal": 1 - v}, NOON) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "batch_id string, item_no long, input_features map<string,double>, anomaly_score double, "
                                       "raw_proba map<string,double>, created_at timestamp")


def test_analysis_rows(spark, tmp_path):
    found = analysis.analyse(scored(spark, [0.9, 0.45, 0.1]), 0.45)
    assert sorted(r["label"] for r in found.alerts.collect()) == ["ANOMALY", "ANOMALY"]
    assert {r["type"]: r["count"] for r in found.logs.groupBy("type").count().collect()} == {"request": 1, "analysis": 3, "alert": 2}
    assert tuple(analysis.summary(found).first())[1:4] == (3, 2, 1)
    assert analysis.analyse(scored(spark, [0.9]), 0.45, auto_create_alert=False).alerts.isEmpty()
    analysis.analyse_and_store(scored(spark, [0.9, 0.45, 0.1]), 0.45, str(tmp_path))
    analysis.analyse_and_store(scored(spark, [0.9, 0.45, 0.1]), 0.45, str(tmp_path))
    for name, rows in (("analyses", 3), ("alerts", 2), ("logs", 6)):
        assert service_tables.read_table(spark, str(tmp_path), name).count() == rows
    links = service_tables.linked_logs(found.logs, found.alerts.select("id", "severity"), "alertId")
    assert sorted(r["severity"] for r in links.collect()) == ["High", "Low"]


def test_ids_repeat(spark):
    ids = [sorted(r["id"] for r in analysis.analyse(scored(spark, [0.9, 0.1]), 0.5).analyses.collect()) for _ in range(2)]
    assert ids[0] == ids[1] and len(set(ids[0])) == 2


def test_empty_batch_summary(spark):
    found = dashboard.batch_summary(analysis.judge(scored(spark, []), 0.5), ())
    assert tuple(found.first()) == (0, 0, 0, 0.0)


def test_effective_threshold_follows_the_switch(spark):
    past = spark.createDataFrame([(0.6,), (0.6,)], "anomaly_score double")
    for smart, expected in ((True, 0.6), (False, 0.8)):
        settings = spark.createDataFrame([(0.8, smart)], "anomaly_threshold double, auto_smart_threshold boolean")
        assert abs(analysis.effective_threshold(settings, past).first()[0] - expected) < 1e-12
    settings = spark.createDataFrame([(0.8, True)], "anomaly_threshold double, auto_smart_threshold boolean")
    assert analysis.effective_threshold(settings, past.limit(0)).first()[0] == 0.8


def test_histogram_bands(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)], "anomaly_score double")
    assert [r["count"] for r in dashboard.score_histogram(df).collect()] == [1, 1, 1, 1, 2]


def test_alert_filter(spark):
    df = spark.createDataFrame([("High", "New", "Alert SOC"), ("Low", "New", "Log only"), ("Low", "Resolved", "alert soc")],
                               "severity string, status string, action string")
    assert dashboard.filter_alerts(df, "all", "New", "SOC").count() == 1
    assert dashboard.filter_alerts(df, search="soc").count() == 2
    assert dashboard.filter_alerts(df).count() == 3


def test_status_updates_and_deletes(spark):
    alerts = spark.createDataFrame([("1", "New"), ("2", "New"), ("3", "New")], "id string, status string")
    changes = spark.createDataFrame([("1", "Acknowledged", 1, 1), ("1", "Resolved", 2, 1)], "id string, status string, changed_at int, seq int")
    gone = spark.createDataFrame([("3",)], "id string")
    rows = {r["id"]: r["status"] for r in service_tables.current_status(alerts, changes, gone).collect()}
    assert rows == {"1": "Resolved", "2": "New"}


def test_labels_compare_in_any_case(spark):
    df = spark.createDataFrame([("Normal",), ("NORMAL ",), ("anomaly",), (None,)], "predicted_label string")
    assert tuple(dashboard.analysis_stats(df).first()) == (4, 1, 2)


def test_matching_nulls_and_copies(spark):
    truth = spark.createDataFrame([(1, None, "normal"), (1, None, "normal"), (2, 5.0, "anomaly")], "a int, b double, class string")
    predictions = spark.createDataFrame([(1, None, "normal"), (1, None, "normal"), (9, 1.0, "normal")], "a long, b double, prediction string")
    counts = matching.match_counts(predictions, truth, ["a", "b"], "class")
    assert [r["pairs"] for r in counts.collect()] == [4]
    assert matching.match_rows(predictions, truth, ["a", "b"], "class").count() == 4
    assert tuple(matching.coverage(predictions, counts).first()) == (3, 4, False)


def test_matching_negative_zero_and_nan(spark):
    truth = spark.createDataFrame([(0.0, float("nan"), "x")], "a double, b double, class string")
    predictions = spark.createDataFrame([(-0.0, float("nan"), "x")], "a double, b double, prediction string")
    assert matching.match_rows(predictions, truth, ["a", "b"], "class").count() == 1


def test_quality_counts(spark):
    df = spark.createDataFrame([("inf", 1.0), ("x", float("nan")), ("2", None)], "s string, v double")
    rows = {r["column"]: (r["rows"], r["infinite"], r["missing"]) for r in cleaning.quality_counts(df, ["s", "v"]).collect()}
    assert rows == {"s": (3, 1, 1), "v": (3, 0, 2)}


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, n int")
    assert [tuple(r) for r in profile.value_counts(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in profile.value_counts(df, "k", keep_null=True).collect()] == [("a", 2), (None, 1)]
    assert {r["column"]: r["n_distinct"] for r in profile.distinct_counts(df, ["k", "n"]).collect()} == {"k": 2, "n": 3}
    assert [tuple(r) for r in profile.low_cardinality(df, limit=2).collect()] == [("k", 1)]
    assert tuple(profile.shape(df).first()) == (3, 2)
    shares = {r["k"]: round(r["share"], 4) for r in profile.class_distribution(df, "k").collect()}
    assert shares == {"a": 0.6667, None: 0.3333}


def test_top_and_chart(spark):
    df = spark.range(30).select("id", (F.col("id") / 100).alias("anomaly_score"), F.lit("NORMAL").alias("predicted_label"), F.col("id").alias("created_at"))
    points = dashboard.chart_points(df).orderBy("point").collect()
    assert [p["point"] for p in points] == list(range(1, 21)) and points[0]["score"] == 10.0
    assert [r["id"] for r in dashboard.top_anomalies(df, 2).collect()] == [29, 28]
    assert dashboard.recent_label_split(df).first()["normal"] == 30


def alert_log(spark, rows):
    from datetime import datetime
    return spark.createDataFrame([(i, datetime(2026, month, 9), "status", "m", None, datetime(2026, month, 9)) for i, month in rows], service_tables.LOGS)


def ids(spark, root):
    return sorted(r["id"] for r in service_tables.read_table(spark, root, "logs").collect())


def test_an_unfinished_commit_is_never_seen(spark, tmp_path):
    root = str(tmp_path)
    service_tables.append_table(alert_log(spark, [("a", 1)]), root, "logs")
    service_tables.append_new(alert_log(spark, [("a", 1), ("b", 1), ("c", 2)]), root, "logs", under="one")
    assert ids(spark, root) == ["a"]
    service_tables.append_new(alert_log(spark, [("b", 1), ("c", 2)]), root, "logs", under="two")
    service_tables.commit(spark, root, "two")
    assert ids(spark, root) == ["a", "b", "c"]
    service_tables.compact(spark, root, "logs", ["2026-01-01"])
    assert ids(spark, root) == ["a", "b", "c"]
    left = service_tables._filed(spark, root, "logs").groupBy("month").count().orderBy("month").collect()
    assert [r["count"] for r in left] == [2, 2]
    service_tables.commit(spark, root, "one")
    assert ids(spark, root) == ["a", "b", "c", "c"]


def test_compaction_spreads_a_large_month(spark, tmp_path):
    root = str(tmp_path)
    service_tables.append_table(alert_log(spark, [(f"{i}", 1) for i in range(400)] + [("x", 2)]), root, "logs")
    service_tables.compact(spark, root, "logs", ["2026-01-01", "2026-02-01"], file_rows=100)
    assert ids(spark, root) == sorted([f"{i}" for i in range(400)] + ["x"])
    parts = {month: list((tmp_path / "logs" / f"month=2026-{month}-01").glob("*.parquet")) for month in ("01", "02")}
    assert len(parts["01"]) == 4 and len(parts["02"]) == 1
    assert max(spark.read.parquet(str(part)).count() for part in parts["01"]) < 150


def test_storing_reads_the_months_of_the_batch_alone(spark, tmp_path):
    root = str(tmp_path)
    service_tables.append_table(alert_log(spark, [(f"{month}", month) for month in range(1, 13)]), root, "logs")
    # Files of other months are spoilt: whoever reads them fails.
    for month in range(1, 13):
        if month != 5:
            for part in (tmp_path / "logs" / f"month=2026-{month:02d}-01").glob("*.parquet"):
                part.write_bytes(b"spoilt")
    service_tables.append_new(alert_log(spark, [("5", 5), ("new", 5)]), root, "logs")
    rows = spark.read.parquet(f"{root}/logs/month=2026-05-01").collect()
    assert sorted(r["id"] for r in rows) == ["5", "new"]


def test_rows_without_a_time_are_stored_once(spark, tmp_path):
    row = spark.createDataFrame([("1", None, "status", "m", None, None)], service_tables.LOGS)
    for _ in range(2):
        service_tables.append_new(row, str(tmp_path), "logs")
    assert ids(spark, str(tmp_path)) == ["1"]
