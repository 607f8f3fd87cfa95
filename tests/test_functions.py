from pyspark.sql import functions as F

from flowlens.functions import labels, numeric, scores, text

import pytest


def values(df):
    return [r[0] for r in df.collect()]


def test_detect_label_follows_candidate_order():
    assert labels.detect_label([" Flow ", "Class ", "label"], labels.LABEL_CANDIDATES["ids2025"]) == "label"


def test_detect_label_fallbacks():
    columns = ["a", "b"]
    assert labels.detect_label(columns, ["x"], "first") == "a"
    assert labels.detect_label(columns, ["x"], "last") == "b"
    with pytest.raises(ValueError):
        labels.detect_label(columns, ["x"])


def test_probe_reports_all_labels_in_order():
    assert labels.found_labels(["type", "Label", "x"], labels.LABEL_CANDIDATES["luflow_probe"]) == ["Label", "type"]


def test_find_target_and_difference():
    assert labels.find_target(["a", "Label"], "class") == "Label"
    assert labels.find_target(["a"], "class") is None
    assert labels.label_by_difference(["f", "note", "label"], ["f", "prediction", "anomaly_score"]) == "label"
    assert labels.label_by_difference(["f", "x", "y"], ["f", "prediction"]) == "y"


def test_class_of_numbers(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (None,), (float("nan"),)], "l double")
    kind = df.schema["l"].dataType
    assert values(df.select(labels.class_of(F.col("l"), kind))) == ["normal", "anomaly", "anomaly", None, None]
    assert values(df.select(labels.class_of(F.col("l"), kind, null_label="anomaly")))[3] == "anomaly"


def test_class_of_text(spark):
    df = spark.createDataFrame([(" BENIGN ",), ("background",), ("0",), ("DDoS",)], "l string")
    kind = df.schema["l"].dataType
    assert values(df.select(labels.class_of(F.col("l"), kind))) == ["normal", "normal", "normal", "anomaly"]
    assert values(df.select(labels.class_of(F.col("l"), kind, labels.NFUQ_TOKENS))) == ["normal", "anomaly", "anomaly", "anomaly"]


def test_class_of_booleans_and_passthrough(spark):
    df = spark.createDataFrame([(False, "malicious"), (True, "outlier"), (None, "X"), (False, "Benign")], "b boolean, s string")
    kind = df.schema["b"].dataType
    assert values(df.select(labels.class_of(F.col("b"), kind))) == ["normal", "anomaly", None, "normal"]
    assert values(df.select(labels.class_passthrough(F.col("s")))) == ["anomaly", "anomaly", "x", "normal"]


def test_header_rule():
    assert text.header_name(" Flow  Byts/s ") == "Flow_Byts/s"


def test_sanitise_and_coerce(spark):
    rows = [("inf",), ("-inf",), ("nan",), (None,), ("2e6",), ("-3",), ("abc",)]
    df = spark.createDataFrame(rows, "s string").select(F.when(F.col("s") == "inf", float("inf")).when(
        F.col("s") == "-inf", float("-inf")).when(F.col("s") == "nan", float("nan")).otherwise(
        numeric.to_number(F.col("s"))).alias("v"))
    assert values(df.select(numeric.sanitise(F.col("v")))) == [1e6, -1e6, 0.0, 0.0, 1e6, -3.0, 0.0]
    assert values(df.select(numeric.missing_if_not_finite(F.col("v")))) == [None, None, None, None, 2e6, -3.0, None]


def test_number_or_default(spark):
    df = spark.createDataFrame([("0",), ("abc",), ("0.6",), (None,)], "s string")
    assert values(df.select(numeric.number_or(F.col("s"), 0.45))) == [0.45, 0.45, 0.6, 0.45]


def test_severity_action_threshold(spark):
    df = spark.createDataFrame([(0.85,), (0.7,), (0.6999,)], "s double")
    level = scores.severity(F.col("s"))
    assert values(df.select(level)) == ["High", "Medium", "Low"]
    assert values(df.select(scores.suggested_action(level))) == ["Block/Isolate host", "Alert SOC", "Log only"]
    assert values(df.select(scores.threshold_label(F.col("s"), 0.7))) == ["ANOMALY", "ANOMALY", "NORMAL"]


def test_rule_detector_on_sample_requests(spark):
    rows = [(396475.77, 8810.57, 1.0), (9999999.99, 50000.0, 500.0), (1200.5, 100.2, 5.0), (None, None, 101.0)]
    df = spark.createDataFrame(rows, "b double, p double, f double")
    assert values(df.select(scores.rule_detector(F.col("b"), F.col("p"), F.col("f")))) == [False, True, False, True]


def test_uk_time_and_quotes(spark):
    df = spark.createDataFrame([("2026-12-01 14:05:09",), ("soon",), (None,)], "t string")
    now = F.to_timestamp(F.lit("2020-01-02 03:04:05"))
    assert values(df.select(text.uk_time(F.col("t"), now))) == ["01/12/2026, 14:05:09", "soon", "02/01/2020, 03:04:05"]
    assert values(spark.createDataFrame([('"x"',)], "t string").select(text.without_quotes(F.col("t")))) == ["x"]


def test_messages_and_ids(spark):
    df = spark.createDataFrame([("ANOMALY", "High", 0.987, 3)], "l string, s string, p double, n int")
    row = df.select(text.alert_message(F.col("l"), F.col("s")), text.status_message(F.lit("Resolved")),
                    text.analysis_message(F.col("l"), F.col("p")), text.request_message(F.col("n")),
                    text.stable_id("a", F.col("n"))).first()
    assert list(row)[:4] == ["Alert created: ANOMALY (High)", "Alert status updated to: Resolved",
                             "Analysis completed: ANOMALY (score: 0.99)", "Request received - analysing 3 item(s)"]
    assert len(row[4]) == 36
