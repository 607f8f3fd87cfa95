import pytest
from pyspark.sql import functions as F

from flowlens.functions import labels
from flowlens.operators import harmonise
from flowlens.plans import ingest
from flowlens.sources import files, positions, requests, service_tables, sinks, units


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)


def test_csv_with_byte_order_mark_and_infinity(spark, tmp_path):
    write(tmp_path / "x.csv", "a,Flow Byts/s\n1,inf\n2,\n", "utf-8-sig")
    df = files.load_csv(spark, str(tmp_path / "x.csv"))
    assert df.columns == ["a", "Flow Byts/s"]
    assert dict(df.dtypes) == {"a": "int", "Flow Byts/s": "double"}
    assert [r[1] for r in df.orderBy("a").collect()] == [float("inf"), None]


def test_malformed_rows_are_kept_or_dropped(spark, tmp_path):
    write(tmp_path / "x.csv", "a,b\n1,2\nx,3\n")
    kept = files.load_csv(spark, str(tmp_path / "x.csv"), "a int, b int, bad string", corrupt_column="bad")
    assert sorted((r["b"], r["bad"]) for r in kept.collect()) == [(2, None), (3, "x,3")]
    assert files.load_csv(spark, str(tmp_path / "x.csv"), "a int, b int", bad_rows="DROPMALFORMED").select("a", "b").collect() == [(1, 2)]


def test_upload_preview(spark, tmp_path):
    write(tmp_path / "x.csv", "a,b\n1,2\n3,4\n")
    assert files.upload_preview(spark, str(tmp_path / "x.csv")).first()["rows"] == 2


def test_recursive_discovery_any_case(spark, tmp_path):
    write(tmp_path / "a" / "one.csv", "v\n1\n")
    write(tmp_path / "b" / "two.CSV", "v\n2\n")
    write(tmp_path / "b" / "note.txt", "v\n3\n")
    df = files.with_source(files.load_csv(spark, str(tmp_path), "v int", recursive=True), "source_file", "scenario")
    assert sorted(map(tuple, df.collect())) == [(1, "one.csv", "a"), (2, "two.CSV", "b")]


def test_manifest_and_pairs(spark, tmp_path):
    write(tmp_path / "mirai" / "Mirai_dataset.csv", "v\n1\n")
    write(tmp_path / "mirai" / "Mirai_labels.csv", "x\n0\n")
    write(tmp_path / "ssdp" / "SSDP_dataset.csv", "v\n1\n")
    write(tmp_path / "readme.md", "no data")
    found = files.manifest(spark, str(tmp_path))
    assert found.count() == 3
    pairs = {r["scenario"]: r["labels_path"] for r in files.pair_label_files(found).collect()}
    assert pairs["mirai"].endswith("Mirai_labels.csv") and pairs["ssdp"] is None


@pytest.fixture
def mixed_units(tmp_path):
    write(tmp_path / "a.csv", " f ,label\n1,BENIGN\n2,ddos\n")
    write(tmp_path / "b.csv", "g,f,Class\n7,3,normal\n8,4,0\n9,5,scan\n")
    write(tmp_path / "c.csv", "f,what\n1,2\n")
    write(tmp_path / "d.csv", "\n")
    return str(tmp_path)


def test_units_with_different_headers_merge_by_name(spark, mixed_units):
    candidates = labels.LABEL_CANDIDATES["ids2025"]
    status = {r["path"].split("/")[-1]: (r["status"], r["label_column"])
              for r in units.label_status(units.unit_headers(spark, mixed_units), candidates).collect()}
    assert status == {"a.csv": ("ok", "label"), "b.csv": ("ok", "Class"), "c.csv": ("no label", None), "d.csv": ("empty", None)}
    found = units.merge_units(spark, mixed_units, candidates)
    merged = found.table
    assert {r["path"].split("/")[-1]: r["status"] for r in found.status.collect()} == {k: v[0] for k, v in status.items()}
    assert merged.columns[-1] == "class" and set(merged.columns) == {"f", "g", "label", "source_label", "source_file", "class"}
    assert found.source_labels == ["label", "source_label"]
    rows = sorted((r["source_file"], r["f"], r["class"]) for r in merged.collect())
    assert rows == [("a.csv", 1, "normal"), ("a.csv", 2, "anomaly"), ("b.csv", 3, "normal"), ("b.csv", 4, "normal"), ("b.csv", 5, "anomaly")]


def test_unit_fallback_takes_last_column(spark, mixed_units):
    status = units.label_status(units.unit_headers(spark, mixed_units), labels.LABEL_CANDIDATES["ids2025"], "last")
    assert {r["path"].split("/")[-1]: r["label_column"] for r in status.collect()}["c.csv"] == "what"


def test_unit_and_total_caps(spark, tmp_path):
    for name in "abc":
        write(tmp_path / f"{name}.csv", "f,label\n" + "".join(f"{i},x\n" for i in range(40)))
    merged = units.merge_units(spark, str(tmp_path), ["label"], total_cap=70).table
    assert {r["source_file"]: r["rows"] for r in units.unit_report(merged).collect()} == {"a.csv": 40, "b.csv": 40}
    capped = units.merge_units(spark, str(tmp_path), ["label"], unit_cap=10).table
    assert {r["source_file"]: r["rows"] for r in units.unit_report(capped).collect()} == {"a.csv": 10, "b.csv": 10, "c.csv": 10}


def test_csv_positions_over_many_splits(spark, tmp_path):
    write(tmp_path / "long.csv", "v\n" + "".join(f"{i}\n" for i in range(20000)))
    write(tmp_path / "short.csv", "w\n" + "".join(f"{i}\n" for i in range(500)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        scan = files.load_csv(spark, [str(tmp_path / "long.csv")], "v long")
        assert scan.rdd.getNumPartitions() > 5
        rows = positions.csv_rows(scan)
        assert rows.count() == 20000 and rows.filter(F.col("v") != F.col(positions.ROW)).isEmpty()
        other = positions.csv_rows(files.load_csv(spark, [str(tmp_path / "short.csv")], "w long"))
        zipped = positions.zip_rows(rows, other.select(positions.ROW, "w"), "w")
        assert zipped.count() == 500 and zipped.filter("v <> w").isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_zip_label_replaces_feature_of_same_name(spark):
    left = spark.createDataFrame([(0, "a", 1), (1, "b", 2)], "row_idx long, label string, f int")
    right = spark.createDataFrame([(0, "x")], "row_idx long, label string")
    assert [tuple(r) for r in positions.zip_rows(left, right, "label").select("f", "label").collect()] == [(1, "x")]


def test_scenario_build_zips_pairs(spark, tmp_path):
    write(tmp_path / "mirai" / "Mirai_dataset.csv", "f,g\n" + "".join(f"{i},{i}\n" for i in range(5)))
    write(tmp_path / "mirai" / "Mirai_labels.csv", "x\n0\n1\n0\n")
    write(tmp_path / "lost" / "Lost_dataset.csv", "f\n1\n")
    rows = sorted((r["f"], r["class"], r["scenario"]) for r in ingest.build_kitsune(spark, str(tmp_path)).table.collect())
    assert rows == [(0, "normal", "mirai"), (1, "anomaly", "mirai"), (2, "normal", "mirai")]


def test_chunked_build_samples_each_chunk(spark, tmp_path):
    write(tmp_path / "nf.csv", "IPV6_SRC_ADDR,v,Attack,Label\n" + "".join(f"x,{i},Benign,{i % 2}\n" for i in range(1000)))
    built = ingest.build_nfuq(spark, str(tmp_path / "nf.csv"), 0.1, 200).table
    rows = built.collect()
    assert "IPV6_SRC_ADDR" not in built.columns and built.columns[-1] == "class"
    assert len(rows) == 100 and {sum(r["v"] // 200 == c for r in rows) for c in range(5)} == {20}
    assert all(r["class"] == ("anomaly" if r["v"] % 2 else "normal") for r in rows)


def test_balanced_build_per_file(spark, tmp_path):
    write(tmp_path / "big.csv", "src_ip,v,label\n" + "".join(f"h,{i},{'benign' if i < 90 else 'outlier'}\n" for i in range(100)))
    write(tmp_path / "small.csv", "src_ip,v,label\n" + "".join(f"h,{i},malicious\n" for i in range(30)))
    built = ingest.build_luflow(spark, str(tmp_path), file_rows=40).table
    counts = {(r["source_file"], r["class"]): r["count"] for r in built.groupBy("source_file", "class").count().collect()}
    assert counts == {("big.csv", "normal"): 20, ("big.csv", "anomaly"): 10, ("small.csv", "anomaly"): 30}
    assert "src_ip" not in built.columns


def test_calibration_file(spark, tmp_path):
    write(tmp_path / "c.csv", 'anomaly_score,class\n0.1,normal\n\n"0.2",normal\nx,normal\n')
    rows = files.load_calibration(spark, str(tmp_path / "c.csv")).collect()
    assert [(r["score"], r["label"]) for r in rows] == [(0.1, "normal"), (0.2, "normal"), (None, "normal")]
    with pytest.raises(ValueError):
        files.load_calibration(spark, str(tmp_path / "c.csv"), score="p")
    write(tmp_path / "empty.csv", "anomaly_score\n")
    with pytest.raises(ValueError):
        files.load_calibration(spark, str(tmp_path / "empty.csv"))


def test_requests_and_alignment(spark):
    bodies = [(1, '{"items":[{"features":{"a":1,"z":9}},{"features":{"b":2.5}}]}'), (2, "{oops"), (3, '{"items":[]}'), (4, '{"items":[{}]}')]
    parsed = requests.read_requests(spark.createDataFrame(bodies, "id int, body string"), "body", ["id"])
    items = parsed.accepted.select("id", "item_no", requests.align_features(F.col("features"), ["a", "b"]).alias("x"))
    assert [tuple(r) for r in items.orderBy("item_no").collect()] == [(1, 0, [1.0, 0.0]), (1, 1, [0.0, 2.5])]
    assert sorted(r["id"] for r in parsed.rejected.collect()) == [2, 3, 4]


def test_responses(spark):
    bodies = [(1, '{"results":[{"anomaly_score":0.9}]}'), (2, '{"raw_proba":{"anomaly":0.2,"normal":0.8}}'),
              (3, '{"raw_proba":{"anomaly":0.2}}'), (4, "oops")]
    parsed = requests.read_responses(spark.createDataFrame(bodies, "id int, body string"), "body", keep=["id"])
    rows = {r["id"]: (r["predicted_label"], r["anomaly_score"], round(r["raw_proba"]["normal"], 6)) for r in parsed.accepted.collect()}
    assert rows == {1: ("ANOMALY", 0.9, 0.1), 2: ("NORMAL", 0.2, 0.8)}
    assert sorted(r["id"] for r in parsed.rejected.collect()) == [3, 4]


def test_settings_upsert_seed_and_types(spark, tmp_path):
    from datetime import datetime

    root = str(tmp_path)
    first = service_tables.settings_changes({"anomalyThreshold": 0.6, "autoCreateAlert": False}, spark, datetime(2026, 1, 1))
    second = service_tables.settings_changes({"anomalyThreshold": 0}, spark, datetime(2026, 1, 2))
    service_tables.append_table(first, root, "settings")
    service_tables.append_table(second, root, "settings")
    current = service_tables.current_settings(service_tables.read_table(spark, root, "settings"))
    assert {r["key"]: r["value"] for r in current.collect()} == {"anomalyThreshold": "0", "autoCreateAlert": "false"}
    row = service_tables.effective_settings(current).first()
    assert tuple(row) == (0.45, False, True, "http://localhost:8000/predict")
    assert sorted(r["key"] for r in service_tables.seed_settings(current).collect()) == ["apiUrl", "autoSmartThreshold"]


def test_clear_table(spark, tmp_path):
    root = str(tmp_path)
    row = spark.createDataFrame([("1", None, "status", "m", None, None)], service_tables.LOGS)
    service_tables.append_table(row, root, "logs")
    service_tables.clear_table(spark, root, "logs")
    assert service_tables.read_table(spark, root, "logs").count() == 0


def test_alert_export_quotes_the_time(spark, tmp_path):
    alerts = spark.createDataFrame([("1", "ANOMALY", 0.9, "High", "Block/Isolate host", "New")],
                                   "id string, label string, anomaly_score double, severity string, action string, status string")
    alerts = alerts.withColumn("time", F.to_timestamp(F.lit("2026-12-01 14:05:09")))
    sinks.write_export(sinks.alert_export(alerts.coalesce(1)), str(tmp_path / "out"))
    lines = [line for f in (tmp_path / "out").glob("*.csv") for line in f.read_text().splitlines()]
    assert lines == ["Time,Label,Anomaly Score,Severity,Action,Status", '"01/12/2026, 14:05:09",ANOMALY,0.9,High,Block/Isolate host,New']


def test_result_documents_have_one_form(spark):
    results = spark.range(25).select(F.lit("b").alias("batch_id"), F.col("id").alias("item_no"), F.lit(0.5).alias("anomaly_score"))
    summary = spark.createDataFrame([("b", 25)], "batch_id string, total int")
    documents = sinks.result_documents(results, summary).collect()
    assert sorted(r["kind"] for r in documents) == ["result"] * 25 + ["summary"]
    assert [r["document"] for r in documents if r["kind"] == "summary"] == ['{"total":25}']


def test_header_of_any_length(spark, tmp_path):
    names = ",".join(f"column_{i}" for i in range(6000))
    write(tmp_path / "wide.csv", f'{names},"odd, ""name""\nhere",Label\n' + ",".join("1" * 6000) + ",x,BENIGN\n")
    header, error = units.read_header(str(tmp_path / "wide.csv"))
    assert error is None and len(header) == 6002 and header[-1] == "Label" and header[-2] == 'odd, "name"\nhere'
    status = units.label_status(units.unit_headers(spark, str(tmp_path)), ["Label"]).first()
    assert (status["status"], status["label_column"]) == ("ok", "Label")


def test_schemes_without_a_file_system_raise():
    with pytest.raises(Exception, match="(?i)scheme|filesystem|protocol"):
        units.read_header("wasbx://container/file.csv")
    assert units.read_header("/nowhere/at/all.csv")[1]


def test_files_of_one_name_are_units_of_their_own(spark, tmp_path):
    for folder in "ab":
        write(tmp_path / folder / "day.csv", "v,label\n" + "".join(f"{i},{'benign' if i % 2 else 'outlier'}\n" for i in range(30)))
    write(tmp_path / "c" / "none.csv", "v,what\n1,2\n")
    built = ingest.build_luflow(spark, str(tmp_path), file_rows=40)
    assert built.table.count() == 60
    status = sorted((r["path"].split("/")[-2], r["status"], r["rows"], r["kept"]) for r in built.status.collect())
    assert status == [("a", "ok", 30, 30), ("b", "ok", 30, 30), ("c", "no label", 0, 0)]
    assert ingest.build_ids2025(spark, str(tmp_path)).table.count() == 61


def test_parquet_positions_over_many_files(spark, tmp_path):
    for name in ("one", "two"):
        spark.range(100).repartition(4).write.parquet(str(tmp_path / name))
    one = positions.parquet_rows(spark, str(tmp_path / "one"))
    two = positions.parquet_rows(spark, str(tmp_path / "two")).withColumnRenamed("id", "label")
    assert sorted(r[0] for r in one.select(positions.ROW).collect()) == list(range(100))
    assert positions.zip_rows(one, two, "label").count() == 100


def test_labels_of_label_files_are_no_features(spark, tmp_path):
    from flowlens.plans import fusion

    write(tmp_path / "m" / "M_dataset.csv", "f,g\n" + "".join(f"{i},{i}\n" for i in range(5)))
    write(tmp_path / "m" / "M_labels.csv", "x\n" + "0\n1\n" * 3)
    built = ingest.build_kitsune(spark, str(tmp_path))
    assert built.source_labels == ["x"]
    assert set(fusion.fuse({"K": built}).columns) == {"f", "g", "class", "dataset"}


def test_blocks_beyond_the_cap_are_not_stored(spark, tmp_path):
    write(tmp_path / "nf.csv", "v,Label\n" + "".join(f"{i},{i % 2}\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        scan = files.load_csv(spark, str(tmp_path / "nf.csv"), "v long, Label int")
        some = positions.csv_rows(scan, 3000)
        assert 3000 <= some.count() < 6000 and some.filter(F.col("v") != F.col(positions.ROW)).isEmpty()
        built = ingest.build_nfuq(spark, str(tmp_path / "nf.csv"), 0.1, 1000, total_cap=250).table
        assert built.count() == 300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_headers_and_types(spark):
    df = spark.createDataFrame([(1, True, "x", 2.0)], " a int, `Flow  Byts/s ` boolean, s string, class double")
    renamed, target = harmonise.normalise_headers(df, " class ")
    assert renamed.columns == ["a", "Flow_Byts/s", "s", "class"] and target == "class"
    assert harmonise.feature_types(renamed, ["class"]) == (["a", "Flow_Byts/s"], ["s"])
    assert harmonise.class_last(renamed.select("class", "a")).columns == ["a", "class"]
    with pytest.raises(ValueError):
        harmonise.require_column(df, "nothing")


def test_malformed_rows_are_counted_per_unit(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", "f,g,label\n1,2,BENIGN\n3,4\n5,6,ddos,7\n8,9,BENIGN\n")
    write(tmp_path / "in" / "b.csv", "f,g,label\n1,2,BENIGN\n")
    write(tmp_path / "in" / "c.csv", "f,g,what\n1,2,3\n")
    built = {how: ingest.build_luflow(spark, str(tmp_path / "in"), bad_rows=how) for how in ("keep", "drop")}
    found = {how: sorted((r["path"].rsplit("/", 1)[1], r["status"], r["rows"], r["malformed"], r["kept"]) for r in b.status.collect()) for how, b in built.items()}
    assert found["keep"] == [("a.csv", "ok", 4, 2, 4), ("b.csv", "ok", 1, 0, 1), ("c.csv", "no label", 0, 0, 0)]
    assert found["drop"] == [("a.csv", "ok", 4, 2, 2), ("b.csv", "ok", 1, 0, 1), ("c.csv", "no label", 0, 0, 0)]
    assert built["keep"].table.count() == 5 and built["drop"].table.count() == 3
    assert built["drop"].table.columns == built["keep"].table.columns == ["f", "g", "label", "source_file", "class"]
    with pytest.raises(ValueError):
        ingest.build_luflow(spark, str(tmp_path / "in"), bad_rows="ignore")


def test_reading_itself_counts_rows(spark, tmp_path):
    write(tmp_path / "a.csv", "f,label\n1,BENIGN\nx,ddos\n3,ddos\n")
    merged = {how: units.merge_units(spark, str(tmp_path), ["label"], schema="f int, label string", bad_rows=how, count_rows=how == "keep") for how in units.BAD_ROWS}
    assert merged["drop"].table.count() == 2
    assert sorted(r["f"] or 0 for r in merged["keep"].table.collect()) == [0, 1, 3]
    assert merged["keep"].counts.get == {"rows": 3, "malformed": 1}
    with pytest.raises(Exception, match="malformed row in"):
        merged["fail"].table.collect()


def test_an_open_quote_in_a_header_is_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(units, "HEADER_BYTES", 1000)
    write(tmp_path / "open.csv", 'a,"b\n' + "1,2\n" * 100_000)
    write(tmp_path / "long.csv", "x" * 5_000_000)
    write(tmp_path / "wide.csv", ",".join(f"c{k}" for k in range(100)) + "\n1\n")
    for name in ("open.csv", "long.csv"):
        header, error = units.read_header(str(tmp_path / name))
        assert header == [] and "first record" in error
    assert len(units.read_header(str(tmp_path / "wide.csv"))[0]) == 100


def test_ledger_gives_positions_without_a_copy(spark, tmp_path):
    write(tmp_path / "one.csv", "v\n" + "".join(f"{k}\n" for k in range(5000)))
    write(tmp_path / "two.csv", "v\n" + "".join(f"{5000 + k}\n" for k in range(70)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        scan = files.load_csv(spark, str(tmp_path), "v long")
        known = positions.ledger(scan)
        assert known.count() > 3
        rows = positions.csv_rows(scan, whole=True, blocks=known)
        assert rows.count() == 5070 and rows.filter("v <> row_idx").isEmpty()
        each = positions.csv_rows(scan)
        assert each.filter("row_idx <> CASE WHEN v < 5000 THEN v ELSE v - 5000 END").isEmpty()
        cut = positions.csv_rows(scan, 100, whole=True, blocks=known)
        assert 100 <= cut.count() < 5070 and cut.filter("v = 99").count() == 1
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
        with pytest.raises(Exception, match="not a block of the ledger"):
            positions.csv_rows(files.load_csv(spark, str(tmp_path), "v long"), blocks=known).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_chunks_report_rows_and_kept(spark, tmp_path):
    write(tmp_path / "nf" / "one.csv", "f,Label\n" + "".join(f"{k},0\n" for k in range(450)))
    write(tmp_path / "nf" / "two.csv", "f,Label\n" + "".join(f"{k},1\n" for k in range(450, 600)))
    built = ingest.build_nfuq(spark, str(tmp_path / "nf"), 0.1, 200)
    assert sorted((r["chunk"], r["rows"], r["kept"]) for r in built.status.collect()) == [(0, 200, 20), (1, 200, 20), (2, 200, 20)]
    assert built.table.count() == 60
    assert built.table.filter("f < 200").count() == 20
