"""Ingest, labels, fusion, samples, splits, cleaning and encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions import labels, text
from flowlens.operators import cleaning, encoding, matching, profile, sampling
from flowlens.plans import fusion, ingest
from flowlens.session import scratch_path
from flowlens.sources import files, positions, units
from flowlens.workload import bindings as b

# --- labels to classes ---------------------------------------------------------------------

RAW_LABEL = """CASE event_type WHEN 'click' THEN ' BENIGN ' WHEN 'view' THEN 'background' WHEN 'purchase' THEN '0'
                   WHEN 'signup' THEN 'DDoS' END"""


def label_to_class_string(spark, sf):
    """Three token rules on one text label; errors have no label."""
    rows = b.table(spark, sf, "events").select("event_id", F.expr(RAW_LABEL).alias("label"))
    kind = rows.schema["label"].dataType
    return rows.select("event_id", *[
        labels.class_of(F.col("label"), kind, tokens).alias(name) for name, tokens in
        (("ids2025", labels.IDS2025_TOKENS), ("kitsune", labels.KITSUNE_TOKENS), ("nfuq", labels.NFUQ_TOKENS))])


LABEL_TO_CLASS_STRING = f"""WITH cleaned AS (SELECT event_id, lower(trim({RAW_LABEL})) AS label FROM events)
SELECT event_id, CASE WHEN label IS NULL THEN NULL WHEN label IN ('benign', 'normal', 'background', '0') THEN 'normal' ELSE 'anomaly' END AS ids2025,
       CASE WHEN label IS NULL THEN NULL WHEN label IN ('benign', 'normal', '0') THEN 'normal' ELSE 'anomaly' END AS kitsune,
       CASE WHEN label IS NULL THEN NULL WHEN label IN ('benign', 'normal') THEN 'normal' ELSE 'anomaly' END AS nfuq FROM cleaned"""


def document_labels(spark: SparkSession, sf: str) -> DataFrame:
    documents = b.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(b.table(spark, sf, "labels"), "doc_id", "left")


def label_to_class_numeric(spark, sf):
    """0 is normal, other numbers are not; a missing label stays missing or counts as anomaly."""
    rows = document_labels(spark, sf)
    kind = rows.schema["toxic"].dataType
    return rows.select("doc_id", labels.class_of(F.col("toxic"), kind).alias("class"),
                       labels.class_of(F.col("toxic"), kind, null_label=labels.ANOMALY).alias("class_strict"))


LABEL_TO_CLASS_NUMERIC = """SELECT d.doc_id, CASE WHEN toxic IS NULL THEN NULL WHEN toxic = 0 THEN 'normal' ELSE 'anomaly' END AS class,
       CASE WHEN toxic = 0 THEN 'normal' ELSE 'anomaly' END AS class_strict
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

PASSED_LABEL = "CASE event_type WHEN 'error' THEN 'Malicious' WHEN 'click' THEN 'BENIGN' WHEN 'view' THEN 'outlier' WHEN 'signup' THEN 'Odd' END"


def label_to_class_passthrough(spark, sf):
    rows = b.table(spark, sf, "events").select("event_id", F.expr(PASSED_LABEL).alias("label"))
    return rows.select("event_id", labels.class_passthrough(F.col("label")).alias("class"),
                       labels.class_for_calibration(F.col("label")).alias("calibration"))


LABEL_TO_CLASS_PASSTHROUGH = f"""WITH cleaned AS (SELECT event_id, lower({PASSED_LABEL}) AS label FROM events)
SELECT event_id, CASE label WHEN 'benign' THEN 'normal' WHEN 'malicious' THEN 'anomaly' WHEN 'outlier' THEN 'anomaly' ELSE label END AS class,
       CASE label WHEN 'benign' THEN 'normal' WHEN 'malicious' THEN 'anomaly' WHEN 'outlier' THEN 'anomaly' END AS calibration FROM cleaned"""


def label_to_class_boolean(spark, sf):
    rows = b.table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") > 200000).alias("flag"))
    return rows.select("o_orderkey", labels.class_of(F.col("flag"), rows.schema["flag"].dataType).alias("class"))


LABEL_TO_CLASS_BOOLEAN = """SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'anomaly' ELSE 'normal' END AS class FROM orders"""

# --- fusion --------------------------------------------------------------------------------


def sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Four labelled datasets with overlapping columns; each still carries its source label.

    ``kind`` has nothing to do with the class. ``amount`` decides the class of customers, a rule left in on purpose.
    """
    def classed(condition) -> F.Column:
        return F.when(condition, "Anomaly").otherwise("Normal").alias("class")

    orders, items = b.table(spark, sf, "orders"), b.table(spark, sf, "lineitem")
    events, customers = b.table(spark, sf, "events"), b.table(spark, sf, "customer")
    return {
        "orders": orders.select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("kind"),
                                F.col("o_orderstatus").alias("Label"), classed(F.col("o_orderstatus") == "F")),
        "lineitem": items.select(F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("amount"), F.col("l_linestatus").alias("kind"),
                                 F.col("l_quantity").alias("quantity"), F.when(F.col("l_returnflag") == "A", "A").otherwise("B").alias("Attack"), classed(F.col("l_returnflag") == "A")),
        "events": events.select(F.col("event_id").alias("key"), F.col("value").alias("amount"), F.concat(F.lit("u"), (F.col("user_id") % 3).cast("string")).alias("kind"),
                                F.col("props").alias("scenario"), classed(F.col("event_type") == "error")),
        "customer": customers.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("amount"),
                                     F.col("c_name").alias("name"), classed(F.col("c_acctbal") < 0)),
    }


SOURCES = """fused AS (
    SELECT 'orders' AS dataset, o_orderkey AS key, o_totalprice AS amount, o_orderpriority AS kind, CAST(NULL AS DOUBLE) AS quantity, CAST(NULL AS VARCHAR) AS name,
           CASE WHEN o_orderstatus = 'F' THEN 'anomaly' ELSE 'normal' END AS class FROM orders
    UNION ALL SELECT 'lineitem', l_orderkey, l_extendedprice, l_linestatus, l_quantity, NULL,
           CASE WHEN l_returnflag = 'A' THEN 'anomaly' ELSE 'normal' END FROM lineitem
    UNION ALL SELECT 'events', event_id, value, 'u' || user_id % 3, NULL, NULL, CASE WHEN event_type = 'error' THEN 'anomaly' ELSE 'normal' END FROM events
    UNION ALL SELECT 'customer', c_custkey, c_acctbal, NULL, NULL, c_name, CASE WHEN c_acctbal < 0 THEN 'anomaly' ELSE 'normal' END FROM customer)"""


def fuse_sources(spark, sf):
    return fusion.fuse(sources(spark, sf))


FUSE_SOURCES = f"WITH {SOURCES} SELECT * FROM fused"


def fuse_sources_capped(spark, sf):
    """At most 1000 rows of each dataset; items have no key and are drawn by their whole row."""
    keys = {"orders": ["key"], "events": ["key"], "customer": ["key"]}
    return fusion.fuse(sources(spark, sf), cap=1000, keys=keys)


FUSE_SOURCES_CAPPED = f"""WITH {SOURCES}, hashed AS (
    SELECT *, md5(CASE WHEN dataset = 'lineitem' THEN concat_ws('|', '42', CAST(key AS VARCHAR), CAST(amount AS VARCHAR), kind, CAST(quantity AS VARCHAR), CASE class WHEN 'anomaly' THEN 'A' ELSE 'B' END,
                       CASE class WHEN 'anomaly' THEN 'Anomaly' ELSE 'Normal' END) ELSE '42|' || key END) AS h FROM fused)
SELECT * EXCLUDE (h, place) FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY h) AS place FROM hashed) WHERE place <= 1000"""


def class_distribution(spark, sf):
    fused = fusion.fuse(sources(spark, sf))
    return profile.class_distribution(fused, "class", "dataset").withColumn("share", F.round("share", 6))


CLASS_DISTRIBUTION = f"""WITH {SOURCES}
SELECT dataset, class, count(*) AS count, CAST(sum(count(*)) OVER (PARTITION BY dataset) AS BIGINT) AS total,
       round(count(*) / sum(count(*)) OVER (PARTITION BY dataset), 6) AS share FROM fused GROUP BY dataset, class"""


def class_distribution_all(spark, sf):
    fused = fusion.fuse(sources(spark, sf))
    return profile.class_distribution(fused, "class").withColumn("share", F.round("share", 6))


CLASS_DISTRIBUTION_ALL = f"""WITH {SOURCES}
SELECT class, count(*) AS count, CAST(sum(count(*)) OVER () AS BIGINT) AS total, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM fused GROUP BY class"""


def encode_fused(spark, sf):
    """All features of the fused table: clipped numbers, dummies of kind and dataset, names dropped."""
    encoded = fusion.encode_fused(fusion.fuse(sources(spark, sf)))
    return encoded.table.select("class", *[text.col(c) for c in encoded.features])


KINDS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "F", "O", "u0", "u1", "u2")
ENCODE_FUSED = f"""WITH {SOURCES}
SELECT class, CAST(least(1e6, key) AS DOUBLE) AS key, least(1e6, greatest(-1e6, amount)) AS amount, coalesce(quantity, 0.0) AS quantity,
       {", ".join(f"CAST(dataset = '{d}' AS DOUBLE) AS dataset_{d}" for d in ("orders", "lineitem", "events", "customer"))},
       {", ".join(f"CAST(coalesce(kind = '{k}', false) AS DOUBLE) AS " + chr(34) + "kind_" + k + chr(34) for k in KINDS)} FROM fused"""


def fused_feature_names(spark, sf):
    """Feature order of the fused table."""
    encoded = fusion.encode_fused(fusion.fuse(sources(spark, sf)))
    rows = [(i, name) for i, name in enumerate(encoded.features)]
    return spark.createDataFrame(rows, "position int, feature string")


FUSED_FEATURE_NAMES = f"""WITH {SOURCES}, names AS (
    SELECT 0 AS part, feature FROM (VALUES ('key'), ('amount'), ('quantity')) v(feature)
    UNION ALL SELECT DISTINCT 1, 'kind_' || kind FROM fused WHERE kind IS NOT NULL
    UNION ALL SELECT DISTINCT 2, 'dataset_' || dataset FROM fused)
SELECT CAST(row_number() OVER (ORDER BY part, CASE feature WHEN 'key' THEN 0 WHEN 'amount' THEN 1 WHEN 'quantity' THEN 2 END, feature) - 1 AS INTEGER) AS position,
       feature FROM names"""

# --- counting ------------------------------------------------------------------------------


def value_counts(spark, sf):
    return profile.value_counts(b.table(spark, sf, "lineitem"), "l_quantity", 15)


VALUE_COUNTS = """SELECT l_quantity AS value, count(*) AS count FROM lineitem GROUP BY 1 ORDER BY count DESC, value LIMIT 15"""


def value_counts_with_null(spark, sf):
    return profile.value_counts(document_labels(spark, sf), "toxic", keep_null=True)


VALUE_COUNTS_WITH_NULL = """SELECT toxic AS value, count(*) AS count FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1"""

COUNTED = ("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey")


def distinct_counts(spark, sf):
    return profile.distinct_counts(b.table(spark, sf, "lineitem"), COUNTED)


DISTINCT_COUNTS = " UNION ALL ".join(f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_distinct FROM lineitem" for c in COUNTED)


def low_cardinality_columns(spark, sf):
    return profile.low_cardinality(b.table(spark, sf, "lineitem"), limit=30)


LOW_CARDINALITY_COLUMNS = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_distinct FROM lineitem" for c in (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")) + ") WHERE n_distinct <= 30"


def table_shape(spark, sf):
    return profile.shape(b.table(spark, sf, "lineitem"))


TABLE_SHAPE = "SELECT count(*) AS rows, CAST(11 AS INTEGER) AS columns FROM lineitem"


def distinct_labels(spark, sf):
    return profile.distinct_labels(b.table(spark, sf, "part"), "p_brand")


DISTINCT_LABELS = "SELECT DISTINCT p_brand FROM part ORDER BY p_brand LIMIT 20"

# --- files and positions -------------------------------------------------------------------


def order_files(spark: SparkSession, sf: str, label: str = "Label") -> str:
    """Orders as CSV files in one folder per priority."""
    root = scratch_path(spark, "orders-csv")
    rows = b.table(spark, sf, "orders").withColumn("scenario", F.substring("o_orderpriority", 1, 1))
    rows.withColumnRenamed("o_orderstatus", label).write.partitionBy("scenario").option("header", True).csv(root)
    return root


def csv_scan(spark, sf):
    """Customers written as CSV and read back with a declared schema."""
    root = scratch_path(spark, "customer-csv")
    customers = b.table(spark, sf, "customer")
    customers.write.option("header", True).csv(root)
    return files.load_csv(spark, root, customers.schema, recursive=True)


CSV_SCAN = "SELECT * FROM customer"


def csv_inferred(spark, sf):
    """Types inferred from text: numbers, and infinities among them."""
    root = scratch_path(spark, "inferred-csv")
    priced = b.table(spark, sf, "part").withColumn("ratio", F.when(F.col("p_size") == 1, float("inf")).otherwise(F.col("p_retailprice") / F.col("p_size")))
    priced.write.option("header", True).option("positiveInf", "inf").csv(root)
    cleaned = cleaning.infinities_to_null(files.load_csv(spark, root, recursive=True))
    return cleaned.select("p_partkey", "p_brand", "p_size", F.round("ratio", 6).alias("ratio"))


CSV_INFERRED = """SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_brand, p_size,
       CASE WHEN p_size <> 1 THEN round(p_retailprice / p_size, 6) END AS ratio FROM part"""


def csv_merged_units(spark, sf):
    """All order files found, labelled, classed and merged; classes counted per folder."""
    merged = units.merge_units(spark, order_files(spark, sf), labels.LABEL_CANDIDATES["ids2025"], normal_tokens=("o", "p")).table
    return merged.groupBy("class", F.col("Label").alias("label")).agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("amount"))


CSV_MERGED_UNITS = """SELECT CASE WHEN o_orderstatus IN ('O', 'P') THEN 'normal' ELSE 'anomaly' END AS class, o_orderstatus AS label,
       count(*) AS rows, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY ALL"""


def unit_status(spark, sf):
    """Header check of every order file: how many folders have usable files, and their label."""
    checked = units.label_status(units.unit_headers(spark, order_files(spark, sf)), labels.LABEL_CANDIDATES["ids2025"])
    return checked.groupBy(text.parent_name(F.col("path")).alias("folder"), "label_column", "status").agg(
        (F.count(F.lit(1)) > 0).alias("present"))


UNIT_STATUS = """SELECT DISTINCT 'scenario=' || substr(o_orderpriority, 1, 1) AS folder, 'Label' AS label_column, 'ok' AS status, true AS present FROM orders"""


def unit_rows(spark, sf):
    """Status of every order file, rows read and rows kept, summed per folder; one file has no label."""
    root = order_files(spark, sf, "label")
    spark.createDataFrame([("1", "2")], "a string, b string").coalesce(1).write.option("header", True).csv(f"{root}/scenario=none")
    built = ingest.build_luflow(spark, root)
    return built.status.groupBy(text.parent_name(F.col("path")).alias("folder"), "status").agg(
        F.sum("rows").alias("rows"), F.sum("kept").alias("kept"))


UNIT_ROWS = """SELECT 'scenario=' || substr(o_orderpriority, 1, 1) AS folder, 'ok' AS status, count(*) AS rows, count(*) AS kept FROM orders GROUP BY 1
UNION ALL SELECT 'scenario=none', 'no label', CAST(0 AS BIGINT), CAST(0 AS BIGINT)"""


def unit_malformed(spark, sf):
    """Rows, malformed rows and kept rows per folder, where amounts that are no numbers were planted; and what the reading itself has observed."""
    root = scratch_path(spark, "planted")
    amount = F.when(F.col("o_orderkey") % 97 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    b.table(spark, sf, "orders").select("o_orderkey", amount.alias("o_totalprice"), F.col("o_orderstatus").alias("Label"),
                                        F.substring("o_orderpriority", 1, 1).alias("scenario")).write.partitionBy("scenario").option("header", True).csv(root)
    schema = "o_orderkey long, o_totalprice double, Label string"
    built = ingest.build_ids2025(spark, root, schema=schema, bad_rows="drop")
    merged = units.merge_units(spark, root, labels.LABEL_CANDIDATES["ids2025"], schema=schema, count_rows=True)
    merged.table.write.format("noop").mode("overwrite").save()
    seen = merged.counts.get
    return built.status.groupBy(text.parent_name(F.col("path")).alias("folder"), "status").agg(
        F.sum("rows").alias("rows"), F.sum("malformed").alias("malformed"), F.sum("kept").alias("kept")).withColumns(
        {"observed_rows": F.lit(seen["rows"]).cast("long"), "observed_malformed": F.lit(seen["malformed"]).cast("long")})


UNIT_MALFORMED = """WITH planted AS (SELECT 'scenario=' || substr(o_orderpriority, 1, 1) AS folder, o_orderkey % 97 = 0 AS bad FROM orders),
folders AS (SELECT folder, count(*) AS rows, count(*) FILTER (bad) AS malformed, count(*) FILTER (NOT bad) AS kept FROM planted GROUP BY folder)
SELECT folder, 'ok' AS status, rows, malformed, kept, CAST(sum(rows) OVER () AS BIGINT) AS observed_rows, CAST(sum(malformed) OVER () AS BIGINT) AS observed_malformed FROM folders"""


def pair_many_files(spark, sf):
    """Two tables of several files zipped by position: as many rows as the shorter table, none twice."""
    paths = [scratch_path(spark, "paired") for _ in range(2)]
    orders = b.table(spark, sf, "orders")
    orders.select("o_orderkey").repartition(4).write.parquet(paths[0])
    b.table(spark, sf, "customer").select(F.col("c_custkey").alias("Label")).repartition(3).write.parquet(paths[1])
    left, right = (positions.parquet_rows(spark, path) for path in paths)
    zipped = positions.zip_rows(left, right, "Label")
    return zipped.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_orderkey").alias("orders"), F.count_distinct("Label").alias("customers"))


PAIR_MANY_FILES = """SELECT n AS rows, n AS orders, n AS customers FROM (
    SELECT least((SELECT count(*) FROM orders), (SELECT count(*) FROM customer)) AS n)"""


def file_manifest(spark, sf):
    """Folders of the order files and whether they hold data."""
    found = files.manifest(spark, order_files(spark, sf))
    return found.groupBy(text.parent_name(F.col("path")).alias("folder")).agg((F.sum("length") > 0).alias("filled"))


FILE_MANIFEST = "SELECT DISTINCT 'scenario=' || substr(o_orderpriority, 1, 1) AS folder, true AS filled FROM orders"


def pair_features_labels(spark, sf):
    """Documents and labels side by side in file order, cut to the shorter file."""
    features = positions.parquet_rows(spark, f"{sf}/documents.parquet").select(positions.ROW, "doc_id", "lang", "n_chars")
    known = positions.parquet_rows(spark, f"{sf}/labels.parquet").select(positions.ROW, "toxic")
    zipped = positions.zip_rows(features, known, "toxic")
    return zipped.select("doc_id", "lang", "n_chars", "toxic",
                         labels.class_of(F.col("toxic"), known.schema["toxic"].dataType).alias("class"))


PAIR_FEATURES_LABELS = """SELECT doc_id, lang, n_chars, toxic, CASE WHEN toxic = 0 THEN 'normal' ELSE 'anomaly' END AS class
FROM (SELECT doc_id, lang, n_chars, row_number() OVER () AS place FROM documents) d
JOIN (SELECT toxic, row_number() OVER () AS place FROM labels) l ON d.place = l.place"""


def unpaired_features(spark, sf):
    return matching.unmatched(b.table(spark, sf, "documents").select("doc_id", "lang", "source"), b.table(spark, sf, "labels"), ["doc_id"])


UNPAIRED_FEATURES = "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"

# --- samples, splits, folds ----------------------------------------------------------------

KEYED = f"""{b.FLOWS}, keyed AS (SELECT event_id, class, ts, anomaly_score, md5('42|' || event_id) AS h FROM flows)"""


def keyed_flows(spark: SparkSession, sf: str) -> DataFrame:
    return b.flows(spark, sf).select("event_id", "class", "ts", "anomaly_score")


def cap_per_source(spark, sf):
    """At most 500 items per status; items have no key, so equal rows are interchangeable."""
    return sampling.cap_rows(b.table(spark, sf, "lineitem"), 500, ["l_linestatus"])


ITEM_HASH = """md5(concat_ws('|', '42', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
    CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR), CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR), l_returnflag, l_linestatus,
    CAST(l_shipdate AS VARCHAR)))"""
CAP_PER_SOURCE = f"""SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_linestatus ORDER BY {ITEM_HASH}) AS place FROM lineitem) WHERE place <= 500"""


def cap_total(spark, sf):
    """Whole months of orders until 5000 rows are reached."""
    rows = b.table(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return sampling.cap_total(rows, 5000, "month").select("o_orderkey", "month")


CAP_TOTAL = """WITH months AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1), running AS (
    SELECT month, coalesce(sum(n) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS written FROM months)
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders
WHERE strftime(o_orderdate, '%Y-%m') IN (SELECT month FROM running WHERE written < 5000)"""


def balanced_quota(spark, sf):
    """Days with more than 200 flows keep at most 100 of each class."""
    rows = keyed_flows(spark, sf).withColumn("day", F.to_date("ts"))
    return sampling.balanced_quota(rows, "class", ["day"], 200, ["event_id"]).select("event_id", "class", "day")


BALANCED_QUOTA = f"""WITH {KEYED}, placed AS (
    SELECT event_id, class, CAST(ts AS DATE) AS day, count(*) OVER (PARTITION BY CAST(ts AS DATE)) AS day_rows,
           row_number() OVER (PARTITION BY CAST(ts AS DATE), class ORDER BY h) AS place FROM keyed)
SELECT event_id, class, day FROM placed WHERE day_rows <= 200 OR place <= 100"""


def fraction_sample(spark, sf):
    return sampling.fraction(keyed_flows(spark, sf), 0.05, ["event_id"]).select("event_id", "class")


FRACTION_SAMPLE = f"""WITH {KEYED} SELECT event_id, class FROM keyed WHERE substr(h, 1, 8) < '{round(0.05 * 16 ** 8):08x}'"""


def fraction_per_day(spark, sf):
    """Exactly the rounded tenth of every day."""
    rows = keyed_flows(spark, sf).withColumn("day", F.to_date("ts"))
    return sampling.fraction_per_unit(rows, 0.1, ["day"], ["event_id"]).select("event_id", "day")


FRACTION_PER_DAY = f"""WITH {KEYED}, placed AS (
    SELECT event_id, CAST(ts AS DATE) AS day, count(*) OVER (PARTITION BY CAST(ts AS DATE)) AS n,
           row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY h) AS place FROM keyed)
SELECT event_id, day FROM placed WHERE place <= round_even(n * 0.1, 0)"""


def cv_subsample(spark, sf):
    return sampling.cap_rows(keyed_flows(spark, sf), 2000, (), ["event_id"]).select("event_id", "class")


CV_SUBSAMPLE = f"WITH {KEYED} SELECT event_id, class FROM keyed ORDER BY h LIMIT 2000"


def split_70_10_20(spark, sf):
    return sampling.stratified_split(keyed_flows(spark, sf), "class", 0.2, 0.1, ["event_id"]).select("event_id", "class", "split")


def split_80_20(spark, sf):
    return sampling.stratified_split(keyed_flows(spark, sf), "class", 0.2, 0.0, ["event_id"]).select("event_id", "class", "split")


def sizes_sql(name: str, source: str, share: str) -> str:
    """Training rows per class: floors of the proportional part, the rest by largest remainder."""
    return f"""{name}_total AS (SELECT sum(n) AS n, sum(n) - ceil(round(sum(n) * {share}, 6)) AS train FROM {source}), {name}_parts AS (
    SELECT class, s.n, CAST(s.n AS HUGEINT) * CAST(train AS BIGINT) // t.n AS base, CAST(s.n AS HUGEINT) * CAST(train AS BIGINT) % t.n AS rest, train
    FROM {source} s, {name}_total t), {name} AS (
    SELECT class, CAST(base + CASE WHEN row_number() OVER (ORDER BY rest DESC, class) <= train - sum(base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS n FROM {name}_parts)"""


SPLIT_BASE = f"""{KEYED}, placed AS (SELECT event_id, class, row_number() OVER (PARTITION BY class ORDER BY h) AS place FROM keyed),
sizes AS (SELECT class, count(*) AS n FROM keyed GROUP BY class), {sizes_sql('trainval', 'sizes', '0.2')}"""
SPLIT_70_10_20 = f"""WITH {SPLIT_BASE}, {sizes_sql('train', 'trainval', '0.125')}
SELECT event_id, p.class, CASE WHEN place <= t.n THEN 'train' WHEN place <= v.n THEN 'val' ELSE 'test' END AS split
FROM placed p JOIN train t ON p.class = t.class JOIN trainval v ON p.class = v.class"""
SPLIT_80_20 = f"""WITH {SPLIT_BASE}
SELECT event_id, p.class, CASE WHEN place <= v.n THEN 'train' ELSE 'test' END AS split FROM placed p JOIN trainval v ON p.class = v.class"""


def split_unkeyed(spark, sf):
    """Split of items without a key: sizes per class and part."""
    parts = sampling.stratified_split(b.table(spark, sf, "lineitem"), "l_returnflag", 0.2, 0.1)
    return parts.groupBy("l_returnflag", "split").agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("l_extendedprice"), 2).alias("amount"))


SPLIT_UNKEYED = f"""WITH placed AS (
    SELECT l_returnflag AS class, l_extendedprice, row_number() OVER (PARTITION BY l_returnflag ORDER BY {ITEM_HASH}) AS place FROM lineitem),
sizes AS (SELECT class, count(*) AS n FROM placed GROUP BY class), {sizes_sql('trainval', 'sizes', '0.2')}, {sizes_sql('train', 'trainval', '0.125')}
SELECT p.class AS l_returnflag, CASE WHEN place <= t.n THEN 'train' WHEN place <= v.n THEN 'val' ELSE 'test' END AS split, count(*) AS rows,
       round(sum(l_extendedprice), 2) AS amount
FROM placed p JOIN train t ON p.class = t.class JOIN trainval v ON p.class = v.class GROUP BY 1, 2"""


def hashed_split(spark, sf):
    return sampling.hashed_split(keyed_flows(spark, sf), ["event_id"], 0.2, 0.1).select("event_id", "split")


HASHED_SPLIT = f"""WITH {KEYED}, placed AS (SELECT event_id, CAST('0x' || substr(h, 1, 8) AS BIGINT) / 4294967296.0 AS place FROM keyed)
SELECT event_id, CASE WHEN place < 0.7 THEN 'train' WHEN place < 0.8 THEN 'val' ELSE 'test' END AS split FROM placed"""


def stratified_folds(spark, sf):
    return sampling.stratified_folds(keyed_flows(spark, sf), 5, "class", ["event_id"]).select("event_id", "class", "fold")


STRATIFIED_FOLDS = f"""WITH {b.FLOWS}, placed AS (
    SELECT event_id, class, row_number() OVER (PARTITION BY class ORDER BY md5('42|' || event_id)) - 1 AS place FROM flows), starts AS (
    SELECT class, coalesce(sum(n) OVER (ORDER BY class ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS class_start
    FROM (SELECT class, count(*) AS n FROM flows GROUP BY class))
SELECT event_id, p.class, CAST((class_start + place) % 5 AS INTEGER) AS fold FROM placed p JOIN starts s ON p.class = s.class"""

# --- cleaning and encoding -----------------------------------------------------------------

RATIO_SPARK = "CASE WHEN l_discount = 0 THEN double('Infinity') WHEN l_tax = 0 THEN double('-Infinity') WHEN l_discount = 0.05 THEN double('NaN') WHEN l_discount = 0.06 THEN NULL ELSE l_extendedprice / l_discount END"
RATIO_SQL = "CASE WHEN l_discount = 0 THEN CAST('inf' AS DOUBLE) WHEN l_tax = 0 THEN CAST('-inf' AS DOUBLE) WHEN l_discount = 0.05 THEN CAST('nan' AS DOUBLE) WHEN l_discount = 0.06 THEN NULL ELSE l_extendedprice / l_discount END"


def rough_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items with a ratio that is infinite, not a number or missing in many rows, and a text number."""
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_linestatus", "l_tax", F.expr(RATIO_SPARK).alias("ratio"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("string")).otherwise("n/a").alias("shown"))


def sanitise_clip(spark, sf):
    rows = rough_items(spark, sf).select("l_orderkey", "l_linenumber", "ratio", "shown")
    return cleaning.sanitise_columns(cleaning.coerce_numeric(rows, ["shown"]), ["ratio", "shown"])


SANITISE_CLIP = f"""SELECT l_orderkey, l_linenumber,
       CASE WHEN ratio IS NULL OR isnan(ratio) THEN 0.0 ELSE least(1e6, greatest(-1e6, ratio)) END AS ratio,
       CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0.0 END AS shown
FROM (SELECT *, {RATIO_SQL} AS ratio FROM lineitem)"""


def infinities_to_null(spark, sf):
    return cleaning.infinities_to_null(rough_items(spark, sf).select("l_orderkey", "l_linenumber", "ratio"))


INFINITIES_TO_NULL = f"""SELECT l_orderkey, l_linenumber, CASE WHEN isfinite(ratio) THEN ratio END AS ratio
FROM (SELECT *, {RATIO_SQL} AS ratio FROM lineitem)"""


def finite_rows(spark, sf):
    found = cleaning.finite(rough_items(spark, sf), "ratio")
    return found.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("rows"))


FINITE_ROWS = f"""SELECT l_linestatus, count(*) AS rows FROM (SELECT *, {RATIO_SQL} AS ratio FROM lineitem) WHERE isfinite(ratio) GROUP BY 1"""


def quality_counts(spark, sf):
    return cleaning.quality_counts(rough_items(spark, sf), ["ratio", "shown", "l_quantity"])


QUALITY_COUNTS = f"""WITH rough AS (SELECT *, {RATIO_SQL} AS ratio FROM lineitem)
SELECT 'ratio' AS column, count(*) AS rows, count(*) FILTER (isinf(ratio)) AS infinite, count(*) FILTER (ratio IS NULL OR isnan(ratio)) AS missing FROM rough
UNION ALL SELECT 'shown', count(*), 0, count(*) FILTER (l_linestatus <> 'F') FROM rough
UNION ALL SELECT 'l_quantity', count(*), 0, 0 FROM rough"""


def dummies(spark, sf):
    """Part types as dummies; part names have too many values and are dropped."""
    parts = b.table(spark, sf, "part").select("p_partkey", "p_size", F.when(F.col("p_size") > 3, F.col("p_type")).alias("p_type"), "p_name")
    learned = encoding.fit_dummies(parts, ["p_type", "p_name"])
    encoded = encoding.encode(parts, ["p_size"], learned, ["p_partkey"])
    return encoded.withColumn("dropped", F.lit(",".join(learned.dropped)))


PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
DUMMIES = "SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, {}, CASE WHEN (SELECT count(DISTINCT p_name) FROM part) > 50 THEN 'p_name' ELSE '' END AS dropped FROM part".format(
    ", ".join(f"CASE WHEN p_size > 3 AND p_type = '{t}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"p_type_{t}\"" for t in PART_TYPES))


def impute_scale(spark, sf):
    """Median imputation and scaling by the population deviation; a constant column becomes 0."""
    rows = b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).alias("price"), F.lit(7).alias("constant"))
    fits = encoding.fit_numbers(rows, ["l_quantity", "price", "constant"])
    scaled = encoding.impute_and_scale(rows, fits, ["l_orderkey", "l_linenumber"])
    return scaled.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in ("l_quantity", "price", "constant")])


IMPUTE_SCALE = """WITH middle AS (
    SELECT median(l_quantity) AS q, median(l_extendedprice) FILTER (l_linestatus = 'F') AS p FROM lineitem), filled AS (
    SELECT l_orderkey, l_linenumber, coalesce(l_quantity, q) AS l_quantity, CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE p END AS price
    FROM lineitem, middle), spread AS (
    SELECT avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs, avg(price) AS pm, stddev_pop(price) AS ps FROM filled)
SELECT l_orderkey, l_linenumber, round((l_quantity - qm) / qs, 6) AS l_quantity, round((price - pm) / ps, 6) AS price, CAST(0 AS DOUBLE) AS constant
FROM filled, spread"""


def column_modes(spark, sf):
    """Most frequent value per text column, the smallest among equals."""
    found = {**encoding.fit_modes(b.table(spark, sf, "part"), ["p_brand", "p_type", "p_name"]),
             **encoding.fit_modes(document_labels(spark, sf), ["lang", "source", "toxic"])}
    return spark.createDataFrame(list(found.items()), "column string, mode string")


def _mode_sql(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS column, CAST({column} AS VARCHAR) AS mode FROM (SELECT {column}, count(*) AS n FROM {source}
        WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY n DESC, CAST({column} AS VARCHAR) LIMIT 1)"""


COLUMN_MODES = " UNION ALL ".join(f"SELECT * FROM ({_mode_sql(c, s)})" for c, s in (
    ("p_brand", "part"), ("p_type", "part"), ("p_name", "part"), ("lang", "documents"), ("source", "documents"), ("toxic", "labels")))


def class_weights(spark, sf):
    weights = encoding.class_weights(b.flows(spark, sf), "class")
    rows = encoding.with_weight(b.flows(spark, sf), "class", weights)
    return rows.groupBy("class").agg(F.count(F.lit(1)).alias("rows"), F.round(F.first("_weight"), 6).alias("weight"), F.round(F.sum("_weight"), 4).alias("total"))


CLASS_WEIGHTS = f"""WITH {b.FLOWS}, sizes AS (SELECT class, count(*) AS n, sum(count(*)) OVER () AS total, count(*) OVER () AS k FROM flows GROUP BY class)
SELECT class, n AS rows, round(total / (k * n), 6) AS weight, round(CAST(total AS DOUBLE) / k, 4) AS total FROM sizes"""



def label_codes(spark, sf):
    """Alphabetical codes of the event types and back again."""
    rows = b.table(spark, sf, "events")
    types = list(encoding.class_weights(rows, "event_type"))
    coded = rows.withColumn("code", encoding.label_code(F.col("event_type"), types))
    return coded.groupBy("event_type", "code", encoding.label_of(F.col("code"), types).alias("back")).agg(F.count(F.lit(1)).alias("rows"))


LABEL_CODES = """SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) - 1 AS INTEGER) AS code, event_type AS back, count(*) AS rows
FROM events GROUP BY event_type"""

NAMES = ("label_to_class_string", "label_to_class_numeric", "label_to_class_passthrough", "label_to_class_boolean", "fuse_sources", "fuse_sources_capped",
         "class_distribution", "class_distribution_all", "encode_fused", "fused_feature_names", "value_counts", "value_counts_with_null",
         "distinct_counts", "low_cardinality_columns", "table_shape", "distinct_labels", "csv_scan", "csv_inferred", "csv_merged_units",
         "unit_status", "unit_rows", "unit_malformed", "pair_many_files", "file_manifest", "pair_features_labels", "unpaired_features", "cap_per_source", "cap_total", "balanced_quota",
         "fraction_sample", "fraction_per_day", "cv_subsample", "split_70_10_20", "split_80_20", "split_unkeyed", "hashed_split",
         "stratified_folds", "sanitise_clip", "infinities_to_null", "finite_rows", "quality_counts", "dummies", "impute_scale",
         "column_modes", "class_weights", "label_codes")
QUERIES = {name: globals()[name] for name in NAMES}
ORACLES = {name: globals()[name.upper()] for name in NAMES}
