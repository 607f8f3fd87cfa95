"""Random forests on the driver tables, checked row by row.

Forests differ between engines, so every class here is a rule that cuts between few distinct values of its features: any right forest
finds the rule exactly, its leaves are pure, and SQL states label and score of every row, the metrics, the nodes and their importance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions import labels, text
from flowlens.operators import forest, sampling
from flowlens.plans import evaluation, fusion, learning, training
from flowlens.session import scratch_path
from flowlens.sources import sinks
from flowlens.workload import bindings as b
from flowlens.workload.preparation import sizes_sql

RULED_FOREST = learning.ForestSettings(numTrees=10, maxDepth=6, featureSubsetStrategy="all", maxBins=128)
PLAIN_FOREST = learning.ForestSettings(numTrees=3, maxDepth=6, featureSubsetStrategy="all", bootstrap=False, balanced=False, maxBins=128)
RULED_SPACE = {"numTrees": range(5, 15), "maxDepth": [5, 7, 9], "minInstancesPerNode": range(1, 4), "featureSubsetStrategy": ["all"],
               "bootstrap": [True, False], "balanced": [False, True]}
HIDDEN = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "split"]


def _class(rule: str) -> Column:
    return F.when(F.expr(rule), labels.ANOMALY).otherwise(labels.NORMAL).alias("class")


# --- items: few distinct quantities and discounts, so that every cut of the rule is tried --------------

ITEM_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_extendedprice")
ITEM_RULE = "l_quantity > 30 AND (l_discount >= 0.045 OR l_returnflag = 'R')"
PLAIN_RULE = "l_quantity > 30 AND l_discount >= 0.045"


def item_flows(spark: SparkSession, sf: str, rule: str = ITEM_RULE) -> DataFrame:
    """Line items as flows; large, much reduced or returned ones are the anomalies."""
    return b.table(spark, sf, "lineitem").select(*ITEM_COLUMNS, _class(rule))


def trained_on_items(spark: SparkSession, sf: str) -> tuple[learning.Trained, DataFrame]:
    """Splits are written once; training passes over its part several times."""
    path = scratch_path(spark, "splits")
    sinks.write_splits(sampling.stratified_split(item_flows(spark, sf), "class", 0.2, 0.1), path)
    rows = spark.read.parquet(path)
    return learning.fit(rows.filter("split = 'train'"), "class", RULED_FOREST, HIDDEN), rows


ITEM_SPLIT = f"""items AS (SELECT {', '.join(ITEM_COLUMNS)}, CASE WHEN {ITEM_RULE} THEN 'anomaly' ELSE 'normal' END AS class FROM lineitem),
placed AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY md5(concat_ws('|', '42', {', '.join(f'CAST({c} AS VARCHAR)' for c in (*ITEM_COLUMNS, 'class'))}))) AS place FROM items),
sizes AS (SELECT class, count(*) AS n FROM items GROUP BY class), {sizes_sql('trainval', 'sizes', '0.2')}, {sizes_sql('train', 'trainval', '0.125')},
parted AS (SELECT p.*, CASE WHEN place <= t.n THEN 'train' WHEN place <= v.n THEN 'val' ELSE 'test' END AS split,
        CASE WHEN p.class = 'anomaly' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score
    FROM placed p JOIN train t ON t.class = p.class JOIN trainval v ON v.class = p.class)"""


def rf_train_score(spark, sf):
    """Label and score of every test row, from the model and from its table of nodes."""
    trained, rows = trained_on_items(spark, sf)
    test = rows.filter("split = 'test'").drop("split")
    own = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    return _both(trained, test, own)


def _both(trained: learning.Trained, rows: DataFrame, own: list[str]) -> DataFrame:
    """Predictions of the model with those of its nodes beside them."""
    nodes = learning.forest_nodes(trained)
    scored = learning.predict(trained, rows).withColumnsRenamed({"predicted_label": "label", "predicted_label_encoded": "code", "anomaly_score": "score", "raw_proba": "proba"})
    walked = learning.predict_by_nodes(trained, nodes, scored.withColumnRenamed("class", "true_class"))
    return walked.select(*own, "true_class", "label", "code", F.round("score", 9).alias("score"), F.round(F.col("proba")[labels.NORMAL], 9).alias("normal_score"),
                         F.col("predicted_label").alias("node_label"), F.round("anomaly_score", 9).alias("node_score"))


RF_TRAIN_SCORE = f"""WITH {ITEM_SPLIT}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, class AS true_class, class AS label, CASE WHEN class = 'anomaly' THEN 0 ELSE 1 END AS code,
       score, 1 - score AS normal_score, class AS node_label, score AS node_score FROM parted WHERE split = 'test'"""


def rf_evaluate(spark, sf):
    """Metrics document of the validation rows: the report's lines, the matrix, the area."""
    trained, rows = trained_on_items(spark, sf)
    document = evaluation.evaluate(trained, rows.filter("split = 'val'")).document
    lines = document.select(F.explode("classification_report").alias("class", "line"), "confusion_matrix", "auc")
    named = lines.filter(F.col("class").isin(labels.ANOMALY, labels.NORMAL))
    return named.select("class", *[F.round(F.col("line")[m], 9).alias(m.split("-")[0]) for m in ("precision", "recall", "f1-score")], F.col("line.support").alias("support"),
                        F.get(F.flatten("confusion_matrix"), F.lit(0)).alias("hits"), F.get(F.flatten("confusion_matrix"), F.lit(1)).alias("misses"),
                        F.get(F.flatten("confusion_matrix"), F.lit(2)).alias("false_alarms"), F.get(F.flatten("confusion_matrix"), F.lit(3)).alias("rest"), F.round("auc", 9).alias("auc"))


RF_EVALUATE = f"""WITH {ITEM_SPLIT}, support AS (SELECT class, count(*) AS n FROM parted WHERE split = 'val' GROUP BY class)
SELECT class, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1, n AS support, (SELECT n FROM support WHERE class = 'anomaly') AS hits,
       CAST(0 AS BIGINT) AS misses, CAST(0 AS BIGINT) AS false_alarms, (SELECT n FROM support WHERE class = 'normal') AS rest, 1.0::DOUBLE AS auc FROM support"""


def rf_predict_only(spark, sf):
    """Predictions of rows without a label, row by row."""
    trained, rows = trained_on_items(spark, sf)
    found = evaluation.evaluate(trained, rows.filter("split = 'test'").drop("class", "split"), predict_only=True).predictions
    return found.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "prediction", F.round("anomaly_score", 9).alias("anomaly_score"))


RF_PREDICT_ONLY = f"""WITH {ITEM_SPLIT}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_returnflag, class AS prediction, score AS anomaly_score FROM parted WHERE split = 'test'"""


def plain_items(spark: SparkSession, sf: str) -> learning.Trained:
    """Equal trees without bootstrap on all items, by a rule of two features."""
    return learning.fit(item_flows(spark, sf, PLAIN_RULE), "class", PLAIN_FOREST, HIDDEN[:-1])


# The better of the two cuts is the root; the other splits the half that is not pure.
PLAIN_TREE = """counted AS (SELECT count(*) AS n, count(*) FILTER (l_quantity > 30) AS q, count(*) FILTER (l_discount >= 0.045) AS d,
        count(*) FILTER (l_quantity > 30 AND l_discount >= 0.045) AS a FROM lineitem),
impure AS (SELECT *, 1 - (a / n) ** 2 - (1 - a / n) ** 2 AS whole, 1 - (a / q) ** 2 - (1 - a / q) ** 2 AS in_q, 1 - (a / d) ** 2 - (1 - a / d) ** 2 AS in_d FROM counted),
gains AS (SELECT *, whole - q / n * in_q AS by_q, whole - d / n * in_d AS by_d FROM impure),
tree AS (SELECT *, by_q > by_d AS q_first, CASE WHEN by_q > by_d THEN q ELSE d END AS under, CASE WHEN by_q > by_d THEN in_q ELSE in_d END AS rest,
        greatest(by_q, by_d) AS first_gain FROM gains)"""


def feature_importance_top30(spark, sf):
    """The expanded features with their importances, from the model and from its table of nodes."""
    trained = plain_items(spark, sf)
    by_nodes = forest.importances(learning.forest_nodes(trained))
    names = spark.createDataFrame(list(enumerate(trained.features)), "feature int, name string")
    named = names.join(by_nodes, "feature", "left").select(F.col("name").alias("feature"), F.round(F.coalesce("importance", F.lit(0.0)), 6).alias("by_nodes"))
    return learning.feature_importances(trained).select("feature", F.round("importance", 6).alias("importance")).join(named, "feature")


FEATURE_IMPORTANCE_TOP30 = f"""WITH {PLAIN_TREE}, shares AS (
    SELECT n * first_gain / (n * first_gain + under * rest) AS first_share, under * rest / (n * first_gain + under * rest) AS second_share, q_first FROM tree),
features AS (SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'l_extendedprice']) AS feature
    UNION ALL SELECT DISTINCT 'l_returnflag_' || l_returnflag FROM lineitem UNION ALL SELECT DISTINCT 'l_linestatus_' || l_linestatus FROM lineitem),
valued AS (SELECT feature, round(CASE feature WHEN 'l_quantity' THEN CASE WHEN q_first THEN first_share ELSE second_share END
        WHEN 'l_discount' THEN CASE WHEN q_first THEN second_share ELSE first_share END ELSE 0 END, 6) AS importance FROM features, shares)
SELECT feature, importance, importance AS by_nodes FROM valued"""


def rf_nodes(spark, sf):
    """The nodes of the forest: what splits them, where to, how many rows of each class arrived."""
    rows = item_flows(spark, sf, PLAIN_RULE).select("l_quantity", "l_tax", "l_discount", "class")
    nodes = learning.forest_nodes(learning.fit_encoded(rows, ["l_quantity", "l_tax", "l_discount"], "class", PLAIN_FOREST))
    return nodes.select("tree", "node", F.col("name").alias("feature"), F.round("cut", 6).alias("cut"), F.col("left").alias("lower"), F.col("right").alias("upper"),
                        F.get("weights", F.lit(0)).cast("long").alias("anomalies"), F.get("weights", F.lit(1)).cast("long").alias("normal"),
                        F.round("gain", 9).alias("gain"), F.get("votes", F.lit(0)).alias("vote"))


RF_NODES = f"""WITH {PLAIN_TREE}, one AS (
    SELECT 0 AS node, CASE WHEN q_first THEN 'l_quantity' ELSE 'l_discount' END AS feature, CASE WHEN q_first THEN 30.5 ELSE 0.045 END AS cut, 1 AS lower, 2 AS upper,
           a AS anomalies, n - a AS normal, first_gain AS gain, NULL AS vote FROM tree
    UNION ALL SELECT 1, NULL, NULL, NULL, NULL, 0, n - under, NULL, 0 FROM tree
    UNION ALL SELECT 2, CASE WHEN q_first THEN 'l_discount' ELSE 'l_quantity' END, CASE WHEN q_first THEN 0.045 ELSE 30.5 END, 3, 4, a, under - a, rest, NULL FROM tree
    UNION ALL SELECT 3, NULL, NULL, NULL, NULL, 0, under - a, NULL, 0 FROM tree
    UNION ALL SELECT 4, NULL, NULL, NULL, NULL, a, 0, NULL, 1 FROM tree)
SELECT CAST(t.tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, feature, round(CAST(cut AS DOUBLE), 6) AS cut, CAST(lower AS INTEGER) AS lower,
       CAST(upper AS INTEGER) AS upper, CAST(anomalies AS BIGINT) AS anomalies, CAST(normal AS BIGINT) AS normal, round(CAST(gain AS DOUBLE), 9) AS gain,
       CAST(vote AS DOUBLE) AS vote FROM one, range(3) t(tree)"""


# --- parts: sizes in bands of ten ------------------------------------------------------------------

PART_RULE = "p_size >= 30"


def banded_parts(spark: SparkSession, sf: str, label: Column | None = None) -> DataFrame:
    """Parts whose class is a rule of their band of sizes."""
    return b.table(spark, sf, "part").select("p_partkey", (F.floor(F.col("p_size") / 10) * 10).cast("double").alias("band"), "p_retailprice", "p_brand", "p_type",
                                             _class(PART_RULE) if label is None else label.alias("class"))


def rf_cv_auc(spark, sf):
    """Rows and area of each of five folds."""
    return learning.cross_validate(banded_parts(spark, sf), "class", 5, RULED_FOREST, key=["p_partkey"]).withColumn("auc", F.round("auc", 9))


RF_CV_AUC = """SELECT CAST(fold AS INTEGER) AS fold, (SELECT count(*) FROM part) // 5 + CASE WHEN fold < (SELECT count(*) FROM part) % 5 THEN 1 ELSE 0 END AS rows,
       1.0::DOUBLE AS auc FROM range(5) f(fold)"""


def rf_random_search(spark, sf):
    """Four random settings on encoded parts, each with its score over three folds; the first of the best wins."""
    encoded = fusion.encode_fused(banded_parts(spark, sf), keep=("class", "p_partkey"))
    table = learning.random_search(encoded.table, encoded.features, "class", 4, 3, RULED_SPACE, ["p_partkey"])[1]
    return table.withColumn("cv_f1", F.round("cv_f1", 9)).withColumn("cv_f1_std", F.round("cv_f1_std", 9))


# The draws of seed 42 from RULED_SPACE. Every one of them finds the rule, if there is anything to find.
_DRAWS = ", ".join(f"({i}, {s.numTrees}, {s.maxDepth}, {s.minInstancesPerNode}, '{s.featureSubsetStrategy}', {s.bootstrap}, {s.balanced})"
                   for i, s in enumerate(learning.draw_settings(4, RULED_SPACE)))
RF_RANDOM_SEARCH = f"""SELECT draw, trees, depth, min_leaf, subset, bootstrap, balanced, score AS cv_f1, 0.0::DOUBLE AS cv_f1_std, draw = 0 AS best
FROM (VALUES {_DRAWS}) d(draw, trees, depth, min_leaf, subset, bootstrap, balanced),
     (SELECT CASE WHEN count(*) FILTER ({PART_RULE}) > 0 AND count(*) FILTER (NOT {PART_RULE}) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM part)"""


def rf_multiclass(spark, sf):
    """Three classes of parts: prediction and the probability of each class for every test row."""
    size = F.when(F.col("p_size") < 20, "small").when(F.col("p_size") < 40, "middle").otherwise("large")
    halves = sampling.hashed_split(banded_parts(spark, sf, size), ["p_partkey"], 0.3)
    trained = learning.fit_encoded(halves.filter("split = 'train'"), ["band", "p_retailprice"], "class", RULED_FOREST)
    named = learning.probability_columns(trained, learning.predict(trained, halves.filter("split = 'test'")))
    return named.select("p_partkey", "class", "prediction", *[F.round(f"proba_{c}", 9).alias(f"proba_{c}") for c in ("large", "middle", "small")])


RF_MULTICLASS = """WITH test AS (SELECT p_partkey, CASE WHEN p_size < 20 THEN 'small' WHEN p_size < 40 THEN 'middle' ELSE 'large' END AS class FROM part
    WHERE CAST('0x' || substr(md5('42|' || p_partkey), 1, 8) AS BIGINT) / 4294967296.0 >= 0.7)
SELECT p_partkey, class, class AS prediction, CASE class WHEN 'large' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS proba_large,
       CASE class WHEN 'middle' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS proba_middle, CASE class WHEN 'small' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS proba_small FROM test"""


def rf_split_files(spark, sf):
    """Split rows written one folder per part and counted from the files."""
    path = scratch_path(spark, "splits")
    sinks.write_splits(sampling.stratified_split(banded_parts(spark, sf), "class", 0.2, 0.1, ["p_partkey"]), path)
    return spark.read.parquet(path).groupBy("split", "class").agg(F.count(F.lit(1)).alias("rows"))


# The sizes of a stratified split follow from the class sizes alone.
PART_SIZES = f"""sizes AS (SELECT CASE WHEN {PART_RULE} THEN 'anomaly' ELSE 'normal' END AS class, count(*) AS n FROM part GROUP BY 1),
{sizes_sql('trainval', 'sizes', '0.2')}, {sizes_sql('train', 'trainval', '0.125')}"""
RF_SPLIT_FILES = f"""WITH {PART_SIZES}, parts AS (
    SELECT 'train' AS split, class, n AS rows FROM train
    UNION ALL SELECT 'val', v.class, v.n - t.n FROM trainval v JOIN train t ON v.class = t.class
    UNION ALL SELECT 'test', s.class, s.n - v.n FROM sizes s JOIN trainval v ON s.class = v.class)
SELECT split, class, rows FROM parts WHERE rows > 0"""


def _report(document: DataFrame, column: str) -> DataFrame:
    lines = document.select("*", F.explode(column).alias("name", "line")).filter(F.col("name").isin(labels.ANOMALY, labels.NORMAL))
    return lines.withColumns({m.split("-")[0]: F.round(F.col("line")[m], 9) for m in ("precision", "recall", "f1-score")} | {"support": F.col("line.support")})


def training_report(spark, sf):
    """A training run: report of the validation rows, areas of folds and validation, sizes of the parts written to files."""
    run = training.train(banded_parts(spark, sf), scratch_path(spark, "training"), settings=RULED_FOREST, key=["p_partkey"], folds=3)
    sizes = {r["split"]: r["rows"] for r in run.details.collect()}
    return _report(run.document, "val_classification_report").select(
        F.col("name").alias("class"), "precision", "recall", "f1", "support", *[F.round(c, 9).alias(c) for c in ("cv_auc_mean", "cv_auc_std", "val_auc")],
        *[F.lit(sizes[p]).cast("long").alias(f"{p}_rows") for p in ("train", "val", "test")])


TRAINING_REPORT = f"""WITH {PART_SIZES}
SELECT s.class, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1, v.n - t.n AS support, 1.0::DOUBLE AS cv_auc_mean, 0.0::DOUBLE AS cv_auc_std,
       1.0::DOUBLE AS val_auc, CAST(sum(t.n) OVER () AS BIGINT) AS train_rows, CAST(sum(v.n - t.n) OVER () AS BIGINT) AS val_rows, CAST(sum(s.n - v.n) OVER () AS BIGINT) AS test_rows
FROM sizes s JOIN trainval v ON s.class = v.class JOIN train t ON s.class = t.class"""


# --- several datasets, each with a rule of its own -------------------------------------------------


def ruled_sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Datasets with overlapping columns; what makes an anomaly differs between them, and source labels go along."""
    orders, items, customers = (b.table(spark, sf, name) for name in ("orders", "lineitem", "customer"))
    return {
        "orders": orders.select(F.col("o_orderkey").alias("key"), F.floor(F.col("o_totalprice") / 100000).alias("amount"), F.col("o_orderpriority").alias("kind"),
                                F.col("o_orderstatus").alias("Label"), _class("o_orderpriority = '1-URGENT'")),
        "lineitem": items.select(F.col("l_orderkey").alias("key"), F.floor(F.col("l_extendedprice") / 10000).alias("amount"), F.col("l_linestatus").alias("kind"),
                                 "l_quantity", F.col("l_returnflag").alias("Attack"), _class("l_quantity > 30")),
        "customer": customers.select(F.col("c_custkey").alias("key"), F.floor(F.col("c_acctbal") / 1000).alias("amount"), F.col("c_mktsegment").alias("kind"), _class("c_acctbal < 0")),
    }


RULED = """ruled AS (
    SELECT 'orders' AS dataset, o_orderkey AS key, CASE WHEN o_orderpriority = '1-URGENT' THEN 'anomaly' ELSE 'normal' END AS class FROM orders
    UNION ALL SELECT 'lineitem', l_orderkey, CASE WHEN l_quantity > 30 THEN 'anomaly' ELSE 'normal' END FROM lineitem
    UNION ALL SELECT 'customer', c_custkey, CASE WHEN c_acctbal < 0 THEN 'anomaly' ELSE 'normal' END FROM customer)"""


def rf_fused(spark, sf):
    """Fusion, encoding, split by key, forest: label and score of every test row of three datasets."""
    encoded = fusion.encode_fused(fusion.fuse(ruled_sources(spark, sf)), keep=("class", "key"))
    rows = sampling.hashed_split(encoded.table, ["key"], 0.2)
    trained = learning.fit_encoded(rows.filter("split = 'train'"), encoded.features, "class",
                                   learning.ForestSettings(numTrees=5, maxDepth=8, featureSubsetStrategy="all", balanced=False, maxBins=128))
    scored = learning.predict(trained, rows.filter("split = 'test'"))
    dataset = F.when(F.col("dataset_orders") == 1, "orders").when(F.col("dataset_lineitem") == 1, "lineitem").otherwise("customer")
    return scored.select(dataset.alias("dataset"), "key", "class", F.col("predicted_label").alias("label"), F.round("anomaly_score", 9).alias("score"))


RF_FUSED = f"""WITH {RULED} SELECT dataset, key, class, class AS label, CASE WHEN class = 'anomaly' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM ruled
WHERE CAST('0x' || substr(md5('42|' || key), 1, 8) AS BIGINT) / 4294967296.0 >= 0.8"""


def tuning_report(spark, sf):
    """A tuning run over two datasets: the search sees the training rows, the report the held-out ones."""
    given = ruled_sources(spark, sf)
    orders = given["orders"].withColumnRenamed("key", "row_key")
    customers = given["customer"].withColumn("row_key", -F.col("key")).drop("key")
    run = training.tune({"orders": orders, "customer": customers}, scratch_path(spark, "tuning"), draws=3, folds=2, space=RULED_SPACE, key=["row_key"])
    best = run.details.agg(F.count(F.lit(1)).alias("draws"), F.count_if(F.col("best")).alias("best"), F.round(F.max("cv_f1"), 9).alias("best_f1")).first()
    return _report(run.document, "classification_report").select(
        F.col("name").alias("class"), "precision", "recall", "f1", "support", F.round("auc", 9).alias("auc"), F.lit(best["draws"]).cast("long").alias("draws"),
        F.lit(best["best"]).cast("long").alias("best"), F.lit(best["best_f1"]).alias("best_f1"))


TUNING_REPORT = f"""WITH {RULED}, sizes AS (SELECT class, count(*) AS n FROM ruled WHERE dataset <> 'lineitem' GROUP BY class),
{sizes_sql('train', 'sizes', '0.2')}
SELECT s.class, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1, s.n - t.n AS support, 1.0::DOUBLE AS auc, CAST(3 AS BIGINT) AS draws, CAST(1 AS BIGINT) AS best,
       1.0::DOUBLE AS best_f1 FROM sizes s JOIN train t ON s.class = t.class"""


# --- serving ---------------------------------------------------------------------------------------


def rf_served_requests(spark, sf):
    """A saved and reloaded model, and its stored table of nodes, score request items given as feature maps."""
    flows = b.flows(spark, sf).select("event_id", (F.floor(F.col("value") / 10) * 10).cast("double").alias("Flow Byts/s"), F.col("user_id").cast("double").alias("Tot Fwd Pkts"),
                                      _class("value >= 100"))
    trained = learning.fit_encoded(flows, ["Flow Byts/s", "Tot Fwd Pkts"], "class", RULED_FOREST)
    path = scratch_path(spark, "model")
    trained.save(path)
    learning.forest_nodes(trained).write.parquet(f"{path}/nodes")
    items = flows.select("event_id", F.create_map(F.lit("Flow Byts/s"), text.col("Flow Byts/s"), F.lit("other"), F.lit(1.0)).alias("features"))
    served = learning.score_requests(learning.Trained.load(spark, path), items)
    aligned = F.array(*[F.coalesce(F.col("input_features")[name], F.lit(0.0)) for name in trained.features])
    kept = served.select("event_id", "input_features", F.col("predicted_label").alias("label"), F.round("anomaly_score", 9).alias("score"))
    walked = forest.score(spark.read.parquet(f"{path}/nodes"), kept, aligned, trained.classes, RULED_FOREST.maxDepth)
    return walked.select("event_id", "label", "score", F.col("predicted_label").alias("node_label"), F.round(F.col("raw_proba")[labels.ANOMALY], 9).alias("node_score"))


RF_SERVED_REQUESTS = """WITH judged AS (SELECT event_id, CASE WHEN value >= 100 THEN 'anomaly' ELSE 'normal' END AS label, CASE WHEN value >= 100 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM events)
SELECT event_id, label, score, label AS node_label, score AS node_score FROM judged"""

NAMES = ("rf_train_score", "rf_evaluate", "rf_predict_only", "feature_importance_top30", "rf_nodes", "rf_cv_auc", "rf_random_search", "rf_fused",
         "rf_multiclass", "rf_served_requests", "rf_split_files", "training_report", "tuning_report")
QUERIES = {name: globals()[name] for name in NAMES}
ORACLES = {name: globals()[name.upper()] for name in NAMES}
