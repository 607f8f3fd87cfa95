"""The table of nodes of a fitted forest against the model itself and against recursive SQL."""

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowlens.operators import forest
from flowlens.plans import learning


@pytest.fixture(scope="module")
def table(spark, sf):
    """Noisy classes, so that leaves are impure and trees differ."""
    return spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.monotonically_increasing_id().alias("id"), "l_quantity", "l_discount", "l_extendedprice", "l_returnflag", "l_linestatus",
        F.when((F.col("l_quantity") * F.col("l_discount") + F.rand(3)) > 2, "anomaly").when(F.col("l_tax") > 0.06, "odd").otherwise("normal").alias("class"))


@pytest.fixture(scope="module")
def trained(table):
    return learning.fit(table, "class", learning.ForestSettings(numTrees=7, maxDepth=8, minInstancesPerNode=3), ["id"])


@pytest.fixture(scope="module")
def nodes(trained):
    return learning.forest_nodes(trained).cache()


def rounded(rows):
    return sorted((r["id"], r["predicted_label"], {k: round(v, 9) for k, v in r["raw_proba"].items()}) for r in rows.select("id", "predicted_label", "raw_proba").collect())


def test_nodes_score_as_the_model_does(trained, nodes, table):
    expected = learning.predict(trained, table)
    found = learning.predict_by_nodes(trained, nodes, table)
    assert found.columns == expected.columns
    assert rounded(found) == rounded(expected)
    assert found.join(expected.select("id", F.col("anomaly_score").alias("model"), F.col("predicted_label_encoded").alias("code")), "id").filter(
        "abs(anomaly_score - model) > 1e-9 or predicted_label_encoded <> code").isEmpty()


def test_nodes_of_a_large_forest_are_joined(trained, nodes, table):
    rows = trained.model.stages[0].transform(table)
    for stage in trained.model.stages[1:-1]:
        rows = stage.transform(rows)
    rows = rows.select("id", vector_to_array("features").alias("given"))
    joined = forest.score(nodes, rows, F.col("given"), trained.classes, 8, most_nodes=10)
    assert rounded(joined) == rounded(learning.predict(trained, table))


def test_recursive_sql_walks_to_the_same_votes(trained, nodes, table):
    rows = table
    for stage in trained.model.stages[:-1]:
        rows = stage.transform(rows)
    rows = rows.select(F.col("id").alias("row"), vector_to_array("features").alias("v"))
    database = duckdb.connect()
    database.register("nodes", nodes.toArrow())
    database.register("given", rows.toArrow())
    votes = {r[0]: r[1:] for r in database.execute(forest.walk_sql("nodes", "given", trained.classes)).fetchall()}
    for r in learning.predict(trained, table).select("id", "raw_proba").collect():
        assert [v / sum(votes[r["id"]]) for v in votes[r["id"]]] == pytest.approx([r["raw_proba"][c] for c in trained.classes], abs=1e-9)


def test_nodes_are_a_forest(nodes, trained):
    rows = nodes.collect()
    assert {r.tree for r in rows} == set(range(7))
    for tree in range(7):
        own = {r.node: r for r in rows if r.tree == tree}
        children = [c for r in own.values() if r.feature is not None for c in (r.left, r.right)]
        assert sorted(children) == sorted(set(own) - {0})
        for r in own.values():
            if r.feature is None:
                assert sum(r.votes) == pytest.approx(1) and r.left is None and r.cut is None
            else:
                assert r.name == trained.features[r.feature]
                parts = [x + y for x, y in zip(own[r.left].weights, own[r.right].weights)]
                assert parts == pytest.approx(r.weights, rel=1e-6)


def test_importances_equal_the_models(trained, nodes):
    found = {trained.features[r.feature]: r.importance for r in forest.importances(nodes).collect()}
    expected = {r.feature: r.importance for r in learning.feature_importances(trained, 100).collect() if r.importance}
    assert found == pytest.approx(expected, abs=1e-9)


def test_a_forest_of_one_leaf(spark):
    rows = spark.createDataFrame([(1, 1.0, "normal"), (2, 1.0, "normal"), (3, 1.0, "anomaly")], "id long, x double, class string")
    trained = learning.fit_encoded(rows, ["x"], "class", learning.ForestSettings(numTrees=2, maxDepth=3, bootstrap=False, balanced=False))
    found = learning.predict_by_nodes(trained, learning.forest_nodes(trained), rows)
    assert {(r.predicted_label, round(r.anomaly_score, 9)) for r in found.collect()} == {("normal", 0.333333333)}
    assert found.filter("id < 0").isEmpty()


def test_walks_end_at_the_farthest_leaf(spark):
    """Settings allow deeper trees than the data gives; rows take no steps beyond the leaves."""
    schema = "tree int, node int, feature int, cut double, left int, right int, votes array<double>"
    nodes = spark.createDataFrame([(0, 0, 0, 1.0, 1, 2, None), (0, 1, None, None, None, None, [1.0, 0.0]), (0, 2, 0, 2.0, 3, 4, None),
                                   (0, 3, None, None, None, None, [0.0, 1.0]), (0, 4, None, None, None, None, [1.0, 0.0]),
                                   (1, 0, None, None, None, None, [0.5, 0.5])], schema)
    assert forest.deepest(nodes, 30) == 2 and forest.deepest(nodes.filter("tree = 1"), 30) == 0 and forest.deepest(nodes, 1) == 1
    rows = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "v double")
    scored = forest.score(nodes, rows, F.array("v"), ["a", "b"], 30)
    assert {r["v"]: r["predicted_label"] for r in scored.collect()} == {0.5: "a", 1.5: "b", 2.5: "a"}
