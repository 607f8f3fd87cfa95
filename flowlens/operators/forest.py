"""A fitted forest as a table of nodes: stored, joined and scored like any other table.

One row per node: ``tree``, ``node`` (0 is the root), ``feature`` (place among the inputs, null at a leaf), ``cut``, ``left``, ``right``,
``votes`` (share of each class at a leaf, null elsewhere), ``weights`` (training weight of each class that reached the node) and ``gain``. A row goes
left where its value is at most the cut. ``score`` walks all trees of a row inside one projection; forests above ``MOST_NODES`` nodes
are walked by joins with the node table, level by level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import scratch_path, small, small_rows, stage

NODES = ("tree int, node int, feature int, cut double, left int, right int, votes array<double>, weights array<double>, gain double, rows long")
MOST_NODES = 500_000


def nodes_of(forest: RandomForestClassificationModel, spark: SparkSession | None = None) -> DataFrame:
    """The node table of a fitted forest, read from what Spark stores of it."""
    spark = spark or SparkSession.getActiveSession()
    path = scratch_path(spark, "forest")
    forest.write().save(path)
    node, split = F.col("nodeData"), F.col("nodeData.split")
    leaf = node["leftChild"] < 0
    # An indicator column is split by its value: 0 to one side, 1 to the other, which is a cut between them.
    indicator = split["numCategories"] >= 0
    swapped = indicator & (split["leftCategoriesOrThreshold"][0] == 1.0)
    total = _sum_of(node["impurityStats"])
    table = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), F.when(~leaf, split["featureIndex"]).alias("feature"),
        F.when(leaf, None).when(indicator, 0.5).otherwise(split["leftCategoriesOrThreshold"][0]).alias("cut"),
        F.when(~leaf, F.when(swapped, node["rightChild"]).otherwise(node["leftChild"])).alias("left"),
        F.when(~leaf, F.when(swapped, node["leftChild"]).otherwise(node["rightChild"])).alias("right"),
        F.when(leaf, F.transform(node["impurityStats"], lambda x: F.when(total > 0, x / total).otherwise(0.0))).alias("votes"),
        node["impurityStats"].alias("weights"), F.when(~leaf, node["gain"]).alias("gain"), node["rawCount"].alias("rows"), split["numCategories"].alias("kinds"))
    if not table.filter("kinds > 2").isEmpty():
        raise ValueError("a split by more than two categories is no cut; encode the column first")
    return table.drop("kinds")


def importances(nodes: DataFrame) -> DataFrame:
    """``feature``, ``importance``: weighted gains per tree, made to add to one, averaged and made to add to one again."""
    weight = _sum_of(F.col("weights"))
    gains = nodes.filter("feature is not null").groupBy("tree", "feature").agg(F.sum(F.col("gain") * weight).alias("gain"))
    totals = gains.groupBy("tree").agg(F.sum("gain").alias("total")).filter("total > 0")
    shares = gains.join(small(totals), "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("total")).alias("share"))
    whole = shares.agg(F.sum("share").alias("whole"))
    return shares.select("feature", (F.col("share") / whole.scalar()).alias("importance"))


def _packed(nodes: DataFrame) -> DataFrame:
    """One row: the trees in order, each the array of its nodes in order."""
    own = F.struct("node", "feature", "cut", "left", "right", "votes")
    trees = nodes.groupBy("tree").agg(F.sort_array(F.collect_list(own)).alias("nodes"))
    in_order = F.sort_array(F.collect_list(F.struct("tree", "nodes")))
    return trees.agg(F.transform(in_order, lambda t: t["nodes"]).alias("trees"))


def _votes(trees: Column, values: Column, depth: int) -> Column:
    """Votes of the leaf that a row reaches in each tree."""
    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree, at)
            return F.when(node["feature"].isNull(), at).when(F.get(values, node["feature"]) <= node["cut"], node["left"]).otherwise(node["right"])
        end = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step) if depth else F.lit(0)
        return F.get(tree, end)["votes"]
    return F.transform(trees, leaf)


def _sum_of(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _part(k: int):
    return lambda votes: F.get(votes, F.lit(k))


def _predictions(classes: Sequence[str], sums: Column) -> list[Column]:
    """Label and class → probability from the votes of all trees."""
    total = _sum_of(sums)
    shares = F.transform(sums, lambda x: F.when(total > 0, x / total).otherwise(0.0))
    names = F.array(*[F.lit(c) for c in classes])
    return [F.get(names, F.array_position(sums, F.array_max(sums)).cast("int") - 1).alias("predicted_label"), F.map_from_arrays(names, shares).alias("raw_proba")]


def deepest(nodes: DataFrame, depth: int) -> int:
    """Steps from the root to the farthest leaf; ``depth``, which no tree exceeds, for forests too large to look at."""
    _, splits = small_rows(nodes.filter("feature is not null").select("tree", "node", "left", "right"))
    if splits is None:
        return depth
    below = {(r["tree"], r["node"]): [(r["tree"], r["left"]), (r["tree"], r["right"])] for r in splits}
    level, steps = [at for at in below if at[1] == 0], 0
    while level and steps < depth:
        level, steps = [child for at in level for child in below[at] if child in below], steps + 1
    return steps


def score(nodes: DataFrame, rows: DataFrame, values: Column, classes: Sequence[str], depth: int, most_nodes: int = MOST_NODES) -> DataFrame:
    """``rows`` with ``predicted_label`` and ``raw_proba`` (class → probability).

    ``values`` is the array of inputs in the forest's order, ``classes`` the class names in the order of the votes, ``depth`` the
    forest's greatest depth. Ties go to the class named first.
    """
    if nodes.limit(most_nodes + 1).count() > most_nodes:
        return _by_joins(nodes, rows, values, classes)
    votes = _votes(F.col("_trees"), F.col("_values"), deepest(nodes, depth))
    sums = F.array(*[_sum_of(F.transform("_votes", _part(k))) for k in range(len(classes))])
    scored = rows.withColumn("_values", values).withColumn("_trees", _packed(nodes).scalar()).withColumn("_votes", votes).withColumn("_sums", sums)
    return scored.select(*[F.col(f"`{c}`") for c in rows.columns], *_predictions(classes, F.col("_sums")))


def _by_joins(nodes: DataFrame, rows: DataFrame, values: Column, classes: Sequence[str]) -> DataFrame:
    """The walk for a forest too large for one value: a row meets one node of every tree per level."""
    rows = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "walked")
    nodes = stage(nodes.select("tree", "node", "feature", "cut", "left", "right", "votes"), "forest-nodes")
    trees = [r["tree"] for r in nodes.select("tree").distinct().collect()]
    at = rows.select("_row", values.alias("_values"), F.explode(F.array(*[F.lit(t) for t in trees])).alias("tree"), F.lit(0).alias("node"))
    ended = None
    while True:
        met = stage(at.join(nodes, ["tree", "node"]), "walk")
        leaves = met.filter("feature is null").select("_row", "votes")
        ended = leaves if ended is None else ended.unionByName(leaves)
        inner = met.filter("feature is not null")
        if inner.isEmpty():
            break
        at = inner.select("_row", "_values", "tree", F.when(F.get("_values", F.col("feature")) <= F.col("cut"), F.col("left")).otherwise(F.col("right")).alias("node"))
    sums = ended.groupBy("_row").agg(F.array(*[F.sum(F.get("votes", F.lit(k))) for k in range(len(classes))]).alias("_sums"))
    return rows.join(sums, "_row").select(*[F.col(f"`{c}`") for c in rows.columns if c != "_row"], *_predictions(classes, F.col("_sums")))


def walk_sql(nodes: str, values: str, classes: Sequence[str]) -> str:
    """The same walk as recursive SQL: tables ``nodes`` and ``values`` (``row``, ``v``, an array from 1) to ``row``, ``votes`` per class."""
    sums = ", ".join(f"sum(votes[{k}]) AS votes_{c}" for k, c in enumerate(classes, 1))
    return f"""WITH RECURSIVE walk AS (
    SELECT r.row, r.v, n.* FROM {values} r JOIN {nodes} n ON n.node = 0
    UNION ALL SELECT w.row, w.v, n.* FROM walk w JOIN {nodes} n
        ON n.tree = w.tree AND n.node = CASE WHEN w.v[w.feature + 1] <= w.cut THEN w."left" ELSE w."right" END WHERE w.feature IS NOT NULL)
SELECT row, {sums} FROM walk WHERE feature IS NULL GROUP BY row"""
