"""Training, tuning and applying random forests with Spark ML."""

from __future__ import annotations

import json
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions import text
from flowlens.functions.labels import ANOMALY
from flowlens.operators import encoding, forest, harmonise, metrics, sampling
from flowlens.session import stage

# Forest settings, folds and rows of the cross validation, search space.
TREES = 200
DEEPEST = 30
FOLDS = 5
CV_ROWS = 200_000
SEARCH_DRAWS = 20
SEARCH_FOLDS = 3
SEARCH_SPACE = {
    "numTrees": range(50, 300),
    "maxDepth": [DEEPEST, 5, 10, 15, 20, 25, 30],
    "minInstancesPerNode": range(1, 10),
    "featureSubsetStrategy": ["sqrt", "log2", "all"],
    "bootstrap": [True, False],
    "balanced": [False, True],
}

# Memory for split statistics: the more nodes one pass can split, the fewer passes over the
# data. Deeper trees keep each row's node instead of walking every tree again.
SPLIT_MEMORY = 512
DEEP = 10


class PlainForest(RandomForestClassifier):
    """Fits a model without its training summary.

    The summary of a forest of two classes holds the session, and every task that predicts would have to ship it, which fails once the
    session has a tag or an observation. A copy of the model has none.
    """

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        return super()._fit(dataset).copy()


@dataclass
class ForestSettings:
    """Spark grows trees to depth 30 at most; there is no minimum split size. ``maxBins`` bounds the cuts tried per feature."""

    numTrees: int = TREES
    maxDepth: int = DEEPEST
    minInstancesPerNode: int = 1
    featureSubsetStrategy: str = "sqrt"
    bootstrap: bool = True
    balanced: bool = True
    seed: int = 42
    maxBins: int = 32

    def classifier(self, features: str = "features", label: str = "label") -> RandomForestClassifier:
        learner = PlainForest(
            featuresCol=features, labelCol=label, predictionCol="encoded", probabilityCol="probability",
            rawPredictionCol="votes", numTrees=self.numTrees, maxDepth=self.maxDepth,
            minInstancesPerNode=self.minInstancesPerNode, featureSubsetStrategy=self.featureSubsetStrategy,
            bootstrap=self.bootstrap, seed=self.seed, maxBins=self.maxBins, maxMemoryInMB=SPLIT_MEMORY,
            cacheNodeIds=self.maxDepth > DEEP)
        return learner.setWeightCol("_weight") if self.balanced else learner


@dataclass
class Trained:
    """A fitted model with its class order and expanded feature names."""

    model: PipelineModel
    classes: list[str]
    features: list[str]
    inputs: list[str]
    extra: dict = field(default_factory=dict)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.getActiveSession()
        document = json.dumps({"classes": self.classes, "features": self.features,
                               "inputs": self.inputs, "extra": self.extra})
        spark.createDataFrame([(document,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/metadata")

    @property
    def encoded(self) -> bool:
        """True for a model on encoded columns, which keeps their names as they are."""
        return len(self.model.stages) == 1

    @staticmethod
    def load(spark: SparkSession, path: str) -> Trained:
        document = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
        return Trained(PipelineModel.load(f"{path}/model"), document["classes"], document["features"],
                       document["inputs"], document["extra"])


def _labeller(target: str, classes: Mapping[str, float]) -> StringIndexerModel:
    """Codes of the classes in alphabetical order."""
    return StringIndexerModel.from_labels(sorted(classes), inputCol=target, outputCol="label")


def _weight_column(settings: ForestSettings) -> list[str]:
    return ["_weight"] if settings.balanced else []


def fit(train: DataFrame, target: str = "class", settings: ForestSettings | None = None,
        provenance: Sequence[str] = (), wide: str = "fail") -> Trained:
    """Impute, scale, one-hot encode and fit a forest; ``provenance`` columns are no features.

    ``wide`` says what becomes of columns of very many categories (``encoding.settle_levels``); a model fitted with
    ``hash`` wants its rows hashed alike. Headers are normalised first. Fitting passes over ``train`` several times, so give it a
    stored table. The prepared features are stored once: the forest reads them for every level of its trees.
    """
    settings = settings or ForestSettings()
    train, target = harmonise.normalise_headers(train, target)
    provenance = [text.header_name(name) for name in provenance]
    harmonise.require_column(train, target)
    known = train.filter(text.col(target).isNotNull())
    numbers, categories = harmonise.feature_types(known, exclude=[target, *provenance])
    known, categories = encoding.settle_levels(known, categories, wide)
    fits, modes = encoding.fit_numbers(known, numbers), encoding.fit_modes(known, categories)
    stages = [encoding.projection_stage(fits, modes)]
    blocks = [f"num_{i}" for i in range(len(fits))]
    if modes:
        indexed, hot = [f"idx_{i}" for i in range(len(modes))], [f"hot_{i}" for i in range(len(modes))]
        stages += [StringIndexer(inputCols=[f"cat_{i}" for i in range(len(modes))], outputCols=indexed,
                                 handleInvalid="keep", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True)]
        blocks += hot
    weights = encoding.class_weights(known, target)
    labeller = _labeller(target, weights)
    stages.append(VectorAssembler(inputCols=blocks, outputCol="features"))
    weighted = encoding.with_weight(known, target, weights) if settings.balanced else known
    prepared = Pipeline(stages=stages).fit(weighted)
    rows = labeller.transform(prepared.transform(weighted)).select("features", "label", *_weight_column(settings))
    model = PipelineModel([*prepared.stages, settings.classifier().fit(stage(rows, "prepared"))])
    names = list(fits)
    indexer = next((s for s in model.stages if isinstance(s, StringIndexerModel)), None)
    for name, values in zip(modes, indexer.labelsArray if indexer else []):
        names += [f"{name}_{value}" for value in values]
    return Trained(model, list(labeller.labels), names, [*numbers, *categories], {"settings": asdict(settings)})


def fit_encoded(train: DataFrame, features: Sequence[str], target: str = "class",
                settings: ForestSettings | None = None) -> Trained:
    """Fit on columns that are encoded already; the model keeps their order. ``train`` is read once."""
    settings = settings or ForestSettings(balanced=False)
    known = train.filter(text.col(target).isNotNull())
    rows = stage(assembled(known, features, [target]), "prepared")
    weights = encoding.class_weights(rows, target)
    labeller = _labeller(target, weights)
    if settings.balanced:
        rows = encoding.with_weight(rows, target, weights)
    model = Pipeline(stages=[settings.classifier()]).fit(labeller.transform(rows))
    return Trained(model, list(labeller.labels), list(features), list(features), {"settings": asdict(settings)})


def assembled(df: DataFrame, features: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) and one ``features`` vector in the given order."""
    kept = [text.col(c) for c in (df.columns if keep is None else keep)]
    values = F.array(*[F.coalesce(text.col(c).cast("double"), F.lit(0.0)) for c in features])
    return df.select(*kept, array_to_vector(values).alias("features"))


def prediction_columns(trained: Trained, positive: str = ANOMALY) -> list[Column]:
    """Label, its code, the score of the positive label by name, and class → probability."""
    proba = vector_to_array("probability")
    names = F.array(*[F.lit(c) for c in trained.classes])
    code = F.col("encoded").cast("int")
    place = trained.classes.index(positive) if positive in trained.classes else 0
    return [F.get(names, code).alias("predicted_label"), code.alias("predicted_label_encoded"),
            F.get(proba, F.lit(place)).alias("anomaly_score"),
            F.map_from_arrays(names, proba).alias("raw_proba")]


def predict(trained: Trained, df: DataFrame, positive: str = ANOMALY) -> DataFrame:
    """Input columns plus the prediction columns."""
    df = df if trained.encoded else harmonise.normalise_headers(df, "")[0]
    rows = assembled(df, trained.features) if trained.encoded else df
    return trained.model.transform(rows).select(*[text.col(c) for c in df.columns],
                                                *prediction_columns(trained, positive))


def _forest(trained: Trained) -> RandomForestClassificationModel:
    return next(s for s in trained.model.stages if isinstance(s, RandomForestClassificationModel))


def forest_nodes(trained: Trained) -> DataFrame:
    """The fitted forest as a table of nodes (``operators.forest``), with the names of the features that split."""
    names = F.array(*[F.lit(name) for name in trained.features])
    return forest.nodes_of(_forest(trained)).withColumn("name", F.get(names, F.col("feature")))


def predict_by_nodes(trained: Trained, nodes: DataFrame, df: DataFrame, positive: str = ANOMALY) -> DataFrame:
    """``predict`` from a table of nodes: the trained object prepares the features, the table decides."""
    df = df if trained.encoded else harmonise.normalise_headers(df, "")[0]
    rows = assembled(df, trained.features) if trained.encoded else PipelineModel(trained.model.stages[:-1]).transform(df)
    kept = rows.select(*[text.col(c) for c in df.columns], vector_to_array("features").alias("_features"))
    scored = forest.score(nodes, kept, F.col("_features"), trained.classes, trained.extra["settings"]["maxDepth"])
    codes = F.array_position(F.array(*[F.lit(c) for c in trained.classes]), F.col("predicted_label")).cast("int") - 1
    place = positive if positive in trained.classes else trained.classes[0]
    return scored.select(*[text.col(c) for c in df.columns], "predicted_label", codes.alias("predicted_label_encoded"),
                         F.col("raw_proba")[place].alias("anomaly_score"), "raw_proba")


def probability_columns(trained: Trained, predicted: DataFrame) -> DataFrame:
    """File layout of predictions: two classes give ``anomaly_score``, more give ``proba_<class>``."""
    plain = predicted.drop("predicted_label_encoded", "raw_proba").withColumnRenamed("predicted_label", "prediction")
    if len(trained.classes) == 2:
        return plain
    probabilities = [predicted["raw_proba"][c].alias(f"proba_{c}") for c in trained.classes]
    return (predicted.select("*", *probabilities).drop("predicted_label_encoded", "raw_proba", "anomaly_score")
            .withColumnRenamed("predicted_label", "prediction"))


def score_requests(trained: Trained, items: DataFrame, features: str = "features") -> DataFrame:
    """Score request items: features in model order, absent ones 0, unknown ones ignored."""
    others = [c for c in items.columns if c != features]
    given = F.col(features)
    aligned = F.array(*[F.coalesce(given[name], F.lit(0.0)) for name in trained.features])
    rows = items.select(*others, given.alias("input_features"), array_to_vector(aligned).alias("features"))
    return trained.model.transform(rows).select(*others, "input_features", *prediction_columns(trained))


def auc_of(trained: Trained, scored: DataFrame, target: str, positive: str = ANOMALY) -> DataFrame:
    """One row (auc): binary by the positive label, else the mean of one against the rest."""
    if len(trained.classes) > 2:
        proba = {c: F.col("raw_proba")[c] for c in trained.classes}
        return metrics.mean_auc(metrics.roc_auc_ovr(scored, target, proba))
    label = positive if positive in trained.classes else trained.classes[0]
    counts = metrics.score_counts(scored.withColumn("_s", F.col("raw_proba")[label]), "_s", text.col(target) == label)
    return metrics.roc_auc(counts).select("auc")


def cross_validate(df: DataFrame, target: str = "class", folds: int = FOLDS, settings: ForestSettings | None = None,
                   key: Sequence[str] | None = None, provenance: Sequence[str] = (), most_rows: int | None = None,
                   positive: str = ANOMALY, parallelism: int = 4, seed: int = 42) -> DataFrame:
    """(fold, rows, auc) of a model fitted on the other folds, preprocessing included.

    All rows take part unless ``most_rows`` bounds them (``CV_ROWS`` is the usual bound) to those first in hash order. ``parallelism``
    folds are submitted at a time, as in Spark's own cross validation.
    """
    subset = sampling.cap_rows(df, most_rows, (), key, seed) if most_rows is not None else df
    folded = stage(sampling.stratified_folds(subset, folds, target, key, seed), "folds")
    hidden = [*provenance, *(key or ())]
    spark = df.sparkSession

    sizes = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}

    def run(fold: int) -> tuple[int, int, float | None]:
        trained = fit(folded.filter(F.col("fold") != fold).drop("fold"), target, settings, hidden)
        scored = predict(trained, folded.filter(F.col("fold") == fold).drop("fold"), positive)
        return fold, sizes.get(fold, 0), auc_of(trained, scored, target, positive).first()["auc"]

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(run), range(folds)))
    return spark.createDataFrame(rows, "fold int, rows long, auc double")


def draw_settings(draws: int = SEARCH_DRAWS, space: Mapping[str, Sequence] = SEARCH_SPACE, seed: int = 42) -> list[ForestSettings]:
    rng = random.Random(seed)
    return [ForestSettings(**{name: rng.choice(list(choices)) for name, choices in space.items()}, seed=seed)
            for _ in range(draws)]


def random_search(df: DataFrame, features: Sequence[str], target: str = "class", draws: int = SEARCH_DRAWS,
                  folds: int = SEARCH_FOLDS, space: Mapping[str, Sequence] = SEARCH_SPACE,
                  key: Sequence[str] | None = None, positive: str = ANOMALY, parallelism: int = 4,
                  seed: int = 42) -> tuple[Trained, DataFrame]:
    """Best of ``draws`` random settings by cross-validated F1 of the positive label.

    Returns the model refitted on all rows, and one row per draw with its score.
    """
    known = df.filter(text.col(target).isNotNull())
    folded = sampling.stratified_folds(known, folds, target, key, seed)
    weights = encoding.class_weights(known, target)
    labeller = _labeller(target, weights)
    if positive not in labeller.labels:
        raise ValueError(f"no row of class '{positive}' in column '{target}'")
    rows = encoding.with_weight(assembled(folded, features, [target, "fold"]), target, weights, "_balanced")
    rows = stage(labeller.transform(rows.withColumn("_even", F.lit(1.0))).drop(target), "search")
    settings = draw_settings(draws, space, seed)
    learner = ForestSettings(maxDepth=max(s.maxDepth for s in settings), balanced=False, seed=seed).classifier()
    grid = [{learner.numTrees: s.numTrees, learner.maxDepth: s.maxDepth,
             learner.minInstancesPerNode: s.minInstancesPerNode,
             learner.featureSubsetStrategy: s.featureSubsetStrategy, learner.bootstrap: s.bootstrap,
             learner.weightCol: "_balanced" if s.balanced else "_even"} for s in settings]
    judge = MulticlassClassificationEvaluator(
        labelCol="label", predictionCol="encoded", metricName="fMeasureByLabel",
        metricLabel=float(labeller.labels.index(positive)))
    search = CrossValidator(estimator=learner, estimatorParamMaps=grid, evaluator=judge, numFolds=folds,
                            foldCol="fold", parallelism=parallelism, seed=seed)
    fitted = search.fit(rows)
    scores, spread = ([float(value) for value in found] for found in (fitted.avgMetrics, fitted.stdMetrics))
    best = max(range(draws), key=scores.__getitem__)
    trained = Trained(PipelineModel([fitted.bestModel]), list(labeller.labels), list(features),
                      list(features), {"settings": asdict(settings[best]), "cv_f1": scores[best]})
    table = [(i, s.numTrees, s.maxDepth, s.minInstancesPerNode, s.featureSubsetStrategy, s.bootstrap, s.balanced,
              scores[i], spread[i], i == best) for i, s in enumerate(settings)]
    return trained, df.sparkSession.createDataFrame(
        table, "draw int, trees int, depth int, min_leaf int, subset string, bootstrap boolean, "
               "balanced boolean, cv_f1 double, cv_f1_std double, best boolean")


def feature_importances(trained: Trained, top: int = 30) -> DataFrame:
    """(feature, importance) of the ``top`` expanded features, descending."""
    rows = [(name, float(value)) for name, value in zip(trained.features, _forest(trained).featureImportances.toArray())]
    table = SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)
