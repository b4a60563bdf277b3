"""Weighted three-class training, scoring and run registry.

The default model is the joint boosting of ``operators.boosting``: a softmax over the three classes, L1 and L2
penalties, row and column sampling, missing values as they are. Two spark.ml
models are kept beside it: ``gbt``, ``OneVsRest(GBTClassifier)`` with a weight column, whose class
probabilities are ``sigmoid(2 * margin_k)`` normalised over the classes, and ``logreg``,
``LogisticRegression(family="multinomial")``; both impute missing values with the median.

Nothing here collects data to the driver: fitting, scoring and metrics are
Spark jobs; only the fitted model and one registry row are written.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchspark.operators import boosting
from pitchspark.operators.boosting import BoostedModel
from pitchspark.operators.evaluate import stratified_split
from pitchspark.session import materialize

# Fixed values of the default model.
DRAW_LABEL = 1
DRAW_MULTIPLIER = 1.35
DECAY_DAYS = 1000.0
GBT_DEFAULTS = {"maxDepth": 3, "stepSize": 0.03, "maxIter": 100, "subsamplingRate": 0.8,
                "featureSubsetStrategy": "0.8", "seed": 42}


def training_weights(df: DataFrame, label: str = "target", weight: str = "match_weight",
                     out: str = "train_weight") -> DataFrame:
    """Decay weight, draws up-weighted on training rows only."""
    w = F.when(F.col(label) == DRAW_LABEL, F.col(weight) * DRAW_MULTIPLIER).otherwise(F.col(weight))
    return df.withColumn(out, F.when(~F.col("is_test"), w).otherwise(F.col(weight)))


ROWS_A_PARTITION = 100_000


def weighted_split(df: DataFrame, key: str = "match_id", label: str = "target") -> DataFrame:
    """Split (W5) and weights (P17), written once: training, scoring and reports all read this table."""
    return materialize(training_weights(stratified_split(df, label, key), label), "split")


def _model_input(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Label and features as doubles, in as many partitions as the rows need: each boosting round reads them all."""
    data = df.withColumn("_label", F.col(label).cast("double")).withColumns({f: F.col(f).cast("double") for f in features})
    return data.coalesce(max(1, -(-data.count() // ROWS_A_PARTITION)))


def _stages(features: list[str], model: str, params: dict, label: str, weight: str | None):
    imputed = [f"{f}__imp" for f in features]
    imp = Imputer(inputCols=features, outputCols=imputed, strategy="median")
    vec = VectorAssembler(inputCols=imputed, outputCol="features", handleInvalid="keep")
    if model == "gbt":
        gbt = GBTClassifier(featuresCol="features", labelCol="_label", **{**GBT_DEFAULTS, **params})
        if weight:
            gbt = gbt.setWeightCol(weight)
        # The three binary models are independent: fit them concurrently.
        clf = OneVsRest(classifier=gbt, featuresCol="features", labelCol="_label", parallelism=3)
        if weight:
            clf = clf.setWeightCol(weight)
    elif model == "logreg":
        clf = LogisticRegression(featuresCol="features", labelCol="_label", family="multinomial", **params)
        if weight:
            clf = clf.setWeightCol(weight)
    else:
        raise ValueError(model)
    return [imp, vec, clf]


def fit(train: DataFrame, features: list[str], label: str = "target", weight: str | None = "train_weight",
        model: str = "gbt", params: dict | None = None, key: str = "match_id") -> PipelineModel | BoostedModel:
    """Fit the weighted classifier (M1): ``boosted`` (rows sampled by ``key``), ``gbt`` or ``logreg``.

    For the spark.ml models the training rows are persisted (memory, spilling to disk) for the
    duration of the fit: the imputer and every boosting round read them,
    and without it each read would recompute the whole upstream plan.
    """
    if model == "boosted":
        return boosting.fit_boosted(train, features, label, weight, key, boosting.Params(**(params or {})))
    data = _model_input(train, features, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=_stages(features, model, params or {}, label, weight)).fit(data)
    finally:
        data.unpersist()


def tune(train: DataFrame, features: list[str], grid: dict[str, list], label: str = "target",
         weight: str | None = "train_weight", folds: int = 5, parallelism: int = 4, model: str = "gbt") -> PipelineModel:
    """Grid search with stratified folds from ``fold`` (M2, W6), scored by accuracy; refits the best.

    The rows are persisted, so the plan above them runs once, not once per
    grid point and fold.
    """
    data = _model_input(train, features, label).withColumn("fold", F.col("fold").cast("int")).persist(StorageLevel.MEMORY_AND_DISK)
    stages = _stages(features, model, {}, label, weight)
    inner = stages[-1].getClassifier() if model == "gbt" else stages[-1]
    pg = ParamGridBuilder()
    for k, vals in grid.items():
        pg = pg.addGrid(inner.getParam(k), vals)
    cv = CrossValidator(estimator=Pipeline(stages=stages), estimatorParamMaps=pg.build(),
                        evaluator=MulticlassClassificationEvaluator(labelCol="_label", metricName="accuracy"),
                        numFolds=folds, foldCol="fold", parallelism=parallelism, seed=42)
    try:
        return cv.fit(data).bestModel
    finally:
        data.unpersist()


def tune_boosted(train: DataFrame, features: list[str], grid: dict[str, list], label: str = "target", weight: str | None = "train_weight",
                 key: str = "match_id", folds: int = 5) -> tuple[BoostedModel, list[tuple]]:
    """Grid search of the boosted model (M2): the point of the best mean accuracy over the stratified folds (W6), the
    first of equals, refitted on all rows; and (parameters, mean accuracy, accuracies by fold) of every point."""
    rows = boosting.binned(train, features, label, weight, key, "fold")
    found = boosting.grid_accuracies(rows, features, grid, label, weight, key, folds=folds)
    best = max(found, key=lambda x: x[1])[0]
    return boosting.fit_boosted(rows, features, label, weight, key, best), found


def score(model: PipelineModel | BoostedModel, df: DataFrame, features: list[str]) -> DataFrame:
    """Predictions and class probabilities ``p ARRAY<DOUBLE>`` (M3, M4)."""
    if isinstance(model, BoostedModel):
        return boosting.score(model, df)
    data = df
    for f in features:
        data = data.withColumn(f, F.col(f).cast("double"))
    out = model.transform(data.withColumn("_label", F.lit(0.0)))
    if "probability" in out.columns:
        probs = vector_to_array("probability")
    else:
        raw = vector_to_array("rawPrediction")
        sig = F.transform(raw, lambda m: 1.0 / (1.0 + F.exp(-2.0 * m)))
        total = F.aggregate(sig, F.lit(0.0), lambda a, x: a + x)
        probs = F.transform(sig, lambda x: x / total)
    keep = [c for c in df.columns]
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"), probs.alias("p"))


def feature_importance(model: PipelineModel | BoostedModel, features: list[str]) -> DataFrame:
    """Importance of each feature, sorted descending (M5, T3): shares of the mean gain, or means over the one-vs-rest models."""
    spark = SparkSession.getActiveSession()
    if isinstance(model, BoostedModel):
        return spark.createDataFrame(model.importance(), "feature string, importance double").orderBy(F.desc("importance"), "feature")
    last = model.stages[-1]
    if hasattr(last, "models"):
        vecs = [m.featureImportances.toArray() for m in last.models]
        imp = [sum(v[i] for v in vecs) / len(vecs) for i in range(len(features))]
    elif hasattr(last, "coefficientMatrix"):
        cm = last.coefficientMatrix.toArray()
        imp = [float(abs(cm[:, i]).mean()) for i in range(len(features))]
    else:
        imp = [0.0] * len(features)
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def train_and_split(df: DataFrame, features: list[str], key: str = "match_id", label: str = "target",
                    model: str = "gbt", params: dict | None = None):
    """Split (W5), weight (P17), fit (M1); returns (model, test predictions)."""
    split = weighted_split(df, key, label)
    m = fit(split.where(~F.col("is_test")), features, label, "train_weight", model, params)
    return m, score(m, split.where(F.col("is_test")), features)


_RUN = "run_name string, version long, created string, accuracy double, training_rows long, params map<string,string>, error string"


def save_run(model: PipelineModel | BoostedModel, path: str, registry: str, run_name: str, accuracy: float | None,
             features: list[str], rows: int, params: dict | None = None) -> int:
    """A model folder of its own below ``path`` plus one registry row (S8); returns the run's version.

    Versions of a run count up from 1. The row is committed as a folder named by run and version
    whose creation fails if it exists, so of two writers of one version one fails and
    takes the next; the model is written before, under a name that no other writer uses, and never
    overwritten.
    """
    spark = SparkSession.getActiveSession()
    made = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    if isinstance(model, BoostedModel):
        model.save(spark, made)
    else:
        model.write().save(made)
    meta = {"draw_multiplier": str(DRAW_MULTIPLIER), "time_decay_days": str(DECAY_DAYS), "features": json.dumps(features), "model_path": made,
            "kind": "boosted" if isinstance(model, BoostedModel) else "pipeline"}
    meta.update({k: str(v) for k, v in (params or {}).items()})
    for _ in range(100):
        version = 1 + (_runs(spark, registry).where(F.col("run_name") == run_name).agg(F.max("version")).first()[0] or 0)
        row = [(run_name, version, _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S"), accuracy, rows, meta, None)]
        try:
            name = hashlib.md5(run_name.encode()).hexdigest()
            spark.createDataFrame(row, _RUN).coalesce(1).write.mode("error").parquet(f"{registry}/run-{name}-{version}")
            return version
        except AnalysisException as e:
            if "PATH_ALREADY_EXISTS" not in str(e):
                raise
    raise RuntimeError(f"no free version of run {run_name}")


def _runs(spark: SparkSession, registry: str) -> DataFrame:
    """All rows of a registry; none if it has not been written yet."""
    try:
        return spark.read.option("recursiveFileLookup", True).schema(_RUN).parquet(registry)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], _RUN)


def load_run(spark: SparkSession, registry: str, run_name: str) -> tuple[PipelineModel | BoostedModel, list[str]]:
    """Model and its stored feature list of the run's highest version (S8; the stored list is used, D8)."""
    meta = _runs(spark, registry).where(F.col("run_name") == run_name).orderBy(F.desc("version")).limit(1).first()
    if meta is None:
        raise KeyError(run_name)
    params = meta["params"]
    kind = BoostedModel.load(spark, params["model_path"]) if params["kind"] == "boosted" else PipelineModel.load(params["model_path"])
    return kind, json.loads(params["features"])


def inspect_run(spark: SparkSession, registry: str, run_name: str, df: DataFrame,
                key: str = "match_id", label: str = "target") -> dict[str, DataFrame]:
    """Reload a run, re-split the same way, re-score and report (M6).

    Returns the stored registry row, accuracy, class report, confusion
    matrix and feature importances as DataFrames (nothing is collected).
    """
    from pitchspark.operators import evaluate as ev

    model, features = load_run(spark, registry, run_name)
    test = stratified_split(df, label, key).where(F.col("is_test"))
    preds = score(model, test, features)
    return {
        "run": _runs(spark, registry).where(F.col("run_name") == run_name).orderBy(F.desc("version")).limit(1),
        "accuracy": ev.accuracy(preds, label, "prediction"),
        "report": ev.class_report(preds, label, "prediction"),
        "confusion": ev.confusion_matrix(preds, label, "prediction"),
        "importance": feature_importance(model, features),
    }
