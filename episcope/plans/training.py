"""MLlib training, tuning and scoring on the feature matrix.

The feature matrix is assembled once, its lineage cut with a reliable checkpoint
(iterative learners re-read it many times, and a lost executor must not replay the
whole feature pipeline), then each estimator is fitted as a ``Pipeline`` so the
scaler / selector / model persist together.  Metrics are the DataFrame evaluation
operators (exact AUC, accuracy), so only one-row results reach the driver.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episcope.operators import evaluation as E
from episcope.operators.encoding import RankEncoder
from episcope.operators.sampling import cv_subsample, fold_column, stratified_split
from episcope.plans import boosting
from episcope.plans.boosting import BoostedModel
from episcope.plans.cuts import TreePipeline
from episcope.session import cut_lineage, path_exists, ship_package


@dataclass
class ModelSpec:
    name: str
    kind: str                 # hist (plans.boosting) | gbt | rf | lr | svm
    params: dict = field(default_factory=dict)
    scaled: bool = False      # linear models see standardised features
    balanced: bool = False    # class weights n / (2 n_class)
    select_k: int | None = None
    calibrated: bool = False  # a margin's probability by Platt scaling on out-of-fold margins


@dataclass
class CalibratedModel:
    """A margin classifier with P(class 1) = 1 / (1 + exp(slope * margin + shift))."""
    model: PipelineModel
    slope: float
    shift: float


# The analysis configuration (boosted trees 300 x depth 8, lr 0.05;
# forest 200 x depth 15 balanced; logistic C = 0.1 balanced, 2000 iterations).
ANALYSIS_MODELS = [
    ModelSpec("boosted_trees", "hist", {"trees": 300, "depth": 8, "rate": 0.05}),
    ModelSpec("random_forest", "rf", {"numTrees": 200, "maxDepth": 15}, balanced=True),
    ModelSpec("logistic_regression", "lr", {"C": 0.1, "maxIter": 2000}, scaled=True, balanced=True),
]
# The trainer's default configuration (100 trees; logistic C = 1).
TRAINER_MODELS = [
    ModelSpec("random_forest", "rf", {"numTrees": 100}),
    ModelSpec("gradient_boosting", "gbt", {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1}),
    ModelSpec("logistic_regression", "lr", {"C": 1.0, "maxIter": 1000}, scaled=True),
    ModelSpec("svm", "svm", {"maxIter": 100}, scaled=True, calibrated=True),
]


def add_weights(df: DataFrame, label: str = "label") -> DataFrame:
    return E.balanced_weights(df, label, "weight")


def _estimator(spec: ModelSpec, n_weight_sum: float | None):
    p = dict(spec.params)
    common = {"featuresCol": "features", "labelCol": "label"}
    if spec.kind == "gbt":
        return GBTClassifier(seed=42, **common, **p)
    if spec.kind == "rf":
        if spec.balanced:
            common["weightCol"] = "weight"
        return RandomForestClassifier(seed=42, **common, **p)
    if spec.kind == "lr":
        c = p.pop("C", 1.0)
        if spec.balanced:
            common["weightCol"] = "weight"
        reg = 1.0 / (c * (n_weight_sum or 1.0))
        return LogisticRegression(regParam=reg, elasticNetParam=0.0, standardization=False, **common, **p)
    if spec.kind == "svm":
        return LinearSVC(**common, **p)
    raise ValueError(spec.kind)


def build_pipeline(spec: ModelSpec, feature_cols, n_weight_sum: float | None = None) -> Pipeline:
    stages = [VectorAssembler(inputCols=list(feature_cols), outputCol="raw_features", handleInvalid="keep")]
    src = "raw_features"
    if spec.scaled:
        stages.append(StandardScaler(inputCol=src, outputCol="scaled", withMean=True, withStd=True))
        src = "scaled"
    if spec.select_k:
        stages.append(UnivariateFeatureSelector(featuresCol=src, outputCol="selected", labelCol="label",
                                                selectionMode="numTopFeatures")
                      .setFeatureType("continuous").setLabelType("categorical")
                      .setSelectionThreshold(min(spec.select_k, len(feature_cols))))
        src = "selected"
    est = _estimator(spec, n_weight_sum)
    est.setFeaturesCol(src)
    stages.append(est)
    return (TreePipeline if spec.kind in ("gbt", "rf") else Pipeline)(stages=stages)


def prepare_training_frame(features: DataFrame, label: str = "outbreak", keys=("disease", "region", "date"),
                           test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Feature matrix + ``label`` (double) + ``row_id`` + ``is_test`` + balanced ``weight``,
    checkpointed so every learner re-reads materialised rows."""
    x = features.withColumn("label", F.col(label).cast("double"))
    x = x.withColumn("row_id", F.pmod(F.xxhash64(*keys), F.lit(2147483647)))
    x = stratified_split(x, "label", "row_id", test_fraction, seed, tiebreak=list(keys))
    x = add_weights(x, "label")
    return cut_lineage(x)


def score(model: PipelineModel, df: DataFrame, keys=("disease", "region", "date"), label: str = "label") -> DataFrame:
    """The caller's ``keys``, actual (only if ``df`` has ``label``), predicted and the probability
    of class 1.  For an SVM that is not calibrated the logistic function of its margin stands for the
    probability; a calibrated one predicts the class that its probability names."""
    if isinstance(model, BoostedModel):
        out = boosting.probability(df, model).withColumn("prediction", (F.col("probability") > 0.5).cast("double"))
        prob = F.col("probability")
    elif isinstance(model, CalibratedModel):
        out = model.model.transform(df)
        prob = 1 / (1 + F.exp(model.slope * vector_to_array("rawPrediction")[1] + model.shift))
        out = out.withColumn("prediction", (prob > 0.5).cast("double"))
    else:
        out = model.transform(df)
        prob = (vector_to_array("probability")[1] if "probability" in out.columns
                else 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1])))
    actual = [F.col(label).cast("int").alias("actual")] if label in df.columns else []
    return out.select(*[c for c in keys if c in df.columns], *actual,
                      F.col("prediction").cast("int").alias("predicted"), prob.alias("probability"))


def predict(models: dict[str, PipelineModel], name: str, df: DataFrame, keys=("disease", "region", "date")) -> DataFrame:
    """Predictions of the model called ``name`` for rows that need no label."""
    if name not in models:
        raise ValueError(f"no model {name!r}; trained: {sorted(models)}")
    return score(models[name], df, keys)


@dataclass
class CrossValidated:
    """Mean and standard deviation of the folds' AUC for each grid point; the best point's model on all rows."""
    avgMetrics: list[float]
    stdMetrics: list[float]
    bestModel: PipelineModel | None


def cv_table(train: DataFrame, folds: int = 3, rows: int | None = 5000, seed: int = 42) -> DataFrame:
    """The rows of a cross-validation with their ``fold``, written once: a seeded subsample (None: all rows)."""
    sub = train if rows is None else cv_subsample(train, "row_id", rows, seed)
    return cut_lineage(fold_column(sub, "label", "row_id", folds, seed), "folds")


def cross_validate(spec: ModelSpec, train: DataFrame, feature_cols, folds: int = 3, rows: int = 5000,
                   seed: int = 42, grid: dict | None = None, parallelism: int = 8, refit: bool = True,
                   table: DataFrame | None = None):
    """Stratified k-fold AUC (mean, std, per grid point), on a seeded subsample of ``rows`` rows
    (None: on all rows).  The regularisation is that of a fold's training rows.  Fits of folds and points
    run side by side: on few rows each is a chain of short jobs that leaves a cluster idle.  ``table``: what
    :func:`cv_table` made of these rows, if it is there already; ``refit``: fit the best point on all of it."""
    sub = cv_table(train, folds, rows, seed) if table is None else table
    total = sub.agg(F.sum("weight") if spec.balanced else F.count(F.lit(1))).first()[0]
    pipe = build_pipeline(spec, feature_cols, total * (folds - 1) / folds)
    est = pipe.getStages()[-1]
    pg = ParamGridBuilder()
    for k, vals in (grid or {}).items():
        pg = pg.addGrid(est.getParam(k), vals)
    maps = pg.build()
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                       metricName="areaUnderROC", numBins=0)

    def auc(job):
        k, params = job
        model = pipe.copy(params).fit(sub.where(F.col("fold") != k))
        return ev.evaluate(model.transform(sub.where(F.col("fold") == k)))
    with ThreadPoolExecutor(parallelism) as pool:
        found = np.array(list(pool.map(auc, [(k, params) for k in range(folds) for params in maps]))).reshape(folds, len(maps))
    mean, std = found.mean(axis=0).tolist(), found.std(axis=0).tolist()
    best = pipe.copy(maps[int(np.argmax(mean))]).fit(sub) if refit else None
    return maps, mean, std, CrossValidated(mean, std, best)


def platt(margins: DataFrame, margin: str = "margin", label: str = "label", rounds: int = 100) -> tuple[float, float]:
    """(slope, shift) of P(1) = 1 / (1 + exp(slope * margin + shift)), by damped Newton steps; a step is one
    aggregation of seven sums.  Targets are (n1 + 1) / (n1 + 2) and 1 / (n0 + 2), so that separable margins do
    not drive the slope to infinity."""
    f, y = F.col(margin).cast("double"), F.col(label) == 1
    n1, n0 = margins.agg(F.count(F.when(y, 1)), F.count(F.when(~y, 1))).first()
    target = F.when(y, (n1 + 1) / (n1 + 2)).otherwise(1 / (n0 + 2))

    def sums(a, b):
        z = F.lit(float(a)) * f + F.lit(float(b))
        p = F.when(z >= 0, F.exp(-z) / (1 + F.exp(-z))).otherwise(1 / (1 + F.exp(z)))
        # -t log p - (1 - t) log(1 - p), without overflow
        loss = F.when(z >= 0, target * z + F.log1p(F.exp(-z))).otherwise((target - 1) * z + F.log1p(F.exp(z)))
        d, w = target - p, p * (1 - p)
        return [float(x or 0.0) for x in margins.agg(F.sum(loss), F.sum(f * d), F.sum(d), F.sum(f * f * w), F.sum(f * w), F.sum(w)).first()]
    a, b = 0.0, float(np.log((n0 + 1) / (n1 + 1)))
    loss, ga, gb, haa, hab, hbb = sums(a, b)
    for _ in range(rounds):
        if abs(ga) < 1e-7 * (n1 + n0) and abs(gb) < 1e-7 * (n1 + n0):
            break
        haa, hbb = haa + 1e-12, hbb + 1e-12
        det = haa * hbb - hab * hab
        da, db = -(hbb * ga - hab * gb) / det, -(haa * gb - hab * ga) / det
        step = 1.0
        while step > 1e-10:
            following = sums(a + step * da, b + step * db)
            if following[0] < loss + 1e-4 * step * (ga * da + gb * db):
                break
            step /= 2
        else:
            break
        a, b = a + step * da, b + step * db
        loss, ga, gb, haa, hab, hbb = following
    return a, b


def calibrate(spec: ModelSpec, train: DataFrame, feature_cols, model, folds: int = 3, seed: int = 42) -> CalibratedModel:
    """``model`` with Platt scaling fitted on margins that models of the other folds give.  ``model`` may be a
    function that fits it: it then runs beside the folds' fits."""
    data = cut_lineage(fold_column(train, "label", "row_id", folds, seed), "calibration-folds")

    def margins(k: int) -> DataFrame:
        rest = data.where(F.col("fold") != k)
        n = rest.agg(F.sum("weight") if spec.balanced else F.count(F.lit(1))).first()[0]
        other = build_pipeline(spec, feature_cols, n).fit(rest)
        return other.transform(data.where(F.col("fold") == k)).select("label", vector_to_array("rawPrediction")[1].alias("margin"))
    with ThreadPoolExecutor(folds + 1) as pool:
        whole = pool.submit(model) if callable(model) else None
        parts = list(pool.map(margins, range(folds)))
        return CalibratedModel(whole.result() if whole else model,
                               *platt(cut_lineage(reduce(DataFrame.unionByName, parts), "margins")))


def _train_hist(spec: ModelSpec, data: DataFrame, feature_cols, cv_folds: int, cv_rows: int | None, seed: int = 42):
    """As :func:`train_one`, for histogram boosting: the model and those of the cross-validation are one
    lockstep fit, whose time is the training time."""
    train, test = data.where(~F.col("is_test")), data.where(F.col("is_test"))
    part = None
    if cv_folds:
        sub = train if cv_rows is None else cv_subsample(train, "row_id", cv_rows, seed)
        folds = fold_column(sub, "label", "row_id", cv_folds, seed).select(F.col("row_id").alias("_id"), "fold").dropDuplicates(["_id"])
        train, part = train.join(folds, F.col("row_id") == F.col("_id"), "left").drop("_id"), "fold"
    specs = [boosting.BoostSpec(spec.name, leave_out=k, seed=seed, **spec.params) for k in (None, *range(cv_folds or 0))]
    t0 = time.time()
    models, held = boosting.fit(train, list(feature_cols), specs, weight="weight" if spec.balanced else None, part=part, keys=["row_id"],
                                stages=[specs[0].trees] if cv_folds else None)
    elapsed = time.time() - t0
    cv = [r["auc"] for r in E.roc_auc_by(held, "model", "label", "probability").collect()] if held is not None else []
    return models[0], score(models[0], test), elapsed, float(np.mean(cv)) if cv else None, float(np.std(cv)) if cv else None


def train_one(spec: ModelSpec, data: DataFrame, feature_cols, cv_folds: int = 3, cv_rows: int = 5000, table: DataFrame | None = None):
    """Fit on the training split, score the test split; returns (metrics dict, model, predictions).  The
    cross-validation runs beside the fit; ``table``: its rows, if :func:`cv_table` has written them."""
    if spec.kind == "hist":
        model, preds, elapsed, mean, std = _train_hist(spec, data, feature_cols, cv_folds, cv_rows)
        preds = cut_lineage(preds, "predictions")
        return ({"model": spec.name, "auc": E.roc_auc(preds, "actual", "probability").first()["auc"],
                 "accuracy": E.accuracy(preds, "actual", "predicted").first()["accuracy"], "cv_auc_mean": mean, "cv_auc_std": std,
                 "training_time": elapsed}, model, preds)
    train = data.where(~F.col("is_test"))
    test = data.where(F.col("is_test"))

    def fit():
        t0 = time.time()
        wsum = train.agg(F.sum("weight")).first()[0] if spec.balanced else train.count()
        pipe = build_pipeline(spec, feature_cols, wsum)
        model = calibrate(spec, train, feature_cols, lambda: pipe.fit(train)) if spec.calibrated else pipe.fit(train)
        preds = score(model, test)
        auc = E.roc_auc(preds, "actual", "probability").first()["auc"]
        return model, preds, auc, E.accuracy(preds, "actual", "predicted").first()["accuracy"], time.time() - t0
    with ThreadPoolExecutor(1) as pool:
        fitted = pool.submit(fit)
        _, cv_mean, cv_std, _ = cross_validate(spec, train, feature_cols, cv_folds, cv_rows, refit=False, table=table) \
            if cv_folds else ([], [None], [None], None)
        model, preds, auc, accuracy, elapsed = fitted.result()
    f = lambda v: None if v is None else float(v)
    return ({"model": spec.name, "auc": f(auc), "accuracy": f(accuracy), "cv_auc_mean": f(cv_mean[0]),
             "cv_auc_std": f(cv_std[0]), "training_time": float(elapsed)}, model, preds)


PERF_SCHEMA = ("model string, auc double, accuracy double, cv_auc_mean double, cv_auc_std double, "
               "training_time double")


def train_all(spark: SparkSession, data: DataFrame, feature_cols, specs=None, cv_folds: int = 3, cv_rows: int | None = None, parallelism: int = 4):
    """Train every spec, ``parallelism`` at a time; returns (performance DataFrame sorted by AUC,
    {name: (model, predictions)}).  All cross-validations read one table of folds, of all training rows unless ``cv_rows``."""
    specs = list(specs or ANALYSIS_MODELS)
    ship_package(spark)
    table = cv_table(data.where(~F.col("is_test")), cv_folds, cv_rows) if cv_folds and any(s.kind != "hist" for s in specs) else None
    with ThreadPoolExecutor(parallelism) as pool:
        found = list(pool.map(lambda spec: train_one(spec, data, feature_cols, cv_folds, cv_rows, table), specs))
    rows = [r for r, _m, _p in found]
    fitted = {spec.name: (model, preds) for spec, (_r, model, preds) in zip(specs, found)}
    perf = spark.createDataFrame(rows, PERF_SCHEMA).orderBy(F.col("auc").desc())
    return perf, fitted


def feature_importance(spark: SparkSession, model: PipelineModel, feature_cols) -> DataFrame | None:
    """(feature, importance) of a tree model; None for linear models."""
    if isinstance(model, BoostedModel):
        return spark.createDataFrame(list(model.importance().items()), "feature string, importance double")
    last = (model.model if isinstance(model, CalibratedModel) else model).stages[-1]
    if not hasattr(last, "featureImportances"):
        return None
    imp = last.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(feature_cols, [float(v) for v in imp])), "feature string, importance double")


def save_pipeline(model, path: str) -> None:
    spark = SparkSession.active()
    if isinstance(model, BoostedModel):
        boosting.save(spark, model, path)
    elif isinstance(model, CalibratedModel):
        model.model.write().overwrite().save(f"{path}/model")
        spark.createDataFrame([(model.slope, model.shift)], "slope double, shift double").write.mode("overwrite").parquet(f"{path}/calibration")
    else:
        model.write().overwrite().save(path)


def load_pipeline(path: str):
    """The model that :func:`save_pipeline` wrote."""
    spark = SparkSession.active()
    if path_exists(spark, f"{path}/about"):
        return boosting.load(spark, path)
    if path_exists(spark, f"{path}/calibration"):
        return CalibratedModel(PipelineModel.load(f"{path}/model"), *spark.read.parquet(f"{path}/calibration").first())
    return PipelineModel.load(path)


@dataclass
class Scoring:
    """A model with the encoders of its raw columns: scores rows that still have names instead of codes."""
    model: object
    encoders: list[RankEncoder]

    def score(self, df: DataFrame, keys=("disease", "region", "date"), unseen: str | int = "error") -> DataFrame:
        """As :func:`score`; a name that an encoder has not seen is an error, or gets ``unseen`` as its code."""
        for e in self.encoders:
            df = e.transform(df, unseen)
        return score(self.model, df, keys)


def save_scoring(scoring: Scoring, path: str) -> None:
    """The model in ``path/scorer`` and each encoder's sorted dictionary in ``path/encoders/<column>``."""
    save_pipeline(scoring.model, f"{path}/scorer")
    for e in scoring.encoders:
        e.save(f"{path}/encoders/{e.col}")
    SparkSession.active().createDataFrame([(e.col,) for e in scoring.encoders], "col string").coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")


def load_scoring(spark: SparkSession, path: str) -> Scoring:
    columns = [r["col"] for r in spark.read.parquet(f"{path}/columns").collect()]
    found = [RankEncoder.load(spark, f"{path}/encoders/{c}") for c in columns]
    return Scoring(load_pipeline(f"{path}/scorer"), [e for e in found if e is not None])
