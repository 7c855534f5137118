"""MLlib invariants on a separable fixture (trees / boosting cannot match another
library row for row, so the checks are properties)."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from episcope.plans import training as ML


def _fixture(spark, n=4000, seed=11):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6))
    y = (x @ np.array([1.5, -2.0, 1.0, 0.5, 0.0, 0.0]) + rng.normal(scale=0.5, size=n) > 1.3).astype(int)
    rows = [(f"s{i % 3}", f"r{i}", i, int(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "disease string, region string, date long, outbreak int, "
                                     "f0 double, f1 double, f2 double, f3 double, f4 double, f5 double")
    return df, [f"f{i}" for i in range(6)]


def test_split_train_score_save_load(spark):
    df, cols = _fixture(spark)
    data = ML.prepare_training_frame(df, "outbreak", ("disease", "region", "date"))
    sizes = {r.is_test: r["count"] for r in data.groupBy("is_test").count().collect()}
    n1 = df.where("outbreak = 1").count()
    assert sizes[True] == int(np.floor(0.2 * n1 + 0.5)) + int(np.floor(0.2 * (4000 - n1) + 0.5))

    spec = ML.ANALYSIS_MODELS[2]  # balanced logistic regression on scaled features
    r, model, preds = ML.train_one(spec, data, cols, cv_folds=3, cv_rows=2000)
    assert r["auc"] > 0.9 and 0.5 < r["accuracy"] <= 1.0
    assert r["cv_auc_mean"] > 0.9 and r["cv_auc_std"] >= 0.0
    lo, hi = preds.agg(F.min("probability"), F.max("probability")).first()
    assert 0.0 <= lo <= hi <= 1.0

    path = os.path.join(tempfile.mkdtemp(prefix="episcope-model-"), "lr")
    ML.save_pipeline(model, path)
    again = ML.score(ML.load_pipeline(path), data.where("is_test"))
    j = preds.alias("a").join(again.alias("b"), ["disease", "region", "date"])
    assert j.where(F.col("a.probability") != F.col("b.probability")).count() == 0
    assert j.count() == sizes[True]


def test_forest_importance(spark):
    df, cols = _fixture(spark, n=1500)
    data = ML.prepare_training_frame(df, "outbreak", ("disease", "region", "date"))
    spec = ML.ModelSpec("random_forest", "rf", {"numTrees": 20, "maxDepth": 6}, balanced=True)
    r, model, _ = ML.train_one(spec, data, cols, cv_folds=0)
    imp = {x.feature: x.importance for x in ML.feature_importance(spark, model, cols).collect()}
    assert abs(sum(imp.values()) - 1.0) < 1e-6
    assert imp["f1"] > imp["f5"] and imp["f0"] > imp["f4"]
    assert r["auc"] > 0.85


def test_predict_needs_no_label_and_a_known_model(spark):
    df, cols = _fixture(spark, n=800)
    data = ML.prepare_training_frame(df, "outbreak", ("disease", "region", "date"))
    for spec in (ML.ANALYSIS_MODELS[2], ML.TRAINER_MODELS[3]):
        _r, model, _p = ML.train_one(spec, data, cols, cv_folds=0)
        new = df.drop("outbreak").withColumn("own_key", F.col("date"))
        out = ML.predict({spec.name: model}, spec.name, new, keys=("own_key",))
        assert out.columns == ["own_key", "predicted", "probability"] and out.count() == 800
        assert out.where("probability < 0 or probability > 1 or (probability > 0.5) <> (predicted = 1)").count() == 0
        with pytest.raises(ValueError, match="no model"):
            ML.predict({spec.name: model}, "other", new)


def test_cross_validation_regularises_like_a_fold(spark):
    df, cols = _fixture(spark, n=900)
    data = ML.prepare_training_frame(df, "outbreak", ("disease", "region", "date"))
    spec = ML.ModelSpec("plain", "lr", {"C": 1.0, "maxIter": 50}, scaled=True)
    _maps, mean, _std, cv = ML.cross_validate(spec, data.where("not is_test"), cols, folds=3, rows=None)
    assert abs(cv.bestModel.stages[-1].getRegParam() - 1 / (720 * 2 / 3)) < 1e-4 and mean[0] > 0.9


def test_boosting_and_selection(spark):
    df, cols = _fixture(spark, n=800)
    data = ML.prepare_training_frame(df, "outbreak", ("disease", "region", "date"))
    r, _m, _p = ML.train_one(ML.ModelSpec("gbt", "gbt", {"maxIter": 5, "maxDepth": 3}), data, cols, cv_folds=0)
    assert r["auc"] > 0.8
    spec = ML.ModelSpec("sel", "lr", {"C": 1.0, "maxIter": 50}, scaled=True, select_k=2)
    _r, model, _p = ML.train_one(spec, data, cols, cv_folds=0)
    sel = [s for s in model.stages if hasattr(s, "selectedFeatures")][0]
    assert sorted(cols[i] for i in sel.selectedFeatures) == ["f0", "f1"]


def test_models_train_side_by_side_on_one_table_of_folds(spark, monkeypatch):
    import threading
    df, cols = _fixture(spark, n=600)
    data = ML.prepare_training_frame(df, "outbreak", ("disease", "region", "date"))
    specs = [ML.ModelSpec("lr", "lr", {"C": 1.0, "maxIter": 20}, scaled=True), ML.ModelSpec("svm", "svm", {"maxIter": 10}, scaled=True)]
    alone = {s.name: ML.cross_validate(s, data.where("not is_test"), cols, folds=2, rows=300)[1:3] for s in specs}
    tables, together, plain = [], threading.Barrier(2), ML.train_one
    written = ML.fold_column

    def folds(*args, **kw):
        tables.append(1)
        return written(*args, **kw)

    def one(*args, **kw):
        together.wait(60)             # broken unless both models are in training
        return plain(*args, **kw)
    monkeypatch.setattr(ML, "fold_column", folds)
    monkeypatch.setattr(ML, "train_one", one)
    perf, fitted = ML.train_all(spark, data, cols, specs, cv_folds=2, cv_rows=300)
    assert len(tables) == 1 and set(fitted) == {"lr", "svm"}
    for r in perf.collect():
        assert (r["cv_auc_mean"], r["cv_auc_std"]) == pytest.approx((alone[r["model"]][0][0], alone[r["model"]][1][0]))


def test_folds_fit_side_by_side(spark, monkeypatch):
    import threading
    df, cols = _fixture(spark, n=600)
    data = ML.prepare_training_frame(df, "outbreak", ("disease", "region", "date"))
    spec = ML.ModelSpec("svm", "svm", {"maxIter": 5}, scaled=True, calibrated=True)
    together, plain = threading.Barrier(4), ML.build_pipeline

    def fit(self, *args, **kw):
        together.wait(60)             # the whole model and three folds
        return pipeline_fit(self, *args, **kw)
    pipeline_fit = ML.Pipeline.fit
    monkeypatch.setattr(ML.Pipeline, "fit", fit)
    train = data.where("not is_test")
    model = ML.calibrate(spec, train, cols, lambda: plain(spec, cols).fit(train))
    assert model.slope < 0


def test_model_comparison_cross_validates_on_all_training_rows(spark, monkeypatch):
    from episcope.plans import registry as R
    df, cols = _fixture(spark, n=7000)
    data = ML.prepare_training_frame(df, "outbreak", ("disease", "region", "date"))
    spec = ML.ModelSpec("lr", "lr", {"C": 1.0, "maxIter": 10}, scaled=True)
    rows, written = [], ML.cv_table

    def folds(*args, **kw):
        table = written(*args, **kw)
        rows.append(table.count())
        return table
    monkeypatch.setattr(R, "_training_data", lambda _spark, _sf: (data, cols))
    monkeypatch.setattr(ML, "TRAINER_MODELS", [spec])
    monkeypatch.setattr(ML, "cv_table", folds)
    out = R.q_e12(spark, "all-training-rows").collect()
    train = data.where("not is_test")
    assert rows == [train.count()] and rows[0] > 5000
    assert out[0]["cv_auc_mean"] == pytest.approx(ML.cross_validate(spec, train, cols, rows=None, refit=False)[1][0])


def test_train_all_cross_validates_on_all_training_rows(spark, monkeypatch):
    df, cols = _fixture(spark, n=7000)
    data = ML.prepare_training_frame(df, "outbreak", ("disease", "region", "date"))
    rows, written = [], ML.cv_table

    def folds(*args, **kw):
        table = written(*args, **kw)
        rows.append(table.count())
        return table
    monkeypatch.setattr(ML, "cv_table", folds)
    ML.train_all(spark, data, cols, [ML.ModelSpec("lr", "lr", {"C": 1.0, "maxIter": 5}, scaled=True)], cv_folds=2)
    assert rows == [data.where("not is_test").count()] and rows[0] > 5000


def test_cuts_of_trees_come_from_all_rows(spark):
    # the label changes at one of the 32 steps of equal weight: only cuts of all rows meet it
    df = ML.cut_lineage(spark.range(12_000).select(F.col("id").cast("double").alias("f0"), (F.pmod("id", F.lit(7))).cast("double").alias("f1"),
                                                   (F.col("id") >= 6000).cast("double").alias("label")))
    model = ML.build_pipeline(ML.ModelSpec("gbt", "gbt", {"maxIter": 1, "maxDepth": 1}), ["f0", "f1"]).fit(df)
    assert ML.score(model, df, keys=()).where("actual <> predicted").count() == 0


def _plain_cuts(x, w, bins=32):
    values, at = np.unique(x, return_inverse=True)
    weight = np.bincount(at, w)
    if len(values) <= bins:
        return ((values[:-1] + values[1:]) / 2).tolist()
    step, out, here = w.sum() / bins, [], weight[0]
    target = step
    for i in range(1, len(values)):
        before, here = here, here + weight[i]
        if abs(before - target) < abs(here - target):
            out.append((values[i - 1] + values[i]) / 2)
            target += step
    return out


@pytest.fixture(scope="module")
def odd_columns(spark):
    rng = np.random.default_rng(5)
    n = 3000
    x = {"even": rng.normal(size=n), "few": rng.integers(0, 5, n).astype(float), "hot zero": np.where(rng.random(n) < 0.6, 0.0, rng.gamma(2, size=n)),
         "rounded": np.round(rng.exponential(3, n)), "one": np.full(n, 7.0)}
    x["label"] = (x["even"] + 0.3 * x["few"] - 0.5 * x["hot zero"] + rng.normal(scale=0.7, size=n) > 0.4).astype(float)
    x["weight"] = np.where(x["label"] == 1, 1.75, 0.625)
    rows = [(i, *map(float, r)) for i, r in enumerate(zip(*x.values()))]
    return ML.cut_lineage(spark.createDataFrame(rows, "id long, " + ", ".join(f"`{c}` double" for c in x))), x, list(x)[:5]


def test_candidate_cuts_follow_the_rule(spark, odd_columns):
    from episcope.plans import cuts as C
    df, x, cols = odd_columns
    for weight in (None, "weight"):
        w = x["weight"] if weight else np.ones(len(x["label"]))
        assert C.candidate_cuts(df, cols, 32, weight) == [_plain_cuts(x[c], w) for c in cols]
    odd = spark.createDataFrame([(1.0, None), (float("nan"), 2.0), (3.0, 3.0), (None, 4.0), (float("inf"), 4.0)], "a double, b double")
    assert C.candidate_cuts(odd, ["a", "b"]) == [[2.0], [2.5, 3.5]]
    assert C.candidate_cuts(odd.limit(0), ["a", "b"]) == [[], []]


def test_binned_learners_equal_the_unsampled_ones(odd_columns, monkeypatch, tmp_path):
    from episcope.plans import cuts as C
    df, _x, cols = odd_columns
    for spec in (ML.ModelSpec("rf", "rf", {"numTrees": 4, "maxDepth": 4}, balanced=True), ML.ModelSpec("gbt", "gbt", {"maxIter": 3, "maxDepth": 3}),
                 ML.ModelSpec("selected", "rf", {"numTrees": 3, "maxDepth": 4}, select_k=3)):
        found = []
        for limit in (C.SAMPLED_FROM, 0):
            with monkeypatch.context() as m:
                m.setattr(C, "SAMPLED_FROM", limit)
                model = ML.build_pipeline(spec, cols).fit(df)
            ML.save_pipeline(model, f"{tmp_path}/{spec.name}-{limit}")
            rows = ML.score(ML.load_pipeline(f"{tmp_path}/{spec.name}-{limit}"), df, keys=("id",)).orderBy("id").collect()
            found.append((model.stages[-1].featureImportances.toArray().tolist(), [r["probability"] for r in rows]))
        assert found[0][0] == pytest.approx(found[1][0]) and found[0][1] == pytest.approx(found[1][1])


def test_missing_values_are_a_bin_of_their_own(spark):
    rows = [(float(i % 500) if i % 7 else None, float("nan") if i % 5 == 0 else float(i % 50), float(i % 7 == 0)) for i in range(11_000)]
    df = ML.cut_lineage(spark.createDataFrame(rows, "a double, b double, label double"))
    model = ML.build_pipeline(ML.ModelSpec("rf", "rf", {"numTrees": 5, "maxDepth": 4}), ["a", "b"]).fit(df)
    assert ML.score(model, df, keys=()).where("actual <> predicted").count() == 0
