"""Fitted encoders, saved scoring of raw rows, Platt scaling."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from episcope.operators import encoding as ENC
from episcope.plans import training as ML

KEYS = ("disease", "region", "date")


def test_codes_are_kept_and_unseen_values_refused(spark, monkeypatch):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", 4), ("c", 5)], "k string, n int")
    e = ENC.RankEncoder.fit(df, "k")
    path = tempfile.mkdtemp(prefix="episcope-encoder-")
    e.save(path)
    again = ENC.RankEncoder.load(spark, path)
    new = spark.createDataFrame([("c", 1), ("a", 2), (None, 3)], "k string, n int")
    assert sorted(tuple(r) for r in again.transform(new).select("n", "k_encoded").collect()) == [(1, 2), (2, 0), (3, None)]
    odd = new.union(spark.createDataFrame([("zz", 9)], "k string, n int"))
    with pytest.raises(Exception, match="has not seen: zz"):
        again.transform(odd).collect()
    assert {r.n: r.k_encoded for r in again.transform(odd, unseen=-1).collect()} == {1: 2, 2: 0, 3: None, 9: -1}
    assert {r.n: r.k_encoded for r in again.transform(odd, unseen="null").collect()} == {1: 2, 2: 0, 3: None, 9: None}
    monkeypatch.setattr(ENC, "MAX_ONE_TASK", 1)
    assert {r.value: r.code for r in ENC.RankEncoder.fit(df, "k").codes.collect()} == {"a": 0, "b": 1, "c": 2}
    none = ENC.RankEncoder.fit(df.where("n > 9"), "k")
    assert none.codes.count() == 0 and none.transform(df.where("k is null")).first().k_encoded is None


def _data(spark, n=900, seed=7):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    code = rng.integers(0, 3, n)
    y = (x @ np.array([1.5, -1.0, 0.5]) + (code == 2) + rng.normal(scale=1.0, size=n) > 0.8).astype(int)
    rows = [(["flu", "measles", "zika"][c], f"r{i}", i, int(t), *map(float, r)) for i, (c, t, r) in enumerate(zip(code, y, x))]
    df = spark.createDataFrame(rows, "disease string, region string, date long, outbreak int, f0 double, f1 double, f2 double")
    return ML.prepare_training_frame(ENC.encode_rank(df, "disease"), "outbreak", KEYS), ["f0", "f1", "f2", "disease_encoded"]


def test_saved_scoring_of_raw_rows(spark):
    data, cols = _data(spark)
    spec = ML.ModelSpec("lr", "lr", {"C": 1.0, "maxIter": 50}, scaled=True)
    _r, model, preds = ML.train_one(spec, data, cols, cv_folds=0)
    path = tempfile.mkdtemp(prefix="episcope-scoring-")
    ML.save_scoring(ML.Scoring(model, [ENC.RankEncoder.fit(data, "disease")]), path)
    loaded = ML.load_scoring(spark, path)
    raw = data.where("is_test").drop("disease_encoded", "label", "outbreak")
    got = {r.date: r.probability for r in loaded.score(raw, KEYS).collect()}
    assert got == {r.date: r.probability for r in preds.collect()}
    with pytest.raises(Exception, match="has not seen"):
        loaded.score(raw.withColumn("disease", F.lit("mumps")), KEYS).collect()
    assert loaded.score(raw.withColumn("disease", F.lit("mumps")), KEYS, unseen=0).count() == len(got)


def _plain_platt(f, y):
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 0.0, np.log((n0 + 1) / (n1 + 1))
    for _ in range(20_000):                       # plain gradient descent
        p = 1 / (1 + np.exp(a * f + b))
        a, b = a - 0.5 * np.mean(f * (t - p)), b - 0.5 * np.mean(t - p)
    return a, b


def test_platt_scaling_equals_gradient_descent(spark):
    rng = np.random.default_rng(3)
    f = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-(2.5 * f - 0.7)))).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(f, y)], "margin double, label int")
    assert ML.platt(df) == pytest.approx(_plain_platt(f, y), abs=1e-3)
    apart = spark.createDataFrame([(float(i), int(i > 0)) for i in range(-20, 21)], "margin double, label int")
    a, b = ML.platt(apart)
    assert a < 0 and np.isfinite([a, b]).all()
    one = spark.createDataFrame([(1.0, 1), (2.0, 1)], "margin double, label int")
    assert np.isfinite(ML.platt(one)).all()


def test_calibrated_svm_has_the_lower_brier_score(spark):
    data, cols = _data(spark)
    spec = ML.TRAINER_MODELS[3]
    assert spec.calibrated
    _r, model, preds = ML.train_one(spec, data, cols, cv_folds=0)

    def brier(p):
        return p.agg(F.avg((F.col("actual") - F.col("probability")) ** 2)).first()[0]
    raw = ML.score(model.model, data.where("is_test"))
    assert brier(preds) < brier(raw)
    assert preds.where("(probability > 0.5) <> (predicted = 1)").count() == 0
    path = tempfile.mkdtemp(prefix="episcope-svm-")
    ML.save_pipeline(model, path)
    again = ML.score(ML.load_pipeline(path), data.where("is_test"))
    assert {r.date: r.probability for r in again.collect()} == {r.date: r.probability for r in preds.collect()}
