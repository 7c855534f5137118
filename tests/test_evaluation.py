"""Evaluation operators against brute-force computations."""

import numpy as np
from pyspark.sql import functions as F

from episcope.operators import aggregates as A
from episcope.operators import evaluation as E
from episcope.operators import sampling as S


def _scores(spark, n=600, seed=3):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    s = np.round(rng.random(n) * 0.5 + y * 0.3, 2)  # tie-heavy
    return y, s, spark.createDataFrame([(int(a), float(b), int(b > 0.5)) for a, b in zip(y, s)],
                                       "label int, score double, prediction int")


def _brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


def test_roc_auc_exact(spark):
    y, s, df = _scores(spark)
    assert abs(E.roc_auc(df).first().auc - _brute_auc(y, s)) < 1e-12


def test_roc_curve_endpoints(spark):
    y, s, df = _scores(spark)
    pts = E.roc_curve(df).orderBy(F.col("threshold").desc()).collect()
    assert len(pts) == len(set(s.tolist()))
    assert abs(pts[-1].fpr - 1.0) < 1e-12 and abs(pts[-1].tpr - 1.0) < 1e-12


def test_confusion_and_report(spark):
    y, s, df = _scores(spark)
    p = (s > 0.5).astype(int)
    c = E.confusion_counts(df).first()
    assert c.tp == int(((y == 1) & (p == 1)).sum()) and c.fn == int(((y == 1) & (p == 0)).sum())
    rep = {r["class"]: r for r in E.classification_report(df).collect()}
    prec1 = c.tp / (c.tp + c.fp) if c.tp + c.fp else 0.0
    assert abs(rep["1"].precision - prec1) < 1e-12
    assert rep["accuracy"].support == len(y)


def test_cost_benefit_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int")
    r = E.cost_benefit(df).first()
    assert r.response_cost == 0 and r.roi_pct == 0.0 and r.missed_cost == 500000
    assert E.detection_impact(df).first().detection_rate == 0.0


def test_stratified_split_sizes(spark):
    rng = np.random.default_rng(0)
    n1 = 848
    rows = [(i, 1 if i < n1 else 0) for i in range(4000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, label int")
    out = S.stratified_split(df, "label", "id", 0.2, 42)
    cnt = {(r.label, r.is_test): r["count"] for r in out.groupBy("label", "is_test").count().collect()}
    assert cnt[(1, True)] == 170 and cnt[(0, True)] == 630
    assert cnt[(1, False)] == 678 and cnt[(0, False)] == 2522


def test_histogram_counts(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=600)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = {r.bin: r["count"] for r in A.histogram(df, "x", 20).collect()}
    exp, _ = np.histogram(x, bins=20)
    assert sum(got.values()) == 600
    assert [got.get(i + 1, 0) for i in range(20)] == exp.tolist()


def test_correlation_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.1, 2.0), (2.0, 0.1, 4.1), (3.0, 0.1, 5.9)], "a double, b double, c double")
    m = {(r.a, r.b): r.r for r in A.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert m[("a", "b")] is None
    assert abs(m[("a", "c")] - np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1]) < 1e-12
