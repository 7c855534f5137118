"""Negation and intensifiers, thinned ROC points, F statistics, the nested report: against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from episcope.operators import aggregates as A
from episcope.operators import evaluation as E
from episcope.operators import sentiment as S
from episcope.plans import report as R
from episcope.sources import files as IO
from episcope.sources import landed


def _walk(text, lex, negators, boosts):
    """Token by token: tokens left under a negator, the factor of the token just before."""
    left, factor, p, s = 0, 1.0, [], []
    for t in re.findall(r"\w+|[.!?;\n]", re.sub("n['’]t", "nt", (text or "").lower())):
        if t in lex:
            p.append(max(-1.0, min(1.0, lex[t][0] * factor * (-0.5 if left > 0 else 1.0))))
            s.append(min(1.0, lex[t][1] * factor))
            left, factor = 0, 1.0
        elif t in ".!?;\n":
            left, factor = 0, 1.0
        else:
            left = 3 if t in negators else left - 1
            factor = boosts.get(t, 1.0)
    return (sum(p) / len(p), sum(s) / len(s)) if p else (0.0, 0.0)


def test_modifiers_equal_a_token_walk(spark):
    rng = random.Random(5)
    parts = ["good", "bad", "not", "never", "very", "slightly", "x", "was", "isn't", "don’t", "no", "fine", "goodness", "é"]
    gaps = [" ", " ", " ", ", ", ". ", "\n", "; ", " - ", "!"]
    texts = ["".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randint(0, 25))) for _ in range(600)]
    texts += [None, "", "not " * 50 + "good", "not good", "NOT very good", "x " * 20_000 + "not good", "very very good"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: (r["polarity"], r["subjectivity"]) for r in S.modified_sentiment(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(_walk(t, S.LEXICON, S.NEGATORS, S.INTENSIFIERS)), repr(t)[:200]
    assert got[len(texts) - 4][0] < 0 and got[len(texts) - 3][0] < 0


def test_without_modifiers_it_is_the_plain_lexicon_also_as_a_table(spark):
    df = spark.createDataFrame([(1, "not very good"), (2, None), (3, "bad, worse; FINE"), (4, "nothing")], "id long, text string")
    plain = sorted(map(tuple, S.lexicon_sentiment(df).collect()))
    assert sorted(map(tuple, S.modified_sentiment(df, negators=(), intensifiers={}).collect())) == plain
    lex = spark.createDataFrame([(k, *v) for k, v in S.LEXICON.items()], "word string, polarity double, subjectivity double")
    table = sorted(map(tuple, S.lexicon_sentiment(df, lexicon=lex, key="id").select("id", "text", "polarity", "subjectivity").collect()))
    assert [r[:2] for r in table] == [r[:2] for r in plain]
    assert np.allclose([r[2:] for r in table], [r[2:] for r in plain])


@pytest.mark.parametrize("levels", [1, 2, 9, 400])
def test_thinned_roc(spark, levels):
    rng = random.Random(levels)
    rows = [(rng.randrange(levels) / levels, rng.randint(0, 1)) for _ in range(700)] + [(0.5, 1), (0.5, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    scores = sorted({s for s, _ in rows}, reverse=True)
    step = {s: (sum(y for t, y in rows if t == s), sum(1 - y for t, y in rows if t == s)) for s in scores}
    p, n, tp, fp = sum(y for _, y in rows), sum(1 - y for _, y in rows), 0, 0
    want = [(float("inf"), 0.0, 0.0)]
    for i, s in enumerate(scores):
        tp, fp = tp + step[s][0], fp + step[s][1]
        if i in (0, len(scores) - 1) or step[s] != step[scores[i + 1]]:
            want.append((s, fp / n, tp / p))
    got = sorted(map(tuple, E.roc_curve(df, thin=True, bucket_rows=16).collect()), reverse=True)
    assert got == want
    x = [(a[1], a[2]) for a in got]
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(x, x[1:]))
    assert area == pytest.approx(E.roc_auc(df).first()["auc"])


def test_anova_f(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 3, 500)
    a, b = rng.normal(y, 2.0), rng.normal(0, 1, 500)
    rows = [(int(c), float(u), None if i % 5 == 0 else float(v), 1.0) for i, (c, u, v) in enumerate(zip(y, a, b))] + [(None, 9.0, 9.0, 9.0)]
    got = {r["feature"]: r["f_value"] for r in A.anova_f(spark.createDataFrame(rows, "y int, a double, b double, c double"), "y", ["a", "b", "c"]).collect()}

    def f_of(x, g):
        groups = [x[g == k] for k in np.unique(g)]
        between = sum(len(q) * (q.mean() - x.mean()) ** 2 for q in groups) / (len(groups) - 1)
        return between / (sum(((q - q.mean()) ** 2).sum() for q in groups) / (len(x) - len(groups)))
    keep = np.arange(500) % 5 != 0
    assert got["a"] == pytest.approx(f_of(a, y)) and got["b"] == pytest.approx(f_of(b[keep], y[keep]))
    assert got["c"] is None


def test_report_sections(spark, tmp_path):
    surv = spark.createDataFrame([("a", "2020-01-01", 1), ("b", "2022-01-01", 0), ("b", "2022-01-08", 0)], "region string, date string, outbreak int") \
        .withColumn("date", F.to_date("date"))
    feats = spark.range(4).selectExpr("id * 1.0 as x", "id * 2.0 as y")
    perf = spark.createDataFrame([("m1", 0.7, 0.6, None, None, 1.0), ("m2", 0.9, 0.8, 0.85, 0.01, 2.0)],
                                 "model string, auc double, accuracy double, cv_auc_mean double, cv_auc_std double, training_time double")
    preds = spark.createDataFrame([(1, 1), (1, 0), (0, 0)], "actual int, predicted int")
    rep = R.analysis_report(surv, spark.range(5), spark.range(0), feats, ["x", "y"], perf, {"m2": preds}, ["s"], None)
    IO.write_report(rep, str(tmp_path / "r"))
    r = spark.read.schema(rep.schema).json(str(tmp_path / "r")).first().asDict(recursive=True)
    d, m = r["dataset_summary"], r["best_model_results"]
    assert (d["surveillance_records"], d["social_media_posts"], d["environmental_records"], d["countries_covered"]) == (3, 5, 0, 2)
    assert str(d["date_range"]["end"]) == "2022-01-08" and d["date_range"]["years_span"] == 2.0
    assert d["outbreak_statistics"]["countries_with_outbreaks"] == 1
    assert r["feature_engineering"]["dataset_shape"] == [4, 2] and r["feature_engineering"]["feature_names"] == ["x", "y"]
    assert m["model_name"] == "m2" and m["performance_metrics"]["cv_auc_std"] == 0.01
    assert m["real_world_impact"] == {"test_outbreaks": 2, "correctly_predicted": 1, "missed_outbreaks": 1, "detection_rate": 0.5}
    assert r["technical_specifications"]["sample_size"] is None
    assert r["technical_specifications"]["models_trained"] == ["m1", "m2"]


def test_top_k_is_limited_before_the_shuffle(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    top = landed.top_k_per_group(df, "g", [F.col("id").desc()], 2)
    assert sorted((r["g"], r["id"]) for r in top.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    top.explain("formatted")
    plan = capsys.readouterr().out
    assert plan.index("Final") < plan.index("Exchange") < plan.index("WindowGroupLimit", plan.index("Exchange"))
    assert "Partial" in plan
