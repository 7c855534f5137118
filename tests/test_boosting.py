"""Histogram boosting and nested grid search against plain computations."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from episcope.operators import evaluation as E
from episcope.plans import boosting as B
from episcope.plans import training as ML
from episcope.plans import tuning as TU

COLS = [f"f{i}" for i in range(4)]


def _rows(n=600, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 1)
    y = (x[:, 0] * x[:, 1] + x[:, 2] + rng.normal(scale=0.3, size=n) > 0.3).astype(float)
    x[rng.random((n, 4)) < 0.05] = np.nan
    return x, y


def _frame(spark, x, y):
    rows = [(i, float(t), i % 3, *[None if np.isnan(v) and i % 2 else float(v) for v in r]) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id long, label double, fold int, " + ", ".join(f"{c} double" for c in COLS)).repartition(4)


def _plain_tree(codes, g, h, rows, depth, l2, min_child):
    """Nested (feature, cut, left, right) or leaf value, by trying every cut."""
    G, H = g[rows].sum(), h[rows].sum()
    best = (B.LEAST_GAIN, None)
    if depth:
        for f in range(len(codes)):
            for c in range(int(codes.max()) + 1):
                left = rows[codes[f, rows] <= c]
                right = rows[codes[f, rows] > c]
                a, b = h[left].sum(), h[right].sum()
                if len(left) and len(right) and a >= min_child and b >= min_child:
                    gain = g[left].sum() ** 2 / (a + l2) + g[right].sum() ** 2 / (b + l2) - G ** 2 / (H + l2)
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, c, left, right))
    if best[1] is None:
        return -G / (H + l2)
    f, c, left, right = best[1]
    return (f, c, *[_plain_tree(codes, g, h, r, depth - 1, l2, min_child) for r in (left, right)])


def _nested(t, node=0):
    if t.feature[node] < 0:
        return t.value[node]
    return (t.feature[node], t.cut[node], _nested(t, t.left[node]), _nested(t, t.right[node]))


def _same(a, b):
    if isinstance(a, tuple):
        assert isinstance(b, tuple) and a[:2] == b[:2], (a, b)
        _same(a[2], b[2])
        _same(a[3], b[3])
    else:
        assert a == pytest.approx(b, abs=1e-9)


def test_grown_tree_equals_plain_search():
    rng = np.random.default_rng(1)
    for t in range(20):
        codes = rng.integers(0, 6, (3, 80)).astype(np.uint8)
        g, h = rng.normal(size=80), rng.random(80) + 0.05
        got = B.grow(codes, g, h, 4, 8, 1.0, 0.5)
        _same(_nested(got), _plain_tree(codes, g, h, np.arange(80), 4, 1.0, 0.5))


def _plain_boosting(x, y, edges, spec, train):
    codes = np.stack([np.where(np.isnan(x[:, f]), len(edges[f]) + 1, np.searchsorted(edges[f], x[:, f], side="left")) for f in range(x.shape[1])])
    share = y[train].mean()
    margin = np.full(len(y), np.log(share / (1 - share)))

    def value(tree, i):
        while isinstance(tree, tuple):
            tree = tree[2] if codes[tree[0], i] <= tree[1] else tree[3]
        return tree
    for _ in range(spec.trees):
        p = 1 / (1 + np.exp(-margin))
        tree = _plain_tree(codes, p - y, p * (1 - p), train, spec.depth, spec.l2, spec.min_child)
        margin = margin + spec.rate * np.array([value(tree, i) for i in range(len(y))])
    return 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("local_rows,kept,slots", [(10_000, 1024, 512), (60, 1024, 512), (60, 0, 1), (0, 1024, 3)])
def test_lockstep_models_equal_plain_boosting(spark, monkeypatch, local_rows, kept, slots):
    """Subtrees in one task, or every level by sums over all tasks, with and without subtraction: the same models."""
    monkeypatch.setattr(B, "KEPT", kept)
    monkeypatch.setattr(B, "SLOTS", slots)
    monkeypatch.setattr(B, "BLOCK_ROWS", 64)
    monkeypatch.setattr(B, "REBASE", 2)
    x, y = _rows(300)
    df = _frame(spark, x, y)
    specs = [B.BoostSpec("all", 3, 3, 0.3), B.BoostSpec("fold", 2, 2, 0.5, leave_out=1)]
    models, held = B.fit(df, COLS, specs, part="fold", keys=["row_id"], bins=6, local_rows=local_rows, stages=[2])
    for m, train in zip(models, (np.arange(300), np.flatnonzero(np.arange(300) % 3 != 1))):
        want = _plain_boosting(x, y, m.edges, m.spec, train)
        got = {r["row_id"]: r["p"] for r in B.probability(df, m, "p").collect()}
        assert [got[i] for i in range(300)] == pytest.approx(want.tolist(), abs=1e-9)
    left_out = sorted(r["probability"] for r in held.collect())
    assert left_out == pytest.approx(sorted(want[i] for i in range(300) if i % 3 == 1), abs=1e-9)
    assert {(r["model"], r["trees"], r["fold"]) for r in held.collect()} == {(1, 2, 1)}


def test_edge_tables(spark):
    x, y = _rows(40)
    one = _frame(spark, x, np.ones(40))
    (m,), _ = B.fit(one, COLS, [B.BoostSpec("one", 3, 2)])
    assert m.trees == [] and B.probability(one, m).agg(F.min("probability")).first()[0] > 0.99
    (m,), held = B.fit(one.filter("label < 0"), COLS, [B.BoostSpec("none", 3, 2)])
    assert m.trees == [] and held is None and B.probability(one.filter("label < 0"), m).count() == 0
    nulls = _frame(spark, np.full((40, 4), np.nan), y)
    (m,), _ = B.fit(nulls, COLS, [B.BoostSpec("nulls", 2, 2)])
    assert sum(m.importance().values()) == 0
    clash = _frame(spark, x, y).withColumn("probability", F.lit("clash"))
    (m,), _ = B.fit(clash, COLS, [B.BoostSpec("x", 2, 2)])
    assert B.probability(clash, m).count() == 40


def test_subsample_depends_on_the_row_only(spark):
    x, y = _rows()
    spec = [B.BoostSpec("half", 3, 3, subsample=0.5)]
    (a,), _ = B.fit(_frame(spark, x, y), COLS, spec, keys=["row_id"])
    (b,), _ = B.fit(_frame(spark, x, y).repartition(7, "f0"), COLS, spec, keys=["row_id"])
    for s, t in zip(a.trees, b.trees):
        assert (s.feature == t.feature).all() and s.value == pytest.approx(t.value)
    share = B._uniform(np.arange(20_000), 42) < 0.5
    assert 0.48 < share.mean() < 0.52 and (share != (B._uniform(np.arange(20_000), 43) < 0.5)).any()


def test_saved_model_scores_alike(spark):
    x, y = _rows()
    df = _frame(spark, x, y)
    (m,), _ = B.fit(df, COLS, [B.BoostSpec("x", 4, 3)])
    path = tempfile.mkdtemp(prefix="episcope-boosted-")
    ML.save_pipeline(m, path)
    again = ML.load_pipeline(path)
    a, b = ({r["row_id"]: r["probability"] for r in B.probability(df, z).collect()} for z in (m, again))
    assert a == b and again.spec == m.spec and again.importance() == m.importance()


def _prepared(spark, n=900):
    x, y = _rows(n)
    df = _frame(spark, x, y).na.fill(0.0).withColumn("disease", F.lit("d")).withColumn("region", F.lit("r")) \
        .withColumnRenamed("row_id", "date").withColumn("outbreak", F.col("label").cast("int")).drop("label", "fold")
    return ML.prepare_training_frame(df, "outbreak", ("disease", "region", "date"))


def test_train_one_with_cross_validation(spark):
    data = _prepared(spark)
    r, model, preds = ML.train_one(ML.ModelSpec("boosted", "hist", {"trees": 12, "depth": 4, "rate": 0.3}), data, COLS, cv_folds=3, cv_rows=500)
    assert r["auc"] == pytest.approx(E.roc_auc(preds, "actual", "probability").first()["auc"])
    assert r["auc"] > 0.9 and r["cv_auc_mean"] > 0.85 and len(model.trees) == 12
    assert preds.where("probability < 0 or probability > 1 or (probability > 0.5) <> (predicted = 1)").count() == 0
    assert preds.count() == data.where("is_test").count()
    imp = {x.feature: x.importance for x in ML.feature_importance(spark, model, COLS).collect()}
    assert sum(imp.values()) == pytest.approx(1) and imp["f3"] < min(imp["f0"], imp["f1"], imp["f2"])


def test_boosted_grid(spark):
    train = _prepared(spark, 400).where("not is_test")
    ranked, best, model = TU.tune_boosted(train, COLS, {"trees": (2, 5), "depth": (1, 3), "rate": (0.3,), "subsample": (0.8, 1.0)}, folds=3)
    assert len(ranked) == 8 and all(r["folds"] == 3 for r in ranked)
    assert [r["cv_auc_mean"] for r in ranked] == sorted((r["cv_auc_mean"] for r in ranked), reverse=True)
    assert best == {k: ranked[0][k] for k in ("trees", "depth", "rate", "subsample")}
    assert (len(model.trees), model.spec.depth, model.spec.subsample, model.spec.leave_out) == (best["trees"], best["depth"], best["subsample"], None)
    # one point computed alone
    p = ranked[-1]
    data = TU.fold_column(train, "label", "row_id", 3, 42)
    specs = [B.BoostSpec("p", p["trees"], p["depth"], p["rate"], subsample=p["subsample"], leave_out=k) for k in range(3)]
    _models, held = B.fit(data, COLS, specs, part="fold", keys=["row_id"], stages=[p["trees"]])
    alone = [E.roc_auc(held.where(F.col("fold") == k), "label", "probability").first()["auc"] for k in range(3)]
    assert np.mean(alone) == pytest.approx(p["cv_auc_mean"]) and np.std(alone) == pytest.approx(p["cv_auc_std"])


def test_forest_grid_and_nested_forests(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    data = _prepared(spark, 400)
    v = VectorAssembler(inputCols=COLS, outputCol="v").transform(data)
    model = RandomForestClassifier(featuresCol="v", labelCol="label", numTrees=7, maxDepth=6, seed=1).fit(v)
    got = model.transform(v).select(*COLS, vector_to_array("probability")[1].alias("p")).toPandas()
    forest = TU.forest_arrays(spark, model, tempfile.mkdtemp(prefix="episcope-forest-"))
    shares = TU.nested_shares(got[COLS].to_numpy(), forest, [0, 2, 6], {3, 7})
    assert shares[7, 6] == pytest.approx(got["p"].to_numpy()) and set(shares) == {(s, d) for s in (3, 7) for d in (0, 2, 6)}
    assert len(set(shares[7, 0].round(12))) == 1                  # cut at the root: one value for all rows
    ranked, best, tuned = TU.tune_forest(data.where("not is_test"), COLS, {"trees": (3, 6), "depth": (2, 5), "leaf": (1, 4)}, folds=3)
    assert len(ranked) == 8 and ranked[0]["cv_auc_mean"] > 0.8
    assert (tuned.getNumTrees, tuned.getMaxDepth(), tuned.getMinInstancesPerNode()) == (best["trees"], best["depth"], best["leaf"])


def test_auc_of_groups(spark):
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(4)), int(rng.integers(2)), float(rng.integers(8)) / 8) for _ in range(500)] + [(9, 1, 0.5), (9, None, 0.1), (2, 1, None)]
    df = spark.createDataFrame(rows, "g int, label int, score double")
    got = {r["g"]: r["auc"] for r in E.roc_auc_by(df, "g").collect()}
    for g in range(4):
        assert got[g] == pytest.approx(E.roc_auc(df.where((F.col("g") == g) & F.col("score").isNotNull())).first()["auc"])
    assert got[9] is None


def test_jobs_of_small_models_do_not_grow_with_their_trees(spark):
    x, y = _rows(200)
    df = _frame(spark, x, y)
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for trees in (2, 25):
        group = f"boost-{trees}"
        spark.sparkContext.setJobGroup(group, "")
        specs = [B.BoostSpec("all", trees, 2), B.BoostSpec("fold", trees, 3, subsample=0.7, leave_out=0)]
        models, held = B.fit(df, COLS, specs, part="fold", keys=["row_id"], stages=[1, trees])
        jobs.append(len(tracker.getJobIdsForGroup(group)))
        assert [len(m.trees) for m in models] == [trees, trees] and held.where(F.col("trees") == trees).count() == 67
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_grid_forests_keep_their_node_ids(spark):
    _ranked, _best, tuned = TU.tune_forest(_prepared(spark, 200).where("not is_test"), COLS, {"trees": (2,), "depth": (2,), "leaf": (1,)}, folds=2)
    assert tuned.getCacheNodeIds()
