"""Grid search with nested evaluation: one fit answers many points of a grid.

A forest of 200 trees holds the forests of its first 50 and 100 trees, and a tree of depth 30 holds,
cut at depth 10 or 20, a tree that a fit of that depth could have grown (each cut is chosen from its
own node's rows alone).  So the grid trees x depth x least leaf costs one fit for each (leaf, fold):
that of the largest size and depth.  Boosted trees are nested in their number only; their other
points are models of one lockstep fit (:mod:`episcope.plans.boosting`).

All training rows take part.  Every point is scored on the rows of the fold that its fit did not
see; its value is the mean of the folds' exact AUCs.  The best point (ties: the smaller model, in grid
order) is fitted on all rows and returned.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episcope.operators.evaluation import roc_auc_by
from episcope.operators.sampling import fold_column
from episcope.plans import boosting
from episcope.session import cut_lineage, ensure_checkpoint_dir, ship_package

# The default grids.  No limit on the depth is depth 30, the deepest that MLlib grows.
FOREST_GRID = {"trees": (50, 100, 200), "depth": (10, 20, 30), "leaf": (1, 2, 4)}
BOOSTED_GRID = {"trees": (100, 200), "depth": (3, 6, 10), "rate": (0.01, 0.1, 0.2), "subsample": (0.8, 1.0)}


def points(grid: dict) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def _ranked(aucs: DataFrame, names: list[str]) -> list[dict]:
    """One dict a point: its parameters, mean and standard deviation over the folds; best first."""
    rows = aucs.groupBy(*names).agg(F.avg("auc").alias("cv_auc_mean"), F.stddev_pop("auc").alias("cv_auc_std"), F.count("auc").alias("folds")).collect()
    return sorted((r.asDict() for r in rows), key=lambda r: (-(r["cv_auc_mean"] if r["cv_auc_mean"] is not None else -1.0), *[r[n] for n in names]))


# ---------------------------------------------------------------- forests

def forest_arrays(spark, model, path: str) -> list[tuple]:
    """The model's trees as (feature, threshold, left, right, share of class 1) arrays, by way of its
    saved form, whose ``data`` table has one row a node with the class counts of its rows."""
    model.write().overwrite().save(path)
    n = F.col("nodeData")
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", n["id"].alias("id"), F.when(n["leftChild"] < 0, -1).otherwise(n["split"]["featureIndex"]).alias("feature"),
        F.coalesce(F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)), F.lit(0.0)).alias("threshold"), n["leftChild"].alias("left"),
        n["rightChild"].alias("right"), (n["impurityStats"][1] / (n["impurityStats"][0] + n["impurityStats"][1])).alias("share")).toArrow()
    tree, node = rows["treeID"].to_numpy(), rows["id"].to_numpy()
    order = np.lexsort((node, tree))
    cols = [rows[c].to_numpy()[order] for c in ("feature", "threshold", "left", "right", "share")]
    cuts = np.searchsorted(tree[order], np.arange(1, tree.max() + 1))
    return list(zip(*[np.split(c, cuts) for c in cols]))


def nested_shares(x: np.ndarray, forest: list[tuple], depths, sizes) -> dict[tuple[int, int], np.ndarray]:
    """(trees, depth) -> probability of class 1 for each row of ``x``, of the forest's first trees cut at
    that depth."""
    sums = {d: np.zeros(len(x)) for d in depths}
    out, every = {}, np.arange(len(x))
    for i, (feature, threshold, left, right, share) in enumerate(forest, 1):
        at = np.zeros(len(x), dtype=np.int64)
        for level in range(max(depths) + 1):
            if level in sums:
                sums[level] += share[at]
            rows = every[feature[at] >= 0]
            if not len(rows):
                for d in depths:
                    if d > level:
                        sums[d] += share[at]
                break
            node = at[rows]
            at[rows] = np.where(x[rows, feature[node]] <= threshold[node], left[node], right[node])
        if i in sizes:
            out.update({(i, d): sums[d] / i for d in depths})
    return out


def tune_forest(train: DataFrame, features: list[str], grid: dict | None = None, folds: int = 5, label: str = "label",
                row_id: str = "row_id", seed: int = 42, parallelism: int = 15):
    """(points best first, best parameters, model fitted on all rows with them)."""
    grid = {**FOREST_GRID, **(grid or {})}
    spark = train.sparkSession
    ship_package(spark)
    data = VectorAssembler(inputCols=list(features), outputCol="_vector", handleInvalid="keep") \
        .transform(fold_column(train, label, row_id, folds, seed)).select(*features, "_vector", F.col(label).cast("double").alias("_label"), "fold")
    data = cut_lineage(data, "forest-folds")
    root = ensure_checkpoint_dir(spark).rstrip("/")

    def fit(leaf: int, rows: DataFrame, trees: int, depth: int):
        # node ids are kept beside the rows: else each level sends the whole forest to the tasks and walks it from the root
        return RandomForestClassifier(featuresCol="_vector", labelCol="_label", seed=seed, numTrees=trees, maxDepth=depth,
                                      minInstancesPerNode=leaf, cacheNodeIds=True).fit(rows)

    def held_out(job):
        leaf, fold = job
        model = fit(leaf, data.filter(F.col("fold") != fold), max(grid["trees"]), max(grid["depth"]))
        return job, forest_arrays(spark, model, f"{root}/episcope-forest-{uuid.uuid4().hex}")

    jobs = list(product(grid["leaf"], range(folds)))
    with ThreadPoolExecutor(parallelism) as pool:
        forests = dict(pool.map(held_out, jobs))
    depths, sizes = sorted(grid["depth"]), set(grid["trees"])
    kind = pa.list_(pa.struct([("leaf", pa.int32()), ("trees", pa.int32()), ("depth", pa.int32()), ("score", pa.float64())]))

    def scored(fold: int):
        own = {leaf: forests[leaf, fold] for leaf in grid["leaf"]}

        def run(batches):
            for b in batches:
                x = np.stack([b.column(i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in range(len(features))], axis=1)
                found = {(leaf, *k): v for leaf, forest in own.items() for k, v in nested_shares(x, forest, depths, sizes).items()}
                rows = [[{"leaf": k[0], "trees": k[1], "depth": k[2], "score": float(v[i])} for k, v in found.items()] for i in range(b.num_rows)]
                yield pa.RecordBatch.from_arrays([b.column(len(features)), pa.array([fold] * b.num_rows, pa.int32()), pa.array(rows, kind)],
                                                 names=["label", "fold", "scores"])
        return data.filter(F.col("fold") == fold).select(*features, F.col("_label").alias("label")) \
            .mapInArrow(run, "label double, fold int, scores array<struct<leaf:int,trees:int,depth:int,score:double>>")

    scores = scored(0)
    for fold in range(1, folds):
        scores = scores.unionByName(scored(fold))
    scores = cut_lineage(scores.select("label", "fold", F.inline("scores")), "forest-scores")
    names = ["trees", "depth", "leaf"]
    ranked = _ranked(roc_auc_by(scores, [*names, "fold"]), names)
    best = {n: ranked[0][n] for n in names}
    return ranked, best, fit(best["leaf"], data, best["trees"], best["depth"])


# ---------------------------------------------------------------- boosted trees

def tune_boosted(train: DataFrame, features: list[str], grid: dict | None = None, folds: int = 5, label: str = "label",
                 row_id: str = "row_id", seed: int = 42):
    """(points best first, best parameters, model fitted on all rows with them).  Each point without
    its number of trees is one model a fold and one on all rows, all in one lockstep fit."""
    grid = {**BOOSTED_GRID, **(grid or {})}
    stages = sorted(grid["trees"])
    data = cut_lineage(fold_column(train, label, row_id, folds, seed), "boosted-folds")
    rest = points({k: v for k, v in grid.items() if k != "trees"})
    specs = [boosting.BoostSpec(str(i), stages[-1], p["depth"], p["rate"], subsample=p["subsample"], leave_out=fold, seed=seed)
             for i, p in enumerate(rest) for fold in (*range(folds), None)]
    models, held = boosting.fit(data, list(features), specs, label=label, part="fold", keys=[row_id], stages=stages)
    point = F.create_map(*[F.lit(x) for i, m in enumerate(models) for x in (i, int(m.spec.name))])[F.col("model")]
    scored = held.withColumn("point", point)
    ranked = [{**{"trees": r["trees"]}, **rest[r["point"]], **{k: r[k] for k in ("cv_auc_mean", "cv_auc_std", "folds")}}
              for r in _ranked(roc_auc_by(scored, ["trees", "point", "fold"], score="probability"), ["trees", "point"])]
    best = {k: ranked[0][k] for k in ("trees", *rest[0])}
    whole = next(m for m in models if m.spec.leave_out is None and rest[int(m.spec.name)] == {k: best[k] for k in rest[0]})
    whole.trees = whole.trees[:best["trees"]]
    return ranked, best, whole
