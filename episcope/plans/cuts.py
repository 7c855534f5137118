"""Candidate cuts of tree learners from all rows.

MLlib's forests and boosted trees read the candidate cuts of the features from a random sample of
max(maxBins ** 2, 10,000) rows.  Here the same rule (steps of equal weight over the distinct values) reads every
row: one aggregation to distinct values, running totals over range buckets, and at most a few ``maxBins`` rows a
feature on the driver.  :class:`TreePipeline` bins the features by these cuts before the learner sees them, and gives the
learner so large a ``maxBins`` that it draws no sample of the bins.
"""

from __future__ import annotations

from math import ceil, inf, isfinite, nextafter, sqrt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episcope.operators.ordering import running_totals
from episcope.session import cut_lineage, drop_table

SAMPLED_FROM = 10_000     # rows up to which MLlib reads all of them itself (or maxBins ** 2, if that is more)


def cut_places(firsts: list[tuple[int, int]], distinct: int, bins: int) -> list[int]:
    """Places (0-based, among ``distinct`` ascending values) of the values that begin a new bin.  ``firsts``: (number
    of steps passed, first place where that many are).  A value that takes several steps delays the later cuts."""
    if distinct <= bins:
        return list(range(1, distinct))
    out, last = [], 0
    for step in range(1, bins):
        reached = [at for steps, at in firsts if steps >= step]
        last = max(last + 1, min(reached, default=distinct))
        if last >= distinct:
            break
        out.append(last)
    return out


def candidate_cuts(df: DataFrame, features: list[str], bins: int = 32, weight: str | None = None) -> list[list[float]]:
    """Ascending cuts (at most ``bins - 1``) of each feature; a value up to a cut lies left of it.  Missing values
    (null or NaN) count nowhere.  A cut is midway between two values next to each other; the k-th is where the weight
    up to there is nearest to k steps of 1 / ``bins`` of the whole weight."""
    spark = df.sparkSession
    values = F.array(*[F.col(f).cast("double") for f in features])
    long = df.select((F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"), F.posexplode(values).alias("feature", "value"))
    table = cut_lineage(long.where(~F.isnan("value") & F.col("value").isNotNull()).groupBy("feature", "value")
                        .agg(F.sum("w").alias("w"), F.lit(1).cast("long").alias("place")), "values")
    sizes = {r["feature"]: r for r in table.groupBy("feature").agg(F.sum("w").alias("w"), F.sum("place").alias("n")).collect()}
    steps = F.array(*[F.lit(2.0 * sizes[i]["w"] / bins if i in sizes else 1.0) for i in range(len(features))])
    run = running_totals(table, ["value"], ["w", "place"], series=["feature"], stable=True)
    # twice the weight midway through the value, in double steps; a step is passed where that is more
    passed = F.ceil((2 * F.col("w_cum") - F.col("w")) / F.get(steps, F.col("feature"))) - 1
    ranked = cut_lineage(run.select("feature", "value", (F.col("place_cum") - 1).alias("place"), passed.alias("passed")), "ranked-values")
    firsts: dict[int, list] = {}
    for r in ranked.groupBy("feature", F.least("passed", F.lit(bins - 1)).alias("passed")).agg(F.min("place").alias("place")).collect():
        firsts.setdefault(r["feature"], []).append((r["passed"], r["place"]))
    places = {i: cut_places(firsts[i], s["n"], bins) for i, s in sizes.items()}
    wanted = sorted({(i, p) for i, at in places.items() for q in at for p in (q - 1, q)})
    at = {}
    if wanted:
        few = spark.createDataFrame(wanted, "feature int, place long")
        at = {(r["feature"], r["place"]): r["value"] for r in ranked.join(F.broadcast(few), ["feature", "place"]).collect()}
    drop_table(spark, table)
    drop_table(spark, ranked)
    cuts = [[(at[i, p - 1] + at[i, p]) / 2 for p in places.get(i, [])] for i in range(len(features))]
    return [sorted({c for c in found if isfinite(c)}) for found in cuts]


class TreePipeline(Pipeline):
    """Assembler (and scaler, selector) and a tree learner whose candidate cuts come from all rows, however many."""

    def _fit(self, dataset):
        *front, learner = self.getStages()
        bins, rows = learner.getMaxBins(), dataset.count()
        if rows <= max(bins * bins, SAMPLED_FROM):
            return super()._fit(dataset)
        before = Pipeline(stages=front)._fit(dataset)
        features = front[0].getInputCols()
        for stage in before.stages:
            if hasattr(stage, "selectedFeatures"):
                features = [features[i] for i in stage.selectedFeatures]
        cuts = candidate_cuts(dataset, features, bins, learner.getWeightCol() if learner.isSet("weightCol") else None)
        # a bucket is closed below, a cut above: the bucket begins at the next number; one without cuts needs two buckets, too
        splits = [[-inf, *[nextafter(c, inf) for c in found or [0.0]], inf] for found in cuts]
        names = [f"_bucket_of_{f}" for f in features]
        bucketizer = Bucketizer(inputCols=features, outputCols=names, splitsArray=splits, handleInvalid="keep")
        # missing values have the last bucket; as expressions the numbers do not count as categories
        numbers = ", ".join(f"coalesce({_quoted(n)}, {len(s) - 1}D) AS {_quoted(f'_bin_of_{f}')}" for n, s, f in zip(names, splits, features))
        numbered = SQLTransformer(statement=f"SELECT *, {numbers} FROM __THIS__")
        binned = VectorAssembler(inputCols=[f"_bin_of_{f}" for f in features], outputCol="binned_features")
        unsampled = {learner.featuresCol: "binned_features", learner.maxBins: max(bins + 2, ceil(sqrt(rows)))}
        codes = PipelineModel([bucketizer, numbered, binned])
        model = learner.copy(unsampled).fit(codes.transform(dataset))
        return PipelineModel([*before.stages, *codes.stages, model])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
