"""The nested analysis report: data set, features, best model and its impact in one JSON row.

Every section is an aggregate of one row (or the rows of a few models), so the report is made of cross
products of single rows and written by one task whatever the size of the tables below it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episcope.operators import aggregates as A
from episcope.operators import evaluation as E


def dataset_section(surv: DataFrame, social: DataFrame, env: DataFrame) -> DataFrame:
    """One row, column ``dataset_summary``: sizes of the sources, date range, outbreak statistics."""
    s = A.report_dataset_summary(surv)
    sizes = social.agg(F.count(F.lit(1)).alias("posts")).crossJoin(env.agg(F.count(F.lit(1)).alias("readings")))
    return s.crossJoin(sizes).select(F.struct(
        F.col("total_records").alias("surveillance_records"), F.col("posts").alias("social_media_posts"),
        F.col("readings").alias("environmental_records"), F.col("countries").alias("countries_covered"),
        F.struct(F.col("start_date").alias("start"), F.col("end_date").alias("end"),
                 F.col("span_years").alias("years_span")).alias("date_range"),
        F.struct("total_outbreaks", "outbreak_rate", "countries_with_outbreaks").alias("outbreak_statistics"),
    ).alias("dataset_summary"))


def feature_section(features: DataFrame, names) -> DataFrame:
    """One row, column ``feature_engineering``.  ``memory_usage_mb`` is the size of the matrix as doubles."""
    names = list(names)
    n = F.count(F.lit(1))
    return features.agg(F.struct(
        F.lit(len(names)).cast("long").alias("total_features"),
        F.array(*map(F.lit, names)).cast("array<string>").alias("feature_names"),
        F.array(n, F.lit(len(names)).cast("long")).alias("dataset_shape"),
        (F.floor(n * (len(names) * 8 * 100) / 2 ** 20 + 0.5) / 100).alias("memory_usage_mb")).alias("feature_engineering"))


def model_section(perf: DataFrame, predictions: dict[str, DataFrame], metric: str = "auc") -> DataFrame:
    """One row, column ``best_model_results``: the model of largest ``metric`` (ties: by name), its metrics and
    what its predictions (``actual``, ``predicted``) would have found."""
    best = perf.orderBy(F.col(metric).desc_nulls_last(), "model").first()
    impact = E.detection_impact(predictions[best["model"]], "actual", "predicted")
    value = lambda c: F.lit(best[c]).cast("double").alias("training_time_seconds" if c == "training_time" else c)
    return impact.select(F.struct(
        F.lit(best["model"]).alias("model_name"),
        F.struct(*map(value, ("auc", "accuracy", "cv_auc_mean", "cv_auc_std", "training_time"))).alias("performance_metrics"),
        F.struct("test_outbreaks", "correctly_predicted", "missed_outbreaks", "detection_rate").alias("real_world_impact"),
    ).alias("best_model_results"))


def analysis_report(surv: DataFrame, social: DataFrame, env: DataFrame, features: DataFrame, names, perf: DataFrame,
                    predictions: dict[str, DataFrame], sources, sample_size: int | None = None) -> DataFrame:
    """The whole report, one nested row.  ``sources`` names the data sources; ``sample_size`` is None without sampling."""
    spark, models = surv.sparkSession, [r["model"] for r in perf.select("model").collect()]
    info = spark.range(1).select(F.struct(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")).alias("analysis_info"))
    technical = spark.range(1).select(F.struct(
        F.lit(sample_size).cast("long").alias("sample_size"), F.array(*map(F.lit, models)).alias("models_trained"),
        F.array(*map(F.lit, sources)).alias("data_sources")).alias("technical_specifications"))
    return info.crossJoin(dataset_section(surv, social, env)).crossJoin(feature_section(features, names)) \
        .crossJoin(model_section(perf, predictions)).crossJoin(technical)
