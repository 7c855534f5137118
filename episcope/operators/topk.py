"""Sort / limit / top-k.  A limit only appears where the report is a top-k.

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps its own
k best rows and only k rows per task reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episcope.operators.aggregates import group_rates, seasonal_outbreaks, yearly_outbreaks
from episcope.operators.filters import filter_min_support


def top_outbreak_regions(surv: DataFrame, region: str = "region", k: int = 5,
                         min_count: int = 10) -> DataFrame:
    """Regions with at least ``min_count`` rows, highest outbreak rate first (ties by name)."""
    r = filter_min_support(group_rates(surv, region), "count", min_count)
    return r.orderBy(F.col("mean").desc(), F.col(region)).limit(k)


def peak_months(df: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` calendar months with the highest outbreak rate (ties by month)."""
    m = seasonal_outbreaks(df).withColumn("month_name", F.date_format(
        F.make_date(F.lit(2000), F.col("month"), F.lit(1)), "MMM"))
    return m.orderBy(F.col("mean").desc(), F.col("month")).limit(k)


def recent_years(df: DataFrame, k: int = 5) -> DataFrame:
    """The last ``k`` years with their outbreak count / sum / mean."""
    return yearly_outbreaks(df).orderBy(F.col("year").desc()).limit(k)


def top_counts(counts: DataFrame, key: str, k: int = 10, count_col: str = "count") -> DataFrame:
    """Most frequent values; ties resolved alphabetically (documented rule)."""
    return counts.orderBy(F.col(count_col).desc(), F.col(key)).limit(k)


def top_features(importance: DataFrame, k: int = 15) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)


def best_model(perf: DataFrame, metric: str = "auc") -> DataFrame:
    """Name and score of the model with the highest ``metric``."""
    return perf.agg(F.max_by("model", metric).alias("best_model"), F.max(metric).alias(metric))


def limit_rows(df: DataFrame, order, n: int) -> DataFrame:
    """First ``n`` rows of a total order (a cap is the feature here, e.g. max_results)."""
    return df.orderBy(*order).limit(n)


def sort_series(df: DataFrame, series=("disease",), order=("date",)) -> DataFrame:
    """Final presentation sort (only for reports; operators never rely on it)."""
    return df.orderBy(*series, *order)
