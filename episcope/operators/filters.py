"""Projections, filters and NULL handling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episcope.functions.numeric import to_numeric_or_zero
from episcope.functions.text import contains_any
from episcope.operators.ordering import _names

# Columns the feature matrix never contains.
FEATURE_EXCLUDE = [
    "date", "disease", "outbreak", "cases", "deaths", "hospitalizations",
    "outbreak_threshold", "data_quality", "source_x", "source_y", "region",
]
# Exclusions of the daily pipeline.
DAILY_FEATURE_EXCLUDE = ["date", "outbreak", "disease", "cases", "deaths", "hospitalizations"]


def filter_in(df: DataFrame, col: str, values) -> DataFrame:
    """Keep rows whose ``col`` is in ``values`` (None keeps everything)."""
    if values is None:
        return df
    return df.filter(F.col(col).isin(list(values)))


def keyword_filter(df: DataFrame, cols, keywords=None) -> DataFrame:
    """Rows where any keyword is a substring of any lowercased column."""
    return df.filter(contains_any(cols, keywords))


def filter_class(df: DataFrame, label: str = "outbreak", value: int = 1) -> DataFrame:
    return df.filter(F.col(label) == value)


def filter_min_support(df: DataFrame, count_col: str = "count", min_count: int = 10) -> DataFrame:
    """HAVING count >= min_count."""
    return df.filter(F.col(count_col) >= min_count)


def select_features(df: DataFrame, exclude=None) -> list[str]:
    """All column names except the exclusion list (order kept)."""
    ex = set(FEATURE_EXCLUDE if exclude is None else exclude)
    return [c for c in df.columns if c not in ex]


def feature_frame(df: DataFrame, exclude=None, keys=(), label: str = "outbreak") -> DataFrame:
    """Key columns, label and every non-excluded column with NULLs filled by 0."""
    feats = [c for c in select_features(df, exclude) if c not in keys]
    cols = list(keys) + ([label] if label in df.columns and label not in keys else []) + feats
    return df.select(*cols).na.fill(0, subset=feats)


def object_columns_to_numeric(df: DataFrame, skip=("date", "disease")) -> DataFrame:
    """Every string column except ``skip`` -> double, unparsable -> 0."""
    repl = {c: to_numeric_or_zero(c) for c, t in df.dtypes if t == "string" and c not in skip}
    return df.withColumns(repl) if repl else df


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    """Add a constant tag column (``source='WHO'`` etc.)."""
    return df.withColumn(name, F.lit(value))


def flatten_names(pairs) -> list[str]:
    """``[('polarity', 'mean'), ...]`` -> ``['polarity_mean', ...]``."""
    return ["_".join(p).strip() for p in pairs]


def drop_null_keys(df: DataFrame, keys) -> DataFrame:
    """pandas ``groupby`` drops NULL keys; Spark keeps them -- filter first for parity."""
    cond = None
    for k in _names(keys):
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df
