"""Feature plans (the flagship).

``prepare_ml_features``  weekly surveillance + daily environment + posts
    -> daily social roll-up -> calendar parts -> left joins on date -> forward
    fill -> per-disease lags / rolling stats -> interactions -> encodings ->
    feature matrix.
``daily_features``  the daily variant: weekly counts interpolated to
    days, percentile outbreak labels, 1/7/14-day lags and 7/30-day windows.

Plan shape at scale: the post roll-up and environment are map-side partial
aggregates to one row per day and are broadcast (size checked); the fact
table is never shuffled for the joins; window features cost one range shuffle
plus one bucket shuffle whatever the skew of the series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episcope.functions.calendar import calendar_features
from episcope.operators.aggregates import daily_social_agg
from episcope.operators.filters import (
    DAILY_FEATURE_EXCLUDE, FEATURE_EXCLUDE, feature_frame, object_columns_to_numeric,
)
from episcope.operators.joins import left_join
from episcope.operators.ordering import _names
from episcope.session import cut_lineage
from episcope.operators.encoding import encode_rank
from episcope.operators.windows import (
    centered_mean, diff, forward_fill, label_outbreaks, lag, resample_daily_interpolate,
    rolling_mean, rolling_std, series_window,
)


def interaction_features(df: DataFrame, symptoms_col: str = "symptom_mentions",
                         squared: bool = True) -> DataFrame:
    """Products and ratios, each added only when its inputs exist."""
    cols = set(df.columns)
    new = {}
    if {"temperature", "humidity"} <= cols:
        new["temp_humidity_interaction"] = F.col("temperature") * F.col("humidity")
        if squared:
            new["temp_squared"] = F.pow(F.col("temperature"), 2)
    if {"polarity_mean", symptoms_col} <= cols:
        new["sentiment_symptoms_interaction"] = F.col("polarity_mean") * F.col(symptoms_col)
    if squared and {"engagement_score_sum", "id_count"} <= cols:
        new["avg_engagement_per_post"] = F.col("engagement_score_sum") / (F.col("id_count") + 1)
    return df.withColumns(new) if new else df


def merge_all(surv: DataFrame, env: DataFrame, social_daily: DataFrame, ffill_order,
              fill_value=0, on: str = "date") -> DataFrame:
    """surveillance LEFT JOIN environment LEFT JOIN daily social on date, then forward
    fill (in ``ffill_order``) and zero-fill of the remaining numeric NULLs."""
    m = left_join(left_join(surv, env, on), social_daily, on)
    keys = set(_names(ffill_order))
    fill_cols = [c for c in m.columns if c not in keys]
    return forward_fill(m, fill_cols, ffill_order, fill_value=fill_value)


def weekly_lag_specs(has_social: bool):
    specs = [lag("cases_lag_1", "cases", 1), lag("cases_lag_2", "cases", 2),
             rolling_mean("cases_mean_4w", "cases", 4), rolling_std("cases_std_4w", "cases", 4),
             diff("cases_trend", "cases")]
    if has_social:
        specs += [lag("polarity_lag_1", "polarity_mean", 1), diff("sentiment_trend", "polarity_mean")]
    return specs


def prepare_ml_features(surv: DataFrame, env: DataFrame, social: DataFrame, *,
                        series=("disease",), order=("date", "region"),
                        ffill_order=("date", "disease", "region"), exclude=None,
                        keys=("disease", "region", "date"), split_hot: bool = True) -> DataFrame:
    """Feature matrix with key columns, ``outbreak`` label and every feature column.

    ``series`` / ``order`` define the lag series (default: per disease, by date with
    region as tie-break); ``ffill_order`` is the total order of the forward fill.
    """
    social_daily = daily_social_agg(social)
    s = calendar_features(surv, "date")
    m = cut_lineage(merge_all(s, env, social_daily, ffill_order))
    if "disease" in m.columns:           # before the windows: the codes come from the written table
        m = encode_rank(m, "disease")
    m = series_window(m, series, order, weekly_lag_specs("polarity_mean" in m.columns),
                      split_hot=split_hot, stable=True)
    m = interaction_features(m)
    m = object_columns_to_numeric(m, skip=("date", "disease", *keys))
    return feature_frame(m, FEATURE_EXCLUDE if exclude is None else exclude, keys=keys)


def daily_lag_specs(has_social: bool):
    specs = [lag("cases_lag_1", "cases", 1), lag("cases_lag_7", "cases", 7),
             lag("cases_lag_14", "cases", 14), rolling_mean("cases_mean_7d", "cases", 7),
             rolling_std("cases_std_7d", "cases", 7), rolling_mean("cases_mean_30d", "cases", 30)]
    if has_social:
        specs += [lag("polarity_lag_1", "polarity_mean", 1), lag("polarity_lag_3", "polarity_mean", 3),
                  lag("symptom_mentions_lag_1", "total_symptom_mentions", 1)]
    return specs


def daily_features(surv: DataFrame, env: DataFrame, social: DataFrame, *,
                           interp_series=("disease", "region"), value_cols=("cases", "deaths", "hospitalizations"),
                           series=("disease",), order=("date", "region"),
                           ffill_order=("date", "disease", "region"), pct: float = 85.0,
                           keys=("disease", "region", "date"), split_hot: bool = True) -> DataFrame:
    """Daily variant: interpolate -> join posts / environment -> fill -> label -> calendar
    -> 1/7/14-day lags and 7/30-day windows -> interactions -> encodings."""
    base = surv.select(*_names(interp_series), "date", *value_cols)
    daily = resample_daily_interpolate(base, interp_series, "date", value_cols, split_hot=split_hot)
    social_daily = daily_social_agg(social, symptoms_col="symptoms" if "symptoms" in social.columns else None,
                                    symptoms_name="total_symptom_mentions")
    m = left_join(left_join(daily, social_daily, "date"), env, "date")
    fill_cols = [c for c in m.columns if c not in set(ffill_order)]
    m = cut_lineage(forward_fill(m, fill_cols, ffill_order, fill_value=0))
    # percentile label, then ONE skew-safe window pass for the centred mean, its
    # trend and every lag / rolling feature (same series, same order)
    m = label_outbreaks(m, "disease", "cases", pct, order=order, with_trend=False, stable=True)
    m = calendar_features(m, "date")
    specs = [centered_mean("cases_7day_avg", "cases", 7), diff("cases_trend", "cases_7day_avg")]
    specs += daily_lag_specs("polarity_mean" in m.columns)
    m = series_window(m, series, order, specs, split_hot=split_hot)
    m = interaction_features(m, symptoms_col="total_symptom_mentions", squared=False)
    for c, t in m.dtypes:
        if t == "string" and c not in DAILY_FEATURE_EXCLUDE and c not in keys:
            m = encode_rank(m, c)
    if "region" in m.columns:
        m = encode_rank(m, "region")
    return feature_frame(m, DAILY_FEATURE_EXCLUDE + ["region", "outbreak_threshold"], keys=keys)
