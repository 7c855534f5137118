"""Aggregations: daily social roll-up, summaries, group rates, histograms, correlations.

Every aggregate is a single ``groupBy().agg()`` so Spark runs a map-side partial
aggregation before the shuffle; a hot group (one day, one region) therefore costs
one partial row per map task, not its row count.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episcope.functions.numeric import round_half_up
from episcope.operators.moments import correlations
from episcope.operators.ordering import _names


def _dbl(c: str) -> Column:
    return F.col(c).cast("double")


def _rate(c: str) -> Column:
    """Mean of a 0/1 column as double (decimal literals would round in Spark)."""
    return F.avg(_dbl(c))


def symptom_count(col: str = "symptoms") -> Column:
    """Length of a symptom list; NULL (unparsable) counts 0."""
    return F.when(F.col(col).isNull(), F.lit(0)).otherwise(F.size(F.col(col)))


def daily_social_agg(social: DataFrame, ts_col: str = "created_at", digits: int = 4,
                     symptoms_col: str | None = "symptoms", symptoms_name: str = "symptom_mentions") -> DataFrame:
    """Per day: polarity mean/std/min/max, subjectivity mean/std, engagement
    sum/mean/max, post count, rounded to ``digits``; plus ``symptoms_name``
    (sum of symptom-list lengths) in the same pass when ``symptoms_col`` exists."""
    r = (lambda c: round_half_up(c, digits)) if digits is not None else (lambda c: c)
    aggs = [
        r(F.avg("polarity")).alias("polarity_mean"),
        r(F.stddev_samp("polarity")).alias("polarity_std"),
        r(F.min(_dbl("polarity"))).alias("polarity_min"),
        r(F.max(_dbl("polarity"))).alias("polarity_max"),
        r(F.avg("subjectivity")).alias("subjectivity_mean"),
        r(F.stddev_samp("subjectivity")).alias("subjectivity_std"),
        r(F.sum(_dbl("engagement_score"))).alias("engagement_score_sum"),
        r(F.avg("engagement_score")).alias("engagement_score_mean"),
        r(F.max(_dbl("engagement_score"))).alias("engagement_score_max"),
        F.count("id").alias("id_count"),
    ]
    if symptoms_col and symptoms_col in social.columns:
        aggs.append(F.sum(symptom_count(symptoms_col)).cast("long").alias(symptoms_name))
    return (social.withColumn("date", F.to_date(ts_col))
            .where(F.col("date").isNotNull()).groupBy("date").agg(*aggs))


def daily_symptom_mentions(social: DataFrame, ts_col: str = "created_at",
                           symptoms_col: str = "symptoms",
                           name: str = "total_symptom_mentions") -> DataFrame:
    """Per day sum of symptom-list lengths (its own table, for the join form)."""
    return (social.withColumn("date", F.to_date(ts_col)).where(F.col("date").isNotNull())
            .groupBy("date").agg(F.sum(symptom_count(symptoms_col)).cast("long").alias(name)))


def group_rates(df: DataFrame, key, flag: str = "outbreak", prefix: str = "") -> DataFrame:
    """count / sum / mean of a 0/1 flag per group (pandas ``agg(['count','sum','mean'])``)."""
    keys = _names(key)
    return (df.groupBy(*keys).agg(F.count(flag).alias(prefix + "count"),
                                F.sum(F.col(flag)).cast("long").alias(prefix + "sum"),
                                _rate(flag).alias(prefix + "mean")))


def regional_stats(df: DataFrame, region: str = "region", digits: int = 3) -> DataFrame:
    """Per region: outbreak count/sum/mean and cases mean/std/max, rounded."""
    r = lambda c: round_half_up(c, digits)
    return df.groupBy(region).agg(
        F.count("outbreak").alias("outbreak_count"),
        F.sum("outbreak").cast("long").alias("outbreak_sum"),
        r(_rate("outbreak")).alias("outbreak_mean"),
        r(F.avg("cases")).alias("cases_mean"),
        r(F.stddev_samp("cases")).alias("cases_std"),
        F.max("cases").alias("cases_max"))


def seasonal_outbreaks(df: DataFrame, date_col: str = "date", flag: str = "outbreak") -> DataFrame:
    """Per calendar month: count / sum / mean of the outbreak flag."""
    return group_rates(df.withColumn("month", F.month(date_col)), "month", flag)


def yearly_outbreaks(df: DataFrame, date_col: str = "date", flag: str = "outbreak") -> DataFrame:
    """Per year: count / sum / mean of the outbreak flag."""
    return group_rates(df.withColumn("year", F.year(date_col)), "year", flag)


def mean_by(df: DataFrame, key: str, col: str, name: str | None = None) -> DataFrame:
    return df.groupBy(key).agg(F.avg(col).alias(name or f"{col}_mean"))


def sum_by(df: DataFrame, key: str, col: str, name: str | None = None) -> DataFrame:
    return df.groupBy(key).agg(F.sum(col).alias(name or f"{col}_sum"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per value, NULLs dropped (``value_counts``); order is applied by callers."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def exploded_counts(df: DataFrame, list_col: str, name: str = "symptom") -> DataFrame:
    """Flatten every list and count each element."""
    return (df.select(F.explode(list_col).alias(name)).where(F.col(name).isNotNull())
            .groupBy(name).agg(F.count(F.lit(1)).alias("count")))


def _with_min_max(df: DataFrame, col: str) -> tuple[DataFrame, float | None, float | None]:
    """Attach the global min/max of ``col`` to every row as literals; also returns the two.

    The one-row aggregate (two numbers) is fetched first; the main pass is then
    purely map-side, with no join at all.
    """
    lo, hi = df.agg(F.min(_dbl(col)), F.max(_dbl(col))).first()
    return df.withColumn("_lo", F.lit(lo).cast("double")).withColumn("_hi", F.lit(hi).cast("double")), lo, hi


def _with_empty_bins(out: DataFrame, x: DataFrame, bins: int, by: str | None, fill: dict) -> DataFrame:
    """``out`` with a row for every bin 1..``bins`` (of every class of ``by`` in ``x``)."""
    grid = x.select(by).distinct() if by else x.sparkSession.range(1).select()
    grid = grid.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    keys = ["bin", *([by] if by else [])]
    r = out.withColumnsRenamed({k: "_g_" + k for k in keys})
    on = [F.col(k).eqNullSafe(F.col("_g_" + k)) for k in keys]
    return grid.join(r, on, "left").drop(*["_g_" + k for k in keys]).na.fill(fill)


def histogram(df: DataFrame, col: str, bins: int = 20, by: str | None = None) -> DataFrame:
    """Equal-width histogram between min and max; last bin closed on the right.

    Returns every ``bin`` (1..bins) of every class ``by`` (optional) with its ``lo``/``hi``
    edges and ``count``, 0 for bins without rows.  No rows: no bins.
    """
    x, lo, hi = _with_min_max(df.where(F.col(col).isNotNull()), col)
    norm = F.lit(float(bins)) / (F.col("_hi") - F.col("_lo"))
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(1)).otherwise(
        F.least(F.floor((_dbl(col) - F.col("_lo")) * norm).cast("int") + 1, F.lit(bins)))
    out = x.groupBy(b.alias("bin"), *([F.col(by)] if by else [])).agg(F.count(F.lit(1)).alias("count"))
    out = _with_empty_bins(out, x, bins, by, {"count": 0}).withColumns({"_lo": F.lit(lo).cast("double"), "_hi": F.lit(hi).cast("double")}).where("_lo is not null")
    w = (F.col("_hi") - F.col("_lo")) / bins
    return out.select("bin", *([by] if by else []),
                      (F.col("_lo") + (F.col("bin") - 1) * w).alias("lo"),
                      (F.col("_lo") + F.col("bin") * w).alias("hi"), "count")


def binned_rate(df: DataFrame, col: str, flag: str = "outbreak", bins: int = 5) -> DataFrame:
    """Mean of ``flag`` per equal-width bin of ``col`` (``pd.cut(x, bins)``).

    Bins are right-closed; the bin number is the count of interior edges below x.  Every bin
    is returned with its edges ``lo`` and ``hi``; a bin without rows has count 0 and no rate.
    """
    x, lo, hi = _with_min_max(df.where(F.col(col).isNotNull()), col)
    w = (F.col("_hi") - F.col("_lo")) / bins
    b = sum((F.when(_dbl(col) > F.col("_lo") + w * i, 1).otherwise(0) for i in range(1, bins)), F.lit(0)) + 1
    out = x.withColumn("bin", b.cast("int")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"), _rate(flag).alias("rate"))
    out = _with_empty_bins(out, x, bins, None, {"count": 0}).withColumns({"_lo": F.lit(lo).cast("double"), "_hi": F.lit(hi).cast("double")}).where("_lo is not null")
    return out.select("bin", (F.col("_lo") + w * (F.col("bin") - 1)).alias("lo"), (F.col("_lo") + w * F.col("bin")).alias("hi"), "count", "rate")


def correlation_matrix(df: DataFrame, cols) -> DataFrame:
    """Pairwise Pearson correlations (upper triangle, i<j) as rows (i, j, a, b, r), over
    pairwise-complete rows (NULL and NaN are missing); r is NULL when either column is constant there.
    One pass, and one row a task in the shuffle (:mod:`episcope.operators.moments`)."""
    cols = list(cols)
    names = F.array(*[F.lit(c) for c in cols])
    p = len(cols)
    grid = df.sparkSession.range(p * p).select((F.col("id") / p).cast("int").alias("i"), (F.col("id") % p).cast("int").alias("j")).where("j > i")
    r = correlations(df, cols).withColumnsRenamed({"i": "_i", "j": "_j"})
    return grid.join(r, (F.col("i") == F.col("_i")) & (F.col("j") == F.col("_j")), "left") \
        .select("i", "j", F.get(names, "i").alias("a"), F.get(names, "j").alias("b"), "r")


def high_correlation_pairs(df: DataFrame, cols, threshold: float = 0.7, top: int = 5) -> DataFrame:
    """Pairs with |r| > threshold in column order (i, j); the first ``top`` of them."""
    m = correlation_matrix(df, cols).where(F.abs("r") > threshold)
    return m.orderBy("i", "j").limit(top)


def dataset_summary(social: DataFrame, surv: DataFrame, env: DataFrame) -> DataFrame:
    """Per-table summary rows (records, date range, categories, key means).

    Three one-row aggregates unioned; category lists are sorted ``collect_set``
    (bounded by the number of platforms / diseases).
    """
    s = social.agg(F.lit("social_media").alias("table"), F.count(F.lit(1)).alias("records"),
                   F.min("created_at").cast("timestamp_ntz").alias("start"),
                   F.max("created_at").cast("timestamp_ntz").alias("end"),
                   F.array_sort(F.collect_set("platform")).alias("categories"),
                   F.avg(_dbl("polarity")).alias("mean_value"),
                   F.lit(None).cast("double").alias("min_value"),
                   F.lit(None).cast("double").alias("max_value"))
    v = surv.agg(F.lit("surveillance").alias("table"), F.count(F.lit(1)).alias("records"),
                 F.min("date").cast("timestamp_ntz").alias("start"),
                 F.max("date").cast("timestamp_ntz").alias("end"),
                 F.array_sort(F.collect_set("disease")).alias("categories"),
                 _rate("outbreak").alias("mean_value"),
                 F.lit(None).cast("double").alias("min_value"),
                 F.lit(None).cast("double").alias("max_value"))
    e = env.agg(F.lit("environmental").alias("table"), F.count(F.lit(1)).alias("records"),
                F.min("date").cast("timestamp_ntz").alias("start"),
                F.max("date").cast("timestamp_ntz").alias("end"),
                F.lit(None).cast("array<string>").alias("categories"),
                F.avg(_dbl("humidity")).alias("mean_value"),
                F.min(_dbl("temperature")).alias("min_value"),
                F.max(_dbl("temperature")).alias("max_value"))
    return s.unionByName(v).unionByName(e)


def report_dataset_summary(surv: DataFrame, region: str = "region") -> DataFrame:
    """Records, distinct regions, date span (years, 1 decimal), outbreaks, rate,
    regions with at least one outbreak."""
    return surv.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(region).alias("countries"),
        F.min("date").alias("start_date"), F.max("date").alias("end_date"),
        round_half_up(F.datediff(F.max("date"), F.min("date")) / F.lit(365.25), 1).alias("span_years"),
        F.sum("outbreak").cast("long").alias("total_outbreaks"),
        _rate("outbreak").alias("outbreak_rate"),
        F.count_distinct(F.when(F.col("outbreak") == 1, F.col(region))).alias("countries_with_outbreaks"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def anova_f(df: DataFrame, label: str, cols) -> DataFrame:
    """F statistic of each feature between the classes of ``label``: (feature, f_value), one pass.

    Missing values and rows without a class do not count.  The table between holds one row a class; the
    statistic is null with fewer than two classes, or without spread inside the classes.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    parts = df.where(F.col(label).isNotNull()).groupBy(label).agg(*[x for i, c in enumerate(cols) for x in (
        F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.var_pop(c).alias(f"v{i}"))])
    per = parts.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").cast("double").alias("m"), F.col(f"v{i}").alias("v"))
        for i, c in enumerate(cols)])).alias("x")).select("x.*").where(F.col("n") > 0)
    tot = per.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"),
        F.sum(F.col("n") * F.col("v")).alias("within"), F.collect_list(F.struct("n", "m")).alias("classes"))
    between = F.aggregate("classes", F.lit(0.0), lambda acc, c: acc + c["n"] * (c["m"] - F.col("mean")) * (c["m"] - F.col("mean")))
    f = F.try_divide(F.try_divide(between, F.col("k") - 1), F.try_divide(F.col("within"), F.col("n") - F.col("k")))
    return tot.select("feature", f.alias("f_value"))
