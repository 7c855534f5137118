"""Evaluation and decision reports as aggregations over (label, prediction, score).

All metrics are one-pass conditional aggregates except the ROC family, which needs
running sums over the distinct scores in descending order; those use the two-level
``running_totals`` so no single task sees every score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episcope.operators.joins import bounded_broadcast
from episcope.operators.ordering import _names, running_totals
from episcope.operators.windows import lead, series_window
from episcope.session import cut_lineage

# Unit costs of the cost-benefit report (currency units).
COST_PER_RESPONSE = 50_000
COST_OF_MISSED_OUTBREAK = 500_000
COST_OF_FALSE_ALARM = 10_000
# Number of countries used for the global projection.
GLOBAL_COUNTRIES = 195


def _i(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """One row: tp, fp, fn, tn, n (a single partial-aggregated pass)."""
    y, p = _i(label), _i(pred)
    return df.agg(
        F.sum(F.when((y == 1) & (p == 1), 1).otherwise(0)).cast("long").alias("tp"),
        F.sum(F.when((y == 0) & (p == 1), 1).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when((y == 1) & (p == 0), 1).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when((y == 0) & (p == 0), 1).otherwise(0)).cast("long").alias("tn"),
        F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return df.agg(F.avg((_i(label) == _i(pred)).cast("double")).alias("accuracy"))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """2x2 counts: a row for each actual class, 0 and 1, with ``predicted_0`` / ``predicted_1``
    (a class without rows has zeros)."""
    c = confusion_counts(df, label, pred)
    zero = F.lit(0).cast("long")
    cell = [F.struct(zero.alias("actual"), F.coalesce("tn", zero).alias("predicted_0"), F.coalesce("fp", zero).alias("predicted_1")),
            F.struct(F.lit(1).cast("long").alias("actual"), F.coalesce("fn", zero).alias("predicted_0"), F.coalesce("tp", zero).alias("predicted_1"))]
    return c.select(F.explode(F.array(*cell)).alias("m")).select("m.*")


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per-class precision / recall / F1 / support, accuracy, macro and weighted averages.

    Zero divisions give 0 (the usual report convention).  Rows: '0', '1',
    'accuracy', 'macro avg', 'weighted avg'.
    """
    c = confusion_counts(df, label, pred)
    z = lambda e: F.coalesce(e, F.lit(0.0))
    p1 = z(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")))
    r1 = z(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")))
    p0 = z(F.try_divide(F.col("tn"), F.col("tn") + F.col("fn")))
    r0 = z(F.try_divide(F.col("tn"), F.col("tn") + F.col("fp")))
    x = c.select("*", p0.alias("p0"), r0.alias("r0"), p1.alias("p1"), r1.alias("r1"),
                 (F.col("tn") + F.col("fp")).alias("s0"), (F.col("tp") + F.col("fn")).alias("s1"))
    f = lambda p, r: z(F.try_divide(2 * F.col(p) * F.col(r), F.col(p) + F.col(r)))
    x = x.select("*", f("p0", "r0").alias("f0"), f("p1", "r1").alias("f1"))
    acc = z(F.try_divide((F.col("tp") + F.col("tn")).cast("double"), F.col("n")))
    wavg = lambda a, b: z(F.try_divide(F.col(a) * F.col("s0") + F.col(b) * F.col("s1"), F.col("n")))
    def row(cls, p, r, f1, sup):
        return F.struct(F.lit(cls).alias("class"), p.alias("precision"), r.alias("recall"),
                        f1.alias("f1_score"), sup.cast("long").alias("support"))

    col = F.col
    rows = F.array(
        row("0", col("p0"), col("r0"), col("f0"), col("s0")),
        row("1", col("p1"), col("r1"), col("f1"), col("s1")),
        row("accuracy", acc, acc, acc, col("n")),
        row("macro avg", (col("p0") + col("p1")) / 2, (col("r0") + col("r1")) / 2,
            (col("f0") + col("f1")) / 2, col("n")),
        row("weighted avg", wavg("p0", "p1"), wavg("r0", "r1"), wavg("f0", "f1"), col("n")))
    return x.select(F.explode(rows).alias("r")).select("r.*")


def detection_impact(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Test outbreaks, correctly predicted, missed, detection rate (0 when none)."""
    c = confusion_counts(df, label, pred)
    outbreaks = F.col("tp") + F.col("fn")
    return c.select(outbreaks.alias("test_outbreaks"), F.col("tp").alias("correctly_predicted"),
                    F.col("fn").alias("missed_outbreaks"),
                    F.coalesce(F.try_divide(F.col("tp").cast("double"), outbreaks), F.lit(0.0))
                    .alias("detection_rate"))


def cost_benefit(df: DataFrame, label: str = "label", pred: str = "prediction",
                 response_cost: int = COST_PER_RESPONSE, missed_cost: int = COST_OF_MISSED_OUTBREAK,
                 false_alarm_cost: int = COST_OF_FALSE_ALARM) -> DataFrame:
    """Response cost, avoided cost, false-alarm cost, missed cost, net benefit, ROI %."""
    c = confusion_counts(df, label, pred)
    predicted = F.col("tp") + F.col("fp")
    x = c.select(
        (predicted * response_cost).alias("response_cost"),
        (F.col("tp") * missed_cost).alias("avoided_cost"),
        (F.col("fp") * false_alarm_cost).alias("false_alarm_cost"),
        (F.col("fn") * missed_cost).alias("missed_cost"))
    net = F.col("avoided_cost") - F.col("response_cost") - F.col("false_alarm_cost") - F.col("missed_cost")
    x = x.withColumn("net_benefit", net)
    return x.withColumn("roi_pct", F.coalesce(
        F.try_divide(F.col("net_benefit").cast("double") * 100, F.col("response_cost")), F.lit(0.0)))


def operational_tiers(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Detection-rate tier (HIGH > .7, MODERATE > .5, else LOW), precision tier (HIGH > .6)."""
    c = confusion_counts(df, label, pred)
    det = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), F.lit(0.0))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0))
    x = c.select(det.alias("detection_rate"), prec.alias("precision"))
    return x.select("*",
                    F.when(F.col("detection_rate") > 0.7, "HIGH")
                    .when(F.col("detection_rate") > 0.5, "MODERATE").otherwise("LOW").alias("detection_tier"),
                    F.when(F.col("precision") > 0.6, "HIGH").otherwise("LOW").alias("precision_tier"))


def score_table(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Distinct scores with positive / negative counts (map-side combined)."""
    y = _i(label)
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(y).cast("long").alias("pos"), F.sum(1 - y).cast("long").alias("neg"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", thin: bool = False,
              bucket_rows: int | None = None) -> DataFrame:
    """One ROC point per distinct score (descending): threshold, fpr, tpr.

    ``thin`` drops the points where the curve keeps its step: those whose next score adds the same positives and
    negatives as their own.  The first and last score stay, and a point (infinity, 0, 0) starts the curve.
    The next score of a bucket's last row comes with the halo, so no task sees every score.
    """
    d = cut_lineage(score_table(df, label, score).withColumn("_neg_score", -F.col("score")), "scores")
    cum = running_totals(d, ["_neg_score"], ["pos", "neg"], stable=True)
    p_tot, n_tot = d.agg(F.sum("pos"), F.sum("neg")).first()  # one row: two numbers
    if thin:
        cum = cut_lineage(cum, "curve")
        lo, hi = cum.agg(F.min("_neg_score"), F.max("_neg_score")).first()
        x = series_window(cum, [], ["_neg_score"], [lead("_next_pos", "pos", 1), lead("_next_neg", "neg", 1)],
                          bucket_rows=bucket_rows, stable=True)
        same = F.col("_next_pos").eqNullSafe(F.col("pos")) & F.col("_next_neg").eqNullSafe(F.col("neg"))
        ends = F.col("_neg_score").isin([v for v in (lo, hi) if v is not None])
        start = cum.sparkSession.createDataFrame([(float("-inf"), float("inf"), 0, 0)],
                                                 "_neg_score double, score double, pos_cum long, neg_cum long")
        cum = x.where(~same | ends).select(*start.columns).unionByName(start)
    return cum.select(F.col("score").alias("threshold"),
                      F.try_divide(F.col("neg_cum").cast("double"), F.lit(n_tot).cast("long")).alias("fpr"),
                      F.try_divide(F.col("pos_cum").cast("double"), F.lit(p_tot).cast("long")).alias("tpr"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve (ties count one half), one row ``auc``.

    AUC = sum over distinct scores of neg_s * (positives scored higher + pos_s / 2) / (P * N).
    """
    d = score_table(df, label, score).withColumn("_neg_score", -F.col("score"))
    cum = running_totals(d, ["_neg_score"], ["pos"])
    term = F.col("neg").cast("decimal(38,0)") * (2 * F.col("pos_cum") - F.col("pos")).cast("decimal(38,0)")
    a = cum.agg(F.sum(term).alias("_num"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return a.select(F.try_divide(F.col("_num").cast("double"),
                                 (2 * F.col("P") * F.col("N")).cast("double")).alias("auc"))


def roc_auc_by(df: DataFrame, groups, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve of each group (``groups``, ``auc``), all groups in one pass.  Rows
    without a label or score do not count; a group of one class has no area (null)."""
    groups = _names(groups)
    d = df.where(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))) \
        .groupBy(*groups, (-F.col(score)).alias("_neg_score")) \
        .agg(F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) != 1, 1)).alias("neg"))
    cum = running_totals(d, ["_neg_score"], ["pos"], series=groups)
    term = F.col("neg").cast("decimal(38,0)") * (2 * F.col("pos_cum") - F.col("pos")).cast("decimal(38,0)")
    return cum.groupBy(*groups).agg(F.try_divide(F.sum(term).cast("double"), (2 * F.sum("pos") * F.sum("neg")).cast("double")).alias("auc"))


def effect_size(auc_df: DataFrame, auc_col: str = "auc") -> DataFrame:
    """d = ((auc - .5) * 2) / .2; Large > .8, Medium > .5, else Small."""
    d = ((F.col(auc_col) - 0.5) * 2) / 0.2
    return auc_df.select(F.col(auc_col), d.alias("effect_size"),
                         F.when(d > 0.8, "Large").when(d > 0.5, "Medium").otherwise("Small").alias("magnitude"))


def trend_verdict(yearly: DataFrame, year: str = "year", rate: str = "mean", last: int = 5,
                  min_years: int = 3, eps: float = 0.01) -> DataFrame:
    """Change of the rate over the last ``last`` years (final minus first of them).

    Only when more than ``min_years`` years exist; the verdict is increasing
    (> eps), decreasing (< -eps) or stable.  ``yearly`` has one row per year.
    """
    w = Window.orderBy(F.col(year).desc())  # one row per year: a small table
    x = yearly.withColumn("_r", F.row_number().over(w)).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy()))
    x = x.where(F.col("_r") <= last)
    a = x.agg(F.max("_n").alias("n_years"), F.min(year).alias("first_year"), F.max(year).alias("last_year"),
              (F.max_by(rate, year) - F.min_by(rate, year)).alias("trend_change"))
    a = a.where(F.col("n_years") > min_years)
    return a.withColumn("verdict", F.when(F.col("trend_change") > eps, "increasing")
                        .when(F.col("trend_change") < -eps, "decreasing").otherwise("stable"))


def coverage_projection(surv: DataFrame, social: DataFrame, region: str = "region",
                        countries: int = GLOBAL_COUNTRIES) -> DataFrame:
    """Regions covered, records per region, posts, projected records for all countries."""
    posts = social.agg(F.count(F.lit(1))).first()[0]  # one number
    x = surv.agg(F.count_distinct(region).alias("countries_covered"), F.count(F.lit(1)).alias("records")) \
        .withColumn("social_posts", F.lit(posts).cast("long"))
    rpc = F.try_divide(F.col("records").cast("double"), F.col("countries_covered"))
    return x.select("countries_covered", "records", rpc.alias("records_per_country"), "social_posts",
                    (rpc * countries).alias("global_projection"))


def balanced_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Class weight n / (n_classes * n_class) per row.

    The class-count table has one row per class; it is broadcast after a size check.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    n = F.sum("_nc").over(Window.partitionBy())  # over the class table: one row per class
    k = F.count(F.lit(1)).over(Window.partitionBy())
    w = counts.select(label, (n / (k * F.col("_nc"))).alias(out))
    return df.join(bounded_broadcast(w, materialize=True), [label], "left")
