"""Time-series window operators: lag, rolling, diff, centred mean, forward fill,
percentile labels, daily interpolation and rank encoding.

All ROWS-frame operators take ``series`` (partition columns) and ``order`` (a total
order inside the series).  With ``split_hot=True`` (the default) a series is cut
into buckets of consecutive rows with halo rows (see ``ordering``), so a disease
holding a third of the data is spread over many tasks with exact results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episcope.operators.joins import bounded_broadcast
from episcope.operators.ordering import (
    BUCKET, HALO, RB, RN, _names, halo_buckets, range_bucket, running_totals, series_ordinal,
)
from episcope.session import cut_lineage

DEFAULT_BUCKET_ROWS = 50_000      # rows of a series in one task; callers and tests may set it



@dataclass(frozen=True)
class Spec:
    """One window feature: ``kind`` in lag, lead, mean, std, sum, min, max, diff, cmean."""

    name: str
    kind: str
    col: str
    n: int = 1

    def reach(self) -> tuple[int, int]:
        """(rows before, rows after) the frame needs."""
        k = self.kind
        if k == "lag":
            return self.n, 0
        if k == "lead":
            return 0, self.n
        if k == "diff":
            return 1, 0
        if k == "cmean":
            return self.n // 2, self.n // 2
        return self.n - 1, 0


def lag(name, col, k):
    return Spec(name, "lag", col, k)


def lead(name, col, k):
    return Spec(name, "lead", col, k)


def rolling_mean(name, col, n):
    return Spec(name, "mean", col, n)


def rolling_std(name, col, n):
    return Spec(name, "std", col, n)


def diff(name, col):
    return Spec(name, "diff", col, 1)


def centered_mean(name, col, n):
    return Spec(name, "cmean", col, n)


def _expr(spec: Spec, w) -> Column:
    c = F.col(spec.col)
    if spec.kind == "lag":
        return F.lag(c, spec.n).over(w)
    if spec.kind == "lead":
        return F.lead(c, spec.n).over(w)
    if spec.kind == "diff":
        return c - F.lag(c, 1).over(w)
    if spec.kind == "cmean":
        h = spec.n // 2
        f = w.rowsBetween(-h, h)
        return F.when(F.count(c).over(f) >= spec.n, F.avg(c).over(f))
    f = w.rowsBetween(-(spec.n - 1), 0)
    agg = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum, "min": F.min, "max": F.max}[spec.kind]
    # pandas rolling(n) needs n non-missing values in the frame (min_periods = n).
    return F.when(F.count(c).over(f) >= spec.n, agg(c).over(f))


def _reach(specs: list[Spec]) -> tuple[int, int]:
    """Frame reach of a chain of specs (a spec may read an earlier spec's output)."""
    need: dict[str, tuple[int, int]] = {}
    for s in specs:
        b, a = s.reach()
        pb, pa = need.get(s.col, (0, 0))
        need[s.name] = (b + pb, a + pa)
    return (max((v[0] for v in need.values()), default=0),
            max((v[1] for v in need.values()), default=0))


def series_window(df: DataFrame, series, order, specs: list[Spec], split_hot: bool = True,
                  bucket_rows: int | None = None,
                  buckets: int | None = None, stable: bool = False) -> DataFrame:
    """Add window features per series in ``order`` (ROWS frames, pandas semantics).

    ``split_hot=False`` is the textbook ``Window.partitionBy(series)`` plan (one
    shuffle, but a series is one task).  ``split_hot=True`` computes an exact
    ordinal, buckets it with halo rows and runs the same expressions per bucket.
    """
    series, order = _names(series), _names(order)
    if not split_hot:
        w = (Window.partitionBy(*series) if series else Window).orderBy(*order)
        for s in specs:
            df = df.withColumn(s.name, _expr(s, w))
        return df
    before, after = _reach(specs)
    x = series_ordinal(df, series, order, buckets, stable=stable)
    x = halo_buckets(x, RN, before, after, bucket_rows or DEFAULT_BUCKET_ROWS)
    w = Window.partitionBy(*series, BUCKET).orderBy(RN)
    for s in specs:
        x = x.withColumn(s.name, _expr(s, w))
    return x.filter(~F.col(HALO)).drop(RN, BUCKET, HALO)


def forward_fill(df: DataFrame, cols, order, partition_by=None, fill_value=None,
                 buckets: int | None = None, stable: bool = False) -> DataFrame:
    """Replace NULLs by the last non-NULL value before them in ``order`` (``ffill``).

    Two levels, so a global fill (no partition key, as in the reference) does not
    run in one task: (1) contiguous range buckets of the order, (2) the last
    non-NULL of every bucket is carried forward over a table with one row per
    bucket (and series), (3) inside each bucket a running ``last(ignorenulls)``.
    ``fill_value`` then replaces what is still NULL (``.fillna(0)``) in numeric columns.
    """
    cols, order, part = _names(cols), _names(order), _names(partition_by)
    df = df if stable else cut_lineage(df, "ordered")
    x = df.withColumn(RB, range_bucket(df, part + order, buckets))
    okey = F.struct(*[F.col(o) for o in order])
    lastv = x.groupBy(RB, *part).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), okey)).alias("_l_" + c) for c in cols])
    wc = (Window.partitionBy(*part) if part else Window).orderBy(RB) \
        .rowsBetween(Window.unboundedPreceding, -1)
    carry = lastv.select(F.col(RB).alias("_c_rb"), *[F.col(p).alias("_c_" + p) for p in part],
                         *[F.last("_l_" + c, ignorenulls=True).over(wc).alias("_c_" + c) for c in cols])
    cond = x[RB] == carry["_c_rb"]
    for p in part:
        cond = cond & x[p].eqNullSafe(carry["_c_" + p])
    # Without a partition key the carry table has one row per range bucket: a
    # proven bound, so it is broadcast.  With keys AQE sizes it at run time.
    right = F.broadcast(carry) if not part else carry
    y = x.join(right, cond, "left")
    wi = Window.partitionBy(RB, *part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    types = dict(df.dtypes)
    repl = {}
    for c in cols:
        v = F.coalesce(F.last(F.col(c), ignorenulls=True).over(wi), F.col("_c_" + c))
        if fill_value is not None and types[c] not in ("string", "date", "timestamp", "timestamp_ntz",
                                                       "boolean") and not types[c].startswith(("array", "struct", "map")):
            v = F.coalesce(v, F.lit(fill_value).cast(types[c]))
        repl[c] = v
    y = y.withColumns(repl)
    return y.drop(*carry.columns, RB)


def fill_zero(df: DataFrame, cols=None) -> DataFrame:
    """Remaining NULLs of numeric columns -> 0 (``fillna(0)``)."""
    return df.na.fill(0, subset=_names(cols) or None)


def percentile_threshold(df: DataFrame, group: str, col: str, pct: float = 85.0) -> DataFrame:
    """Per-group linear-interpolation percentile (``numpy.percentile``), exact.

    The distinct values of a group are counted (combined map-side), and running counts over
    range buckets find the two order statistics, so the values of a hot group are spread
    over the buckets however many they are.
    """
    v = df.where(F.col(col).isNotNull()).groupBy(group, F.col(col).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    v = running_totals(v, ["_v"], ["_n"], suffix="_upto", series=[group])
    totals = v.groupBy(F.col(group).alias("_g")).agg(F.max("_n_upto").alias("_all"))
    at = F.lit(pct / 100.0) * (F.col("_all") - 1)
    x = v.join(totals, F.col(group).eqNullSafe(F.col("_g"))).withColumn("_at", at)

    def statistic(index):
        return F.max(F.when((F.col("_n_upto") > index) & (F.col("_n_upto") - F.col("_n") <= index), F.col("_v")))

    lo, hi = statistic(F.floor("_at")), statistic(F.ceil("_at"))
    out = x.groupBy(group).agg(lo.alias("_lo"), hi.alias("_hi"), F.max("_at").alias("_at"))
    return out.select(group, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_at") - F.floor("_at"))).alias("outbreak_threshold"))


def label_outbreaks(df: DataFrame, group: str = "disease", col: str = "cases",
                    pct: float = 85.0, order=("date",), with_trend: bool = True,
                    split_hot: bool = True, stable: bool = False) -> DataFrame:
    """``outbreak = cases > per-group percentile`` (strict) plus optional 7-row centred
    mean ``cases_7day_avg`` and its first difference ``cases_trend``."""
    df = df if stable else cut_lineage(df, "labels")
    # one row per group: materialised, size-checked and broadcast, so a hot group
    # never meets a sort-merge join on its key
    th = bounded_broadcast(percentile_threshold(df, group, col, pct), materialize=True)
    out = df.join(th, [group], "left").withColumn(
        "outbreak", (F.col(col) > F.col("outbreak_threshold")).cast("int"))
    if with_trend:
        out = series_window(out, [group], order, [
            centered_mean("cases_7day_avg", col, 7), diff("cases_trend", "cases_7day_avg")],
            split_hot=split_hot, stable=True)
    return out


def resample_daily_interpolate(df: DataFrame, series, date_col: str, value_cols,
                               split_hot: bool = True) -> DataFrame:
    """Weekly (any irregular) points -> one row per day, values linearly interpolated.

    Each point is expanded to the days up to (not including) the next point of its
    series; the last point of a series yields only itself, and so does a point that
    another of the same date follows (in the order of the values).
    """
    series, value_cols = _names(series), _names(value_cols)
    specs = [lead("_next_date", date_col, 1)] + [lead("_next_" + c, c, 1) for c in value_cols]
    x = series_window(df, series, [date_col, *value_cols], specs, split_hot=split_hot)
    x = x.withColumn("_next_date", F.when(F.col("_next_date") > F.col(date_col), F.col("_next_date")))
    nd = F.col("_next_date")
    days = F.sequence(F.col(date_col), F.coalesce(F.date_sub(nd, 1), F.col(date_col)))
    x = x.withColumn("_day", F.explode(days))
    span = F.datediff(nd, F.col(date_col)).cast("double")
    frac = F.datediff(F.col("_day"), F.col(date_col)).cast("double") / span
    repl = {c: F.when(nd.isNull() | (F.col("_day") == F.col(date_col)), F.col(c).cast("double"))
            .otherwise(F.col(c).cast("double") + (F.col("_next_" + c).cast("double") - F.col(c).cast("double")) * frac)
            for c in value_cols}
    x = x.withColumns(repl).withColumn(date_col, F.col("_day"))
    return x.drop("_day", "_next_date", *["_next_" + c for c in value_cols])


def every_nth(df: DataFrame, order, n: int = 7) -> DataFrame:
    """Rows 1, 1+n, 1+2n, ... of a total order (``iloc[::n]``)."""
    x = series_ordinal(df, [], order)
    return x.filter(F.pmod(F.col(RN) - 1, F.lit(n)) == 0).drop(RN)
