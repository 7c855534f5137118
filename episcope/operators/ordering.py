"""Order-sensitive building blocks that never funnel a whole series into one task.

pandas operators such as ``shift`` / ``rolling`` / ``ffill`` follow the row order of
an in-memory frame.  In Spark every such operator takes an explicit *total* order.
A plain ``Window.partitionBy(series)`` would put one series (one disease may hold a
third of all rows) into a single task.  The helpers here cut the order into
contiguous *range buckets* and stitch the buckets back together with small carry
tables (one row per bucket and series).

Bucket boundaries are sampled once (a bounded random sample) and inlined as literals, so the bucket of a row is a deterministic expression: a
recomputed task after an executor loss lands every row in the same bucket.

* :func:`range_bucket` -- deterministic contiguous bucket id of a sort key.
* :func:`series_ordinal` -- exact 1-based row number inside each series.
* :func:`halo_buckets` -- cut each series into fixed-size buckets of consecutive
  rows and copy the few neighbouring rows a window frame needs ("halo").
* :func:`running_totals` -- cumulative sums in a global order (ROC, AUC).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episcope.session import cut_lineage, default_parallelism

RN, BUCKET, HALO, RB = "_rn", "_bkt", "_halo", "_rb"
FLAT_BUCKETS = 64         # bounds searched by one nested comparison; more are searched in two levels
SAMPLES_PER_BUCKET = 32


def _names(cols) -> list:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return list(cols)


def _sort_key(row):
    # Spark ascending order puts NULL first; strings compare by code point (= UTF-8 bytes)
    return tuple((v is not None, v) for v in row)


def sample_bounds(df: DataFrame, keys: list[str], buckets: int, seed: int = 42) -> list[tuple]:
    """Ascending boundary tuples of ``keys`` (at most ``buckets - 1``) from a random sample.

    The sample is cut down in the scan to about ``buckets * SAMPLES_PER_BUCKET`` rows, so what
    reaches the driver is bounded by the bucket count, not by the input.  ``df`` is read twice
    (count and sample); callers materialise it first."""
    if buckets <= 1:
        return []
    k, n = buckets * SAMPLES_PER_BUCKET, df.count()
    some = df.select(*keys) if n <= 2 * k else df.select(*keys).where(F.rand(seed) < 1.5 * k / n)
    rows = sorted((tuple(r) for r in some.collect()), key=_sort_key)
    out = []
    for i in range(1, buckets if rows else 1):
        b = rows[min(len(rows) - 1, (len(rows) * i) // buckets)]
        if not out or _sort_key(b) > _sort_key(out[-1]):
            out.append(b)
    return out


def range_bucket(df: DataFrame, keys, buckets: int | None = None, seed: int = 42) -> Column:
    """Column with the 0-based range bucket of ``struct(keys)``.

    Rows in bucket b sort before rows in bucket b+1; equal keys share a bucket.  Without an
    explicit ``buckets`` their number is the session's shuffle partitions.  Up to FLAT_BUCKETS
    bounds are a binary search on literals.  More are searched in two levels: that binary
    search over every s-th bound (s near the root of their number), then a count of the
    smaller bounds in the one block found, a literal array.  So there is no largest number.
    """
    keys = _names(keys)
    bounds = sample_bounds(df, keys, buckets or default_parallelism(df.sparkSession), seed)
    types = dict(df.select(*keys).dtypes)
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    lits = [F.struct(*[F.lit(v).cast(types[k]).alias(f"k{i}") for i, (k, v) in enumerate(zip(keys, b))])
            for b in bounds]

    def search(at: list[Column], lo: int, hi: int) -> Column:  # number of bounds <= key among at[lo:hi] (+ lo)
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key >= at[mid], search(at, mid + 1, hi)).otherwise(search(at, lo, mid))

    if len(lits) <= FLAT_BUCKETS:
        return search(lits, 0, len(lits)).cast("int")
    step = int(len(lits) ** 0.5)
    blocks = [lits[i:i + step] for i in range(0, len(lits), step)]
    block = search([b[0] for b in blocks[1:]], 0, len(blocks) - 1)
    arrays = F.array(*[F.array(*b) for b in blocks])
    # the block is bound once: a one-element array of (block, key) turned into the bucket number
    bound = F.transform(F.array(F.struct(block.alias("at"), key.alias("key"))),
                        lambda b: b["at"] * step + F.aggregate(F.get(arrays, b["at"]), F.lit(0),
                                                               lambda n, x: n + F.when(x <= b["key"], 1).otherwise(0)))
    return F.get(bound, F.lit(0)).cast("int")


def series_ordinal(df: DataFrame, series, order, buckets: int | None = None,
                   col: str = RN, stable: bool = False) -> DataFrame:
    """Add the exact 1-based row number of each row inside its series.

    Rows are numbered inside (range bucket, series) and offset by the row counts of
    the earlier buckets of the same series.  The count table has at most
    ``buckets + series`` rows; it is joined back without a hint so AQE broadcasts
    it once it has measured it.  The input is read four times (count, sample, counts,
    rows), so it is written once first unless the caller says that it is ``stable``
    (a written table with at most projections on top).
    """
    series, order = _names(series), _names(order)
    df = df if stable else cut_lineage(df, "ordered")
    x0 = df.withColumn(RB, range_bucket(df, series + order, buckets))
    w = Window.partitionBy(RB, *series).orderBy(*order)
    x = x0.withColumn("_local", F.row_number().over(w))
    counts = x0.groupBy(RB, *series).agg(F.count(F.lit(1)).alias("_n"))
    wc = (Window.partitionBy(*series) if series else Window).orderBy(RB) \
        .rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*[F.col(c).alias("_c_" + c) for c in [RB, *series]],
                           F.coalesce(F.sum("_n").over(wc), F.lit(0)).alias("_carry"))
    cond = [x[RB] == counts["_c_" + RB]] + [x[s].eqNullSafe(counts["_c_" + s]) for s in series]
    out = x.join(counts, reduce(lambda a, b: a & b, cond))
    out = out.withColumn(col, F.col("_carry") + F.col("_local"))
    return out.drop(*counts.columns, RB, "_local")


def halo_buckets(df: DataFrame, rn_col: str, before: int, after: int,
                 bucket_rows: int) -> DataFrame:
    """Assign bucket ``floor((rn-1)/B)`` and copy edge rows into neighbour buckets.

    The last ``before`` rows of each bucket are copied into the next bucket and the
    first ``after`` rows into the previous one (flag ``_halo``), so any ROWS frame
    reaching ``before`` rows back and ``after`` rows ahead is complete inside a
    bucket.  Every bucket holds at most ``B + before + after`` rows.
    """
    b = max(int(bucket_rows), before, after, 1)
    pos = F.col(rn_col) - 1
    home = F.floor(pos / b).cast("long")
    off = F.pmod(pos, F.lit(b))
    targets = F.array(home)
    if before > 0:
        targets = F.when(off >= b - before, F.array_append(targets, home + 1)).otherwise(targets)
    if after > 0:
        targets = F.when(off < after, F.array_append(targets, home - 1)).otherwise(targets)
    out = df.withColumn("_home", home).withColumn(BUCKET, F.explode(targets))
    return out.withColumn(HALO, F.col(BUCKET) != F.col("_home")).drop("_home")


def running_totals(df: DataFrame, order, sum_cols, buckets: int | None = None,
                   suffix: str = "_cum", series=None, stable: bool = False) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in an ascending total ``order`` (per ``series``).

    Two levels: bucket totals (one row per range bucket and series) are carried forward and
    added to in-bucket running sums.  The input is written once unless ``stable``.
    """
    order, sum_cols, series = _names(order), _names(sum_cols), _names(series)
    df = df if stable else cut_lineage(df, "ordered")
    x = df.withColumn(RB, range_bucket(df, series + order, buckets))
    tot = x.groupBy(RB, *series).agg(*[F.sum(c).alias("_t_" + c) for c in sum_cols])
    wc = (Window.partitionBy(*series) if series else Window).orderBy(RB) \
        .rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*[F.col(c).alias("_c_" + c) for c in [RB, *series]],
                     *[F.coalesce(F.sum("_t_" + c).over(wc), F.lit(0)).alias("_s_" + c) for c in sum_cols])
    cond = [x[RB] == tot["_c_" + RB]] + [x[s].eqNullSafe(tot["_c_" + s]) for s in series]
    # without series the totals have one row per bucket: a proven bound
    out = x.join(tot if series else F.broadcast(tot), reduce(lambda a, b: a & b, cond))
    wi = Window.partitionBy(RB, *series).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumns({c + suffix: F.col("_s_" + c) + F.sum(c).over(wi) for c in sum_cols})
    return out.drop(*tot.columns, RB)
