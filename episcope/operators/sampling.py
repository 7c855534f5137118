"""Seeded, exact-size stratified splits and samples.

Row choice is a deterministic pseudo-random key (a Lehmer step over the row id and
a seed, integer arithmetic that any SQL engine reproduces).  Ranks inside a class
come from the exact, skew-safe ``series_ordinal``: a class holding 85% of the rows
is spread over all partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episcope.operators.joins import bounded_broadcast
from episcope.operators.ordering import RN, series_ordinal
from episcope.session import cut_lineage

# MINSTD multiplier and modulus used for the seeded row key.
LEHMER_A = 48271
LEHMER_M = 2147483647


def seeded_key(id_col: str, seed: int = 42) -> Column:
    """Deterministic pseudo-random key in [0, 2^31-1) from an integer id."""
    x = F.pmod(F.col(id_col).cast("long"), F.lit(LEHMER_M)) + F.lit(int(seed))
    return F.pmod(x * F.lit(LEHMER_A), F.lit(LEHMER_M))


def _class_sizes(df: DataFrame, label: str) -> DataFrame:
    # one row per class; broadcast only after a size check
    return bounded_broadcast(df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc")), materialize=True)


def stratified_split(df: DataFrame, label: str, id_col: str, test_fraction: float = 0.2,
                     seed: int = 42, tiebreak=()) -> DataFrame:
    """Add ``is_test``: per class exactly ``round(test_fraction * n_class)`` rows."""
    x0 = cut_lineage(df.withColumn("_key", seeded_key(id_col, seed)), "split")
    x = series_ordinal(x0, [label], ["_key", id_col, *tiebreak], stable=True)
    x = x.join(_class_sizes(x0, label), [label])
    test = F.col(RN) <= F.floor(F.col("_nc") * F.lit(test_fraction) + F.lit(0.5))
    return x.withColumn("is_test", test).drop("_key", RN, "_nc")


def stratified_sample(df: DataFrame, label: str, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows keeping the share of class 1: ``int(n * ratio)`` of it, the rest from class 0.

    Each class is a top-n by the seeded key, for which a scan first keeps the rows below a
    key that holds about twice the quota (the keys are uniform); only if that was too few,
    all rows are sorted.
    """
    x = cut_lineage(df.withColumn("_key", seeded_key(id_col, seed)), "sample")
    one = F.coalesce(F.col(label) == 1, F.lit(False))
    total, n1 = x.agg(F.count(F.lit(1)), F.sum(F.when(one, 1).otherwise(0))).first()
    take1 = (n * (n1 or 0)) // total if total else 0
    parts = []
    for rows, size, quota in ((x.where(one), n1 or 0, take1), (x.where(~one), total - (n1 or 0), n - take1)):
        parts.append(_smallest(rows, size, quota, id_col))
    return parts[0].unionByName(parts[1]).drop("_key")


def _smallest(x: DataFrame, size: int, n: int, id_col: str) -> DataFrame:
    """The ``n`` rows of ``x`` (``size`` rows) with the smallest (_key, id)."""
    if n < size:
        cut_off = int(LEHMER_M * min(1.0, 2.0 * n / size + 100.0 / size))
        few = x.where(F.col("_key") < cut_off)
        if few.count() >= n:
            x = few
    return x.orderBy("_key", id_col).limit(n)


def cv_subsample(df: DataFrame, id_col: str, n: int = 5000, seed: int = 42) -> DataFrame:
    """``min(n, rows)`` rows with the smallest seeded key (a scan keeps about twice as many, then a top-n)."""
    x = df.withColumn("_key", seeded_key(id_col, seed))
    return _smallest(x, x.count(), n, id_col).drop("_key")


def fold_column(df: DataFrame, label: str, id_col: str, k: int = 3, seed: int = 42,
                out: str = "fold") -> DataFrame:
    """Stratified fold id 0..k-1: class-wise rank modulo ``k``."""
    x = df.withColumn("_key", seeded_key(id_col, seed))
    x = series_ordinal(x, [label], ["_key", id_col])
    return x.withColumn(out, F.pmod(F.col(RN) - 1, F.lit(k)).cast("int")).drop("_key", RN)
