"""Mergeable pairwise moments: counts, means, variances and covariances of all pairs of columns.

A task turns its rows into one packed state of p x p tables, by matrix products of the values and of
the mask of values present; states are merged pairwise (parallel-variance formula).  So the shuffle has
one row a task, whatever the number of rows, and a second round one row for every merged group of tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episcope.session import ship_package

STATE = "part int, state binary"
TABLES = 6       # count; of column i where i and j are present: mean, sum of squares, least, greatest; co-moment of i and j


def empty(p: int) -> np.ndarray:
    out = np.zeros((TABLES, p, p))
    out[3], out[4] = np.inf, -np.inf
    return out


def of_rows(x: np.ndarray) -> np.ndarray:
    """State of the rows of ``x`` (rows x columns, NaN: missing)."""
    p = x.shape[1]
    out = empty(p)
    if not len(x):
        return out
    here = ~np.isnan(x)
    m = here.astype(float)
    centre = np.where(here, x, 0).sum(axis=0) / np.maximum(m.sum(axis=0), 1)
    y = np.where(here, x - centre, 0.0)           # near its mean, so that squares do not cancel
    n = m.T @ m
    some = np.maximum(n, 1)
    s, q, c = y.T @ m, (y * y).T @ m, y.T @ y
    out[0], out[1] = n, np.where(n > 0, centre[:, None] + s / some, 0)
    out[2], out[5] = np.maximum(q - s * s / some, 0.0), c - s * s.T / some
    whole = here.all(axis=0)
    for table, least, fill in ((3, np.minimum, np.inf), (4, np.maximum, -np.inf)):
        filled = np.where(here, x, fill)
        out[table][:, whole] = least.reduce(filled, axis=0)[:, None]
        for j in np.flatnonzero(~whole):
            out[table][:, j] = least.reduce(filled[here[:, j]], axis=0, initial=fill)
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """State of the rows of both."""
    n = a[0] + b[0]
    some = np.maximum(n, 1)
    d = b[1] - a[1]
    share = a[0] * b[0] / some
    mean = np.where(a[0] == 0, b[1], np.where(b[0] == 0, a[1], a[1] + d * b[0] / some))
    return np.stack([n, mean, a[2] + b[2] + d * d * share, np.minimum(a[3], b[3]), np.maximum(a[4], b[4]), a[5] + b[5] + d * d.T * share])


def pairwise_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """(part, state): one row with the state of all rows (none for a table without partitions)."""
    ship_package(df.sparkSession)
    p = len(cols)
    src = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    groups = math.isqrt(max(1, src.rdd.getNumPartitions())) + 1

    def task(batches):
        state = empty(p)
        for b in batches:
            state = merged(state, of_rows(np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1)))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % groups], pa.int32()), pa.array([state.tobytes()], pa.binary())],
                                         names=["part", "state"])

    def merge(group: pa.Table) -> pa.Table:
        state = empty(p)
        for s in sorted(group["state"].to_pylist()):
            state = merged(state, np.frombuffer(s).reshape(TABLES, p, p))
        return pa.table({"part": pa.array([0], pa.int32()), "state": pa.array([state.tobytes()], pa.binary())})

    once = src.mapInArrow(task, STATE).groupBy("part").applyInArrow(merge, STATE)
    return once.select(F.lit(0).alias("part"), "state").groupBy("part").applyInArrow(merge, STATE)


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """(i, j, r) for i < j: Pearson correlation over the rows where both are present, null where there
    are none or a column is constant there."""
    p = len(cols)

    def rows(batches):
        for b in batches:
            for s in b.column(1).to_pylist():
                n, _mean, square, least, greatest, co = np.frombuffer(s).reshape(TABLES, p, p)
                i, j = np.triu_indices(p, 1)
                with np.errstate(invalid="ignore", divide="ignore"):
                    r = (co / np.sqrt(square * square.T))[i, j]
                known = (n[i, j] > 0) & (least[i, j] < greatest[i, j]) & (least[j, i] < greatest[j, i])
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(r, mask=~known)], names=["i", "j", "r"])

    return pairwise_moments(df, cols).mapInArrow(rows, "i int, j int, r double")
