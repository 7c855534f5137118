"""Column scaling in SQL form (parity with a population-std z-score)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_standard_scaler(df: DataFrame, cols) -> DataFrame:
    """One-row table of mean / population std per column (the fitted scaler)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"_mu_{c}"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"_sd_{c}")]
    return df.agg(*aggs)


def standard_scale(df: DataFrame, cols, fitted: DataFrame | None = None, suffix: str = "") -> DataFrame:
    """z = (x - mean) / population std; a constant column scales to 0.

    ``fitted`` (from :func:`fit_standard_scaler`, e.g. on the training split) is a
    one-row table; its numbers are inlined as literals (no join).
    """
    cols = list(cols)
    st = (fitted if fitted is not None else fit_standard_scaler(df, cols)).first().asDict()  # one row
    repl = {}
    for c in cols:
        mu, sd = st[f"_mu_{c}"], st[f"_sd_{c}"]
        z = (F.col(c).cast("double") - F.lit(mu)) / F.lit(sd) if sd else F.lit(0.0)
        repl[c + suffix] = F.when(F.col(c).isNotNull(), z)
    return df.withColumns(repl)
