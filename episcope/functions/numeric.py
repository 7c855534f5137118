"""Numeric helpers that behave the same in Spark and in the SQL oracle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int) -> Column:
    """Round half up on the binary value: ``floor(x * 10^d + 0.5) / 10^d``.

    Spark ``round`` (half-up on the decimal expansion) and pandas (half-even on
    the binary value) disagree on ties; this one formula is evaluated the same
    way by every IEEE engine, so reports hash identically across engines.
    """
    scale = float(10 ** digits)
    return (F.floor(_c(c) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))


def safe_div(a, b) -> Column:
    """Division that yields NULL on a zero or NULL divisor (ANSI-safe)."""
    return F.try_divide(_c(a), _c(b))


def to_numeric_or_zero(c) -> Column:
    """Text to double, anything unparsable (or NULL) to 0 -- ``pd.to_numeric(errors='coerce').fillna(0)``."""
    return F.coalesce(F.expr(f"try_cast({c} as double)") if isinstance(c, str)
                      else c.try_cast("double"), F.lit(0.0))
