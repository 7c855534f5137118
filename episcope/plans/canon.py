"""Output canonicalisation for cross-engine comparison of registered queries.

Floating sums and means depend on the order of addition, which differs between
engines and partitionings; rounding every double to 6 decimals (half up, one
formula evaluated identically by IEEE engines) makes the outputs comparable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episcope.functions.numeric import round_half_up


def canon(df: DataFrame, digits: int = 6) -> DataFrame:
    repl = {c: F.when(F.abs(F.col(c)) < 1e9, round_half_up(c, digits)).otherwise(F.col(c))
            for c, t in df.dtypes if t in ("double", "float")}
    return df.withColumns(repl) if repl else df


def double_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("double", "float")]
