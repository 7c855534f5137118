"""Equi left joins on a date key, with size-checked broadcast.

The reference only has left joins of a big fact table (surveillance) to one-row-
per-day tables (environment, daily social).  Those right sides grow with the time
span, not with the data volume, so they are broadcast -- but only after a check
that reads at most ``max_rows + 1`` rows; beyond the bound the planner's shuffle
join (with AQE) is used instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episcope.operators.ordering import _names
from episcope.session import cut_lineage

# A daily table for 100 years has ~36,500 rows; anything past this is not "small".
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 << 20


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      materialize: bool = False, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows and ``max_bytes`` bytes (8 a field,
    strings by their length), else ``df`` unchanged.

    The check reads at most ``max_rows + 1`` rows.  With ``materialize`` the table (typically a daily aggregate) is
    first written to the checkpoint folder, so the check and the join read the
    stored rows instead of recomputing the aggregate twice.
    """
    if materialize:
        df = cut_lineage(df)
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary")),
                F.lit(8 * len(df.columns)))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df


def assert_unique_keys(df: DataFrame, keys) -> None:
    """Raise if ``keys`` repeat (a left join on them would fan out rows)."""
    keys = _names(keys)
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"join keys {keys} are not unique, e.g. {dup[0].asDict()}")


def left_join(left: DataFrame, right: DataFrame, on, suffixes=("_x", "_y"),
              max_broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
              null_safe: bool = False, materialize: bool = True) -> DataFrame:
    """``left.merge(right, on=on, how='left')``.

    Non-key columns present on both sides get ``suffixes``.  ``null_safe`` makes
    NULL keys match each other (pandas behaviour); the default keeps SQL semantics.
    """
    keys = _names(on)
    both = [c for c in right.columns if c in left.columns and c not in keys]
    if both:
        left = left.withColumnsRenamed({c: c + suffixes[0] for c in both})
        right = right.withColumnsRenamed({c: c + suffixes[1] for c in both})
    if max_broadcast_rows:
        right = bounded_broadcast(right, max_broadcast_rows, materialize)
    if not null_safe:
        return left.join(right, keys, "left")
    r = right.withColumnsRenamed({k: "_r_" + k for k in keys})
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r["_r_" + k])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*["_r_" + k for k in keys])


def join_environment(surv: DataFrame, env: DataFrame, on="date", **kw) -> DataFrame:
    """Surveillance LEFT JOIN environment ON date."""
    return left_join(surv, env, on, **kw)


def join_social(df: DataFrame, social_daily: DataFrame, on="date", **kw) -> DataFrame:
    """LEFT JOIN daily social features ON date."""
    return left_join(df, social_daily, on, **kw)


def attach_by_key(df: DataFrame, other: DataFrame, key: str, cols) -> DataFrame:
    """Attach ``cols`` of ``other`` by an explicit row key (never by position)."""
    return df.join(other.select(key, *_names(cols)), [key], "left")
