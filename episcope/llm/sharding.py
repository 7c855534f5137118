"""Proportional stratified interleaving: every shard holds each source in its overall share.

Rows are shuffled by a seeded hash inside their source and ranked there; a row's place is
its fractional rank ``(rank - u) / n`` in its source (``u``: the source's seeded offset in
(0, 1), so that many small sources do not pile up at one fraction).  All rows in the order
of that place are cut into ``shards`` runs whose lengths differ by one at most.

Neither rank needs a group in one task.  Inside a source the hash is cut into ranges, the
rows of (source, range) are numbered, and the counts of earlier ranges are added; the same
is done for the place, whose ranges are even whatever the source sizes are.  Range tables
have one row per (source, range); their number follows the row count.

DataFrame functions only.  A null source is a stratum of its own; null keys and repeated
rows (ordered by all columns that are carried) are kept; an empty table gives no rows; extra
columns are carried unless named shard, slot or starting with ``_si_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from episcope.llm.common import cut

HASH_HEX = 13           # hex digits of md5 read as a number: 52 bits, exact as a double
ROWS_PER_RANGE = 1_000_000
LEAST_RANGES = 256


def _unit(col: Column) -> Column:
    """A text's md5 as a double in (0, 1)."""
    return (F.conv(F.substring(F.md5(col), 1, HASH_HEX), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(16 ** HASH_HEX))


def _ranked(df: DataFrame, strata: list[str], place: str, order: list, ranges: int, out: str) -> DataFrame:
    """``out``: the 0-based rank by (``place`` in [0, 1), ``order``) inside the strata."""
    df = df.withColumn("_si_r", F.least(F.floor(F.col(place) * ranges), F.lit(ranges - 1)).cast("long"))
    counts = df.groupBy(*strata, "_si_r").agg(F.count(F.lit(1)).alias("_si_n"))
    before = Window.partitionBy(*strata).orderBy("_si_r").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*[F.col(s).alias(f"_si_c_{s}") for s in strata], F.col("_si_r").alias("_si_c_r"),
                           F.coalesce(F.sum("_si_n").over(before), F.lit(0)).alias("_si_carry"))
    own = F.row_number().over(Window.partitionBy(*strata, "_si_r").orderBy(place, *order)) - 1
    on = [F.col("_si_r") == F.col("_si_c_r")] + [F.col(s).eqNullSafe(F.col(f"_si_c_{s}")) for s in strata]
    # numbered after the join: the join keys are the window's, so one exchange of the rows serves both
    joined = df.join(counts, on)
    return joined.withColumn(out, F.col("_si_carry") + own).drop(*counts.columns, "_si_r")


def interleave(df: DataFrame, source: str = "source", key: str = "doc_id", shards: int = 40, seed: int = 7) -> DataFrame:
    """``df`` with shard (0 to ``shards`` - 1) and slot (gapless from 0 in each shard)."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    cols = [c for c in df.columns if c not in ("shard", "slot") and not c.startswith("_si_")]
    rows = cut(df.select(*cols, F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_si_s"),
                         F.col(source).isNull().alias("_si_null"),
                         _unit(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")))).alias("_si_h")),
               "interleave")
    total = rows.count()
    ranges = max(LEAST_RANGES, -(-total // ROWS_PER_RANGE))
    sizes = rows.groupBy("_si_s", "_si_null").agg(F.count(F.lit(1)).alias("_si_size"))
    strata, ties = ["_si_s", "_si_null"], [key, *[c for c, t in df.select(*cols).dtypes if c != key and not t.startswith("map")]]
    ranked = _ranked(rows, strata, "_si_h", ties, ranges, "_si_rank")
    sizes = sizes.select(F.col("_si_s").alias("_si_z_s"), F.col("_si_null").alias("_si_z_null"), "_si_size")
    placed = ranked.join(sizes, [F.col("_si_s") == F.col("_si_z_s"), F.col("_si_null") == F.col("_si_z_null")])
    u = _unit(F.concat_ws(":", F.lit(str(seed)), F.col("_si_null").cast("int"), F.col("_si_s")))
    placed = placed.withColumn("_si_f", (F.col("_si_rank") + 1 - u) / F.col("_si_size"))
    ordered = _ranked(placed, [], "_si_f", ["_si_s", "_si_null", "_si_rank"], ranges, "_si_pos")
    # exact in long arithmetic: shard s holds the positions from ceil(s * n / shards) on
    shard = F.expr(f"(_si_pos * {shards}L) div {max(total, 1)}L")
    first = F.expr(f"(((_si_pos * {shards}L) div {max(total, 1)}L) * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    return ordered.select(*cols, shard.cast("int").alias("shard"), (F.col("_si_pos") - first).cast("long").alias("slot"))
