"""Label codes by rank, fitted once and kept: the sorted dictionary of a column is a table that is written
beside a model and looked up when new rows are scored."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from episcope.operators.joins import bounded_broadcast
from episcope.operators.ordering import RN, series_ordinal
from episcope.session import cut_lineage

MAX_ONE_TASK = 100_000       # distinct values that one task ranks


@dataclass
class RankEncoder:
    """``col`` -> ``out``: 0-based rank of the value among the sorted distinct values of the fitted rows."""
    col: str
    out: str
    codes: DataFrame         # (value, code), written

    @classmethod
    def fit(cls, df: DataFrame, col: str, out: str | None = None) -> RankEncoder:
        """The distinct values (a category list) are found map-side and written; up to MAX_ONE_TASK of them are
        ranked in one task, more by range buckets.  NULL has no code."""
        values = cut_lineage(df.select(F.col(col).alias("value")).where("value is not null").distinct(), "values")
        if values.limit(MAX_ONE_TASK + 1).count() <= MAX_ONE_TASK:
            codes = values.withColumn("code", (F.row_number().over(Window.orderBy("value")) - 1).cast("int"))
        else:
            codes = series_ordinal(values, [], ["value"], stable=True).select("value", (F.col(RN) - 1).cast("int").alias("code"))
        return cls(col, out or f"{col}_encoded", cut_lineage(codes, "codes"))

    def transform(self, df: DataFrame, unseen: str | int = "error") -> DataFrame:
        """``df`` with ``out``.  A value without a code is an error when the rows are computed, or gets NULL
        (``unseen="null"``) or the given code.  NULL stays NULL.  A hot value never meets a sort-merge join as
        long as the dictionary passes the size check."""
        codes = self.codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        out = df.join(bounded_broadcast(codes), F.col(self.col) == F.col("_value"), "left")
        code = F.col("_code")
        if unseen != "null":
            other = F.raise_error(F.concat(F.lit(f"{self.col} has a value that the encoder has not seen: "), F.col(self.col).cast("string"))).cast("int") \
                if unseen == "error" else F.lit(int(unseen))
            code = F.when(F.col(self.col).isNotNull(), F.when(F.col("_value").isNull(), other).otherwise(code))
        return out.withColumn(self.out, code).drop("_value", "_code")

    def save(self, path: str) -> None:
        self.codes.select("value", "code", F.lit(self.col).alias("col"), F.lit(self.out).alias("out")) \
            .write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RankEncoder | None:
        """The saved encoder (None if it was fitted on no value)."""
        saved = spark.read.parquet(path)
        names = saved.select("col", "out").first()
        return cls(names["col"], names["out"], saved.select("value", "code")) if names else None


def encode_rank(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Fit a :class:`RankEncoder` on the rows and apply it to them.  NULL keeps NULL."""
    return RankEncoder.fit(df, col, out).transform(df, unseen="null")
