"""Daily social roll-up over a stream of landed post files.

Collectors land post files continuously, in any order of days; the same per-day
aggregates as the batch ``daily_social_agg`` are maintained as streaming state.  The
state is one row per day, so it needs no watermark to stay small, and without one
no post is ever too late.  Each micro-batch upserts the changed days into a Parquet folder; the current table is
the latest version of every day.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episcope.functions.numeric import round_half_up
from episcope.session import ensure_checkpoint_dir

POST_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("platform", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("polarity", T.DoubleType()),
    T.StructField("subjectivity", T.DoubleType()), T.StructField("engagement_score", T.DoubleType()),
])


def daily_social_stream(spark: SparkSession, source_dir: str, schema: T.StructType = POST_SCHEMA,
                        fmt: str = "parquet", max_files: int = 1000) -> DataFrame:
    """Streaming per-day aggregates (same columns as the batch roll-up, unrounded).

    ``created_at`` is a wall-clock time (TIMESTAMP_NTZ).  The event time of the day windows
    is that wall clock read as UTC, built from its date and time-of-day parts, so
    days are calendar days whatever the session time zone.  ``max_files`` bounds a
    micro-batch, not the result.
    """
    s = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files).load(source_dir)
    ts = F.col("created_at")
    secs = (F.unix_date(F.to_date(ts)).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
            + F.second(ts))
    s = s.withColumn("event_time", F.timestamp_seconds(secs))
    return (s.groupBy(F.window("event_time", "1 day").alias("w"))
            .agg(F.avg("polarity").alias("polarity_mean"), F.stddev_samp("polarity").alias("polarity_std"),
                 F.min("polarity").alias("polarity_min"), F.max("polarity").alias("polarity_max"),
                 F.avg("subjectivity").alias("subjectivity_mean"),
                 F.stddev_samp("subjectivity").alias("subjectivity_std"),
                 F.sum("engagement_score").alias("engagement_score_sum"),
                 F.avg("engagement_score").alias("engagement_score_mean"),
                 F.max("engagement_score").alias("engagement_score_max"),
                 F.count("id").alias("id_count")))


def run_daily_social(spark: SparkSession, source_dir: str, out_dir: str | None = None,
                     checkpoint: str | None = None, **kw) -> str:
    """Process every available file (``availableNow``) and upsert days into ``out_dir``."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    tag = uuid.uuid4().hex
    out_dir = out_dir or f"{root}/episcope-stream-out-{tag}"
    checkpoint = checkpoint or f"{root}/episcope-stream-state-{tag}"

    def upsert(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out_dir)

    q = (daily_social_stream(spark, source_dir, **kw).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint).foreachBatch(upsert).trigger(availableNow=True).start())
    q.awaitTermination()
    return out_dir


def latest_daily_rows(spark: SparkSession, out_dir: str, digits: int = 4) -> DataFrame:
    """Current table: the newest version of each day, rounded like the batch roll-up."""
    x = spark.read.parquet(out_dir)
    vals = [c for c in x.columns if c not in ("w", "batch_id")]
    day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("w.start")) / 86400).cast("int"))
    latest = x.groupBy(day.alias("date")).agg(F.max_by(F.struct(*vals), F.col("batch_id")).alias("v"))
    out = latest.select("date", "v.*")
    return out.withColumns({c: round_half_up(c, digits) for c in vals if c != "id_count"})
