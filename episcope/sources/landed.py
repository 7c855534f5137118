"""Shaping of landed API payloads (JSON files written by collectors) into tables.

The reference calls web APIs; here the payloads are files already landed in
storage, read with ``spark.read.json`` and flattened with built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from episcope.functions.text import contains_any


def flatten_indicators(payload: DataFrame, indicator: str, source: str = "WHO") -> DataFrame:
    """``value: array<struct<SpatialDim, TimeDim, NumericValue, Value>>`` -> one row per item."""
    items = payload.select(F.explode("value").alias("v"))
    return items.select(F.lit(indicator).alias("indicator"), F.col("v.SpatialDim").alias("country"),
                        F.col("v.TimeDim").alias("year"), F.col("v.NumericValue").alias("value"),
                        F.col("v.Value").alias("display_value"), F.lit(source).alias("source"))


def normalize_tweets(tweets: DataFrame, as_of=None, days_back: int = 7,
                     max_results: int | None = None) -> DataFrame:
    """Flatten ``public_metrics``; keep tweets in ``[as_of - days_back, as_of]``; optional cap.

    ``as_of`` is a parameter (a timestamp), never the wall clock.  The cap keeps
    the newest ``max_results`` tweets (a top-n: each task keeps n rows).
    """
    t = tweets.select(
        F.col("id").cast("string").alias("id"), "text", F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("public_metrics.retweet_count").alias("retweet_count"),
        F.col("public_metrics.like_count").alias("like_count"),
        F.col("public_metrics.reply_count").alias("reply_count"),
        F.col("public_metrics.quote_count").alias("quote_count"),
        F.col("author_id").cast("string").alias("author_id"), F.lit("twitter").alias("source"))
    if as_of is not None:
        end = F.lit(as_of).cast("timestamp_ntz")
        t = t.where(F.col("created_at").between(end - F.expr(f"INTERVAL {int(days_back)} DAYS"), end))
    if max_results is not None:
        t = t.orderBy(F.col("created_at").desc(), F.col("id")).limit(int(max_results))
    return t


def top_k_per_group(df: DataFrame, group: str, order, k: int) -> DataFrame:
    """First ``k`` rows of each group in ``order``.  Spark limits the rank inside each task before the shuffle
    (WindowGroupLimit, partial), so a hot group sends at most ``k`` rows a task, whatever its share of the rows."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def normalize_reddit(posts: DataFrame, keywords=None, limit: int | None = None) -> DataFrame:
    """Keep posts whose title or body holds a keyword; epoch -> timestamp; NULL author -> 'deleted'.

    ``limit`` keeps the newest ``limit`` posts per subreddit (``subreddit.new(limit)``).
    """
    p = posts.where(contains_any(["title", "selftext"], keywords))
    if limit is not None:
        p = top_k_per_group(p, "subreddit", [F.col("created_utc").desc(), F.col("id")], int(limit))
    return p.select(
        F.col("id").cast("string").alias("id"), "title", F.col("selftext").alias("text"), "score",
        "upvote_ratio", "num_comments",
        F.timestamp_seconds(F.col("created_utc")).cast("timestamp_ntz").alias("created_utc"),
        "subreddit", F.coalesce(F.col("author").cast("string"), F.lit("deleted")).alias("author"),
        F.lit("reddit").alias("source"))
