"""Set operations: the post union and distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episcope.functions.text import clean_text, extract_keywords
from episcope.operators.sentiment import lexicon_sentiment


def union_posts(tweets: DataFrame, reddit: DataFrame, keywords=None, lexicon=None) -> DataFrame:
    """Normalised tweets + reddit posts -> one post table with cleaned text,
    sentiment and symptoms (id, platform, text, raw_text, created_at,
    engagement_score, author, polarity, subjectivity, symptoms)."""
    t = tweets.select(F.col("id").cast("string").alias("id"), F.lit("twitter").alias("platform"),
                      F.col("text").alias("raw_text"), F.col("created_at").cast("timestamp_ntz").alias("created_at"),
                      (F.coalesce("like_count", F.lit(0)) + F.coalesce("retweet_count", F.lit(0)))
                      .cast("long").alias("engagement_score"),
                      F.col("author_id").cast("string").alias("author"))
    r = reddit.select(F.col("id").cast("string").alias("id"), F.lit("reddit").alias("platform"),
                      F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("text", F.lit("")))
                      .alias("raw_text"),
                      F.col("created_utc").cast("timestamp_ntz").alias("created_at"),
                      F.col("score").cast("long").alias("engagement_score"), F.col("author").cast("string"))
    u = t.unionByName(r).withColumn("text", clean_text("raw_text"))
    u = lexicon_sentiment(u, "text", lexicon)
    return u.withColumn("symptoms", extract_keywords("text", keywords))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct()
