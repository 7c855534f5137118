"""Domain tables derived by Spark from the supplied TPC-H-like parquet tables.

The reference's raw files are not available, so every query runs on proxies whose
work grows with the supplied tables:

* surveillance  orders x customer x nation x region, weekly counts per
                (order priority = disease, region)
* environment   lineitem rolled up per ship day
* social        events (one post per event), dates shifted into the surveillance span,
                text from the document with the same id
* scored        labels x documents: a 0/1 label and a length-based score

Each builder has a SQL twin in ``episcope.sources.proxy_sql`` for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episcope.functions.text import clean_text, extract_keywords
from episcope.operators.joins import bounded_broadcast

# Whole weeks that move the event clock (2024) into the surveillance span.
SOCIAL_SHIFT_DAYS = 10591
# Keywords that occur in the supplied documents (the health keywords do not).
PROXY_KEYWORDS = ["tion", "the", "er", "ou", "sch"]
# Length at which the proxy score saturates.
SCORE_CHARS = 20000.0

DIM_ROWS = 100_000  # nation x region is a fixed-size dimension; checked, not assumed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def surveillance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """disease, region, date (Monday), cases, deaths, hospitalizations."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = bounded_broadcast(n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name"), DIM_ROWS)
    cust = c.join(geo, c.c_nationkey == geo.n_nationkey).select("c_custkey", "r_name")
    j = o.join(cust, o.o_custkey == cust.c_custkey)
    return (j.groupBy(F.col("o_orderpriority").alias("disease"), F.col("r_name").alias("region"),
                      F.to_date(F.date_trunc("week", "o_orderdate")).alias("date"))
            .agg(F.count(F.lit(1)).alias("cases"),
                 F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).cast("long").alias("deaths"),
                 F.sum(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).cast("long").alias("hospitalizations")))


def environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, temperature, humidity, precipitation, air_quality_index, uv_index (one row per day)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.to_date("l_shipdate").alias("date"))
            .agg(F.avg("l_quantity").alias("temperature"),
                 (F.avg("l_discount") * 100).alias("humidity"),
                 (F.avg("l_tax") * 100).alias("precipitation"),
                 (F.avg("l_extendedprice") / 1000).alias("air_quality_index"),
                 F.count(F.lit(1)).alias("uv_index")))


def social(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, platform, created_at, polarity, subjectivity, engagement_score."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"), F.col("event_type").alias("platform"),
                    (F.col("ts") - F.expr(f"INTERVAL {SOCIAL_SHIFT_DAYS} DAYS")).alias("created_at"),
                    ((F.col("value") - 50) / 50).alias("polarity"),
                    (F.col("value") / 100).alias("subjectivity"),
                    F.col("value").alias("engagement_score"))


def social_with_text(spark: SparkSession, sf_dir: str, keywords=None) -> DataFrame:
    """``social`` plus ``raw_text``, cleaned ``text`` and ``symptoms`` from the document
    whose id equals the event id (posts without a document have NULL text)."""
    # Text tables are never broadcast: the shuffle join also spreads the text work
    # (cleaning, keyword search) over the shuffle partitions.
    d = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.col("text").alias("raw_text")).hint("merge")
    s = social(spark, sf_dir)
    j = s.join(d, s.id == d.doc_id, "left").drop("doc_id")
    return (j.withColumn("text", clean_text("raw_text"))
            .withColumn("symptoms", extract_keywords("text", keywords or PROXY_KEYWORDS)))


def posts_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text of every document."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, label (quality), score (length based), prediction (score > 0.5)."""
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = lab.join(doc, "doc_id")
    score = F.least(F.col("n_chars") / F.lit(SCORE_CHARS), F.lit(1.0))
    return j.select("doc_id", F.col("quality").cast("int").alias("label"), score.alias("score"),
                    (score > 0.5).cast("int").alias("prediction"))


def tweet_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed-tweet shape: each document is a tweet, enriched by the event with its id."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text").hint("merge")
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    j = d.join(e, d.doc_id == e.event_id)
    return j.select(F.col("doc_id").alias("id"), "text",
                    (F.col("ts") - F.expr(f"INTERVAL {SOCIAL_SHIFT_DAYS} DAYS")).alias("created_at"),
                    F.struct(F.floor("value").cast("long").alias("retweet_count"),
                             F.col("user_id").alias("like_count"), F.lit(0).cast("long").alias("reply_count"),
                             F.lit(0).cast("long").alias("quote_count")).alias("public_metrics"),
                    F.col("user_id").alias("author_id"))


def reddit_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed-reddit shape: each conversation turn is a post, enriched by the event
    with the conversation's id (its type is the subreddit)."""
    c = table(spark, sf_dir, "conversations").hint("merge")
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "event_type")
    j = c.join(e, c.conv_id == e.event_id)
    shifted = (F.col("ts") - F.expr(f"INTERVAL {SOCIAL_SHIFT_DAYS} DAYS")).cast("timestamp")
    return j.select(F.concat(F.lit("r"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string")).alias("id"),
                    F.col("role").alias("title"), F.col("text").alias("selftext"),
                    F.col("turn").alias("score"), (F.col("value") / 500).alias("upvote_ratio"),
                    F.col("turn").alias("num_comments"),
                    (F.unix_seconds(shifted) + F.col("turn")).cast("double").alias("created_utc"),
                    F.col("event_type").alias("subreddit"),
                    F.when(F.col("role") == "user", F.col("user_id").cast("string")).alias("author"))
