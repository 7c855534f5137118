"""Readers / writers / streaming on small hand-made files."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from episcope.sources import files as IO
from episcope.sources import landed
from episcope.streaming import posts as STREAM


def test_read_social_header_order_and_missing_tokens(spark):
    d = tempfile.mkdtemp(prefix="episcope-csv-")
    path = os.path.join(d, "posts.csv")
    with open(path, "w") as f:
        f.write("created_at,id,platform,author,symptoms,polarity,text\n")
        f.write("2024-01-02 10:00:00,1,twitter,NA,\"['fever', 'cough']\",0.5,\"multi\nline\"\n")
        f.write("2024-01-03 11:30:00.250000,2,reddit,bob,oops,,plain\n")
    rows = {r.id: r for r in IO.read_social(spark, path).collect()}
    assert rows["1"].author is None and rows["1"].symptoms == ["fever", "cough"]
    assert rows["1"].text == "multi\nline"
    assert rows["2"].symptoms is None and rows["2"].polarity is None
    assert rows["2"].created_at == dt.datetime(2024, 1, 3, 11, 30, 0, 250000)


def test_read_social_nan_offsets_and_bad_times(spark):
    d = tempfile.mkdtemp(prefix="episcope-csv-")
    with open(os.path.join(d, "posts.csv"), "w") as f:
        f.write("id,created_at,polarity,engagement_score\n")
        f.write("1,2024-01-02 10:00:00+02:30,NaN,1\n2,2024-01-02T10:00:00Z,nan,2\n3,2024-01-02 23:30:00-01:00,0.25,NaN\n4,not a time,1e400,\n")
    rows = {r.id: r for r in IO.read_social(spark, d).collect()}
    assert rows["1"].created_at == dt.datetime(2024, 1, 2, 7, 30) and rows["1"].polarity is None
    assert rows["2"].created_at == dt.datetime(2024, 1, 2, 10, 0)
    assert rows["3"].created_at == dt.datetime(2024, 1, 3, 0, 30) and rows["3"].engagement_score is None
    assert rows["4"].created_at is None


def test_files_with_different_headers_are_an_error(spark):
    d = tempfile.mkdtemp(prefix="episcope-csv-")
    for name, text in (("a.csv", "disease,region,cases,deaths\nflu,US,2,1\n"), ("b.csv", "region,disease,deaths,cases\nUS,flu,1,20\n")):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    with pytest.raises(Exception, match="header"):
        IO.read_surveillance(spark, d).collect()
    r = IO.read_surveillance(spark, os.path.join(d, "b.csv")).first()
    assert (r.disease, r.region, r.cases, r.deaths) == ("flu", "US", 20, 1)


def test_list_cells_with_quotes_survive_the_csv(spark):
    d = tempfile.mkdtemp(prefix="episcope-csv-")
    df = spark.createDataFrame([("1", ["don't", 'say "hi"', "back\\slash", "a, b"])], "id string, symptoms array<string>")
    IO.write_table(df, d + "/out")
    assert IO.read_social(spark, d + "/out").first().symptoms == ["don't", 'say "hi"', "back\\slash", "a, b"]


def test_health_document_and_week_dates(spark):
    d = tempfile.mkdtemp(prefix="episcope-json-")
    doc = {"environmental_data": [{"date": "2024-01-01", "temperature": 20.5, "humidity": 60.0,
                                   "precipitation": 1.0, "air_quality_index": 40.0, "uv_index": 5.0,
                                   "source": "Environmental_API"}],
           "surveillance_data": [{"disease": "flu", "week": 2, "year": 2024, "cases": 10, "deaths": 0,
                                  "hospitalizations": 1, "region": "National", "data_quality": "Good",
                                  "source": "National_Surveillance"}]}
    path = os.path.join(d, "health.json")
    with open(path, "w") as f:
        json.dump(doc, f, indent=2)
    env = IO.read_health_document(spark, path, "environmental_data", IO.ENVIRONMENT_SCHEMA).collect()
    assert env[0].temperature == 20.5
    surv = IO.read_health_document(spark, path, "surveillance_data", IO.SURVEILLANCE_JSON_SCHEMA)
    r = surv.withColumn("date", IO.week_to_date("year", "week")).first()
    assert r.date == dt.datetime.strptime("2024-W2-1", "%Y-W%W-%w").date()


def test_normalize_reddit_keyword_cap_and_deleted(spark):
    rows = [(f"p{i}", "Fever again" if i % 2 == 0 else "nothing", "", i, 0.5, 1, float(1_700_000_000 + i),
             "medical", None if i == 0 else "u") for i in range(10)]
    df = spark.createDataFrame(rows, "id string, title string, selftext string, score long, upvote_ratio double, "
                                     "num_comments long, created_utc double, subreddit string, author string")
    out = landed.normalize_reddit(df, limit=3).orderBy(F.col("created_utc").desc()).collect()
    assert [r.id for r in out] == ["p8", "p6", "p4"]
    allp = landed.normalize_reddit(df).collect()
    assert {r.author for r in allp if r.id == "p0"} == {"deleted"} and len(allp) == 5


def test_stream_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="episcope-stream-")
    src = os.path.join(d, "in")
    base = dt.datetime(2024, 1, 1, 22, 0)
    rows = [(i, "x", base + dt.timedelta(hours=i), float(i % 5) / 5, 0.5, float(i)) for i in range(60)]
    spark.createDataFrame(rows, STREAM.POST_SCHEMA).write.parquet(src)
    out = STREAM.latest_daily_rows(spark, STREAM.run_daily_social(spark, src))
    got = {r.date: r.id_count for r in out.collect()}
    exp = {}
    for r in rows:
        exp[r[2].date()] = exp.get(r[2].date(), 0) + 1
    assert got == exp


def test_stream_loses_no_post_over_many_small_batches(spark):
    """Files of shuffled days, one file a batch: every post is counted."""
    d = tempfile.mkdtemp(prefix="episcope-stream-")
    src = os.path.join(d, "in")
    days = [5, 1, 9, 3, 2, 8, 1]
    for n, day in enumerate(days):
        rows = [(n * 100 + i, "x", dt.datetime(2024, 1, day, i), 0.1 * i, 0.5, float(i)) for i in range(10)]
        spark.createDataFrame(rows, STREAM.POST_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    out = STREAM.latest_daily_rows(spark, STREAM.run_daily_social(spark, src, max_files=1)).collect()
    assert {r.date.day: r.id_count for r in out} == {x: 10 * days.count(x) for x in days}


def test_stream_days_do_not_depend_on_session_zone(spark):
    d = tempfile.mkdtemp(prefix="episcope-stream-tz-")
    src = os.path.join(d, "in")
    base = dt.datetime(2024, 1, 1, 20, 0)
    rows = [(i, "x", base + dt.timedelta(hours=i), 0.1, 0.5, 1.0) for i in range(30)]
    spark.createDataFrame(rows, STREAM.POST_SCHEMA).write.parquet(src)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = {r.date: r.id_count for r in STREAM.latest_daily_rows(spark, STREAM.run_daily_social(spark, src)).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    exp = {}
    for r in rows:
        exp[r[2].date()] = exp.get(r[2].date(), 0) + 1
    assert got == exp
