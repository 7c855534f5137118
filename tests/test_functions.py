"""Scalar functions against Python/pandas references on small fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from episcope.functions import calendar as cal
from episcope.functions.text import clean_text, extract_keywords, parse_list_literal


# (text, cleaned text), stated by hand
CLEANED = [
    ("Visit http://x.com/a?b now @user #tag ok", "visit now ok"),
    ("@José said #ça va\tbien", "said va bien"),
    ("a\u00a0b\u200bc  d", "a b\u200bc d"),
    ("", ""),
    ("https://t.co/xyz", ""),
    ("www.example.org and text", "and text"),
    ("Feeling sick with fever and cough. Is this flu season starting early?",
     "feeling sick with fever and cough. is this flu season starting early?"),
]


def test_clean_text(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CLEANED)], "id int, text string")
    got = {r.id: r.c for r in df.select("id", clean_text("text").alias("c")).collect()}
    assert [got[i] for i in range(len(CLEANED))] == [c for _, c in CLEANED]


def test_worked_record(spark):
    df = spark.createDataFrame([(CLEANED[-1][0],)], "text string")
    r = df.select(extract_keywords(clean_text("text")).alias("k")).first()
    assert r.k == ["fever", "cough", "flu", "sick"]


def test_parse_list_literal(spark):
    df = spark.createDataFrame([("['fever', 'sore throat']",), ("[]",), ("oops",), (None,),
                                ('["don\'t", \'a, b\']',), (r"['it\'s', 'x\\y']",), ("['open",)], "s string")
    got = [r.a for r in df.select(parse_list_literal("s").alias("a")).collect()]
    assert got == [["fever", "sore throat"], [], None, None, ["don't", "a, b"], ["it's", "x\\y"], None]


def test_week_to_date_matches_strptime(spark):
    rows = [(y, w) for y in range(1990, 2031) for w in range(1, 54)]
    df = spark.createDataFrame(rows, "y int, w int")
    got = {(r.y, r.w): r.d for r in df.select("y", "w", cal.week_to_date("y", "w").alias("d")).collect()}
    for (y, w), d in got.items():
        exp = dt.datetime.strptime(f"{y}-W{w}-1", "%Y-W%W-%w").date()
        assert d == exp, (y, w)


def test_iso_week_to_date(spark):
    rows = [(y, w) for y in range(1995, 2026) for w in (1, 10, 52)]
    df = spark.createDataFrame(rows, "y int, w int")
    for r in df.select("y", "w", cal.week_to_date("y", "w", iso=True).alias("d")).collect():
        assert r.d == dt.date.fromisocalendar(r.y, r.w, 1)


def test_calendar_and_season(spark):
    df = spark.createDataFrame([(dt.date(2020, m, 15),) for m in range(1, 13)], "date date")
    out = cal.calendar_features(df).withColumn("name", cal.season_name("date")).orderBy("date").collect()
    assert [r.season for r in out] == [0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 3, 0]
    assert out[0].name == "Winter" and out[6].name == "Summer"
    assert [r.week_of_year for r in out][:2] == [dt.date(2020, 1, 15).isocalendar()[1], dt.date(2020, 2, 15).isocalendar()[1]]


def test_health_features_from_dates_and_years(spark):
    dated = spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2023, 7, 4),)], "date date")
    got = sorted(tuple(r) for r in cal.health_features(dated).select("date", "month", "quarter", "day_of_year", "week_of_year", "season").collect())
    assert got == [(dt.date(2023, 7, 4), 7, 3, 185, 27, "Summer"), (dt.date(2024, 12, 30), 12, 4, 365, 1, "Winter")]
    yearly = spark.createDataFrame([(2020,)], "year int")
    assert cal.health_features(yearly).first()["date"] == dt.date(2020, 1, 1)
