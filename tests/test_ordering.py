"""Skew-safe order operators agree with the plain window / pandas on seeded data."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from episcope.operators import windows as W
from episcope.operators.ordering import running_totals, series_ordinal


def _series(spark, n=600, seed=7):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "disease": rng.choice(["a", "b", "Z"], n, p=[0.7, 0.2, 0.1]),
        "date": pd.to_datetime("2020-01-01") + pd.to_timedelta(rng.integers(0, 200, n), unit="D"),
        "rid": np.arange(n),
        "cases": rng.integers(0, 100, n).astype(float),
    })
    pdf.loc[rng.random(n) < 0.6, "cases"] = np.nan
    return pdf, spark.createDataFrame(pdf).withColumn("date", F.to_date("date"))


def test_series_ordinal_matches_row_number(spark):
    _, df = _series(spark)
    got = series_ordinal(df, ["disease"], ["date", "rid"], buckets=5)
    w = Window.partitionBy("disease").orderBy("date", "rid")
    exp = df.withColumn("_rn", F.row_number().over(w))
    assert got.select("rid", "_rn").exceptAll(exp.select("rid", "_rn")).count() == 0
    assert got.count() == df.count()


def test_hot_series_window_equals_plain_window(spark):
    _, df = _series(spark)
    specs = [W.lag("l1", "cases", 1), W.lag("l3", "cases", 3), W.rolling_mean("m4", "cases", 4),
             W.rolling_std("s4", "cases", 4), W.diff("d1", "cases"), W.centered_mean("c7", "cases", 7),
             W.diff("c7d", "c7"), W.lead("n1", "cases", 1)]
    hot = W.series_window(df, ["disease"], ["date", "rid"], specs, split_hot=True, bucket_rows=16, buckets=6)
    plain = W.series_window(df, ["disease"], ["date", "rid"], specs, split_hot=False)
    cols = ["rid"] + [s.name for s in specs]
    a = sorted(tuple(r) for r in hot.select(*cols).collect())
    b = sorted(tuple(r) for r in plain.select(*cols).collect())
    assert len(a) == len(b) == 600
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            assert (u is None and v is None) or abs(u - v) < 1e-9


def test_rolling_matches_pandas(spark):
    pdf, df = _series(spark)
    pdf = pdf.sort_values(["disease", "date", "rid"])
    g = pdf.groupby("disease")["cases"]
    pdf["m4"] = g.transform(lambda s: s.rolling(4).mean())
    pdf["l2"] = g.shift(2)
    got = W.series_window(df, ["disease"], ["date", "rid"],
                          [W.rolling_mean("m4", "cases", 4), W.lag("l2", "cases", 2)], bucket_rows=32).toPandas()
    m = pdf.merge(got, on="rid", suffixes=("", "_s"))
    assert np.allclose(m["m4"], m["m4_s"].astype(float), equal_nan=True)
    assert np.allclose(m["l2"], m["l2_s"].astype(float), equal_nan=True)


def test_forward_fill_global_matches_pandas(spark):
    pdf, df = _series(spark)
    pdf = pdf.sort_values(["date", "disease", "rid"])
    exp = pdf.assign(cases=pdf["cases"].ffill().fillna(0))
    got = W.forward_fill(df, ["cases"], ["date", "disease", "rid"], fill_value=0, buckets=7).toPandas()
    m = exp.merge(got, on="rid", suffixes=("", "_s"))
    assert np.allclose(m["cases"], m["cases_s"])


def test_forward_fill_partitioned(spark):
    pdf, df = _series(spark)
    pdf = pdf.sort_values(["disease", "date", "rid"])
    exp = pdf.assign(cases=pdf.groupby("disease")["cases"].ffill())
    got = W.forward_fill(df, ["cases"], ["date", "rid"], partition_by=["disease"], buckets=4).toPandas()
    m = exp.merge(got, on="rid", suffixes=("", "_s"))
    assert np.allclose(m["cases"], m["cases_s"].astype(float), equal_nan=True)


def test_running_totals(spark):
    df = spark.range(0, 500).withColumn("v", F.col("id") % 7)
    got = running_totals(df, ["id"], ["v"], buckets=9).orderBy("id").toPandas()
    assert list(got["v_cum"]) == list(np.cumsum([i % 7 for i in range(500)]))


def test_resample_daily_interpolate(spark):
    df = spark.createDataFrame([("x", "2020-01-06", 10.0), ("x", "2020-01-13", 24.0), ("x", "2020-01-27", 3.0)],
                               "k string, d string, v double").withColumn("date", F.to_date("d")).drop("d")
    out = W.resample_daily_interpolate(df, ["k"], "date", ["v"]).orderBy("date").toPandas()
    s = pd.Series([10.0, 24.0, 3.0], index=pd.to_datetime(["2020-01-06", "2020-01-13", "2020-01-27"]))
    exp = s.resample("D").interpolate()
    assert len(out) == len(exp) == 22
    assert np.allclose(out["v"].values, exp.values)


def test_every_nth(spark):
    df = spark.range(0, 50)
    got = sorted(r.id for r in W.every_nth(df, ["id"], 7).collect())
    assert got == list(range(0, 50, 7))
