"""Readers and writers for the landed files (CSV posts / surveillance, JSON health
data, OWID CSV) and the result sinks.  Every reader takes an explicit schema; no
schema inference on the data path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episcope.functions.calendar import week_to_date
from episcope.functions.text import parse_list_literal
from episcope.sources import ranges

# Text tokens pandas reads as missing by default (subset used here).
NA_TOKENS = ["", "NA", "N/A", "n/a", "NaN", "nan", "null", "NULL", "None", "#N/A", "<NA>", "-NaN", "-nan"]

SOCIAL_CSV_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("platform", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("raw_text", T.StringType()),
    T.StructField("created_at", T.StringType()), T.StructField("engagement_score", T.DoubleType()),
    T.StructField("author", T.StringType()), T.StructField("polarity", T.DoubleType()),
    T.StructField("subjectivity", T.DoubleType()), T.StructField("symptoms", T.StringType()),
])

SURVEILLANCE_CSV_SCHEMA = T.StructType([
    T.StructField("disease", T.StringType()), T.StructField("week", T.IntegerType()),
    T.StructField("year", T.IntegerType()), T.StructField("cases", T.LongType()),
    T.StructField("deaths", T.LongType()), T.StructField("hospitalizations", T.LongType()),
    T.StructField("region", T.StringType()), T.StructField("country_code", T.StringType()),
    T.StructField("who_region", T.StringType()), T.StructField("data_quality", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("outbreak", T.IntegerType()), T.StructField("outbreak_threshold", T.DoubleType()),
])

ENVIRONMENT_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("temperature", T.DoubleType()),
    T.StructField("humidity", T.DoubleType()), T.StructField("precipitation", T.DoubleType()),
    T.StructField("air_quality_index", T.DoubleType()), T.StructField("uv_index", T.DoubleType()),
    T.StructField("source", T.StringType()),
])

SURVEILLANCE_JSON_SCHEMA = T.StructType([
    T.StructField("disease", T.StringType()), T.StructField("week", T.IntegerType()),
    T.StructField("year", T.IntegerType()), T.StructField("cases", T.LongType()),
    T.StructField("deaths", T.LongType()), T.StructField("hospitalizations", T.LongType()),
    T.StructField("region", T.StringType()), T.StructField("data_quality", T.StringType()),
    T.StructField("source", T.StringType()),
])


def normalize_missing(df: DataFrame, cols=None, tokens=None) -> DataFrame:
    """String cells equal to a missing-value token become NULL."""
    toks = NA_TOKENS if tokens is None else tokens
    cols = cols or [c for c, t in df.dtypes if t == "string"]
    return df.withColumns({c: F.when(F.col(c).isin(toks), F.lit(None)).otherwise(F.col(c)) for c in cols})


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Columns are matched by header name (any order, missing ones NULL), then typed.

    Cells that do not parse as the field type, and NaN, become NULL.  All files of one path must have
    one header; a file with another order or other columns is an error, never a silent shift of
    columns (read such files path by path).  ``multi_line`` allows line breaks in cells and a header of its
    own for each file (:mod:`episcope.sources.ranges`; a file is still read by many tasks).
    """
    if multi_line:
        raw = ranges.read_csv(spark, path, [f.name for f in schema.fields])
    else:
        opts = {"header": True, "escape": '"'}
        names = spark.read.options(**opts, inferSchema=False).csv(path).columns
        raw = spark.read.options(**opts, enforceSchema=False) \
            .schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).csv(path)
    have = set(raw.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f"`{f.name}`")
            v = c if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                v = F.when(~F.isnan(v), v)
            cols.append(v.alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def utc_wall_clock(text) -> Column:
    """Time text -> TIMESTAMP_NTZ in UTC: a trailing offset (``+02:00``) is taken off, no offset
    or ``Z`` is UTC already, text that is no time gives NULL."""
    c = F.trim(text)
    offset = r"([+-])(\d{2}):?(\d{2})$"
    is_off = c.rlike(r"\d:\d{2}(:\d{2}(\.\d+)?)?\s*[+-]\d{2}:?\d{2}$")
    wall = F.regexp_replace(F.when(is_off, F.regexp_replace(c, offset, "")).otherwise(c), r"\s*Z$", "").try_cast("timestamp_ntz")
    part = lambda i: F.coalesce(F.regexp_extract(c, offset, i).try_cast("int"), F.lit(0))
    minutes = (part(2) * 60 + part(3)) * F.when(F.regexp_extract(c, offset, 1) == "-", -1).otherwise(1)
    return F.when(is_off, wall - F.make_dt_interval(mins=minutes)).otherwise(wall)


def read_social(spark: SparkSession, path: str, na_cols=("author", "platform")) -> DataFrame:
    """Posts CSV: ``created_at`` parsed (see :func:`utc_wall_clock`), ``symptoms`` list literal -> array<string>."""
    df = normalize_missing(_read_csv(spark, path, SOCIAL_CSV_SCHEMA, multi_line=True), list(na_cols))
    return (df.withColumn("created_at", utc_wall_clock(F.col("created_at")))
            .withColumn("symptoms", parse_list_literal("symptoms")))


def read_surveillance(spark: SparkSession, path: str,
                      na_cols=("deaths", "data_quality", "who_region", "source")) -> DataFrame:
    """Labelled surveillance CSV with ``date`` parsed to a date."""
    df = _read_csv(spark, path, SURVEILLANCE_CSV_SCHEMA)
    df = normalize_missing(df, [c for c, t in df.dtypes if t == "string" and c in na_cols])
    return df.withColumn("date", F.to_date(F.substring("date", 1, 10)))


def read_health_table(spark: SparkSession, root: str, key: str, schema: T.StructType) -> DataFrame:
    """One source of the health data set stored as JSON lines under ``root/key``
    (splittable: many tasks read it)."""
    return spark.read.schema(schema).json(f"{root.rstrip('/')}/{key}")


def read_health_document(spark: SparkSession, path: str, key: str, item_schema: T.StructType) -> DataFrame:
    """A JSON document ``{key: [records...], ...}`` (or a folder of them) -> rows of ``key``.  A document is
    read by as many tasks as it has byte ranges (:mod:`episcope.sources.ranges`); a record that does not
    parse gives a row of NULLs."""
    items = ranges.json_items(spark, path, key)
    return items.select(F.from_json("item", item_schema).alias("r")).select("r.*")


def read_environment(spark: SparkSession, root: str) -> DataFrame:
    env = read_health_table(spark, root, "environmental_data", ENVIRONMENT_SCHEMA)
    return env.withColumn("date", F.to_date(F.substring("date", 1, 10)))


def read_surveillance_json(spark: SparkSession, root: str, iso: bool = False) -> DataFrame:
    """Surveillance records; the date is the Monday of (year, week)."""
    s = read_health_table(spark, root, "surveillance_data", SURVEILLANCE_JSON_SCHEMA)
    return s.withColumn("date", week_to_date("year", "week", iso=iso))


OWID_SCHEMA = T.StructType([
    T.StructField("location", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("new_cases", T.DoubleType()), T.StructField("new_deaths", T.DoubleType()),
])


def read_covid(spark: SparkSession, path: str, countries=None, schema: T.StructType = OWID_SCHEMA) -> DataFrame:
    """OWID CSV, optional ``location`` membership filter (pushed to the scan), tagged ``source='OWID'``."""
    df = _read_csv(spark, path, schema)
    if countries is not None:
        df = df.where(F.col("location").isin(list(countries)))
    return df.withColumn("date", F.to_date("date")).withColumn("source", F.lit("OWID"))


def write_table(df: DataFrame, path: str) -> None:
    """CSV with header and no index; arrays become list literals (CSV has no array type)."""
    out = df
    for c, t in df.dtypes:
        if t.startswith("array"):
            out = out.withColumn(c, F.concat(F.lit("["), F.array_join(
                F.transform(c, lambda x: F.concat(F.lit("'"), F.regexp_replace(x, r"(['\\\\])", r"\\$1"), F.lit("'"))), ", "), F.lit("]")))
        elif t.startswith(("struct", "map")):
            out = out.withColumn(c, F.to_json(c))
    (out.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


def write_report(report: DataFrame, path: str) -> None:
    """A (one-row, nested) report as JSON; dates are written as ISO strings."""
    report.coalesce(1).write.mode("overwrite").option("dateFormat", "yyyy-MM-dd").json(path)


def combine_sources(sources: dict[str, DataFrame], root: str, caps: dict | None = None,
                    order: dict | None = None) -> dict[str, str]:
    """Store each source of the health data set as its own JSON-lines folder.

    ``caps`` limits a source to its first n rows of ``order`` (the OWID cap of 1000);
    no source is gathered into one record or one task.
    """
    paths = {}
    for key, df in sources.items():
        out = df
        if caps and key in caps:
            out = out.orderBy(*(order or {}).get(key, df.columns[:1])).limit(int(caps[key]))
        p = f"{root.rstrip('/')}/{key}"
        out.write.mode("overwrite").option("dateFormat", "yyyy-MM-dd").json(p)
        paths[key] = p
    return paths
