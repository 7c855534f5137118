"""Calendar expressions (month, quarter, ISO week, season, week -> date)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Season names indexed by season code 0..3.
SEASON_NAMES = ["Winter", "Spring", "Summer", "Fall"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month(c) -> Column:
    return F.month(_c(c))


def quarter(c) -> Column:
    return F.quarter(_c(c))


def week_of_year(c) -> Column:
    """ISO-8601 week number (weeks start Monday, week 1 holds Jan 4th)."""
    return F.weekofyear(_c(c))


def day_of_year(c) -> Column:
    return F.dayofyear(_c(c))


def season_code(c) -> Column:
    """Dec-Feb 0, Mar-May 1, Jun-Aug 2, Sep-Nov 3 (from a date column)."""
    return F.floor(F.pmod(F.month(_c(c)), F.lit(12)) / 3).cast("int")


def season_name(c) -> Column:
    """Winter / Spring / Summer / Fall from a date column."""
    return F.element_at(F.array(*[F.lit(s) for s in SEASON_NAMES]), season_code(c) + 1)


def month_name(c) -> Column:
    """Three-letter English month name from a date column ('Jan' .. 'Dec')."""
    return F.date_format(_c(c), "MMM")


def calendar_features(df: DataFrame, date_col: str = "date") -> DataFrame:
    """month, quarter, week_of_year (ISO), day_of_year, season (code 0-3)."""
    d = F.col(date_col)
    return df.withColumns({
        "month": month(d),
        "quarter": quarter(d),
        "week_of_year": week_of_year(d),
        "day_of_year": day_of_year(d),
        "season": season_code(d),
    })


def week_to_date(year, week, iso: bool = False) -> Column:
    """Monday of a numbered week.

    ``iso=False`` follows ``strptime('%Y-W%W-%w')`` with weekday 1: week 1 starts on
    the first Monday of the year and week 0 is the Monday before it.
    ``iso=True`` uses ISO-8601 weeks (week 1 holds January 4th).
    """
    y, w = _c(year).cast("int"), _c(week).cast("int")
    if iso:
        jan4 = F.make_date(y, F.lit(1), F.lit(4))
        monday1 = F.date_sub(jan4, F.weekday(jan4))
    else:
        monday1 = F.next_day(F.date_sub(F.make_date(y, F.lit(1), F.lit(1)), 1), "Mon")
    return F.date_add(monday1, (w - 1) * 7)


def year_to_date(year) -> Column:
    """January 1st of ``year`` (rows that only carry a year)."""
    return F.make_date(_c(year).cast("int"), F.lit(1), F.lit(1))


def health_features(df: DataFrame, date_col: str = "date", year_col: str = "year") -> DataFrame:
    """Calendar features of health records: without a date column the date is January 1st of
    the year; then month, quarter, day_of_year, ISO week_of_year and the season's name."""
    if date_col not in df.columns:
        df = df.withColumn(date_col, year_to_date(year_col))
    out = calendar_features(df.withColumn(date_col, F.to_date(date_col)), date_col)
    return out.withColumn("season", season_name(date_col))


def truncate_day(c) -> Column:
    return F.to_date(_c(c))


def span_years(start, end) -> Column:
    """Length of [start, end] in years of 365.25 days."""
    return F.datediff(_c(end), _c(start)) / F.lit(365.25)


def lookback_start(as_of, days: int) -> Column:
    """``as_of`` minus ``days`` days; ``as_of`` is a parameter, never the wall clock."""
    a = F.lit(as_of) if not isinstance(as_of, Column) else as_of
    return a - F.expr(f"INTERVAL {int(days)} DAYS")
