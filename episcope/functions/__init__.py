"""Column expressions: calendar parts, text cleaning, numeric helpers."""

from episcope.functions.calendar import (  # noqa: F401
    calendar_features, day_of_year, lookback_start, month, month_name, quarter,
    season_code, season_name, span_years, truncate_day, week_of_year,
    week_to_date, year_to_date,
)
from episcope.functions.numeric import (  # noqa: F401
    round_half_up, safe_div, to_numeric_or_zero,
)
from episcope.functions.text import (  # noqa: F401
    HEALTH_KEYWORDS, clean_text, contains_any, engagement_score,
    extract_keywords, parse_list_literal,
)
