"""Structured Streaming forms of the batch operators (posts arriving as files)."""

from episcope.streaming.posts import daily_social_stream, latest_daily_rows, run_daily_social  # noqa: F401
