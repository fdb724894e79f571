"""The window jobs over stored messages, as one batch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.operators.windows import (
    rising_snapshot,
    rising_tokens,
    rising_tokens_latest,
    top_snapshot,
    top_tokens,
    top_tokens_latest,
    traffic_counts,
    traffic_summary,
    window_posts,
    window_token_counts,
    window_top_tokens,
    windowed,
)
from pulse.schema import TRAFFIC_SNAPSHOT, StreamParams


def traffic(messages: DataFrame, p: StreamParams = StreamParams()) -> DataFrame:
    return traffic_summary(traffic_counts(messages, p.window), p.window)


def window_top(messages: DataFrame, p: StreamParams = StreamParams()) -> DataFrame:
    return window_top_tokens(window_token_counts(messages, p), p.top_n)


def top(messages: DataFrame, p: StreamParams = StreamParams()) -> DataFrame:
    counts, windows = window_token_counts(messages, p), window_posts(messages, p.window)
    return top_tokens(counts, windows, p.top_n, p.window)


def last_windows(messages: DataFrame, n: int, p: StreamParams = StreamParams()) -> list[str]:
    """Starts of the last n windows with messages, newest first, from times alone."""
    start = F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start")
    found = windowed(messages.select("ts"), p.window).select(start).distinct()
    return [r["start"] for r in found.orderBy(F.col("start").desc()).limit(n).collect()]


def _from(messages: DataFrame, start: str) -> DataFrame:
    """Messages from a time on; the filter comes before anything is read from the texts."""
    return messages.filter(F.col("ts") >= F.lit(start).cast("timestamp"))


def top_latest(messages: DataFrame, p: StreamParams = StreamParams()) -> DataFrame:
    """Top words of the last window; only messages of its UTC day are tokenized."""
    near = messages
    for start in last_windows(messages, 1, p):
        # windows belong to the day they end in, so the first one starts before midnight
        end = F.lit(start).cast("timestamp") + F.expr(f"INTERVAL {p.window}")
        first = F.to_date(end).cast("timestamp") - F.expr(f"INTERVAL {p.window}")
        near = messages.filter(F.col("ts") >= first)
    counts, windows = window_token_counts(near, p), window_posts(near, p.window)
    return top_tokens_latest(counts, windows, p.top_n)


def rising(messages: DataFrame, p: StreamParams = StreamParams()) -> DataFrame:
    counts, windows = window_token_counts(messages, p), window_posts(messages, p.window)
    return rising_tokens(counts, windows, p.top_n, p.min_count, p.min_delta)


def rising_latest(messages: DataFrame, p: StreamParams = StreamParams()) -> DataFrame:
    """Rising words of the last window; only messages of two windows are tokenized."""
    starts = last_windows(messages, 2, p)
    near = _from(messages, starts[-1]) if starts else messages
    counts, windows = window_token_counts(near, p), window_posts(near, p.window)
    return rising_tokens_latest(counts, windows, p.top_n, p.min_count, p.min_delta)


def latest_snapshots(
    messages: DataFrame, p: StreamParams = StreamParams()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Snapshots of the last window: traffic, top words, rising words; a row each or none."""
    starts = last_windows(messages, 1, p)
    newest = _from(messages, starts[0]) if starts else messages
    closed = window_posts(newest, p.window)
    recent = traffic(messages, p).orderBy(F.col("window_end").desc()).limit(1)
    return (
        recent.select(*TRAFFIC_SNAPSHOT.names),
        top_snapshot(top_latest(messages, p), closed, p.top_n),
        rising_snapshot(rising_latest(messages, p), closed, p.top_n),
    )
