"""The daily job: posts to documents to word statistics to next-day predictions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from pulse.operators.docs import cleaned_docs, daily_token_stats, process_dates, tokenize
from pulse.operators.forecast import predict_next_day
from pulse.operators.serve import daily_report
from pulse.schema import CLEANED_DOC, PREDICTION, TOKEN_STATS, DailyParams
from pulse.sources.readers import read_token_stats
from pulse.sources.sinks import replace_dates, upsert_reports, write_predictions
from pulse.sources.store import read_or_empty


def token_stats(docs: DataFrame, p: DailyParams = DailyParams()) -> DataFrame:
    """Statistics of cleaned documents with the native tokenizer."""
    return daily_token_stats(
        tokenize(docs, words=p.stopwords, min_len=p.min_token_len, max_len=p.max_token_len)
    )


def forecast_posts(posts: DataFrame, run_date: date, p: DailyParams = DailyParams()) -> DataFrame:
    """Predictions straight from posts, nothing stored."""
    dates = process_dates(run_date, p.predict.window_days, rebuild=True)
    docs = cleaned_docs(posts, dates, p.discovered_is_utc, p.timezone)
    return predict_next_day(token_stats(docs, p), run_date, p.predict)


def run_daily(
    spark: SparkSession,
    posts: DataFrame,
    target: str,
    run_date: date,
    p: DailyParams = DailyParams(),
) -> dict[str, dict[date, int]]:
    """Replace the run's days in ``cleaned_docs``, ``daily_token_stats`` and ``predictions``.

    Each table is written once and the next step reads it back, so texts are cleaned once and
    the statistics need the document text of the run's days only.
    """
    dates = process_dates(run_date, p.predict.window_days, p.rebuild_window)
    docs_path, stats_path = f"{target}/cleaned_docs", f"{target}/daily_token_stats"
    predictions_path = f"{target}/predictions"

    docs = cleaned_docs(posts, dates, p.discovered_is_utc, p.timezone)
    written = {"cleaned_docs": replace_dates(docs, docs_path, "doc_date", dates)}

    stored = read_or_empty(spark, docs_path, CLEANED_DOC)
    stats = token_stats(stored.filter(stored.doc_date.isin(dates)), p)
    written["daily_token_stats"] = replace_dates(
        stats, stats_path, "stat_date", dates, rebalance=True
    )

    window = read_token_stats(
        read_or_empty(spark, stats_path, TOKEN_STATS), run_date, p.predict.window_days
    )
    tomorrow = run_date + timedelta(days=1)
    predictions = predict_next_day(window, run_date, p.predict)
    written["predictions"] = {
        tomorrow: write_predictions(predictions, predictions_path, tomorrow)
    }
    return written


def run_report(spark: SparkSession, target: str, day: date) -> None:
    """Write the plain report of a day's predictions."""
    from pyspark.sql import functions as F

    predictions = read_or_empty(spark, f"{target}/predictions", PREDICTION)
    report = daily_report(predictions, day).withColumn("created_at", F.current_timestamp())
    if report.isEmpty():
        raise RuntimeError(f"no prediction rows for {day.isoformat()}")
    upsert_reports(report, f"{target}/daily_reports")
