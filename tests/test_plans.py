"""What the physical plans must and must not contain."""

import re
from datetime import date

import pytest

from pulse.checks import fixtures as fx
from pulse.operators import docs, forecast, ingest, windows
from pulse.plans import daily
from pulse.sources.readers import read_token_stats

SF_DIR = "/root/testdata/sf0.01"


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def simple(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def hash_shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", simple(df)))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Posts, messages and statistics as tables, read without spreading."""
    base = tmp_path_factory.mktemp("tables")
    fx.daily_posts(spark, SF_DIR).write.parquet(f"{base}/posts")
    fx.messages(spark, SF_DIR).write.parquet(f"{base}/messages")
    stats = daily.token_stats(docs.cleaned_docs(spark.read.parquet(f"{base}/posts")))
    stats.write.partitionBy("stat_date").parquet(f"{base}/stats")
    fx.raw_posts(spark, SF_DIR).write.parquet(f"{base}/raw")
    return {n: spark.read.parquet(f"{base}/{n}") for n in ("posts", "messages", "stats", "raw")}


def test_no_python_on_the_main_paths(stored):
    counts = windows.window_token_counts(stored["messages"])
    fired = windows.window_posts(stored["messages"])
    for df in (
        daily.token_stats(docs.cleaned_docs(stored["posts"])),
        windows.top_tokens(counts, fired),
        windows.rising_tokens(counts, fired),
        forecast.candidates(stored["stats"], fx.RUN_DATE),
        ingest.route_posts(stored["raw"]),
    ):
        assert "Python" not in simple(df) and "InPandas" not in simple(df)


def test_daily_statistics_take_one_shuffle_and_no_join(stored):
    df = daily.token_stats(docs.cleaned_docs(stored["posts"]))
    assert hash_shuffles(df) == 1 and "Join" not in simple(df)
    assert "partial_sum" in simple(df)


def test_cleaning_takes_no_shuffle(stored):
    assert "Exchange" not in simple(docs.cleaned_docs(stored["posts"], [fx.RUN_DATE]))


def test_routing_reads_once(stored):
    text = simple(ingest.route_posts(stored["raw"]))
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_window_list_does_not_read_texts(stored):
    text = plan(windows.window_posts(stored["messages"]))
    assert "content_text" not in text


def test_word_counts_read_texts_once_for_top_and_rising(stored):
    counts = windows.window_token_counts(stored["messages"])
    fired = windows.window_posts(stored["messages"])
    for df in (windows.top_tokens(counts, fired), windows.rising_tokens(counts, fired)):
        assert plan(df).count("content_text:string") == 1


def test_rankings_keep_n_rows_before_the_shuffle(stored):
    counts = windows.window_token_counts(stored["messages"])
    fired = windows.window_posts(stored["messages"])
    for df in (
        windows.window_top_tokens(counts), windows.top_tokens(counts, fired),
        windows.rising_tokens(counts, fired), ingest.first_seen(stored["raw"], "url", ["doc_id"]),
    ):
        text = plan(df)
        assert "Partial" in text and "WindowGroupLimit" in text


def test_only_the_window_list_goes_through_one_partition(stored):
    counts = windows.window_token_counts(stored["messages"])
    fired = windows.window_posts(stored["messages"])
    assert "SinglePartition" not in simple(windows.top_tokens(counts, fired))
    assert simple(windows.rising_tokens(counts, fired)).count("SinglePartition") == 1


def test_no_cross_joins(stored):
    counts = windows.window_token_counts(stored["messages"])
    fired = windows.window_posts(stored["messages"])
    for df in (windows.top_tokens(counts, fired), windows.rising_tokens(counts, fired),
               windows.traffic_summary(windows.traffic_counts(stored["messages"]))):
        assert "NestedLoop" not in simple(df) and "Cartesian" not in simple(df)


def test_statistics_window_prunes_days_and_columns(stored):
    text = plan(read_token_stats(stored["stats"], date(2024, 1, 7), 3))
    assert re.search(r"PartitionFilters: \[.*stat_date.*2024-01-05.*2024-01-07", text)


def test_coarse_date_filter_reaches_the_scan(stored):
    text = plan(docs.cleaned_docs(stored["posts"], [date(2024, 1, 7)]))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(postdate,2024-01-07\)", text)


def test_series_are_grouped_once_without_join(stored):
    df = forecast.candidates(stored["stats"], fx.RUN_DATE)
    assert hash_shuffles(df) == 1 and "Join" not in simple(df)
