"""Record layouts and job parameters.

Layouts are fixed, never inferred: every decode step names one of these types.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from pulse.functions.text import DEFAULT_STOPWORDS


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


POST_MESSAGE = _strings(
    "schema_version", "url", "title", "content_text", "postdate", "discovered_at"
)
CLEANED_MESSAGE = _strings("url", "title", "content_text", "postdate", "discovered_at")
FAILURE = _strings("url", "error")
ERROR_MESSAGE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("raw_data", T.StringType()),
        T.StructField("occurred_at", T.StringType()),
    ]
)
ROUTED_MESSAGE = _strings("topic", "key", "value")

SEARCH_ITEM = _strings("link", "title", "postdate", "bloggername", "bloggerlink")

POST = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("content_text", T.StringType()),
        T.StructField("postdate", T.DateType()),
        T.StructField("discovered_at", T.TimestampType()),
    ]
)
CLEANED_DOC = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("doc_date", T.DateType()),
        T.StructField("date_source", T.StringType()),
        T.StructField("postdate", T.DateType()),
        T.StructField("discovered_at", T.TimestampType()),
        T.StructField("title", T.StringType()),
        T.StructField("content_text", T.StringType()),
        T.StructField("cleaned_text", T.StringType()),
    ]
)
TOKEN_STATS = T.StructType(
    [
        T.StructField("stat_date", T.DateType()),
        T.StructField("token", T.StringType()),
        T.StructField("mention_count", T.LongType()),
        T.StructField("doc_count", T.LongType()),
    ]
)
PREDICTION = T.StructType(
    [
        T.StructField("predict_date", T.DateType()),
        T.StructField("token", T.StringType()),
        T.StructField("predicted_count", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("burst", T.DoubleType()),
        T.StructField("today_count", T.LongType()),
        T.StructField("yest_count", T.LongType()),
        T.StructField("avg_3d_count", T.DoubleType()),
        T.StructField("avg_7d_count", T.DoubleType()),
        T.StructField("doc_today", T.LongType()),
        T.StructField("doc_yest", T.LongType()),
    ]
)
REPORT = T.StructType(
    [
        T.StructField("report_date", T.DateType()),
        T.StructField("title", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("content_md", T.StringType()),
        T.StructField("keywords_json", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

TRAFFIC_SNAPSHOT = T.StructType(
    [
        T.StructField("total_posts", T.LongType()),
        T.StructField("prev_total_posts", T.LongType()),
        T.StructField("traffic_increase_rate", T.DoubleType()),
        T.StructField("window_end", T.StringType()),
        T.StructField("summary", T.StringType()),
    ]
)
TOP_ITEM = T.StructType(
    [
        T.StructField("rank", T.IntegerType()),
        T.StructField("token", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("share", T.DoubleType()),
        T.StructField("prev_count", T.LongType()),
        T.StructField("increase_rate", T.DoubleType()),
        T.StructField("increase_label", T.StringType()),
    ]
)
RISING_ITEM = T.StructType(
    [
        T.StructField("rank", T.IntegerType()),
        T.StructField("token", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("prev_count", T.LongType()),
        T.StructField("delta", T.LongType()),
        T.StructField("rise_rate", T.DoubleType()),
        T.StructField("increase_label", T.StringType()),
        T.StructField("share", T.DoubleType()),
    ]
)


def _ranking(item: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("window_start", T.StringType()),
            T.StructField("window_end", T.StringType()),
            T.StructField("total_posts", T.LongType()),
            T.StructField("top_n", T.IntegerType()),
            T.StructField("items", T.ArrayType(item)),
        ]
    )


TOP_SNAPSHOT = _ranking(TOP_ITEM)
RISING_SNAPSHOT = _ranking(RISING_ITEM)

SNAPSHOT_SCHEMAS = {
    "traffic": TRAFFIC_SNAPSHOT,
    "top": TOP_SNAPSHOT,
    "rising": RISING_SNAPSHOT,
}

SERIES_DAYS = 7


# The defaults of the three settings classes.


@dataclass(frozen=True)
class StreamParams:
    """Settings of the ten-minute window jobs."""

    window: str = "10 minutes"
    top_n: int = 20
    min_count: int = 5
    min_delta: int = 3
    token_cap: int | None = None
    stopwords: tuple[str, ...] = DEFAULT_STOPWORDS
    ttl_seconds: int = 86400
    #: Windows this far behind the newest message take no more messages; None: none is ever late.
    lateness: str | None = None


@dataclass(frozen=True)
class PredictParams:
    """Settings of the daily forecast. The lag features are written for seven days."""

    window_days: int = SERIES_DAYS
    top_n: int = 50
    min_doc_today: int = 5
    min_count_today: int = 10
    growth_ratio_min: float = 2.0
    prev_mean_max: float = 3.0
    w_burst: float = 1.5
    w_stable: float = 0.7
    w_uncertain: float = 0.3
    yhat_cap_multiplier: float = 3.0
    min_training_rows: int = 50
    ridge_alpha: float = 1.0

    def __post_init__(self) -> None:
        if self.window_days != SERIES_DAYS:
            raise ValueError(f"window_days must be {SERIES_DAYS}, got {self.window_days}")


@dataclass(frozen=True)
class DailyParams:
    """Settings of the daily job around the forecast."""

    predict: PredictParams = PredictParams()
    rebuild_window: bool = False
    min_token_len: int = 2
    max_token_len: int = 20
    timezone: str = "Asia/Seoul"
    discovered_is_utc: bool = True
    stopwords: tuple[str, ...] = ()
