"""Posts, search results and reports derived from the given tables, all rows of them.

``oracles.py`` states the same views in SQL.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions.dates import instant
from pulse.sources.readers import spread

RUN_DATE = date(2024, 1, 7)
NEXT_DATE = date(2024, 1, 8)
NOW = datetime(2024, 2, 4)
HOST = r"example\.(?:com|net|org)"
MOBILE_HOST = "m.example.com"
KEEP_KEYS = ("page", "ref")
AT = "2024-01-08T00:00:00+00:00"
STOPWORDS = ("the", "and", "les", "der", "오늘")
EXTRA_SECONDS = 30
TEXT_TABLES = ("documents", "pages")
POST_URL = "https://blog.example.com/p/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream; the pattern fits a single file as well as a folder."""
    stored = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    stream = spark.readStream.schema(stored.schema).parquet(f"{sf_dir}/{name}.parque[t]")
    return spread(stream, stored) if name in TEXT_TABLES else stream


def messages_from(documents: DataFrame) -> DataFrame:
    """Posts over 1000 minutes from noon, with an empty stretch of 20 minutes.

    Some have no url, some arrive a second time 30 seconds later with other text.
    """
    slot = F.col("doc_id") % 1000
    minute = slot + F.when(slot >= 100, 20).otherwise(0)
    has_url = F.col("doc_id") % 50 != 7
    again = (F.col("doc_id") % 17 == 0) & has_url
    copies = F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    late = F.col("copy") == 1
    seconds = minute * 60 + F.col("copy") * EXTRA_SECONDS
    start = F.lit("2024-01-01 12:00:00").cast("timestamp")
    return documents.withColumn("copy", F.explode(copies)).select(
        (F.col("doc_id") + F.col("copy") * 1_000_000_000).alias("msg_id"),
        F.timestamp_add("SECOND", seconds, start).alias("ts"),
        F.when(has_url, F.concat(F.lit(POST_URL), F.col("doc_id").cast("string"))).alias("url"),
        F.when(late, "late copy").alias("title"),
        F.when(late, F.concat("text", F.lit(" zzcopy"))).otherwise(F.col("text")).alias(
            "content_text"
        ),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from(table(spark, sf_dir, "documents"))


def event_messages(events: DataFrame, *keep: str) -> DataFrame:
    return events.select(F.col("ts").cast("timestamp").alias("ts"), *keep)


def daily_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of seven days; a third has no postdate and was found at 05:00 Seoul time."""
    day = (
        F.when(F.col("lang") == "es", 6 - F.when(F.col("doc_id") % 5 == 0, 1).otherwise(0))
        .when(F.col("lang") == "de", 4 + F.col("doc_id") % 3)
        .otherwise(F.col("doc_id") % 7)
    )
    dated = table(spark, sf_dir, "documents").withColumn(
        "dt", F.date_add(F.lit(date(2024, 1, 1)), day.cast("int"))
    )
    number = F.col("doc_id").cast("string")
    return dated.select(
        F.concat(F.lit(POST_URL), number).alias("url"),
        F.concat(F.lit("Post "), number).alias("title"),
        F.col("text").alias("content_text"),
        F.when(F.col("doc_id") % 3 != 0, F.col("dt")).alias("postdate"),
        (F.col("dt").cast("timestamp") - F.expr("INTERVAL 4 HOURS")).alias("discovered_at"),
    )


def _pick(number: Column, *values: Column | str | None) -> Column:
    """Value at ``number`` modulo the number of values."""
    at = number % len(values)
    out = None
    for i, v in enumerate(values):
        v = v if isinstance(v, Column) else F.lit(v)
        out = F.when(at == i, v) if out is None else out.when(at == i, v)
    return out


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post messages, some invalid, with dates in good and bad forms.

    The url depends on the text, so copies of a document share it.
    """
    n = F.col("doc_id")
    url = F.concat(F.lit(POST_URL), F.sha1("text"))
    title = F.concat(F.lit("\u00a0 Post "), n.cast("string"), F.lit("\n"))
    return table(spark, sf_dir, "documents").select(
        n,
        F.lit("1.0").alias("schema_version"),
        F.when(n % 50 == 7, None).when(n % 50 == 8, "").otherwise(url).alias("url"),
        F.when(n % 40 == 3, "").when(n % 40 == 4, None).otherwise(title).alias("title"),
        F.when(n % 30 == 5, "").otherwise(F.col("text")).alias("content_text"),
        _pick(n, "20240107", "2024-01-06", "n/a", None, "20240230").alias("postdate"),
        _pick(
            n,
            "2024-01-07T10:00:00Z",
            "2024-01-07T10:00:00+09:00",
            "2024-01-07T10:00:00",
            "yesterday",
        ).alias("discovered_at"),
    )


def stored_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urls that count as stored: those of labelled documents."""
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct()
    return raw_posts(spark, sf_dir).join(labelled, "doc_id", "left_semi").select("url").distinct()


def search_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search results out of the pages, in page order."""
    found = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    n = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        n,
        F.concat(F.lit("  "), F.col("url")).alias("link"),
        F.concat(F.lit("<b>"), found, F.lit("</b> &quot;new&quot; &lt;1&gt;")).alias("title"),
        _pick(n, "20240107", "2024-01-06", "", None).alias("postdate"),
        _pick(n, "someone", "").alias("bloggername"),
        F.lit(AT).alias("discovered_at"),
    )


def event_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report per day of events; keywords are malformed on every seventh day."""
    day = F.to_date("ts")
    per_day = (
        table(spark, sf_dir, "events")
        .groupBy(day.alias("report_date"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("event_type").alias("a"),
            F.max("event_type").alias("b"),
            F.max("ts").cast("timestamp").alias("created_at"),
        )
    )
    shown = F.col("report_date").cast("string")
    words = F.concat(F.lit('["'), F.col("a"), F.lit('", "'), F.col("b"), F.lit('"]'))
    return per_day.select(
        "report_date",
        F.concat(shown, F.lit(" Daily Report")).alias("title"),
        F.concat(F.col("n").cast("string"), F.lit(" events")).alias("summary"),
        F.concat(F.lit("## "), shown).alias("content_md"),
        F.when(F.dayofmonth("report_date") % 7 == 0, "not json").otherwise(words).alias(
            "keywords_json"
        ),
        "created_at",
    )


def document_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report for each of seven days from 2024-01-28, out of the daily posts."""
    per_day = (
        daily_posts(spark, sf_dir)
        .groupBy(
            F.date_add(F.to_date(F.col("discovered_at") + F.expr("INTERVAL 9 HOURS")), 27).alias(
                "report_date"
            )
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_day.select(
        "report_date",
        F.lit("rewritten").alias("title"),
        F.concat(F.col("n").cast("string"), F.lit(" posts")).alias("summary"),
        F.lit("## rewritten").alias("content_md"),
        F.lit("[]").alias("keywords_json"),
        instant(NOW).alias("created_at"),
    )
