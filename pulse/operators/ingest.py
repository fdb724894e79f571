"""Crawled items to validated, cleaned, routed and stored posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.functions.dates import clean_postdate, iso_postdate, parse_discovered_at, parse_postdate
from pulse.functions.text import strip
from pulse.functions.urls import KEEP_KEYS, mobile_url, plain_title
from pulse.schema import CLEANED_MESSAGE, POST_MESSAGE

# Topic names, required fields in order of checking, error kinds and texts.
RAW, CLEANED, ERROR = "raw", "cleaned", "error"
REQUIRED = ("url", "title", "content_text")
MISSING_FIELD = "필수 필드 누락: '{}'"
NOT_TEXT = "content_text가 문자열이 아님"
VALIDATION_ERROR = "validation_error"
CRAWL_FAILURE = "crawl_failure"
UNKNOWN_FAILURE = "크롤링 실패 (원인 불명)"
UNKNOWN_URL = "unknown"


def _decoded(df: DataFrame, value: str) -> DataFrame:
    """Add ``m``, the message, null where the text is not a JSON object."""
    checked = T.StructType([*CLEANED_MESSAGE.fields, T.StructField("_corrupt", T.StringType())])
    body = F.from_json(
        F.col(value).cast("string"), checked, {"columnNameOfCorruptRecord": "_corrupt"}
    )
    return df.withColumn("_m", body).withColumn("m", F.when(F.col("_m._corrupt").isNull(), F.col("_m")))


def decode_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to message columns; text that is not an object gives null columns."""
    kept = [c for c in df.columns if c != value]
    return _decoded(df, value).select(*kept, *[f"m.{c}" for c in CLEANED_MESSAGE.names])


def decode_posts(df: DataFrame, value: str = "value") -> DataFrame:
    """Only messages that decode and name a url."""
    return decode_messages(df, value).filter(F.length("url") > 0)


def dead_letters(df: DataFrame, value: str = "value") -> DataFrame:
    """Messages that are not a JSON object, as they came."""
    return _decoded(df, value).filter(F.col("m").isNull()).select(*df.columns)


def decode_crawled(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON of crawled posts to post columns, and ``content_json``: the content where it is not text."""
    fields = [f for f in POST_MESSAGE.fields if f.name != "content_text"]
    typed = T.StructType([*fields, T.StructField("content_text", T.VariantType())])
    kept = [c for c in df.columns if c != value]
    body = df.withColumn("_m", F.from_json(F.col(value), typed))
    content = F.col("_m.content_text")
    is_text = F.schema_of_variant(content) == "STRING"
    columns = {
        "content_text": F.when(is_text, F.try_variant_get(content, "$", "string")),
        "content_json": F.when(~is_text, F.to_json(content)),
    }
    named = [columns[c].alias(c) if c in columns else F.col(f"_m.{c}").alias(c) for c in POST_MESSAGE.names]
    return body.select(*kept, *named, columns["content_json"].alias("content_json"))


# JSON that counts as no content at all.
NO_CONTENT = ("null", "false", "0", "0.0", "-0.0", "[]", "{}")


def validate_posts(posts: DataFrame) -> DataFrame:
    """Add ``error_message``, naming the first required field that is missing or empty.

    Content that came as JSON of another kind than text (``content_json``, if there is that column) is
    missing when it is empty, and otherwise an error of its own after the missing fields.
    """
    empty = {f: F.coalesce(F.length(f), F.lit(0)) == 0 for f in REQUIRED}
    other = F.lit(False)
    if "content_json" in posts.columns:
        other = F.coalesce(~F.col("content_json").isin(*NO_CONTENT), F.lit(False))
        empty["content_text"] &= ~other
    checks = [F.when(empty[f], MISSING_FIELD.format(f)) for f in REQUIRED]
    return posts.withColumn("error_message", F.coalesce(*checks, F.when(other, NOT_TEXT)))


def clean_posts(posts: DataFrame) -> DataFrame:
    """Cleaned message: trimmed texts and an ISO date where the compact form is valid."""
    return posts.select(
        "url",
        strip(F.col("title")).alias("title"),
        strip(F.col("content_text")).alias("content_text"),
        clean_postdate(F.col("postdate")).alias("postdate"),
        "discovered_at",
    )


def error_record(url: Column, kind: str, message: Column, raw: Column, at: Column) -> Column:
    """Error message with the rejected record nested inside."""
    return F.struct(
        url.alias("url"),
        F.lit(kind).alias("error_type"),
        message.alias("error_message"),
        raw.alias("raw_data"),
        at.alias("occurred_at"),
    )


def _json(record: Column) -> Column:
    return F.to_json(record, {"ignoreNullFields": "false"})


def _now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def route_posts(posts: DataFrame, at: Column | None = None) -> DataFrame:
    """``topic, key, value``: every post raw, then cleaned or error, in one read of the input.

    The key is the url, null when empty.
    """
    checked = validate_posts(posts)
    fields = {c: F.col(c) for c in POST_MESSAGE.names}
    if "content_json" in posts.columns:
        fields["content_text"] = F.coalesce("content_text", "content_json").alias("content_text")
    raw = F.struct(*fields.values())
    cleaned = F.struct(
        F.col("url"),
        strip(F.col("title")).alias("title"),
        strip(F.col("content_text")).alias("content_text"),
        clean_postdate(F.col("postdate")).alias("postdate"),
        F.col("discovered_at"),
    )
    bad = F.col("error_message").isNotNull()
    rejected = error_record(
        F.col("url"), VALIDATION_ERROR, F.col("error_message"), raw, at if at is not None else _now()
    )
    second = F.when(bad, F.struct(F.lit(ERROR).alias("topic"), _json(rejected).alias("value")))
    second = second.otherwise(F.struct(F.lit(CLEANED).alias("topic"), _json(cleaned).alias("value")))
    first = F.struct(F.lit(RAW).alias("topic"), _json(raw).alias("value"))
    return checked.select(
        F.nullif("url", F.lit("")).alias("key"), F.explode(F.array(first, second)).alias("out")
    ).select("out.topic", "key", "out.value")


def route_failures(failures: DataFrame, at: Column | None = None) -> DataFrame:
    """Crawl failures as error messages."""
    url = F.coalesce("url", F.lit(UNKNOWN_URL))
    record = error_record(
        url,
        CRAWL_FAILURE,
        F.coalesce("error", F.lit(UNKNOWN_FAILURE)),
        F.struct("url", "error"),
        at if at is not None else _now(),
    )
    return failures.select(
        F.lit(ERROR).alias("topic"), url.alias("key"), _json(record).alias("value")
    )


def publish_summary(routed: DataFrame) -> DataFrame:
    """Messages per topic."""
    return routed.groupBy("topic").agg(F.count(F.lit(1)).alias("sent"))


def first_seen(df: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """First row of each key. Map tasks forward one row per key, so a hot key stays small."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def exclude_existing(df: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not stored yet."""
    return df.join(target.select(key), key, "left_anti")


def to_stored_post(messages: DataFrame, *extra: str) -> DataFrame:
    """Message columns in the types of the post table; missing texts become empty."""
    return messages.select(
        "url",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("content_text", F.lit("")).alias("content_text"),
        parse_postdate(F.col("postdate")).alias("postdate"),
        parse_discovered_at(F.col("discovered_at")).alias("discovered_at"),
        *extra,
    )


def new_posts(batch: DataFrame, target: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Rows of a batch to insert: first of each url, unless the url is stored."""
    return exclude_existing(first_seen(batch, "url", order), target, "url")


def ingest_summary(batch: DataFrame, inserted: DataFrame) -> DataFrame:
    """How many rows of a batch were inserted and how many skipped."""
    both = batch.select(F.lit(1).alias("seen"), F.lit(0).alias("new")).unionAll(
        inserted.select(F.lit(0), F.lit(1))
    )
    totals = both.agg(
        F.coalesce(F.sum("seen"), F.lit(0)).alias("seen"),
        F.coalesce(F.sum("new"), F.lit(0)).alias("new"),
    )
    return totals.select(
        F.explode(
            F.array(
                F.struct(F.lit("inserted").alias("outcome"), F.col("new").alias("posts")),
                F.struct(
                    F.lit("skipped").alias("outcome"), (F.col("seen") - F.col("new")).alias("posts")
                ),
            )
        ).alias("o")
    ).select("o.*")


def filter_host(df: DataFrame, host: str, column: str = "link") -> DataFrame:
    """Links that mention a host. The host is a regular expression."""
    return df.filter(F.col(column).rlike(host))


def first_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First n rows by arrival."""
    return df.orderBy(*order).limit(n)


def discover_items(
    found: DataFrame,
    host: str,
    order: Sequence[Column | str],
    mobile_host: str | None = None,
    keep_keys: Sequence[str] = KEEP_KEYS,
    target_unique: int | None = None,
) -> DataFrame:
    """Search results to unique posts: allowed host, canonical link, first arrival, clean title."""
    linked = filter_host(found, host).withColumn(
        "url", mobile_url(F.col("link"), host, mobile_host, keep_keys)
    )
    unique = first_seen(linked, "url", order)
    if target_unique is not None:
        unique = first_n(unique, order, target_unique)
    return unique.withColumns(
        {
            "title": plain_title(F.col("title")),
            **{
                c: F.when(F.col(c) != "", F.col(c))
                for c in ("postdate", "bloggername", "bloggerlink")
                if c in unique.columns
            },
        }
    )


def assemble_posts(
    items: DataFrame, pages: DataFrame, no_page: str = "not fetched"
) -> tuple[DataFrame, DataFrame]:
    """Posts from items with a fetched page, failures from the rest.

    ``pages`` has url, page_title and content_text; of several pages of a url the least counts.
    The page title wins over the search title.
    """
    once = first_seen(pages, "url", ["page_title", "content_text"])
    fetched = once.select("url", "page_title", "content_text", F.lit(True).alias("_found"))
    joined = items.join(fetched, "url", "left")
    posts = joined.filter("_found").select(
        F.lit("1.0").alias("schema_version"),
        "url",
        F.coalesce(F.nullif("page_title", F.lit("")), "title").alias("title"),
        "content_text",
        iso_postdate(F.col("postdate")).alias("postdate"),
        "discovered_at",
    )
    failures = joined.filter("_found is null").select("url", F.lit(no_page).alias("error"))
    return posts, failures


def retry_merge(
    posts: DataFrame, failures: DataFrame, retried: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Posts with the recovered ones added, failures that remain, and both counts.

    ``retried`` has the post columns and ``error``, null where the retry worked; only urls that
    had failed count. Of several attempts at a url one counts, a successful one if there is any.
    """
    tried = retried.join(failures.select("url").distinct(), "url", "left_semi")
    rest = [c for c in tried.columns if c not in ("url", "error")]
    tried = first_seen(tried, "url", [F.col("error").asc_nulls_first(), *rest])
    recovered = tried.filter(F.col("error").isNull())
    still = failures.join(recovered.select("url"), "url", "left_anti").join(
        tried.filter(F.col("error").isNotNull()).select("url", F.col("error").alias("_new")),
        "url",
        "left",
    )
    still = still.select("url", F.coalesce("_new", "error").alias("error"))
    merged = posts.unionByName(recovered.select(*posts.columns), allowMissingColumns=True)
    kinds = merged.select(F.lit("posts").alias("kind")).unionAll(
        still.select(F.lit("failures"))
    )
    return merged, still, kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"))
