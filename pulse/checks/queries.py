"""Every operator as a query over the given tables.

Times and dates are shown as text so that results compare by value with any SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.checks import fixtures as fx
from pulse.functions.dates import iso_postdate, iso_z, parse_discovered_at, parse_postdate
from pulse.functions.numbers import serve_round, share
from pulse.functions.text import distinct_tokens, filter_tokens, split_tokens, tokens_stream
from pulse.functions.urls import mobile_url, normalize_url, plain_title
from pulse.operators import docs, forecast, ingest, pages, segment, serve, windows
from pulse.plans import collect, daily, trends
from pulse.schema import (
    PREDICTION,
    RISING_SNAPSHOT,
    TOKEN_STATS,
    TOP_SNAPSHOT,
    TRAFFIC_SNAPSHOT,
    DailyParams,
    StreamParams,
)
from pulse.sources.posts import land_posts as land
from pulse.sources.posts import stored_posts
from pulse.sources.readers import (
    load_stopwords,
    read_crawl_result,
    read_posts,
    read_posts_stream,
    read_snapshot,
    read_snapshots,
    read_token_stats,
    read_words,
)
from pulse.sources.sinks import replace_dates, write_predictions, write_snapshot
from pulse.sources.store import materialize, read_or_empty, scratch
from pulse.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PARAMS = StreamParams(stopwords=fx.STOPWORDS)
PAGE_TITLES = (pages.Rule("meta", "property", "og:title"), pages.Rule("title"))
PAGE_BODIES = (pages.Rule("article"),)


def shown(df: DataFrame) -> DataFrame:
    """Times and dates as text."""

    def text(f: T.StructField) -> Column:
        if f.dataType == T.TimestampType():
            return iso_z(F.col(f.name)).alias(f.name)
        if f.dataType == T.DateType():
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*[text(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    """Register under the function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return shown(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return run


# Traffic ------------------------------------------------------------------------------------


def _event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.traffic_counts(fx.event_messages(fx.table(spark, sf_dir, "events")))


@query
def traffic_window_counts(spark, sf_dir):
    return _event_windows(spark, sf_dir)


@query
def traffic_prev_exact(spark, sf_dir):
    return windows.with_prev_exact(_event_windows(spark, sf_dir))


@query
def traffic_delta(spark, sf_dir):
    return windows.traffic_delta(_event_windows(spark, sf_dir))


@query
def traffic_summary(spark, sf_dir):
    return windows.traffic_summary(_event_windows(spark, sf_dir))


# Words per window ---------------------------------------------------------------------------


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_token_counts(fx.messages(spark, sf_dir), PARAMS)


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_posts(fx.messages(spark, sf_dir))


@query
def window_distinct_posts(spark, sf_dir):
    return _windows(spark, sf_dir)


@query
def window_first_arrivals(spark, sf_dir):
    first = windows.first_per_window(fx.messages(spark, sf_dir), ["msg_id", "title"])
    return first.select(F.col("w.end").alias("window_end"), "url", "msg_id", "title")


@query
def window_token_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@query
def window_token_rows(spark, sf_dir):
    return windows.window_token_rows(fx.messages(spark, sf_dir), PARAMS)


@query
def window_top_tokens(spark, sf_dir):
    return trends.window_top(fx.messages(spark, sf_dir), PARAMS)


@query
def cumulative_token_counts(spark, sf_dir):
    return windows.cumulative_counts(_counts(spark, sf_dir))


@query
def top_tokens_history(spark, sf_dir):
    return trends.top(fx.messages(spark, sf_dir), PARAMS)


@query
def top_tokens_latest(spark, sf_dir):
    return trends.top_latest(fx.messages(spark, sf_dir), PARAMS)


@query
def fired_windows(spark, sf_dir):
    return windows.fired_windows(_windows(spark, sf_dir))


@query
def prev_fired_counts(spark, sf_dir):
    return windows.with_prev_fired(_counts(spark, sf_dir), _windows(spark, sf_dir))


@query
def prev_fired_all_words(spark, sf_dir):
    return windows.with_prev_fired_all(_counts(spark, sf_dir), _windows(spark, sf_dir))


@query
def rising_tokens(spark, sf_dir):
    return trends.rising(fx.messages(spark, sf_dir), PARAMS)


@query
def rising_tokens_latest(spark, sf_dir):
    """With lower thresholds than the job's, as the last window may have few posts."""
    return trends.rising_latest(fx.messages(spark, sf_dir), replace(PARAMS, min_count=2, min_delta=1))


@query
def token_share(spark, sf_dir):
    both = _counts(spark, sf_dir).join(
        _windows(spark, sf_dir).select("window_end", "total_posts"), "window_end"
    )
    part = share(F.col("cnt"), F.col("total_posts"))
    return both.select(
        "window_end", "token", part.alias("share"), serve_round(part).alias("served_share")
    )


@query
def token_universe(spark, sf_dir):
    """Words of documents with even ids against those with odd ids."""
    words = fx.table(spark, sf_dir, "documents").select(
        (F.col("doc_id") % 2).alias("side"),
        F.explode(distinct_tokens(tokens_stream(F.lit(None), F.col("text")))).alias("token"),
    )
    counts = words.groupBy("side", "token").agg(F.count(F.lit(1)).alias("cnt"))
    return windows.token_universe(
        counts.filter("side = 0").drop("side"), counts.filter("side = 1").drop("side")
    )


# Text ---------------------------------------------------------------------------------------


def _joined(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


@query
def tokens_streaming(spark, sf_dir):
    m = fx.messages(spark, sf_dir)
    return m.select(
        "msg_id",
        _joined(tokens_stream(F.col("title"), F.col("content_text"), fx.STOPWORDS)).alias("words"),
    )


@query
def tokens_capped(spark, sf_dir):
    """The cap of the window jobs, a setting: the first 300 words of a post."""
    words = tokens_stream(F.col("title"), F.col("content_text"), fx.STOPWORDS, cap=300)
    return fx.messages(spark, sf_dir).select("msg_id", _joined(words).alias("words"))


@query
def tokens_batch(spark, sf_dir):
    cleaned = docs.cleaned_docs(fx.daily_posts(spark, sf_dir))
    return docs.tokenize(cleaned, words=fx.STOPWORDS).select(
        "doc_id", _joined(F.col("tokens")).alias("words")
    )


@query
def tokens_batch_filtered(spark, sf_dir):
    split = split_tokens(F.col("text"))
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", _joined(filter_tokens(split, fx.STOPWORDS)).alias("words")
    )


@query
def tokens_distinct(spark, sf_dir):
    words = distinct_tokens(split_tokens(F.col("text")))
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", F.size(words).alias("n"), _joined(words).alias("words")
    )


# Daily statistics ---------------------------------------------------------------------------


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.cleaned_docs(fx.daily_posts(spark, sf_dir))


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.token_stats(_docs(spark, sf_dir), DailyParams(stopwords=fx.STOPWORDS))


@query
def cleaned_docs(spark, sf_dir):
    return _docs(spark, sf_dir).drop("content_text")


@query
def cleaned_docs_of_dates(spark, sf_dir):
    dates = docs.process_dates(fx.RUN_DATE, 3, rebuild=True)
    cleaned = docs.cleaned_docs(fx.daily_posts(spark, sf_dir), dates)
    return cleaned.select("doc_id", "doc_date", "date_source")


@query
def doc_date_source(spark, sf_dir):
    dated = docs.with_doc_date(fx.daily_posts(spark, sf_dir))
    return dated.groupBy("doc_date", "date_source").agg(F.count(F.lit(1)).alias("posts"))


@query
def daily_token_stats(spark, sf_dir):
    return _stats(spark, sf_dir)


@query
def token_stats_joined(spark, sf_dir):
    return docs.token_stats_joined(docs.tokenize(_docs(spark, sf_dir), words=fx.STOPWORDS))


@query
def token_documents(spark, sf_dir):
    return docs.distinct_token_docs(docs.tokenize(_docs(spark, sf_dir), words=fx.STOPWORDS))


def _word_file(spark: SparkSession, sf_dir: str, longest: int = 5) -> str:
    """A word list of thousands of lines: all words of documents up to five letters."""
    path = scratch(spark, "words")
    short = split_tokens(F.col("text"))
    words = fx.table(spark, sf_dir, "documents").select(F.explode(short).alias("value"))
    words.filter(F.length("value").between(1, longest)).distinct().write.text(path)
    return path


def _short_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_words(spark, _word_file(spark, sf_dir))


@query
def word_list(spark, sf_dir):
    return _short_words(spark, sf_dir)


@query
def stopwords_loaded(spark, sf_dir):
    """A short list of a file and a comma list, as the window jobs load them."""
    path = _word_file(spark, sf_dir, 2)
    words = load_stopwords(spark, [f"{path}-missing", path], " Extra, words,")
    return spark.createDataFrame([(w,) for w in words], "word string")


@query
def stats_without_words(spark, sf_dir):
    return docs.without_words(_stats(spark, sf_dir), _short_words(spark, sf_dir))


@query
def tokens_tagged(spark, sf_dir):
    """The tokenizer with the analyzer learnt from the same documents."""
    cleaned = _docs(spark, sf_dir)
    model = segment.learn_pieces(segment.distinct_words(cleaned))
    tagged = docs.tokenize(cleaned, "morph", segment.analyzer(model), fx.STOPWORDS)
    return tagged.select("doc_id", _joined(F.col("tokens")).alias("words"))


@query
def word_pieces(spark, sf_dir):
    """The pieces of words and their costs."""
    return segment.learn_pieces(segment.distinct_words(_docs(spark, sf_dir)))


@query
def stats_replaced(spark, sf_dir):
    """Statistics stored by day, some days twice, and read back."""
    path, days = scratch(spark, "stats"), [fx.RUN_DATE.replace(day=d) for d in range(1, 8)]
    stats = _stats(spark, sf_dir)
    replace_dates(stats.withColumn("doc_count", F.lit(0).cast("long")), path, "stat_date", days[:3])
    replace_dates(stats, path, "stat_date", days, rebalance=True)
    return read_or_empty(spark, path, TOKEN_STATS)


@query
def predictions_stored(spark, sf_dir):
    """Predictions written twice and read back."""
    path, best = scratch(spark, "predictions"), materialize(_predictions(spark, sf_dir))
    for _ in range(2):
        write_predictions(best, path, fx.NEXT_DATE)
    return read_or_empty(spark, path, PREDICTION).select(*PREDICTION.names)


#: Bytes of texts in one object of a crawl, about.
CRAWL_BYTES = 8 << 20


def _crawl_parts(rows: DataFrame) -> DataFrame:
    """The rows with their part of the source: parts follow the bytes of the source, rows are dealt by a hash.

    Only sources of more than one part are listed, at most one for every CRAWL_BYTES of the input.
    """
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 256)
    parts = F.ceil(size / CRAWL_BYTES).cast("int")
    large = rows.groupBy("source").agg(parts.alias("parts")).filter("parts > 1")
    large = large.withColumnRenamed("source", "large")
    dealt = rows.withColumn("turn", F.xxhash64(F.monotonically_increasing_id()))
    dealt = dealt.join(large, F.col("source").eqNullSafe(F.col("large")), "left")
    part = F.pmod("turn", F.coalesce("parts", F.lit(1))).cast("int")
    return dealt.withColumn("part", part).drop("turn", "large", "parts")


@query
def crawl_result(spark, sf_dir):
    """Posts and failures of a crawl, written as objects of bounded size per source and read back."""
    path = scratch(spark, "crawl")
    rows = _crawl_parts(fx.table(spark, sf_dir, "documents"))
    url = F.concat(F.lit(fx.POST_URL), F.col("doc_id").cast("string"))
    post = F.struct(url.alias("url"), F.col("source").alias("title"), F.col("text").alias("content_text"))
    failure = F.struct(url.alias("url"), F.concat(F.lit("timeout "), F.col("lang")).alias("error"))
    ok = F.col("doc_id") % 10 != 3
    runs = rows.groupBy("source", "part").agg(
        F.collect_list(F.when(ok, post)).alias("posts"), F.collect_list(F.when(~ok, failure)).alias("failures")
    )
    # one file per run, as the crawler leaves them
    body = F.to_json(F.struct("posts", "failures")).alias("value")
    runs.select("source", "part", body).write.partitionBy("source", "part").text(path)
    posts, failures = read_crawl_result(spark, path)
    return posts.select("url", "title", "content_text").unionByName(failures, allowMissingColumns=True)


# Forecast -----------------------------------------------------------------------------------


@query
def stats_window(spark, sf_dir):
    return read_token_stats(_stats(spark, sf_dir), fx.RUN_DATE, 3)


@query
def token_candidates(spark, sf_dir):
    return forecast.candidate_tokens(_stats(spark, sf_dir), fx.RUN_DATE)


@query
def stats_window_candidates(spark, sf_dir):
    stats = materialize(_stats(spark, sf_dir))  # a stored table in the daily job
    return forecast.narrow_to_candidates(stats, forecast.candidate_tokens(stats, fx.RUN_DATE))


@query
def token_series(spark, sf_dir):
    series = forecast.token_series(_stats(spark, sf_dir), fx.RUN_DATE)
    return series.select(
        "token",
        *[F.get("counts", F.lit(i)).alias(f"c{i}") for i in range(7)],
        *[F.get("docs", F.lit(i)).alias(f"d{i}") for i in range(7)],
    )


@query
def series_features(spark, sf_dir):
    return forecast.series_features(forecast.token_series(_stats(spark, sf_dir), fx.RUN_DATE)).drop(
        "counts", "docs"
    )


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.candidates(_stats(spark, sf_dir), fx.RUN_DATE)


@query
def token_status(spark, sf_dir):
    return _candidates(spark, sf_dir).select("token", "non_zero_days", "growth_ratio", "status")


@query
def burst_score(spark, sf_dir):
    return _candidates(spark, sf_dir).select("token", F.round("burst", 9).alias("burst"))


@query
def forecast_rules(spark, sf_dir):
    return forecast.with_rules(_candidates(spark, sf_dir)).select(
        "token", "status", "predicted_count"
    )


def _ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions by rule alone, which SQL can state too."""
    scored = forecast.with_score(forecast.with_rules(_candidates(spark, sf_dir)))
    return scored.withColumns(
        {"score": F.round("score", 6), "burst": F.round("burst", 6)}
    )


@query
def forecast_scored(spark, sf_dir):
    return forecast.to_predictions(_ruled(spark, sf_dir), fx.RUN_DATE)


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = forecast.predictions_top_n(_ruled(spark, sf_dir), 50)
    return forecast.to_predictions(best, fx.RUN_DATE)


@query
def predictions_top_n(spark, sf_dir):
    return _predictions(spark, sf_dir)


@query
def training_rows(spark, sf_dir):
    stable = _candidates(spark, sf_dir).filter("status = 'stable'")
    rows = forecast.training_rows(stable)
    return rows.select(
        "token", "j", *[F.round(c, 6).alias(c) for c in [*forecast.FEATURES, "label"]]
    )


@query
def inference_rows(spark, sf_dir):
    stable = _candidates(spark, sf_dir).filter("status = 'stable'")
    rows = forecast.inference_rows(stable)
    return rows.select("token", *[F.round(c, 6).alias(c) for c in forecast.FEATURES])


@query
def predictions_ridge(spark, sf_dir):
    """The whole daily job, from posts to the best predictions, to seven digits."""
    best = daily.forecast_posts(
        fx.daily_posts(spark, sf_dir), fx.RUN_DATE, DailyParams(stopwords=fx.STOPWORDS)
    )
    return best.withColumns(
        {
            c: F.format_string("%.6e", c).cast("double")
            for c in ("predicted_count", "score", "burst")
        }
    )


# Ingest -------------------------------------------------------------------------------------


def _fixed_time() -> Column:
    return F.lit(fx.AT)


@query
def post_validation(spark, sf_dir):
    return ingest.validate_posts(fx.raw_posts(spark, sf_dir)).select("doc_id", "error_message")


@query
def post_content_kinds(spark, sf_dir):
    """Crawled posts as JSON whose content is text or something else."""
    n = F.col("doc_id")
    text = F.to_json(F.struct(F.col("text").alias("content_text")))
    other = fx._pick(n, None, n.cast("string"), "false", "true", "null", "[]", '{"a": [1, 2.5]}', "0", '""')
    rest = F.when(n % 9 == 0, F.expr("substring(t, 2)")).otherwise(F.concat(F.lit('"content_text": '), other, F.lit("}")))
    head = F.concat(F.lit('{"url": "u'), n.cast("string"), F.lit('", "title": "T", '))
    value = fx.table(spark, sf_dir, "documents").withColumn("t", text).select("doc_id", F.concat(head, rest).alias("value"))
    checked = ingest.validate_posts(ingest.decode_crawled(value))
    return checked.select("doc_id", "url", "content_text", "content_json", "error_message")


@query
def post_clean(spark, sf_dir):
    return ingest.clean_posts(fx.raw_posts(spark, sf_dir))


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.route_posts(fx.raw_posts(spark, sf_dir), _fixed_time())


@query
def post_routing(spark, sf_dir):
    fields = ("title", "content_text", "postdate", "error_type", "error_message", "occurred_at")
    body = [F.get_json_object("value", f"$.{f}").alias(f) for f in fields]
    rejected = F.get_json_object("value", "$.raw_data.content_text").alias("rejected_text")
    return _routed(spark, sf_dir).select("topic", "key", *body, rejected)


@query
def routing_summary(spark, sf_dir):
    return ingest.publish_summary(_routed(spark, sf_dir))


@query
def post_decoding(spark, sf_dir):
    """Cleaned messages sent and decoded again."""
    sent = _routed(spark, sf_dir).filter(F.col("topic") == ingest.CLEANED)
    return ingest.decode_posts(sent.select("value"))


@query
def dead_letters(spark, sf_dir):
    """Document texts as messages: none is a JSON object, unlike the event properties."""
    texts = fx.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    props = fx.table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    return ingest.dead_letters(texts.unionByName(props))


@query
def failure_routing(spark, sf_dir):
    """Every document as a crawl failure, some without url or reason."""
    failures = fx.table(spark, sf_dir, "documents").select(
        F.when(F.col("doc_id") % 9 != 0, F.concat(F.lit(fx.POST_URL), F.col("doc_id").cast("string")))
        .alias("url"),
        F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit("timeout "), F.col("source"))).alias("error"),
    )
    routed = ingest.route_failures(failures, _fixed_time())
    return routed.select(
        "topic",
        "key",
        F.get_json_object("value", "$.error_type").alias("error_type"),
        F.get_json_object("value", "$.error_message").alias("error_message"),
        F.get_json_object("value", "$.raw_data.url").alias("raw_url"),
    )


def _new_posts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    batch = ingest.to_stored_post(fx.raw_posts(spark, sf_dir).filter("length(url) > 0"), "doc_id")
    return batch, ingest.new_posts(batch, fx.stored_urls(spark, sf_dir), ["doc_id"])


@query
def land_posts(spark, sf_dir):
    return _new_posts(spark, sf_dir)[1]


@query
def ingest_summary(spark, sf_dir):
    return ingest.ingest_summary(*_new_posts(spark, sf_dir))


@query
def postdate_parse(spark, sf_dir):
    c = F.col("postdate")
    return fx.raw_posts(spark, sf_dir).select(
        "doc_id", parse_postdate(c).alias("postdate"), iso_postdate(c).alias("iso_postdate")
    )


@query
def discovered_parse(spark, sf_dir):
    return fx.raw_posts(spark, sf_dir).select(
        "doc_id", parse_discovered_at(F.col("discovered_at")).alias("discovered_at")
    )


@query
def url_normalize(spark, sf_dir):
    items = fx.search_items(spark, sf_dir)
    return items.select("page_id", normalize_url(F.col("link"), fx.KEEP_KEYS).alias("url"))


@query
def url_mobile(spark, sf_dir):
    url = mobile_url(F.col("link"), fx.HOST, fx.MOBILE_HOST, fx.KEEP_KEYS)
    return fx.search_items(spark, sf_dir).select("page_id", url.alias("url"))


@query
def host_filter(spark, sf_dir):
    return ingest.filter_host(fx.search_items(spark, sf_dir), r"example\.org").select("page_id", "link")


@query
def url_first_seen(spark, sf_dir):
    items = ingest.discover_items(
        fx.search_items(spark, sf_dir), fx.HOST, ["page_id"], fx.MOBILE_HOST, fx.KEEP_KEYS
    )
    return items.select("page_id", "url", "title", "postdate", "bloggername")


@query
def first_unique_items(spark, sf_dir):
    """The cap of the collection job: first 100 unique posts by arrival."""
    items = ingest.discover_items(
        fx.search_items(spark, sf_dir), fx.HOST, ["page_id"], fx.MOBILE_HOST, fx.KEEP_KEYS, 100
    )
    return items.select("page_id", "url")


@query
def title_strip(spark, sf_dir):
    return fx.search_items(spark, sf_dir).select("page_id", plain_title(F.col("title")).alias("title"))


@query
def page_titles(spark, sf_dir):
    return pages.page_titles(fx.table(spark, sf_dir, "pages")).select("page_id", "page_title")


@query
def page_bodies(spark, sf_dir):
    return pages.extract_pages(fx.table(spark, sf_dir, "pages"), PAGE_TITLES, PAGE_BODIES)


def _collected(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every tenth page could not be fetched; some urls were fetched several times."""
    fetched = fx.table(spark, sf_dir, "pages").filter("page_id % 10 <> 3").select(
        mobile_url(F.col("url"), fx.HOST, fx.MOBILE_HOST, fx.KEEP_KEYS).alias("url"), "page_id", "html"
    )
    return collect.collect(
        fx.search_items(spark, sf_dir), fetched, fx.HOST, ["page_id"], fx.MOBILE_HOST, fx.KEEP_KEYS,
        title_rules=PAGE_TITLES, body_rules=PAGE_BODIES, page_order=["page_id"],
    )


@query
def collected_posts(spark, sf_dir):
    """Posts with their texts, and failures with their reasons."""
    posts, failures = _collected(spark, sf_dir)
    return posts.unionByName(failures, allowMissingColumns=True)


@query
def retry_merge(spark, sf_dir):
    """Labelled documents are posts, the others failures; a retry works for long texts."""
    labels = fx.table(spark, sf_dir, "labels").select("doc_id").distinct()
    documents = fx.table(spark, sf_dir, "documents").withColumn(
        "url", F.concat(F.lit(fx.POST_URL), F.col("doc_id").cast("string"))
    )
    posts = documents.join(labels, "doc_id", "left_semi").select("url", "source")
    lost = documents.join(labels, "doc_id", "left_anti")
    failures = lost.select("url", F.lit("timeout").alias("error"))
    retried = documents.select(
        "url", "source", F.when(F.col("n_chars") < 1000, "gone").alias("error")
    )
    merged, still, summary = ingest.retry_merge(posts, failures, retried)
    return (
        merged.select("url", F.lit("post").alias("kind"), F.col("source").alias("detail"))
        .unionByName(still.select("url", F.lit("failure").alias("kind"), F.col("error").alias("detail")))
        .unionByName(
            summary.select(
                F.lit("").alias("url"),
                F.concat(F.lit("count "), F.col("kind")).alias("kind"),
                F.col("rows").cast("string").alias("detail"),
            )
        )
    )


# Serving ------------------------------------------------------------------------------------


@query
def predictions_for_date(spark, sf_dir):
    return serve.predictions_for(_predictions(spark, sf_dir), fx.NEXT_DATE, 20)


@query
def report_daily(spark, sf_dir):
    return serve.daily_report(_predictions(spark, sf_dir), fx.NEXT_DATE)


@query
def report_keywords(spark, sf_dir):
    words = serve.report_keywords(_predictions(spark, sf_dir))
    return words.select(F.array_join("keywords", " ").alias("keywords"))


@query
def report_payload(spark, sf_dir):
    """The payload decoded again, one row per item."""
    payload = serve.report_payload(_predictions(spark, sf_dir), fx.NEXT_DATE, 30)
    item = T.StructType([f for f in PREDICTION.fields if f.name != "predict_date"])
    schema = T.StructType(
        [
            T.StructField("report_date", T.StringType()),
            T.StructField("top_n", T.IntegerType()),
            T.StructField("items", T.ArrayType(item)),
        ]
    )
    body = payload.select(F.from_json("payload", schema).alias("p"))
    return body.select("p.report_date", "p.top_n", F.posexplode("p.items").alias("place", "i")).select(
        "report_date", "top_n", "place", "i.*"
    )


@query
def report_upsert(spark, sf_dir):
    return serve.merge_reports(fx.event_reports(spark, sf_dir), fx.document_reports(spark, sf_dir))


@query
def report_list(spark, sf_dir):
    return serve.list_reports(fx.event_reports(spark, sf_dir), 10)


@query
def report_get(spark, sf_dir):
    reports = fx.event_reports(spark, sf_dir)
    found = serve.get_report(reports, fx.RUN_DATE).unionByName(
        serve.get_report(reports, fx.RUN_DATE.replace(day=8))
    )
    return found.withColumn("keywords", F.array_join("keywords", " "))


@query
def report_filter(spark, sf_dir):
    reports = serve.filter_reports(fx.event_reports(spark, sf_dir), " 01-2", 30, fx.NOW)
    return reports.select("report_date", "title")


def _top_items(snapshots: DataFrame) -> DataFrame:
    return snapshots.select("window_end", "total_posts", F.explode("items").alias("i")).select(
        "window_end", "total_posts", "i.*"
    )


@query
def snapshot_top_decoded(spark, sf_dir):
    """Top snapshots to JSON and back."""
    rows = materialize(windows.window_token_rows(fx.messages(spark, sf_dir), PARAMS))
    counts, closed = windows.split_rows(rows)
    top = windows.top_snapshot(windows.top_tokens(counts, closed), closed)
    return _top_items(serve.decode(serve.encode(top), TOP_SNAPSHOT))


@query
def snapshot_latest(spark, sf_dir):
    """Top snapshots of all windows stored twice; the newest is served."""
    target = scratch(spark, "snapshots")
    messages = fx.messages(spark, sf_dir)
    rows = materialize(windows.window_token_rows(messages, PARAMS))
    counts, closed = windows.split_rows(rows)
    top = windows.top_snapshot(windows.top_tokens(counts, closed), closed)
    for _ in range(2):
        write_snapshot(top, target, "top")
    return _top_items(read_snapshot(spark, target, "top"))


def _dashboard(spark: SparkSession, sf_dir: str, limit: int | None) -> DataFrame:
    row = serve.dashboard_latest(*trends.latest_snapshots(fx.messages(spark, sf_dir), PARAMS), limit=limit)
    items = [
        F.array_join(
            F.transform(
                f"{part}.items",
                lambda i: F.concat_ws(":", i["rank"].cast("string"), i["token"], i["count"].cast("string")),
            ),
            " ",
        ).alias(f"{part}_items")
        for part in ("top", "rising")
    ]
    return row.select(
        iso_z(F.col("traffic.window_end")).alias("traffic_end"),
        F.col("traffic.summary").alias("traffic_summary"),
        F.col("top.total_posts").alias("total_posts"),
        *items,
    )


@query
def dashboard_latest(spark, sf_dir):
    return _dashboard(spark, sf_dir, None)


@query
def dashboard_limit(spark, sf_dir):
    return _dashboard(spark, sf_dir, 5)


# Streams ------------------------------------------------------------------------------------


def _history(spark: SparkSession, target: str, name: str, schema: T.StructType) -> DataFrame:
    return serve.decode(read_snapshots(spark, target, name).select("payload"), schema)


@query
def stream_traffic(spark, sf_dir):
    target = scratch(spark, "traffic")
    stream = fx.event_messages(fx.stream_table(spark, sf_dir, "events"))
    jobs.run_traffic(stream, target, f"{target}/checkpoint").awaitTermination()
    return _history(spark, target, "traffic", TRAFFIC_SNAPSHOT)


@query
def stream_top_tokens(spark, sf_dir):
    target = scratch(spark, "top")
    stream = fx.messages_from(fx.stream_table(spark, sf_dir, "documents"))
    jobs.run_top_tokens(stream, target, f"{target}/checkpoint", params=PARAMS).awaitTermination()
    return _top_items(_history(spark, target, "top", TOP_SNAPSHOT))


@query
def stream_replayed(spark, sf_dir):
    """Two batches, the halves of the posts, of which the first is replayed at the end."""
    target, messages = scratch(spark, "replayed"), fx.messages(spark, sf_dir)
    halves = [messages.filter(F.col("msg_id") % 2 == i) for i in range(2)]
    for i in (0, 1, 0):
        jobs.add_posts(halves[i], target, PARAMS, i, rising=False)
    return _top_items(_history(spark, target, "top", TOP_SNAPSHOT))


@query
def stream_rising_tokens(spark, sf_dir):
    target = scratch(spark, "rising")
    stream = fx.messages_from(fx.stream_table(spark, sf_dir, "documents"))
    jobs.run_rising_tokens(stream, target, f"{target}/checkpoint", params=PARAMS).awaitTermination()
    return _top_items(_history(spark, target, "rising", RISING_SNAPSHOT))


@query
def stream_landing(spark, sf_dir):
    target = scratch(spark, "landing")
    stream = fx.messages_from(fx.stream_table(spark, sf_dir, "documents")).filter("url is not null")
    stream = stream.withColumns(
        {"postdate": F.lit("20240107"), "discovered_at": F.lit("2024-01-07T10:00:00Z")}
    )
    jobs.run_landing(stream, f"{target}/posts", f"{target}/checkpoint").awaitTermination()
    return stored_posts(spark, f"{target}/posts")


@query
def stream_source(spark, sf_dir):
    """Messages as JSON in files that take the place of the broker, read as a stream and decoded."""
    target = scratch(spark, "source")
    value = F.to_json(F.struct("url", "title", "content_text")).alias("value")
    fx.messages(spark, sf_dir).select(value, "ts", "msg_id").write.parquet(f"{target}/in")
    stream = ingest.decode_messages(read_posts_stream(spark, "parquet", {"path": f"{target}/in"}))
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{target}/checkpoint")
    writer.trigger(availableNow=True).start(f"{target}/out").awaitTermination()
    return spark.read.parquet(f"{target}/out").select("msg_id", "ts", "url", "title", "content_text")


@query
def posts_read(spark, sf_dir):
    """Posts landed by bucket and read as the daily job reads them."""
    path = scratch(spark, "posts")
    land(ingest.to_stored_post(fx.raw_posts(spark, sf_dir), "doc_id"), path, ["doc_id"])
    return read_posts(spark, f"{path}/posts")


@query
def stream_word_list(spark, sf_dir):
    """Word counts of a stream that leaves out a list too long for its plan."""
    target = scratch(spark, "listed")
    stream = fx.messages_from(fx.stream_table(spark, sf_dir, "documents"))
    listed = _word_file(spark, sf_dir)
    jobs.run_trends(
        stream, target, f"{target}/checkpoint", PARAMS, top=False, rising=False, words=listed
    ).awaitTermination()
    return jobs.counts_of(spark, target)


@query
def stream_late_posts(spark, sf_dir):
    """Three batches by post number; windows close half an hour behind the batches before."""
    target, messages = scratch(spark, "late"), fx.messages(spark, sf_dir)
    params = replace(PARAMS, lateness="30 minutes")
    for i in range(3):
        jobs.add_posts(messages.filter(F.col("msg_id") % 3 == i), target, params, i, top=False, rising=False)
    late = jobs.late_messages(spark, target).select("window_end", F.col("posts").alias("late"))
    return late.join(jobs.windows_of(spark, target).select("window_end", "total_posts"), "window_end", "full")


@query
def stream_late_traffic(spark, sf_dir):
    """Events in three files, one a batch; windows close two days behind the batches before."""
    target, events = scratch(spark, "late-traffic"), fx.event_messages(fx.table(spark, sf_dir, "events"), "event_id")
    for i in range(3):
        events.filter(F.col("event_id") % 3 == i).coalesce(1).write.mode("append").parquet(f"{target}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{target}/in")
    params = replace(PARAMS, lateness="2 days")
    jobs.run_traffic(stream, target, f"{target}/checkpoint", params).awaitTermination()
    late = jobs.late_messages(spark, target).select(iso_z(F.col("window_end")).alias("window_end"), F.col("traffic").alias("late"))
    shown = _history(spark, target, "traffic", TRAFFIC_SNAPSHOT).select("window_end", "total_posts", "prev_total_posts")
    return late.join(shown, "window_end", "full")
