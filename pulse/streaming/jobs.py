"""The window jobs as Structured Streaming queries.

Traffic is the stream's own stateful aggregation: every micro-batch brings the whole count of each
window it changed, and the snapshots of these windows and of the ones after them are written.

Top and rising words go through ``foreachBatch``. What a batch adds is stored under its number; the
windows it touches are counted anew from the arrivals stored for them, and no others. For top words the
running totals of a day are kept up to some of its windows, so the totals up to a window are those of the
nearest kept window before it and the counts since. Rising words of a window need the counts of the
window that fired before; each window touched is written with the one that fired after it.

So every window comes out with the batch that brings its first message, later messages correct it, and a
replayed batch replaces its own rows and leaves the same history. With a ``lateness`` messages of
windows that ended so long before the newest message of earlier batches are not counted; they are
counted apart (:func:`late_messages`). Without one nothing is ever late. The stream has no watermark, as
Spark would drop late rows without a trace; the state it keeps for this is 144 rows a day.

History is foldered by UTC day and written as logs (:mod:`pulse.sources.log`); words are valid once the
log of windows names the write they came with.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulse.operators.ingest import to_stored_post
from pulse.operators.windows import (
    first_rows,
    post_tokens,
    rising_snapshot,
    rising_tokens,
    token_rows,
    top_contenders,
    top_snapshot,
    top_tokens,
    top_tokens_latest,
    traffic_summary,
    windowed,
    without_listed,
)
from pulse.schema import StreamParams
from pulse.sources import log
from pulse.sources.posts import land_posts
from pulse.sources.readers import read_words
from pulse.sources.sinks import SNAPSHOT_ROW, overwrite_partitions, write_snapshot
from pulse.sources.store import day_names, folder_names, read_days, remove_folder

ONCE: Mapping[str, bool] = {"availableNow": True}
EVERY_WINDOW: Mapping[str, str] = {"processingTime": "10 minutes"}

_BOUNDS = [
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
]
_WORDS = [T.StructField("token", T.StringType()), T.StructField("cnt", T.LongType())]
WINDOW_ROWS = T.StructType([*_BOUNDS, T.StructField("total_posts", T.LongType()), T.StructField("counted", T.LongType())])
COUNT_ROWS = T.StructType([*_BOUNDS, *_WORDS])
TOTAL_ROWS = T.StructType([*COUNT_ROWS.fields, T.StructField("window_day", T.DateType()), T.StructField("upto", T.StringType())])
#: Messages of a window that a batch brought or, for a stream with state, that came so far.
ARRIVED_ROWS = T.StructType(
    [
        *_BOUNDS,
        T.StructField("total_posts", T.LongType()),
        T.StructField("last_ts", T.TimestampType()),
        T.StructField("batch", T.LongType()),
        T.StructField("late", T.BooleanType()),
    ]
)
TEN_MINUTES = timedelta(minutes=10)
DAY = timedelta(days=1)
#: Posts and counts of a window are stored together, so that a task that reads them has few words to pass on.
BY_WINDOW = ("window_day", "window_end")
#: Running totals are kept up to a window once so many windows have fired since the last kept one.
KEPT_EVERY = 6


def windows_of(spark: SparkSession, target: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Windows of a job, of some days or all: window_start, window_end, total_posts."""
    days = [d for d in day_names(spark, f"{target}/windows") if (first is None or d >= first) and (last is None or d <= last)]
    return _windows(spark, target, days).drop("counted")


def _windows(spark: SparkSession, target: str, days: Collection[date]) -> DataFrame:
    return log.latest(log.read(spark, f"{target}/windows", WINDOW_ROWS, days)).select(*WINDOW_ROWS.names)


def counts_of(spark: SparkSession, target: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Word counts of a job, of some days or all: window_start, window_end, token, cnt."""
    days = [d for d in day_names(spark, f"{target}/windows") if (first is None or d >= first) and (last is None or d <= last)]
    valid = _windows(spark, target, days).select("window_end", F.col("counted").alias("seq"))
    written = log.read(spark, f"{target}/counts", COUNT_ROWS, days)
    return written.join(valid, ["window_end", "seq"], "left_semi").filter("token <> ''").select(*COUNT_ROWS.names)


def _text(when: datetime) -> str:
    return f"{when:%Y-%m-%d %H:%M:%S}"


def _at(when: datetime) -> Column:
    return F.lit(_text(when)).cast("timestamp")


def _end() -> Column:
    """The window end as text, in UTC."""
    return F.date_format("window_end", "yyyy-MM-dd HH:mm:ss")


def _time(text: str) -> datetime:
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def _at_times(rows: DataFrame, times: Collection[datetime]) -> DataFrame:
    """Rows of the listed window ends; the range reaches the scan. 144 times a day at most."""
    if not times:
        return rows.limit(0)
    listed = rows.sparkSession.createDataFrame([(_text(t),) for t in times], "at string")
    listed = F.broadcast(listed.select(F.col("at").cast("timestamp").alias("window_end")))
    near = rows.filter(F.col("window_end").between(_at(min(times)), _at(max(times))))
    return near.join(listed, "window_end", "left_semi")


def _fired(spark: SparkSession, target: str, days: Collection[date]) -> dict[datetime, int]:
    """Ends of the stored windows of some days, in order, and the write their words came with."""
    rows = _windows(spark, target, days).select(_end().alias("at"), "counted").collect()
    return {_time(r["at"]): r["counted"] for r in sorted(rows)}


def _counts_at(spark: SparkSession, target: str, fired: Mapping[datetime, int], times: Collection[datetime]) -> DataFrame:
    """Word counts of some windows; only the writes they came with are opened."""
    written = log.read(spark, f"{target}/counts", COUNT_ROWS, {t.date() for t in times})
    if not times:
        return written.limit(0).select(*COUNT_ROWS.names)
    written = written.filter(F.col("seq").isin(sorted({fired[t] for t in times})))
    written = written.filter(F.col("window_end").between(_at(min(times)), _at(max(times))))
    named = spark.createDataFrame([(_text(t), fired[t]) for t in times], "at string, seq long")
    valid = F.broadcast(named.select(F.col("at").cast("timestamp").alias("window_end"), "seq"))
    return written.join(valid, ["window_end", "seq"], "left_semi").filter("token <> ''").select(*COUNT_ROWS.names)


def _start(
    rows: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Mapping[str, object],
    mode: str = "append",
) -> StreamingQuery:
    return (
        rows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(each)
        .trigger(**trigger)
        .start()
    )


# Lateness -----------------------------------------------------------------------------------


def _closed_until(spark: SparkSession, path: str, batch_id: int, lateness: str | None) -> Column:
    """Windows that end here or earlier are closed: the newest message of earlier batches less the lateness."""
    if lateness is not None:
        for day in reversed(day_names(spark, path)):
            rows = log.read(spark, path, ARRIVED_ROWS, [day]).filter(F.col("batch") < batch_id)
            newest = rows.agg(F.date_format(F.max("last_ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
            if newest is not None:
                return F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
    return F.lit(None).cast("timestamp")


def _arrived(rows: DataFrame, path: str, batch_id: int, closed: Column) -> list[date]:
    """Store message counts by window, marked if late; returns the days of those that are not."""
    late = F.coalesce(F.col("window_end") <= closed, F.lit(False))
    marked = rows.withColumns({"batch": F.lit(batch_id).cast("long"), "late": late})
    seen = Observation()
    day = F.when(~F.col("late"), F.date_format("window_end", "yyyy-MM-dd"))
    log.append(marked, path, observe=(seen, F.collect_set(day).alias("days")))
    return sorted(date.fromisoformat(d) for d in seen.get["days"] or [])


def late_messages(spark: SparkSession, target: str, days: Collection[date] | None = None) -> DataFrame:
    """Late messages by window: window_end, traffic (by the traffic job), posts (by the word jobs)."""
    keys = ("window_end", "late")
    traffic = log.latest(log.read(spark, f"{target}/totals", ARRIVED_ROWS, days), keys)
    # a late count holds what had come in time
    over = traffic.groupBy("window_end").agg(
        F.max(F.when(F.col("late"), F.col("total_posts"))).alias("whole"),
        F.max(F.when(~F.col("late"), F.col("total_posts"))).alias("in_time"),
    )
    zero = F.lit(0).cast("long")
    by_traffic = over.filter("whole is not null").select(
        "window_end", (F.col("whole") - F.coalesce("in_time", zero)).alias("traffic"), zero.alias("posts")
    )
    posts = log.latest(log.read(spark, f"{target}/arrivals", ARRIVED_ROWS, days), ("window_end", "batch")).filter("late")
    by_posts = posts.select("window_end", zero.alias("traffic"), F.col("total_posts").alias("posts"))
    return by_traffic.unionByName(by_posts).groupBy("window_end").agg(
        F.sum("traffic").alias("traffic"), F.sum("posts").alias("posts")
    )


# Traffic ------------------------------------------------------------------------------------


def traffic_state(messages: DataFrame, duration: str = "10 minutes") -> DataFrame:
    """Messages per window with the newest time; in a stream, the state of the job."""
    counted = windowed(messages, duration).groupBy("w").agg(
        F.count(F.lit(1)).alias("total_posts"), F.max("ts").alias("last_ts")
    )
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "total_posts", "last_ts")


def put_traffic(
    totals: DataFrame, target: str, batch_id: int = 0, duration: str = "10 minutes", lateness: str | None = None
) -> None:
    """Store whole counts of windows and write the snapshots they change.

    A snapshot depends on its window and the one before, so those of the windows stored and of
    the windows after these are written, and no others.
    """
    spark, path = totals.sparkSession, f"{target}/totals"
    closed = _closed_until(spark, path, batch_id, lateness)
    days = _arrived(totals, path, batch_id, closed)
    if days:
        _show_traffic(spark, target, days, _last_write(spark, path, days), duration)


def _last_write(spark: SparkSession, path: str, days: list[date]) -> int:
    return max(int(n) for d in days for n in folder_names(spark, f"{path}/window_day={d.isoformat()}", "seq"))


def _show_traffic(spark: SparkSession, target: str, days: list[date], seq: int, duration: str) -> None:
    near = {d + k * DAY for d in days for k in (-1, 0, 1)}
    rows = log.read(spark, f"{target}/totals", ARRIVED_ROWS, near).filter("not late")
    changed = rows.filter(F.col("seq") == seq).select(
        F.explode(F.array(F.col("window_end"), F.col("window_end") + F.expr(f"INTERVAL {duration}"))).alias("window_end")
    )
    now = traffic_summary(log.latest(rows).select("window_end", "total_posts"), duration)
    now = now.join(changed, "window_end", "left_semi")
    write_snapshot(
        now.select("total_posts", "prev_total_posts", "traffic_increase_rate", "window_end", "summary"),
        target,
        "traffic",
    )


def add_traffic(batch: DataFrame, target: str, batch_id: int = 0, duration: str = "10 minutes") -> None:
    """The same for a batch of messages without a stream behind it: its counts join the stored ones."""
    spark = batch.sparkSession
    rows = traffic_state(batch, duration).withColumns(
        {"window_day": F.to_date("window_end"), "batch": F.lit(batch_id).cast("long")}
    )
    seen = Observation()
    overwrite_partitions(
        rows.coalesce(1).observe(seen, F.collect_set(_end()).alias("ends")),  # one row a window
        f"{target}/parts",
        ["window_day", "batch"],
    )
    touched = [_time(t) for t in seen.get["ends"] or []]
    if touched:
        parts = _at_times(read_days(spark, f"{target}/parts", rows.schema, days={t.date() for t in touched}), touched)
        whole = parts.groupBy("window_start", "window_end").agg(
            F.sum("total_posts").alias("total_posts"), F.max("last_ts").alias("last_ts")
        )
        put_traffic(whole, target, batch_id, duration)


def run_traffic(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    params: StreamParams = StreamParams(),
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Traffic per window. ``messages`` needs ``ts`` only."""
    return _start(
        traffic_state(messages.select("ts"), params.window),
        lambda df, i: put_traffic(df, target, i, params.window, params.lateness),
        checkpoint,
        trigger,
        "update",
    )


# Words --------------------------------------------------------------------------------------


def add_posts(
    batch: DataFrame,
    target: str,
    params: StreamParams = StreamParams(),
    batch_id: int = 0,
    top: bool = True,
    rising: bool = True,
    words: str | None = None,
) -> None:
    """Add the posts of a batch, count the windows it touches anew and write the snapshots they change.

    ``words`` names a word list to leave out, of any length; short lists are a setting.

    A post is tokenized once, when it arrives. Its words are stored with its arrival, so that the
    first arrival of a url can be found again when more batches bring posts of the same window.
    """
    spark, seen = batch.sparkSession, Observation()
    if params.lateness is not None:
        path = f"{target}/arrivals"
        closed = _closed_until(spark, path, batch_id, params.lateness)
        _arrived(traffic_state(batch, params.window), path, batch_id, closed)
        end = F.window("ts", params.window)["end"]
        batch = batch.filter(~F.coalesce(end <= closed, F.lit(False)))
    arrived = post_tokens(batch, params, ("ts", "msg_id")).select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "url", "ts", "msg_id", "tokens",
    )
    keyed = arrived.withColumns({"window_day": F.to_date("window_end"), "batch": F.lit(batch_id).cast("long")})
    overwrite_partitions(
        keyed.hint("rebalance", *BY_WINDOW).observe(seen, F.collect_set(_end()).alias("ends")),
        f"{target}/posts",
        ["window_day", "batch"],
    )
    touched = sorted(_time(t) for t in seen.get["ends"] or [])
    if not touched:
        return
    firsts: dict[date, datetime] = {}
    for t in touched:
        firsts.setdefault(t.date(), t)
    _drop_totals(spark, target, firsts)
    _count_windows(spark, target, keyed.schema, touched, words)
    if top:
        _show_top(spark, target, params, firsts)
    if rising:
        _show_rising(spark, target, params, touched)


def _count_windows(
    spark: SparkSession, target: str, schema: T.StructType, touched: list[datetime], words: str | None
) -> None:
    """Word counts and totals of the touched windows, from all posts stored for them.

    The counts hold for readers once the log of windows names their write.
    """
    days = {t.date() for t in touched}
    stored = _at_times(read_days(spark, f"{target}/posts", schema, days=days), touched)
    window = F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end"))
    once = first_rows(stored.withColumn("w", window), ["w", "url"], ("ts", "msg_id"))
    counts = f"{target}/counts"
    listed = None if words is None else read_words(spark, words)
    seq = log.append(without_listed(token_rows(once), listed).select(*COUNT_ROWS.names), counts, by=BY_WINDOW)
    own = log.read(spark, counts, COUNT_ROWS, days).filter((F.col("seq") == seq) & (F.col("token") == ""))
    log.append(
        own.select("window_start", "window_end", F.col("cnt").alias("total_posts"), F.lit(seq).alias("counted")).coalesce(1),
        f"{target}/windows",
    )


def _kept(spark: SparkSession, target: str, day: date) -> list[datetime]:
    """Windows of a day up to which running totals are kept."""
    names = folder_names(spark, f"{target}/running/window_day={day.isoformat()}", "upto")
    return sorted(datetime.strptime(f"{day.isoformat()} {n}", "%Y-%m-%d %H%M%S") for n in names)


def _drop_totals(spark: SparkSession, target: str, firsts: Mapping[date, datetime]) -> None:
    """Running totals up to windows that are about to change, or past them, are void."""
    for day, first in firsts.items():
        for upto in _kept(spark, target, day):
            if upto >= first:
                remove_folder(spark, f"{target}/running/window_day={day.isoformat()}/upto={upto:%H%M%S}")


def _totals_before(spark: SparkSession, target: str, fired: Mapping[datetime, int], first: datetime) -> DataFrame | None:
    """Word counts of the day before a window: kept totals, as of their last window, and counts since.

    Totals are kept anew here once enough windows have fired since the last ones.
    """
    day = first.date()
    kept = _kept(spark, target, day)
    since = [t for t in fired if t.date() == day and t < first and (not kept or t > kept[-1])]
    parts = []
    if kept:
        parts.append(_read_totals(spark, target, day, kept[-1]))
    if since:
        parts.append(_counts_at(spark, target, fired, since))
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if len(since) < KEPT_EVERY:
        return rows
    upto = since[-1]
    totals = rows.groupBy("token").agg(F.sum("cnt").alias("cnt")).select(
        _at(upto - TEN_MINUTES).alias("window_start"), _at(upto).alias("window_end"), "token", "cnt",
        F.lit(day).alias("window_day"), F.lit(f"{upto:%H%M%S}").alias("upto"),
    )
    overwrite_partitions(totals, f"{target}/running", ["window_day", "upto"])
    return _read_totals(spark, target, day, upto)


def _read_totals(spark: SparkSession, target: str, day: date, upto: datetime) -> DataFrame:
    root = f"{target}/running"
    rows = spark.read.schema(TOTAL_ROWS).option("basePath", root)
    return rows.parquet(f"{root}/window_day={day.isoformat()}/upto={upto:%H%M%S}").select(*COUNT_ROWS.names)


def _show_top(spark: SparkSession, target: str, params: StreamParams, firsts: Mapping[date, datetime]) -> None:
    """Top words of the windows of each day from the first touched one on."""
    fired = _fired(spark, target, set(firsts))
    changed = [t for t in fired if t >= firsts[t.date()]]
    counts = _counts_at(spark, target, fired, changed)
    for first in firsts.values():
        before = _totals_before(spark, target, fired, first)
        counts = counts if before is None else counts.unionByName(before)
    windows = _windows(spark, target, set(firsts)).drop("counted")
    closed = _at_times(windows, changed)
    if len(changed) == 1:  # the usual case: the newest window
        ranked = top_tokens_latest(counts, closed, params.top_n)
    else:
        able = top_contenders(counts, closed, windows, params.top_n)
        ranked = top_tokens(able, closed, params.top_n, params.window)
    write_snapshot(top_snapshot(ranked, closed, params.top_n), target, "top", params.ttl_seconds)


def _show_rising(spark: SparkSession, target: str, params: StreamParams, touched: list[datetime]) -> None:
    """Rising words of the touched windows and of those that fired next."""
    days = day_names(spark, f"{target}/windows")
    near = set()
    for day in {t.date() for t in touched}:
        at = days.index(day)
        near |= {*days[max(at - 1, 0) : at + 2]}
    fired = _fired(spark, target, near)
    order = list(fired)
    places = {t: i for i, t in enumerate(order)}
    shown = {order[j] for t in touched for j in (places[t], places[t] + 1) if j < len(order)}
    needed = shown | {order[places[t] - 1] for t in shown if places[t] > 0}
    windows = _windows(spark, target, near).drop("counted")
    # a needed window that is not shown has no place of its own in the order of these, but is not asked for
    risen = rising_tokens(
        _counts_at(spark, target, fired, needed), _at_times(windows, needed),
        params.top_n, params.min_count, params.min_delta,
    )
    closed = _at_times(windows, shown)
    risen = risen.join(closed.select("window_end"), "window_end", "left_semi")
    write_snapshot(rising_snapshot(risen, closed, params.top_n), target, "rising", params.ttl_seconds)


def run_trends(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    params: StreamParams = StreamParams(),
    trigger: Mapping[str, object] = ONCE,
    top: bool = True,
    rising: bool = True,
    words: str | None = None,
) -> StreamingQuery:
    """Top and rising words from one pass over the messages, without those of a word list if one is named."""
    return _start(
        messages, lambda df, i: add_posts(df, target, params, i, top, rising, words), checkpoint, trigger
    )


def run_top_tokens(messages: DataFrame, target: str, checkpoint: str, **more) -> StreamingQuery:
    return run_trends(messages, target, checkpoint, rising=False, **more)


def run_rising_tokens(messages: DataFrame, target: str, checkpoint: str, **more) -> StreamingQuery:
    return run_trends(messages, target, checkpoint, top=False, **more)


def compact_history(spark: SparkSession, target: str, days: Collection[date] | None = None) -> None:
    """One write per day in the logs of windows and snapshots."""
    log.compact(spark, f"{target}/windows", WINDOW_ROWS, days)
    for name in ("traffic", "top", "rising"):
        log.compact(spark, f"{target}/{name}", SNAPSHOT_ROW, days)


def run_landing(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] = ONCE,
    on_batch: Callable[[int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Store the first post of each url. ``messages`` are decoded posts with ``ts, msg_id``.

    A failed write fails the batch, which then runs again; stored urls are skipped.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        counts = land_posts(to_stored_post(batch, "ts", "msg_id"), path, ["ts", "msg_id"])
        if on_batch is not None:
            on_batch(batch_id, counts)

    return _start(messages, land, checkpoint, trigger)
