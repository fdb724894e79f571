"""Ten-minute window operators: traffic, top words, rising words.

Shapes passed between the functions:

* messages  ``ts, msg_id, url, title, content_text`` (url null when undecodable)
* counts    ``window_start, window_end, token, cnt``, one row per window and word
* windows   ``window_start, window_end, total_posts``, one row per window that fired
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.functions.numbers import change_label, rate, serve_round, share, traffic_text
from pulse.functions.text import distinct_tokens, tokens_stream
from pulse.schema import StreamParams
from pulse.sources.store import materialize

TEN_MINUTES = "10 minutes"


def windowed(df: DataFrame, duration: str = TEN_MINUTES, ts: str = "ts") -> DataFrame:
    """Add the tumbling window a row falls into, aligned to the epoch."""
    return df.withColumn("w", F.window(F.col(ts), duration))


def _bounds(df: DataFrame, *rest: Column | str) -> DataFrame:
    return df.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest
    )


def traffic_counts(messages: DataFrame, duration: str = TEN_MINUTES) -> DataFrame:
    """Messages per window; repeats and undecodable ones count too."""
    counted = windowed(messages, duration).groupBy("w").agg(F.count(F.lit(1)).alias("total_posts"))
    return _bounds(counted, "total_posts")


def with_prev_exact(windows: DataFrame, step: str = TEN_MINUTES) -> DataFrame:
    """Add the count of the window that ended exactly one step earlier, 0 if it is missing.

    Each row is offered to its own end and to the next one, so one grouping over the
    small window table does what a self join would, with a single read of the input.
    """
    own = F.struct(
        F.col("window_end").alias("at"),
        F.col("total_posts").alias("cur"),
        F.lit(None).cast("long").alias("prev"),
    )
    ahead = F.struct(
        (F.col("window_end") + F.expr(f"INTERVAL {step}")).alias("at"),
        F.lit(None).cast("long").alias("cur"),
        F.col("total_posts").alias("prev"),
    )
    return (
        windows.select(F.explode(F.array(own, ahead)).alias("o"))
        .groupBy(F.col("o.at").alias("window_end"))
        .agg(
            F.max("o.cur").alias("total_posts"),
            F.coalesce(F.max("o.prev"), F.lit(0).cast("long")).alias("prev_total_posts"),
        )
        .filter(F.col("total_posts").isNotNull())
    )


def traffic_delta(windows: DataFrame, step: str = TEN_MINUTES) -> DataFrame:
    """Change against the window before, in posts and percent."""
    cur, prev = F.col("total_posts"), F.col("prev_total_posts")
    return with_prev_exact(windows, step).select(
        "window_end",
        "total_posts",
        "prev_total_posts",
        (cur - prev).alias("delta"),
        (rate(cur, prev) * 100.0).alias("traffic_increase_rate"),
    )


def traffic_summary(windows: DataFrame, step: str = TEN_MINUTES) -> DataFrame:
    return traffic_delta(windows, step).withColumn(
        "summary", traffic_text(F.col("total_posts"), F.col("prev_total_posts"))
    )


def _packed(order: Sequence[str], df: DataFrame) -> Column:
    """The order columns as one number, so that map tasks reduce it in place.

    A time and a whole number fit into 38 digits; any other order stays a struct, without texts.
    """
    kinds = [df.schema[c].dataType for c in order]
    whole = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    if len(order) == 2 and isinstance(kinds[0], T.TimestampType) and isinstance(kinds[1], whole):
        big = F.lit(str(1 << 64)).cast("decimal(20,0)")
        at = F.unix_micros(order[0]).cast("decimal(17,0)")
        return (at * big + F.col(order[1]).cast("decimal(19,0)")).cast("decimal(38,0)")
    return F.struct(*order)


#: Repeated keys are sent out to find their rows up to this many bytes.
SENT_BYTES = 64 << 20


def first_rows(
    df: DataFrame, key: Sequence[str], order: Sequence[str], sent_bytes: int = SENT_BYTES
) -> DataFrame:
    """The first row of each key; rows without a key value share one. Of rows equal in order one stays.

    Keys and order are reduced alone, without the other columns, and this is run at once. Only keys
    that come more than once are joined back, to leave out all but their first row. Their size is known
    by then: up to ``sent_bytes`` they are sent out and no row moves, beyond that both sides are shuffled.
    """
    at = _packed(order, df)
    slim = df.select(*key, at.alias("_at"))
    names = [f"_key_{i}" for i in range(len(key))]
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(key, names, strict=True)])
    whole = slim.groupBy(*[F.col(c).alias(n) for c, n in zip(key, names, strict=True)])
    repeated = whole.agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    repeated = materialize(repeated.filter("_rows > 1").select(*names, "_first"))
    size = repeated.agg(F.sum(F.length(F.to_json(F.struct(*names))) + 64)).first()[0]
    if size is None:
        return df

    def sent(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if size <= sent_bytes else rows

    firsts = slim.join(sent(repeated), same & (F.col("_at") == F.col("_first")))
    marks = materialize(firsts.groupBy(*names, "_first").agg((F.count(F.lit(1)) > 1).alias("_tied")))
    rows = df.withColumn("_own", at)
    first = F.col("_own") == F.col("_first")
    kept = rows.join(sent(marks), same, "left").filter(F.col("_first").isNull() | (first & ~F.col("_tied")))
    kept, tied = kept.select(*df.columns), marks.filter("_tied")
    if tied.isEmpty():
        return kept
    once = rows.join(sent(tied), same).filter(first).dropDuplicates(list(key))
    return kept.unionByName(once.select(*df.columns))


def first_per_window(
    messages: DataFrame,
    keep: Sequence[str],
    order: Sequence[str] = ("ts", "msg_id"),
    duration: str = TEN_MINUTES,
) -> DataFrame:
    """First arrival of each url in each window, with the columns to keep. Rows without url share one group."""
    return first_rows(windowed(messages, duration), ["w", "url"], order).select("w", "url", *keep)


def post_tokens(
    messages: DataFrame, params: StreamParams = StreamParams(), keep: Sequence[str] = ()
) -> DataFrame:
    """``w, url, tokens``: the distinct words of each post that arrived first in its window.

    ``keep`` names more columns of that arrival.

    Words are taken from the rows that stay. The row with a null url stands for undecodable messages.
    """
    own = messages.withColumn("url", F.nullif("url", F.lit("")))
    words = tokens_stream(
        F.col("title"), F.col("content_text"), params.stopwords, params.token_cap
    )
    first = first_per_window(own, [*keep, "title", "content_text"], duration=params.window)
    tokens = F.when(F.col("url").isNotNull(), distinct_tokens(words)).alias("tokens")
    return first.select("w", "url", *keep, tokens)


def token_rows(posts: DataFrame) -> DataFrame:
    """Posts per window and word out of :func:`post_tokens`.

    The row with the empty word carries the number of posts and is 0 for a window that holds
    undecodable messages only.
    """
    no_words = F.array().cast("array<string>")
    rows = _bounds(
        posts,
        F.col("url").isNotNull().cast("long").alias("one"),
        F.explode(
            F.concat(F.array(F.lit("")), F.coalesce(F.col("tokens"), no_words))
        ).alias("token"),
    )
    return rows.groupBy("window_start", "window_end", "token").agg(F.sum("one").alias("cnt"))


def without_listed(rows: DataFrame, words: DataFrame | None) -> DataFrame:
    """Count rows without those of listed words (``word``), for lists too long for a plan.

    One row per window and word is joined, not every mention. A cap on the words of a post comes before.
    """
    if words is None:
        return rows
    return rows.join(words.select(F.col("word").alias("token")), "token", "left_anti").select(*rows.columns)


def window_token_rows(messages: DataFrame, params: StreamParams = StreamParams()) -> DataFrame:
    """Posts per window and word, with the number of posts under the empty word."""
    return token_rows(post_tokens(messages, params))


def split_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Word counts and fired windows out of :func:`window_token_rows`."""
    counts = rows.filter(F.col("token") != "")
    windows = rows.filter(F.col("token") == "").select(
        "window_start", "window_end", F.col("cnt").alias("total_posts")
    )
    return counts, windows


def window_token_counts(
    messages: DataFrame, params: StreamParams = StreamParams(), words: DataFrame | None = None
) -> DataFrame:
    """Posts that contain a word, per window and word, without the words of a table if one is given."""
    return without_listed(split_rows(window_token_rows(messages, params))[0], words)


def window_posts(messages: DataFrame, duration: str = TEN_MINUTES) -> DataFrame:
    """Distinct posts per window, 0 for a window of undecodable messages only.

    Reads times and urls only, so it serves as the window list next to
    :func:`window_token_counts` without reading the texts again.
    """
    url = F.nullif("url", F.lit(""))
    per_url = windowed(messages, duration).groupBy("w", url.alias("url")).agg(F.count("*").alias("n"))
    counted = per_url.groupBy("w").agg(F.count("url").alias("total_posts"))
    return _bounds(counted, "total_posts")


def rank_in_window(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Row numbers from 1 in each window."""
    return df.withColumn(
        "rank", F.row_number().over(Window.partitionBy("window_end").orderBy(*order))
    )


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First n rows of each window; every map task forwards n rows per window at most."""
    return rank_in_window(df, order).filter(F.col("rank") <= n)


def count_order(count: str = "cnt") -> list[Column]:
    return [F.col(count).desc(), F.col("token").asc()]


def rising_order() -> list[Column]:
    """Largest gain first; words without a rate come after rated ones of equal gain."""
    return [
        F.col("delta").desc(),
        F.coalesce(F.col("rise_rate"), F.lit(-1.0)).desc(),
        F.col("cnt").desc(),
        F.col("token").asc(),
    ]


def window_top_tokens(counts: DataFrame, n: int = 20) -> DataFrame:
    return top_n(counts, n, count_order()).select("window_start", "window_end", "rank", "token", "cnt")


def cumulative_counts(counts: DataFrame) -> DataFrame:
    """Running count of a word over the UTC day of the window end.

    A group is one word of one day, at most 144 rows. ``next_end`` is the window in which the
    word occurs again that day, null when it does not.
    """
    day = F.to_date("window_end").alias("utc_day")
    word = Window.partitionBy("utc_day", "token").orderBy("window_end")
    return counts.select("window_start", "window_end", day, "token", "cnt").select(
        "*",
        F.sum("cnt").over(word.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
        F.lead("window_end").over(word).alias("next_end"),
    )


def top_contenders(
    counts: DataFrame, changed: DataFrame, fired: DataFrame, n: int = 20, sent_bytes: int = SENT_BYTES
) -> DataFrame:
    """The counts of all words that can be among the first n by running count in a window of their day.

    For :func:`top_tokens` over stored counts, which are read four times here but not shuffled. ``fired`` lists
    every window that has counts, ``changed`` those that are shown. The words with the largest counts in the
    fullest window of a day, five times n in case some are rare elsewhere, give a floor under the n-th running
    count of each of its windows. A word that reaches the floor of the k-th window has a k-th of it in one
    window up to there, so words without such a count are left out with all their rows. Where the words that
    stay take more than ``sent_bytes`` nothing is.
    """
    day = F.to_date("window_end").alias("day")
    fullest = changed.groupBy(day).agg(F.max(F.struct("total_posts", "window_end"))["window_end"].alias("at"))
    ends = [r["at"] for r in fullest.select(F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at")).collect()]
    if not ends:
        return counts
    # one window a day, named in the filter so that it reaches the scan
    full = counts.filter(F.col("window_end").isin([F.lit(e).cast("timestamp") for e in ends]))
    frequent = materialize(top_n(full, 5 * n, count_order()).select(day, "token").distinct())  # 5 n rows a day
    some = F.broadcast(frequent.select("token").distinct())
    found = counts.join(some, "token", "left_semi").groupBy("window_end", "token").agg(F.sum("cnt").alias("cnt"))
    by_day = Window.partitionBy("day").orderBy("window_end")
    places = fired.select("window_end", day).distinct().withColumn("k", F.row_number().over(by_day))
    so_far = Window.partitionBy("day", "token").orderBy("window_end")
    running = places.join(frequent, "day").join(found, ["window_end", "token"], "left").withColumn(
        "cum", F.sum(F.coalesce("cnt", F.lit(0))).over(so_far)
    )
    nth = F.get(F.sort_array(F.collect_list("cum"), asc=False), F.lit(n - 1))  # of 5 n at most; fewer than n are no floor
    least = F.coalesce(nth / F.col("k"), F.lit(0.0))
    floors = running.groupBy("day", "window_end", "k").agg(least.alias("least")).withColumn(
        "floor", F.min("least").over(by_day.rowsBetween(0, Window.unboundedFollowing))
    )
    floors = F.broadcast(materialize(floors.select("window_end", "floor")))  # 144 rows a day
    able = counts.join(floors, "window_end", "left").filter(F.col("floor").isNull() | (F.col("cnt") >= F.col("floor")))
    words = materialize(able.select("token").distinct())
    size = words.agg(F.sum(F.octet_length("token") + 64)).first()[0]
    if size is None or size > sent_bytes:
        return counts
    return counts.join(F.broadcast(words), "token", "left_semi").select(*counts.columns)


def top_tokens(
    counts: DataFrame, windows: DataFrame, n: int = 20, duration: str = TEN_MINUTES
) -> DataFrame:
    """Top words of every fired window by count since UTC midnight.

    A word also ranks in windows where it does not occur. Its running count holds until it
    occurs again, and no word that is outside the first n among the words of its own window
    can be among the first n later on while it stays unchanged: the n words before it only
    grow. So the first n of each window by running count, each held until ``next_end``, are
    all that can appear. Only those are written out for the windows they hold in, at most n
    for each pair of windows of a day however many words there are.
    """
    order = [F.col("cum").desc(), F.col("token").asc()]
    changed = top_n(cumulative_counts(counts), n, order)
    midnight = F.date_add("utc_day", 1).cast("timestamp")
    until = F.least("next_end", midnight) - F.expr("INTERVAL 1 MICROSECOND")
    held_in = F.sequence("window_end", until, F.expr(f"INTERVAL {duration}"))
    held = changed.select(
        "token",
        "cum",
        "cnt",
        F.col("window_end").alias("since"),
        F.explode(held_in).alias("window_end"),
    )
    here = F.when(F.col("since") == F.col("window_end"), F.col("cnt")).otherwise(
        F.lit(0).cast("long")
    )
    ranked = top_n(held.join(windows, "window_end"), n, order)
    return _top_columns(ranked.withColumn("here", here))


def _top_columns(ranked: DataFrame) -> DataFrame:
    cum, prev = F.col("cum"), F.col("cum") - F.col("here")
    return ranked.select(
        "window_start",
        "window_end",
        "total_posts",
        "rank",
        "token",
        cum.alias("count"),
        share(cum, F.col("total_posts")).alias("share"),
        share(F.col("here"), F.col("total_posts")).alias("window_share"),
        prev.alias("prev_count"),
        rate(cum, prev).alias("increase_rate"),
        change_label(cum, prev).alias("increase_label"),
    )


def top_tokens_latest(counts: DataFrame, windows: DataFrame, n: int = 20) -> DataFrame:
    """Top words of the last fired window only: one grouping of its day, then a top-n."""
    last = (
        windows.agg(F.max_by(F.struct(*windows.columns), "window_end").alias("last"))
        .select("last.*")
        .withColumn("utc_day", F.to_date("window_end"))
    )
    day_counts = counts.select(
        F.to_date("window_end").alias("utc_day"), F.col("window_end").alias("at"), "token", "cnt"
    )
    totals = (
        day_counts.join(F.broadcast(last), "utc_day")  # one row
        .filter(F.col("at") <= F.col("window_end"))
        .groupBy("window_start", "window_end", "total_posts", "token")
        .agg(
            F.sum("cnt").alias("cum"),
            F.coalesce(
                F.sum(F.when(F.col("at") == F.col("window_end"), F.col("cnt"))),
                F.lit(0).cast("long"),
            ).alias("here"),
        )
        .orderBy(F.col("cum").desc(), "token")
        .limit(n)
    )
    return _top_columns(rank_in_window(totals, [F.col("cum").desc(), F.col("token").asc()]))


def _neighbours(windows: DataFrame) -> DataFrame:
    """Each window once, with the ends of those that fired before and after it.

    The only ordering without a partition key; the window list has 144 rows a day.
    """
    once = windows.groupBy("window_end").agg(
        F.first("window_start").alias("window_start"), F.max("total_posts").alias("total_posts")
    )
    order = Window.orderBy("window_end")
    return once.withColumns(
        {"prev_end": F.lag("window_end").over(order), "next_end": F.lead("window_end").over(order)}
    )


def fired_windows(windows: DataFrame) -> DataFrame:
    """Each window once, with the end of the one that fired before it."""
    return _neighbours(windows).drop("next_end")


def with_prev_fired(counts: DataFrame, windows: DataFrame) -> DataFrame:
    """Add each word's count in the last window that fired, 0 if it was absent there.

    History is cut into UTC days. A day gets its own counts and, from the day before that has windows,
    those of the last window, so a group is one word of one day: 145 rows at most, however
    long the history. The word's row before counts only when it belongs to the window that fired last.
    """
    day, next_day = F.to_date("window_end"), F.to_date("next_end")
    listed = _neighbours(windows).select(
        "window_start", "window_end", "total_posts", "prev_end", day.alias("day"),
        F.when(next_day > day, F.array(day, next_day)).otherwise(F.array(day)).alias("handed"),
    )
    rows = counts.select("window_end", "token", "cnt").join(listed, "window_end")
    word = Window.partitionBy("block", "token").orderBy("window_end")
    back = rows.withColumn("block", F.explode("handed")).select(
        "*", F.lag("cnt").over(word).alias("last_cnt"), F.lag("window_end").over(word).alias("last_end")
    )
    prev = F.when(F.col("last_end") == F.col("prev_end"), F.col("last_cnt"))
    return back.filter("block = day").select(
        "window_start",
        "window_end",
        "total_posts",
        "token",
        "cnt",
        F.coalesce(prev, F.lit(0).cast("long")).alias("prev_count"),
    )


def token_universe(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """Every word of either side with both counts, 0 where absent."""
    zero = F.lit(0).cast("long")
    sides = cur.select("token", F.col("cnt").alias("cnt"), zero.alias("prev_count")).unionByName(
        prev.select("token", zero.alias("cnt"), F.col("cnt").alias("prev_count"))
    )
    return sides.groupBy("token").agg(
        F.sum("cnt").alias("cnt"), F.sum("prev_count").alias("prev_count")
    )


def _rising_columns(df: DataFrame, n: int, min_count: int, min_delta: int) -> DataFrame:
    cnt, prev = F.col("cnt"), F.col("prev_count")
    risen = (
        df.withColumn("delta", cnt - prev)
        .filter((cnt >= min_count) & (F.col("delta") >= min_delta))
        .withColumn("rise_rate", rate(cnt, prev))
    )
    return top_n(risen, n, rising_order()).select(
        "window_start",
        "window_end",
        "total_posts",
        "rank",
        "token",
        cnt.alias("count"),
        "prev_count",
        "delta",
        "rise_rate",
        change_label(cnt, prev).alias("increase_label"),
        share(cnt, F.col("total_posts")).alias("share"),
    )


def with_prev_fired_all(counts: DataFrame, windows: DataFrame) -> DataFrame:
    """As :func:`with_prev_fired`, with rows for words that vanished since the last window.

    Each count is offered to its own window and, as the previous count, to the next one.
    """
    fired = _neighbours(windows)
    later = fired.select("window_end", "next_end").filter("next_end is not null")
    zero = F.lit(0).cast("long")
    own = F.struct(F.col("window_end").alias("at"), F.col("cnt").alias("cnt"), zero.alias("prev"))
    ahead = F.struct(F.col("next_end").alias("at"), zero.alias("cnt"), F.col("cnt").alias("prev"))
    return (
        counts.select("window_end", "token", "cnt")
        .join(later, "window_end", "left")
        .select("token", F.explode(F.array(own, ahead)).alias("o"))
        .filter("o.at is not null")
        .groupBy(F.col("o.at").alias("window_end"), "token")
        .agg(F.sum("o.cnt").alias("cnt"), F.sum("o.prev").alias("prev_count"))
        .join(fired.drop("prev_end", "next_end"), "window_end")
    )


def rising_tokens(
    counts: DataFrame, windows: DataFrame, n: int = 20, min_count: int = 5, min_delta: int = 3
) -> DataFrame:
    """Words that gained most against the window that fired before.

    Words without a count in the window can only pass when ``min_count`` allows 0.
    """
    pairs = with_prev_fired if min_count > 0 else with_prev_fired_all
    return _rising_columns(pairs(counts, windows), n, min_count, min_delta)


def rising_tokens_latest(
    counts: DataFrame, windows: DataFrame, n: int = 20, min_count: int = 5, min_delta: int = 3
) -> DataFrame:
    """Rising words of the last fired window, from the counts of two windows only."""
    last = fired_windows(windows).orderBy(F.col("window_end").desc()).limit(2)
    near = counts.join(F.broadcast(last.select("window_end")), "window_end", "left_semi")  # 2 rows
    newest = last.orderBy(F.col("window_end").desc()).limit(1).select("window_end")
    risen = rising_tokens(near, last.drop("prev_end"), n, min_count, min_delta)
    kept = risen.join(F.broadcast(newest), "window_end", "left_semi")  # 1 row
    return kept.select(*risen.columns)


def top_snapshot(top: DataFrame, windows: DataFrame, n: int = 20) -> DataFrame:
    """Nested form of :func:`top_tokens`, one row per fired window."""
    return _snapshot(
        top, windows, n,
        ["rank", "token", "count", "share", "prev_count", "increase_rate", "increase_label"],
        ["share", "increase_rate"],
    )


def rising_snapshot(rising: DataFrame, windows: DataFrame, n: int = 20) -> DataFrame:
    """Nested form of :func:`rising_tokens`; a window without rising words has no items."""
    return _snapshot(
        rising, windows, n,
        ["rank", "token", "count", "prev_count", "delta", "rise_rate", "increase_label", "share"],
        ["share", "rise_rate"],
    )


def _snapshot(
    ranked: DataFrame, windows: DataFrame, n: int, names: list[str], rounded: list[str]
) -> DataFrame:
    fields = [
        (serve_round(F.col(c)) if c in rounded else F.col(c)).alias(c) for c in names
    ]
    items = ranked.groupBy("window_end").agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("items")  # n items at most
    )
    empty = F.array().cast(items.schema["items"].dataType)
    return windows.join(items, "window_end", "left").select(
        "window_start",
        "window_end",
        "total_posts",
        F.lit(n).alias("top_n"),
        F.coalesce("items", empty).alias("items"),
    )
