import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulse.operators import windows as w
from pulse.schema import StreamParams

SCHEMA = "ts timestamp, msg_id bigint, url string, title string, content_text string"
START = datetime(2024, 1, 1, 23, 0, tzinfo=UTC)
MIN = timedelta(minutes=1)


def frame(spark, rows):
    return spark.createDataFrame(
        [(ts, i, url, None, text) for i, (ts, url, text) in enumerate(rows)], SCHEMA
    )


def end_of(ts):
    return ts - timedelta(minutes=ts.minute % 10, seconds=ts.second) + 10 * MIN


def model(rows, n=20, min_count=5, min_delta=3):
    """Both token jobs as a state machine over fired windows."""
    fired = {}
    for i, (ts, url, text) in sorted(enumerate(rows), key=lambda r: (r[1][0], r[0])):
        posts = fired.setdefault(end_of(ts), {})
        if url and url not in posts:
            posts[url] = set(text.split())
    top, rising, cum, prev, day = [], [], {}, {}, None
    for end in sorted(fired):
        posts, counts = fired[end], {}
        for words in posts.values():
            for token in words:
                counts[token] = counts.get(token, 0) + 1
        if end.date() != day:
            cum, day = {}, end.date()
        for token, c in counts.items():
            cum[token] = cum.get(token, 0) + c
        best = sorted(cum.items(), key=lambda x: (-x[1], x[0]))[:n]
        for rank, (token, c) in enumerate(best, 1):
            before = c - counts.get(token, 0)
            rate = (c - before) / before if before > 0 else None
            part = c / len(posts) if posts else 0.0
            top.append((end, rank, token, c, before, rate, None if before else "NEW", part, len(posts)))
        found = []
        for token in set(prev) | set(counts):
            c, p = counts.get(token, 0), prev.get(token, 0)
            if c < min_count or c - p < min_delta:
                continue
            rate = (c - p) / p if p > 0 else None
            label = None if p > 0 else "—" if c == 0 else "NEW"
            found.append((token, c, p, c - p, rate, label))
        found.sort(key=lambda x: (-x[3], -(x[4] if x[4] is not None else -1.0), -x[1], x[0]))
        rising += [(end, r, *f) for r, f in enumerate(found[:n], 1)]
        prev = counts
    return top, rising


def random_rows(seed, windows=30, vocabulary=40, per_window=25):
    rng = random.Random(seed)
    words = [f"w{i:02d}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    rows = []
    for k in range(windows):
        if rng.random() < 0.2:
            continue
        for _ in range(rng.randint(1, per_window)):
            ts = START + timedelta(minutes=10 * k, seconds=rng.randint(0, 599))
            url = None if rng.random() < 0.1 else f"u{rng.randint(0, 60)}"
            rows.append((ts, url, " ".join(rng.choices(words, weights, k=rng.randint(0, 8)))))
    rows.append((START + timedelta(minutes=10 * windows + 35), None, ""))  # undecodable only
    rows.append((START + timedelta(minutes=10 * windows + 45), "last", "w00 w01 fresh"))
    return rows


def utc(ts):
    return ts.replace(tzinfo=UTC) if ts.tzinfo is None else ts


def run(spark, rows, **params):
    p = StreamParams(**params)
    messages = frame(spark, rows)
    counts, windows = w.window_token_counts(messages, p), w.window_posts(messages)
    iso = F.unix_timestamp("window_end").alias("e")
    top = w.top_tokens(counts, windows, p.top_n).select(
        iso, "rank", "token", "count", "prev_count", "increase_rate", "increase_label", "share", "total_posts"
    )
    risen = w.rising_tokens(counts, windows, p.top_n, p.min_count, p.min_delta).select(
        iso, "rank", "token", "count", "prev_count", "delta", "rise_rate", "increase_label"
    )

    def rows_of(df):
        return [
            (datetime.fromtimestamp(r["e"], UTC), *tuple(r)[1:])
            for r in df.orderBy("e", "rank").collect()
        ]

    return rows_of(top), rows_of(risen)


@pytest.mark.parametrize("seed", [1, 2])
def test_top_and_rising_follow_the_state_machine(spark, seed):
    rows = random_rows(seed)
    assert run(spark, rows, top_n=5, min_count=3, min_delta=1) == model(rows, 5, 3, 1)


def test_words_that_vanished_count_when_zero_is_allowed(spark):
    rows = random_rows(3, windows=6)
    _, want = model(rows, 50, 0, -99)
    _, got = run(spark, rows, top_n=50, min_count=0, min_delta=-99)
    assert got == want
    assert any(r[3] == 0 for r in got)


def test_ties_at_the_edge_of_the_list(spark):
    rows = []
    for k in range(4):
        for i in range(6):
            rows.append((START + (10 * k) * MIN, f"u{k}{i}", f"t{(i * 7 + k * 5) % 11:02d}"))
    assert run(spark, rows, top_n=3, min_count=1, min_delta=1) == model(rows, 3, 1, 1)


def test_window_edges_and_midnight(spark):
    rows = [
        (START + 49 * MIN + timedelta(seconds=59), "a", "late"),
        (START + 50 * MIN, "b", "word"),  # ends at midnight, belongs to the new day
        (START + 60 * MIN, "c", "word"),
    ]
    top, _ = run(spark, rows)
    assert [(r[0].hour, r[0].minute, r[2], r[3]) for r in top] == [
        (23, 50, "late", 1), (0, 0, "word", 1), (0, 10, "word", 2)
    ]


def test_latest_top_equals_the_last_window_of_the_history(spark):
    rows = random_rows(5)
    messages = frame(spark, rows)
    counts, windows = w.window_token_counts(messages), w.window_posts(messages)
    history = w.top_tokens(counts, windows, 7)
    last = history.filter(F.col("window_end") == windows.agg(F.max("window_end")).first()[0])
    assert sorted(w.top_tokens_latest(counts, windows, 7).collect()) == sorted(last.collect())


def test_latest_rising_equals_the_last_window_of_the_history(spark):
    rows = random_rows(9)[:-2]
    messages = frame(spark, rows)
    counts, windows = w.window_token_counts(messages), w.window_posts(messages)
    history = w.rising_tokens(counts, windows, 7, 1, 0)
    last = history.filter(F.col("window_end") == windows.agg(F.max("window_end")).first()[0])
    got = sorted(w.rising_tokens_latest(counts, windows, 7, 1, 0).collect())
    assert got == sorted(last.collect()) and got


def test_undecodable_only_window_fires_and_clears(spark):
    rows = [(START, f"u{i}", "word") for i in range(6)]
    rows.append((START + 10 * MIN, None, ""))
    rows += [(START + 20 * MIN, f"u{i}", "word") for i in range(6)]
    _, risen = run(spark, rows)
    assert [(r[0].minute, r[4], r[7]) for r in risen] == [(10, 0, "NEW"), (30, 0, "NEW")]
    windows = w.window_posts(frame(spark, rows))
    assert sorted(r["total_posts"] for r in windows.collect()) == [0, 6, 6]


def test_gap_counts_as_last_fired_but_not_as_ten_minutes_earlier(spark):
    rows = [(START, f"u{i}", "word") for i in range(5)]
    rows += [(START + 40 * MIN, f"u{i}", "word") for i in range(9)]
    _, risen = run(spark, rows)
    assert [(r[3], r[4], r[5]) for r in risen] == [(5, 0, 5), (9, 5, 4)]
    traffic = w.traffic_delta(w.traffic_counts(frame(spark, rows))).orderBy("window_end").collect()
    assert [(r["total_posts"], r["prev_total_posts"], r["traffic_increase_rate"]) for r in traffic] == [
        (5, 0, None), (9, 0, None)
    ]


def test_traffic_counts_every_message(spark):
    rows = [(START, "a", "x"), (START, "a", "x"), (START, None, ""), (START + 10 * MIN, "a", "x")]
    got = w.traffic_delta(w.traffic_counts(frame(spark, rows))).orderBy("window_end").collect()
    assert [(r["total_posts"], r["prev_total_posts"], r["delta"]) for r in got] == [(3, 0, 3), (1, 3, -2)]


def test_first_arrival_wins_and_hot_urls_stay_one_row(spark):
    rows = [(START + timedelta(seconds=i % 500), "hot", f"w{i}") for i in range(3000)]
    rows.append((START, "other", "x1"))
    messages = frame(spark, rows)
    first = {r["url"]: r["tokens"] for r in w.post_tokens(messages).collect()}
    assert first == {"hot": ["w0"], "other": ["x1"]}


def test_listing_a_window_twice_changes_nothing(spark):
    messages = frame(spark, random_rows(6, windows=8))
    windows = w.window_posts(messages)
    once = w.fired_windows(windows).collect()
    assert sorted(w.fired_windows(windows.unionAll(windows)).collect()) == sorted(once)


def test_snapshots_are_nested_ranked_and_rounded(spark):
    rows = [(START, f"u{i}", "word") for i in range(6)]
    rows += [(START + 10 * MIN, f"u{i}", "word other") for i in range(7)]
    messages = frame(spark, rows)
    counts, windows = w.window_token_counts(messages), w.window_posts(messages)
    top = w.top_snapshot(w.top_tokens(counts, windows, 2), windows, 2).orderBy("window_end").collect()
    assert [i["token"] for i in top[1]["items"]] == ["word", "other"]
    assert top[1]["items"][0]["increase_rate"] == round(7 / 6, 4)
    assert top[1]["top_n"] == 2
    risen = w.rising_snapshot(w.rising_tokens(counts, windows, 2, 50), windows, 2).collect()
    assert [r["items"] for r in risen] == [[], []]


def test_latest_plans_filter_times_before_tokenizing(spark):
    from pulse.plans import trends

    day = datetime(2024, 1, 1, 22, 0, tzinfo=UTC)
    rows = [(day + timedelta(minutes=10 * i), i, f"u{i}", None, f"common word{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "ts timestamp, msg_id long, url string, title string, content_text string")
    p = StreamParams(min_count=1, min_delta=0)
    assert trends.last_windows(df, 2, p) == ["2024-01-02 01:10:00", "2024-01-02 01:00:00"]
    for latest, history in ((trends.top_latest, trends.top), (trends.rising_latest, trends.rising)):
        whole = history(df, p)
        last = whole.agg(F.max("window_end")).first()[0]
        want = whole.filter(F.col("window_end") == F.lit(last)).collect()
        assert sorted(map(str, latest(df, p).collect())) == sorted(map(str, want))
    # counted words: those of the kept windows alone
    near = trends.top_latest(df, p)._jdf.queryExecution().optimizedPlan().toString()
    assert "ts" in near and near.count("regexp_extract_all") >= 1
    assert near.index("regexp_extract_all") < near.index(">=")  # the filter stands below
    assert trends.top_latest(df.limit(0), p).collect() == []
    assert trends.rising_latest(df.limit(0), p).collect() == []


@pytest.mark.parametrize("urls", [40, 4])
def test_texts_are_not_moved_to_find_first_arrivals(spark, urls):
    """Neither without nor with urls that repeat in a window: the first exchange has counts only."""
    rows = [(START + i * MIN, f"u{i % urls}", f"word w{i}") for i in range(200)]
    counts = w.window_token_counts(frame(spark, rows))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(w" in plan
    assert ("BroadcastHashJoin" in plan) == (urls == 4)
    word = {r["cnt"] for r in counts.filter("token = 'word'").collect()}
    assert word == {10 if urls == 40 else 4}


def test_first_rows_by_shuffling(spark):
    rows = [(START + i * MIN, f"u{i % 7}", f"w{i}") for i in range(50)] + [(START, None, "x")] * 3
    df = frame(spark, rows)
    got = w.first_rows(df, ["url"], ["ts", "msg_id"], sent_bytes=0).collect()
    assert sorted(r["content_text"] for r in got) == ["w0", "w1", "w2", "w3", "w4", "w5", "w6", "x"]


def test_of_equal_arrivals_one_stays(spark):
    rows = [(START, "a", "one two"), (START, "a", "one two"), (START, "b", "one"), (START + MIN, "b", "late")]
    messages = frame(spark, rows).withColumn("msg_id", F.lit(7).cast("long"))
    assert {r["token"]: r["cnt"] for r in w.window_token_counts(messages).collect()} == {"one": 2, "two": 1}
    by_struct = messages.withColumn("msg_id", F.struct(F.lit(0).alias("partition"), F.lit(5).alias("offset")))
    assert {r["token"]: r["cnt"] for r in w.window_token_counts(by_struct).collect()} == {"one": 2, "two": 1}
    assert w.first_per_window(by_struct, ["content_text"]).count() == 2


def test_previous_counts_over_days_and_gaps(spark):

    start, step = datetime(2024, 1, 1, 22, 30, tzinfo=UTC), timedelta(minutes=10)
    ends = [start + step * k for k in (0, 1, 2, 8, 9, 10, 11, 160, 161, 500, 501, 502)]
    cnt = {(e, t): 1 + (i * 7 + j) % 5 for i, e in enumerate(ends) for j, t in enumerate(("all", "some")) if j == 0 or i % 3}
    counts = spark.createDataFrame([(e - step, e, t, n) for (e, t), n in cnt.items()], "window_start timestamp, window_end timestamp, token string, cnt long")
    windows = spark.createDataFrame([(e - step, e, 9) for e in ends], "window_start timestamp, window_end timestamp, total_posts long")
    before = dict(zip(ends, [None, *ends], strict=False))
    found = w.with_prev_fired(counts, windows)
    at = F.date_format("window_end", "yyyy-MM-dd HH:mm").alias("at")
    got = {(r["at"], r["token"]): (r["cnt"], r["prev_count"]) for r in found.select(at, "token", "cnt", "prev_count").collect()}
    assert got == {(f"{e:%Y-%m-%d %H:%M}", t): (n, cnt.get((before[e], t), 0)) for (e, t), n in cnt.items()}
    everything = w.with_prev_fired_all(counts, windows).filter("prev_count > 0 or cnt > 0").select(at, "token", "cnt", "prev_count")
    want = {(f"{e:%Y-%m-%d %H:%M}", t): (cnt.get((e, t), 0), cnt.get((before[e], t), 0)) for e in ends for t in ("all", "some")}
    assert {(r["at"], r["token"]): (r["cnt"], r["prev_count"]) for r in everything.collect()} == {k: v for k, v in want.items() if v != (0, 0)}


def test_no_group_holds_a_word_over_all_time(spark):
    """A word of every window of a year: the rows of its day and the last window before."""
    ends = spark.range(144 * 365).select(
        F.timestamp_add("MINUTE", F.col("id") * 10, F.lit("2023-01-01").cast("timestamp")).alias("window_end"),
        F.concat(F.lit("word"), (F.col("id") % 1).cast("string")).alias("token"),
    )
    counts = ends.select(F.expr("window_end - interval 10 minutes").alias("window_start"), "window_end", "token", F.lit(3).cast("long").alias("cnt"))
    windows = counts.select("window_start", "window_end", F.lit(3).cast("long").alias("total_posts"))
    found = w.with_prev_fired(counts, windows)
    assert found.agg(F.sum("prev_count")).first()[0] == 3 * (144 * 365 - 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(block" in plan and "windowspecdefinition(token" not in plan


@pytest.mark.parametrize("first_posts", [1, 40])
def test_only_contenders_are_ranked(spark, first_posts):
    """Words that cannot reach the first n are left out before ranking, and the ranking stays the same."""
    start, rows = datetime(2024, 1, 1, 22, 0, tzinfo=UTC), []
    for i in range(24):  # over midnight; the first window may hold next to nothing
        posts = first_posts if i == 0 else 40
        common = [(f"c{j}", max(1, posts * (9 - j) // 10 + (i * j) % 3)) for j in range(5)]
        late = [("burst", 39 if i in (9, 20) else 1)]
        rows += [(start + timedelta(minutes=10 * i), t, c) for t, c in common + late]
        rows += [(start + timedelta(minutes=10 * i), f"rare{i % 7}-{j}", 1 + (j + i) % 2) for j in range(30)]
    ten = F.expr("INTERVAL 10 MINUTES")
    counts = spark.createDataFrame(rows, "window_start timestamp, token string, cnt long").select(
        "window_start", (F.col("window_start") + ten).alias("window_end"), "token", "cnt"
    ).cache()
    closed = counts.groupBy("window_start", "window_end").agg(F.max("cnt").alias("total_posts"))
    for n in (2, 3, 400):
        able = w.top_contenders(counts, closed, closed, n)
        assert sorted(w.top_tokens(able, closed, n).collect()) == sorted(w.top_tokens(counts, closed, n).collect())
    few = {r["token"] for r in w.top_contenders(counts, closed, closed, 3).select("token").distinct().collect()}
    assert {"c0", "c1", "c2"} <= few
    if first_posts == 40:
        assert not any(t.startswith("rare") for t in few)
    # with an empty share to send all counts stay
    assert w.top_contenders(counts, closed, closed, 3, sent_bytes=0).count() == counts.count()
