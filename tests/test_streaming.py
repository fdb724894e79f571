import json
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulse.operators import windows as w
from pulse.operators.ingest import dead_letters, decode_messages, decode_posts
from pulse.operators.serve import decode, encode
from pulse.schema import RISING_SNAPSHOT, TOP_SNAPSHOT, TRAFFIC_SNAPSHOT, StreamParams
from pulse.sources.posts import stored_posts
from pulse.sources.readers import MESSAGE_ROW, read_dashboard, read_posts_stream, read_snapshot, read_snapshots
from pulse.sources.sinks import SNAPSHOT_ROW
from pulse.sources.store import day_names, folder_names
from pulse.streaming import jobs

START = datetime(2024, 1, 1, 23, 30, tzinfo=UTC)
PARAMS = StreamParams(top_n=3, min_count=2, min_delta=1)


def message(url, text):
    return json.dumps({"url": url, "title": None, "content_text": text})


def write(spark, path, rows, first_id=0):
    df = spark.createDataFrame(
        [(v, START + timedelta(seconds=s), first_id + i) for i, (s, v) in enumerate(rows)], MESSAGE_ROW
    )
    df.coalesce(1).write.mode("append").parquet(path)
    return df


FIRST = [
    (0, message("a", "news spark")), (5, message("a", "ignored")), (9, message("b", "news")),
    (700, "{broken"),  # a window of its own
    (1300, message("a", "news spark spark")), (1301, message("c", "spark")), (1302, message("d", "spark")),
]
SECOND = [
    (2000, message("e", "spark late")), (2001, message("f", "late")), (2600, message("g", "spark")),
    (9000, message("z", "end")),
]


def history(spark, target, name, schema):
    rows = read_snapshots(spark, target, name).select("payload")
    return [tuple(r) for r in decode(rows, schema).orderBy("window_end").collect()]


def batch_rows(spark, rows, first_id=0):
    df = spark.createDataFrame(
        [(v, START + timedelta(seconds=s), first_id + i) for i, (s, v) in enumerate(rows)], MESSAGE_ROW
    )
    return decode_messages(df)


def expected(spark, rows):
    messages = batch_rows(spark, rows)
    counts, windows = w.window_token_counts(messages, PARAMS), w.window_posts(messages)
    top = w.top_snapshot(w.top_tokens(counts, windows, 3), windows, 3)
    risen = w.rising_snapshot(w.rising_tokens(counts, windows, 3, 2, 1), windows, 3)
    return tuple(
        [tuple(r) for r in decode(encode(df), schema).orderBy("window_end").collect()]
        for df, schema in ((top, TOP_SNAPSHOT), (risen, RISING_SNAPSHOT))
    )


def both(spark, target):
    return tuple(history(spark, target, n, x) for n, x in (("top", TOP_SNAPSHOT), ("rising", RISING_SNAPSHOT)))


def run_trends(spark, source, target):
    stream = decode_messages(read_posts_stream(spark, "parquet", {"path": source}))
    jobs.run_trends(stream, target, f"{target}/checkpoint", PARAMS).awaitTermination()


def test_trends_over_a_restart_equal_the_batch_result(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, source, FIRST)
    run_trends(spark, source, target)
    write(spark, source, SECOND, 100)
    run_trends(spark, source, target)  # a new query on the same checkpoint
    top, rising = expected(spark, FIRST + SECOND)
    assert len(top) == 6 and any(items for *_, items in rising)
    assert history(spark, target, "top", TOP_SNAPSHOT) == top
    assert history(spark, target, "rising", RISING_SNAPSHOT) == rising
    newest = read_snapshot(spark, target, "top").first()
    assert tuple(newest) == top[-1]
    run_trends(spark, source, target)  # nothing new
    assert history(spark, target, "top", TOP_SNAPSHOT) == top


def test_dashboard_of_stored_snapshots(spark, tmp_path):
    target = str(tmp_path)
    assert read_dashboard(spark, target).collect() == []
    jobs.add_posts(batch_rows(spark, FIRST), target, PARAMS)
    jobs.add_traffic(batch_rows(spark, FIRST), target)
    row = read_dashboard(spark, target, limit=1).first()
    assert row["traffic"]["total_posts"] == 3 and row["top"]["total_posts"] == 3
    assert [i["token"] for i in row["top"]["items"]] == ["spark"]
    assert len(row["rising"]["items"]) == 1
    later = datetime.now(UTC) + timedelta(days=2)
    row = read_dashboard(spark, target, later).first()
    assert row["traffic"] is not None and row["top"] is None and row["rising"] is None


def test_processing_time_puts_old_messages_in_the_present(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, source, FIRST)
    stream = read_posts_stream(spark, "parquet", {"path": source}, processing_time=True)
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    assert spark.read.parquet(out).filter("ts > current_timestamp() - INTERVAL 1 HOUR").count() == len(FIRST)


def test_a_replayed_batch_leaves_the_same_history(spark, tmp_path):
    target = str(tmp_path)
    for batch, rows in ((0, FIRST), (1, SECOND), (1, SECOND), (0, FIRST)):
        jobs.add_posts(batch_rows(spark, rows), target, PARAMS, batch)
        jobs.add_traffic(batch_rows(spark, rows), target, batch)
        if batch == 1:
            seen = (
                both(spark, target), sorted(jobs.counts_of(spark, target).collect()),
                sorted(jobs.windows_of(spark, target).collect()), history(spark, target, "traffic", TRAFFIC_SNAPSHOT),
            )
    assert seen == (
        both(spark, target), sorted(jobs.counts_of(spark, target).collect()),
        sorted(jobs.windows_of(spark, target).collect()), history(spark, target, "traffic", TRAFFIC_SNAPSHOT),
    )
    assert seen[0] == expected(spark, FIRST + SECOND)


@pytest.mark.parametrize("order", [1, -1])
def test_batches_in_any_order_equal_all_at_once(spark, tmp_path, order):
    rows, target = FIRST + SECOND, str(tmp_path)
    cut = [rows[i : i + 3] for i in range(0, len(rows), 3)]
    for i, part in list(enumerate(cut))[::order]:
        jobs.add_posts(batch_rows(spark, part, 3 * i), target, PARAMS, i)
        jobs.add_traffic(batch_rows(spark, part, 3 * i), target, i)
    assert both(spark, target) == expected(spark, rows)
    got = history(spark, target, "traffic", TRAFFIC_SNAPSHOT)
    assert [(g[0], g[1]) for g in got] == [(3, 0), (1, 3), (3, 1), (2, 3), (1, 2), (1, 0)]


def test_only_the_days_needed_are_opened(spark, tmp_path):
    target = str(tmp_path)
    for day in (3, 2, 1, 0):
        rows = [(86_400 * day + s, m) for s, m in FIRST[:3]]
        jobs.add_posts(batch_rows(spark, rows), target, PARAMS, day)
    assert [d.day for d in day_names(spark, f"{target}/windows")] == [1, 2, 3, 4]
    days = jobs.counts_of(spark, target, date(2024, 1, 3), date(2024, 1, 3)).inputFiles()
    assert days and all("window_day=2024-01-03" in f for f in days)
    files = read_snapshot(spark, target, "top").inputFiles()
    assert files and all("window_day=2024-01-04" in f for f in files)


def test_an_empty_batch_stores_nothing(spark, tmp_path):
    jobs.add_posts(batch_rows(spark, []), str(tmp_path), PARAMS)
    jobs.add_traffic(batch_rows(spark, []), str(tmp_path))
    assert jobs.windows_of(spark, str(tmp_path)).collect() == []


def test_traffic_counts_malformed_messages_and_looks_ten_minutes_back(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        stream = decode_messages(read_posts_stream(spark, "parquet", {"path": source}))
        jobs.run_traffic(stream, target, f"{target}/checkpoint", PARAMS).awaitTermination()

    write(spark, source, FIRST)
    run()
    write(spark, source, SECOND, 100)
    run()
    got = history(spark, target, "traffic", TRAFFIC_SNAPSHOT)
    assert [(g[0], g[1]) for g in got] == [(3, 0), (1, 3), (3, 1), (2, 3), (1, 2), (1, 0)]
    assert got[1][2] == -2 / 3 * 100.0
    assert tuple(read_snapshot(spark, target, "traffic").first())[:2] == (1, 0)


def test_landing_over_two_runs(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "posts")
    seen = []

    def run():
        stream = decode_posts(read_posts_stream(spark, "parquet", {"path": source}))
        query = jobs.run_landing(
            stream, path, str(tmp_path / "checkpoint"), on_batch=lambda _, counts: seen.append(counts)
        )
        query.awaitTermination()

    write(spark, source, FIRST)
    run()
    write(spark, source, [(3000, message("a", "newer")), (3001, message("y", "x"))], 100)
    run()
    rows = {r["url"]: r["content_text"] for r in stored_posts(spark, path).collect()}
    assert rows == {"a": "news spark", "b": "news", "c": "spark", "d": "spark", "y": "x"}
    assert seen == [{"inserted": 4, "skipped": 2}, {"inserted": 1, "skipped": 1}]


def test_dead_letters_of_a_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "dead")
    write(spark, source, FIRST)
    stream = dead_letters(read_posts_stream(spark, "parquet", {"path": source}))
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    assert [r["value"] for r in spark.read.parquet(out).collect()] == ["{broken"]


def test_late_rows_correct_their_window(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(0, message("a", "news")), (1300, message("b", "news"))]
    late = [(10, message("c", "news")), (9000, message("z", "end"))]
    write(spark, source, rows)
    run_trends(spark, source, target)
    write(spark, source, late, 100)
    run_trends(spark, source, target)
    assert both(spark, target) == expected(spark, rows + late)
    assert [t[2] for t in history(spark, target, "top", TOP_SNAPSHOT)] == [2, 1, 1]


def writes(spark, target, name):
    """Writes of each window in a log."""
    from pulse.sources import log

    rows = log.read(spark, f"{target}/{name}", SNAPSHOT_ROW).select(F.date_format("window_end", "dd HH:mm").alias("at"), "seq")
    found = {}
    for r in rows.collect():
        found.setdefault(r["at"], set()).add(r["seq"])
    return {at: len(seqs) for at, seqs in found.items()}


def test_a_late_message_leaves_other_windows_alone(spark, tmp_path):
    target = str(tmp_path)
    day = 86_400
    for i in range(4):
        rows = [(day * i + 600 * k, message(f"u{i}-{k}", "news spark")) for k in range(3, 6)]
        jobs.add_posts(batch_rows(spark, rows, 100 * i), target, PARAMS, i)
        jobs.add_traffic(batch_rows(spark, rows, 100 * i), target, i)
    before = {n: writes(spark, target, n) for n in ("traffic", "top", "rising")}
    late = [(day + 600 * 4, message("late", "news"))]
    jobs.add_posts(batch_rows(spark, late, 900), target, PARAMS, 9)
    jobs.add_traffic(batch_rows(spark, late, 900), target, 9)
    changed = {
        n: sorted(at for at, w in writes(spark, target, n).items() if w != before[n].get(at)) for n in before
    }
    # 23:30 on the first day plus a day and 40 minutes
    assert changed["traffic"] == ["03 00:20", "03 00:30"]
    assert changed["top"] == ["03 00:20", "03 00:30"]  # to the end of the day
    assert changed["rising"] == ["03 00:20", "03 00:30"]  # and the one that fired next


def test_a_newest_window_reads_running_totals_not_the_day(spark, tmp_path, monkeypatch):
    target, opened = str(tmp_path), []
    counts_at = jobs._counts_at
    monkeypatch.setattr(jobs, "_counts_at", lambda s, t, f, times: (opened.append(len(times)), counts_at(s, t, f, times))[1])
    monkeypatch.setattr(jobs, "KEPT_EVERY", 3)
    rows = [(1800 + 600 * k, message(f"u{k}", f"news w{k} spark")) for k in range(11)]
    for k, row in enumerate(rows):
        opened.clear()
        jobs.add_posts(batch_rows(spark, [row], k), target, PARAMS, k, rising=False)
        assert sum(opened) <= 1 + jobs.KEPT_EVERY
    assert both(spark, target)[0] == expected(spark, rows)[0]
    opened.clear()
    late = (1800 + 600 * 7, message("late", "news extra"))
    jobs.add_posts(batch_rows(spark, [late], 900), target, PARAMS, 99, rising=False)
    assert sum(opened) <= 4 + jobs.KEPT_EVERY  # the window, those after it, and those since the totals before it
    assert both(spark, target)[0] == expected(spark, [*rows, late])[0]


def test_late_messages_are_counted_apart(spark, tmp_path):
    target = str(tmp_path)
    params = StreamParams(top_n=3, min_count=2, min_delta=1, lateness="20 minutes")
    batches = [
        [(0, message("a", "news")), (3000, message("b", "news"))],  # to 00:20
        [(10, message("c", "news")), (1250, message("d", "news")), (3100, message("e", "news")), (1801, "{broken")],
        [(1200, message("f", "news"))],
    ]
    for i, rows in enumerate(batches):
        for _ in range(2):  # each is replayed
            jobs.add_posts(batch_rows(spark, rows, 10 * i), target, params, i)
            totals = batch_rows(spark, [r for part in batches[: i + 1] for r in part])
            jobs.put_traffic(jobs.traffic_state(totals), target, i, lateness=params.lateness)
    late = {r["at"]: (r["posts"], r["traffic"]) for r in jobs.late_messages(spark, target).select(
        F.date_format("window_end", "HH:mm").alias("at"), "posts", "traffic").collect()}
    assert late == {"23:40": (1, 1), "00:00": (2, 2)}
    kept = [rows for part in batches for rows in part if rows[0] not in (10, 1250, 1200)]
    assert [t[2] for t in both(spark, target)[0]] == [t[2] for t in expected(spark, kept)[0]] == [1, 0, 2]
    assert [(t[0], t[1]) for t in history(spark, target, "traffic", TRAFFIC_SNAPSHOT)] == [(1, 0), (1, 0), (2, 0)]


def test_compacting_the_history_changes_no_result(spark, tmp_path):
    target = str(tmp_path)
    for i, part in enumerate((FIRST, SECOND)):
        jobs.add_posts(batch_rows(spark, part, 100 * i), target, PARAMS, i)
        jobs.add_traffic(batch_rows(spark, part, 100 * i), target, i)
    seen = both(spark, target), history(spark, target, "traffic", TRAFFIC_SNAPSHOT)
    jobs.compact_history(spark, target)
    assert (both(spark, target), history(spark, target, "traffic", TRAFFIC_SNAPSHOT)) == seen
    for name in ("traffic", "top", "rising", "windows"):
        for day in day_names(spark, f"{target}/{name}"):
            assert len(folder_names(spark, f"{target}/{name}/window_day={day}", "seq")) == 1
    more = [(9100, message("y", "spark"))]
    jobs.add_posts(batch_rows(spark, more, 900), target, PARAMS, 2)
    assert both(spark, target) == expected(spark, FIRST + SECOND + more)


def test_a_word_list_of_a_file_is_left_out(spark, tmp_path):
    target, words = str(tmp_path / "out"), str(tmp_path / "words")
    spark.createDataFrame([("Spark",), ("# late",)], "value string").coalesce(1).write.text(words)
    jobs.add_posts(batch_rows(spark, FIRST + SECOND), target, PARAMS, words=words)
    assert {r["token"] for r in jobs.counts_of(spark, target).collect()} == {"news", "late", "end"}
    assert jobs.windows_of(spark, target).count() == 6
