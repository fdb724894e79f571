import json
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulse.functions.text import DEFAULT_STOPWORDS
from pulse.operators import serve as s
from pulse.operators.ingest import route_posts
from pulse.plans import daily
from pulse.plans.collect import publish
from pulse.schema import POST, POST_MESSAGE, PREDICTION, REPORT, TOKEN_STATS, TRAFFIC_SNAPSHOT, DailyParams
from pulse.sources import posts
from pulse.sources import readers as r
from pulse.sources import sinks as k
from pulse.sources.store import read_or_empty

D1, D2, D3 = (date(2024, 1, d) for d in (1, 2, 3))
NOW = datetime(2024, 1, 10, tzinfo=UTC)


def stats(spark, *rows):
    return spark.createDataFrame(list(rows), TOKEN_STATS)


def stored(spark, path, schema):
    rows = read_or_empty(spark, path, schema).select(*schema.names).collect()
    return sorted(tuple(x) for x in rows)


def test_replacing_dates_clears_listed_days_and_keeps_others(spark, tmp_path):
    path = str(tmp_path / "stats")
    k.replace_dates(stats(spark, (D1, "a", 1, 1), (D2, "a", 2, 1), (D3, "a", 3, 1)), path, "stat_date", [D1, D2, D3])
    got = k.replace_dates(stats(spark, (D1, "b", 5, 1), (D3, "x", 9, 9)), path, "stat_date", [D1, D2], rebalance=True)
    assert got == {D1: 1, D2: 0}
    assert stored(spark, path, TOKEN_STATS) == [(D1, "b", 5, 1), (D3, "a", 3, 1)]


def test_replacing_with_nothing_on_a_new_table(spark, tmp_path):
    path = str(tmp_path / "stats")
    assert k.replace_dates(stats(spark), path, "stat_date", [D1]) == {D1: 0}
    assert stored(spark, path, TOKEN_STATS) == []


def test_a_table_can_be_rewritten_from_itself(spark, tmp_path):
    path = str(tmp_path / "stats")
    k.replace_dates(stats(spark, (D1, "a", 1, 1), (D2, "b", 1, 1)), path, "stat_date", [D1, D2])
    again = read_or_empty(spark, path, TOKEN_STATS).withColumn("mention_count", F.col("mention_count") + 1)
    k.replace_dates(again, path, "stat_date", [D1])
    assert stored(spark, path, TOKEN_STATS) == [(D1, "a", 2, 1), (D2, "b", 1, 1)]


@pytest.mark.parametrize("broadcast_bytes", [10**6, 0])
def test_landing_keeps_the_first_row_of_a_url(spark, tmp_path, broadcast_bytes):
    path = str(tmp_path / "posts")

    schema = type(POST)(list(POST.fields))
    schema.add("n", "integer")

    def frame(*rows):
        return spark.createDataFrame([(u, t, "", None, None, n) for u, t, n in rows], schema)

    land = lambda df: posts.land_posts(df, path, ["n"], broadcast_bytes, 8)
    assert land(frame(("a", "late", 2), ("a", "first", 1), ("b", "b", 3))) == {"inserted": 2, "skipped": 1}
    assert land(frame(("a", "new", 1), ("c", "c", 2), ("c", "c2", 3))) == {"inserted": 1, "skipped": 2}
    assert land(frame(("a", "new", 1), ("c", "c", 2))) == {"inserted": 0, "skipped": 2}
    assert land(frame((None, "x", 1), (None, "y", 2), ("", "z", 3))) == {"inserted": 0, "skipped": 3}
    assert land(frame()) == {"inserted": 0, "skipped": 0}
    assert sorted((x["url"], x["title"]) for x in posts.stored_posts(spark, path).collect()) == [
        ("a", "first"), ("b", "b"), ("c", "c")
    ]


def post_rows(spark, urls):
    return spark.createDataFrame([(u, u, "", None, None, 0) for u in urls], type(POST)([*POST.fields]).add("n", "integer"))


def test_a_batch_opens_only_buckets_that_may_hold_its_urls(spark, tmp_path, monkeypatch):
    path, buckets = str(tmp_path / "posts"), 1000
    old = [f"https://a.example/{i}" for i in range(3000)]
    posts.land_posts(post_rows(spark, old), path, ["n"], buckets=buckets)
    opened = []
    read = posts.stored_posts
    monkeypatch.setattr(posts, "stored_posts", lambda s, p, b: (opened.append(list(b)), read(s, p, b))[1])

    new = [f"https://b.example/{i}" for i in range(10)]
    assert posts.land_posts(post_rows(spark, new), path, ["n"], buckets=buckets) == {"inserted": 10, "skipped": 0}
    assert opened.pop() == []  # the filters know that all are new
    seen = old[:10]
    assert posts.land_posts(post_rows(spark, seen), path, ["n"], buckets=buckets) == {"inserted": 0, "skipped": 10}
    own = {r[0] for r in post_rows(spark, seen).select(posts.bucket_of(F.col("url"), buckets)).collect()}
    assert set(opened[0]) == own and len(own) <= 10
    files = read(spark, path, opened[0]).inputFiles()
    assert {int(f.split("/bucket=")[1].split("/")[0]) for f in files} == own
    assert read(spark, path).count() == 3010


def test_lost_and_full_filters_lose_no_row(spark, tmp_path, monkeypatch):
    from pulse.sources.store import remove_folder

    path = str(tmp_path / "posts")
    monkeypatch.setattr(posts, "FILTER_WORDS", 1)  # soon full
    urls = [f"u{i}" for i in range(400)]
    for part in (urls[:100], urls[50:300], urls):
        posts.land_posts(post_rows(spark, part), path, ["n"], buckets=4)
    assert sorted(r["url"] for r in posts.stored_posts(spark, path).collect()) == sorted(urls)
    remove_folder(spark, f"{path}/filters/bucket=1")
    remove_folder(spark, f"{path}/filters/bucket=2")
    assert posts.land_posts(post_rows(spark, [*urls, "x"]), path, ["n"], buckets=4) == {"inserted": 1, "skipped": 400}
    assert posts.land_posts(post_rows(spark, [*urls, "x"]), path, ["n"], buckets=4)["inserted"] == 0


def test_compacting_keeps_rows_and_filters(spark, tmp_path):
    path = str(tmp_path / "posts")
    for i in range(4):
        posts.land_posts(post_rows(spark, [f"u{i}-{j}" for j in range(20)]), path, ["n"], buckets=2)
    assert len(posts.stored_posts(spark, path).inputFiles()) == 8
    assert posts.compact_posts(spark, path, 2, 2) == [0, 1]
    assert len(posts.stored_posts(spark, path).inputFiles()) == 2
    again = post_rows(spark, [f"u{i}-{j}" for i in range(5) for j in range(20)])
    assert posts.land_posts(again, path, ["n"], buckets=2) == {"inserted": 20, "skipped": 80}
    assert posts.stored_posts(spark, path).count() == 100


def traffic(spark, minute, total):
    end = datetime(2024, 1, 9, 12, minute, tzinfo=UTC)
    layout = (
        "total_posts bigint, prev_total_posts bigint, traffic_increase_rate double, "
        "window_end timestamp, summary string"
    )
    return spark.createDataFrame([(total, 0, None, end, f"s{total}")], layout)


def test_snapshots_serve_the_newest_that_is_alive(spark, tmp_path):
    path = str(tmp_path)
    assert r.read_snapshot(spark, path, "traffic", NOW).collect() == []
    k.write_snapshot(traffic(spark, 20, 2), path, "traffic", 60, NOW)
    k.write_snapshot(traffic(spark, 10, 1), path, "traffic", 3600, NOW)
    k.write_snapshot(traffic(spark, 20, 2), path, "traffic", 60, NOW)  # replayed
    read = lambda at: [tuple(x) for x in r.read_snapshot(spark, path, "traffic", at).collect()]
    assert read(NOW) == [(2, 0, None, "2024-01-09T12:20:00Z", "s2")]
    assert read(NOW + timedelta(minutes=2)) == [(1, 0, None, "2024-01-09T12:10:00Z", "s1")]
    assert read(NOW + timedelta(hours=2)) == []
    k.write_snapshot(traffic(spark, 30, 3), path, "traffic")  # never expires
    assert read(NOW + timedelta(days=900))[0][0] == 3


def test_malformed_snapshot_is_no_snapshot(spark):
    df = spark.createDataFrame([('{"total_posts": 1',), ("[]",), ('{"total_posts": 7}',)], "payload string")
    assert [x["total_posts"] for x in s.decode(df, TRAFFIC_SNAPSHOT).collect()] == [7]


def report(spark, *rows):
    return spark.createDataFrame([(d, t, "s", "md", kw, NOW) for d, t, kw in rows], REPORT)


def test_reports_are_updated_by_date_and_keep_their_first_time(spark, tmp_path):
    path = str(tmp_path / "reports")
    k.upsert_reports(report(spark, (D1, "one", '["a", "b"]'), (D2, "two", "oops")), path)
    later = report(spark, (D2, "two again", "[]"), (D3, "three", None)).withColumn(
        "created_at", F.lit(datetime(2030, 1, 1, tzinfo=UTC))
    )
    k.upsert_reports(later, path)
    table = read_or_empty(spark, path, REPORT)
    rows = s.list_reports(table, 2).withColumn("year", F.year("created_at")).collect()
    assert [(x["report_date"], x["title"], x["year"]) for x in rows] == [(D3, "three", 2030), (D2, "two again", 2024)]
    assert s.get_report(table, D1).first()["keywords"] == ["a", "b"]
    assert s.get_report(table, D3).first()["keywords"] is None
    assert s.get_report(report(spark, (D2, "x", "oops")), D2).first()["keywords"] is None
    assert s.get_report(table, date(2020, 1, 1)).collect() == []


def test_report_filter(spark):
    df = report(spark, (D1, "Alpha", None), (D2, "beta", None), (D3, None, None))
    titles = lambda *a: [x["report_date"].day for x in s.filter_reports(df, *a).orderBy("report_date").collect()]
    assert titles() == [1, 2, 3]
    assert titles(" ALPHA ") == [1]
    assert titles("2024-01-0") == [1, 2, 3]
    assert titles("", 7, datetime(2024, 1, 9)) == [2, 3]
    assert titles("", 7, datetime(2024, 1, 9, 0, 0, 1)) == [3]


def predictions(spark, *rows):
    return spark.createDataFrame([(D2, t, 1.0, sc, "stable", 0.0, 1, 1, 1.0, 1.0, 1, 1) for t, sc in rows], PREDICTION)


def test_plain_report(spark):
    df = predictions(spark, ("b", 2.5), ("a", 2.5), ("", 9.0), (None, 8.0), *[(f"t{i}", 1.0) for i in range(9)])
    row = s.daily_report(df, D2).first()
    assert row["title"] == "2024-01-02 데일리 트렌드 리포트"
    lines = row["content_md"].split("\n")
    assert lines[0] == "## 2024-01-02 일일 트렌드 요약" and lines[3:5] == ["", "## Top Keywords"]
    assert lines[5:9] == ["- 1.  (score 9.0)", "- 2. None (score 8.0)", "- 3. a (score 2.5)", "- 4. b (score 2.5)"]
    assert len(lines) == 15
    assert json.loads(row["keywords_json"]) == ["a", "b", "t0", "t1", "t2", "t3", "t4", "t5"]
    assert s.report_keywords(df).first()[0] == json.loads(row["keywords_json"])
    few = s.daily_report(predictions(spark, ("x", 1.0)), D2).first()["content_md"]
    assert few.endswith("## Top Keywords\n- 1. x (score 1.0)")
    assert s.daily_report(df, D3).collect() == []
    payload = json.loads(s.report_payload(df, D2, 3).first()[0])
    assert payload["top_n"] == 3 and [i.get("token") for i in payload["items"]] == ["", None, "a"]


def test_dashboard_row(spark):
    def part(*rows):
        return spark.createDataFrame(list(rows), "window_end string, items array<int>")

    full = s.dashboard_latest(part(("t", [1])), part(("p", [1, 2, 3])), part(), 2).first()
    assert full["traffic"]["items"] == [1] and full["top"]["items"] == [1, 2] and full["rising"] is None
    assert s.dashboard_latest(part(), part(("p", [1, 2])), part(), 0).first()["top"]["items"] == [1, 2]
    assert s.dashboard_latest(part(), part(), part()).collect() == []


def test_word_lists(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_text("# note\nThe\n\n  and \n오늘\nthe\n", encoding="utf-8")
    load = lambda *a, **kw: set(r.load_stopwords(spark, *a, **kw))
    assert load([str(tmp_path / "none"), str(path)]) == {"the", "and", "오늘"}
    assert load(str(path), " X ,,y") == {"the", "and", "오늘", "x", "y"}
    assert load(str(path), lower=False, default=()) == {"The", "the", "and", "오늘"}
    assert load(str(tmp_path / "none")) == set(DEFAULT_STOPWORDS)
    assert load(str(tmp_path / "none"), lower=False, default=()) == set()


def test_crawl_result(spark, tmp_path):
    path = tmp_path / "run.json"
    path.write_text(json.dumps({"posts": [{"url": "a", "title": "A"}], "failures": [{"url": "b", "error": "e"}]}, indent=1))
    done, failed = r.read_crawl_result(spark, str(path))
    assert [x["title"] for x in done.collect()] == ["A"] and [x["error"] for x in failed.collect()] == ["e"]


def test_partitioned_table_read_options():
    options = r.jdbc_options("jdbc:x", "posts", "postdate", "2024-01-01", "2024-02-01", 8, user="u")
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "postdate" and options["user"] == "u"
    with pytest.raises(ValueError):
        r.jdbc_options("jdbc:x", "posts", "postdate")


def test_publishing_counts_and_fails_when_nothing_is_sent(spark, tmp_path):
    rows = [("1.0", "u", "t", "c", None, None), ("1.0", "v", None, "c", None, None)]
    df = spark.createDataFrame(rows, POST_MESSAGE)
    failures = spark.createDataFrame([("w", "boom")], "url string, error string")
    path = str(tmp_path / "out")
    assert publish(df, failures, "parquet", path) == {"raw": 2, "cleaned": 1, "error": 2}
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(RuntimeError):
        k.check_published(route_posts(df.limit(0)), 2)
    k.check_published({}, 0)


def test_daily_job_replaces_its_days(spark, tmp_path):
    run = date(2024, 1, 7)
    rows = []
    for back in range(7):
        day = run - timedelta(days=back)
        for i in range(6 + back % 2):
            rows.append((f"u{back}-{i}", "Title", "spark spark news" + " rare" * (back == 0), day, None))
    rows.append(("empty", "!!", "https://x.y", run, None))
    posts = spark.createDataFrame(rows, POST)
    target = str(tmp_path)
    p = DailyParams(rebuild_window=True, stopwords=("title",))
    first = daily.run_daily(spark, posts, target, run, p)
    assert first["cleaned_docs"][run] == 6 and first["daily_token_stats"][run] == 3
    got = read_or_empty(spark, f"{target}/predictions", PREDICTION).collect()
    assert {x["token"]: x["status"] for x in got} == {"spark": "stable"}
    once = stored(spark, f"{target}/daily_token_stats", TOKEN_STATS)
    assert (run, "spark", 12, 6) in once
    assert daily.run_daily(spark, posts, target, run, p) == first
    assert stored(spark, f"{target}/daily_token_stats", TOKEN_STATS) == once
    only_today = daily.run_daily(spark, posts.filter("url like 'u0-%'"), target, run, DailyParams(stopwords=("title",)))
    assert list(only_today["cleaned_docs"]) == [run]
    assert stored(spark, f"{target}/daily_token_stats", TOKEN_STATS) == once
    daily.run_report(spark, target, run + timedelta(days=1))
    daily.run_report(spark, target, run + timedelta(days=1))
    assert read_or_empty(spark, f"{target}/daily_reports", REPORT).count() == 1
    with pytest.raises(RuntimeError):
        daily.run_report(spark, target, run)
