import random
from collections import Counter
from datetime import UTC, date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulse.operators import docs as d
from pulse.schema import POST
from pulse.sources.readers import spread

RUN = date(2024, 1, 7)


def posts(spark, *rows):
    return spark.createDataFrame([(u, t, c, p, f) for u, t, c, p, f in rows], POST)


def test_process_dates():
    assert d.process_dates(RUN, 7, False) == [RUN]
    assert d.process_dates(RUN, 3, True) == [date(2024, 1, 5), date(2024, 1, 6), RUN]


def test_documents_take_the_posting_date_or_the_local_finding_date(spark):
    evening = datetime(2024, 1, 6, 20, tzinfo=UTC)
    df = posts(
        spark,
        ("a", "t", "one", date(2024, 1, 3), evening),
        ("b", "t", "two", None, evening),
        ("c", "t", "three", None, None),
        ("e", None, "--", RUN, None),
        ("f", None, "https://only.link", RUN, None),
    )
    got = {r["url"]: (r["doc_date"], r["date_source"]) for r in d.cleaned_docs(df).collect()}
    assert got == {
        "a": (date(2024, 1, 3), "postdate"),
        "b": (RUN, "discovered_at"),
        "c": (None, "discovered_at"),
    }
    assert [r["url"] for r in d.cleaned_docs(df, [RUN]).collect()] == ["b"]
    local = d.cleaned_docs(df, [date(2024, 1, 6)], discovered_is_utc=False).collect()
    assert [r["url"] for r in local] == ["b"]


def test_document_ids_are_the_sha1_of_the_url(spark):
    df = d.with_doc_id(posts(spark, ("abc", "", "", None, None)))
    assert df.first()["doc_id"] == "a9993e364706816aba3e25717850c26c9cd0d89d"


def tokenized(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_date date, doc_id string, tokens array<string>")


def test_statistics_count_mentions_and_documents(spark):
    df = tokenized(spark, (RUN, "1", ["a", "b", "a"]), (RUN, "2", ["a"]), (RUN, "3", []))
    want = [(RUN, "a", 3, 2), (RUN, "b", 1, 1)]
    assert sorted(tuple(r) for r in d.daily_token_stats(df).collect()) == want
    assert sorted(tuple(r) for r in d.token_stats_joined(df).collect()) == want


def test_repeated_document_ids_count_once(spark):
    df = tokenized(spark, (RUN, "1", ["a", "b"]), (RUN, "1", ["a"]))
    got = sorted(tuple(r) for r in d.token_stats_joined(df).collect())
    assert got == [(RUN, "a", 2, 1), (RUN, "b", 1, 1)]
    assert d.distinct_token_docs(df).count() == 2


def shuffled(df):
    """Columns of the exchanges of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


@pytest.mark.parametrize("sent", [d.MOST_SENT, 0])
def test_only_repeated_ids_are_counted_by_document(spark, sent):
    rng = random.Random(5)
    ids = [*map(str, range(40)), *map(str, range(8)), None, None]
    days = [RUN, date(2024, 1, 6), None]
    rows = [(rng.choice(days), i, rng.choices("abcdefg", k=rng.randrange(9))) for i in ids] + [(RUN, "x", None)]
    mentions, found = Counter(), set()
    for day, i, words in rows:
        mentions.update((day, w) for w in words or [])
        found |= {(day, w, i) for w in words or []}
    documents = Counter((day, w) for day, w, _ in found)
    df = tokenized(spark, *rows)
    got = [tuple(r) for r in d.distinct_token_docs(df, sent).select("doc_date", "token", "doc_id").collect()]
    assert Counter(got) == Counter(found)
    stats = {(r["stat_date"], r["token"]): (r["mention_count"], r["doc_count"]) for r in d.token_stats_joined(df, sent).collect()}
    assert stats == {k: (n, documents[k]) for k, n in mentions.items()}


def test_words_of_single_ids_are_not_shuffled_with_their_documents(spark):
    df = tokenized(spark, (RUN, "1", ["a", "b", "a"]), (RUN, "2", ["a"]))
    assert not shuffled(d.distinct_token_docs(df))
    assert all("doc_id" not in line for line in shuffled(d.token_stats_joined(df)))


def test_analyzer_hook_keeps_allowed_tags(spark):
    @F.pandas_udf("array<struct<form:string,tag:string>>")
    def analyze(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"form": w, "tag": "NNG" if w[0].isupper() else "VV"} for w in t.split()])

    df = spark.createDataFrame([("Spark runs Fast 12 THE",)], "cleaned_text string")
    got = d.tokenize(df, "morph", analyze, words=["the"]).first()["tokens"]
    assert got == ["spark", "fast"]
    with pytest.raises(ValueError):
        d.tokenize(df, "morph")
    with pytest.raises(ValueError):
        d.tokenize(df, "other")


def test_only_tables_of_few_files_are_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    spark.range(100).repartition(16).write.parquet(str(tmp_path / "many"))
    one, many = (spark.read.parquet(str(tmp_path / n)) for n in ("one", "many"))
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(many) is many
