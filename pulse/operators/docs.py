"""Posts to cleaned documents to daily word statistics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.dates import local_date
from pulse.functions.text import (
    clean_text,
    distinct_tokens,
    filter_tokens,
    has_words,
    tokens_batch,
)
from pulse.schema import CLEANED_DOC
from pulse.sources.store import materialize

# Tags of the forms an analyzer's tokens are taken from.
NOUN_TAGS = ("NNG", "NNP", "NNB", "NR", "NP", "SL")


def process_dates(run_date: date, days: int, rebuild: bool) -> list[date]:
    """The run date, or the whole window that ends with it, oldest first."""
    back = range(days - 1, -1, -1) if rebuild else range(1)
    return [run_date - timedelta(days=i) for i in back]


def with_doc_date(
    posts: DataFrame, discovered_is_utc: bool = True, tz: str = "Asia/Seoul"
) -> DataFrame:
    """Add the day a post belongs to and which column gave it."""
    posted = F.to_date("postdate")
    found = local_date(F.col("discovered_at").cast("timestamp"), tz, discovered_is_utc)
    return posts.withColumns(
        {
            "doc_date": F.coalesce(posted, found),
            "date_source": F.when(posted.isNotNull(), "postdate").otherwise("discovered_at"),
        }
    )


def with_doc_id(posts: DataFrame) -> DataFrame:
    return posts.withColumn("doc_id", F.sha1("url"))


def filter_dates(df: DataFrame, dates: Sequence[date], column: str = "doc_date") -> DataFrame:
    return df.filter(F.col(column).isin(list(dates)))


def may_fall_on(dates: Sequence[date]) -> Column:
    """Coarse date filter on the stored columns, which the scan can use to skip data.

    The exact day is computed from two columns and cannot be pushed down; a day of slack
    on both sides covers every time zone.
    """
    first, last = min(dates), max(dates)
    lo, hi = first - timedelta(days=1), last + timedelta(days=2)
    found = F.col("discovered_at").between(
        F.lit(lo.isoformat()).cast("timestamp"), F.lit(hi.isoformat()).cast("timestamp")
    )
    return F.col("postdate").between(F.lit(first), F.lit(last)) | (
        F.col("postdate").isNull() & found
    )


def cleaned_docs(
    posts: DataFrame,
    dates: Sequence[date] | None = None,
    discovered_is_utc: bool = True,
    tz: str = "Asia/Seoul",
) -> DataFrame:
    """Documents of the given days (all days if None) with non-empty cleaned text."""
    if dates is not None:
        posts = posts.filter(may_fall_on(dates))
    docs = with_doc_id(with_doc_date(posts, discovered_is_utc, tz))
    if dates is not None:
        docs = filter_dates(docs, dates)
    texts = F.col("title"), F.col("content_text")
    docs = docs.filter(has_words(*texts))
    cleaned = docs.withColumn("cleaned_text", clean_text(*texts))
    return cleaned.select(*CLEANED_DOC.names)


def tokenize(
    df: DataFrame,
    mode: str = "split",
    analyzer=None,
    words: Sequence[str] = (),
    min_len: int = 2,
    max_len: int = 20,
    tags: Sequence[str] = NOUN_TAGS,
    text: str = "cleaned_text",
) -> DataFrame:
    """Add the array ``tokens``.

    ``split`` is native. ``morph`` takes an analyzer supplied by the caller: a pandas UDF from
    text to an array of structs with ``form`` and ``tag``; forms with an allowed tag are kept.
    """
    if mode == "split":
        return df.withColumn("tokens", tokens_batch(F.col(text), words, min_len, max_len))
    if mode != "morph":
        raise ValueError(f"unknown tokenizer mode {mode!r}")
    if analyzer is None:
        raise ValueError("mode 'morph' needs an analyzer")
    found = df.withColumn("_morphs", analyzer(F.col(text)))
    kept = F.filter("_morphs", lambda m: m["tag"].isin(list(tags)))
    forms = F.transform(kept, lambda m: m["form"])
    return found.withColumn("tokens", filter_tokens(forms, words, min_len, max_len)).drop("_morphs")


def without_words(counts: DataFrame, words: DataFrame, column: str = "token") -> DataFrame:
    """Counts without those of listed words, for lists of any length.

    The list (``word``) is taken out of the counts, not of the texts: the result is the same, and one
    row per day and word is joined instead of every mention.
    """
    return counts.join(words.select(F.col("word").alias(column)), column, "left_anti")


def _uses(tokenized: DataFrame) -> DataFrame:
    """Every word once per mention and once per row: doc_date, token, and 1 under ``m`` or ``d``."""
    mentions = F.transform(
        "tokens", lambda t: F.struct(t.alias("token"), F.lit(1).alias("m"), F.lit(0).alias("d"))
    )
    documents = F.transform(
        distinct_tokens(F.col("tokens")),
        lambda t: F.struct(t.alias("token"), F.lit(0).alias("m"), F.lit(1).alias("d")),
    )
    uses = tokenized.select("doc_date", F.explode(F.concat(mentions, documents)).alias("o"))
    return uses.select("doc_date", "o.token", "o.m", "o.d")


def _summed(uses: DataFrame) -> DataFrame:
    return uses.groupBy(F.col("doc_date").alias("stat_date"), "token").agg(
        F.sum("m").alias("mention_count"), F.sum("d").alias("doc_count")
    )


def daily_token_stats(tokenized: DataFrame) -> DataFrame:
    """Mentions and documents per day and word.

    One document is one row (``doc_id`` is the key of the documents). Every word is sent out
    once per mention and once per document, so a single grouping with map-side combine gives
    both numbers: nothing keyed by document is shuffled, and there is no join.
    """
    return _summed(_uses(tokenized))


#: Repeated ids are sent out to find their rows up to this many; for more both sides are shuffled.
MOST_SENT = 1 << 20


def _by_id(tokenized: DataFrame, sent: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose day and id come once, and all rows of those that come repeatedly, None without any.

    Days and ids alone are counted, as hashes, and this is run at once. A row that only shares the hash of
    another counts as repeated, which costs time but changes no result.
    """
    marked = tokenized.withColumn("_key", F.xxhash64("doc_date", "doc_id"))
    counted = marked.groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    repeated = materialize(counted.filter("n > 1").select("_key"))
    n = repeated.count()
    if n == 0:
        return tokenized, None
    listed = F.broadcast(repeated) if n <= sent else repeated
    once, again = (marked.join(listed, "_key", how).select(*tokenized.columns) for how in ("left_anti", "left_semi"))
    return once, again


def distinct_token_docs(tokenized: DataFrame, sent: int = MOST_SENT) -> DataFrame:
    """Each (day, word, document) once, also when a document id comes in several rows.

    Words of a row are told apart where it is; only those of repeated ids are shuffled.
    """
    once, again = _by_id(tokenized, sent)

    def words(rows: DataFrame) -> DataFrame:
        return rows.select("doc_date", F.explode(distinct_tokens(F.col("tokens"))).alias("token"), "doc_id")

    if again is None:
        return words(once)
    return words(once).unionByName(words(again).dropDuplicates(["doc_date", "token", "doc_id"]))


def token_stats_joined(tokenized: DataFrame, sent: int = MOST_SENT) -> DataFrame:
    """Mention counts next to document counts, for documents whose ids may come repeatedly.

    Rows of ids that come once are counted as in :func:`daily_token_stats`. The words of repeated ids are
    counted per document first, which moves every (day, word, document) of these once; both parts meet in
    one grouping.
    """
    once, again = _by_id(tokenized, sent)
    if again is None:
        return daily_token_stats(once)
    per_doc = (
        again.select("doc_date", "doc_id", F.explode("tokens").alias("token"))
        .groupBy("doc_date", "token", "doc_id")
        .agg(F.count(F.lit(1)).alias("m"))
    )
    return _summed(_uses(once).unionByName(per_doc.select("doc_date", "token", "m", F.lit(1).alias("d"))))
