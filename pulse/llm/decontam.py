"""Benchmark phrases in documents, through a distributed positional inverted index.

Items are cut into windows of k words. Of every window the rarest term in the corpus is its anchor,
and only anchors are posted: a posting is a document, a place and the words around it. A window
is found by looking up its anchor and comparing the words at their offsets from it, so frequent
terms are never listed. Everything is column expressions.

The query set is stated and goes over all documents in blocks: a block holds at most BLOCK_WINDOWS
windows on average, whose terms are literals of the plan and whose anchors are broadcast. All
documents are read twice per block, once to count the block's terms and once to post.

Defined results: null and empty texts have no words; items without words match nowhere; an item of
fewer than k words is one window; rows are one document if both doc_id, null or not, and text are the
same; repeated items count once; empty tables give no matches. Other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.stored import stored

K = 10
BLOCK_WINDOWS = 20_000

# A word is a run of anything but these ASCII characters; only A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NO_WORDS = "array<string>"

# What makes rows one document: the id, and the digest of the text.
_DOC = ("doc_id", "digest")


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def words_of(text: Column) -> Column:
    found = F.regexp_extract_all(F.translate(text.cast("string"), UPPER, LOWER), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast(NO_WORDS))


def windows_of(items: DataFrame, k: int = K) -> DataFrame:
    """Distinct (item_id, phrase): phrase is an array of k words, or of all words of a short item."""
    rows = items.select(F.col("item_id"), words_of(F.col("text")).alias("words"))
    at = F.sequence(F.lit(1), F.greatest(F.size("words") - k + 1, F.lit(1)))
    return (
        rows.filter(F.size("words") > 0)
        .select("item_id", "words", F.explode(at).alias("p"))
        .select("item_id", F.slice("words", F.col("p"), k).alias("phrase"))
        .distinct()
    )


def _terms(phrases: DataFrame) -> list[str]:
    """Distinct terms of one block: at most k times its windows."""
    return [r[0] for r in phrases.select(F.explode("phrase")).distinct().collect()]


def anchors_of(phrases: DataFrame, doc_words: DataFrame) -> DataFrame:
    """phrase with its rarest term and the offset of that term: phrase, anchor, offset."""
    counts = (
        doc_words.select(F.explode("words").alias("term"))
        .filter(F.col("term").isin(_terms(phrases)))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    each = phrases.select("phrase", F.posexplode("phrase").alias("offset", "term"))
    best = F.min_by(F.struct("term", "offset"), F.struct(F.coalesce("n", F.lit(0)), "offset"))
    return (
        each.join(counts, "term", "left")
        .groupBy("phrase")
        .agg(best.alias("a"))
        .select("phrase", F.col("a.term").alias("anchor"), F.col("a.offset").alias("offset"))
    )


def postings_of(doc_words: DataFrame, terms: list[str], reach: int) -> DataFrame:
    """Documents with the postings of the given terms: doc_id, digest, n_words, posted.

    A posting holds the term, its place (from 0) and the words from ``reach`` before to ``reach``
    after it.
    """
    words = F.col("words")

    def post(w: Column, i: Column) -> Column:
        first = F.greatest(i - reach, F.lit(0))
        around = F.slice(words, first + 1, i + reach + 1 - first)
        return F.when(w.isin(terms), F.struct(w.alias("term"), i.alias("place"), around.alias("around")))

    return doc_words.select(
        *_DOC,
        F.size("words").cast("long").alias("n_words"),
        F.filter(F.transform("words", post), lambda p: p.isNotNull()).alias("posted"),
    )


def match(posted: DataFrame, anchors: DataFrame, reach: int, slop: int | None = None) -> DataFrame:
    """Matches of the phrases: doc_id, digest, first, size, phrase, exact.

    Exact: the words stand at their offsets. With a slop, windows also match by proximity when all
    their words occur within that many words beyond the window's length around the anchor.
    """
    flat = posted.select(*_DOC, F.explode("posted").alias("p")).select(*_DOC, "p.*")
    joined = flat.join(F.broadcast(anchors), F.col("term") == F.col("anchor"))
    first = (F.col("place") - F.col("offset")).alias("first")
    base = F.greatest(F.col("place") - reach, F.lit(0))
    size = F.size("phrase")
    at = F.col("place") - F.col("offset") - base + 1
    exact = (at >= 1) & F.coalesce(
        F.slice("around", F.greatest(at, F.lit(1)), size) == F.col("phrase"), F.lit(False)
    )
    rows = joined.select(*_DOC, first, size.alias("size"), "phrase", exact.alias("exact"),
                         "around", (F.col("place") - base + 1).alias("own"))
    if slop is None:
        return rows.filter("exact").select(*_DOC, "first", "size", "phrase", "exact")
    low = F.greatest(F.col("own") - F.col("size") + 1 - slop, F.lit(1))
    near = F.slice("around", low, F.col("own") + F.col("size") - 1 + slop - low + 1)
    return rows.filter(F.col("exact") | (F.size(F.array_except("phrase", near)) == 0)).select(
        *_DOC, "first", "size", "phrase", "exact"
    )


def find_phrases(docs: DataFrame, items: DataFrame, k: int = K, slop: int | None = None,
                 block_windows: int = BLOCK_WINDOWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with n_words, matches, windows): see :func:`match` and :func:`windows_of`."""
    windows = stored(windows_of(items, k), "benchmark-windows")
    blocks = max(1, math.ceil(windows.count() / block_windows))
    doc_words = docs.select(
        F.col("doc_id").cast("long"), digest_of(F.col("text")).alias("digest"), words_of(F.col("text")).alias("words")
    )
    reach, found, counted = k - 1 + (slop or 0), None, None
    for b in range(blocks):
        phrases = windows.filter(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == b).select("phrase").distinct()
        anchors = stored(anchors_of(phrases, doc_words), "benchmark-anchors")
        terms = [r[0] for r in anchors.select("anchor").distinct().collect()]
        posted = stored(postings_of(doc_words, terms, reach), "benchmark-postings")
        matches = match(posted, anchors, reach, slop)
        found = matches if found is None else found.unionByName(matches)
        counted = posted.select(*_DOC, "n_words") if counted is None else counted
    return counted, found, windows


def contamination(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """Every document with its words inside occurrences of windows, and the items they are from."""
    return judged(docs, items, k).drop("digest")


def judged(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """:func:`contamination` with the digest of the text."""
    counted, matches, windows = find_phrases(docs, items, k)
    spans = matches.select(*_DOC, "first", (F.col("first") + F.col("size")).alias("stop")).distinct()
    order = Window.partitionBy(*_DOC).orderBy("first", "stop")
    before = F.coalesce(F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = F.greatest(F.col("stop") - F.greatest("first", "before"), F.lit(0))
    hits = (
        spans.withColumn("before", before)
        .groupBy(*_DOC)
        .agg(F.sum(fresh).cast("long").alias("n_hit"))
    )
    # copies of one passage name the same items: distinct pairs before the join and after it
    pairs = matches.select(*_DOC, "phrase").distinct().join(windows, "phrase").select(*_DOC, "item_id")
    sorted_ids = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    named = pairs.groupBy(*_DOC).agg(sorted_ids.alias("items")).toDF("d", "o", "items")
    found = hits.join(named, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("digest") == F.col("o")))
    found = found.select(F.col("doc_id").alias("hit_id"), F.col("digest").alias("hit_digest"), "n_hit", "items")
    items_col = F.coalesce("items", F.array().cast(NO_WORDS))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("digest") == F.col("hit_digest"))
    return counted.join(found, same, "left").select(
        *_DOC,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.size(items_col).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_col, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
