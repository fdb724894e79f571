"""Quality rules per document, and verdicts on whole hosts.

Base rules fail a document by itself. Hosts are judged by how many of their documents fail: rates
are shrunk with a beta prior fitted to all hosts, so small hosts lean to the common rate, and the
verdict of a host is joined back to its documents.

Defined results: a null or empty text has no words and fails; a null host is a host of its own;
repeated rows are judged one by one; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.words import whole_windows, word_slices
from pulse.sources.store import materialize

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5
SALTS = 32

# Characters counted as symbols.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

METRICS = (
    "doc_id long, source string, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long"
)


def _repeat_words(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text, words inside a 3-word window that the text holds at least twice."""
    at = whole_windows(offsets, 3)
    n = len(h)
    if len(at) == 0:
        return np.zeros(len(offsets) - 1, np.int64)
    _, ids = np.unique(h, return_inverse=True)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ids = ids.astype(np.int64)
    # (text, word, word, word) as two sortable integers: exact for equal word hashes
    a = text[at] << 32 | ids[at]
    b = ids[at + 1] << 32 | ids[at + 2]
    order = np.lexsort((b, a))
    same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[at[twice] + k] = True
    return np.add.reduceat(np.append(inside, False), offsets[:-1]).astype(np.int64) * (
        np.diff(offsets) > 0
    )


def _dup_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(lines) - len(set(lines))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2)
        for w in word_slices(texts):
            rows = batch.slice(w.rows.start, w.rows.stop - w.rows.start)
            lead = (w.data & 0xC0) != 0x80  # first bytes of characters
            chars = np.concatenate([[0], np.cumsum(lead)])
            symbols = np.concatenate([[0], np.cumsum(SYMBOLS[w.data])])
            per_word = np.concatenate([[0], np.cumsum(chars[w.ends] - chars[w.starts])])
            bounds = _bounds(rows.column(2))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).cast(pa.int64()),
                    rows.column(1).cast(pa.string()),
                    pa.array(w.counts(), pa.int64()),
                    pa.array(per_word[w.offsets[1:]] - per_word[w.offsets[:-1]], pa.int64()),
                    pa.array(symbols[bounds[1:]] - symbols[bounds[:-1]], pa.int64()),
                    pa.array([_dup_lines(t) for t in rows.column(2).to_pylist()], pa.int64()),
                    pa.array(_repeat_words(w.hashes(), w.offsets), pa.int64()),
                ],
                ["doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                 "n_repeat_words"],
            )


def _bounds(texts: pa.Array) -> np.ndarray:
    from pulse.llm.words import text_bytes

    _, at = text_bytes(texts)
    return at - at[0]


def measure(docs: DataFrame) -> DataFrame:
    """Counts the rules look at, one row per document, and the base verdict."""
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string")
    ).mapInArrow(_measure, METRICS)
    return rows.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def host_verdicts(measured: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Hosts with their shrunk failure rate: source, n_docs, n_failed, host_rate, host_rejected.

    The prior is fitted by moments: mean m and variance v of the hosts' rates give a strength of
    m(1-m)/v - 1 documents. With no variance between hosts every host gets the mean.
    """
    hosts = measured.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"))
    strength = F.col("m") * (1 - F.col("m")) / F.col("v") - 1
    prior = prior.select("m", F.when(F.col("v") > 0, F.greatest(strength, F.lit(0.0))).alias("k"))
    shrunk: Column = F.when(F.col("k").isNull(), F.col("m")).otherwise(
        (F.col("n_failed") + F.col("m") * F.col("k")) / (F.col("n_docs") + F.col("k"))
    )
    # one row, the fitted prior, meets every host
    return (
        hosts.join(F.broadcast(prior))
        .withColumn("host_rate", shrunk)
        .withColumn("host_rejected", F.col("host_rate") > max_rate)
        .drop("m", "k")
    )


def judge(docs: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Every document with its counts, the base verdict and whether it is kept.

    The counts are written once and read for the hosts and for the result. A host may hold most
    documents, so its row is repeated per salt and its documents are dealt over the salts.
    """
    measured = materialize(measure(docs))
    hosts = host_verdicts(measured, max_rate).select(
        F.col("source").alias("host"),
        "host_rate",
        "host_rejected",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("host_salt"),
    )
    salted = measured.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    on = salted["source"].eqNullSafe(hosts["host"]) & (salted["salt"] == hosts["host_salt"])
    return salted.join(hosts, on, "left").select(
        "doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "host_rate",
        (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"),
    )
