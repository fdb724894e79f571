"""Exact removal of repeated passages: Rabin-Karp hashes of every window, counted in Spark.

Every window of k consecutive words is hashed. Windows travel packed: a map task takes about a
million windows, sorts them, keeps of equal ones those of its smallest document (the rest are known
to repeat already), and sends each hash bucket one row of hashes and places. A bucket is counted
by one task; its size follows the number of buckets, not any key, as equal hashes of one map task
travel once. What comes back per document are maximal runs of repeated windows.

A window repeats if the same words also start in a document with a smaller doc_id. Equality is that
of 64-bit hashes of word hashes: two different windows of n meet with a chance of n^2 / 2^65.

Defined results: null and empty texts have no words; null doc_ids sort before all others and count
as one document; rows that repeat a doc_id are that document given again, with the same text; an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.graph import passing, slots_of
from pulse.llm.stored import stored
from pulse.llm.words import whole_windows, window_hashes, word_slices

WINDOW = 50
BATCH_WINDOWS = 1 << 20
NULL_ID = -(1 << 63)

_PACKED = "bucket int, docs binary, firsts binary, hashes binary, steps binary, runs binary"
_RUNS = "doc_id long, first long, last long"


def _zip(a: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unzip(b: bytes, kind: str) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def doc_column(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)


def runs_of(docs: np.ndarray, places: np.ndarray) -> np.ndarray:
    """(doc, first, last) of consecutive places, from places in any order."""
    if len(docs) == 0:
        return np.empty((0, 3), np.int64)
    order = np.lexsort((places, docs))
    d, p = docs[order], places[order]
    cut = np.flatnonzero((d[1:] != d[:-1]) | (p[1:] > p[:-1] + 1)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut - 1, [len(d) - 1]])
    return np.column_stack([d[first], p[first], p[last]])


def _pack(docs, counts, hashes, places, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of one batch: per bucket the windows to be counted, and runs already known.

    docs and counts describe the texts of the batch in order, hashes and places their windows.
    """
    # texts in order of doc_id, so that the first of equal hashes is of the smallest document
    text = np.repeat(np.arange(len(docs)), counts)
    order = np.lexsort((docs[text], hashes))
    h, d = hashes[order], docs[text][order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    group = np.cumsum(new) - 1
    smallest = d[new][group]
    known = d > smallest
    runs = runs_of(d[known], places[order][known])
    kept = np.sort(order[~known])  # back in order of text and place
    first_of = np.concatenate([[0], np.cumsum(counts)])[:-1]
    bucket = (hashes[kept] % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    kept, bucket = kept[by], bucket[by]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = []
    for b in range(buckets):
        own = kept[cuts[b] : cuts[b + 1]]
        if len(own) == 0 and not (b == 0 and len(runs)):
            continue
        t = np.unique(text[own])
        rows.append((
            b,
            _zip(np.diff(docs[t], prepend=np.int64(0))),
            _zip(np.diff(first_of[t], prepend=0)),  # windows of the batch before the text
            hashes[own].tobytes(),
            _zip(np.diff(own, prepend=0).astype("<u4")),
            _zip(runs.astype("<i8")) if b == 0 and len(runs) else None,
        ))
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32())]
        + [pa.array([r[c] for r in rows], pa.binary()) for c in range(1, 6)],
        ["bucket", "docs", "firsts", "hashes", "steps", "runs"],
    )


def _windows(k: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            parts = [np.concatenate(x) for x in zip(*held, strict=True)]
            yield from _pack(*parts, buckets)

        for batch in batches:
            ids = doc_column(batch.column(0))
            for w in word_slices(batch.column(1)):
                at = whole_windows(w.offsets, k)
                if len(at) == 0:
                    continue
                bounds = np.searchsorted(at, w.offsets)
                text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                places = at - w.offsets[text]
                counts = np.diff(bounds)
                some = counts > 0
                hashes = window_hashes(w.hashes(), k)[at]
                held.append((ids[w.rows][some], counts[some], hashes, places))
                size += len(at)
                if size >= BATCH_WINDOWS:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


def _count(table: pa.Table) -> pa.Table:
    """Runs of one bucket: windows whose hash also occurs in a smaller document."""
    docs, places, hashes, runs = [], [], [], []
    for _, d, f, h, s, r in zip(*(c.to_pylist() for c in table.columns), strict=True):
        if r is not None:
            runs.append(_unzip(r, "<i8").reshape(-1, 3))
        if not h:
            continue
        before = np.cumsum(_unzip(f, "<i8"))
        own = np.cumsum(_unzip(s, "<u4"), dtype=np.int64)
        text = np.searchsorted(before, own, "right") - 1
        docs.append(np.cumsum(_unzip(d, "<i8"))[text])
        places.append(own - before[text])
        hashes.append(np.frombuffer(h, "<u8"))
    if hashes:
        d, p, h = np.concatenate(docs), np.concatenate(places), np.concatenate(hashes)
        del docs, places, hashes
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        new = np.concatenate([[True], h[1:] != h[:-1]])
        known = d > d[new][np.cumsum(new) - 1]
        runs.append(runs_of(d[known], p[order[known]]))
    found = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
    return pa.table({n: found[:, i] for i, n in enumerate(("doc_id", "first", "last"))})


def repeated_windows(docs: DataFrame, k: int = WINDOW, buckets: int | None = None) -> DataFrame:
    """Runs of places at which a repeated window starts: doc_id, first, last.

    Buckets default to four times the shuffle partitions, the setting that follows the cluster
    and the input. A document may show a place more than once, and runs that touch.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _windows(k, buckets), _PACKED
    )
    return packed.groupBy("bucket").applyInArrow(_count, _RUNS)


REMOVED = "doc_id long, n_words long, n_removed long, spans array<array<long>>, kept string"


def _removed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, runs in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "runs")), strict=True):
                words = (text or "").encode().split()
                n, spans = len(words), []
                if runs:
                    steps = np.zeros(n + 1, np.int32)
                    for r in runs:
                        steps[min(r["first"], n)] += 1
                        steps[min(r["last"] + k, n)] -= 1
                    gone = np.cumsum(steps[:-1]) > 0
                    edges = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                    spans = edges.reshape(-1, 2).tolist()
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                kept = b" ".join(words).decode()
                rows.append((doc, n, n - len(words), spans, kept))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([r[3] for r in rows], pa.list_(pa.list_(pa.int64()))),
                    pa.array([r[4] for r in rows], pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, k: int = WINDOW, runs: DataFrame | None = None) -> DataFrame:
    """Every row with its maximal removed word spans and the words that stay.

    Columns doc_id, n_words, n_removed, spans (start and end of words, end exclusive), kept. Texts
    that certainly have no run are finished where they are read; only the others are joined.
    """
    runs = repeated_windows(docs, k) if runs is None else runs
    per_doc = runs.groupBy(F.col("doc_id").alias("own")).agg(
        F.collect_list(F.struct("first", "last")).alias("runs")
    )
    per_doc = stored(per_doc, "runs")
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("own"),
    )
    slots = slots_of(per_doc.select("own"))
    some = passing(rows, "own", slots).join(per_doc.hint("shuffle_hash"), "own", "left")
    shortened = some.select("doc_id", "text", "runs").mapInArrow(_removed(k), REMOVED)
    rest = rows.withColumn("runs", F.lit(None).cast(per_doc.schema["runs"].dataType))
    rest = rest.select("doc_id", "text", "runs", "own")
    return shortened.unionByName(passing(rest, "own", slots, False, _removed(k), REMOVED))


def kept_digest(removed: DataFrame) -> DataFrame:
    return removed.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"), "spans"
    )
