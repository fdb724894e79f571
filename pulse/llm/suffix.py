"""Removal of repeated passages with sparse suffix arrays.

Suffixes are retained at minimiser positions only: of the GRAM-word sequences inside any window of k
words, the one with the smallest hash. The choice depends on the window's words alone, so equal windows
retain suffixes at the same place in them, and every window of k words holds a retained one.

1. Retained positions are listed with the hash of their sequence. Those whose sequence occurs in
   several documents go on.
2. For these, the k words that follow and the words that may precede inside one window are taken from
   the text. Of equal surroundings in one map task only the smallest document's goes on;
   the others repeat it for certain.
3. Each bucket of sequences sorts its suffixes and compares neighbours, which gives classes of
   suffixes that agree on their first n words, for every n; the same to the left with the
   reversed prefixes. A window that reaches o words left and k - o words right of its suffix
   repeats if another suffix of a smaller document is in its class on both sides.
4. A sequence with more than HOT_ROWS places would make its bucket as large as its group. The windows
   around its places are hashed whole instead: of equal ones in a map task the smallest document's
   goes on, and buckets go by the hash of the window.
5. Repeated windows merge into maximal spans per document.

Every window is decided, so the result equals that of comparing all windows: a word goes if a
window of k words around it also starts in a document with a smaller doc_id. Words are compared by
64-bit hashes, and so are sequences and the windows of step 4.

Defined results: null and empty texts have no words; null doc_ids sort before all others and count
as one document; rows that repeat a doc_id are that document given again, with the same text; an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.graph import only
from pulse.llm.stored import stored
from pulse.llm.substring import NULL_ID, _unzip, _zip, doc_column, runs_of
from pulse.llm.words import whole_windows, window_hashes, word_slices

K = 50
GRAM = 16
HELD_ROWS = 1 << 15
HOT_ROWS = 1 << 14
HELD_WINDOWS = 1 << 20

_SURROUNDINGS = (
    "bucket int, doc long, place int, n_left int, n_right int, ahead binary, behind binary, "
    "runs array<array<long>>"
)
_HOT = "bucket int, hashes binary, docs binary, places binary, runs binary"
_RUNS = "doc_id long, first long, last long"


def least_places(h: np.ndarray, span: int) -> np.ndarray:
    """For every run of ``span`` hashes the place of its smallest, the leftmost if equal."""
    n = len(h) - span + 1
    if n <= 0:
        return np.empty(0, np.int64)
    at, width = np.arange(len(h)), 1
    while 2 * width <= span:
        a, b = at[:-width], at[width:]
        at = np.where(h[a] <= h[b], a, b)
        width *= 2
    a, b = at[:n], at[span - width : span - width + n]
    return np.where(h[a] <= h[b], a, b)


def _retained(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = doc_column(batch.column(0))
            for w in word_slices(batch.column(1)):
                windows = whole_windows(w.offsets, k)
                if len(windows) == 0:
                    continue
                grams = window_hashes(w.hashes(), GRAM)
                at = np.unique(least_places(grams, k - GRAM + 1)[windows])
                text = np.searchsorted(w.offsets, at, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[at].view(np.int64)), pa.array(ids[w.rows][text]),
                     pa.array(at - w.offsets[text], pa.int32())],
                    ["gram", "doc", "place"],
                )

    return run


def retained_suffixes(rows: DataFrame, k: int = K) -> DataFrame:
    """(doc, places, hot) of retained positions whose word sequence occurs in several documents.

    hot: those whose sequence has more than HOT_ROWS places; they are not among the others.
    """
    kept = stored(rows.mapInArrow(_retained(k), "gram long, doc long, place int"), "suffixes")
    shared = kept.groupBy("gram").agg(
        F.min("doc").alias("a"), F.max("doc").alias("b"), (F.count(F.lit(1)) > HOT_ROWS).alias("many")
    )
    # from a table both sides of the join are plain shuffles, of which a very common gram can be split
    shared = stored(shared.filter("a < b").select("gram", "many"), "shared-grams")
    return (
        kept.join(shared.hint("shuffle_hash"), "gram")
        .groupBy("doc")
        .agg(
            F.collect_set(F.when(~F.col("many"), F.col("place"))).alias("places"),
            F.collect_set(F.when(F.col("many"), F.col("place"))).alias("hot"),
        )
    )


def _first_of_each(docs: np.ndarray, hashes: np.ndarray, places: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Windows of the smallest document that has them, and runs of all others."""
    order = np.lexsort((docs, hashes))
    d, h, p = docs[order], hashes[order], places[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    again = d > d[new][np.cumsum(new) - 1]
    return [x[~again] for x in (d, h, p)], runs_of(d[again], p[again])


def _hot_windows(k: int, buckets: int):
    """Windows around the places of hot sequences, packed by bucket."""
    reach = k - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            (d, h, p), runs = _first_of_each(*(np.concatenate(x) for x in zip(*held, strict=True)))
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
            rows = [(0, None, None, None, _zip(runs.astype("<i8")))]
            for b in np.flatnonzero(np.diff(cuts)):
                own = by[cuts[b] : cuts[b + 1]]
                rows.append((b, h[own].tobytes(), _zip(d[own]), _zip(p[own]), None))
            kinds = (pa.int32(), *[pa.binary()] * 4)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                ["bucket", "hashes", "docs", "places", "runs"],
            )

        for batch in batches:
            ids = doc_column(batch.column(0))
            places = batch.column(2)
            for w in word_slices(batch.column(1)):
                hashes = window_hashes(w.hashes(), k)
                for i, row in enumerate(range(w.rows.start, w.rows.stop)):
                    windows = int(w.offsets[i + 1] - w.offsets[i]) - k + 1
                    at = np.array(places[row].values, np.int64)
                    starts = np.unique(at[:, None] - np.arange(reach + 1))
                    starts = starts[(starts >= 0) & (starts < windows)]
                    held.append((np.full(len(starts), ids[row]), hashes[w.offsets[i] + starts], starts))
                    size += len(starts)
                    if size >= HELD_WINDOWS:
                        yield flush()
                        held, size = [], 0
        if size:
            yield flush()

    return run


def _compare_hot(table: pa.Table) -> pa.Table:
    parts, found = [], [np.empty((0, 3), np.int64)]
    for h, d, p, r in zip(*(table.column(c).to_pylist() for c in ("hashes", "docs", "places", "runs")), strict=True):
        if r is not None:
            found.append(_unzip(r, "<i8").reshape(-1, 3))
        else:
            parts.append((_unzip(d, "<i8"), np.frombuffer(h, "<u8"), _unzip(p, "<i8")))
    if parts:
        found.append(_first_of_each(*(np.concatenate(x) for x in zip(*parts, strict=True)))[1])
    rows = np.concatenate(found)
    return pa.table({n: rows[:, i] for i, n in enumerate(("doc_id", "first", "last"))})


def _surroundings(k: int, buckets: int):
    reach = k - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            best: dict[tuple, int] = {}
            for r in held:
                best[r[2:]] = min(best.get(r[2:], r[0]), r[0])
            known, rows = [], []
            for r in held:
                doc, place, n_left, n_right, ahead, behind, gram = r
                if doc > best[r[2:]]:
                    # all windows inside the surroundings repeat
                    known.append([doc, place - n_left, place + n_right - k])
                else:
                    rows.append((gram % buckets, doc, place, n_left, n_right, ahead, behind, None))
            known = [x for x in known if x[1] <= x[2]]
            if known:
                rows.append((0, 0, 0, 0, 0, b"", b"", known))
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(),
                     pa.binary(), pa.list_(pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                ["bucket", "doc", "place", "n_left", "n_right", "ahead", "behind", "runs"],
            )

        for batch in batches:
            ids = doc_column(batch.column(0))
            places = batch.column(2)
            for w in word_slices(batch.column(1)):
                words = w.hashes().astype("<u8")
                for i, row in enumerate(range(w.rows.start, w.rows.stop)):
                    own = words[w.offsets[i] : w.offsets[i + 1]]
                    padded = np.concatenate([np.zeros(reach, "<u8"), own, np.zeros(k, "<u8")])
                    at = np.sort(np.array(places[row].values, np.int64))
                    at = at[at < len(own)]
                    ahead = padded[(at + reach)[:, None] + np.arange(k)]
                    behind = padded[(at + reach - 1)[:, None] - np.arange(reach)]
                    left, right = np.minimum(at, reach), np.minimum(len(own) - at, k)
                    grams = window_hashes(padded[reach:], GRAM)[at].tolist()
                    doc = int(ids[row])
                    held += [
                        (doc, int(p), int(a), int(b), x.tobytes(), y.tobytes(), g)
                        for p, a, b, x, y, g in zip(at, left, right, ahead, behind, grams, strict=True)
                    ]
                    if len(held) >= HELD_ROWS:
                        yield flush()
                        held.clear()
        if held:
            yield flush()

    return run


def _classes(sides: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the sequences, and how many first words each shares with the one before it."""
    order = np.array(sorted(range(len(sides)), key=sides.__getitem__), np.int64)
    words = np.frombuffer(b"".join(sides), "<u8").reshape(len(sides), width)[order]
    common = np.zeros(len(sides), np.int64)
    differ = words[1:] != words[:-1]
    common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, common


def _compare(k: int):
    reach = k - GRAM

    def run(table: pa.Table) -> pa.Table:
        runs = [r for x in table.column("runs").to_pylist() if x for r in x]
        own = table.filter(pa.compute.is_null(table.column("runs")))
        found = [np.array(runs, np.int64).reshape(-1, 3)]
        if own.num_rows:
            doc, place, n_left, n_right = (
                own.column(c).to_numpy().astype(np.int64) for c in ("doc", "place", "n_left", "n_right")
            )
            ahead_order, ahead = _classes(own.column("ahead").to_pylist(), k)
            behind_order, behind = _classes(own.column("behind").to_pylist(), reach)
            starts, docs = [], []
            for left in range(reach + 1):
                right = k - left
                a, b = np.empty(len(doc), np.int64), np.empty(len(doc), np.int64)
                a[ahead_order] = np.cumsum(ahead < right)
                b[behind_order] = np.cumsum(behind < left)
                fits = np.flatnonzero((n_left >= left) & (n_right >= right))
                both = a[fits] * (len(doc) + 1) + b[fits]
                order = np.lexsort((doc[fits], both))
                both, d, at = both[order], doc[fits][order], fits[order]
                if len(both) == 0:
                    continue
                new = np.ones(len(both), bool)
                new[1:] = both[1:] != both[:-1]
                again = d > d[new][np.cumsum(new) - 1]
                docs.append(d[again])
                starts.append(place[at[again]] - left)
            if docs:
                found.append(runs_of(np.concatenate(docs), np.concatenate(starts)))
        rows = np.concatenate(found)
        return pa.table({n: rows[:, i] for i, n in enumerate(("doc_id", "first", "last"))})

    return run


def repeated_windows(docs: DataFrame, k: int = K, buckets: int | None = None) -> DataFrame:
    """Runs of places at which a repeated window starts: doc_id, first, last."""
    spark = docs.sparkSession
    buckets = buckets or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    places = stored(retained_suffixes(rows, k), "suffix-places")
    named = rows.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), "text")

    def texts(column: str) -> DataFrame:
        own = places.filter(F.size(column) > 0).select("doc", F.col(column).alias("places"))
        found = only(named, "doc", own.select("doc")).join(own.hint("shuffle_hash"), "doc")
        return found.select("doc", "text", "places")

    around = texts("places").mapInArrow(_surroundings(k, buckets), _SURROUNDINGS)
    found = around.groupBy("bucket").applyInArrow(_compare(k), _RUNS)
    if places.filter(F.size("hot") > 0).isEmpty():
        return found
    packed = texts("hot").mapInArrow(_hot_windows(k, buckets), _HOT)
    return found.unionByName(packed.groupBy("bucket").applyInArrow(_compare_hot, _RUNS))
