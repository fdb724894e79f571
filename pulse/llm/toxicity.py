"""Toxicity by class-conditional Kneser-Ney language models.

Two models of letter sequences, of toxic and of ordinary labelled documents, are compared by their
log-likelihoods. Letters rather than words, as offensive words are bent and compounded in every
language. Both models discount their counts and back off to continuation counts shared by both
classes, so an expression that is hardly seen gets the shared estimate and speaks for neither.

Every document gets its length-normalised log-likelihood ratio, and that of its few strongest
words, as a long clean text may hide a short insult. A logistic calibration turns these into a
score. It is fitted on training documents, each rated by a model of the other half of them.

Counts cover every labelled training document. They are summed per event in Spark and estimated in
blocks whose number follows the distinct events. The table of ratios holds every event, and the
backoff weight of every context for events unseen there. Up to BROADCAST_ROWS rows it is broadcast;
a larger one stays in Spark, where texts are gathered in chunks of bounded size and the distinct
events of a chunk are joined to it. Both ways give the same scores.

Scores see the text alone. Defined results: null and empty texts rate 0; null doc_ids are never
training rows; several labels of one document count as toxic if any is; without training rows of both
classes every score is 0.5; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.stored import stored
from pulse.llm.words import SLICE_BYTES, text_bytes

ORDER = 5
DISCOUNT = 2
SPARED = 0.75
STRONGEST = 3
THRESHOLD = 0.7
BLOCK_EVENTS = 1 << 16
HELD = 1 << 21
BROADCAST_ROWS = 1 << 22
CHUNK_BYTES = 1 << 22

# 64 symbols: letters, one for digits, one for everything between words, bytes beyond ASCII folded.
GAP = 27
SYMBOL = np.full(256, GAP, np.uint32)
SYMBOL[0x61:0x7B] = SYMBOL[0x41:0x5B] = np.arange(26)
SYMBOL[0x30:0x3A] = 26
SYMBOL[0x80:0xC0] = 28 + np.arange(64) % 32
SYMBOL[0xC0:] = 60 + np.arange(64) % 4
BITS, SYMBOLS = 6, 64

# Groups of training documents: twice the half (0 or 1) plus 1 if toxic.
GROUPS = 4
_COUNTS = tuple(f"n{g}" for g in range(GROUPS))
_COUNTED = "key long, " + ", ".join(f"{c} long" for c in _COUNTS)
_MODELS = ((0, 1), (0,), (1,))  # halves each model learns from


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def half_of(doc_id: Column) -> Column:
    return F.coalesce(F.floor(remainder(doc_id) / 3) % 2, F.lit(0)).cast("int")


def symbol_slices(column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, symbols, offsets) of consecutive texts, each closed by a gap; long texts come alone."""
    raw, at = text_bytes(column)
    i, n = 0, len(column)
    while i < n:
        j = min(max(i + 1, int(np.searchsorted(at, at[i] + SLICE_BYTES, "right")) - 1), n)
        bounds = at[i : j + 1] - at[i]
        out = np.insert(SYMBOL[raw[at[i] : at[j]]], bounds[1:], GAP)
        yield slice(i, j), out, bounds + np.arange(j - i + 1)
        i = j


def events(symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Every symbol with the ORDER - 1 before it, as one integer; before a text come gaps."""
    # work on texts with a run of gaps before each, then drop the events of those gaps
    lead = ORDER - 1
    counts = np.diff(offsets)
    place = np.arange(len(symbols)) + np.repeat(np.arange(1, len(counts) + 1) * lead, counts)
    padded = np.full(len(symbols) + lead * len(counts), GAP, np.uint32)
    padded[place] = symbols
    keys = padded.copy()
    for j in range(1, ORDER):
        keys[j:] |= padded[:-j] << np.uint32(BITS * j)
    return keys[place]


def _count_events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list[np.ndarray]] = {}
    size = 0

    def flush():
        keys = np.unique(np.concatenate([x for arrays in held.values() for x in arrays]))
        n = np.zeros((GROUPS, len(keys)), np.int64)
        for g, arrays in held.items():
            own, counts = np.unique(np.concatenate(arrays), return_counts=True)
            n[g, np.searchsorted(keys, own)] = counts
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), *(pa.array(x) for x in n)], ["key", *_COUNTS]
        )

    for batch in batches:
        groups = batch.column(0).to_numpy()
        for rows, symbols, offsets in symbol_slices(batch.column(1)):
            found = events(symbols, offsets)
            own = np.repeat(groups[rows], np.diff(offsets))
            for g in np.unique(own):
                held.setdefault(int(g), []).append(found[own == g])
            size += len(found)
            if size >= HELD:
                yield flush()
                held, size = {}, 0
    if held:
        yield flush()


def event_counts(rows: DataFrame) -> DataFrame:
    """Every event once with its counts by group: key, n0 to n3."""
    partial = rows.mapInArrow(_count_events, _COUNTED)
    return partial.groupBy("key").agg(*(F.sum(c).alias(c) for c in _COUNTS))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(grp, text) of labelled documents outside the held-out third."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter(
        remainder(F.col("doc_id")) % 3 != 1
    )
    joined = rows.join(marks(labels).hint("shuffle_hash"), F.col("doc_id") == F.col("label_id"))
    return joined.select((half_of(F.col("doc_id")) * 2 + F.col("toxic")).alias("grp"), "text")


def marks(labels: DataFrame) -> DataFrame:
    return (
        labels.filter(F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg((F.max(F.col("toxic").cast("int")) > 0).cast("int").alias("toxic"))
    )


def discounted(n: np.ndarray, share: float) -> np.ndarray:
    """Expected min(count, DISCOUNT) of every event in a random share of the class."""
    out = np.full(n.shape, float(DISCOUNT))
    p = (1 - share) ** n  # chance of a count of j, starting at 0
    for j in range(DISCOUNT):
        out -= (DISCOUNT - j) * p
        if share < 1:
            p = p * (n - j).clip(0) / (j + 1) * (share / (1 - share))
        else:
            p = (n == j + 1).astype(np.float64)
    return out


class Block:
    """Events of one block with all their contexts; n has a row of counts for each group."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys, self.n = keys, n
        def code(shift: int, symbols: int) -> np.ndarray:
            part = (keys >> np.uint32(BITS * shift)) & np.uint32((1 << BITS * symbols) - 1)
            return np.unique(part, return_inverse=True)[1]

        self.context = code(1, ORDER - 1)
        self.contexts = np.unique(keys >> np.uint32(BITS))
        self.shorter, self.shorter_context = code(0, ORDER - 1), code(1, ORDER - 2)

    def shared(self, pooled: np.ndarray) -> np.ndarray:
        """Kneser-Ney backoff: in how many contexts the shorter event was seen by either class."""
        seen = (pooled > 0).astype(np.float64)
        follows = np.bincount(self.shorter, seen)
        first = np.unique(self.shorter, return_index=True)[1]
        home = self.shorter_context[first]
        total, kinds = np.bincount(home, follows), np.bincount(home, follows > 0)
        total, kinds = total[self.shorter_context], kinds[self.shorter_context]
        own = np.maximum(follows[self.shorter] - SPARED, 0) + SPARED * kinds / SYMBOLS
        return np.where(total > 0, own / np.maximum(total, 1), 1 / SYMBOLS)

    def log_model(self, n: np.ndarray, share: float, shared: np.ndarray) -> np.ndarray:
        """log P(symbol | context) of a class, from counts as in the smaller class's size.

        Discounting takes more from a small sample than from a large one. Both classes are
        discounted at the size of the smaller, the larger in expectation, so that what is as
        common in both has a ratio near 0 however rare it is.
        """
        taken = discounted(n, share)
        total = np.bincount(self.context, n * share)[self.context]
        rest = np.bincount(self.context, taken)[self.context]
        own = np.maximum(n * share - taken, 0) + rest * shared
        return np.log(np.where(total > 0, own / np.where(total > 0, total, 1), shared))

    def log_weight(self, n: np.ndarray, share: float) -> np.ndarray:
        """Per context, log of what an unseen event gets of its shared estimate."""
        total = np.bincount(self.context, n * share)
        rest = np.bincount(self.context, discounted(n, share))
        return np.log(np.where(total > 0, rest / np.where(total > 0, total, 1), 1))

    def ratios(self, halves: tuple[int, ...], totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the events, and by context of events unseen there, whose shared estimates cancel out."""
        toxic, plain = (sum(self.n[2 * h + t] for h in halves) for t in (1, 0))
        all_toxic, all_plain = (sum(totals[2 * h + t] for h in halves) for t in (1, 0))
        least = min(all_toxic, all_plain)
        if least == 0:
            return np.zeros(len(self.keys)), np.zeros(len(self.contexts))
        shared = self.shared(toxic + plain)
        seen = self.log_model(toxic, least / all_toxic, shared) - self.log_model(
            plain, least / all_plain, shared
        )
        unseen = self.log_weight(toxic, least / all_toxic) - self.log_weight(plain, least / all_plain)
        return seen, unseen


#: Contexts stand in the table behind all events.
_FIRST_CONTEXT = 1 << BITS * ORDER
_TABLE = "key long, r0 float, r1 float, r2 float"


def _blocks(n_events: int, partitions: int) -> int:
    return max(4 * partitions, -(-n_events // BLOCK_EVENTS))


def learn(rows: DataFrame) -> DataFrame | None:
    """Log-likelihood ratios by each model, for every event and every context: key, r0, r1, r2."""
    counts = stored(event_counts(rows), "toxicity-counts")
    sums = counts.agg(F.count(F.lit(1)), *(F.coalesce(F.sum(c), F.lit(0)) for c in _COUNTS)).first()
    n_events, totals = sums[0], np.array(sums[1:], np.float64)
    if not (totals[0] + totals[2]) or not (totals[1] + totals[3]):
        return None

    def estimate(table: pa.Table) -> pa.Table:
        n = np.stack([table.column(c).to_numpy() for c in _COUNTS])
        block = Block(table.column("key").to_numpy().astype(np.uint32), n)
        found = [block.ratios(halves, totals) for halves in _MODELS]
        keys = np.concatenate([block.keys, block.contexts.astype(np.int64) + _FIRST_CONTEXT])
        return pa.table({
            "key": pa.array(keys, pa.int64()),
            **{f"r{i}": pa.array(np.concatenate(r), pa.float32()) for i, r in enumerate(found)},
        })

    # by the context without its first symbol, so that all a backoff needs is in one block; it has
    # at most SYMBOLS^2 events
    middle = F.shiftright("key", BITS).bitwiseAND((1 << BITS * (ORDER - 2)) - 1)
    blocks = _blocks(n_events, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    block = F.pmod(F.xxhash64(middle), F.lit(blocks)).alias("block")
    found = counts.select("*", block).groupBy("block").applyInArrow(estimate, _TABLE)
    return stored(found, "toxicity-table")


class Ratios:
    """Some rows of the table: the ratios of events, one row for each model."""

    def __init__(self, found: pa.Table):
        keys = found.column("key").to_numpy()
        order = np.argsort(keys)
        self.keys = keys[order].astype(np.uint32)
        # the last column stands for what is not there
        self.values = np.zeros((len(_MODELS), len(keys) + 1), np.float32)
        for i in range(len(_MODELS)):
            self.values[i, :-1] = found.column(f"r{i}").to_numpy()[order]

    def places(self, events_: np.ndarray) -> np.ndarray:
        """Column of each event, or of its context if the event was not seen."""
        at = self._find(events_)
        unseen = np.flatnonzero(at == len(self.keys))
        at[unseen] = self._find(_context_keys(events_[unseen]))
        return at

    def _find(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        if len(self.keys):
            at[self.keys[np.minimum(at, len(self.keys) - 1)] != keys] = len(self.keys)
        return at


def _context_keys(events_: np.ndarray) -> np.ndarray:
    return (events_ >> np.uint32(BITS)) + np.uint32(_FIRST_CONTEXT)


def _strongest(sums: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """The STRONGEST largest values of every text, 0 where it has fewer words."""
    out, left = np.zeros((STRONGEST, n)), sums.copy()
    first = np.searchsorted(text, np.arange(n))
    for k in range(STRONGEST):
        best = np.maximum.reduceat(left, first)
        out[k] = np.where(np.isfinite(best), best, 0)
        hit = np.flatnonzero(left == best[text])
        hit = hit[np.unique(text[hit], return_index=True)[1]]
        left[hit] = -np.inf
    return out


_FEATURES = [f"{p}{x}" for p in ("f", "c") for x in range(1 + STRONGEST)]
_RATED = "doc_id long, n_bytes long, " + ", ".join(f"{n} double" for n in _FEATURES)


def _features(ids: pa.Array, halves: np.ndarray, texts: pa.Array, model: Ratios) -> Iterator[pa.RecordBatch]:
    for rows, symbols, offsets in symbol_slices(texts):
        at = model.places(events(symbols, offsets))
        n = np.diff(offsets)
        text = np.repeat(np.arange(len(n)), n)
        # a gap closes a word: its own event counts to the word before it
        ends = np.flatnonzero(symbols == GAP)
        begins = np.concatenate([[0], ends[:-1] + 1])
        features = []
        for values in (model.values[0][at], model.values[2 - halves[rows][text], at]):
            words = np.add.reduceat(values.astype(np.float64), begins)
            owner = text[begins]
            total = np.bincount(owner, words, minlength=len(n))
            features += [total / n, *_strongest(words, owner, len(n))]
        yield pa.RecordBatch.from_arrays(
            [ids.slice(rows.start, len(n)), pa.array(n - 1, pa.int64()),
             *(pa.array(f, pa.float64()) for f in features)],
            ["doc_id", "n_bytes", *_FEATURES],
        )


def rate(docs: DataFrame, table: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, and features by the whole model and by the other half's."""
    rows = docs.select(
        F.col("doc_id").cast("long"), half_of(F.col("doc_id")).alias("half"), F.col("text").cast("string")
    )
    if table.count() > BROADCAST_ROWS:
        return _rate_joined(rows, table)
    model = docs.sparkSession.sparkContext.broadcast(Ratios(table.toArrow()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _features(batch.column(0), batch.column(1).to_numpy(), batch.column(2), model.value)

    return rows.mapInArrow(run, _RATED)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows numbered by chunks of about CHUNK_BYTES; a longer text is a chunk of its own."""
    from pyspark import TaskContext

    chunk, size = TaskContext.get().partitionId() << 33, 0
    for batch in batches:
        own = []
        for n in np.diff(text_bytes(batch.column(2))[1]).tolist():
            # a row counts for itself too, so that empty texts fill chunks as well
            if size and size + n > CHUNK_BYTES:
                chunk, size = chunk + 1, 0
            size += n + 64
            own.append(chunk)
        yield batch.append_column("chunk", pa.array(own, pa.int64()))


def _chunk_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chunks = batch.column(1).to_numpy()
        for rows, symbols, offsets in symbol_slices(batch.column(0)):
            found, of = events(symbols, offsets), np.repeat(chunks[rows], np.diff(offsets))
            for c in np.unique(of):
                keys = np.unique(found[of == c])
                keys = np.concatenate([keys, np.unique(_context_keys(keys))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), c)), pa.array(keys, pa.int64())], ["chunk", "key"]
                )


def _rate_joined(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The same by joins: every chunk of texts gets the rows of the table it needs.

    A chunk asks for an event once, so the most common event has as many rows as there are chunks.
    """
    texts = stored(rows.mapInArrow(_chunks, "doc_id long, half int, text string, chunk long"), "toxicity-chunks")
    keys = texts.select("text", "chunk").mapInArrow(_chunk_keys, "chunk long, key long").distinct()
    needed = keys.join(table, "key").select("chunk", "key", "r0", "r1", "r2")

    def run(own: pa.Table, found: pa.Table) -> pa.Table:
        own = own.combine_chunks()
        ids, halves, texts = (own.column(c) for c in ("doc_id", "half", "text"))
        parts = _features(ids.combine_chunks(), halves.to_numpy(), texts.combine_chunks(), Ratios(found))
        return pa.Table.from_batches(parts)

    return texts.groupBy("chunk").cogroup(needed.groupBy("chunk")).applyInArrow(run, _RATED)


def calibrate(rated: DataFrame, labels: DataFrame) -> tuple[float, list[float]] | None:
    """Intercept and weights of the logistic score, from training documents as the other half rates them."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    features = F.array(*[F.col(f"c{i}") for i in range(1 + STRONGEST)])
    rows = (
        rated.filter((remainder(F.col("doc_id")) % 3 != 1) & (F.col("n_bytes") > 0))
        .join(marks(labels), F.col("doc_id") == F.col("label_id"))
        .select(F.col("toxic").cast("double").alias("label"), array_to_vector(features).alias("features"))
    )
    if rows.select("label").distinct().count() < 2:
        return None
    fit = LogisticRegression(regParam=1e-5, maxIter=50).fit(rows)
    return float(fit.intercept), [float(x) for x in fit.coefficients]


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, ratio for every document."""
    table = learn(training_rows(docs, labels))
    fitted = None
    if table is None:
        rated = docs.select(F.col("doc_id").cast("long"), F.lit(0.0).alias("f0"))
    else:
        rated = stored(rate(docs, table), "toxicity-ratios")
        fitted = calibrate(rated, labels)
    if fitted is None:
        score = F.lit(0.5)
    else:
        intercept, weights = fitted
        z = sum((F.lit(w) * F.col(f"f{i}") for i, w in enumerate(weights)), F.lit(intercept))
        score = 1 / (1 + F.exp(-z))
    return rated.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id")) % 3 == 1, F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= THRESHOLD).cast("int").alias("predicted"),
        F.col("f0").alias("ratio"),
    )
