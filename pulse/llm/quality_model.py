"""Quality by logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Features are single words and pairs of neighbours, once by their letters, A-Z lowered, and once by their
shape: a run of small letters, of capitals or of digits is one sign, any other character stands for
itself. All are hashed to ``SLOTS`` slots; the value of a slot is its share of the text's features, so
a score is the sparse dot product of shares and weights and does not depend on the length of a text.

The model learns from at most ``TRAINED`` labelled documents outside the held-out fifth, those with the
smallest hashes of their ids. They are dealt over shards; in every round each shard goes through its
documents one by one with FTRL-proximal steps from the state the shards reached together, and states
are averaged. A state is two numbers for each slot, whatever the data.

Scores see the text alone. Defined results: null and empty texts score as the model rates no features;
null doc_ids are never training rows and not held out; several labels of one document count as the
least; equal rows of a document train once; without training rows of both classes every score is 0.5;
an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.stored import stored
from pulse.llm.words import Words, mixed, word_slices

SLOTS = 1 << 18
TRAINED = 1 << 14
SHARD = 1 << 11
ROUNDS = 4
THRESHOLD = 0.3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-3
SCALE = 16.0  # of the shares, against the constant feature

# Signs of shapes: small letters and bytes beyond ASCII, capitals, digits; others are their own.
SIGN = np.arange(256, dtype=np.uint8)
SIGN[0x61:0x7B] = SIGN[0x80:] = 0x61
SIGN[0x41:0x5B] = 0x41
SIGN[0x30:0x3A] = 0x30
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_PAIR = np.uint64(0x9E3779B97F4A7C15)
_TWICE = np.uint64(0xD1B54A32D192ED03)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def _shapes(words: Words) -> np.ndarray:
    """A hash of the shape of every word."""
    signs = SIGN[words.data]
    keep = np.ones(len(signs), bool)
    keep[1:] = signs[1:] != signs[:-1]
    keep[words.starts] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    return Words(signs[keep], before[words.starts], before[words.ends], words.offsets, words.rows).hashes()


def _pairs(hashes: np.ndarray, first_of_text: np.ndarray, seed: int) -> np.ndarray:
    """A hash of every word with the one before it; the first of a text stands with a mark."""
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[first_of_text] = np.uint64(seed)
    return mixed(before * _PAIR + hashes + np.uint64(seed))


def slots_of(words: Words) -> np.ndarray:
    """The slots of every word's features: one row for each word."""
    lowered = Words(LOWER[words.data], words.starts, words.ends, words.offsets, words.rows).hashes()
    shapes = _shapes(words)
    first = words.offsets[:-1][words.counts() > 0]
    repeated = np.zeros(len(lowered), bool)
    repeated[1:] = lowered[1:] == lowered[:-1]
    repeated[first] = False
    found = np.stack([
        lowered,
        _pairs(lowered, first, 3),
        mixed(shapes + np.uint64(1)),
        _pairs(shapes, first, 5) ^ np.where(repeated, _TWICE, np.uint64(0)),
    ], axis=1)
    return (found >> np.uint64(64 - 18)).astype(np.int32)


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, label, slots, shares of every text."""
    for batch in batches:
        for words in word_slices(batch.column(2)):
            slots, counts = slots_of(words), words.counts()
            at, keys, shares = 0, [], []
            for n in counts.tolist():
                own, times = np.unique(slots[at : at + n], return_counts=True)
                keys.append(own)
                shares.append((times / max(times.sum(), 1)).astype(np.float32))
                at += n
            rows = batch.slice(words.rows.start, len(counts))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(keys, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))],
                ["key", "label", "slots", "shares"],
            )


_SHARES = "key long, label int, slots array<int>, shares array<float>"


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAINED) -> DataFrame:
    """key, label, text of the labelled documents to learn from."""
    usable = labels.filter(F.col("quality").isNotNull() & (remainder(F.col("doc_id")) % 5 != 0))
    named = usable.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.min(F.col("quality").cast("int")).alias("label")
    )
    chosen = named.orderBy(F.xxhash64("label_id"), "label_id").limit(most)  # the bound of what is broadcast
    key = F.xxhash64("label_id", "text").alias("key")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    joined = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    return joined.select(key, (F.col("label") > 0).cast("int").alias("label"), "text")


class Leader:
    """FTRL-proximal state: sums of gradients and of their squares by slot; the last is the constant."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    @classmethod
    def empty(cls) -> Leader:
        return cls(np.zeros(SLOTS + 1), np.zeros(SLOTS + 1))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        pull = np.sign(z) * L1 - z
        return np.where(np.abs(z) <= L1, 0.0, pull / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def step(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - label) * x
        n = self.n[at]
        grown = n + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
        self.n[at] = grown


def features(slots: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.append(slots, SLOTS), np.append(shares.astype(np.float64) * SCALE, 1.0)


def _gone_through(state: Broadcast, turn: int) -> Callable[[pa.Table], pa.Table]:
    """One shard's documents, in an order of the turn's own, from a state to the state after them."""

    def run(table: pa.Table) -> pa.Table:
        z, n = state.value
        own = Leader(z.copy(), n.copy())
        order = np.random.default_rng(turn).permutation(table.num_rows)
        table = table.sort_by("key").take(pa.array(order)).combine_chunks()
        slots, shares = table.column("slots").combine_chunks(), table.column("shares").combine_chunks()
        cuts = slots.offsets.to_numpy()
        values, weights = slots.values.to_numpy(), shares.values.to_numpy()
        labels = table.column("label").to_numpy()
        for i in range(table.num_rows):
            a, b = cuts[i], cuts[i + 1]
            own.step(*features(values[a:b], weights[a:b]), labels[i])
        at = np.flatnonzero(own.n)
        return pa.table({"slot": pa.array(at, pa.int32()), "z": own.z[at], "n": own.n[at]})

    return run


def learn(rows: DataFrame) -> np.ndarray | None:
    """Weights by slot out of ``key, label, slots, shares``; None without both classes."""
    found = rows.agg(F.count(F.lit(1)), F.min("label"), F.max("label")).first()
    if found[1] is None or found[1] == found[2]:
        return None
    shards = -(-found[0] // SHARD)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    leader = Leader.empty()
    for turn in range(ROUNDS):
        state = rows.sparkSession.sparkContext.broadcast((leader.z, leader.n))
        reached = dealt.groupBy("shard").applyInArrow(_gone_through(state, turn), "slot int, z double, n double")
        sums = reached.groupBy("slot").agg(F.sum("z").alias("z"), F.sum("n").alias("n"))
        table = sums.toArrow()  # SLOTS + 1 rows at most
        leader = Leader.empty()
        at = table.column("slot").to_numpy()
        leader.z[at] = table.column("z").to_numpy() / shards
        leader.n[at] = table.column("n").to_numpy() / shards
        state.unpersist()
    return leader.weights()


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    rows = training_rows(docs, labels).mapInArrow(_shares, _SHARES).dropDuplicates(["key"])
    weights = learn(stored(rows, "quality-features"))
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(np.zeros(SLOTS + 1) if weights is None else weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            for words in word_slices(batch.column(1)):
                each = w[slots_of(words)].sum(axis=1)
                sums = np.concatenate([[0.0], np.cumsum(each)])[words.offsets]
                n = words.counts()
                z = np.diff(sums) * SCALE / np.maximum(4 * n, 1) + w[SLOTS]
                ids = batch.column(0).slice(words.rows.start, len(n))
                score = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(score)], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, score double"
    )
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id")) % 5 == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
