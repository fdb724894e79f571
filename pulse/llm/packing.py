"""Best-fit packing of documents into token sequences, by large-item matching.

A sequence holds at most two pieces above a third of its capacity. These are matched first, each
with the largest partner that still fits; smaller pieces then go, largest first, where the
remaining gap is smallest. Pieces are dealt into groups of bounded size and every group is packed
by itself, which costs at most about one unfilled sequence a group.

Defined results: null and empty texts give one piece that holds the end id alone; repeated rows
are packed one by one; null ids stay null; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.tokens import encoder, slices
from pulse.sources.store import materialize

CAPACITY = 4096
GROUP_PIECES = 16_384
END_ID = 1

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID):
    """Documents as token ids plus the end id, cut where longer than the capacity."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for i, j in slices(texts):
                ids, at = encode(texts[i:j])
                rows = []
                for d in range(i, j):
                    own = np.append(ids[at[d - i] : at[d - i + 1]], np.uint32(end_id)).astype("<u4")
                    for k, s in enumerate(range(0, len(own), capacity)):
                        part = own[s : s + capacity]
                        rows.append((doc_ids[d], k, s, len(part), zlib.crc32(part.tobytes())))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.int32()),
                        *(pa.array([r[c] for r in rows], pa.int64()) for c in (2, 3, 4)),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, PIECES
    )


class Gaps:
    """Open sequences by free space: the smallest gap that fits is one lookup in a bit set."""

    def __init__(self, capacity: int):
        self.by_size: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def put(self, gap: int, sequence: int) -> None:
        if gap:
            self.by_size[gap].append(sequence)
            self.mask |= 1 << gap

    def take(self, size: int) -> tuple[int, int] | None:
        """(gap, sequence) of the tightest fit."""
        fits = self.mask >> size
        if not fits:
            return None
        gap = size + (fits & -fits).bit_length() - 1
        sequence = self.by_size[gap].pop()
        if not self.by_size[gap]:
            self.mask &= ~(1 << gap)
        return gap, sequence


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece."""
    sequence = np.empty(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    n_large = int(np.searchsorted(-lengths[order], -(capacity // 3), "left"))
    gaps, n = Gaps(capacity), 0
    # large pieces waiting for a partner, by length: the largest that fits is the highest bit
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in order[:n_large]:
        waiting[lengths[i]].append(i)
        mask |= 1 << int(lengths[i])

    def pop(size: int) -> int:
        nonlocal mask
        i = waiting[size].pop()
        if not waiting[size]:
            mask &= ~(1 << size)
        return i

    while mask:
        size = mask.bit_length() - 1
        i = pop(size)
        sequence[i] = n
        partner = (mask & ((1 << (capacity - size + 1)) - 1)).bit_length() - 1
        free = capacity - size
        if partner > 0:
            j = pop(partner)
            sequence[j], offset[j] = n, size
            free -= partner
        gaps.put(free, n)
        n += 1
    for i in order[n_large:]:
        size = int(lengths[i])
        if found := gaps.take(size):
            gap, s = found
            sequence[i], offset[i] = s, capacity - gap
            gaps.put(gap - size, s)
        else:
            sequence[i] = n
            gaps.put(capacity - size, n)
            n += 1
    return sequence, offset


def dealt_over(cut: DataFrame, groups: int) -> DataFrame:
    return cut.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Every piece with its sequence and its place there."""
    cut = materialize(pieces(docs, vocabulary, capacity))
    groups = max(1, -(-cut.count() // group_pieces))
    # by a hash of the row's place, so that equal ids and lengths spread over all groups, and so do the
    # first rows of many small partitions
    dealt = dealt_over(cut, groups)

    def place(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        sequence, offset = pack_lengths(lengths, capacity)
        first = table.column("grp")[0].as_py() << 32
        return table.drop_columns(["grp"]).append_column(
            "sequence_id", pa.array(sequence + first, pa.int64())
        ).append_column("offset", pa.array(offset, pa.int64()))

    return dealt.groupBy("grp").applyInArrow(place, PACKED)
