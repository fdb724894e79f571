"""Token ids in binary files: independent zstandard frames with a trailing seek table.

Layout of a file, which any zstandard decoder can read as a whole:

* data frames, each the little-endian unsigned 32-bit ids of one or more documents, or a part of
  one very long document;
* one skippable frame with the document index: a count, then doc_id (signed 64-bit, the smallest
  value for null) and number of ids (64-bit) of every document in order;
* the seek table, a skippable frame as in the public seekable format: compressed size,
  decompressed size and a checksum (low 32 bits of XXH64 of the content) for every frame before it.

A reader takes the table from the end of the file and decompresses only the frames it needs.
Files are written under a name of their own for every attempt and count only once the manifest,
a table, names them; so lost executors and repeated tasks leave nothing wrong behind.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulse.llm.tokens import encoder, slices
from pulse.sources.store import scratch

END_ID = 2
FRAME_IDS = 1 << 16
FILE_IDS = 1 << 26
NULL_ID = -(1 << 63)

# Fixed values of the zstandard and seekable formats.
INDEX_MAGIC = 0x184D2A50
TABLE_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80

MANIFEST = "part int, seq int, path string, n_docs long, n_ids long"


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class FrameWriter:
    """Writes one file: ids document by document, then index and seek table."""

    def __init__(self, sink, frame_ids: int = FRAME_IDS):
        import zstandard

        self.sink, self.frame_ids = sink, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=3, write_content_size=True)
        self.open: list[np.ndarray] = []
        self.open_ids = 0
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int]] = []
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((NULL_ID if doc_id is None else doc_id, len(ids)))
        self.n_ids += len(ids)
        if self.open_ids and self.open_ids + len(ids) > self.frame_ids:
            self._end_frame()
        for i in range(0, len(ids), self.frame_ids):
            part = ids[i : i + self.frame_ids].astype("<u4")
            self.open.append(part)
            self.open_ids += len(part)
            if self.open_ids >= self.frame_ids:
                self._end_frame()

    def _end_frame(self) -> None:
        if self.open_ids:
            self._write(np.concatenate(self.open).tobytes())
        self.open, self.open_ids = [], 0

    def _write(self, content: bytes) -> None:
        import xxhash

        frame = self.zstd.compress(content)
        self.sink.write(frame)
        self.frames.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def close(self) -> None:
        import xxhash

        self._end_frame()
        index = struct.pack("<Q", len(self.docs)) + np.array(self.docs, "<i8").tobytes()
        self.sink.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.frames.append((8 + len(index), 0, xxhash.xxh64_intdigest(index) & 0xFFFFFFFF))
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), CHECKSUMS, FOOTER_MAGIC)
        self.sink.write(struct.pack("<II", TABLE_MAGIC, len(table) + len(footer)) + table + footer)
        self.sink.close()


@dataclass
class FrameReader:
    """Reads documents of one file; only frames that hold them are decompressed."""

    source: object

    def __post_init__(self):
        import xxhash

        self.decoded = 0
        size = self.source.size()
        n, _, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC:
            raise ValueError("no seek table")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3)
        self.sizes, self.lengths, self.sums = table.T.astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.sizes)])
        self.first_id = np.concatenate([[0], np.cumsum(self.lengths // 4)])
        index = self._at(int(self.places[n - 1]) + 8, int(self.sizes[n - 1]) - 8)
        if xxhash.xxh64_intdigest(index) & 0xFFFFFFFF != self.sums[n - 1]:
            raise ValueError("document index: wrong checksum")
        docs = np.frombuffer(index[8:], "<i8").reshape(-1, 2)
        self.doc_ids, self.counts = docs[:, 0], docs[:, 1]
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def frame(self, k: int) -> np.ndarray:
        import xxhash
        import zstandard

        self.decoded += 1
        content = zstandard.ZstdDecompressor().decompress(
            self._at(int(self.places[k]), int(self.sizes[k]))
        )
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k}: wrong checksum")
        return np.frombuffer(content, "<u4")

    def parts(self, n: int) -> Iterator[np.ndarray]:
        """Ids of the n-th document, frame by frame."""
        a, b = int(self.starts[n]), int(self.starts[n + 1])
        k = int(np.searchsorted(self.first_id, a, "right")) - 1
        while a < b:
            if getattr(self, "_last", (-1, None))[0] != k:
                self._last = k, self.frame(k)
            base = int(self.first_id[k])
            part = self._last[1][a - base : b - base]
            yield part
            a += len(part)
            k += 1

    def document(self, n: int) -> np.ndarray:
        return np.concatenate([np.empty(0, "<u4"), *self.parts(n)])


#: Words a worker keeps encoded; twice as many as where other stages run in the same workers.
CACHED_WORDS = 800_000


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID,
                      frame_ids: int = FRAME_IDS, file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of all documents in ascending doc_id order; returns the manifest.

    Documents are dealt by ranges of doc_id, so files follow one another in part and seq. Null
    ids come first; rows with equal ids stand side by side; null texts hold the end id alone;
    an empty table gives no file. Other columns are ignored.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode = TaskContext.get().partitionId(), encoder(vocabulary, CACHED_WORDS).encode
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        done, out, path = [], None, ""

        def close():
            out.close()
            done.append((part, len(done), path, len(out.docs), out.n_ids))

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for i, j in slices(texts):
                ids, at = encode(texts[i:j])
                for d in range(i, j):
                    if out is None:
                        path = f"{root.rstrip('/')}/part-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.zst"
                        out = FrameWriter(
                            store.open_output_stream(path, compression=None), frame_ids
                        )
                    own = ids[at[d - i] : at[d - i + 1]]
                    out.add(doc_ids[d], np.append(own, np.uint32(end_id)))
                    if out.n_ids >= file_ids:
                        close()
                        out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in done], pa.int32()),
                pa.array([r[1] for r in done], pa.int32()),
                pa.array([r[2] for r in done], pa.string()),
                pa.array([r[3] for r in done], pa.int64()),
                pa.array([r[4] for r in done], pa.int64()),
            ],
            ["part", "seq", "path", "n_docs", "n_ids"],
        )

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # by the text too, so that rows without an id, or of one id, are not all one range
    order = [F.col("doc_id").asc_nulls_first(), F.substring("text", 1, 64), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    target = f"{folder.rstrip('/')}/manifest"
    ordered.mapInArrow(write, MANIFEST).write.parquet(target)
    return spark.read.schema(MANIFEST).parquet(target)


#: Tasks that read files back, at most.
MOST_READERS = 20_000


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document, read back: doc_id, start, n_tokens, ids_crc32.

    The running sum runs over the manifest, one row per file of up to FILE_IDS ids.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for batch in batches:
            for path, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_file(path) as source:
                    reader = FrameReader(source)
                    for a in range(0, len(reader.counts), 8192):
                        b = min(a + 8192, len(reader.counts))
                        sums = []
                        for n in range(a, b):
                            crc = 0
                            for part in reader.parts(n):
                                crc = zlib.crc32(part.tobytes(), crc)
                            sums.append(crc)
                        ids = reader.doc_ids[a:b]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(ids, pa.int64(), mask=ids == NULL_ID),
                                pa.array(before + reader.starts[a:b], pa.int64()),
                                pa.array(reader.counts[a:b], pa.int64()),
                                pa.array(sums, pa.int64()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    upto = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select(
        "path", F.coalesce(F.sum("n_ids").over(upto), F.lit(0)).alias("before")
    )
    # the sum leaves all files in one partition: deal them out again, one file is one unit of work. The
    # number is given, as partitions of a few short rows each would be merged into one.
    spread = files.repartition(max(1, min(manifest.count(), MOST_READERS)), "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files_folder(spark: SparkSession) -> str:
    return scratch(spark, "token-files")
