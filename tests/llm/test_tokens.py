import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from fixtures import documents, mixed_rows, prose, text_of

from pulse.llm import packing, token_files, tokens
from pulse.sources.store import scratch

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ROWS = [*mixed_rows(), (800, "<|endoftext|> x<|startoftext|>y"), (801, text_of(prose(1, 9000, 9000)))]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_chunks_give_the_ids_of_whole_texts(whole, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 50)
    encoder, rng = tokens.ChunkEncoder(VOCABULARY), random.Random(3)
    parts = [*"aAé \n\t'sΣσİḰ̈​ \x1c\x85漢🙂3", "é", "<|endoftext|>", "  ", "x" * 60]
    for _ in range(20):
        texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(40)]
        ids, at = encoder.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [whole(t) for t in texts]
        assert len(encoder.place) <= 51
    assert encoder.encode([])[0].tolist() == []


def test_files_round_trip(spark, whole):
    rows = [*ROWS, (801, "again"), (None, "no id")]
    folder = scratch(spark, "files")
    manifest = token_files.write_token_files(documents(spark, rows), folder, VOCABULARY, frame_ids=500, file_ids=3000)
    got = [tuple(r) for r in token_files.read_token_files(manifest, folder).collect()]
    got.sort(key=lambda r: r[1])
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    at, want = 0, []
    for i, text in sorted(rows, key=key):
        ids = np.array([*whole(text), 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    assert manifest.count() > 3


def test_a_reader_decompresses_only_what_it_needs():
    class Sink(io.BytesIO):
        def close(self):
            pass

    sink, rng = Sink(), np.random.default_rng(1)
    texts = [rng.integers(0, 49_000, n).astype("<u4") for n in (10, 700, 3, 2500, 0, 40)]
    writer = token_files.FrameWriter(sink, 1000)
    for i, ids in enumerate(texts):
        writer.add(None if i == 4 else i, ids)
    writer.close()
    data = sink.getvalue()

    class Source(io.BytesIO):
        def size(self):
            return len(data)

    reader = token_files.FrameReader(Source(data))
    assert reader.document(1).tolist() == texts[1].tolist() and reader.decoded == 1
    for i, ids in enumerate(texts):
        assert reader.document(i).tolist() == ids.tolist()
    assert reader.doc_ids.tolist()[3:] == [3, token_files.NULL_ID, 5]
    # any zstandard decoder reads the file; a damaged frame is noticed
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
    assert stream.read() == np.concatenate(texts).tobytes()
    broken = bytearray(data)
    broken[6] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        reader = token_files.FrameReader(type("S", (io.BytesIO,), {"size": lambda s: len(broken)})(bytes(broken)))
        reader.document(0)


def test_empty_table(spark):
    folder = scratch(spark, "files")
    manifest = token_files.write_token_files(documents(spark, []), folder, VOCABULARY)
    assert token_files.read_token_files(manifest, folder).collect() == []
    assert packing.pack(documents(spark, []), VOCABULARY).collect() == []


@pytest.mark.parametrize("group", [16_384, 7])
def test_packing(spark, whole, group):
    rows = [*ROWS, (801, "again"), (None, None)]
    got = packing.pack(documents(spark, rows), VOCABULARY, group_pieces=group).collect()
    want = []
    for i, text in rows:
        ids = np.array([*whole(text), 1], "<u4")
        want += [(i, k, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes()))
                 for k, s in enumerate(range(0, len(ids), 4096))]
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r)[:5] for r in got) == order(want)
    by: dict = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096


def test_packing_is_tight():
    rng = np.random.default_rng(2)
    for lengths in (rng.integers(1, 4097, 5000), rng.integers(1, 300, 5000), rng.integers(1366, 2731, 2000)):
        sequence, offset = packing.pack_lengths(lengths)
        used = np.bincount(sequence, lengths)
        assert used.max() <= 4096 and (offset + lengths <= 4096).all()
        large = np.bincount(sequence, lengths > 4096 // 3)
        assert large.max() <= 2
        # no sequence holds three pieces of over a third
        bound = max(lengths.sum() / 4096, (lengths > 2048).sum(), (lengths > 1365).sum() / 2)
        assert len(used) <= 1.12 * bound + 1


def test_many_small_partitions_fill_all_groups(spark):
    rows = spark.range(4000).repartition(200)
    sizes = {r["grp"]: r["count"] for r in packing.dealt_over(rows, 16).groupBy("grp").count().collect()}
    assert len(sizes) == 16 and max(sizes.values()) < 400


def test_files_are_read_back_by_as_many_tasks(spark):
    rows = [(None, f"{i} words without an id") for i in range(300)] + [(7, f"words {i} of one id") for i in range(300)]
    folder, merging = scratch(spark, "files"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        manifest = token_files.write_token_files(documents(spark, rows), folder, VOCABULARY, file_ids=400)
    finally:
        spark.conf.set(merging, "true")
    found = token_files.read_token_files(manifest, folder)
    assert found.rdd.getNumPartitions() == manifest.count() > 4
    assert manifest.select("part").distinct().count() > 2  # neither the null nor the repeated id is one range
    assert [r["doc_id"] for r in found.orderBy("start").collect()] == [None] * 300 + [7] * 300
