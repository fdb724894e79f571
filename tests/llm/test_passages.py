import numpy as np
import pyarrow as pa
import pytest
from brute import removed
from fixtures import documents, mixed_rows, prose, text_of

from pulse.llm import substring, suffix
from pulse.llm.words import word_slices

WAYS = {"hashes": substring.repeated_windows, "suffixes": suffix.repeated_windows}


def result(spark, rows, way, k):
    docs = documents(spark, rows)
    out = substring.remove_repeats(docs, k, WAYS[way](docs, k))
    return [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in out.collect()], out


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("k", [50, 20])
def test_equals_comparing_all_windows(spark, way, k):
    rows = mixed_rows()
    got, out = result(spark, rows, way, k)
    assert sorted(got) == sorted(removed(rows, k))
    spans = {r["doc_id"]: r["spans"] for r in out.collect()}
    for doc, n, gone, _ in got:
        assert sum(b - a for a, b in spans[doc]) == gone
        assert all(x[1] < y[0] for x, y in zip(spans[doc], spans[doc][1:], strict=False))


@pytest.mark.parametrize("way", WAYS)
def test_repeated_rows_and_a_hot_passage(spark, way):
    shared = prose(5, 80)
    rows = [(i, text_of(prose(100 + i, 30) + shared[: 52 + i % 20])) for i in range(60)]
    got, _ = result(spark, rows + rows[:5], way, 50)
    want = removed(rows, 50)
    assert set(got) == want and len(got) == 65


@pytest.mark.parametrize("way", WAYS)
def test_empty_table_and_null_ids(spark, way):
    assert result(spark, [], way, 50)[0] == []
    text = text_of(prose(1, 60))
    got, _ = result(spark, [(None, text), (3, text), (None, None)], way, 50)
    gone = {(r[0], r[2]) for r in got}
    assert gone == {(None, 0), (3, 60)}


@pytest.mark.parametrize("way", WAYS)
def test_a_long_text_and_small_batches(spark, way, monkeypatch):
    monkeypatch.setattr(substring, "BATCH_WINDOWS", 1000)
    monkeypatch.setattr(suffix, "HELD_ROWS", 10)
    long = prose(8, 30_000, 5000)
    rows = [(1, text_of(long[10_000:10_200])), (2, text_of(long)), (3, text_of(long[25_000:26_000]))]
    got, _ = result(spark, rows, way, 50)
    assert {(r[0], r[2]) for r in got} == {(1, 0), (2, 200), (3, 1000)}


def test_hot_sequences_leave_the_buckets(spark, monkeypatch):
    # documents with a line in common, and passages of it with different and with equal ends
    line = prose(5, 30)
    rows = [(i, text_of(prose(100 + i % 40, 40) + line + prose(200 + i % 20, 40))) for i in range(60)] + mixed_rows()[-9:]
    docs = documents(spark, rows)
    monkeypatch.setattr(suffix, "HOT_ROWS", 20)
    places = suffix.retained_suffixes(docs.select("doc_id", "text").toDF("doc", "text")).collect()
    assert sum(len(r["hot"]) for r in places) >= 60 and any(r["places"] for r in places)
    counted = {}
    for r in places:
        w = dict(rows)[r["doc"]].split()
        for p in r["places"]:
            gram = tuple(w[p : p + suffix.GRAM])
            counted[gram] = counted.get(gram, 0) + 1
    assert max(counted.values()) <= 20
    for hot in (0, 20, 1 << 14):
        monkeypatch.setattr(suffix, "HOT_ROWS", hot)
        assert sorted(result(spark, rows, "suffixes", 50)[0]) == sorted(removed(rows, 50))


def same_half():
    """Two words whose hashes agree in the lower 32 bits."""
    names = [f"v{i}" for i in range(400_000)]
    h = np.concatenate([w.hashes() for w in word_slices(pa.array(names))])
    low = h & np.uint64(0xFFFFFFFF)
    order = np.argsort(low)
    (at, *_) = np.flatnonzero(low[order][1:] == low[order][:-1])
    return names[order[at]], names[order[at + 1]]


@pytest.mark.parametrize("way", WAYS)
def test_words_that_share_half_a_hash_differ(spark, way):
    one, other = same_half()
    rows = []
    for i in range(6):
        w = prose(300 + i, 60)
        w[30 + i % 2] = one
        rows.append((2 * i, text_of(w)))
        rows.append((2 * i + 1, text_of([other if x == one else x for x in w])))
    assert sorted(result(spark, rows, way, 50)[0]) == sorted(removed(rows, 50))
