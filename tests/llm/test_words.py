import numpy as np
import pyarrow as pa
import pytest
from brute import ALNUM as ALNUM_RULE
from brute import lower, words
from fixtures import ODD, mixed_rows

from pulse.llm import words as w

TEXTS = [t for _, t in mixed_rows()] + [t for _, t in ODD]


@pytest.mark.parametrize("small", [False, True])
def test_words_and_hashes(monkeypatch, small):
    if small:
        monkeypatch.setattr(w, "SLICE_BYTES", 64)
        monkeypatch.setattr(w, "BLOCK_BYTES", 16)
    column = pa.array(["skipped", *TEXTS])[1:]  # a slice, as Spark may send
    for table, rule, low in ((w.NON_BLANK, None, False), (w.ALNUM, ALNUM_RULE, True)):
        seen, known = [], {}
        for part in w.word_slices(column, table, low):
            hashes = part.hashes()
            found = [part.data[a:b].tobytes().decode() for a, b in zip(part.starts, part.ends, strict=True)]
            seen += [found[a:b] for a, b in zip(part.offsets, part.offsets[1:], strict=False)]
            for x, h in zip(found, hashes.tolist(), strict=True):
                assert known.setdefault(x, h) == h
        assert len(set(known.values())) == len(known)
        assert seen == [words(lower(t), rule) if rule else words(t) for t in TEXTS]


@pytest.mark.parametrize("k", [1, 2, 3, 5, 16, 50])
def test_window_hashes_depend_on_the_window_alone(k):
    h = np.random.default_rng(k).integers(0, 1 << 63, 200).astype(np.uint64)
    h[100:160] = h[:60]
    got = w.window_hashes(h, k)
    assert len(got) == 200 - k + 1
    assert (got[100 : 100 + 60 - k + 1] == got[: 60 - k + 1]).all()
    assert len(np.unique(got)) == 200 - k + 1 - (60 - k + 1) * (k <= 60)
    assert len(w.window_hashes(h[:k - 1], k)) == 0
    whole = w.whole_windows(np.array([0, 0, 30, 90, 90, 200]), k)
    want = [p for a, b in ((0, 30), (30, 90), (90, 200)) for p in range(a, b - k + 1)]
    assert whole.tolist() == want
