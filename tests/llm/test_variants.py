"""Spelling variants against a dictionary of deletions in plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from fixtures import documents, mixed_rows

from pulse.llm import variants


def vocabulary(rows):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = brute.lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            k = h % len(run)
            seen[run[:k] + run[k + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 6 and n >= 5}


def expected(words):
    near, same_rest = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            rest = w[:k] + w[k + 1 :]
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
            same_rest[k, w[:k], w[k + 1 :]].add(w)
    for group in same_rest.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * n:
            form[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (w, n, len(near[w]), form.get(w), words.get(form.get(w)), root)
    return out


def rows_of(found):
    return {r["word"]: (r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in found.collect()}


def random_words(seed, n, letters, longest):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(6, longest))) for _ in range(n)}
    return {w: rng.choice([5, 5, 6, 30, 31, 160, 900, 30_000]) for w in words}


@pytest.mark.parametrize("limit, letters, longest", [
    (1, "abcé", 7), (5, "ab", 9), (60, "thenraÿ", 8), (4096, "abcé", 7), (4096, "ab", 9),
])
def test_any_size_of_partition(spark, limit, letters, longest):
    words = random_words(len(letters), 700, letters, longest)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_of(variants.variants_of(df, limit)) == expected(words)


def test_open_prefixes_longer_than_a_round(spark):
    stem = "ab" * 20
    words = {stem + w: n for w, n in random_words(3, 60, "ab", 8).items()}
    words |= {stem[:k]: 5 for k in range(6, 41)} | {"a" * k: 10 * k for k in range(6, 60)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_of(variants.variants_of(df, 3)) == expected(words)


def test_acceptor_shares_equal_continuations():
    words = sorted(x + y for x in ("an", "bo", "cu") for y in ("ings", "ing", "ed", "s"))
    found = variants.Acceptor(words, 0)
    assert len(found.arcs) < len(words)
    assert sorted(found.language[-1]) == words
    state = next(s for s, places in found.prefixes.items() if len(places) == 3 and len(found.language[s]) == 4)
    assert sorted(found.language[state]) == ["ed", "ing", "ings", "s"]


def test_documents(spark):
    rng = random.Random(7)
    base = ["Theatre", "théatre", "theatres", "theater", "ÉTUDES", "étude", "Études", "colour", "color", "colours"]
    rows = [(i, " ".join(rng.choices(base, [90, 9, 9, 4, 3, 2, 2, 60, 9, 5], k=200))) for i in range(80)]
    rows += [(None, "colouur colouur's_colouur colouur9colouur"), (None, None), (3, "x" * 120_000), (4, "Long" * 30_000)]
    rows += [(i, "Long" * 30_000) for i in range(100, 106)] + mixed_rows()
    words = vocabulary(rows)
    assert any(len(w) > 100_000 for w in words)
    got = rows_of(variants.group_variants(documents(spark, rows)))
    assert got == expected(words)
    assert any(r[3] for r in got.values())


def test_empty_table(spark):
    assert variants.group_variants(documents(spark, [])).collect() == []
    assert variants.group_variants(documents(spark, [(1, "few words"), (2, None)])).collect() == []
