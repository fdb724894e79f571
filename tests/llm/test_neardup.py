import random

import pytest
from brute import groups, shingles
from fixtures import ODD, documents, mixed_rows, prose, text_of

from pulse.llm import neardup
from pulse.llm.graph import components


def result(spark, rows):
    return neardup.near_duplicates(documents(spark, rows)).collect()


def edited(words, n, seed):
    rng = random.Random(seed)
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"edit{rng.random()}"
    return out


def test_equals_brute_force(spark):
    base = prose(1, 200)
    rows = mixed_rows()
    # from nearly equal to just below the threshold, in steps that make chains
    rows += [(100 + i, text_of(edited(base, i % 9, i), i)) for i in range(30)]
    rows += [(200 + i, text_of(base, i).upper()) for i in range(4)]
    rows += [(300 + i, text_of(prose(7, 40)[i : i + 30])) for i in range(8)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in result(spark, rows)}
    want = groups(rows)
    texts = dict(rows)
    assert got == {i: (len(shingles(texts[i])), c, c == i) for i, c in want.items()}
    assert len(set(want.values())) < len(want)


def test_a_big_group_of_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "FAMILY_BLOCK", 16)
    base, shared = prose(2, 120), prose(3, 25)
    rows = [(i, text_of(edited(base, i % 6, i))) for i in range(120)]
    rows += [(500 + i, text_of(shared + prose(600 + i, 60))) for i in range(60)]
    got = {r["doc_id"]: r["component_id"] for r in result(spark, rows)}
    assert got == groups(rows)


def test_odd_rows(spark):
    got = {r["doc_id"]: r for r in result(spark, ODD)}
    assert got[900]["n_shingles"] == 0 and got[901]["kept"] and got[902]["component_id"] == 902
    assert got[903]["n_shingles"] == 1 and got[904]["n_shingles"] == 1
    assert got[908]["component_id"] == 907  # the same single shingle
    assert result(spark, []) == []


def test_repeated_rows_and_null_ids(spark):
    text = text_of(prose(4, 40))
    got = result(spark, [(5, text), (5, text), (6, text), (None, text), (None, None)])
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in got) == [
        (-1, -1, True), (-1, -1, True), (5, 5, True), (5, 5, True), (6, 5, False)
    ]


@pytest.mark.parametrize("n", [2, 40])
def test_components_of_a_path_and_a_star(spark, n):
    links = [(i, i + 1) for i in range(n)] + [(1000, 1000 + i) for i in range(1, n)]
    random.Random(n).shuffle(links)
    df = spark.createDataFrame([(b, a) if i % 2 else (a, b) for i, (a, b) in enumerate(links)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {i: 0 for i in range(1, n + 1)} | {1000 + i: 1000 for i in range(1, n)}
