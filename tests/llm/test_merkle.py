"""The manifest against a tree built in plain Python."""

import zlib

import brute
import pytest
from fixtures import documents
from pyspark.sql import functions as F

from pulse.llm import merkle


def part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([brute.sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def path_of(levels, at):
    out = []
    for level in levels[:-1]:
        run = at // 8 * 8
        out.append(("".join(level[run:at]), "".join(level[at + 1 : run + 8])))
        at //= 8
    return out


def expected(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        leaf = brute.sha("".join(part(v) for v in r))
        changed = leaf
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
            changed = brute.sha("".join(part(v) for v in (*r[:4], brute.lower(r[4]))))
        order = (r[0] is not None, r[0] or 0, leaf)
        groups.setdefault((r[2] is not None, (r[2] or "").encode()), []).append((order, r[0], leaf, changed))
    trees = {g: levels_of([x[2] for x in sorted(found, key=lambda x: x[0])]) for g, found in groups.items()}
    top = levels_of([trees[g][-1][0] for g in sorted(trees)])
    root, out = top[-1][0], []
    for place, g in enumerate(sorted(trees)):
        for at, (_, doc_id, leaf, changed) in enumerate(sorted(groups[g], key=lambda x: x[0])):
            path, folded = path_of(trees[g], at) + path_of(top, place), changed
            for before, after in path:
                folded = brute.sha(before + folded + after)
            proof = brute.sha("".join(a + b for a, b in path))
            out.append((doc_id, leaf, trees[g][-1][0], root, proof, folded, folded == root))
    return out


def table(spark, rows):
    base = documents(spark, [])
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    extra = [F.lit("x").alias(f.name) for f in base.schema.fields if f.name not in names]
    clash = [F.lit("y").alias(n) for n in ("g", "i", "n", "hash", "nodes", "path", "root", "last", "_row", "_part")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    return df.repartition(5).select("*", *extra, *clash)


def same(got, want):
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_sizes_around_runs_and_blocks(spark):
    sizes = {"a": 1, "b": 2, "c": 8, "d": 9, "e": 64, "f": 65, "g": 512, "h": 513, "i": 4700}
    rows = [(i * 7 % 10_007, "s", lang, i, f"Text {i} É") for lang, n in sizes.items() for i in range(n)]
    same(merkle.verify(merkle.manifest(table(spark, rows))).collect(), expected(rows))


@pytest.mark.parametrize("n", [1, 70])
def test_one_language(spark, n):
    rows = [(i * 7 % 10_007, "s", "en", i, f"Text {i} É") for i in range(n)]
    same(merkle.verify(merkle.manifest(table(spark, rows))).collect(), expected(rows))


def test_languages_nulls_ties_and_odd_texts(spark):
    rows = [(i, None if i % 5 == 0 else "s", [None, "de", "ä", "", "z" * 9][i % 5], None, f"A{i}") for i in range(700)]
    rows += [(None, None, None, None, None), (None, "s", "de", 3, "Abc"), (None, "s", "de", 3, "abd")]
    rows += [(5, "t", "de", 1, "X"), (5, "s", "de", 2, "Y"), (5, "s", "de", 2, "Y"), (6, "s", "de", 0, "")]
    rows += [(9, "s", "de", 1, "É" * 300_000 + "Z"), *[(i, "s", f"l{i}", 1, "one") for i in range(90)]]
    rows += [(8, "s", "de", 1, "same")] * 1500
    same(merkle.verify(merkle.manifest(table(spark, rows))).collect(), expected(rows))


def test_empty_table(spark):
    found = merkle.verify(merkle.manifest(table(spark, [])))
    assert found.collect() == []
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_a_path_has_the_siblings_only(spark):
    rows = [(i, "s", "en", i, "t") for i in range(20)]
    found = {r["doc_id"]: r for r in merkle.manifest(table(spark, rows)).collect()}
    assert [len(s["before"] + s["after"]) // 64 for s in found[0]["path"]] == [7, 2]
    assert [len(s["before"] + s["after"]) // 64 for s in found[19]["path"]] == [3, 2]
