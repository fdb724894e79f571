"""The quality classifier: features and steps against plain Python, held-out accuracy, odd tables."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
from fixtures import ODD, documents, prose, text_of

from pulse.llm import quality_model as qm
from pulse.llm.words import word_slices


def slots(texts):
    out = []
    for words in word_slices(pa.array(texts)):
        found = qm.slots_of(words)
        out += np.split(found, words.offsets[1:-1])
    return out


def test_features_do_not_depend_on_neighbouring_texts():
    texts = ["The THE cat. 12 cats", "", "cat", "cat cat", "The THE cat. 12 cats", "é" * 9]
    together = slots(texts)
    for text, found in zip(texts, together, strict=True):
        assert (slots([text])[0] == found).all() and len(found) == len(text.split())
    first = together[0]
    assert first[0][0] == first[1][0] and first[0][2] != first[1][2]  # one word, two shapes
    assert first[0][2] != first[2][2] and first[3][2] != first[4][2]
    assert together[3][0][0] == together[3][1][0] == together[2][0][0]
    assert together[3][1][1] != together[2][0][1]


def test_shares_sum_to_one():
    batch = pa.record_batch([pa.array([1, 2, 3]), pa.array([0, 1, 1], pa.int32()), pa.array(["a b a", None, "x"])], ["key", "label", "text"])
    found = [r for b in qm._shares(iter([batch])) for r in b.to_pylist()]
    assert [r["key"] for r in found] == [1, 2, 3]
    assert [round(sum(r["shares"]), 5) for r in found] == [1, 0, 1]
    assert all(r["slots"] == sorted(set(r["slots"])) for r in found)


def test_steps_are_ftrl_proximal():
    """Against the update written out number by number."""
    rng = random.Random(5)
    leader, z, n = qm.Leader.empty(), {}, {}
    for _ in range(60):
        at = sorted(rng.sample(range(40), 6))
        x, label = [rng.random() for _ in at], rng.randrange(2)

        def weight(i):
            zi, ni = z.get(i, 0.0), n.get(i, 0.0)
            if abs(zi) <= qm.L1:
                return 0.0
            return -(zi - math.copysign(qm.L1, zi)) / ((qm.BETA + math.sqrt(ni)) / qm.ALPHA + qm.L2)

        w = [weight(i) for i in at]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x, strict=True))))
        for i, wi, xi in zip(at, w, x, strict=True):
            g = (p - label) * xi
            sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / qm.ALPHA
            z[i] = z.get(i, 0.0) + g - sigma * wi
            n[i] = n.get(i, 0.0) + g * g
        leader.step(np.array(at), np.array(x), label)
    assert np.allclose(leader.z[:40], [z.get(i, 0.0) for i in range(40)])
    assert np.allclose(leader.n[:40], [n.get(i, 0.0) for i in range(40)])


def test_scores_are_dot_products_of_the_weights(spark):
    rows = labelled(120)
    docs, labels = documents(spark, [r[:2] for r in rows]), spark.createDataFrame([r[::2] for r in rows], "doc_id long, quality int")
    shares = qm.training_rows(docs, labels).mapInArrow(qm._shares, qm._SHARES).dropDuplicates(["key"])
    w = qm.learn(shares)
    text = dict(r[:2] for r in rows)
    for r in qm.score_documents(docs, labels).collect():
        found = slots([text[r["doc_id"]]])[0]
        z = w[qm.SLOTS] + qm.SCALE * sum(w[i] for i in found.ravel()) / max(found.size, 1)
        assert abs(r["score"] - 1 / (1 + math.exp(-z))) < 1e-9
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == (r["score"] >= 0.3)


def labelled(n):
    """(doc_id, text, quality): every fourth is junk."""
    out = []
    for i in range(n):
        words = prose(i, 40 + i % 90)
        if i % 4 == 0:
            words = [w + "###" for w in words] if i % 8 else [w.upper() + "!!" for w in words]
        out.append((i, text_of(words, i), int(i % 4 != 0)))
    return out


def test_held_out_accuracy(spark):
    rows = labelled(400)
    docs, labels = documents(spark, [r[:2] for r in rows]), spark.createDataFrame([r[::2] for r in rows], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in qm.score_documents(docs, labels).collect()}
    held = [(got[i], q) for i, _, q in rows if got[i]["held_out"]]
    assert len(held) > 50
    assert sum(r["predicted"] == q for r, q in held) / len(held) > 0.95


def test_a_sample_of_the_labels_is_bounded_and_repeatable(spark):
    rows = labelled(300)
    docs, labels = documents(spark, [r[:2] for r in rows]), spark.createDataFrame([r[::2] for r in rows], "doc_id long, quality int")
    first = {r["key"] for r in qm.training_rows(docs, labels, 40).collect()}
    assert len(first) == 40
    assert first == {r["key"] for r in qm.training_rows(docs.repartition(7), labels.repartition(3), 40).collect()}


def test_odd_rows_and_empty_tables(spark):
    rows = [r[:2] for r in labelled(60)] + ODD + [(None, "text without id"), (7, labelled(8)[7][1])]
    docs = documents(spark, rows)
    labels = spark.createDataFrame(
        [(i, int(i % 4 != 0)) for i in range(60)] + [(None, 0), (900, 1), (901, None), (4, 1), (5000, 0)], "doc_id long, quality int"
    )
    found = qm.score_documents(docs, labels).collect()
    assert len(found) == len(rows)
    assert len({r["score"] for r in found if r["doc_id"] in (900, 901, 902)}) == 1
    assert [r["held_out"] for r in found if r["doc_id"] is None] == [False]
    assert len({r["score"] for r in found if r["doc_id"] == 7}) == 1
    one_class = spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int")
    assert {r["score"] for r in qm.score_documents(docs, one_class).collect()} == {0.5}
    empty = documents(spark, [])
    assert qm.score_documents(empty, labels).collect() == []
    assert {r["score"] for r in qm.score_documents(docs, labels.limit(0)).collect()} == {0.5}
