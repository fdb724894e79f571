import random
import zlib

import numpy as np
from fixtures import ODD, documents, prose, text_of

from pulse.llm import toxicity as t

LABELS = "doc_id long, quality int, toxic int, text string, score double"


def corpus(n=1200):
    rng, rows, labels = random.Random(4), [], []
    for i in range(n):
        w, toxic = prose(i, 40 + i % 200, 300), i % 5 == 0
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["zgrubo", "ogzgrub", "zgrubling", "Blarkf", "blarkful"]))
        rows.append((i, text_of(w)))
        labels.append((i, 1, int(toxic), "x", 0.0))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels = corpus()
    odd = [(10_000 + i, x) for i, x in ODD] + [(None, rows[0][1]), (10_999, rows[0][1]), (10_999, rows[0][1])]
    table = spark.createDataFrame(labels + labels[:3] + [(5, None, None, "x", 0.0), (None, 1, 1, "x", 0.0)], LABELS)
    got = t.score_documents(documents(spark, rows + odd), table).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in got)
    toxic = {i for i, *_, in labels if i % 5 == 0}
    held = [(r["doc_id"] in toxic, r["predicted"]) for r in got if r["held_out"] and r["doc_id"] < 10_000]
    assert 300 < len(held) < 500
    caught = [p for y, p in held if y]
    wrong = [p for y, p in held if not y]
    assert sum(caught) > 0.9 * len(caught) and sum(wrong) < 0.02 * len(wrong)


def test_labels_of_the_held_out_third_change_nothing(spark):
    rows, labels = corpus(300)
    docs = documents(spark, rows)
    import zlib

    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y, x, s) for i, q, y, x, s in labels]
    runs = [
        sorted((r["doc_id"], round(r["score"], 9)) for r in t.score_documents(docs, spark.createDataFrame(x, LABELS)).collect())
        for x in (labels, flipped)
    ]
    assert runs[0] == runs[1]


def test_without_both_classes_and_empty_tables(spark):
    rows, labels = corpus(30)
    docs = documents(spark, rows)
    plain = spark.createDataFrame([x for x in labels if not x[2]], LABELS)
    for table in (plain, plain.limit(0)):
        assert {(r["score"], r["predicted"]) for r in t.score_documents(docs, table).collect()} == {(0.5, 0)}
    assert t.score_documents(documents(spark, []), plain).collect() == []


def test_a_model_is_a_distribution():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 8, 4000).astype(np.uint32)
    keys, n = np.unique(t.events(symbols, np.array([0, 1500, 4000])), return_counts=True)
    block = t.Block(keys, np.zeros((4, len(keys))))
    shared = block.shared(n)
    p = np.exp(block.log_model(n.astype(float), 1.0, shared))
    sums = np.bincount(block.context, p)
    assert (sums <= 1 + 1e-9).all() and sums.max() > 0.5
    # thinning in expectation equals thinning on average
    many = rng.binomial(12, 0.3, 200_000)
    assert abs(t.discounted(np.array([12.0]), 0.3)[0] - np.minimum(many, t.DISCOUNT).mean()) < 0.01


def test_unseen_events_back_off_and_none_is_dropped(spark):
    rows, labels = corpus(300)
    train = t.training_rows(documents(spark, rows), spark.createDataFrame(labels, LABELS)).cache()
    counts, found = {r["key"]: r for r in t.event_counts(train).collect()}, t.Ratios(t.learn(train).toArrow())
    contexts = {k >> t.BITS for k in counts}
    assert len(found.keys) == len(counts) + len(contexts)
    # more events than one slot each of a small fixed table could hold, and no stranger's ratio
    known = np.array(sorted(counts), np.uint32)
    assert (found.keys[found.places(known)] == known).all()
    # unseen in a known context: the backoff weight of that context; in an unknown one: 0
    n = np.array([[r[f"n{g}"] for g in range(t.GROUPS)] for r in counts.values()])
    of = np.array([k >> t.BITS for k in counts])
    toxic, plain = n[:, 1] + n[:, 3], n[:, 0] + n[:, 2]
    least = min(toxic.sum(), plain.sum())

    def weight(c, x):
        own, share = x[of == c], least / x.sum()
        return t.discounted(own, share).sum() / (own.sum() * share) if own.sum() else 1

    checked = 0
    for c in sorted(contexts)[::5]:
        key = next(k for k in range(c << t.BITS, (c + 1) << t.BITS) if k not in counts)
        got = found.values[0, found.places(np.array([key], np.uint32))[0]]
        want = np.log(weight(c, toxic) / weight(c, plain))
        assert abs(got - want) < 1e-5
        checked += abs(want) > 0.01
    assert checked > 3
    c = next(c for c in range(1 << t.BITS * 4) if c not in contexts)
    assert found.values[0, found.places(np.array([c << t.BITS], np.uint32))[0]] == 0


def test_a_table_too_large_to_broadcast_gives_the_same(spark, monkeypatch):
    rows, labels = corpus(300)
    odd = [(10_000 + i, x) for i, x in ODD] + [(None, rows[0][1]), (None, None), (10_999, "qqqq xzxz " * 50)]
    docs, table = documents(spark, rows + odd), spark.createDataFrame(labels, LABELS)

    def run():
        found = t.learn(t.training_rows(docs, table))
        return sorted(map(str, (tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in t.rate(docs, found).collect())))

    want = run()
    assert len(want) == len(rows) + len(odd)
    monkeypatch.setattr(t, "BROADCAST_ROWS", 0)
    assert run() == want


def test_counts_meet_per_event_and_blocks_follow_them(spark):
    rows, labels = corpus(60)
    train = t.training_rows(documents(spark, rows * 3), spark.createDataFrame(labels, LABELS))
    got = t.event_counts(train).collect()
    assert len({r["key"] for r in got}) == len(got)
    texts = [text for i, text in rows * 3 if zlib.crc32(str(i).encode()) % 3 != 1]
    assert sum(r[f"n{g}"] for r in got for g in range(t.GROUPS)) == sum(len(x.encode()) + 1 for x in texts)
    assert t._blocks(1000, 4) == 16 and t._blocks(1000 * t.BLOCK_EVENTS, 4) == 1000


def plain_model(texts):
    """Ratios of events and contexts out of (toxic, text), number by number: a function of an event."""
    from collections import Counter, defaultdict

    counts = {0: Counter(), 1: Counter()}
    for toxic, text in texts:
        counts[toxic].update(plain_events(text))
    whole = {y: sum(c.values()) for y, c in counts.items()}
    share = {y: min(whole.values()) / n for y, n in whole.items()}
    every = set(counts[0]) | set(counts[1])
    follows = Counter(e[1:] for e in every)  # contexts a shorter event was seen in
    longer, kinds = Counter(), Counter()
    for s, n in follows.items():
        longer[s[:-1]] += n
        kinds[s[:-1]] += 1
    within = defaultdict(list)
    for e in every:
        within[e[:-1]].append(e)

    def taken(n, s):
        return 2 - 2 * (1 - s) ** n - (n * s * (1 - s) ** (n - 1) if n else 0)

    def ratio(event):
        found = []
        own = within.get(event[:-1])
        if own is None:
            return 0.0
        for y in (1, 0):
            total = sum(counts[y][e] for e in own) * share[y]
            rest = sum(taken(counts[y][e], share[y]) for e in own)
            if event not in every:
                found.append(rest / total if total else 1)
                continue
            s = event[1:]
            shared = (max(follows[s] - 0.75, 0) + 0.75 * kinds[s[:-1]] / 64) / longer[s[:-1]]
            n = counts[y][event]
            found.append((max(n * share[y] - taken(n, share[y]), 0) + rest * shared) / total if total else shared)
        return float(np.log(found[0] / found[1]))

    return ratio


def plain_events(text):
    symbols = [27] * 4 + [int(t.SYMBOL[b]) for b in (text or "").encode()] + [27]
    return [tuple(symbols[i - 4 : i + 1]) for i in range(4, len(symbols))]


def test_features_against_plain_python(spark):
    rows, labels = corpus(150)
    odd = [(10_000 + i, x) for i, x in ODD] + [(11_000, "zgrubo ogzgrub zgrubling quite unseen Xylophone 42")]
    docs, table = documents(spark, rows + odd), spark.createDataFrame(labels, LABELS)
    toxic = {i: y for i, _, y, *_ in labels}
    learnt = [(toxic[i], x) for i, x in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    ratio = plain_model(learnt)
    got = {r["doc_id"]: r for r in t.rate(docs, t.learn(t.training_rows(docs, table))).collect()}
    checked = [rows[i] for i in range(0, 150, 4)] + odd
    assert len(checked) > 45
    for i, text in checked:
        events = plain_events(text)
        values = [ratio(e) for e in events]
        words, at = [], 0
        for k, e in enumerate(events):
            if e[-1] == 27:
                words.append(sum(values[at : k + 1]))
                at = k + 1
        best = sorted(words, reverse=True)[:3]
        want = [sum(values) / len(values), *best, *[0.0] * (3 - len(best))]
        assert np.allclose([got[i][f"f{k}"] for k in range(4)], want, atol=2e-4), i


def test_scores_follow_from_the_features(spark):
    rows, labels = corpus(300)
    docs, table = documents(spark, rows), spark.createDataFrame(labels, LABELS)
    rated = t.rate(docs, t.learn(t.training_rows(docs, table)))
    intercept, weights = t.calibrate(rated, table)
    features = {r["doc_id"]: [r[f"f{k}"] for k in range(4)] for r in rated.collect()}
    for r in t.score_documents(docs, table).collect():
        z = intercept + sum(w * x for w, x in zip(weights, features[r["doc_id"]], strict=True))
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-4
