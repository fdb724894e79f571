"""The analyzer against every way to cut a word, in plain Python."""

import math
import random
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from pulse.operators import docs
from pulse.operators import segment as s


def cuts(word):
    """All ways to cut a word."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        for rest in cuts(word[n:]):
            yield [word[:n], *rest]


def model_of(words):
    seen = Counter(w[a:b] for w in words for a in range(len(w)) for b in range(a + 1, min(len(w), a + 8) + 1))
    kept = {p: n for p, n in seen.items() if n >= 3}
    total = sum(kept.values())
    return {p: math.floor(1000 * math.log(total / n) + 0.5) for p, n in kept.items()}


def expected(word, costs):
    def rank(cut):
        prices = [costs.get(p, 20_000 if len(p) == 1 else math.inf) for p in cut]
        return sum(prices), len(cut), [-len(p) for p in reversed(cut)]

    return min(cuts(word), key=rank)


def words(seed, n=120):
    rng = random.Random(seed)
    stems = ["walk", "jump", "talk", "sing", "학교", "도서관", "x"]
    ends = ["", "ing", "ed", "er", "ers", "에서", "는", "으로"]
    return sorted({rng.choice(stems) + rng.choice(["", "er", "able"]) + rng.choice(ends) for _ in range(n)})


def test_the_model_counts_places_in_distinct_words(spark):
    own = words(1)
    texts = spark.createDataFrame([(" ".join(own).upper(),), (" 12 \n" + " ".join(own[:9]),), ("y" * 41,), (None,)], "cleaned_text string")
    got = {r["piece"]: r["cost"] for r in s.learn_pieces(s.distinct_words(texts)).collect()}
    assert got == model_of(own)
    few = s.learn_pieces(s.distinct_words(texts), 5).collect()
    assert len(few) == 5 and {r["piece"] for r in few} < set(got)


def test_words_are_cut_at_the_least_cost():
    costs = model_of(words(2))
    lattice = s.Lattice(costs)
    for word in [*words(3, 60), "zzwalkzz", "q", "walkjump"]:
        assert lattice.pieces(word) == expected(word, costs), word
    tied = s.Lattice({"ab": 10, "c": 10, "a": 10, "bc": 10, "abc": 20})
    assert tied.pieces("abc") == ["abc"]
    assert s.Lattice({"ab": 10, "c": 10, "a": 10, "bc": 10}).pieces("abc") == ["a", "bc"]


def test_stems_stay_and_endings_go(spark):
    own = [f"{stem}{end}" for stem in ("학교", "회사", "시장", "나라", "walk", "jump") for end in ("", "에서", "으로", "ing", "s")]
    corpus = spark.createDataFrame([(" ".join(own),)], "cleaned_text string")
    analyze = s.analyzer(s.learn_pieces(s.distinct_words(corpus)))
    texts = spark.createDataFrame([(1, "학교에서 Walking 2024 시장으로"), (2, ""), (3, None), (4, "가" * 41)], "i int, cleaned_text string")
    got = {r["i"]: r["m"] for r in texts.select("i", analyze(F.col("cleaned_text")).alias("m")).collect()}
    assert [tuple(m) for m in got[1]] == [
        ("학교", "NNG"), ("에서", "XSN"), ("walk", "NNG"), ("ing", "XSN"), ("2024", "SN"), ("시장", "NNG"), ("으로", "XSN")
    ]
    assert got[2] == got[3] == [] and [m["tag"] for m in got[4]] == ["SW"]
    tokens = docs.tokenize(texts, "morph", analyze).filter("i = 1").first()["tokens"]
    assert tokens == ["학교", "walk", "시장"]


def test_kept_words_do_not_change_the_pieces(spark, monkeypatch):
    own = words(4)
    model = s.learn_pieces(s.distinct_words(spark.createDataFrame([(" ".join(own),)], "cleaned_text string")))
    lattice = s.Lattice({r["piece"]: r["cost"] for r in model.collect()})
    rng = random.Random(6)
    texts = [" ".join(rng.choices([*own, "12", "É" * 41], k=rng.randrange(12))) for _ in range(60)] + ["", None]
    want = [[m for w in (t or "").lower().split() for m in lattice.morphs(w)] for t in texts]
    known = s.Known(lattice)
    for part in (texts[:20], texts[20:], []):  # later batches meet kept words
        got = known.of(pa.array(part, pa.string())).to_pylist()
        assert [[(m["form"], m["tag"]) for m in ms] for ms in got] == want[texts.index(part[0]) :][: len(part)] if part else got == []
    assert len(known) == len(known.starts) - 1 <= len(own) + 2


def test_distinct_words_take_no_regex_split(spark):
    df = spark.createDataFrame([("a b a",)], "cleaned_text string")
    plan = s.distinct_words(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct" in plan and "p{Z}" not in plan
