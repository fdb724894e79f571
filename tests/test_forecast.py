import math
from datetime import date, timedelta

import numpy as np
import pytest

from pulse.operators import forecast as f
from pulse.schema import PREDICTION, TOKEN_STATS, PredictParams

RUN = date(2024, 1, 7)


def stats(spark, series):
    """Statistics from ``{token: (counts, docs)}``; zero counts have no row."""
    rows = []
    for token, (counts, docs) in series.items():
        for i, (c, d) in enumerate(zip(counts, docs)):
            if c:
                rows.append((RUN - timedelta(days=6 - i), token, c, d))
    return spark.createDataFrame(rows, TOKEN_STATS)


def flat(counts):
    return counts, [min(c, 9) for c in counts]


def features(c, d, j):
    """The 23 numbers of day j, straight from their definitions."""
    x = [c[j - k] if j >= k else 0.0 for k in range(7)]
    y = [d[j - k] if j >= k else 0.0 for k in range(7)]
    seen = np.array(c[: j + 1], float)
    return x + y + [
        np.mean(x[:3]), seen.mean(), x[0] - x[1], x[1] - x[2], seen.std(), y[0], np.mean(y[:3]),
        math.log((y[0] + 1) / (y[1] + 1)), x[0] / (y[0] + 1),
    ]


def stable_words(n, seed=0):
    rng = np.random.default_rng(seed)
    out = {}
    for i in range(n):
        counts = [int(v) for v in rng.integers(0, 60, 7)]
        counts[3:] = [max(v, 1) for v in counts[3:]]
        counts[6] = max(counts[6], 10)
        out[f"s{i:03d}"] = (counts, [min(c, int(rng.integers(5, 30))) for c in counts])
    return out


def predict(spark, series, **params):
    rows = f.predict_next_day(stats(spark, series), RUN, PredictParams(**params)).collect()
    return {r["token"]: r for r in rows}


def test_series_fills_missing_days_and_ignores_others(spark):
    df = stats(spark, {"a": ([0, 2, 0, 0, 0, 0, 9], [0, 1, 0, 0, 0, 0, 5])})
    old = spark.createDataFrame([(RUN - timedelta(days=7), "a", 99, 99)], TOKEN_STATS)
    row = f.token_series(df.unionAll(old), RUN).first()
    assert row["counts"] == [0, 2, 0, 0, 0, 0, 9] and row["docs"] == [0, 1, 0, 0, 0, 0, 5]


@pytest.mark.parametrize(
    "counts, status",
    [
        ([0, 0, 0, 1, 1, 1, 10], "stable"),  # four days
        ([0, 0, 0, 0, 1, 9, 19], "burst"),  # growth exactly 2
        ([0, 0, 0, 0, 1, 9, 18], "uncertain"),  # growth just below 2
        ([0, 0, 0, 0, 9, 9, 30], "burst"),  # mean of the days before exactly 3
        ([0, 0, 0, 0, 10, 9, 30], "uncertain"),  # mean just above 3
        ([0, 0, 0, 0, 0, 0, 10], "burst"),
    ],
)
def test_status_at_the_thresholds(spark, counts, status):
    row = f.candidates(stats(spark, {"a": flat(counts)}), RUN).first()
    assert row["status"] == status


@pytest.mark.parametrize("counts", [[0] * 6 + [500], [90, 0, 90, 0, 90, 90, 10], [1, 2, 3, 4, 5, 6, 70]])
def test_burst_score(spark, counts):
    row = f.candidates(stats(spark, {"a": flat(counts)}), RUN).first()
    prev = np.array(counts[:6], float)
    jump = (counts[6] - prev.mean()) / (prev.std() + 1)
    want = 0.7 * math.log((counts[6] + 1) / (counts[5] + 1)) + 0.3 * min(max(jump, -3), 6)
    assert row["burst"] == pytest.approx(want, rel=1e-12)


def test_only_active_words_are_candidates(spark):
    series = {
        "in": ([0] * 6 + [10], [0] * 6 + [5]),
        "few_docs": ([0] * 6 + [10], [0] * 6 + [4]),
        "few_counts": ([0] * 6 + [9], [0] * 6 + [9]),
        "yesterday": ([0] * 5 + [50, 0], [0] * 5 + [9, 0]),
    }
    df = stats(spark, series)
    assert [r["token"] for r in f.candidates(df, RUN).collect()] == ["in"]
    chosen = f.candidate_tokens(df, RUN)
    assert [r["token"] for r in chosen.collect()] == ["in"]
    assert f.narrow_to_candidates(df, chosen).count() == 1


def test_rules_for_burst_and_uncertain(spark):
    series = {
        "burst": flat([0, 0, 0, 0, 0, 2, 20]),
        "capped": flat([0, 0, 0, 0, 0, 0, 20]),
        "mean": flat([0, 0, 0, 0, 20, 20, 20]),
        "small": ([0, 0, 0, 0, 0, 0, 2], [0, 0, 0, 0, 0, 0, 2]),
    }
    got = predict(spark, series, min_doc_today=1, min_count_today=1, growth_ratio_min=2.0)
    assert got["burst"]["predicted_count"] == 29.0
    assert got["capped"]["predicted_count"] == 30.0
    assert got["mean"]["predicted_count"] == 20.0
    got = predict(spark, {"x": flat([0, 0, 0, 0, 0, 0, 20])}, yhat_cap_multiplier=1.25)
    assert got["x"]["predicted_count"] == 25.0
    # Growth demanded above what it has: uncertain, and a mean below 1 gives today's count.
    got = predict(spark, {"s": series["small"]}, min_doc_today=1, min_count_today=1, growth_ratio_min=9.0)
    assert (got["s"]["status"], got["s"]["predicted_count"]) == ("uncertain", 2.0)


def test_burst_forecast_is_halved_with_few_documents(spark):
    df = spark.createDataFrame([(20, 0, 3)], "c0 bigint, c1 bigint, doc0 bigint")
    assert df.select(f.forecast_burst()).first()[0] == 15.0


def test_score_uses_the_weight_of_the_status(spark):
    rows = [("a", 10.0, "burst", 0.5), ("b", 10.0, "stable", 0.5), ("c", 10.0, "uncertain", 0.5)]
    df = spark.createDataFrame(rows, "token string, predicted_count double, status string, burst double")
    sig = 1 / (1 + math.exp(-0.5))
    got = [r["score"] for r in f.with_score(df).orderBy("token").collect()]
    assert got == pytest.approx([10 * (1 + w * sig) for w in (1.5, 0.7, 0.3)], rel=1e-14)


def test_feature_rows_match_their_definitions(spark):
    series = stable_words(6)
    df = f.token_series(stats(spark, series), RUN)
    for r in f.training_rows(df).collect():
        c, d = series[r["token"]]
        assert [r[x] for x in f.FEATURES] == pytest.approx(features(c, d, r["j"]), abs=1e-12)
        assert r["label"] == pytest.approx(math.log1p(c[r["j"] + 1]), rel=1e-14)
    rows = f.inference_rows(df).collect()
    assert len(rows) == 6 and f.training_rows(df).count() == 36
    for r in rows:
        assert [r[x] for x in f.FEATURES] == pytest.approx(features(*series[r["token"]], 6), abs=1e-12)


def test_ridge_equals_the_closed_form(spark):
    series = stable_words(40)
    train = [(features(c, d, j), math.log1p(c[j + 1])) for c, d in series.values() for j in range(6)]
    x, y = np.array([t[0] for t in train]), np.array([t[1] for t in train])
    xm, ym = x.mean(0), y.mean()
    xc = x - xm
    coef = np.linalg.solve(xc.T @ xc + np.eye(x.shape[1]), xc.T @ (y - ym))
    got = predict(spark, series)
    assert len(got) == 40 and {r["status"] for r in got.values()} == {"stable"}
    for token, (c, d) in series.items():
        want = max(math.expm1(ym + (np.array(features(c, d, 6)) - xm) @ coef), 0.0)
        assert got[token]["predicted_count"] == pytest.approx(want, rel=1e-9)


def test_fit_needs_fifty_rows(spark):
    eight, nine = stable_words(8), stable_words(9)
    got = predict(spark, eight)
    assert all(r["predicted_count"] == r["avg_3d_count"] for r in got.values())
    got = predict(spark, nine)
    assert any(r["predicted_count"] != r["avg_3d_count"] for r in got.values())


def test_constant_series_do_not_break_the_fit(spark):
    series = {f"s{i:02d}": ([12] * 7, [6] * 7) for i in range(12)}
    got = predict(spark, series)
    assert [r["predicted_count"] for r in got.values()] == pytest.approx([12.0] * 12, rel=1e-12)


def test_top_n_breaks_ties_by_word_and_dates_tomorrow(spark):
    series = {t: flat([0] * 6 + [20]) for t in ("c", "a", "b")}
    df = f.predict_next_day(stats(spark, series), RUN, PredictParams(top_n=2))
    assert [r["token"] for r in df.collect()] == ["a", "b"]
    assert df.first()["predict_date"] == RUN + timedelta(days=1)
    assert (df.first()["today_count"], df.first()["yest_count"], df.first()["doc_today"]) == (20, 0, 9)


def test_no_statistics_give_an_empty_result_of_the_same_layout(spark):
    df = f.predict_next_day(spark.createDataFrame([], TOKEN_STATS), RUN)
    assert df.collect() == []
    assert [(x.name, x.dataType) for x in df.schema] == [(x.name, x.dataType) for x in PREDICTION]


def test_only_seven_days_are_accepted():
    with pytest.raises(ValueError):
        PredictParams(window_days=8)
