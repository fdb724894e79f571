"""Next-day forecast of word counts from seven days of statistics."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.numbers import clip, sigmoid
from pulse.schema import PREDICTION, SERIES_DAYS, PredictParams
from pulse.sources.store import materialize

FEATURES = [
    *[f"count_lag{k}" for k in range(7)],
    *[f"doc_lag{k}" for k in range(7)],
    "count_ma3",
    "count_mean",
    "momentum1",
    "momentum2",
    "count_std",
    "doc_now",
    "doc_ma3",
    "doc_growth",
    "repeat_ratio",
]
# Days that make a word stable, and how the burst score is mixed and bounded.
STABLE_DAYS = 4
GROWTH_PART, JUMP_PART = 0.7, 0.3
JUMP_MIN, JUMP_MAX = -3.0, 6.0
# Both are 0 in every training row, so their weight is 0 and the fit is the same without.
UNSEEN = ("count_lag6", "doc_lag6")


def candidate_tokens(
    stats: DataFrame, run_date: date, min_doc: int = 5, min_count: int = 10
) -> DataFrame:
    """Words that are active enough on the run date."""
    return (
        stats.filter(F.col("stat_date") == F.lit(run_date))
        .filter((F.col("doc_count") >= min_doc) & (F.col("mention_count") >= min_count))
        .select("token")
        .distinct()
    )


def narrow_to_candidates(stats: DataFrame, candidates: DataFrame) -> DataFrame:
    """Statistics of candidate words only. The join side is left to the measured sizes."""
    return stats.join(candidates, "token", "left_semi")


def token_series(stats: DataFrame, run_date: date, days: int = SERIES_DAYS) -> DataFrame:
    """Counts and documents of each word per day, oldest first, 0 for a missing day."""
    slots = [run_date - timedelta(days=i) for i in range(days - 1, -1, -1)]

    def per_day(name: str) -> list[Column]:
        return [
            F.coalesce(F.sum(F.when(F.col("stat_date") == F.lit(d), F.col(name))), F.lit(0)).cast(
                "double"
            )
            for d in slots
        ]

    return (
        stats.filter(F.col("stat_date").between(F.lit(slots[0]), F.lit(slots[-1])))
        .groupBy("token")
        .agg(
            F.array(*per_day("mention_count")).alias("counts"),
            F.array(*per_day("doc_count")).alias("docs"),
        )
    )


def _total(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def growth_ratio(c0: Column, c1: Column) -> Column:
    return (c0 + 1.0) / (c1 + 1.0)


def series_features(series: DataFrame) -> DataFrame:
    """Today, yesterday, means, spread of the six days before, and days seen."""
    c = [F.get("counts", F.lit(i)) for i in range(SERIES_DAYS)]
    before = c[:-1]
    base = series.select(
        "*",
        c[6].cast("long").alias("c0"),
        c[5].cast("long").alias("c1"),
        F.get("docs", F.lit(6)).cast("long").alias("doc0"),
        F.get("docs", F.lit(5)).cast("long").alias("doc1"),
        _total([(x > 0).cast("int") for x in c]).alias("non_zero_days"),
        (_total(before) / 6.0).alias("prev_mean"),
        (_total(c[4:]) / 3.0).alias("avg_3d_count"),
        (_total(c) / 7.0).alias("avg_7d_count"),
    )
    mu = F.col("prev_mean")
    off = [(x - mu) * (x - mu) for x in before]
    return base.select(
        "*",
        F.sqrt(_total(off) / 6.0).alias("prev_std"),
        growth_ratio(F.col("c0"), F.col("c1")).alias("growth_ratio"),
    )


def with_status(features: DataFrame, p: PredictParams = PredictParams()) -> DataFrame:
    """stable, burst or uncertain."""
    burst = (F.col("growth_ratio") >= p.growth_ratio_min) & (F.col("prev_mean") <= p.prev_mean_max)
    return features.withColumn(
        "status",
        F.when(F.col("non_zero_days") >= STABLE_DAYS, "stable").when(burst, "burst").otherwise("uncertain"),
    )


def with_burst(features: DataFrame) -> DataFrame:
    """Jump against the days before, mixed with growth since yesterday."""
    jump = (F.col("c0") - F.col("prev_mean")) / (F.col("prev_std") + 1.0)
    growth = F.log((F.col("c0") + 1.0) / (F.col("c1") + 1.0))
    return features.withColumn(
        "burst", GROWTH_PART * growth + JUMP_PART * clip(jump, JUMP_MIN, JUMP_MAX)
    )


def candidates(
    stats: DataFrame, run_date: date, p: PredictParams = PredictParams()
) -> DataFrame:
    """Active words with features, status and burst.

    The activity test sits on the grouped row, so the statistics are read and grouped once
    and need no join with a candidate list.
    """
    series = series_features(token_series(stats, run_date, p.window_days))
    active = series.filter(
        (F.col("doc0") >= p.min_doc_today) & (F.col("c0") >= p.min_count_today)
    )
    return with_burst(with_status(active, p))


def lag_vector(values: Column, j: Column, k: int) -> Column:
    """Value k days before position j, 0 before the series starts."""
    return F.coalesce(F.get(values, j - k), F.lit(0.0))


def _with_lag_features(df: DataFrame, j: Column) -> DataFrame:
    """The 23 features of position j in a series."""
    c, d = F.col("counts"), F.col("docs")
    lags = {f"count_lag{k}": lag_vector(c, j, k) for k in range(7)}
    lags |= {f"doc_lag{k}": lag_vector(d, j, k) for k in range(7)}
    seen = F.slice(c, F.lit(1), j + 1)
    n = (j + 1).cast("double")
    mean = F.aggregate(seen, F.lit(0.0), lambda a, x: a + x) / n
    df = df.withColumns(lags | {"count_mean": mean})
    mu = F.col("count_mean")
    spread = F.aggregate(seen, F.lit(0.0), lambda a, x: a + (x - mu) * (x - mu))
    x0, x1, x2 = (F.col(f"count_lag{k}") for k in range(3))
    d0, d1, d2 = (F.col(f"doc_lag{k}") for k in range(3))
    return df.withColumns(
        {
            "count_ma3": (x0 + x1 + x2) / 3.0,
            "momentum1": x0 - x1,
            "momentum2": x1 - x2,
            "count_std": F.sqrt(spread / n),
            "doc_now": d0,
            "doc_ma3": (d0 + d1 + d2) / 3.0,
            "doc_growth": F.log((d0 + 1.0) / (d1 + 1.0)),
            "repeat_ratio": x0 / (d0 + 1.0),
        }
    )


def training_rows(stable: DataFrame) -> DataFrame:
    """Six day-to-day steps per stable word: features of a day, log count of the next."""
    steps = stable.select(
        "token", "counts", "docs", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("j")
    )
    rows = _with_lag_features(steps, F.col("j"))
    return rows.select(
        "token", "j", *FEATURES, F.log1p(F.get("counts", F.col("j") + 1)).alias("label")
    )


def inference_rows(stable: DataFrame) -> DataFrame:
    """Features of the run date."""
    return _with_lag_features(stable.select("token", "counts", "docs"), F.lit(6)).select(
        "token", *FEATURES
    )


def fit_predict_ridge(train: DataFrame, infer: DataFrame, alpha: float = 1.0) -> DataFrame:
    """Ridge on log counts; returns ``token, yhat`` with counts of at least 0.

    Each task sums its rows into one small matrix, so only that matrix reaches the driver.
    The penalty is stated per row and in units of the label's deviation, hence the scaling.
    """
    stat = train.agg(
        F.count(F.lit(1)).alias("n"),
        F.stddev_pop("label").alias("sd"),
        F.avg("label").alias("mean"),
    ).first()
    if not stat["sd"]:
        yhat = F.lit(stat["mean"])
        return infer.select("token", F.greatest(F.expm1(yhat), F.lit(0.0)).alias("yhat"))
    used = [f for f in FEATURES if f not in UNSEEN]
    assemble = VectorAssembler(inputCols=used, outputCol="features")
    model = LinearRegression(
        solver="normal",
        elasticNetParam=0.0,
        standardization=False,
        regParam=alpha * stat["sd"] / stat["n"],
    ).fit(assemble.transform(train).select("features", "label"))
    scored = model.transform(assemble.transform(infer).select("token", "features"))
    return scored.select(
        "token", F.greatest(F.expm1(F.col("prediction")), F.lit(0.0)).alias("yhat")
    )


def stable_fallback(df: DataFrame) -> Column:
    """Used while there are too few rows to fit."""
    return F.col("avg_3d_count")


def forecast_burst(p: PredictParams = PredictParams()) -> Column:
    """Today plus half the gain, capped, halved when few documents carry the word."""
    c0, c1 = F.col("c0").cast("double"), F.col("c1").cast("double")
    raised = c0 + 0.5 * F.greatest(c0 - c1, F.lit(0.0))
    capped = F.least(raised, p.yhat_cap_multiplier * c0)
    return F.greatest(
        F.when(F.col("doc0") < p.min_doc_today, capped * 0.5).otherwise(capped), F.lit(0.0)
    )


def forecast_uncertain() -> Column:
    mean = F.col("avg_3d_count")
    return F.when(mean < 1.0, F.col("c0").cast("double")).otherwise(mean)


def with_rules(df: DataFrame, p: PredictParams = PredictParams()) -> DataFrame:
    """Forecast by rule; stable words get their three-day mean."""
    return df.withColumn(
        "predicted_count",
        F.when(F.col("status") == "burst", forecast_burst(p))
        .when(F.col("status") == "uncertain", forecast_uncertain())
        .otherwise(stable_fallback(df)),
    )


def with_score(df: DataFrame, p: PredictParams = PredictParams()) -> DataFrame:
    """Forecast lifted by the burst, weighted by status."""
    weight = (
        F.when(F.col("status") == "burst", p.w_burst)
        .when(F.col("status") == "stable", p.w_stable)
        .otherwise(p.w_uncertain)
    )
    lift = 1.0 + weight * sigmoid(F.col("burst"))
    return df.withColumn("score", F.col("predicted_count") * lift)


def with_forecast(df: DataFrame, p: PredictParams = PredictParams()) -> DataFrame:
    """Forecast of every active word; stable ones by ridge if there are rows enough.

    The active words are read several times (count, fit, scoring), so they are written once.
    """
    active = materialize(df)
    stable = active.filter(F.col("status") == "stable")
    ruled = with_rules(active, p)
    if stable.count() * (SERIES_DAYS - 1) < p.min_training_rows:
        return ruled
    yhat = fit_predict_ridge(training_rows(stable), inference_rows(stable), p.ridge_alpha)
    return ruled.join(yhat, "token", "left").withColumn(
        "predicted_count", F.coalesce("yhat", "predicted_count")
    )


def to_predictions(scored: DataFrame, run_date: date) -> DataFrame:
    """Stored columns, dated the day after the run."""
    names = {
        "c0": "today_count",
        "c1": "yest_count",
        "doc0": "doc_today",
        "doc1": "doc_yest",
    }
    dated = scored.withColumnsRenamed(names).withColumn(
        "predict_date", F.lit(run_date + timedelta(days=1))
    )
    return dated.select(*PREDICTION.names)


def predictions_top_n(scored: DataFrame, n: int = 50) -> DataFrame:
    """Best scores, ties by word."""
    return scored.orderBy(F.col("score").desc(), "token").limit(n)


def predict_next_day(
    stats: DataFrame, run_date: date, p: PredictParams = PredictParams()
) -> DataFrame:
    """Top forecasts for the day after ``run_date``; no statistics give no rows."""
    scored = with_score(with_forecast(candidates(stats, run_date, p), p), p)
    return to_predictions(predictions_top_n(scored, p.top_n), run_date)
