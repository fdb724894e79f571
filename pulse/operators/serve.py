"""What the dashboard and the report pages read."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.functions.dates import instant, iso_z
from pulse.functions.numbers import plain_double

# Texts of the plain report.
REPORT_TITLE = "{} 데일리 트렌드 리포트"
REPORT_SUMMARY = "예측 데이터 기준으로 상위 키워드를 요약했습니다."
REPORT_HEAD = (
    "## {} 일일 트렌드 요약",
    "- 데이터가 제한적이어서 간단 요약만 제공됩니다.",
    "- 상위 키워드를 참고해주세요.",
    "",
    "## Top Keywords",
)
REPORT_KEYWORDS = 10


def predictions_for(predictions: DataFrame, day: date, n: int) -> DataFrame:
    """Best n predictions for a day."""
    return (
        predictions.filter(F.col("predict_date") == F.lit(day))
        .orderBy(F.col("score").desc(), "token")
        .limit(n)
    )


def list_reports(reports: DataFrame, limit: int = 30) -> DataFrame:
    """Newest reports first."""
    return (
        reports.select("report_date", "title", "summary", "created_at")
        .orderBy(F.col("report_date").desc())
        .limit(limit)
    )


def get_report(reports: DataFrame, day: date) -> DataFrame:
    """One report with its keywords decoded; malformed keywords give null."""
    return reports.filter(F.col("report_date") == F.lit(day)).select(
        "report_date",
        "title",
        "summary",
        "content_md",
        F.from_json("keywords_json", T.ArrayType(T.StringType())).alias("keywords"),
        "created_at",
    )


def filter_reports(
    reports: DataFrame, query: str = "", days: int | None = None, now: datetime | None = None
) -> DataFrame:
    """Reports at most ``days`` old whose date or title holds the text, in any case."""
    if days is not None:
        age = instant(now) - F.expr(f"INTERVAL {int(days)} DAYS")
        reports = reports.filter(F.col("report_date").cast("timestamp") >= age)
    query = query.strip().lower()
    if query:
        hay = F.lower(
            F.concat_ws(
                " ",
                F.coalesce(F.col("report_date").cast("string"), F.lit("")),
                F.coalesce("title", F.lit("")),
            )
        )
        reports = reports.filter(hay.contains(query))
    return reports


def report_keywords(predictions: DataFrame, n: int = REPORT_KEYWORDS) -> DataFrame:
    """Words of the best n rows in rank order, empty ones left out, as one array."""
    best = predictions.orderBy(F.col("score").desc(), "token").limit(n)
    return best.agg(_ranked_words().alias("keywords"))


def _best_first() -> Column:
    """At most ten collected rows, best score first, ties by word."""
    rows = F.collect_list(F.struct((-F.col("score")).alias("o"), "token", "score"))
    return F.sort_array(rows)


def _ranked_words() -> Column:
    words = F.transform(_best_first(), lambda r: r["token"])
    return F.filter(words, lambda t: F.length(t) > 0)


def daily_report(predictions: DataFrame, day: date, n: int = REPORT_KEYWORDS) -> DataFrame:
    """Ranked Markdown report of a day, one row; no row without predictions."""
    best = predictions_for(predictions, day, n)
    rows = best.agg(_best_first().alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 0")
    lines = F.transform(
        "best",
        lambda r, i: F.concat(
            F.lit("- "), (i + 1).cast("string"), F.lit(". "),
            F.coalesce(r["token"], F.lit("None")),
            F.lit(" (score "), plain_double(r["score"]), F.lit(")"),
        ),
    )
    head = F.array(*[F.lit(s.format(day.isoformat())) for s in REPORT_HEAD])
    words = F.filter(F.transform("best", lambda r: r["token"]), lambda t: F.length(t) > 0)
    return rows.select(
        F.lit(day).alias("report_date"),
        F.lit(REPORT_TITLE.format(day.isoformat())).alias("title"),
        F.lit(REPORT_SUMMARY).alias("summary"),
        F.array_join(F.concat(head, lines), "\n").alias("content_md"),
        F.to_json(words).alias("keywords_json"),
    )


def report_payload(predictions: DataFrame, day: date, n: int) -> DataFrame:
    """The day's best predictions as one JSON text, for whoever writes the report."""
    names = [c for c in predictions.columns if c not in ("predict_date", "created_at")]
    best = predictions_for(predictions, day, n).select(
        F.struct((-F.col("score")).alias("o"), F.col("token").alias("t"), F.struct(*names).alias("r"))
        .alias("row")
    )
    items = F.transform(F.sort_array(F.collect_list("row")), lambda x: x["r"])
    return best.agg(items.alias("items")).select(
        F.to_json(
            F.struct(
                F.lit(day.isoformat()).alias("report_date"), F.lit(n).alias("top_n"), "items"
            )
        ).alias("payload")
    )


def merge_reports(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Reports after an upsert by date: new texts win, the first creation time stays."""
    texts = ["title", "summary", "content_md", "keywords_json"]
    old = stored.select("report_date", F.col("created_at").alias("_created"))
    fresh = new.join(old, "report_date", "left").select(
        "report_date", *texts, F.coalesce("_created", "created_at").alias("created_at")
    )
    kept = stored.join(new.select("report_date"), "report_date", "left_anti")
    return kept.select(*fresh.columns).unionByName(fresh)


def limit_items(df: DataFrame, n: int | None, column: str = "items") -> DataFrame:
    """Shorten an array column; without a positive limit nothing changes."""
    if not n or n <= 0:
        return df
    return df.withColumn(column, F.slice(column, 1, n))


def encode(df: DataFrame, *keep: str) -> DataFrame:
    """All columns as one JSON ``payload``, nulls included and times as ISO text.

    ``keep`` stay as columns too.
    """
    fields = [
        iso_z(F.col(f.name)).alias(f.name) if f.dataType == T.TimestampType() else F.col(f.name)
        for f in df.schema.fields
    ]
    whole = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(*keep, whole.alias("payload"))


def decode(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns out of ``payload``; rows that do not decode are dropped."""
    checked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    body = F.from_json("payload", checked, {"columnNameOfCorruptRecord": "_corrupt"})
    return (
        df.select(body.alias("p"))
        .filter("p is not null and p._corrupt is null")
        .select("p.*")
        .drop("_corrupt")
    )


def latest_snapshot(history: DataFrame, now: datetime | None = None) -> DataFrame:
    """Newest snapshot that has not expired: ``payload``, no row or one."""
    alive = history.filter(F.col("expires_at").isNull() | (F.col("expires_at") > instant(now)))
    newest = alive.orderBy(F.col("window_end").desc(), F.col("expires_at").desc())
    return newest.limit(1).select("payload")


def dashboard_latest(
    traffic: DataFrame, top: DataFrame, rising: DataFrame, limit: int | None = None
) -> DataFrame:
    """The three latest snapshots as one row of structs; no row when all are absent.

    Each input has no row or one, so tagging and grouping puts them side by side.
    """
    parts = {
        "traffic": traffic,
        "top": limit_items(top, limit),
        "rising": limit_items(rising, limit),
    }
    types = {name: part.select(F.struct("*")).schema[0].dataType for name, part in parts.items()}
    rows = [
        part.select(
            *[
                (F.struct("*") if other == name else F.lit(None).cast(types[other])).alias(other)
                for other in parts
            ]
        )
        for name, part in parts.items()
    ]
    tagged = rows[0].unionByName(rows[1]).unionByName(rows[2])
    one = tagged.agg(
        *[F.first(name, ignorenulls=True).alias(name) for name in parts],
        F.count(F.lit(1)).alias("n"),
    )
    return one.filter("n > 0").drop("n")

