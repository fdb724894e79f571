"""Writing posts, dated tables, snapshots, reports and routed messages.

Tables are parquet folders. A write replaces whole partitions or appends rows whose key is new, so
running a job or a micro-batch again leaves the same result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.functions.dates import instant
from pulse.operators.ingest import RAW, publish_summary
from pulse.operators.serve import encode, merge_reports
from pulse.schema import REPORT
from pulse.sources import log
from pulse.sources.store import materialize, read_or_empty

SNAPSHOT_ROW = T.StructType(
    [
        T.StructField("window_end", T.TimestampType()),
        T.StructField("payload", T.StringType()),
        T.StructField("expires_at", T.TimestampType()),
    ]
)


def overwrite_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replace the partitions that occur in ``df``; all others stay."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)


def replace_dates(
    df: DataFrame, path: str, date_col: str, dates: Sequence[date], rebalance: bool = False
) -> dict[date, int]:
    """Replace the rows of the given dates; a date without new rows ends up empty.

    The rows of each date are counted while they are written. ``rebalance`` evens out file
    sizes (large dates are split, small ones merged) and is meant for aggregated tables.
    """
    seen = Observation()
    rows = df.filter(F.col(date_col).isin(list(dates))).observe(
        seen, *[F.count_if(F.col(date_col) == F.lit(d)).alias(d.isoformat()) for d in dates]
    )
    if rebalance:
        rows = rows.hint("rebalance", date_col)
    overwrite_partitions(rows, path, [date_col])
    counts = {d: seen.get[d.isoformat()] for d in dates}
    nothing = df.sparkSession.createDataFrame([], df.drop(date_col).schema)
    for d in [d for d, n in counts.items() if n == 0]:
        nothing.write.mode("overwrite").parquet(f"{path}/{date_col}={d.isoformat()}")
    return counts


def write_predictions(predictions: DataFrame, path: str, predict_date: date) -> int:
    """Replace the predictions for a day."""
    return replace_dates(predictions, path, "predict_date", [predict_date])[predict_date]


def write_snapshot(
    snapshots: DataFrame,
    path: str,
    name: str,
    ttl_seconds: int | None = None,
    now: datetime | None = None,
) -> None:
    """Append snapshots to the log of their kind; the newest write of a window counts.

    Without a time to live a snapshot never expires.
    """
    expires = F.lit(None).cast("timestamp")
    if ttl_seconds is not None:
        expires = instant(now) + F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS")
    rows = encode(snapshots, "window_end").select(
        "window_end", "payload", expires.alias("expires_at")
    )
    log.append(rows, f"{path}/{name}")


def upsert_reports(new: DataFrame, path: str) -> None:
    """Insert reports or update them by date, keeping the first creation time."""
    stored = read_or_empty(new.sparkSession, path, REPORT)
    touched = stored.join(new.select("report_date"), "report_date", "left_semi")
    merged = merge_reports(touched, new).select(*REPORT.names)
    overwrite_partitions(materialize(merged), path, ["report_date"])


def write_routed(
    routed: DataFrame, fmt: str = "kafka", path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> dict[str, int]:
    """Send messages to their topics, or to one folder per topic; returns rows per topic."""
    sent = Observation()
    topics = ["raw", "cleaned", "error"]
    rows = routed.observe(sent, *[F.count_if(F.col("topic") == t).alias(t) for t in topics])
    writer = rows.write.format(fmt).mode("append").options(**(options or {}))
    if fmt == "kafka":
        writer.save()
    else:
        writer.partitionBy("topic").save(path)
    return {t: sent.get[t] for t in topics}


def check_published(routed_or_counts: DataFrame | Mapping[str, int], posts: int) -> None:
    """Fail when there were posts but none was sent."""
    counts = routed_or_counts
    if isinstance(counts, DataFrame):
        counts = {r["topic"]: r["sent"] for r in publish_summary(counts).collect()}
    if posts > 0 and counts.get(RAW, 0) == 0:
        raise RuntimeError(f"{posts} posts but nothing was sent to topic {RAW!r}")
