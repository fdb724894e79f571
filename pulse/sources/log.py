"""Append-only logs of windows, foldered by day.

Every write adds one folder ``window_day=.../seq=...`` to the days it touches, with one file unless the
rows are many; nothing written is changed. Readers take the newest write of each window, so a
window can be written again at any time, and a reader never sees half a write. ``compact`` puts the
newest rows of a day into one write and drops the older ones.
"""

from __future__ import annotations

import time
from collections.abc import Collection, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.sources.store import day_names, folder_names, materialize, read_days, remove_folder

DAY = T.StructField("window_day", T.DateType())
SEQ = T.StructField("seq", T.LongType())


def next_seq(spark: SparkSession, path: str) -> int:
    """A number above those of earlier writes: microseconds, whatever the clock above the newest day's."""
    newest = [
        int(n) for d in day_names(spark, path)[-1:]
        for n in folder_names(spark, f"{path}/window_day={d.isoformat()}", "seq")
    ]
    return max([time.time_ns() // 1000, *[n + 1 for n in newest]])


def append(
    rows: DataFrame,
    path: str,
    seq: int | None = None,
    observe: tuple[Observation, Column] | None = None,
    by: Sequence[str] = ("window_day",),
) -> int:
    """Write rows with a ``window_end``; returns the number of the write.

    What is observed is observed right before the write, where an empty input is still seen. Where the rows are
    many, those alike in ``by`` share a file.
    """
    seq = next_seq(rows.sparkSession, path) if seq is None else seq
    keyed = rows.withColumns({"window_day": F.to_date("window_end"), "seq": F.lit(seq).cast("long")})
    keyed = keyed.hint("rebalance", *by)
    keyed = keyed if observe is None else keyed.observe(*observe)
    keyed.write.mode("append").partitionBy("window_day", "seq").parquet(path)
    return seq


def read(
    spark: SparkSession, path: str, schema: T.StructType, days: Collection[date] | None = None
) -> DataFrame:
    """All writes of some days, or of all."""
    full = T.StructType([*schema.fields, DAY, SEQ])
    return read_days(spark, path, full, days=days)


def latest(rows: DataFrame, key: Sequence[str] = ("window_end",)) -> DataFrame:
    """The rows of the newest write of each key."""
    newest = rows.groupBy(*key).agg(F.max("seq").alias("seq"))
    return rows.join(newest, [*key, "seq"], "left_semi")


def compact(
    spark: SparkSession, path: str, schema: T.StructType, days: Collection[date] | None = None
) -> dict[date, int]:
    """One write per day in place of several; returns how many each day had.

    The new write comes first. Until the older ones are gone readers see both and take the new.
    """
    had = {}
    for day in day_names(spark, path) if days is None else days:
        folder = f"{path}/window_day={day.isoformat()}"
        old = folder_names(spark, folder, "seq")
        had[day] = len(old)
        if len(old) > 1:
            kept = materialize(latest(read(spark, path, schema, [day])).select(*schema.names))
            append(kept, path, max(next_seq(spark, path), max(map(int, old)) + 1))
            for name in old:
                remove_folder(spark, f"{folder}/seq={name}")
    return had
