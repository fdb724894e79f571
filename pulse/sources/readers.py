"""Reading posts, statistics, word lists and crawl results."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.functions.text import DEFAULT_STOPWORDS
from pulse.operators.serve import dashboard_latest, decode, latest_snapshot
from pulse.schema import FAILURE, POST_MESSAGE, SNAPSHOT_SCHEMAS
from pulse.sources import log
from pulse.sources.sinks import SNAPSHOT_ROW
from pulse.sources.store import day_names

# A word list becomes part of the plan, so it has to stay small.
MAX_STOPWORDS = 100_000

MESSAGE_ROW = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("msg_id", T.LongType()),
    ]
)


def read_posts_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    from_start: bool = False,
    processing_time: bool = False,
) -> DataFrame:
    """Stream of ``value, ts, msg_id``: message text, arrival time, and arrival order.

    Any file format with these three columns takes the place of the broker. With
    ``processing_time`` the time of the micro-batch replaces the arrival time.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        start = "earliest" if from_start else "latest"
        stream = (
            reader.option("startingOffsets", start)
            .load()
            .select(
                F.col("value").cast("string").alias("value"),
                F.col("timestamp").alias("ts"),
                F.struct("partition", "offset").alias("msg_id"),
            )
        )
    else:
        stream = reader.schema(MESSAGE_ROW).load()
    return stream.withColumn("ts", F.current_timestamp()) if processing_time else stream


def jdbc_options(
    url: str,
    table: str,
    partition_column: str,
    lower: str | None = None,
    upper: str | None = None,
    num_partitions: int = 64,
    fetch_size: int = 10_000,
    **more: str,
) -> dict[str, str]:
    """Options of a table read that is split over tasks by a column and its bounds."""
    if lower is None or upper is None:
        raise ValueError("a partitioned read needs lower and upper bounds")
    return {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_size),
        "partitionColumn": partition_column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(num_partitions),
        **more,
    }


def read_posts(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The stored posts, from files or with ``fmt="jdbc"`` and :func:`jdbc_options`.

    The folders of a landed table are not a column of it. A table read without a split would be one
    task and is refused.
    """
    if fmt == "jdbc" and "partitionColumn" not in (options or {}):
        raise ValueError("a table read needs jdbc_options with a partition column")
    reader = spark.read.format(fmt).options(**(options or {}))
    rows = reader.load(path) if path is not None else reader.load()
    return rows.drop("bucket")


def spread(df: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Deal a table of fewer files than cores out to all of them.

    A file may be one row group, and a row group is one task, which would then do all the
    text work alone. A table that already splits into several tasks per core is left as it is
    without listing its files. ``stored`` is the table behind a stream, which cannot list its
    files itself.
    """
    source = stored or df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if source.rdd.getNumPartitions() > 4 * cores or len(source.inputFiles()) >= cores:
        return df
    return df.repartition(cores)


def read_token_stats(stats: DataFrame, run_date: date, window_days: int = 7) -> DataFrame:
    """Statistics of the days that end with the run date; the filter reaches the scan."""
    first = run_date - timedelta(days=window_days - 1)
    return stats.filter(F.col("stat_date").between(F.lit(first), F.lit(run_date))).select(
        "stat_date", "token", "mention_count", "doc_count"
    )


def read_words(spark: SparkSession, path: str, lower: bool = True) -> DataFrame:
    """A word list of any length as a table: ``word``, one per line, blank lines and # lines skipped.

    For lists too long for a plan; see :func:`pulse.operators.docs.without_words`.
    """
    word = F.trim("value")
    if lower:
        word = F.lower(word)
    lines = spark.read.text(path).select(word.alias("word"))
    return lines.filter((F.col("word") != "") & ~F.col("word").startswith("#")).distinct()


def _word_lines(spark: SparkSession, path: str, lower: bool) -> list[str]:
    return [r["word"] for r in read_words(spark, path, lower).limit(MAX_STOPWORDS + 1).collect()]


def load_stopwords(
    spark: SparkSession,
    candidates: str | Sequence[str] | None = None,
    extra_csv: str = "",
    lower: bool = True,
    default: Sequence[str] = DEFAULT_STOPWORDS,
) -> tuple[str, ...]:
    """Words of the first readable file and of a comma list; the default if both are empty.

    The daily job reads with ``lower=False, default=()``.
    """
    words: set[str] = set()
    for path in [candidates] if isinstance(candidates, str) else candidates or ():
        try:
            words.update(_word_lines(spark, path, lower))
            break
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    extra = (w.strip() for w in extra_csv.split(","))
    words.update(w.lower() if lower else w for w in extra if w)
    if len(words) > MAX_STOPWORDS:
        raise ValueError(f"more than {MAX_STOPWORDS} stopwords; name the list as a table instead")
    return tuple(sorted(words or default))


def read_snapshots(
    spark: SparkSession, path: str, name: str, days: Collection[date] | None = None
) -> DataFrame:
    """Snapshots of a kind as stored, the newest write of each window, of some days or all."""
    return log.latest(log.read(spark, f"{path}/{name}", SNAPSHOT_ROW, days))


def read_snapshot(
    spark: SparkSession, path: str, name: str, now: datetime | None = None
) -> DataFrame:
    """Latest snapshot of a kind, decoded; no row when missing, expired or malformed.

    Days are opened from the newest on until one has a snapshot that has not expired.
    """
    newest = spark.createDataFrame([], SNAPSHOT_ROW)
    for day in reversed(day_names(spark, f"{path}/{name}")):
        newest = latest_snapshot(read_snapshots(spark, path, name, [day]), now)
        if not newest.isEmpty():
            break
    return decode(newest.select("payload"), SNAPSHOT_SCHEMAS[name])


def read_dashboard(
    spark: SparkSession, path: str, now: datetime | None = None, limit: int | None = None
) -> DataFrame:
    """The latest stored snapshots side by side; no row when there is none."""
    parts = [read_snapshot(spark, path, name, now) for name in ("traffic", "top", "rising")]
    return dashboard_latest(*parts, limit=limit)


def read_crawl_result(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Posts and failures of an earlier crawl, each file one JSON object with both lists."""
    schema = T.StructType(
        [
            T.StructField("posts", T.ArrayType(POST_MESSAGE)),
            T.StructField("failures", T.ArrayType(FAILURE)),
        ]
    )
    runs = spark.read.schema(schema).option("multiLine", "true").json(path)
    posts = runs.select(F.explode("posts").alias("p")).select("p.*")
    failures = runs.select(F.explode("failures").alias("f")).select("f.*")
    return posts, failures
