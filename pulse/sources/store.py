"""Where intermediate and history tables live."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Collection
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The session names it in ``spark.checkpoint.dir``. A machine-local folder is used only on a
    local master without that setting, as in tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="pulse-")
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under :func:`work_dir`."""
    return f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows to reliable storage and continue from there."""
    work_dir(df.sparkSession)
    return df.checkpoint()


def _path(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column, from the names of the folders alone."""
    root, fs = _path(spark, path)
    if not fs.exists(root):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(root)]
    return sorted(n.split("=")[1] for n in names if n.startswith(f"{column}="))


def remove_folder(spark: SparkSession, path: str) -> None:
    root, fs = _path(spark, path)
    fs.delete(root, True)


def day_names(spark: SparkSession, path: str, column: str = "window_day") -> list[date]:
    """Days of a table foldered by day."""
    return [date.fromisoformat(n) for n in folder_names(spark, path, column)]


def read_days(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    first: date | None = None,
    last: date | None = None,
    column: str = "window_day",
    days: Collection[date] | None = None,
) -> DataFrame:
    """Rows of the days in a range, or of listed ones; the files of other days are not even listed."""
    days = [
        d for d in day_names(spark, path, column)
        if (first is None or d >= first) and (last is None or d <= last) and (days is None or d in days)
    ]
    if not days:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/{column}={d.isoformat()}" for d in days]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet table, or no rows when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
