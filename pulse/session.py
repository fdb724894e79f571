"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


PARTITIONS_PER_CORE = 3


def build_session(app_name: str = "pulse", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in (SETTINGS | extra).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    cores = spark.sparkContext.defaultParallelism
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if not spark.sparkContext.master.startswith("local") and spark.conf.get(initial, None) is None:
        # adaptive execution only merges partitions, so a large cluster has to start with many
        given = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(initial, str(max(given, PARTITIONS_PER_CORE * cores)))
    return spark
