"""The post table: one row per url, foldered by a hash of the url.

A url belongs to the bucket ``xxhash64(url) mod BUCKETS``, so a batch can only meet stored urls in the
buckets of its own urls. Beside the posts every bucket has a Bloom filter of its urls, an array of
words of bits in a log. A batch opens a bucket only if the filter lets one of its urls pass;
urls that no filter knows are new without reading a stored row. A filter is written before the posts
it covers, so it may know urls that are not stored, never the other way round; a bucket with posts and
no filter is opened.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.schema import POST
from pulse.sources.store import folder_names, read_or_empty, remove_folder, scratch

#: Setting of a store, not to be changed once it has rows.
BUCKETS = 128
#: Words of 64 bits in a filter, and bits set for each url: about one url in 100 passes wrongly at 27,000
#: urls a bucket. A fuller filter lets more pass, which costs reads and nothing else.
FILTER_WORDS = 4096
FILTER_HASHES = 4
# Urls of one batch are broadcast up to this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024

FILTER_ROWS = T.StructType(
    [
        T.StructField("bits", T.ArrayType(T.LongType())),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("seq", T.LongType()),
    ]
)


def bucket_of(url: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


def _places(url: Column) -> list[Column]:
    """The bits of a url in its bucket's filter."""
    return [F.pmod(F.xxhash64(url, F.lit(i)), F.lit(64 * FILTER_WORDS)) for i in range(FILTER_HASHES)]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))


def filters_of(urls: DataFrame) -> DataFrame:
    """bucket, bits: the filter of each bucket's urls."""
    set_ = F.explode(F.array(*_places(F.col("url")))).alias("place")
    words = urls.select("bucket", set_).select(
        "bucket", F.floor(F.col("place") / 64).cast("int").alias("word"), _bit(F.col("place")).alias("bit")
    )
    each = words.groupBy("bucket", "word").agg(F.bit_or("bit").alias("bits"))
    found = F.map_from_entries(F.collect_list(F.struct("word", "bits")))  # FILTER_WORDS entries at most
    whole = each.groupBy("bucket").agg(found.alias("m"))
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(FILTER_WORDS - 1)),
        lambda w: F.coalesce(F.element_at("m", w.cast("int")), F.lit(0).cast("long")),
    )
    return whole.select("bucket", dense.alias("bits"))


def _maybe_stored(bits: Column, url: Column) -> Column:
    """Whether a filter lets a url pass; without a filter it does."""
    hit = F.lit(True)
    for place in _places(url):
        word = F.get(bits, F.floor(place / 64).cast("int"))
        hit = hit & (word.bitwiseAND(_bit(place)) != 0)
    return bits.isNull() | hit


def _folders(spark: SparkSession, path: str) -> set[int]:
    return set(map(int, folder_names(spark, path, "bucket")))


def read_filters(spark: SparkSession, path: str, buckets: Collection[int]) -> DataFrame:
    """bucket, bits of some buckets; BUCKETS rows of 32 KB at most."""
    root = f"{path}/filters"
    known = _folders(spark, root) & set(buckets)
    if not known:
        return spark.createDataFrame([], FILTER_ROWS).drop("seq")
    folders = [f"{root}/bucket={b}" for b in sorted(known)]
    rows = spark.read.schema(FILTER_ROWS).option("basePath", root).parquet(*folders)
    newest = rows.groupBy("bucket").agg(F.max("seq").alias("seq"))
    return rows.join(F.broadcast(newest), ["bucket", "seq"], "left_semi").select("bucket", "bits")


def _add_to_filters(fresh: DataFrame, path: str, buckets: Collection[int]) -> list[str]:
    """Filters of the buckets that get new urls, with the bits they had; returns the folders they replace.

    A bucket that has posts and no filter gets one of all its urls. The folders are to be removed once
    nothing reads them any more; until then the newer filter counts.
    """
    spark, root = fresh.sparkSession, f"{path}/filters"
    bare = _folders(spark, f"{path}/posts") & set(buckets) - _folders(spark, root)
    urls = fresh.select("url", "bucket")
    for bucket in sorted(bare):
        urls = urls.unionByName(stored_posts(spark, path, [bucket]).select("url", F.lit(bucket).alias("bucket")))
    added = filters_of(urls)
    old = read_filters(spark, path, buckets).select("bucket", F.col("bits").alias("had"))
    both = F.when(F.col("had").isNull(), F.col("bits")).otherwise(
        F.zip_with("bits", "had", lambda a, b: a.bitwiseOR(b))
    )
    merged = added.join(F.broadcast(old), "bucket", "left").select("bucket", both.alias("bits"))
    names = {b: [int(n) for n in folder_names(spark, f"{root}/bucket={b}", "seq")] for b in buckets}
    seq = 1 + max((n for found in names.values() for n in found), default=0)
    rows = merged.withColumn("seq", F.lit(seq).cast("long")).hint("rebalance", "bucket")
    rows.write.mode("append").partitionBy("bucket", "seq").parquet(root)
    return [
        f"{root}/bucket={bucket}/seq={n}"
        for bucket, old_ones in names.items()
        if old_ones and str(seq) in folder_names(spark, f"{root}/bucket={bucket}", "seq")
        for n in old_ones
    ]


def stored_posts(spark: SparkSession, path: str, buckets: Collection[int] | None = None) -> DataFrame:
    """The stored posts, of some buckets or all; the files of others are not even listed."""
    schema = T.StructType([*POST.fields, T.StructField("bucket", T.IntegerType())])
    root = f"{path}/posts"
    if buckets is None:
        return read_or_empty(spark, root, schema).select(*POST.names)
    folders = sorted(_folders(spark, root) & set(buckets))
    if not folders:
        return spark.createDataFrame([], POST)
    rows = spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/bucket={b}" for b in folders])
    return rows.select(*POST.names)


def _numbers(rows: DataFrame, column: str) -> list[int]:
    """The distinct buckets of a batch, BUCKETS at most."""
    return sorted(r[0] for r in rows.select(column).distinct().collect())


def land_posts(
    batch: DataFrame,
    path: str,
    order: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    buckets: int = BUCKETS,
) -> dict[str, int]:
    """Append the first row of each new url; stored urls are left alone, rows without one skipped.

    Only buckets that may hold one of the batch's urls are read, and of these the url column. The
    urls that may be stored are measured: when they are small the stored ones are filtered against
    them in place, otherwise both sides are shuffled by url.
    """
    spark = batch.sparkSession
    rest = [c for c in POST.names if c != "url"]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("first")
    urls = batch.groupBy("url").agg(first, F.count(F.lit(1)).alias("rows")).persist()
    try:
        total = urls.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()["rows"]
        named = urls.filter(F.length("url") > 0).withColumn("bucket", bucket_of(F.col("url"), buckets))
        touched = _numbers(named, "bucket")
        known = F.broadcast(read_filters(spark, path, touched))
        asked = named.join(known, "bucket", "left").withColumn("maybe", _maybe_stored(F.col("bits"), F.col("url")))
        asked = asked.drop("bits")
        opened = _opened(asked)
        stored = stored_posts(spark, path, [r["bucket"] for r in opened]).select("url")
        if sum(r["bytes"] for r in opened) <= broadcast_bytes:
            stored = stored.join(F.broadcast(asked.filter("maybe").select("url")), "url", "left_semi")
        fresh = asked.join(stored, "url", "left_anti").select("url", "first.*", "bucket")
        inserted = Observation()
        replaced = _add_to_filters(fresh, path, touched) if touched else []
        counted = fresh.hint("rebalance", "bucket").observe(inserted, F.count(F.lit(1)).alias("n"))
        counted.write.mode("append").partitionBy("bucket").parquet(f"{path}/posts")
        new = inserted.get["n"]
        for folder in replaced:
            remove_folder(spark, folder)
    finally:
        urls.unpersist()
    return {"inserted": new, "skipped": total - new}


def _opened(asked: DataFrame) -> list:
    """Buckets in which a url may be stored, with the bytes of such urls."""
    maybe = asked.filter("maybe").groupBy("bucket")
    return maybe.agg(F.sum(F.octet_length("url")).alias("bytes")).collect()


def compact_posts(spark: SparkSession, path: str, most_files: int = 8, buckets: int = BUCKETS) -> list[int]:
    """Rewrite buckets of more than ``most_files`` files as one file each, with new filters; returns them.

    Not to be run next to a landing job. The rows are copied to the work folder first, so a lost
    executor or a failure half way costs no row.
    """
    root = f"{path}/posts"
    files = stored_posts(spark, path).inputFiles()
    per: dict[int, int] = {}
    for f in files:
        bucket = int(f.split("/bucket=")[1].split("/")[0])
        per[bucket] = per.get(bucket, 0) + 1
    many = sorted(b for b, n in per.items() if n > most_files)
    if many:
        copy = scratch(spark, "posts")
        rows = stored_posts(spark, path, many).withColumn("bucket", bucket_of(F.col("url"), buckets))
        rows.write.parquet(copy)
        rows = spark.read.parquet(copy)
        replaced = _add_to_filters(rows, path, many)
        writer = rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("bucket").parquet(root)
        for folder in replaced:
            remove_folder(spark, folder)
    return many
