"""Connected components of a table of links, and reductions of large tables by known ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.stored import stored

SLOTS = 1 << 22


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) but the roots; a root is the smallest node.

    Every round each node's neighbours are linked to its smallest neighbour, first the larger
    neighbours, then the smaller ones; the links become stars within a logarithm of the longest
    path. Rounds are written to the shared folder, which also cuts the lineage.
    """
    edges = stored(_directed(links.select("a", "b")), "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        far = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        far = stored(_directed(far), "links")
        least = far.groupBy("a").agg(F.min("b").alias("m"))
        near = far.join(least, "a").select(F.col("b").alias("x"), F.col("m").alias("b"))
        near = near.withColumnRenamed("x", "a").unionByName(least.withColumnRenamed("m", "b"))
        edges = stored(_directed(near), "links")
        if (now := _state(edges)) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def _directed(links: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller node."""
    return (
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def only(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose id may be among the ids, before any shuffle; some others pass as well.

    Follow up with a join.
    """
    return passing(df, column, slots_of(ids))


def slots_of(ids: DataFrame) -> Broadcast:
    """The ids as SLOTS bits, a fixed size whatever their number."""
    bits = np.zeros(SLOTS, bool)
    bits[ids.select(_slot(ids.columns[0])).distinct().toArrow().column(0).to_numpy()] = True
    return ids.sparkSession.sparkContext.broadcast(np.packbits(bits))


def _slot(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SLOTS)).cast("int").alias("_slot")


def passing(df: DataFrame, column: str, slots: Broadcast, wanted: bool = True,
            then=lambda batches: batches, schema=None) -> DataFrame:
    """Rows whose id may be among the ids, or those whose id certainly is not.

    ``then`` goes on with the batches in the same step, to rows of ``schema``.
    """

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(slots.value).astype(bool)
        for batch in batches:
            keep = bits[batch.column(batch.num_columns - 1).to_numpy()] == wanted
            if keep.any():
                yield batch.filter(pa.array(keep)).drop_columns(["_slot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from then(kept(batches))

    return df.select("*", _slot(column)).mapInArrow(run, schema or df.schema)
