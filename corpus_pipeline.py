"""From raw documents to packed sequences, stage by stage.

Every stage takes the documents its predecessor kept and returns their columns; the last returns
packed pieces. A document is known by its doc_id and its text: rows of one id, or without one, that have
different texts are different documents, and each gets the verdict of its own text (and, in the first
stage, host). Equal rows go or stay together. Of near duplicates the smallest doc_id stays; rows without
an id come after all others, and so do further texts under one id. Stages need columns doc_id, text
and source; others pass through, n_chars follows the text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm import decontam, merkle, neardup, packing, quality, secret_scan
from pulse.llm.queries import table, vocabulary
from pulse.llm.stored import stored
from pulse.sources.store import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _free(name: str, docs: DataFrame) -> str:
    """A column name the documents do not use."""
    while name in docs.columns:
        name += "_"
    return name


def _identified(docs: DataFrame, *also: str) -> tuple[DataFrame, str]:
    """Documents with a doc_id of their own for every id, text and further columns.

    Ids that are null or come more than once are the only ones looked at; their documents are
    numbered behind the largest id. Returns the documents and the column with the ids they had.
    """
    given = _free("given_id", docs)
    out = docs.withColumn(given, F.col("doc_id"))
    own = F.col("doc_id").cast("long")
    repeated = docs.groupBy(own.alias("id")).agg(F.count(F.lit(1)).alias("n"))
    repeated = repeated.filter("id is null or n > 1").select("id")
    if repeated.isEmpty():
        return out, given
    key = {"id": own, "digest": decontam.digest_of(F.col("text"))} | {c: F.col(c).cast("string") for c in also}
    keys = docs.select(*[c.alias(n) for n, c in key.items()])
    several = F.broadcast(repeated) if repeated.count() <= MOST_SENT else repeated
    odd = keys.join(several.withColumnRenamed("id", "odd"), F.col("id").eqNullSafe(F.col("odd")), "left_semi").distinct()
    placed = merkle.numbered(odd.withColumn("all", F.lit("")), "all", list(key))
    low, high = docs.agg(F.min(own), F.max(own)).first()
    low, high = low or 0, high or 0
    number = F.lit(high + 1) + F.col("i") if high < 1 << 62 else F.lit(low - 1) - F.col("i")
    names = {n: f"{given}_{n}" for n in key}
    placed = placed.select(*[F.col(n).alias(names[n]) for n in key], number.alias(names["id"] + "_new"))
    same = reduce(and_, [c.eqNullSafe(F.col(names[n])) for n, c in key.items()])
    joined = out.join(placed, same, "left")
    joined = joined.withColumn("doc_id", F.coalesce(F.col(names["id"] + "_new"), own))
    return joined.select(*out.columns), given


#: Ids sent out to find their documents, at most; more are joined by shuffling.
MOST_SENT = 1 << 17


def _keep(docs: DataFrame, given: str, verdicts: DataFrame) -> DataFrame:
    """Identified documents that are kept, with the ids they had."""
    id_ = _free("kept_id", docs)
    kept = verdicts.filter("kept").select(F.col("doc_id").alias(id_)).distinct().hint("shuffle_hash")
    left = docs.join(kept, docs["doc_id"].cast("long") == F.col(id_), "left_semi")
    return left.withColumn("doc_id", F.col(given)).drop(given)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or come from a rejected host."""
    own, given = _identified(docs, "source")
    return _keep(own, given, quality.judge(own).select("doc_id", "kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of every group of near duplicates."""
    own, given = _identified(docs)
    return _keep(own, given, neardup.near_duplicates(own).select("doc_id", "kept"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    id_, digest = _free("bad_id", docs), _free("bad_digest", docs)
    found = decontam.judged(docs, table(spark, sf_dir, "benchmark"))
    bad = found.filter("contaminated").select(F.col("doc_id").alias(id_), F.col("digest").alias(digest))
    same = decontam.digest_of(docs["text"]) == F.col(digest)
    own = same & docs["doc_id"].cast("long").eqNullSafe(F.col(id_))
    return docs.join(bad.distinct().hint("shuffle_hash"), own, "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by a mark."""
    versions = secret_scan.versions_of(docs)
    ledger = secret_scan.update_ledger(versions, scratch(spark, "secret-ledger"))
    blob, spans = _free("found_blob", docs), _free("found_spans", docs)
    found = secret_scan.blob_findings(ledger).select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = docs.join(found.hint("shuffle_hash"), F.sha2(text, 256) == F.col(blob), "left")
    hit = F.col(spans).isNotNull()
    clean = F.when(hit, secret_scan.redacted(F.col("text"), F.col(spans))).otherwise(F.col("text"))
    out = joined.withColumn("text", clean)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(hit, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", counted)
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of at most 4096 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret redaction", redact_secrets),
    ("best-fit packing", pack),
]

# Token ids are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
