"""Incremental secret scans over every historical version of a file.

A version's content is a blob, known by its SHA-256. The ledger holds one row per (blob, rule,
rule version) that was ever scanned, with the spans found. A run takes the distinct blobs of the
given versions, scans only the pairs the ledger does not hold yet, appends them, and joins the
findings of all blobs back to every path. Everything is column expressions.

Spans are code points, end exclusive. Matches of a rule are leftmost and do not overlap; those whose
secret is shorter than the rule's minimum are dropped afterwards.

Defined results: null text is empty content; a null path is kept as it is; repeated rows give
repeated results; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.stored import stored
from pulse.sources.store import read_or_empty


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` is the part that must be at least ``least`` characters long.

    ``hint``: every match holds one of these strings; texts without them are not searched.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1
    hint: tuple[str, ...] = ()


# Patterns and lengths of the base kinds, in the order of their listing.
BASE_RULES = (
    Rule(
        "assign",
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
        r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
        hint=(":", "="),
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16, hint=("AKIA",)),
    Rule("hex", r"[0-9a-f]{32,}", least=32),
)
# Added by this scanner: private keys, from the header to the END line. Without one before the next
# dashes, a header goes with the base64 lines that follow: the first has 16 characters at least, and
# of a line that is not all base64 the first word goes too, as it may be the rest of the key. The
# repetitions are bounded as Java recurses into them; 900 lines are ten times an RSA key of 8192 bits.
_BREAK = r"[ \t]*(?:\r?\n|\\r\\n|\\n)[ \t]*"
MORE_RULES = (
    Rule(
        "private",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
        r"(?:[^-]*(?:-{1,4}[^-]+){0,64}-----END [A-Z ]*PRIVATE KEY-----"
        rf"|(?:(?:{_BREAK}(?:Proc-Type|DEK-Info):[^\r\n\\]*){{1,4}}(?:{_BREAK})?)?"
        rf"{_BREAK}[A-Za-z0-9+/=]{{16,}}(?:{_BREAK}[A-Za-z0-9+/=]+){{0,900}})?",
        version=3,
        hint=("PRIVATE KEY",),
    ),
)
RULES = BASE_RULES + MORE_RULES

LEDGER = "blob string, kind string, version int, spans array<struct<start:long,stop:long>>"


def versions_of(docs: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """path, blob, content: one row per version."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(path).alias("path"), content.alias("content")).select(
        "path", F.sha2("content", 256).alias("blob"), "content"
    )


def _pieces(rule: Rule) -> Column:
    """(length up to and including the match, match, secret) for every match in the content.

    A piece runs from the end of the match before to the end of this one. The anchor at the end of
    the last match keeps the search linear after the last one.
    """
    text = F.col("content")
    whole = F.regexp_extract_all(text, F.lit(rf"\G(?s:.*?)(?:{rule.pattern})"), F.lit(0))
    found = F.transform(
        whole,
        lambda p: F.struct(
            F.length(p).cast("long").alias("step"),
            F.length(F.regexp_extract(p, rule.pattern, 0)).cast("long").alias("size"),
            F.length(F.regexp_extract(p, rule.pattern, rule.group)).alias("secret"),
        ),
    )
    if not rule.hint:
        return found
    hinted = F.lit(False)
    for h in rule.hint:
        hinted = hinted | text.contains(h)
    return F.when(hinted, found)


def scan_blobs(pending: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for blobs with their pending kinds: blob, content, kinds."""
    scans = F.array(*[
        F.when(
            F.array_contains("kinds", r.kind),
            F.struct(
                F.lit(r.kind).alias("kind"),
                F.lit(r.version).alias("version"),
                F.lit(r.least).alias("least"),
                F.coalesce(_pieces(r), F.array().cast("array<struct<step:long,size:long,secret:int>>")).alias("pieces"),
            ),
        )
        for r in rules
    ])
    each = pending.select("blob", F.explode(F.filter(scans, lambda s: s.isNotNull())).alias("scan"))
    # lengths alone, written so that the texts are searched once for both ways below
    flat = stored(each.select("blob", "scan.kind", "scan.version", "scan.least", "scan.pieces"), "matches")
    # the end of a match is the sum of the steps up to it: add them up while walking the pieces
    ends = F.aggregate(
        "pieces",
        F.struct(
            F.lit(0).cast("long").alias("at"),
            F.array().cast("array<struct<start:long,stop:long>>").alias("spans"),
        ),
        lambda acc, p: F.struct(
            (acc["at"] + p["step"]).alias("at"),
            F.when(
                p["secret"] >= F.col("least"),
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + p["step"] - p["size"]).alias("start"),
                            (acc["at"] + p["step"]).alias("stop"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    few = flat.filter(F.size("pieces") <= WALKED).select("blob", "kind", "version", ends.alias("spans"))
    return few.unionByName(_many(flat.filter(F.size("pieces") > WALKED)))


#: Appending to an array copies it; blobs with more matches than this are summed as rows instead.
WALKED = 256


def _many(flat: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    rows = flat.select("blob", "kind", "version", "least", F.posexplode("pieces").alias("n", "p"))
    upto = Window.partitionBy("blob", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum("p.step").over(upto)
    placed = rows.select("blob", "kind", "version", "least", "p", stop.alias("stop"))
    span = F.when(
        F.col("p.secret") >= F.col("least"),
        F.struct((F.col("stop") - F.col("p.size")).alias("start"), F.col("stop").alias("stop")),
    )
    return placed.groupBy("blob", "kind", "version").agg(
        F.array_sort(F.collect_list(span)).alias("spans")
    )


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return read_or_empty(spark, ledger, spark.createDataFrame([], LEDGER).schema)


def update_ledger(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger does not hold and append it; returns the ledger.

    Copies of a blob meet only once per map task, as distinct contents are taken before the
    shuffle too.
    """
    spark = versions.sparkSession
    current = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    seen = (
        read_ledger(spark, ledger)
        .groupBy("blob")
        .agg(F.collect_set(F.struct("kind", "version")).alias("seen"))
    )
    blobs = versions.select("blob", "content").dropDuplicates(["blob"])
    todo = F.array_except(current, F.coalesce("seen", F.array().cast("array<struct<kind:string,version:int>>")))
    pending = (
        blobs.join(seen, "blob", "left")
        .select("blob", "content", F.transform(todo, lambda t: t["kind"]).alias("kinds"))
        .filter(F.size("kinds") > 0)
    )
    scan_blobs(pending, rules).write.mode("append").parquet(ledger)
    return read_ledger(spark, ledger)


def blob_findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob and its spans under the current rules, for blobs with any: array of start, rank, stop, kind.

    Spans are ordered by start, then by the order of the rules. A pair may stand in the ledger twice
    after a repeated append; equal spans count once.
    """
    ranks = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (f"{r.kind}:{r.version}", i)])
    rank = ranks[F.concat_ws(":", "kind", "version")]
    return (
        ledger.withColumn("rank", rank)
        .filter(F.col("rank").isNotNull() & (F.size("spans") > 0))
        .select("blob", F.explode("spans").alias("s"), "rank", "kind")
        .groupBy("blob")
        .agg(F.array_sort(F.collect_set(F.struct("s.start", "rank", "s.stop", "kind"))).alias("spans"))
    )


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """path, blob and all spans of its content, for every version."""
    none = F.array().cast("array<struct<start:long,rank:int,stop:long,kind:string>>")
    found = blob_findings(ledger, rules)
    return versions.select("path", "blob").join(found, "blob", "left").select(
        "path", "blob", F.coalesce("spans", none).alias("spans")
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def scan_report(found: DataFrame) -> DataFrame:
    """Counts and digests per path."""
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["rank"] < len(BASE_RULES))
    return found.select(
        F.col("path").alias("doc_id"),
        *[count(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every run of overlapping or touching spans replaced by the mark.

    The text is cut at the kept pieces between spans: from the furthest end so far to the next
    start. A piece of no length between overlapping spans leaves one mark, not two.
    """
    ends = F.transform(
        spans, lambda s, i: F.array_max(F.transform(F.slice(spans, 1, i + 1), lambda t: t["stop"]))
    )
    kept = F.transform(
        spans,
        lambda s, i: F.struct(
            F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(ends, i - 1)).alias("a"),
            s["start"].alias("b"),
        ),
    )
    between = F.filter(kept, lambda k: (k["b"] > k["a"]) | (k["a"] == 0))
    parts = F.transform(between, lambda k: F.substr(text, (k["a"] + 1).cast("int"), (k["b"] - k["a"]).cast("int")))
    tail = F.substr(text, (F.array_max(ends) + 1).cast("int"))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.concat(F.array_join(parts, mark), F.lit(mark), tail)
    )
