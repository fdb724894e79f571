"""Merkle manifest of a dataset: a leaf per row, a tree per language, one root over the languages.

H is the SHA-256 of the joined inputs in lowercase hex. A leaf is H of doc_id, source, lang, n_chars and
text, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value. In a language leaves ascend by
doc_id, and every 8 consecutive nodes become their H until one, the subroot, remains. The subroots,
ordered by language, give the root in the same way.

A level of a block of 512 aligned nodes is one hex string. Parents are hashes of its fixed-width
substrings, and the siblings of a node are the substrings left and right of it in its run of 8. A
block ends in one node; these are numbered, put into blocks and hashed in turn. Proofs go the other
way: the path of a block's last node is that of every node in it, behind the node's own segments.

No block holds more than 512 nodes, whatever the size of its language, and rows are numbered by a
range shuffle and the sums of whole partitions, so no language is one group or one task. Texts
are hashed where they are read. Everything is column expressions.

Defined results: null doc_ids come first; rows of one doc_id are ordered by their leaves, equal rows in
any order; a null language has a tree of its own before all others; an empty table gives no rows. Other
columns are ignored. The ids of null doc_ids have no CRC, so those rows are never tampered with.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.stored import stored

FAN = 8
LEVELS = 3  # of a block
BLOCK = FAN**LEVELS
HEX = 64

SEGMENTS = "array<struct<before:string,after:string>>"


def _part(value: Column) -> Column:
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*[_part(c) for c in (doc_id, source, lang, n_chars, text)]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def group_key(lang: Column) -> Column:
    """Languages as texts that are never null, in their order, null first."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Rows with their place ``i`` in the group, from 0, and its size ``n``.

    Sorted partitions are stored; the counts of each partition's groups, summed over the partitions
    before, give the places. Rows of equal order are split between partitions too.
    """
    keys = [group, *order, "_at"]
    spread = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*keys)
    placed = stored(
        spread.sortWithinPartitions(*keys).drop("_at").withColumn("_row", F.monotonically_increasing_id()),
        "merkle-order",
    )
    placed = placed.withColumn("_part", F.shiftright("_row", 33))
    runs = placed.groupBy(group, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        group, "_part", "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(whole).alias("n"),
    )
    at = (F.col("_start") + F.col("_row") - F.col("_first")).alias("i")
    return placed.join(starts, [group, "_part"]).select(*rows.columns, at, "n")


def _parents(level: str) -> Column:
    """H of every run of 8 nodes of a level, as the next level."""
    width = FAN * HEX
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / width).cast("int") - 1)
    each = F.transform(runs, lambda k: F.sha2(F.substr(F.col(level), k * width + 1, F.lit(width)), 256))
    return F.array_join(each, "")


def _blocks(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """g, n, b, nodes, levels l0 to l2 and the block's ``last`` node, out of g, n, i, hash."""
    block = F.shiftright("i", 3 * LEVELS).alias("b")
    node = F.struct((F.col("i") % BLOCK).cast("int").alias("p"), "hash", *payload)
    out = nodes.groupBy("g", "n", block).agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    out = out.withColumn("l0", F.array_join(F.transform("nodes", lambda x: x["hash"]), ""))
    for k in range(LEVELS):  # a level that is already the last one has no parents
        out = out.withColumn(f"l{k + 1}", F.when(F.col("n") > FAN**k, _parents(f"l{k}")))
    last = F.coalesce(*[f"l{k}" for k in range(LEVELS, -1, -1)])
    return out.withColumn("last", last).drop(f"l{LEVELS}")


@dataclass
class Tree:
    """Blocks of every round, from the leaves up, and the last node of every group."""

    rounds: list[DataFrame]
    roots: DataFrame  # g, root


def build(nodes: DataFrame, payload: list[str]) -> Tree:
    """The trees of all groups of ``g, n, i, hash``; every round has a 512th of the nodes before."""
    rounds: list[DataFrame] = []
    done: list[DataFrame] = []
    while True:
        blocks = stored(_blocks(nodes, payload), "merkle-blocks")
        rounds.append(blocks)
        done.append(blocks.filter(F.col("n") <= BLOCK).select("g", F.col("last").alias("root")))
        most = blocks.agg(F.max("n")).first()[0]
        if most is None or most <= BLOCK:
            break
        rest = F.ceil(F.col("n") / BLOCK).alias("n")
        nodes = blocks.filter(F.col("n") > BLOCK).select("g", rest, F.col("b").alias("i"), F.col("last").alias("hash"))
        payload = []
    roots = done[0]
    for more in done[1:]:
        roots = roots.unionByName(more)
    return Tree(rounds, roots)


def _segment(level: str, place: Column) -> Column:
    """The siblings of a node: what stands before and after it in its run."""
    inside = place % FAN
    first = place - inside
    before = F.substr(F.col(level), first * HEX + 1, inside * HEX)
    after = F.substr(F.col(level), (place + 1) * HEX + 1, (FAN - 1 - inside) * HEX)
    return F.struct(before.alias("before"), after.alias("after"))


def _own_path(place: Column) -> Column:
    """Sibling segments of a node up to the last node of its block."""
    parts = [
        F.when(F.col("n") > FAN**k, _segment(f"l{k}", F.shiftright(place, 3 * k))) for k in range(LEVELS)
    ]
    return F.filter(F.array(*parts), lambda s: s.isNotNull())


def paths(tree: Tree, tops: DataFrame, carried: list[str]) -> DataFrame:
    """Every node of the first round with ``path``, its sibling segments up to the end of ``tops``.

    ``tops`` has for every group ``g`` the path from its last node on, and columns to carry down.
    """
    upper = None
    for r in range(len(tree.rounds) - 1, -1, -1):
        blocks = tree.rounds[r]
        ends = blocks.filter(F.col("n") <= BLOCK).select("g", "b").join(tops, "g")
        ends = ends.select("g", "b", "path", *carried)
        above = ends if upper is None else upper.unionByName(ends)
        each = blocks.join(above.withColumnRenamed("path", "up"), ["g", "b"])
        each = each.select("g", "n", "b", "l0", "l1", "l2", "up", *carried, F.explode("nodes").alias("x"))
        whole = F.concat(_own_path(F.col("x.p")), F.col("up")).alias("path")
        if r == 0:
            return each.select("g", "x.*", whole, *carried)
        index = (F.col("b") * BLOCK + F.col("x.p")).alias("b")
        upper = each.select("g", index, whole, *carried)
    raise AssertionError("a tree has a round")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to along its path."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, language key, leaf, and the leaf of the row as tampered with where it is."""
    named = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(hit, leaf_of(*named, lower_ascii(F.col("text").cast("string"))))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        group_key(F.col("lang")).alias("g"),
        leaf_of(*named, F.col("text")).alias("hash"),
        tampered.alias("tampered"),
    )


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, path: the proof of every row."""
    rows = numbered(stored(leaves(docs), "merkle-leaves"), "g", ["doc_id", "hash"])
    tree = build(rows, ["doc_id", "tampered"])
    subroots = tree.roots.select(F.lit("").alias("all"), F.col("g").alias("lang"), F.col("root").alias("hash"))
    listed = numbered(subroots, "all", ["lang"]).withColumnRenamed("all", "g")
    top = build(listed, ["lang"])
    whole = top.roots.select("g", F.array().cast(SEGMENTS).alias("path"), "root")
    langs = paths(top, whole, ["root"])
    tops = langs.select(F.col("lang").alias("g"), "path", F.col("hash").alias("subroot"), "root")
    found = paths(tree, tops, ["subroot", "root"])
    return found.withColumnRenamed("hash", "leaf").drop("g", "p")


def verify(proofs: DataFrame) -> DataFrame:
    """Digest of each proof, and whether the row as it is now still leads to the root."""
    segments = F.transform("path", lambda s: F.concat(s["before"], s["after"]))
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return proofs.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.array_join(segments, ""), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
