"""Near duplicates by an inverted join over MinHash signature coordinates.

A document's set holds its 5-word shingles; two documents are linked when the sets' Jaccard
similarity is 0.75 or more.

1. Equal sets are one class, known by a 128-bit digest; only its smallest document goes on.
2. Every class is posted under each (coordinate, value) of its signature of K values. Values that
   only one class has are counted but not kept.
3. Linked classes agree on about three quarters of the coordinates. A pair is a candidate if it
   agrees on T of K (a linked pair misses that with a chance below 1e-6). Such a pair must share
   one of the K - T + 1 rarest coordinates of each class, so only those are posted: frequent values
   are skipped as long as a class has enough rare ones.
4. Shingles that no other posted class has cannot be shared. What is left of each set bounds the
   similarity of every pair from above, so classes with many edits of their own need no test.
5. Collisions are counted for pairs under a common posting, and candidates are confirmed on full sets.
   Big lists never give all pairs: first every class meets only the most central class of each of
   its lists, the one with the smallest share of shingles of its own, and of these the one it
   agrees with most. A component and the classes whose centre lies in it are a family; those not
   linked are compared with the rest of it on full sets, block by block, and only links come out. Lists that
   still hold several components and families are then compared block by block, first each class
   with the best match in every other component, then, after merging again, whatever candidates
   are left. Pairs inside a component need no test, so no link between components is lost.
6. Components of the confirmed links give the groups.

Defined results: null and empty texts have an empty set and are linked with nothing; a null doc_id has
no component and is kept; rows that repeat a doc_id are that document given again; an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.graph import components, only
from pulse.llm.stored import stored
from pulse.llm.words import Words, mixed, whole_windows, window_hashes, word_slices

SHINGLE = 5
PERCENT = 75
K = 48
T = 20
BLOCK = 1024
FAMILY_BLOCK = 256

SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, signature array<int>"


def _coordinates() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(7))
    a = rng.integers(0, 1 << 63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, K, dtype=np.uint64)


_A, _B = _coordinates()


def shingle_sets(w: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted, and where each text's set begins.

    A text of fewer words has one shingle, all of them in order.
    """
    h, counts = w.hashes(), w.counts()
    at = whole_windows(w.offsets, size)
    text = np.searchsorted(w.offsets, at, "right") - 1
    values = window_hashes(h, size)[at] if len(at) else np.empty(0, np.uint64)
    for k in range(1, size):  # whole short texts, told apart by their length
        short = np.flatnonzero(counts == k)
        if len(short):
            own = mixed(window_hashes(h, k)[w.offsets[short]] ^ np.uint64(k))
            text, values = np.concatenate([text, short]), np.concatenate([values, own])
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return values[new], np.searchsorted(text[new], np.arange(len(counts) + 1))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in word_slices(batch.column(1), lower=True):
            values, at = shingle_sets(w)
            n, some = np.diff(at), np.diff(at) > 0
            first = at[:-1][some]
            signature = np.zeros((len(n), K), np.int32)
            digests = np.zeros((2, len(n)), np.int64)
            if len(values):
                for k in range(K):
                    least = np.minimum.reduceat(values * _A[k] + _B[k], first)
                    signature[some, k] = (mixed(least) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
                for i, twist in enumerate((0, 0x5851F42D4C957F2D)):
                    sums = np.add.reduceat(mixed(values ^ np.uint64(twist)), first)
                    digests[i, some] = sums.view(np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(n) + 1) * K, pa.int32()), pa.array(signature.reshape(-1))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(w.rows.start, len(n)), pa.array(n, pa.int64()),
                 pa.array(digests[0]), pa.array(digests[1]), lists],
                ["doc_id", "n_shingles", "d1", "d2", "signature"],
            )


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def sign(docs: DataFrame) -> DataFrame:
    """Set size, digest and signature of every row."""
    return _rows(docs).mapInArrow(_sign, SIGNED)


def shared_postings(classes: DataFrame) -> DataFrame:
    """(key, id) under the K - T + 1 rarest coordinates of every class, where others share the value."""
    posted = classes.select("id", F.posexplode("signature").alias("k", "v")).select(
        "id", (F.shiftleft(F.col("k").cast("long"), 32) + F.col("v").cast("long") + F.lit(1 << 31)).alias("key")
    )
    counts = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    common = posted.join(counts.hint("shuffle_hash"), "key")
    mine = common.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("keys"))
    # values of one class alone are the rarest: they use up places and meet nobody
    places = F.size("keys") - (T - 1)
    rare = mine.filter(places > 0).select("id", F.explode(F.slice("keys", 1, F.greatest(places, F.lit(1)))).alias("p"))
    return rare.select("p.key", "id")


def texts_to_sets(postings: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, shingles) of the posted classes; only texts that take part are shuffled."""
    ids = postings.select("id").distinct()
    rows = _rows(docs).withColumnRenamed("doc_id", "id")
    texts = only(rows, "id", ids).join(ids.hint("shuffle_hash"), "id", "left_semi").dropDuplicates(["id"])
    return texts.mapInArrow(_sets, "id long, shingles array<long>")


def shareable(sets: DataFrame) -> DataFrame:
    """(id, size, shared): how many shingles of a class some other posted class has as well."""
    alone = (
        sets.select("id", F.explode("shingles").alias("s"))
        .groupBy("s")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
        .filter("n = 1")
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("own"))
    )
    size = F.size("shingles").cast("long")
    own = F.coalesce("own", F.lit(0))
    return sets.join(alone, "id", "left").select("id", size.alias("size"), (size - own).alias("shared"))


def agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that may be similar enough, with the number of coordinates they agree on."""
    left = classes.select(*[F.col(c).alias(f"{c}_a") for c in classes.columns])
    right = classes.select(*[F.col(c).alias(f"{c}_b") for c in classes.columns])
    equal: Column = F.filter(F.zip_with("signature_a", "signature_b", lambda x, y: x == y), lambda e: e)
    most = F.least("shared_a", "shared_b")
    return (
        pairs.join(left, F.col("a") == F.col("id_a"))
        .join(right, F.col("b") == F.col("id_b"))
        .filter(100 * most >= PERCENT * (F.col("size_a") + F.col("size_b") - most))
        .select("a", "b", F.size(equal).alias("agree"))
        .filter(f"agree >= {T}")
    )


def hub_pairs(postings: DataFrame, classes: DataFrame) -> DataFrame:
    """Each class with one candidate: of the most central classes of its lists, the most agreeing one."""
    central = classes.select("id", (F.col("shared") / F.col("size")).alias("central"))
    hubs = (
        postings.join(central, "id")
        .groupBy("key")
        .agg(F.max_by("id", F.struct("central", -F.col("id"))).alias("a"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    met = postings.join(hubs.hint("shuffle_hash"), "key").filter("a <> id").select("a", F.col("id").alias("b")).distinct()
    best = F.max_by("a", F.struct("agree", -F.col("a")))
    return agreeing(met, classes).groupBy("b").agg(best.alias("a")).select("a", "b")


def _compare(best_only: bool):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        i, j = (key[n].as_py() for n in (1, 2))
        ids, comps, block, size, shared, family = (
            table.column(n).to_numpy() for n in ("id", "comp", "block", "size", "shared", "family")
        )
        signature = np.array(table.column("signature").combine_chunks().flatten()).reshape(-1, K)
        x, y = np.flatnonzero(block == i), np.flatnonzero(block == j)
        agree = np.zeros((len(x), len(y)), np.uint8)
        for k in range(K):
            agree += signature[x, k][:, None] == signature[y, k][None, :]
        most = np.minimum(shared[x][:, None], shared[y][None, :])
        near = 100 * most >= PERCENT * (size[x][:, None] + size[y][None, :] - most)
        open_ = (agree >= T) & near & (comps[x][:, None] != comps[y][None, :])
        open_ &= family[x][:, None] != family[y][None, :]
        if i == j:
            open_ &= ids[x][:, None] < ids[y][None, :]
        a, b = np.nonzero(open_)
        if best_only and len(a):
            keep = np.zeros(len(a), bool)
            for own, other in ((x[a], y[b]), (y[b], x[a])):
                order = np.lexsort((ids[other], -agree[a, b].astype(int), comps[other], ids[own]))
                o, c = ids[own][order], comps[other][order]
                first = np.ones(len(order), bool)
                first[1:] = (o[1:] != o[:-1]) | (c[1:] != c[:-1])
                keep[order[first]] = True
            a, b = a[keep], b[keep]
        left, right = ids[x[a]], ids[y[b]]
        return pa.table({"a": np.minimum(left, right), "b": np.maximum(left, right)})

    return run


def open_pairs(postings: DataFrame, classes: DataFrame, roots: DataFrame, best_only: bool) -> DataFrame:
    """Candidate pairs between different components and families, from lists that hold several.

    Lists are compared in blocks of about BLOCK classes against each other, so no task sees a list
    whole. Only pairs that agree on T coordinates and may be similar enough come out.
    """
    named = postings.join(roots.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", F.coalesce("root", "id").alias("comp")
    )
    mixed_lists = (
        named.groupBy("key")
        .agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.count(F.lit(1)).alias("n"))
        .filter("c1 <> c2")
        .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    rows = named.join(mixed_lists.hint("shuffle_hash"), "key").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.withColumn("other", other).select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "comp"
    )
    signed = dealt.join(classes, "id")
    return signed.groupBy("key", "i", "j").applyInArrow(_compare(best_only), "a long, b long").distinct()


def _family_links(key: tuple, table: pa.Table) -> pa.Table:
    """Links of two blocks of a family, reduced to one for each class and component found."""
    i, j = (key[n].as_py() for n in (1, 2))
    ids, block, linked = (table.column(n).to_numpy(zero_copy_only=False) for n in ("id", "block", "linked"))
    x, y = np.flatnonzero(block == i), np.flatnonzero(block == j)
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    if linked.all():
        return none
    sets = table.column("shingles").combine_chunks()
    sizes = np.diff(sets.offsets.to_numpy())
    values, at = np.unique(sets.flatten().to_numpy(), return_inverse=True)
    often = np.bincount(at) > 1  # a shingle of one class adds to no intersection
    place = np.cumsum(often) - 1
    row = np.repeat(np.arange(len(ids)), sizes)
    keep = often[at]
    width = -(-int(often.sum()) // 64) or 1
    bits = np.zeros((len(ids), width * 64), bool)
    bits[row[keep], place[at[keep]]] = True
    bits = np.packbits(bits, axis=1).view(np.uint64)
    near = np.zeros((len(ids), len(ids)), bool)
    for a in x:
        other = y if not linked[a] else y[~linked[y]]
        both = np.bitwise_count(bits[a] & bits[other]).sum(axis=1, dtype=np.int64)
        near[a, other] = 100 * both >= PERCENT * (sizes[a] + sizes[other] - both)
    near |= near.T
    label = np.arange(len(ids))
    while True:  # the smallest row reachable
        least = np.where(near, label[None, :], len(ids)).min(axis=1)
        new = np.minimum(label, least)
        if (new == label).all():
            break
        label = new
    member = np.flatnonzero(label != np.arange(len(ids)))
    left, right = ids[member], ids[label[member]]
    other = left != right
    left, right = left[other], right[other]
    return pa.table({"a": np.minimum(left, right), "b": np.maximum(left, right)})


def families_of(ids: DataFrame, confirmed: DataFrame, roots: DataFrame) -> DataFrame:
    """(id, family, linked): the component of each class's centre, and whether it is its own."""
    own = roots.select(F.col("node").alias("id"), F.col("root").alias("own"))
    centre = roots.select(F.col("node").alias("a"), F.col("root").alias("far"))
    of_centre = confirmed.join(centre, "a", "left").select(
        F.col("b").alias("id"), F.coalesce("far", "a").alias("family")
    )
    root = F.coalesce("own", "id")
    return (
        ids.join(own, "id", "left")
        .join(of_centre, "id", "left")
        .select("id", F.coalesce("family", root).alias("family"), root.alias("root"))
        .select("id", "family", (F.col("family") == F.col("root")).alias("linked"))
    )


def family_links(families: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) within families of which some classes are not linked.

    Only links come out, in a number that follows the number of classes.
    """
    members = families.withColumnRenamed("family", "hub")
    torn = members.filter("not linked").select("hub").distinct()
    members = members.join(torn.hint("shuffle_hash"), "hub", "left_semi")
    blocks = members.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / FAMILY_BLOCK).cast("int").alias("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        members.join(blocks.hint("shuffle_hash"), "hub")
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", other)
        .select("hub", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                "block", "id", "linked")
    )
    full = dealt.join(only(sets, "id", members.select("id")), "id")
    return full.groupBy("hub", "i", "j").applyInArrow(_family_links, "a long, b long")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in word_slices(batch.column(1), lower=True):
            values, at = shingle_sets(w)
            sets = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(w.rows.start, len(at) - 1), sets], ["id", "shingles"]
            )


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = x.values.to_numpy(), y.values.to_numpy()
            both = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).append_column("linked", pa.array(linked))


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked): whether the full sets of the pair are similar enough."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    named = only(sets, "id", ids)
    left = pairs.join(named.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    both = left.join(named.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    return both.select("a", "b", "sa", "sb").mapInArrow(_confirm, "a long, b long, linked boolean")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Every row with its set size, the smallest doc_id of its group and whether it is that one."""
    signed = stored(sign(docs), "signatures")
    owned = signed.filter("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "d1", "d2"]
    firsts = owned.groupBy(*same).agg(F.min("doc_id").alias("id"))
    member = stored(owned.select("doc_id", *same).distinct().join(firsts, same).select("doc_id", "id"), "classes")
    first = member.filter("doc_id = id").select("id").distinct()
    classes = stored(
        signed.join(first.hint("shuffle_hash"), signed["doc_id"] == first["id"])
        .select("id", "signature").dropDuplicates(["id"]), "class-signatures",
    )
    postings = stored(shared_postings(classes), "postings")
    sets = stored(texts_to_sets(postings, docs), "shingle-sets")
    classes = stored(shareable(sets).join(classes, "id"), "posted-classes")

    pairs = stored(hub_pairs(postings, classes), "pairs")  # a is the centre
    tested = stored(confirm(pairs, sets), "confirmed")
    links = tested.filter("linked").select("a", "b")
    families = stored(families_of(classes.select("id"), tested, components(links)), "families")
    classes = stored(classes.join(families.select("id", "family"), "id"), "family-classes")
    links = stored(links.unionByName(family_links(families, sets)), "family-links")
    roots = components(links)
    for best_only in (True, False):
        pairs = open_pairs(postings, classes, roots, best_only)
        pairs = stored(pairs.join(_ordered(tested), ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            continue
        done = stored(confirm(pairs, sets), "confirmed")
        tested = tested.select("a", "b", "linked").unionByName(done)
        links = links.unionByName(done.filter("linked").select("a", "b"))
        roots = components(links)
    found = member.join(roots, member["id"] == roots["node"], "left").select(
        "doc_id", F.coalesce("root", "id").alias("component_id")
    )
    found = found.withColumnRenamed("doc_id", "member_id")
    component = F.coalesce("component_id", "doc_id")
    return (
        signed.select("doc_id", "n_shingles")
        .join(found, signed["doc_id"] == found["member_id"], "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )
