"""Spelling variants: words of the corpus at one edit from a far more common word.

The acceptor of the vocabulary is composed with a transducer of exactly one insertion, deletion or
replacement and with the acceptor again; the pairs the composition accepts are the near words. Before
the edit both sides are in the same state, so the machine falls apart by the prefix read so far: every
prefix is the start of a partition of its own, and a partition is one minimised acceptor of at most
``PARTITION`` words. A prefix with more words is left open: its partition is split by the next symbol,
and the pairs whose edit lies right behind it, which end in different partitions, are those with equal
rests, found by grouping on prefix and rest. Such a group has a word for each symbol at most.

In an acceptor equal continuations are one state. The edit can lie only where words part, and what
the composition accepts from a state by an edit there is worked out once for each state, then written
out for every prefix that leads to it. A pair is found at one place only: where its words part.

Words: maximal runs of Latin letters of at least 6 code points, A-Z lowered; of one run in 199 a
character is lost, by a checksum of document and run. Those seen 5 times or more are the vocabulary.

Defined results: null and empty texts have no words; the checksum of a row without doc_id takes an empty
id; repeated rows count again; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.merkle import lower_ascii
from pulse.llm.stored import stored

SHORTEST = 6
FEWEST = 5
LOST_IN = 199
FORM_TIMES = 5
PARTITION = 4096
DEEPER = 16  # symbols looked at in a round of splitting
SALTS = 16

RUN = rf"[A-Za-zÀ-ÿ]{{{SHORTEST},}}+"


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: the vocabulary."""
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), F.lit(0))
    owner = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("owner")
    each = docs.select(owner, F.explode(runs).alias("run")).select(
        "owner", F.when(F.col("run").rlike("[A-Z]"), lower_ascii(F.col("run"))).otherwise(F.col("run")).alias("run")
    )
    each = each.withColumn("h", F.crc32(F.concat("owner", F.lit(":"), "run").cast("binary")))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), place), F.substr("run", place + 2))
    word = F.when(F.col("h") % LOST_IN == 0, cut).otherwise(F.col("run"))
    counted = each.select(word.alias("word")).filter(F.length("word") >= SHORTEST).groupBy("word").count()
    return counted.filter(F.col("count") >= FEWEST).select("word", F.col("count").alias("n"))


def with_depth(words: DataFrame, limit: int = PARTITION) -> DataFrame:
    """Add ``deep``: the length of the longest prefix of a word with more than ``limit`` words."""
    closed: list[DataFrame] = []
    start, todo = 0, words
    while True:
        upto = F.least(F.length("word"), F.lit(start + DEEPER))
        lengths = F.when(upto > start, F.sequence(F.lit(start + 1), upto)).otherwise(F.array().cast("array<int>"))
        prefixes = todo.select(F.explode(F.transform(lengths, lambda d: F.substr("word", F.lit(1), d))).alias("prefix"))
        hot = stored(prefixes.groupBy("prefix").count().filter(F.col("count") > limit).select("prefix"), "hot-prefixes")
        # a hot prefix has a large part of all words: deal both sides over salts
        salt = F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int").alias("salt")
        copies = hot.select("prefix", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        reach = todo.select("word", "n", salt, F.explode(lengths).alias("d"))
        reach = reach.withColumn("prefix", F.substr("word", F.lit(1), F.col("d")))
        deep = F.coalesce(F.max(F.when(F.col("hit"), F.col("d"))), F.lit(start)).alias("deep")
        found = reach.join(copies.withColumn("hit", F.lit(True)), ["prefix", "salt"], "left")
        found = stored(found.groupBy("word", "n").agg(deep), "depths")
        closed.append(found.filter(F.col("deep") < start + DEEPER))
        start += DEEPER
        todo = found.filter(F.col("deep") == start)
        over = todo.filter(F.length("word") <= start)  # these end with the hot prefix
        closed.append(over)
        todo = todo.filter(F.length("word") > start).select("word", "n")
        if todo.isEmpty():
            break
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    return out


_NEAR = "word string, n_near long, best struct<less:long,near:string>"


def parted_at_open_prefixes(words: DataFrame) -> DataFrame:
    """Near words whose edit lies behind an open prefix: word, n_near, best.

    A word is written once as it is and once without the symbol behind the prefix. Equal rests meet: words
    of different symbols there, and the word that has none.
    """
    at = F.explode(F.sequence(F.lit(0), F.col("deep"))).alias("d")
    rows = words.select("word", "n", F.length("word").alias("len"), at).filter("d <= len")
    head = F.substr("word", F.lit(1), F.col("d"))

    def key(rest: Column) -> Column:
        return F.concat(head, F.lit("*"), rest)

    here = F.substr("word", F.col("d") + 1, F.lit(1))
    following = F.substr("word", F.col("d") + 2, F.lit(1))
    longer = F.struct(
        key(F.substr("word", F.col("d") + 2)).alias("key"),
        # a repeated symbol is lost at the end of its run, where the words part
        F.struct(F.lit(False).alias("lacks"), (here != following).alias("ends"), "n", "word").alias("m"),
    )
    whole = F.struct(
        key(F.substr("word", F.col("d") + 1)).alias("key"),
        F.struct(F.lit(True).alias("lacks"), F.lit(True).alias("ends"), "n", "word").alias("m"),
    )
    sides = F.when(F.col("d") < F.col("len"), F.array(longer, whole)).otherwise(F.array(whole))
    each = rows.select(F.explode(sides).alias("s")).select("s.key", "s.m")
    groups = each.groupBy("key").agg(F.collect_list("m").alias("ms")).filter(F.size("ms") > 1)

    def near(m: Column, o: Column) -> Column:
        return (m["word"] != o["word"]) & F.when(m["lacks"], o["ends"]).when(o["lacks"], m["ends"]).otherwise(True)

    one = groups.select("ms", F.explode("ms").alias("m"))
    others = F.filter("ms", lambda o: near(F.col("m"), o))
    best = F.array_min(F.transform("others", lambda o: F.struct((-o["n"]).alias("less"), o["word"].alias("near"))))
    return (
        one.select(F.col("m.word").alias("word"), others.alias("others"))
        .filter(F.size("others") > 0)
        .select("word", F.size("others").cast("long").alias("n_near"), best.alias("best"))
    )


class Acceptor:
    """Minimal acceptor of sorted words, runs without a branch as one arc.

    ``language`` has the continuations of every state, ``prefixes`` the places (word, length) that lead
    to a state where words part.
    """

    def __init__(self, words: list[str], start: int):
        self.language: list[tuple[str, ...]] = []
        self.arcs: list[tuple[tuple[str, int], ...]] = []
        self.prefixes: dict[int, list[tuple[int, int]]] = {}
        self._known: dict[tuple, int] = {}
        # open nodes on the way to the last word: length, whether a word ends there, arcs
        spine: list[tuple[int, bool, list]] = [(start, len(words[0]) == start, [])]
        if len(words[0]) > start:
            spine.append((len(words[0]), True, []))
        for i, last in enumerate(words):
            word = words[i + 1] if i + 1 < len(words) else None
            top = start if word is None else _shared(last, word, start)
            while spine[-1][0] > top:
                length, state = spine[-1][0], self._closed(spine.pop(), i)
                if spine[-1][0] < top:
                    spine.append((top, False, []))
                spine[-1][2].append((last[spine[-1][0] : length], state))
            if word is not None:
                spine.append((len(word), True, []))
        self._closed(spine[0], len(words) - 1)

    def _closed(self, node: tuple[int, bool, list], word: int) -> int:
        length, final, arcs = node
        state = self._state(final, tuple(arcs))
        if len(arcs) + final > 1:
            self.prefixes.setdefault(state, []).append((word, length))
        return state

    def _state(self, final: bool, arcs: tuple) -> int:
        known = self._known.get((final, arcs))
        if known is None:
            known = self._known[final, arcs] = len(self.arcs)
            rests = [label + rest for label, to in arcs for rest in self.language[to]]
            self.language.append(("", *rests) if final else tuple(rests))
            self.arcs.append(arcs)
        return known

    def edited(self, state: int) -> list[tuple[list[str], str | None]]:
        """What one edit at a state accepts: groups of near continuations, and the one it lengthens."""
        groups: dict[str, list[str]] = {}
        for label, to in self.arcs[state]:
            for rest in self.language[to]:
                tail = label + rest
                groups.setdefault(tail[1:], []).append(tail)
        own = set(self.language[state])
        out = []
        for rest, tails in groups.items():
            short = rest if rest in own else None
            if len(tails) > 1 or (short is not None and any(t[0] != rest[:1] for t in tails)):
                out.append((tails, short))
        return out


def _shared(a: str, b: str, start: int) -> int:
    """Length of the common prefix, known to be ``start`` at least."""
    lo, hi = start, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def near_in(words: list[str], counts: list[int], start: int) -> dict[str, tuple[int, tuple[int, str]]]:
    """Near words among sorted words that share ``start`` symbols, by an edit behind these.

    For a word with any: how many, and the most common one as (-n, word).
    """
    n_of = dict(zip(words, counts, strict=True))
    found: dict[str, tuple[int, tuple[int, str]]] = {}

    def add(word: str, others: list[tuple[int, str]]) -> None:
        """``others`` are sorted and may hold the word itself."""
        count = len(others)
        best = others[0]
        if best[1] == word:
            best = others[1]
        n, least = found.get(word, (0, best))
        found[word] = (n + count, min(least, best))

    acceptor = Acceptor(words, start)
    for state, places in acceptor.prefixes.items():
        accepted = acceptor.edited(state)
        if not accepted:
            continue
        for i, length in places:
            prefix = words[i][:length]
            for tails, short in accepted:
                longer = sorted((-n_of[prefix + t], prefix + t) for t in tails)
                if len(longer) > 1:
                    for _, word in longer:
                        add(word, longer)
                        n, least = found[word]
                        found[word] = (n - 1, least)  # not near itself
                if short is not None:
                    ended = sorted((-n_of[prefix + t], prefix + t) for t in tails if t[0] != short[:1])
                    if ended:
                        own = prefix + short
                        add(own, ended)
                        for _, word in ended:
                            add(word, [(-n_of[own], own)])
    return found


def near_in_partitions(words: DataFrame, partitions: int) -> DataFrame:
    """Near words whose edit lies inside a partition: word, n_near, best."""

    def compose(table: pa.Table) -> pa.Table:
        ordered = table.sort_by("word")
        words_ = ordered.column("word").to_pylist()
        start = ordered.column("deep")[0].as_py() + 1
        found = near_in(words_, ordered.column("n").to_pylist(), start) if len(words_) > 1 else {}
        best = pa.StructArray.from_arrays(
            [pa.array([b[0] for _, b in found.values()], pa.int64()), pa.array([b[1] for _, b in found.values()], pa.string())],
            ["less", "near"],
        )
        counts = pa.array([n for n, _ in found.values()], pa.int64())
        return pa.table({"word": pa.array(list(found), pa.string()), "n_near": counts, "best": best})

    # words that end with the open prefix have no symbol behind it and no edit left
    rows = words.filter(F.length("word") > F.col("deep"))
    part = F.substr("word", F.lit(1), F.col("deep") + 1).alias("part")
    dealt = rows.select("word", "n", "deep", part).repartition(partitions, "part")
    return dealt.groupBy("part").applyInArrow(compose, _NEAR)


def roots(links: DataFrame) -> DataFrame:
    """word, root: the end of each word's chain of forms, by doubling steps.

    Counts grow at least fivefold along a chain, so it is short and has no circle.
    """
    here = stored(links.select("word", F.col("form").alias("root")), "form-chains")
    while True:
        step = here.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = here.join(step, "root", "left")
        moved = stored(
            joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "form-chains",
        )
        here = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return here


def group_variants(docs: DataFrame, partition: int = PARTITION) -> DataFrame:
    """word, n, n_near, form, form_n, root for every word of the vocabulary."""
    words = stored(word_counts(docs), "vocabulary")
    return variants_of(words, partition)


def variants_of(words: DataFrame, partition: int = PARTITION) -> DataFrame:
    """The same, out of a vocabulary ``word, n``."""
    deep = stored(with_depth(words, partition), "vocabulary-depths")
    spark = words.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * words.count() // partition))
    found = near_in_partitions(deep, parts).unionByName(parted_at_open_prefixes(deep))
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    is_form = -F.col("best.less") >= FORM_TIMES * F.col("n")
    listed = stored(
        words.join(near, "word", "left").select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "variants",
    )
    ends = roots(listed.filter(F.col("form").isNotNull()))
    return listed.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
