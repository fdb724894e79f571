"""Words to stems and endings, by a lattice of pieces learnt from the corpus.

The pieces of a language are the parts of words that many different words share. How many distinct words
hold a piece gives its cost, and a word is cut where the costs of its pieces sum to the least. No
dictionary is needed, so the analyzer serves any script that is written with blanks.

Pieces are counted in Spark over distinct words; the model is the ``MOST_PIECES`` that explain most, a
bounded table sent to all tasks. Words are cut in tasks, each distinct word once as long as
it is kept; the pieces of a batch are put together as Arrow columns.

The first piece of a word is its stem, tagged as a noun; a later piece of up to ``ENDING`` characters is an
ending, a longer one the other part of a compound. Numbers are tagged as numbers. Words of more than
``LONGEST`` characters are not cut and tagged as symbols.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.text import distinct_tokens, split_tokens

PIECE = 8
FEWEST_WORDS = 3
MOST_PIECES = 1 << 16
LONGEST = 40
ENDING = 3
#: Cost of a character that is no piece, above that of any piece.
UNKNOWN = 20_000
#: More than any number of pieces of a word.
RANK = 1 << 32
#: Words a task keeps the pieces of, before a batch adds its own.
MOST_KNOWN = 1 << 18
# Tags of nouns, endings, numbers and symbols.
NOUN, SUFFIX, NUMBER, SYMBOL = "NNG", "XSN", "SN", "SW"

MORPHS = "array<struct<form:string,tag:string>>"


def distinct_words(docs: DataFrame, text: str = "cleaned_text") -> DataFrame:
    """The distinct words of all texts in small letters, without numbers: word."""
    own = distinct_tokens(split_tokens(F.lower(F.col(text))))
    words = docs.select(F.explode(own).alias("word"))
    return words.filter(~F.col("word").rlike(r"^[0-9]+$") & (F.length("word") <= LONGEST)).distinct()


def learn_pieces(words: DataFrame, most: int = MOST_PIECES) -> DataFrame:
    """piece, cost: the model, from distinct words. A word counts for every place it holds a piece at."""
    lengths = F.explode(F.sequence(F.lit(1), F.least(F.length("word"), F.lit(PIECE)))).alias("size")
    sized = words.filter(F.length("word") > 0).select("word", lengths)
    places = F.sequence(F.lit(1), F.length("word") - F.col("size") + 1)
    pieces = sized.select(F.explode(F.transform(places, lambda p: F.substr("word", p, F.col("size")))).alias("piece"))
    counted = pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= FEWEST_WORDS)
    best = counted.orderBy((F.col("n") * F.length("piece")).desc(), "piece").limit(most)
    total = best.agg(F.sum("n").alias("total"))
    cost = F.round(1000 * F.log(F.col("total") / F.col("n"))).cast("int").alias("cost")
    return best.join(F.broadcast(total)).select("piece", cost)  # one row


class Lattice:
    """Cuts words at the least cost, then with the fewest pieces, then with the longest last piece."""

    def __init__(self, costs: Mapping[str, int]):
        # cost and number of pieces in one whole number, ordered as the two are
        self.ranks = {piece: cost * RANK + 1 for piece, cost in costs.items()}

    def pieces(self, word: str) -> list[str]:
        rank_of, unknown = self.ranks.get, UNKNOWN * RANK + 1
        best, starts = [0], [0]  # rank of the best cut up to a place, start of its last piece
        for end in range(1, len(word) + 1):
            least, at = best[end - 1] + rank_of(word[end - 1], unknown), end - 1
            for start in range(end - 2, max(-1, end - PIECE - 1), -1):
                rank = rank_of(word[start:end])
                if rank is not None and (rank := rank + best[start]) <= least:
                    least, at = rank, start
            best.append(least)
            starts.append(at)
        out, end = [], len(word)
        while end:
            start = starts[end]
            out.append(word[start:end])
            end = start
        return out[::-1]

    def morphs(self, word: str) -> list[tuple[str, str]]:
        if word.isdigit():
            return [(word, NUMBER)]
        if len(word) > LONGEST:
            return [(word, SYMBOL)]
        cut = self.pieces(word)
        return [(p, NOUN if i == 0 or len(p) > ENDING else SUFFIX) for i, p in enumerate(cut)]


class Known(dict):
    """Word to its number among the words seen; a new word is cut and its pieces are kept behind the others."""

    def __init__(self, lattice: Lattice):
        self.lattice = lattice
        self.forms: list[str] = []
        self.tags: list[str] = []
        self.starts = [0]

    def __missing__(self, word: str) -> int:
        for form, tag in self.lattice.morphs(word):
            self.forms.append(form)
            self.tags.append(tag)
        self.starts.append(len(self.forms))
        number = self[word] = len(self)
        return number

    def of(self, texts: pa.Array) -> pa.Array:
        """The pieces of texts, an array for each."""
        numbers, counts = [], []
        for text in texts.to_pylist():
            words = (text or "").lower().split()
            numbers += map(self.__getitem__, words)
            counts.append(len(words))
        at, starts = np.array(numbers, np.int64), np.array(self.starts, np.int64)
        size = starts[at + 1] - starts[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(starts[at] - ends[:-1], size) + np.arange(ends[-1])
        fields = [pa.array(column, pa.string()).take(pa.array(place)) for column in (self.forms, self.tags)]
        bounds = ends[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(fields, ["form", "tag"]))


def analyzer(model: DataFrame) -> Callable[[Column], Column]:
    """Text to an array of ``form, tag``, for :func:`pulse.operators.docs.tokenize` in mode ``morph``."""
    table = model.toArrow()  # MOST_PIECES rows at most
    costs = dict(zip(table.column("piece").to_pylist(), table.column("cost").to_pylist(), strict=True))
    sent = model.sparkSession.sparkContext.broadcast(costs)

    @F.arrow_udf(MORPHS)
    def analyze(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lattice = Lattice(sent.value)
        known = Known(lattice)
        for texts in batches:
            if len(known) > MOST_KNOWN:
                known = Known(lattice)
            yield known.of(texts)

    return analyze
