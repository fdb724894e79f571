"""Small tables with everything that may trip an operator."""

import random

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        *[T.StructField(n, T.StringType()) for n in (
            "kept", "bucket", "spans", "n_words", "runs", "doc", "gram", "id", "key", "blob",
            "content", "half", "piece", "length", "words", "term", "salt", "host", "label_id",
        )],
    ]
)


def documents(spark, rows, source="s"):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else source, None if r[1] is None else len(r[1]),
         *["x"] * (len(DOCUMENTS.fields) - 5))
        for r in rows
    ]
    return spark.createDataFrame(full, DOCUMENTS).repartition(3)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}{'é' if rng.random() < 0.1 else ''}" for _ in range(n)]


def text_of(words, seed=0):
    """Words with all kinds of blanks between them."""
    rng = random.Random(seed)
    return "".join(w + rng.choice([" ", "  ", "\n", "\t ", "\r\n"]) for w in words)


PASSAGE = prose(99, 70)
ODD = [
    (900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "One two three"),
    (905, "é" * 3000), (906, "🙂 漢字 x y \x1c z"), (907, "a " * 400), (908, "a " * 300),
]


def mixed_rows():
    """Passages at starts, ends and inside, nested and shifted; copies; ODD texts."""
    rows = []
    for i in range(12):
        w = prose(i, 60 + 17 * i)
        if i % 3 == 0:
            w[20:20] = PASSAGE
        if i % 4 == 1:
            w = PASSAGE[: 50 + i] + w
        if i % 5 == 2:
            w = w + PASSAGE[70 - 50 - i % 3 :]
        rows.append((i * 7 % 50, text_of(w, i)))
    rows.append((60, rows[3][1]))
    rows.append((61, text_of(words_of(rows[3][1])[:-1] + ["end"])))
    rows.append((62, text_of(PASSAGE[:50])))
    rows.append((63, text_of(PASSAGE[:49])))
    return rows + ODD


def words_of(text):
    return text.split()
