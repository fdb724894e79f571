import random
import re

from pyspark.sql import functions as F

from pulse.functions import text as t

X = F.col("x")
NONE = F.lit(None).cast("string")


def model_stream(title, body, words, cap):
    """The window jobs' word rule in plain Python."""
    raw = f"{title or ''} {body or ''}"
    raw = re.sub(r"(https?://\S+|www\.\S+)", " ", raw, flags=re.I)
    raw = re.sub(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", " ", raw)
    out = []
    for w in re.sub(r"[^\w\s]", " ", raw.lower()).split():
        bad = re.fullmatch(r"\d+", w) or re.fullmatch("[ㅋㅎㅠㅜ]+", w) or w in words
        if 2 <= len(w) <= 20 and not bad:
            out.append(w)
    return out[:cap]


def model_batch(text, words):
    out = []
    for w in text.split():
        w = w.strip().lower()
        if not 2 <= len(w) <= 20 or re.fullmatch(r"\d+", w) or re.fullmatch("[ㅋㅎㅠㅜ]+", w):
            continue
        if re.search("[0-9A-Za-z가-힣]", w) and w not in words:
            out.append(w)
    return out


CASES = [
    "a ab " + "x" * 20 + " " + "y" * 21,
    "123 a1 1a ١٢٣ ²",
    "ㅋㅋㅋ ㅠㅠ ㅋㅋa 안녕ㅋㅋ",
    "snake_case _ __ a_",
    "tab\tnew\nline nbsp　wide\x1cfs",
    "UPPER Case ÉTÉ İstanbul ΟΔΟΣ",
    "write me@example.com now 한me@example.com",
    "see HTTPS://Example.com/a?b=c and www.foo.bar/x end http://x",
    "http:// www. httpx://no https",
    "emoji 😀😀 text😀text",
    "#hash #태그 don't 'quoted'",
    "",
    "   ",
    "rep rep rep 오늘 오늘은",
]


def test_stream_words_follow_the_rule(column):
    want = [model_stream(None, c, {"오늘", "rep"}, 300) for c in CASES]
    assert column(CASES, t.tokens_stream(NONE, X, ["오늘", "rep"])) == want


def test_stream_words_on_random_text(column):
    rng = random.Random(7)
    alphabet = "aB1_ .@:/wht?ps \n가ㅋéß९-"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(600)]
    want = [model_stream(None, c, set(), 300) for c in texts]
    assert column(texts, t.tokens_stream(NONE, X)) == want


def test_title_and_body_are_joined_and_null_is_empty(spark):
    df = spark.createDataFrame(
        [("one", "two"), (None, "two"), ("one", None), (None, None)], "a string, b string"
    )
    got = [r[0] for r in df.select(t.tokens_stream(F.col("a"), F.col("b"))).collect()]
    assert got == [["one", "two"], ["two"], ["one"], []]


def test_cap_comes_after_filtering_and_before_distinct(column):
    text = " ".join(["no"] + ["same"] * 299 + [f"w{i}" for i in range(5)])
    tokens = t.tokens_stream(NONE, X, ["no"], cap=300)
    assert column([text], F.size(tokens)) == [300]
    assert column([text], t.distinct_tokens(tokens)) == [["same", "w0"]]
    assert column([text], F.size(t.tokens_stream(NONE, X, cap=None))) == [305]


def test_batch_words_follow_the_rule(column):
    texts = ["a ab abc 12 a1 ㅋㅋ 안녕 THE the " + "z" * 20 + " " + "z" * 21, "", "\\ \\a --"]
    want = [model_batch(x, {"the"}) for x in texts]
    assert column(texts, t.tokens_batch(X, ["the"])) == want
    assert column(texts, t.filter_tokens(t.split_tokens(X), ["the"])) == want


def test_filter_tokens_on_random_text(column):
    rng = random.Random(8)
    texts = ["".join(rng.choices("aB1_ .- \n가ㅋé९ ", k=rng.randint(0, 50))) for _ in range(400)]
    want = [model_batch(x, {"ab"}) for x in texts]
    assert column(texts, t.filter_tokens(t.split_tokens(X), ["ab"])) == want


def test_null_text_has_no_batch_words(column):
    assert column([None], t.tokens_batch(X)) == [[]]


def test_cleaning_as_intended(column):
    text = "Hi, 세계!  http://a.b/c?d=e  x\ty_z   ㅋㅋ é"
    assert column([text, "!!!", "https://only.link"], t.clean_text(NONE, X)) == [
        "Hi 세계 x y z", "", ""
    ]
    assert column([text, "!!!", "https://only.link"], t.has_words(NONE, X)) == [True, False, False]


def test_stopwords_of_either_side_do_not_change_order(column):
    assert column([["b", "a", "b", "c"]], t.remove_stopwords(X, ["a"]), "array<string>") == [
        ["b", "b", "c"]
    ]
    assert column([["b", "a", "b"]], t.distinct_tokens(X), "array<string>") == [["b", "a"]]


def test_strip_covers_all_whitespace(column):
    chars = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert column(["".join(chars) + "a b" + "".join(chars)], t.strip(X)) == ["a b"]


def test_every_kind_of_whitespace_splits(column):
    every = [chr(c) for c in range(1, 0x3100) if chr(c) != "x"]
    got = column([f"x{c}x" for c in every], F.size(t.split_tokens(X)), "string")
    white = re.compile(r"[\s\x1c-\x1f\x85\xa0  -     　]")
    assert [n == 2 for n in got] == [bool(white.fullmatch(c)) for c in every]
    assert column(["", " 　", None], t.split_tokens(X)) == [[], [], None]


def test_texts_are_split_without_a_regex_pass(spark):
    plan = spark.createDataFrame([("a b",)], "x string").select(t.split_tokens(X))
    assert "p{Z}" not in plan._jdf.queryExecution().optimizedPlan().toString()
