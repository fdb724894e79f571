"""Text to words, as column expressions only.

Two word rules exist side by side: the window jobs keep every script and the
underscore, the daily job keeps ASCII letters, digits and Hangul syllables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as whitespace, as pure laughing or crying, as a kept character, as a link,
# as a url or an e-mail address in a post.
WHITESPACE = r"\s\x1c-\x1f\x85\p{Z}"
LAUGH_CRY = "ㅋㅎㅠㅜ"
# ASCII letters and digits, Hangul syllables. Java runs the named class much faster than ranges.
KEPT = r"\p{Alnum}가-힣"
LINK = r"https?://\S+"
URL = rf"(?i)(https?://[^{WHITESPACE}]+|www\.[^{WHITESPACE}]+)"
EMAIL = r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Words dropped by the window jobs when no list is configured.
DEFAULT_STOPWORDS = (
    "그리고",
    "그러나",
    "하지만",
    "오늘",
    "진짜",
    "근데",
    "그냥",
    "정말",
    "너무",
    "이번",
    "저는",
    "제가",
    "에서",
    "으로",
    "하다",
    "있는",
    "없는",
)

MIN_LEN, MAX_LEN = 2, 20


def strip(c: Column) -> Column:
    """Trim every kind of whitespace, not only blanks."""
    return F.btrim(c, F.lit(STRIP_CHARS))


def joined_text(title: Column, body: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(body, F.lit("")))


def remove_stopwords(tokens: Column, words: Sequence[str]) -> Column:
    """Drop listed words. A literal list becomes a hash lookup, not a scan per word."""
    if not words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(list(words)))


def cap_tokens(tokens: Column, n: int) -> Column:
    return F.slice(tokens, 1, n)


def distinct_tokens(tokens: Column) -> Column:
    return F.array_distinct(tokens)


def without_links(text: Column) -> Column:
    """Blank out links where there is "://" or "www." at all, then e-mail addresses where there is an @."""
    linked = text.contains("://") | F.lower(text).contains("www.")
    no_url = F.when(linked, F.regexp_replace(text, URL, " ")).otherwise(text)
    return F.when(text.contains("@"), F.regexp_replace(no_url, EMAIL, " ")).otherwise(no_url)


def tokens_stream(
    title: Column,
    body: Column,
    words: Sequence[str] = (),
    cap: int | None = None,
    min_len: int = MIN_LEN,
    max_len: int = MAX_LEN,
) -> Column:
    """Words of a post for the window jobs.

    One regex pass picks runs of letters, digits and underscore whose whole run has a
    valid length and is neither a number nor only laughing; order and repeats stay. With a cap
    only the first words count, a setting for jobs that want it.
    """
    inside = r"[a-z\p{L}\p{N}_]"  # a to z are letters too, but the range is tried first and is fast
    pattern = (
        rf"(?<!{inside})"
        rf"(?!\p{{Nd}}+(?!{inside}))"
        rf"(?![{LAUGH_CRY}]+(?!{inside}))"
        rf"{inside}{{{min_len},{max_len}}}+(?!{inside})"
    )
    text = F.lower(without_links(joined_text(title, body)))
    tokens = remove_stopwords(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), words)
    return tokens if cap is None else cap_tokens(tokens, cap)


def clean_text(title: Column, body: Column) -> Column:
    """Title and body without links, as one line of ASCII letters, digits and Hangul syllables."""
    text = F.regexp_replace(joined_text(title, body), LINK, " ")
    return F.trim(F.regexp_replace(text, rf"[^{KEPT}]+", " "))


def has_words(title: Column, body: Column) -> Column:
    """Whether :func:`clean_text` is not empty, without building it: stops at the first hit."""
    return F.regexp_replace(joined_text(title, body), LINK, " ").rlike(f"[{KEPT}]")


def split_tokens(text: Column) -> Column:
    """Split on runs of whitespace; blank text gives no tokens.

    Every kind of whitespace is made a blank first: a split at blanks takes no regex pass.
    """
    blanked = F.translate(text, STRIP_CHARS, " " * len(STRIP_CHARS))
    return F.filter(F.split(blanked, " "), lambda t: t != "")


def filter_tokens(
    tokens: Column,
    words: Sequence[str] = (),
    min_len: int = MIN_LEN,
    max_len: int = MAX_LEN,
) -> Column:
    """Normalise ready-made tokens and keep the useful ones.

    A token must hold a kept character, which also rules out pure laughing.
    """
    useful = rf"(?s)\A(?!\p{{Nd}}+\z).*[{KEPT}]"
    tidy = F.transform(tokens, lambda t: F.lower(strip(t)))
    kept = F.filter(
        tidy, lambda t: F.length(t).between(min_len, max_len) & t.rlike(useful)
    )
    return remove_stopwords(kept, words)


def tokens_batch(
    cleaned: Column,
    words: Sequence[str] = (),
    min_len: int = MIN_LEN,
    max_len: int = MAX_LEN,
) -> Column:
    """``filter_tokens(split_tokens(cleaned))`` for cleaned text, in one regex pass."""
    pattern = (
        rf"(?<!\S)(?!\p{{Nd}}+(?!\S))(?=\S*[{KEPT}])\S{{{min_len},{max_len}}}+(?!\S)"
    )
    found = F.regexp_extract_all(F.lower(cleaned), F.lit(pattern), F.lit(0))
    return remove_stopwords(F.coalesce(found, F.array().cast("array<string>")), words)
