"""Title and body out of fetched HTML pages, as column expressions.

A page is cut into tokens by one pattern: comments, scripts with their contents, tags, texts. A rule names an
element; one fold over the rule's own tags keeps the depth and finds where the element begins and
ends, and the texts between are the result. The fold carries four numbers, whatever the page holds.

Defined results: an element that is never closed goes on to the end of its parent, or of the page; a
closing tag without an open one is passed over; scripts, styles and ``noscript`` elements are no text; a null or
empty page has neither title nor body.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.text import strip
from pulse.functions.urls import decode_entities

# Elements whose contents are not text of the page.
HIDDEN = ("script", "style", "noscript")
# Common entities, with or without the semicolon, ampersand last.
ENTITIES = (
    ("&lt;?", "<"),
    ("&gt;?", ">"),
    ("&quot;?", '"'),
    ("&#39;?", "'"),
    ("&nbsp;?", "\xa0"),
    ("&amp;?", "&"),
)

# Inside a tag a quoted value may hold any character. All repetitions are possessive.
_REST = r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+>"""
TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    rf"|<({'|'.join(HIDDEN)})(?=[\s/>]){_REST}.*?(?:</\1\s*+>|\z)"
    rf"|</?[a-z]{_REST}|<[!?][^>]*+>|[^<]++|<"
)
_ATTRIBUTE = r"""[\s/]++[^\s=>/"']++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+"""


@dataclass(frozen=True)
class Rule:
    """An element by tag, optionally an id, class or property, optionally a child tag in it.

    A ``meta`` rule reads the attribute ``content``; any other rule reads the text.
    """

    tag: str
    attr: str | None = None
    value: str | None = None
    inner: str | None = None

    def pattern(self) -> str:
        """What the opening tag looks like."""
        start = rf"(?is)^<{self.tag}(?=[\s/>])"
        if self.attr is None:
            return start
        value = re.escape(self.value)
        if self.attr == "class":  # one of several words
            quoted = "|".join(rf"{q}(?:[^{q}]*\s)?{value}(?:\s[^{q}]*)?{q}" for q in "\"'")
        else:
            quoted = "|".join(f"{q}{value}{q}" for q in "\"'")
        return rf"{start}(?:{_ATTRIBUTE})*?[\s/]++{self.attr}\s*=\s*(?:{quoted}|{value}(?=[\s/>]))"


# Where a title and a body are looked for, first hit wins.
TITLE_RULES = (
    Rule("meta", "property", "og:title"),
    Rule("div", "class", "se-title-text", inner="span"),
    Rule("h3", "class", "tit_h3"),
    Rule("title"),
)
BODY_RULES = (
    Rule("div", "class", "se-main-container"),
    Rule("div", "id", "viewTypeSelector"),
    Rule("div", "id", "postViewArea"),
    Rule("div", "class", "post_ct"),
)


def tokens(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))


# Kinds of tags a rule looks at.
_MATCH, _OPEN, _CLOSE, _INNER, _INNER_CLOSE = range(1, 6)


def _kind(rule: Rule, t: Column) -> Column:
    def tag(name: str, close: str = "") -> Column:
        return t.rlike(rf"(?i)^<{close}{name}[\s/>]")

    kind = F.when(t.rlike(rule.pattern()), _MATCH).when(tag(rule.tag), _OPEN).when(tag(rule.tag, "/"), _CLOSE)
    if rule.inner is not None:
        kind = kind.when(tag(rule.inner), _INNER).when(tag(rule.inner, "/"), _INNER_CLOSE)
    return F.when(t.startswith("<"), kind)


def element(rule: Rule, parts: Column) -> Column:
    """The tokens inside the first element of a rule; null without one.

    The state of the fold: open elements named like the rule's tag since the match, the same for the
    element that is read, and where this begins and ends.
    """
    marks = F.filter(
        F.transform(parts, lambda t, i: F.struct(_kind(rule, t).alias("kind"), i.alias("at"))), lambda m: m["kind"].isNotNull()
    )
    nothing = F.lit(None).cast("int")
    start = F.struct(F.lit(0).alias("outer"), F.lit(0).alias("depth"), nothing.alias("first"), nothing.alias("last"))
    one, zero = F.lit(1), F.lit(0)

    def state(s: Column, m: Column, **to: Column) -> Column:
        return F.struct(*[(to[n] if n in to else s[n]).alias(n) for n in ("outer", "depth", "first", "last")])

    def read(s: Column, m: Column, opens: Column, closes: Column) -> Column:
        """Depth, begin and end of the element that is read."""
        down = (s["depth"] == 1) & closes
        return (
            F.when((s["depth"] > 0) & opens, state(s, m, depth=s["depth"] + one))
            .when(down, state(s, m, depth=zero, last=m["at"]))
            .when((s["depth"] > 0) & closes, state(s, m, depth=s["depth"] - one))
        )

    def step(s: Column, m: Column) -> Column:
        kind = m["kind"]
        opens, closes = kind.isin(_MATCH, _OPEN), kind == _CLOSE
        if rule.inner is None:
            begun = F.when((s["depth"] == 0) & (kind == _MATCH), state(s, m, depth=one, first=m["at"]))
            moved = F.coalesce(begun, read(s, m, opens, closes), s)
        else:
            own = read(s, m, kind == _INNER, kind == _INNER_CLOSE)
            begun = F.when(
                (s["outer"] > 0) & (s["depth"] == 0) & (kind == _INNER), state(s, m, depth=one, first=m["at"])
            )
            outer = (
                F.when((s["outer"] == 0) & (kind == _MATCH), state(s, m, outer=one))
                .when((s["outer"] > 0) & opens, state(s, m, outer=s["outer"] + one))
                .when((s["outer"] == 1) & closes & (s["depth"] > 0), state(s, m, outer=zero, last=m["at"]))
                .when((s["outer"] > 0) & closes, state(s, m, outer=s["outer"] - one))
            )
            moved = F.coalesce(outer, begun, own, s)
        return F.when(s["last"].isNotNull(), s).otherwise(moved)

    return F.transform(
        F.array(F.aggregate(marks, start, step)),
        lambda s: F.when(
            s["first"].isNotNull(),
            F.slice(parts, s["first"] + 2, F.coalesce(s["last"], F.size(parts)) - s["first"] - 1),
        ),
    )[0]


def _texts(parts: Column) -> Column:
    """The tokens that are text."""
    return F.filter(parts, lambda t: ~t.rlike("^<[a-zA-Z/!?]"))


def _attribute(t: Column, name: str) -> Column:
    """The value of an attribute of a tag."""
    found = F.regexp_extract(t, rf"""(?is)^<[^\s/>]++(?:{_ATTRIBUTE})*?[\s/]++{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.regexp_replace(found, "^[\"']|[\"']$", "")


def _title(rule: Rule, parts: Column) -> Column:
    if rule.tag == "meta":
        found = F.get(F.filter(parts, lambda t: t.rlike(rule.pattern())), F.lit(0))
        return F.array(_attribute(found, "content"))
    return _texts(element(rule, parts))


def extract_pages(
    pages: DataFrame,
    title_rules: tuple[Rule, ...] = TITLE_RULES,
    body_rules: tuple[Rule, ...] = BODY_RULES,
) -> DataFrame:
    """``page_title`` and ``content_text`` of each page's ``html``; other columns stay.

    The title is that of the first rule with a text, the body that of the first rule with an element.
    Titles are decoded twice, as search results carry them.
    """
    kept = [c for c in pages.columns if c != "html"]
    cut = pages.select(*kept, tokens(F.col("html")).alias("_parts"))
    parts = F.col("_parts")
    body = F.coalesce(*[_texts(element(r, parts)) for r in body_rules])
    # every text is decoded by the same expression, which is a long one
    read = cut.select(*kept, F.array(body, *[_title(r, parts) for r in title_rules]).alias("_read"))
    plain = F.transform(
        "_read", lambda ts: F.filter(F.transform(ts, lambda t: strip(decode_entities(t))), lambda t: t != "")
    )
    decoded = read.select(*kept, plain.alias("_plain"))
    body, titles = F.get("_plain", F.lit(0)), F.slice("_plain", 2, len(title_rules))
    title = F.get(F.filter(titles, lambda ts: F.size(ts) > 0), F.lit(0))
    return decoded.select(
        *kept,
        decode_entities(F.array_join(title, " ")).alias("page_title"),
        F.array_join(body, "\n").alias("content_text"),
    )


def page_titles(pages: DataFrame) -> DataFrame:
    """The ``<title>`` text by regex alone, for pages where that is all that is needed.

    Like :func:`extract_pages` it decodes twice, here the common named entities.
    """
    text = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    for _ in range(2):
        for entity, plain in ENTITIES:
            text = F.regexp_replace(text, entity, plain)
    return pages.withColumn("page_title", F.nullif(F.trim(text), F.lit(""))).drop("html")
