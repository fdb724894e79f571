"""Link and title normalisation."""

from __future__ import annotations

import html.entities
import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulse.functions.text import strip

# Query keys kept in a post link, in this order.
KEEP_KEYS = ("blogId", "logNo", "Redirect", "proxyReferer")


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _query_value(query: Column, key: str) -> Column:
    """First non-blank value of a key, decoded; null when absent."""
    raw = F.regexp_extract(query, rf"(?:^|&){key}=([^&]+)", 1)
    plain = F.coalesce(F.try_url_decode(raw), F.replace(raw, F.lit("+"), F.lit(" ")))
    return F.when(raw != "", plain)


def _quote(c: Column) -> Column:
    """Percent-encode as in a path: slash and tilde stay, blank is %20."""
    out = F.url_encode(c)
    for found, wanted in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(found), F.lit(wanted))
    return out


def _kept_query(query: Column, keep_keys: Sequence[str]) -> Column:
    """``?`` and the named pairs, or nothing."""
    pairs = [
        F.concat(F.lit(f"{key}="), _quote(_query_value(query, key))) for key in keep_keys
    ]
    return _bind(
        F.concat_ws("&", *pairs),
        lambda kept: F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""),
    )


def normalize_url(c: Column, keep_keys: Sequence[str] = KEEP_KEYS) -> Column:
    """Trimmed link without fragment and with only the named query keys."""

    def rebuilt(url: Column) -> Column:
        scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
        rest = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?([^?#]*)", 1)
        query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
        return F.concat(F.lower(scheme), rest, _kept_query(query, keep_keys))

    return _bind(strip(c), rebuilt)


def mobile_url(
    c: Column,
    host: str,
    mobile_host: str | None = None,
    keep_keys: Sequence[str] = KEEP_KEYS,
    id_keys: tuple[str, str] = ("blogId", "logNo"),
) -> Column:
    """Canonical mobile link of a post.

    ``host`` is a regular expression of the blog host without capturing groups,
    ``mobile_host`` the host to write. A link that is already mobile or has no post number
    passes through.
    """
    target = mobile_host or "m." + host.replace("\\", "")
    # Where a link names the blog and the post number.
    by_query = rf"{id_keys[0]}=([^&]+).*{id_keys[1]}=(\d+)"
    by_path = rf"(?:{host})/([^/?]+)/(\d+)"

    def link(url: Column, pattern: str) -> Column:
        blog, post = (F.regexp_extract(url, pattern, i) for i in (1, 2))
        return F.concat(F.lit(f"https://{target}/"), blog, F.lit("/"), post)

    def canonical(url: Column) -> Column:
        return (
            F.when(url.contains(target), url)
            .when(url.rlike(by_query), link(url, by_query))
            .when(url.rlike(by_path), link(url, by_path))
            .otherwise(url)
        )

    return _bind(normalize_url(c, keep_keys), canonical)


# References as HTML reads them, and everything between them.
REFERENCES = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"


def _names() -> str:
    """Entity names of the standard library as a JSON object."""
    return json.dumps(html.entities.html5)


def _short_names() -> str:
    """Names that count without a semicolon, even as the start of a longer word."""
    short = [n for n in html.entities.html5 if not n.endswith(";")]
    return "|".join(sorted(short, key=len, reverse=True))


def _controls() -> str:
    """Characters of the numbers that HTML reads as the Windows code page, as a JSON object."""
    return json.dumps({str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)})


def _character(n: Column) -> Column:
    """The character of a number; what HTML replaces or drops is replaced or dropped."""
    controls = F.from_json(F.lit(_controls()), "map<string,string>")
    dropped = n.between(1, 8) | n.between(14, 31) | n.isin(11, 127)
    dropped |= n.between(0xFDD0, 0xFDEF) | (n % 0x10000).isin(0xFFFE, 0xFFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (
        F.when(n.isNull() | (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd")
        .when(n.between(0x80, 0x9F), F.element_at(controls, n.cast("string")))
        .when(dropped, "")
        .otherwise(plain)
    )


def decode_entities(c: Column) -> Column:
    """Text with character references decoded, named ones and numbers, as browsers read them."""
    names = F.from_json(F.lit(_names()), "map<string,string>")

    def decoded(p: Column) -> Column:
        digits = F.regexp_extract(p, r"^&#([0-9]+)", 1)
        hexed = F.regexp_extract(p, r"^&#[xX]([0-9a-fA-F]+)", 1)
        # ten digits are beyond all characters, and so is anything longer
        number = F.when(F.length(digits).between(1, 11), digits.cast("long")).when(
            F.length(hexed).between(1, 11), F.conv(hexed, 16, 10).cast("long")
        )
        named = F.element_at(names, F.substring(p, 2, 64))
        short = F.regexp_extract(p, f"^&({_short_names()})", 1)
        rest = F.substr(p, F.length(short) + 2)
        return (
            F.when((digits != "") | (hexed != ""), _character(number))
            .when(named.isNotNull(), named)
            .when(short != "", F.concat(F.element_at(names, short), rest))
            .otherwise(p)
        )

    parts = F.transform(
        F.regexp_extract_all(c, F.lit(REFERENCES), F.lit(0)),
        lambda p: F.when(p.startswith("&"), decoded(p)).otherwise(p),
    )
    return F.when(c.contains("&"), F.array_join(parts, "")).otherwise(c)


def plain_title(c: Column) -> Column:
    """Title without tags and with entities decoded; an empty title is null."""
    return decode_entities(F.regexp_replace(F.when(c != "", c), r"<[^>]+>", ""))
