"""The collection job without the network: found links and fetched pages to routed messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from pulse.functions.urls import KEEP_KEYS
from pulse.operators.ingest import (
    RAW,
    assemble_posts,
    discover_items,
    first_n,
    first_seen,
    route_failures,
    route_posts,
)
from pulse.operators.pages import BODY_RULES, TITLE_RULES, Rule, extract_pages
from pulse.sources.sinks import check_published, write_routed


def collect(
    found: DataFrame,
    pages: DataFrame,
    host: str,
    order: Sequence[Column | str],
    mobile_host: str | None = None,
    keep_keys: Sequence[str] = KEEP_KEYS,
    target_unique: int | None = None,
    max_fetch: int | None = None,
    title_rules: tuple[Rule, ...] = TITLE_RULES,
    body_rules: tuple[Rule, ...] = BODY_RULES,
    page_order: Sequence[Column | str] = ("html",),
) -> tuple[DataFrame, DataFrame]:
    """Posts and failures.

    ``found`` holds search results (link, title, postdate, discovered_at and the order
    columns), ``pages`` the fetched ``url, html`` and the columns of ``page_order``, by which the
    first page of a url counts. The two caps are settings of the job, off by default.
    """
    items = discover_items(found, host, order, mobile_host, keep_keys, target_unique)
    if max_fetch is not None:
        items = first_n(items, order, max_fetch)
    once = first_seen(pages, "url", page_order).select("url", "html")
    return assemble_posts(items, extract_pages(once, title_rules, body_rules))


def publish(
    posts: DataFrame,
    failures: DataFrame,
    fmt: str = "kafka",
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    at: Column | None = None,
) -> dict[str, int]:
    """Route and send posts and failures; fail when there are posts but none was sent."""
    routed = route_posts(posts, at).unionByName(route_failures(failures, at))
    sent = write_routed(routed, fmt, path, options)
    if sent[RAW] == 0:
        check_published(sent, posts.count())
    return sent
