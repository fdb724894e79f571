import json

import pytest
from pyspark.sql import functions as F

from pulse.functions import urls
from pulse.operators import ingest as g
from pulse.operators import pages as p
from pulse.plans.collect import collect
from pulse.schema import POST_MESSAGE

X = F.col("x")
KEYS = ("page", "ref")


def posts(spark, *rows):
    base = {"schema_version": "1.0", "url": "u", "title": "t", "content_text": "c",
            "postdate": "20240107", "discovered_at": "2024-01-07T10:00:00Z"}
    return spark.createDataFrame([tuple((base | r)[n] for n in POST_MESSAGE.names) for r in rows], POST_MESSAGE)


def test_first_missing_field_is_named(spark):
    rows = [{}, {"url": None, "title": ""}, {"url": ""}, {"title": None, "content_text": ""},
            {"content_text": ""}, {"title": " "}]
    got = [r["error_message"] for r in g.validate_posts(posts(spark, *rows)).collect()]
    name = "필수 필드 누락: '{}'".format
    assert got == [None, name("url"), name("url"), name("title"), name("content_text"), None]


@pytest.mark.parametrize("content, want", [
    ('"text"', None), ('"12"', None), ("12", "kind"), ("true", "kind"), ('{"a":1}', "kind"), ("[0]", "kind"), ("0.5", "kind"),
    ("0", "missing"), ("0.0", "missing"), ("false", "missing"), ("null", "missing"), ("[]", "missing"), ("{}", "missing"), ('""', "missing"),
])
def test_content_must_be_text(spark, content, want):
    body = f'{{"url": "u", "title": "t", "content_text": {content}}}'
    posts = g.decode_crawled(spark.createDataFrame([(body,)], "value string"))
    row = g.validate_posts(posts).first()
    texts = {None: None, "kind": g.NOT_TEXT, "missing": g.MISSING_FIELD.format("content_text")}
    assert row["error_message"] == texts[want]
    routed = {r["topic"]: r["value"] for r in g.route_posts(posts).collect()}
    assert set(routed) == {"raw", "cleaned" if want is None else "error"}


def test_other_missing_fields_come_before_the_kind_of_content(spark):
    rows = [('{"url": "u", "content_text": 5}',), ('{"title": "t", "content_text": 5}',), ("oops",), (None,)]
    checked = g.validate_posts(g.decode_crawled(spark.createDataFrame(rows, "value string"))).collect()
    assert [r["error_message"] for r in checked] == [g.MISSING_FIELD.format(f) for f in ("title", "url", "url", "url")]


def test_routing_keeps_raw_and_splits_by_validity(spark):
    df = posts(spark, {"url": "ok", "title": "　 t\n", "postdate": "bad"}, {"url": "no", "title": None})
    got = {(r["topic"], r["key"]): json.loads(r["value"]) for r in g.route_posts(df, F.lit("T")).collect()}
    assert set(got) == {("raw", "ok"), ("raw", "no"), ("cleaned", "ok"), ("error", "no")}
    assert got["raw", "ok"]["title"] == "　 t\n" and got["cleaned", "ok"]["title"] == "t"
    assert got["cleaned", "ok"]["postdate"] == "bad"
    assert "schema_version" not in got["cleaned", "ok"]
    bad = got["error", "no"]
    assert bad["error_type"] == "validation_error" and bad["occurred_at"] == "T"
    assert bad["raw_data"] == got["raw", "no"] and bad["raw_data"]["title"] is None
    summary = {r["topic"]: r["sent"] for r in g.publish_summary(g.route_posts(df)).collect()}
    assert summary == {"raw": 2, "cleaned": 1, "error": 1}


def test_failures_have_defaults(spark):
    df = spark.createDataFrame([("u", "boom"), (None, None)], "url string, error string")
    got = [json.loads(r["value"]) for r in g.route_failures(df).collect()]
    assert [(r["url"], r["error_message"]) for r in got] == [
        ("u", "boom"), ("unknown", "크롤링 실패 (원인 불명)")
    ]


def test_decoding_drops_what_is_no_object_or_has_no_url(spark):
    values = ['{"url": "a", "title": "x", "extra": 1}', '{"url": ""}', '{"title": "x"}', "[1]", "5",
              '"text"', "null", '{"url": "cut', "", None, '{"url": "b", "title": null}', '[{"url": "c"}]']
    df = spark.createDataFrame([(v,) for v in values], "value string")
    assert [r["url"] for r in g.decode_posts(df).collect()] == ["a", "b"]
    assert g.decode_messages(df).count() == len(values)
    dead = [r["value"] for r in g.dead_letters(df).collect()]
    assert dead == ["[1]", "5", '"text"', "null", '{"url": "cut', "", None, '[{"url": "c"}]']


def test_first_seen_and_first_n(spark):
    rows = [(3, "a", "x"), (1, "a", "y"), (2, "b", "z"), (4, "c", "w")]
    df = spark.createDataFrame(rows, "o int, k string, v string")
    first = g.first_seen(df, "k", ["o"])
    assert sorted(tuple(r) for r in first.collect()) == [(1, "a", "y"), (2, "b", "z"), (4, "c", "w")]
    assert [r["k"] for r in g.first_n(first, ["o"], 2).collect()] == ["a", "b"]


def test_retry_merge(spark):
    kept = spark.createDataFrame([("a", "A")], "url string, title string")
    failed = spark.createDataFrame([("b", "e"), ("c", "e"), ("d", "e")], "url string, error string")
    retried = spark.createDataFrame(
        [("b", "B", None), ("c", None, "again"), ("zz", "Z", None)], "url string, title string, error string"
    )
    merged, still, summary = g.retry_merge(kept, failed, retried)
    assert sorted(tuple(r) for r in merged.collect()) == [("a", "A"), ("b", "B")]
    assert sorted(tuple(r) for r in still.collect()) == [("c", "again"), ("d", "e")]
    assert {r["kind"]: r["rows"] for r in summary.collect()} == {"posts": 2, "failures": 2}
    # repeated attempts: a success counts once, two failures are one
    more = [("b", "B", None), ("b", "B2", None), ("b", None, "again"), ("c", None, "x"), ("c", None, "again")]
    merged, still, _ = g.retry_merge(kept, failed, spark.createDataFrame(more, retried.schema))
    assert sorted(tuple(r) for r in merged.collect()) == [("a", "A"), ("b", "B")]
    assert sorted(tuple(r) for r in still.collect()) == [("c", "again"), ("d", "e")]


@pytest.mark.parametrize(
    "url, want",
    [
        (" https://b.example.com/a?page=2&x=1&ref=q#top ", "https://b.example.com/a?page=2&ref=q"),
        ("https://b.example.com/a?ref=q&page=2", "https://b.example.com/a?page=2&ref=q"),
        ("HTTP://B.example.com/a?page=&page=3&page=4", "http://B.example.com/a?page=3"),
        ("https://h/a?page=a%20b+c%2Fd~*", "https://h/a?page=a%20b%20c/d~%2A"),
        ("https://h/a?page=%ED%95%9C", "https://h/a?page=%ED%95%9C"),
        ("https://h/a?mypage=1", "https://h/a"),
        ("https://h/a?", "https://h/a"),
        ("not a url", "not a url"),
        ("", ""),
        (None, None),
    ],
)
def test_normalized_links(column, url, want):
    assert column([url], urls.normalize_url(X, KEYS)) == [want]


@pytest.mark.parametrize(
    "url, want",
    [
        ("https://blog.example.com/PostView?logNo=5&blogId=me&x=1", "https://m.blog.example.com/me/5"),
        ("https://blog.example.com/me/123?Redirect=y", "https://m.blog.example.com/me/123"),
        ("http://m.blog.example.com/me/123#a", "http://m.blog.example.com/me/123"),
        ("https://blog.example.com/me", "https://blog.example.com/me"),
        ("https://other.org/me/123", "https://other.org/me/123"),
    ],
)
def test_mobile_links(column, url, want):
    assert column([url], urls.mobile_url(X, r"blog\.example\.com")) == [want]


def test_plain_titles(column):
    values = ["<b>a</b> &amp; b", "&#39;q&#x27; &hellip; &nosuch;", "plain", "", None, "&lt;b&gt;"]
    assert column(values, urls.plain_title(X)) == ["a & b", "'q' … &nosuch;", "plain", None, None, "<b>"]


PAGE = """<html><head><meta property="og:title" content=""><title> Tab &amp;amp; title </title></head>
<body><div class="other">no</div>
<div class="se-title-text x"><div><span>Real <b>title</b></span></div><span>second</span></div>
<div class="post_ct">later</div>
<div class="se-main-container"><p>One<br>two &lt;3 <img src=x></p><script>var a = "</p>";</script>
<div>three<noscript>no</noscript><style>p{}</style></div> </div><div>after</div></body></html>"""


def extracted(spark, html, **rules):
    df = spark.createDataFrame([(1, html)], "id int, html string")
    return tuple(p.extract_pages(df, **rules).first())[1:]


def test_pages_use_the_first_rule_that_hits(spark):
    title, body = extracted(spark, PAGE)
    assert title == "Real title"
    assert body == "One\ntwo <3\nthree"


def test_pages_fall_back_and_may_miss(spark):
    assert extracted(spark, "<title>T &amp;amp; U</title><div id=postViewArea>x</div>") == ("T & U", "x")
    assert extracted(spark, '<meta property="og:title" content="Og"><title>T</title>') == ("Og", None)
    assert extracted(spark, "<p>nothing") == (None, None)
    assert extracted(spark, None) == (None, None)
    assert extracted(spark, '<div id="postViewArea"><p>open <b>tags</div><p>out') == (None, "open\ntags")
    rules = {"title_rules": (p.Rule("h1"),), "body_rules": (p.Rule("article"),)}
    assert extracted(spark, "<h1>A</h1><article>b</article>", **rules) == ("A", "b")


@pytest.mark.parametrize("html, want", [
    ("<div id='postViewArea'>a<div>b</div>c</div>d", "a\nb\nc"),
    ("<DIV data-x='a>b' ID=postViewArea >a</DIV >b", "a"),
    ('<div title="id=postViewArea">no</div><div id="postViewArea">yes', "yes"),
    ("<div id=postViewAreas>no</div><div class='x post_ct y'>yes</div>", "yes"),
    ("<div class='post_ctx'>no</div>", None),
    ("</div></div><div id=postViewArea></p>a</div></div>b", "a"),
    ("<div id=postViewArea><!-- <div> no --> a <br/> b &amp; c <script>'</div>'</script> d", "a\nb & c\nd"),
    ("<div id=postViewArea>1 < 2 <b>3</b></div>", "1\n<\n2\n3"),
    ("<div id=postViewArea>&nbsp; <p> </p></div><div class=post_ct>later</div>", ""),
    ("<div id=postViewArea><style>no", ""),
    ("", None),
    ("<div", None),
])
def test_bodies_of_nested_unclosed_and_odd_tags(spark, html, want):
    assert extracted(spark, html, title_rules=(p.Rule("title"),)) == (None, want)


def test_titles_of_a_child_in_an_element(spark):
    rules = {"title_rules": (p.Rule("div", "class", "t", inner="span"), p.Rule("title")), "body_rules": (p.Rule("p"),)}
    cases = {
        "<span>no</span><div class=t>x<span>a<span>b</span>c</span><span>d</span></div>": "a b c",
        "<div class=t><div>x</div></div><div class=t><div><span>a": "a",
        "<div class=t><span>a</div>b</span>": "a",
        "<div class=t>none</div><title>fall &amp;amp; back</title>": "fall & back",
        "<div class=t><span>&nbsp;</span></div><title>t</title>": "t",
    }
    df = spark.createDataFrame([(i, h) for i, h in enumerate(cases)], "id int, html string")
    got = [r["page_title"] for r in p.extract_pages(df, **rules).orderBy("id").collect()]
    assert got == list(cases.values())


def test_pages_need_no_python_and_take_long_texts(spark):
    df = spark.createDataFrame([("<div id=postViewArea>" + "<p>word &lt; x</p>" * 20_000 + "</div>" + "<" * 20_000,)], "html string")
    plan = p.extract_pages(df)
    assert len(plan.first()["content_text"]) == 20_000 * 9 - 1
    steps = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(s in steps for s in ("MapInPandas", "MapInArrow", "EvalPython"))


def test_regex_title_agrees_on_plain_pages(spark):
    df = spark.createDataFrame([(1, "<TITLE lang=en> a &amp;lt; b </TITLE>"), (2, "no")], "id int, html string")
    assert [r["page_title"] for r in p.page_titles(df).orderBy("id").collect()] == ["a < b", None]


def test_collect_joins_search_results_and_pages(spark):
    found = spark.createDataFrame(
        [
            (1, "https://blog.example.com/me/1", "<b>One</b>", "20240107"),
            (2, "https://m.blog.example.com/me/1", "again", "20240108"),
            (3, "https://elsewhere.org/me/2", "other host", ""),
            (4, "https://blog.example.com/me/3?utm=1", "Three", ""),
            (5, "https://blog.example.com/me/4", "Four", "x"),
        ],
        "n int, link string, title string, postdate string",
    ).withColumn("discovered_at", F.lit("now"))
    pages = spark.createDataFrame(
        [("https://m.blog.example.com/me/1", "<div class=post_ct>body</div>"),
         ("https://m.blog.example.com/me/1", "<div class=post_ct>body~again</div>"),
         ("https://m.blog.example.com/me/3", "<title>Page</title>")],
        "url string, html string",
    )
    done, failed = collect(found, pages, r"blog\.example\.com", ["n"])
    rows = sorted((r["url"][-1], r["title"], r["content_text"], r["postdate"]) for r in done.collect())
    assert rows == [("1", "One", "body", "2024-01-07"), ("3", "Page", None, None)]
    assert [r["url"][-1] for r in failed.collect()] == ["4"]
    capped, _ = collect(found, pages, r"blog\.example\.com", ["n"], max_fetch=1)
    assert capped.count() == 1


def test_entities_are_decoded_as_browsers_do(column):
    import html
    import random

    rng = random.Random(5)
    parts = [
        "&", "&amp;", "&lt", "&gt;", "&notit;", "&notin;", "&ampx", "&#65;", "&#x41", "&#X1F642;", "&#0;", "&#13;",
        "&#128;", "&#x81;", "&#xD800;", "&#99999999999999999999;", "&#1;", "&#xFFFE;", "&NotEqualTilde;", "&copy=1",
        "&unknown;", "&;", "&#;", "&#x;", "é", " ", "x", ";", "&quot;", "&nbsp;", "&fjlig;", "&AMP", "&#1114111;",
    ]
    texts = parts + ["".join(rng.choices(parts, k=6)) for _ in range(300)] + ["", None]
    got = column(texts, urls.decode_entities(X))
    assert got == [None if t is None else html.unescape(t) for t in texts]
