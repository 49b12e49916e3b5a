"""Hostile and odd pages, and the classes of a host's tokens against brute force."""

from __future__ import annotations

import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import html_text

PAGE = "page_id long, url string, html string"


def text_of(html, template=frozenset()):
    return html_text.main_text(html_text.Page(html), set(template))


@pytest.mark.parametrize(
    "html",
    [
        "<a " * 350_000,
        "<div>" * 100_000 + "</p>" * 100_000 + "</span>" * 50_000,
        '<p title="it>hello' * 60_000,
        "<p a='x>" * 120_000,
        "<a '>" * 200_000,
        "<!--" * 250_000,
        "<span>" * 80_000 + "</div>" * 80_000,
        "<script><script></script " * 40_000,
        "<div>" * 50_000 + "<nav><article>" * 50_000,
        "<" * 1_000_000,
        "&" * 1_000_000,
    ],
    ids="a div quote apostrophe closed comment span script nav sign amp".split(),
)
def test_pages_of_a_megabyte_take_seconds(html):
    begun = time.time()
    text_of(html)
    assert time.time() - begun < 20


@pytest.mark.parametrize(
    "html, text",
    [
        ('<p title="it>hello</p>', "hello"),
        ("<p title='it>hello</p><p id=x>more", "hello more"),
        ('<p title="a > b" class=\'c\'>hello</p>', "hello"),
        ("<p don't>hello</p> <p>it's</p>", "hello it's"),
        ("<p title = \"a'b\">x</p>", "x"),
        ("a < b and c > d", "a < b and c > d"),
        ("one <b", "one <b"),
        ("one <!-- two", "one"),
        ("one <!doctype x> two <?php echo 1 ?> three", "one two three"),
        ("<script>var a='</p>'</script >text", "text"),
        ("<scripted>text</scripted>", "text"),
        ("<p>a</b></i>b", "ab"),
        ("", ""),
        ("<article>teaser</article><div><p>the real and long body</p></div>", "the real and long body"),
        ("<div>short</div><article>the article itself</article>", "the article itself"),
        ("<article><div class='header'><h1>Title</h1></div><p>body</p></article>", "Title body"),
        ("<article><p class=legal>terms</p><div id='search'>find</div></article>", "terms find"),
        ("<article>x<div class='ad'>buy</div><div class='comments'>me too</div></article>", "x"),
        ("<div class='header'>site</div><p>text</p>", "text"),
        ("<p><a href=x>a block that is a link</a></p><p>text</p>", "a block that is a link text"),
        ("<nav><div><article>kept</article>", "kept"),
        ("<li>a<li>b<p>c<div>d", "a b c d"),
    ],
)
def test_text(html, text):
    assert text_of(html) == text


def site(n=12):
    """Pages of a host with a frame, a menu that is no element of that name, and a text each; one host has two pages."""
    out = []
    for i in range(n):
        menu = "<div class=top><span>Start</span><div>Imprint of the house</div></div>"
        odd = "<div><p>only here</p></div>" if i == 3 else ""
        half = "<p>said on half of them</p>" if i % 2 else ""
        out.append((i, "http://one.example/x", f"<html><body>{menu}<div id=c><p>text number {i}</p>{half}{odd}</div></body></html>"))
    out += [(100 + i, "http://two.example/", f"<body><p>few {i}</p></body>") for i in range(2)]
    return out


def classes(pages, min_pages=3, share=0.5):
    """By host: tokens of classes of equal occurrence vectors, kept whole."""
    by_host = defaultdict(dict)
    for _, url, html in pages:
        by_host[url.split("/")[2]][html] = html_text.Page(html)
    out = {}
    for host, found in by_host.items():
        vectors = defaultdict(dict)
        for n, page in enumerate(found.values()):
            for token, times in Counter([*page.tags, *(b[0] for b in page.blocks)]).items():
                vectors[token][n] = times
        groups = defaultdict(set)
        for token, vector in vectors.items():
            if len(vector) >= max(min_pages, share * len(found)):
                groups[tuple(sorted(vector.items()))].add(token)
        template = set().union(*(g for g in groups.values() if len(g) >= html_text.MIN_TOKENS))
        if template:
            out[host] = template
    return out


def test_templates_are_the_classes_of_equal_vectors(spark):
    pages = site() + site()[:4]  # equal pages count once
    rows = spark.createDataFrame(pages, PAGE)
    keyed = rows.select(html_text.host(F.col("url")).alias("host"), "html", F.xxhash64("html").alias("page_key"))
    found = {r.host: set(r.template) for r in html_text.templates(keyed).collect()}
    assert found == classes(pages)


def test_slots_of_pages_without_an_article(spark):
    pages = site()
    rows = spark.createDataFrame(pages, PAGE)
    got = {r.page_id: r.text for r in html_text.extract(rows).collect()}
    template = classes(pages)
    expected = {i: text_of(html, template.get(url.split("/")[2], ())) for i, url, html in pages}
    assert got == expected
    assert got[0] == "text number 0" and "Imprint" not in got[5] and got[100] == "few 0"


def test_empty_table_nulls_and_clashing_names(spark):
    assert html_text.extract(spark.createDataFrame([], PAGE)).count() == 0
    rows = [(1, None, None), (None, "http://a/", "<p>x</p>"), (2, "no address", ""), (2, "no address", "")]
    names = ("host", "page_key", "template", "text", "n_chars", "_host", "token", "members", "count")
    df = spark.createDataFrame(rows, PAGE).withColumns({c: F.lit(c) for c in names})
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html_text.extract(df).collect()), key=repr)
    assert got == sorted([(1, None, "", 0), (None, "http://a/", "x", 1), (2, "no address", "", 0), (2, "no address", "", 0)], key=repr)
