"""Valid classes: one order of tokens on all pages, classes that nest, and roles told apart by them."""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import functions as F

from tidemark.llm import html_text

PAGE = "page_id long, url string, html string"


def texts(spark, htmls):
    rows = [(i, "http://h.example/", html) for i, html in enumerate(htmls)]
    found = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, PAGE)).collect()}
    return [found[i] for i in range(len(htmls))]


def test_tokens_out_of_order_are_no_class(spark):
    one, two = "<p>first line</p>", "<div>second line</div>"
    pages = [f"<body><h1>House</h1>{one + two if i % 2 else two + one}<p>story {i}</p></body>" for i in range(8)]
    for i, text in enumerate(texts(spark, pages)):
        # one of the two keeps its place, the other is none of the template
        assert f"story {i}" in text and "House" not in text
        assert ("first line" in text) != ("second line" in text)


def test_a_class_out_of_order_is_broken_into_two(spark):
    one = "<div><p>first line</p><p>next line</p></div>"
    two = "<section><h2>Other</h2><p>second line</p><p>third line</p></section>"
    pages = [f"<body>{one + two if i % 2 else two + one}<p>story {i}</p></body>" for i in range(8)]
    assert texts(spark, pages) == [f"story {i}" for i in range(8)]


def test_classes_that_do_not_nest_are_dropped(spark):
    box = "<div><p>box of one</p><p>box of two</p></div>"
    pages = []
    for i in range(9):
        before, behind = [("", ""), (box, ""), ("", box)][i % 3]
        pages.append(f"<body><h1>House</h1>{before}<h2>Street</h2><p>story {i}</p>{behind}</body>")
    box_text = "box of one box of two"
    want = [[f"story {i}", f"{box_text} story {i}", f"story {i} {box_text}"][i % 3] for i in range(9)]
    assert texts(spark, pages) == want


def test_a_class_that_stays_in_a_gap_is_kept(spark):
    box = "<div><p>box of one</p><p>box of two</p></div>"
    pages = [f"<body><h1>House</h1>{box * (i % 3)}<h2>Street</h2><p>story {i}</p></body>" for i in range(9)]
    assert texts(spark, pages) == [f"story {i}" for i in range(9)]


def test_roles_are_told_apart_by_the_gaps_of_classes(spark):
    pages = []
    for i in range(6):
        story = "".join(f"<p>story {i} {k}</p>" for k in range(i % 3 + 1))
        pages.append(f"<body><p>more</p><h1>House</h1>{story}<h2>Street</h2><p>more</p></body>")
    assert texts(spark, pages) == [" ".join(f"story {i} {k}" for k in range(i % 3 + 1)) for i in range(6)]


def random_page(rng, depth=0):
    out = []
    for _ in range(rng.randint(1, 4)):
        tag = rng.choice(["div", "p", "h1", "section"])
        inner = random_page(rng, depth + 1) if depth < 2 and rng.random() < 0.4 else rng.choice("abcdefg")
        out.append(f"<{tag}>{inner}</{tag}>")
    return "".join(out)


def changed_page(rng, parts):
    parts = [p for p in parts if rng.random() < 0.85]
    if rng.random() < 0.4 and len(parts) > 1:
        i, k = rng.sample(range(len(parts)), 2)
        parts[i], parts[k] = parts[k], parts[i]
    return f"<body>{''.join(parts)}<p>{rng.random()}</p></body>"


def ordered(places, a, b):
    one, two = places[a], places[b]
    return len(one) == len(two) and all(x < y for x, y in zip(one, two)) and all(y < x for x, y in zip(one[1:], two))


def gap(places, outer, spans):
    """Where a class lies in another: one gap for all its spans, 0 beside it, None neither."""
    marks = sorted(p for t in outer for p in places[t])
    gaps = set()
    for low, high in spans:
        before, upto = (sum(m < at for m in marks) for at in (low, high))
        if before != upto:
            return 0 if before % len(outer) == upto % len(outer) == 0 and len(spans) else None
        gaps.add(before % len(outer))
    return gaps


def test_valid_classes_of_random_hosts_by_their_definition(spark):
    rng = random.Random(5)
    rows = []
    for host in range(25):
        parts = [random_page(rng) for _ in range(rng.randint(2, 6))]
        rows += [(len(rows) + i, f"http://h{host}.example/", changed_page(rng, parts)) for i in range(rng.randint(3, 9))]
    pages = spark.createDataFrame(rows, PAGE)
    keyed = pages.select(html_text.host(F.col("url")).alias("host"), "html", F.xxhash64("html").alias("page_key"))
    found = {r.host: r for r in html_text.templates(keyed).collect()}
    assert len(found) > 15
    several = 0
    for host, row in found.items():
        rounds = [html_text.Round(r.classes, r.apart) for r in row.rounds]
        classes = rounds[-1].classes
        assert sorted(t for c in classes for t in c) == sorted(row.template)
        several += len(classes) > 1
        between = {}
        for html in {html for _, url, html in rows if url == f"http://{host}/"}:
            roles = reduce(lambda tokens, r: r.roles(tokens), rounds[:-1], html_text.Page(html).tokens)
            places = {t: [at for at, role in enumerate(roles) if role == t] for t in row.template}
            for c in classes:
                assert all(ordered(places, a, b) for n, a in enumerate(c) for b in c[n + 1 :])
            for n, outer in enumerate(classes):
                for k, inner in enumerate(classes):
                    spans = list(zip(places[inner[0]], places[inner[-1]]))
                    if n != k and spans:
                        at = gap(places, outer, spans)
                        assert at is not None
                        between.setdefault((n, k), set()).update({0} if at == 0 else at)
        assert all(len(gaps) == 1 for gaps in between.values())
    assert several > 5
