import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from paperlake.sources import markup, pages
from paperlake.sources.markup import Wanted
from test_sources import PAGE

# each page with the elements that its tree, written by hand, holds: (name, text, markup)
D, P, A, H = Wanted("div", "c", every=True, markup=True), Wanted("p", every=True), Wanted("a", every=True), Wanted("h1", within="article")
GOLDEN = {
    "comment": ('<!-- <div class="c">no</div> > --><div class="c">yes<!-- </div> --> on</div>', {"d": D},
                [("d", "yes on", '<div class="c">yes<!-- </div> --> on</div>')]),
    "script": ('<script>if (a < b) x = "</p><p>no</p>";</script><style>p > a {}</style><p>one</p>', {"p": P}, [("p", "one", None)]),
    "script inside": ("<p>a<script>'<p>'</script>b</p>", {"p": P}, [("p", "ab", None)]),
    "attribute": ("<p title='a > b' class=\"x\">text</p><a href=/u?a=1&amp;b>l</a>", {"p": P, "a": A},
                  [("p", "text", None), ("a", "l", None)]),
    "nested": ('<div class="c">1<div class="c">2<div>3</div></div>4</div>5', {"d": D},
               [("d", "1234", '<div class="c">1<div class="c">2<div>3</div></div>4</div>'),
                ("d", "23", '<div class="c">2<div>3</div></div>')]),
    "classes": ('<div class="cc">1</div><DIV CLASS=" b c ">2</DIV><div class=c>3</div><div>4</div>', {"d": D},
                [("d", "2", '<DIV CLASS=" b c ">2</DIV>'), ("d", "3", "<div class=c>3</div>")]),
    "open paragraphs": ("<p>1<p><b>2<br>3<div><p>4</div>5", {"p": P}, [("p", "1", None), ("p", "23", None), ("p", "4", None)]),
    "walls": ("<p>1<button><p>2</p>3</button>4<ul><li><p>5<li>6</ul>", {"p": P}, [("p", "1234", None), ("p", "2", None), ("p", "5", None)]),
    "within": ("<h1>0</h1><article><section><h1>1</h1></section><h1>2</h1></article>", {"h": H}, [("h", "1", None)]),
    "stray": ("</p></div>1 < 2 <p>a <3 b</i></p>", {"p": P}, [("p", "a <3 b", None)]),
    "title": ("<title>a <p> b</title><p>c</p>", {"t": Wanted("title"), "p": P}, [("t", "a <p> b", None), ("p", "c", None)]),
    "cut off": ('<p>text<a href="x', {"p": P, "a": A}, [("p", "text", None)]),
    "open": ('x<div class="c">a<b>b', {"d": D}, [("d", "ab", '<div class="c">a<b>b')]),
    "void": ("<img class=c><p/>t", {"i": Wanted("img", "c", markup=True)}, [("i", "", "<img class=c>")]),
    "empty": ("", {"p": P}, []),
}


@pytest.mark.parametrize("name", sorted(GOLDEN))
def test_golden(name):
    html, wanted, want = GOLDEN[name]
    assert [(e["name"], e["text"], e["markup"]) for e in markup.find_elements(html, wanted)] == want


def test_attributes():
    assert markup.attributes(""" HREF='a>b' class="x  y" id=z/ checked href=2 data-n = "3" """) == {
        "href": "a>b", "class": "x  y", "id": "z/", "checked": "", "data-n": "3"}


@pytest.mark.parametrize("piece", ["<a b='", '<a ="', "<div>", "</p>", "<div></p>", "<script>", "<", "<!--", "<title><", "<p>", "<a <a ", "<p><button>", "<p><b>"])
def test_broken_pages_take_linear_time(piece):
    begin = time.monotonic()
    markup.find_elements(piece * (1_000_000 // len(piece)), {"d": Wanted("div"), "p": Wanted("p")})
    assert time.monotonic() - begin < 30


def test_same_records_as_patterns(spark):
    docs = spark.createDataFrame([("one", PAGE), ("two", "<html><h1>Only heading</h1></html>"), ("none", None), ("", ""), (None, "<p>")],
                                 "slug string, html string").withColumn("title", F.lit("clash"))
    want = pages.extract_pages(docs, "2026-08-01", url_base="u/")
    got = pages.parse_pages(docs, "2026-08-01", url_base="u/")
    assert got.schema.names == want.schema.names
    rows = {r["slug"]: r for r in got.collect()}
    for r in want.filter("slug in ('one', 'two')").collect():
        assert rows[r["slug"]] == r
    assert [rows[s]["problem"] for s in ("one", "none", "", None)] == [None, "no html", "no slug", "no slug"]
    assert (rows["none"]["title"], rows["none"]["mesh_terms"], rows["none"]["body_html"]) == ("", [], "")
    assert pages.parse_pages(docs.limit(0), "2026-08-01").count() == 0


def test_pages_that_mislead_patterns(spark):
    html = ("""<!-- <article><h1>Old</h1> --><article data-x="a > b"><script>t("<h1>Script</h1>")</script>
<h1 title=">">Real &amp; new<!-- > --></h1><p class="masthead-date">2026-07-15</p>
<p class="article-lead">Lead <b title="1 > 0">x</b></p><div class="article-content"><!-- </div> --><div>in</div>out</div>
<a title="x > y" class="source-link" href='https://doi.org/10.1/a?b=1&amp;c="2"'>s</a>"""
            """<a class=tag href=#>one</a><!-- <a class="tag">no</a> --><a class="tag"><b>two</b></a></article>""")
    row = pages.parse_pages(spark.createDataFrame([("s", html)], "slug string, html string"), "2026-08-01").first()
    assert (row["title"], row["abstract"], row["pub_date"]) == ("Real & new", "Lead x", dt.date(2026, 7, 15))
    assert row["body_html"] == '<div class="article-content"><!-- </div> --><div>in</div>out</div>'
    assert row["source_url"] == 'https://doi.org/10.1/a?b=1&c="2"' and row["mesh_terms"] == ["one", "two"]
