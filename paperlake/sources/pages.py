"""Article pages (HTML) to records."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake import vocab
from paperlake.functions import text as T
from paperlake.sources import markup
from paperlake.sources.markup import Wanted

# Names of character references and their text, from the standard library's table of HTML 5.
NAMED_REFERENCES = {name.rstrip(";"): text for name, text in html5.items()}
_REFERENCE = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def read_pages(spark: SparkSession, base: str) -> DataFrame:
    """``index.html`` of every article folder as (path, slug, html).

    Folders named ``category`` or starting with ``-`` are left out.
    """
    files = (spark.read.format("text").option("wholetext", True).load(f"{base.rstrip('/')}/*/index.html")
             .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html")))
    return (files.withColumn("slug", F.element_at(F.split("path", "/"), -2))
            .filter((F.col("slug") != "category") & ~F.startswith("slug", F.lit("-"))))


def plain_text(fragment: Column) -> Column:
    """Text of an HTML fragment: tags dropped, references resolved, ends trimmed."""
    return _trimmed(resolve_references(F.regexp_replace(fragment, "(?s)<[^>]*>", "")))


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def resolve_references(text: Column, named: dict[str, str] | None = None) -> Column:
    """Named, decimal and hexadecimal character references as characters, each once; unknown ones stay."""
    table = F.from_json(F.lit(json.dumps(NAMED_REFERENCES if named is None else named)), "map<string,string>")

    def character(code: Column) -> Column:
        valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code < 0x110000))
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def resolved(piece: Column) -> Column:
        name = F.regexp_extract(piece, _REFERENCE, 1)
        value = (F.when(F.rlike(name, F.lit("^#[0-9]{1,7}$")), character(F.substring(name, 2, 7).try_cast("long")))
                 .when(F.rlike(name, F.lit("^#[xX][0-9a-fA-F]{1,6}$")), character(F.conv(F.substring(name, 3, 6), 16, 10).try_cast("long")))
                 .when(name != "", F.try_element_at(table, name)))
        return F.coalesce(F.concat(value, F.substring(piece, F.length(name) + 2, F.length(piece))), F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&")
    return F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(resolved(p))), "")


def _with_class(css_class: str) -> str:
    """Pattern for the attributes of an opening tag that has a class among its classes."""
    return rf"\s[^>]*\bclass\s*=\s*[\"'](?:[^\"']*\s)?{css_class}(?:\s[^\"']*)?[\"'][^>]*"


def element(html: Column, tag: str, css_class: str | None = None) -> Column:
    """Inner HTML of the first such element without same-named children; '' when absent."""
    attributes = r"(?:\s[^>]*)?" if css_class is None else _with_class(css_class)
    return F.regexp_extract(html, rf"(?is)<{tag}{attributes}>(.*?)</{tag}\s*>", 1)


def nested_block(html: Column, css_class: str) -> Column:
    """Outer HTML of the first ``div`` with a class, inner divs included; '' when absent."""
    tail = F.regexp_extract(html, rf"(?is)<div{_with_class(css_class)}>.*", 0)
    # cut at every opening and closing div, then count until the first is closed
    pieces = F.split(tail, r"(?i)(?=<div[\s>])|(?<=</div>)")

    def step(acc, piece):
        depth = (acc["depth"] + F.rlike(piece, F.lit(r"(?i)^<div[\s>]")).cast("int")
                 - F.rlike(piece, F.lit(r"(?i)</div>$")).cast("int"))
        return F.struct(
            F.when(acc["open"], depth).otherwise(acc["depth"]).alias("depth"),
            (acc["taken"] + acc["open"].cast("int")).alias("taken"),
            (acc["open"] & (depth > 0)).alias("open"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("taken"), F.lit(True).alias("open"))
    taken = F.aggregate(F.filter(pieces, lambda p: p != ""), start, step)["taken"]
    return F.when(tail == "", F.lit("")).otherwise(
        F.array_join(F.slice(F.filter(pieces, lambda p: p != ""), F.lit(1), taken), ""))


def article_title(html: Column) -> Column:
    """Heading inside ``<article>``, else the first heading of the page."""
    inside = F.regexp_extract(html, r"(?is)<article[^>]*>(.*)", 1)
    own = element(inside, "h1")
    return plain_text(F.when(own != "", own).otherwise(element(html, "h1")))


def category_code(badge: Column, labels=tuple(vocab.CATEGORY_LABELS)) -> Column:
    codes = F.create_map(*(F.lit(x) for code, name, _ in labels for x in (name, code)))
    return F.coalesce(F.try_element_at(codes, badge), F.lit(vocab.DEFAULT_CATEGORY))


def extract_pages(pages: DataFrame, as_of, html: str = "html", slug: str = "slug",
                  authors: list[str] | None = None, journal: str = "", url_base: str = "") -> DataFrame:
    """Paper-shaped records of HTML pages, plus slug, body and source link.

    One pass of built-in expressions per page. A page with a slug but no HTML
    comes out with ``problem`` set; see ``plans.load``. Patterns find the
    elements; for pages with comments, scripts or nested elements that mislead
    patterns there is :func:`parse_pages`.
    """
    page = F.col(html)
    link = F.regexp_extract(page, rf"(?is)<a{_with_class('source-link')}>", 0)
    parts = {
        "title": article_title(page),
        "date": F.coalesce(F.nullif(plain_text(element(page, "p", "masthead-date")), F.lit("")),
                           plain_text(element(page, "div", "article-meta"))),
        "lead": plain_text(element(page, "p", "article-lead")),
        "tags": F.transform(F.regexp_extract_all(page, F.lit(rf"(?is)<a{_with_class('tag')}>(.*?)</a\s*>"), 1), plain_text),
        "badge": plain_text(element(page, "span", "cat-badge")),
        "body": nested_block(page, "article-content"),
        "source": F.replace(F.regexp_extract(link, r"(?is)\bhref\s*=\s*[\"']([^\"']*)[\"']", 1), F.lit("&amp;"), F.lit("&")),
    }
    return pages.select(*_record(parts, page, as_of, slug, authors, journal, url_base))


# the elements of an article page, by the names that parse_pages gives them
ARTICLE = {
    "title": Wanted("h1", within="article"), "heading": Wanted("h1"), "date": Wanted("p", "masthead-date"),
    "meta": Wanted("div", "article-meta"), "lead": Wanted("p", "article-lead"), "badge": Wanted("span", "cat-badge"),
    "body": Wanted("div", "article-content", markup=True), "source": Wanted("a", "source-link"), "tag": Wanted("a", "tag", every=True),
}


def parse_pages(pages: DataFrame, as_of, html: str = "html", slug: str = "slug",
                authors: list[str] | None = None, journal: str = "", url_base: str = "") -> DataFrame:
    """The records of :func:`extract_pages`, their elements found by ``markup.elements``.

    The scan runs once a page in Arrow batches; dates, references, labels and
    links are the same columns as there. Absent elements and null pages give
    empty texts; a null page or an absent slug sets ``problem``.
    """
    found = pages.select(F.col(slug).alias("_slug"), F.col(html).isNotNull().alias("_has"),
                         markup.elements(F.col(html), ARTICLE).alias("_found"))

    def text(name: str) -> Column:
        return F.coalesce(_trimmed(resolve_references(markup.first_of(F.col("_found"), name)["text"])), F.lit(""))

    def filled(first: str, second: str) -> Column:
        return F.coalesce(F.nullif(text(first), F.lit("")), text(second))

    href = F.try_element_at(markup.first_of(F.col("_found"), "source")["attributes"], F.lit("href"))
    parts = {
        "title": filled("title", "heading"),
        "date": filled("date", "meta"),
        "lead": text("lead"),
        "tags": F.transform(markup.all_of(F.col("_found"), "tag"), lambda e: _trimmed(resolve_references(e["text"]))),
        "badge": text("badge"),
        "body": F.coalesce(markup.first_of(F.col("_found"), "body")["markup"], F.lit("")),
        "source": F.coalesce(resolve_references(href), F.lit("")),
    }
    return found.select(*_record(parts, F.when(F.col("_has"), ""), as_of, "_slug", authors, journal, url_base))


def _record(parts: dict[str, Column], page: Column, as_of, slug: str, authors: list[str] | None, journal: str,
            url_base: str) -> list[Column]:
    columns = {
        "pmid": F.col(slug),
        "title": parts["title"],
        "abstract": parts["lead"],
        "authors": F.lit(authors or []).cast("array<string>"),
        "journal": F.lit(journal),
        "pub_date": T.page_date(parts["date"], as_of),
        "doi": T.source_ref(parts["source"]),
        "url": F.concat(F.lit(url_base), F.col(slug), F.lit("/")),
        "mesh_terms": parts["tags"],
        "category": category_code(parts["badge"]),
        "evidence_level": F.lit("article"),
        "slug": F.col(slug),
        "body_html": parts["body"],
        "source_url": parts["source"],
        "problem": F.when(page.isNull(), "no html").when(F.col(slug).isNull() | (F.col(slug) == ""), "no slug"),
    }
    return [c.alias(n) for n, c in columns.items()]
