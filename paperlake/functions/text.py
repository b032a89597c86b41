"""Scalar text and date rules as Column expressions."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperlake import vocab


def as_date(as_of) -> Column:
    """``as_of`` given as Column, date or ISO string."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    return F.lit(as_of).cast("date")


def days_before(as_of, days: int) -> Column:
    return F.date_sub(as_date(as_of), days)


def text_of(title="title", abstract="abstract") -> Column:
    """Lower-cased title and abstract, the text all word rules look at."""
    return F.lower(F.concat(F.coalesce(title if isinstance(title, Column) else F.col(title), F.lit("")),
                            F.lit(" "),
                            F.coalesce(abstract if isinstance(abstract, Column) else F.col(abstract), F.lit(""))))


def contains_any(text: Column, words: list[str]) -> Column:
    """True when ``text`` holds one of the words as a substring."""
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words), F.lit(False))


def whole_word(text: Column, word: str) -> Column:
    """``word`` bounded by non-word characters; the default rules use substrings."""
    return F.rlike(text, F.concat(F.lit(r"(?<!\w)\Q"), F.lit(word), F.lit(r"\E(?!\w)")))


def keyword_points(text: Column, high: list[str], medium: list[str], words_only: bool = False) -> Column:
    """Points for every keyword present, counted once each."""
    hit = whole_word if words_only else (lambda t, w: F.contains(t, F.lit(w)))
    parts = [hit(text, w).cast("int") * vocab.HIGH_POINTS for w in high]
    parts += [hit(text, w).cast("int") * vocab.MEDIUM_POINTS for w in medium]
    return reduce(lambda a, b: a + b, parts, F.lit(0))


def _evidence_tests(text: Column) -> list[tuple[Column, str, int]]:
    def has(word):
        return F.contains(text, F.lit(word))

    # Fixed values: (test, label, points), first match wins.
    return [
        (has("meta-analysis") | has("systematic review"), "meta-analysis", 20),
        (has("randomized") & has("controlled"), "RCT", 15),
        (has("guideline"), "guideline", 15),
        (has("clinical trial"), "trial", 10),
        (has("review"), "review", 5),
    ]


def evidence_bonus(text: Column) -> Column:
    chain = F
    for test, _, points in _evidence_tests(text):
        chain = chain.when(test, F.lit(points))
    return chain.otherwise(F.lit(0))


def classify_evidence(text: Column) -> Column:
    """Label form of :func:`evidence_bonus`; NULL when no rule fits."""
    chain = F
    for test, label, _ in _evidence_tests(text):
        chain = chain.when(test, F.lit(label))
    return chain


def recency_bonus(raw_date: Column, as_of, window: int = vocab.RECENCY_DAYS) -> Column:
    """``window`` minus age in days, at least 0; unreadable dates give 0."""
    day = F.try_to_date(F.substring(raw_date.cast("string"), 1, 10), "yyyy-M-d")
    return F.coalesce(F.greatest(F.lit(0), F.lit(window) - F.datediff(as_date(as_of), day)), F.lit(0))


def relevance_score(text: Column, raw_date: Column, as_of, *, high=vocab.HIGH_KEYWORDS,
                    medium=vocab.MEDIUM_KEYWORDS, focus: str = vocab.FOCUS_TERM,
                    words_only: bool = False) -> Column:
    """Keyword, evidence, recency and focus points of one record."""
    return (keyword_points(text, high, medium, words_only)
            + evidence_bonus(text)
            + recency_bonus(raw_date, as_of)
            + F.contains(text, F.lit(focus)).cast("int") * vocab.FOCUS_POINTS)


def polarity_flags(text: Column, positive=vocab.POSITIVE_WORDS, negative=vocab.NEGATIVE_WORDS):
    return contains_any(text, positive), contains_any(text, negative)


def polarity_score(pos1: Column, neg1: Column, pos2: Column, neg2: Column) -> Column:
    """0.5 for each direction of disagreement, less 0.2 for shared praise, floor 0."""
    raw = ((pos1 & neg2).cast("double") * 0.5
           + (neg1 & pos2).cast("double") * 0.5
           - (pos1 & pos2 & ~neg1 & ~neg2).cast("double") * 0.2)
    return F.greatest(F.lit(0.0), raw)


def slug(title: Column) -> Column:
    dashed = F.regexp_replace(F.lower(title), "[^a-z0-9-]+", "-")
    return F.btrim(F.substring(dashed, 1, 60), F.lit("-"))


def read_minutes(body: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(body) / 500).cast("int"))


def page_date(text: Column, as_of) -> Column:
    """Date a page text starts with, in one of three notations, else ``as_of``."""
    found = [F.regexp_extract(text, pattern, 0) for pattern in
             (r"^\d{4}-\d{1,2}-\d{1,2}", r"^\d{4}年\d{1,2}月\d{1,2}日", r"^\d{4}/\d{1,2}/\d{1,2}")]
    formats = ("yyyy-M-d", "yyyy'年'M'月'd'日'", "yyyy/M/d")
    return F.coalesce(*(F.try_to_date(t, f) for t, f in zip(found, formats)), as_date(as_of))


def source_ref(url: Column) -> Column:
    """DOI, or ``PMID:`` and number, taken from a source link; else ''."""
    last = F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)
    return (F.when(F.contains(url, F.lit("doi.org")), F.element_at(F.split(url, r"doi\.org/"), -1))
            .when(F.contains(url, F.lit("pubmed.ncbi.nlm.nih.gov")), F.concat(F.lit("PMID:"), last))
            .otherwise(F.lit("")))


def embedding_text(title: Column, abstract: Column, terms: Column, category: Column) -> Column:
    """The labelled parts that are present, blank lines between them."""
    def part(label, value, present):
        return F.when(present, F.concat(F.lit(label), value))

    return F.concat_ws(
        "\n\n",
        part("Title: ", title, title != ""),
        part("Abstract: ", abstract, abstract != ""),
        part("Keywords: ", F.array_join(terms, ", "), F.size(terms) > 0),
        part("Category: ", category, category != ""),
    )


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def iso_episode(day: Column) -> Column:
    return F.weekofyear(day)


def prefix(value: Column, chars: int) -> Column:
    return F.substring(value, 1, chars)


def fill_template(template: str, *, title: Column, abstract: Column, journal: Column, date: Column,
                  doi: Column, url: Column, tags: Column, episode: Column,
                  abstract_chars: int = 3000) -> Column:
    """Put one record into a prompt template, placeholder after placeholder."""
    def text(value):
        return F.coalesce(value.cast("string"), F.lit(""))

    abstract = prefix(text(abstract), abstract_chars)
    values = {
        "{paper_title}": text(title),
        "{paper_abstract[:3000]}": abstract,
        "{paper_abstract}": abstract,
        "{paper_journal}": text(journal),
        "{paper_date}": text(date),
        "{paper_doi}": text(doi),
        "{paper_url}": text(url),
        "{paper_tags}": F.coalesce(F.array_join(tags, ", "), F.lit("")),
        "{episode}": text(episode),
    }
    return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), kv[1]), values.items(), F.lit(template))
