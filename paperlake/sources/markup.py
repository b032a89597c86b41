"""Elements of HTML texts, found by a scan over tags with a stack of open elements.

Patterns over whole pages (``sources.pages``) take the first closing tag for the
end of an element and any ``>`` for the end of a tag. This scan skips comments
and the contents of scripts, reads quoted attributes whole and knows which
element a closing tag belongs to. It runs in Arrow batches, one pass a page.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# shipped to workers by value, as the kernels are
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# fixed values of HTML: elements without an end tag, elements whose content holds no tags
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
SILENT = frozenset("script style".split())
# an opening tag of these ends an open element of the group when that is the innermost one
ENDS = {"li": {"li", "p"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}}
# an opening tag of these ends the open paragraph, unless one of the walls was opened in it
BLOCKS = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul""".split())
WALLS = frozenset("applet button caption html marquee object table td template th".split())

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)|[^>=]++)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")

FOUND = "array<struct<name: string, text: string, markup: string, attributes: map<string, string>>>"
_FOUND = pa.list_(pa.struct([("name", pa.string()), ("text", pa.string()), ("markup", pa.string()),
                             ("attributes", pa.map_(pa.string(), pa.string()))]))


@dataclass(frozen=True)
class Wanted:
    """Elements to report: a tag, optionally with a class, inside an element with the tag ``within``.

    ``every`` reports all of them, else the first. ``markup`` adds the source
    text from the opening tag to the end tag.
    """

    tag: str
    css_class: str | None = None
    within: str | None = None
    every: bool = False
    markup: bool = False


def tags(html: str):
    """(start, end, closing, name, attributes) of every tag; ``start`` to ``end`` of what is no text has no name.

    A tag that is never closed by ``>`` and a comment without an end reach to
    the end of the text. A ``<`` that opens nothing is text.
    """
    at, raw = 0, ""
    while (start := html.find("<", at)) >= 0:
        if raw:
            close = re.compile(rf"</{raw}(?=[\s/>])", re.I).search(html, start)
            start = close.start() if close else len(html)
            if raw in SILENT:
                yield at, start, False, "", ""
            raw = ""
            if not close:
                return
        if html.startswith("<!--", start):
            end = html.find("-->", start + 2)
            at = len(html) if end < 0 else end + 3
            yield start, at, False, "", ""
        elif html.startswith(("<!", "<?"), start):
            end = html.find(">", start)
            at = len(html) if end < 0 else end + 1
            yield start, at, False, "", ""
        elif tag := _TAG.match(html, start):
            closing, name, at = tag[1] == "/", tag[2].lower(), tag.end()
            raw = name if name in RAW and not closing else ""
            yield start, at, closing, name, tag[3]
        elif re.match("</?[A-Za-z]", html[start:start + 3]):
            yield start, len(html), False, "", ""
            return
        else:
            at = start + 1
    if raw in SILENT:
        yield at, len(html), False, "", ""


def attributes(source: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name; the first of a name counts, one without a value is empty."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), "".join(values))
    return out


def find_elements(html: str, wanted: dict[str, Wanted]) -> list[dict]:
    """What ``wanted`` asks for, by start in ``html``. Each tag is pushed and popped once."""
    selectors: dict[str, list] = {}
    for name, w in wanted.items():
        selectors.setdefault(w.tag, []).append((name, w))
    found, done = [], set()
    stack, open_count, texts, at = [], Counter(), [], 0
    paragraphs = [0]  # open ones, behind each open wall

    def pop(end: int):
        name, records = stack.pop()
        open_count[name] -= 1
        if name in WALLS:
            paragraphs.pop()
        elif name == "p":
            paragraphs[-1] -= 1
        for record, w, first, start in records:
            record["text"] = "".join(texts[first:])
            record["markup"] = html[start:end] if w.markup else None

    for start, end, closing, name, source in tags(html):
        if start > at:
            texts.append(html[at:start])
        at = end
        if not name:
            continue
        if closing:
            # an end tag without its element means nothing; one with it ends all elements opened inside
            if open_count[name]:
                while stack[-1][0] != name:
                    pop(start)
                pop(end)
            continue
        while name in BLOCKS and paragraphs[-1]:
            pop(start)
        while stack and stack[-1][0] in ENDS.get(name, ()):
            pop(start)
        records, values = [], None
        for key, w in selectors.get(name, ()):
            if key in done or w.within and not open_count[w.within]:
                continue
            values = attributes(source) if values is None else values
            if w.css_class and w.css_class not in values.get("class", "").split():
                continue
            record = {"name": key, "text": "", "markup": html[start:end] if w.markup else None, "attributes": list(values.items())}
            found.append(record)
            records.append((record, w, len(texts), start))
            if not w.every:
                done.add(key)
        if name not in VOID:
            stack.append((name, records))
            open_count[name] += 1
            if name in WALLS:
                paragraphs.append(0)
            elif name == "p":
                paragraphs[-1] += 1
    if at < len(html):
        texts.append(html[at:])
    while stack:
        pop(len(html))
    return found


def elements(html: Column, wanted: dict[str, Wanted]) -> Column:
    """Array of the wanted elements of a page in the order of their opening tags.

    ``text`` is the text inside without tags, comments, scripts and styles; references
    in it and in attributes are left as they are (``pages.resolve_references``). A
    null page has no elements. Elements that are still open end with the text.
    A wanted element inside another one is reported too, so its text comes in both.
    """
    def run(column: pa.Array) -> pa.Array:
        return pa.array([find_elements(v, wanted) if v else [] for v in column.to_pylist()], type=_FOUND)

    return F.arrow_udf(run, FOUND)(html)


def all_of(found: Column, name: str) -> Column:
    """The elements of one name among ``found``."""
    return F.filter(found, lambda e: e["name"] == name)


def first_of(found: Column, name: str) -> Column:
    """The first element of one name, null when there is none."""
    return F.get(all_of(found, name), F.lit(0))
