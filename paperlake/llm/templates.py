"""Benchmark decontamination by templates.

Texts become sequences of words in which numbers, names and units are typed
placeholders: a token that begins with a digit is a number, a capitalised
token inside a sentence is a name, a token of ``UNITS`` after a number is a
unit. Windows of ``WINDOW`` tokens of a document and of a benchmark item are
joined by hash, as templates and once more as plain lower-case words (which
find verbatim copies even where names lost their capitals). Hits with one
offset between document and item belong together; their placeholders must be
filled consistently, each value of the item by one value of the document. A
question with other numbers or names is thereby found, while a text that only
shares the form and mixes the values is not. The same is done on two shorter
sequences, in which a number with its marks (1,250 or 3.5) and a run of
capitalised words are one placeholder each; in the second the word that opens
a sentence may be a name too. With ``verbatim`` so many tokens
in plain windows are enough by themselves, whatever the slots beside them say.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.runtime import cut_lineage

from . import bitmaps
from . import bytesops as B
from .toxicity import sentence_words

WINDOW = 8
MIN_LITERAL = 4  # tokens of a template window that are not placeholders
MIN_TOKENS = 10
_NO_ID = -(1 << 63)
UNITS = ("mm cm m km in ft yd mi mg g kg t lb oz ml l gal s sec min h hr hours minutes seconds days weeks months years "
         "percent pct kmh mph usd eur dollars euros cents degrees celsius kelvin w kw kwh j kj cal hz khz mhz ghz kb mb gb tb")
_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (0x1D8E4E27C47D124F, 0x2545F4914F6CDD1D, 0x369DEA0F31A53F85))
_U = np.uint64

RAW, WHOLE, OPENERS = 0, 1, 2  # sequences: single tokens, whole numbers and names, the same with names as openers
HITS = "doc bigint, h bigint, kind int, pos int, name bigint, slots array<bigint>"


def _unit_hashes(powers) -> np.ndarray:
    out = []
    for unit in UNITS.split():
        data = np.frombuffer(unit.encode(), dtype=np.uint8)
        out.append(B.word_hashes(data, np.array([0]), np.array([len(data)]), powers)[0])
    return np.array(out, dtype=np.uint64)


def tokens_in(data, offsets, powers):
    """(sentence, text, first and end byte of every token, sums for their hashes)."""
    return *sentence_words(data, offsets, powers)[1:], B.prefix_hash(data, powers, B.BYTE_VALUES[B.LOWER])


def canonical(data, tokens, powers, units: np.ndarray):
    """Word hashes, template hashes (placeholders for slots), slot marks and text of every token."""
    sentence, text, starts, ends, sums = tokens
    words = B.span_hash(sums, starts, ends, powers)
    if not len(words):
        return words, words, np.zeros(0, dtype=bool), text
    lead = data[starts]
    opens = np.concatenate([[True], sentence[1:] != sentence[:-1]])
    number = (lead >= 48) & (lead <= 57)
    name = (lead >= 65) & (lead <= 90) & ~opens
    after = np.concatenate([[False], number[:-1]]) & ~opens
    unit = np.isin(words, units) & after
    template = np.where(number, _NUMBER, np.where(name, _NAME, np.where(unit, _UNIT, words)))
    return words, template, number | name | unit, text


def whole_slots(data, tokens, powers, units: np.ndarray, openers: bool):
    """As ``canonical``, with whole numbers and whole runs of capitalised words as one token each."""
    sentence, text, starts, ends, sums = tokens
    if not len(starts):
        none = np.zeros(0, dtype=np.uint64)
        return none, none, np.zeros(0, dtype=bool), text
    lead, gap = data[starts], data[np.minimum(ends[:-1], len(data) - 1)]
    number, capital = (lead >= 48) & (lead <= 57), (lead >= 65) & (lead <= 90)
    beside = (starts[1:] - ends[:-1] == 1) & (text[1:] == text[:-1])
    digit = (data[ends[:-1] - 1] >= 48) & (data[ends[:-1] - 1] <= 57)
    more = np.concatenate([[False], beside & ((gap == 46) | (gap == 44)) & number[:-1] & number[1:] & digit])
    opens = np.concatenate([[True], sentence[1:] != sentence[:-1]]) & ~more
    name = capital if openers else capital & ~opens
    more[1:] |= beside & (gap == 32) & name[:-1] & name[1:] & ~opens[1:]
    head = np.flatnonzero(~more)
    words = B.span_hash(sums, starts[head], ends[np.append(head[1:], len(starts)) - 1], powers)
    number, name, opens = number[head], name[head], opens[head]
    unit = np.isin(words, units) & np.concatenate([[False], number[:-1]]) & ~opens
    template = np.where(number, _NUMBER, np.where(name, _NAME, np.where(unit, _UNIT, words)))
    return words, template, number | name | unit, text[head]


def windows_of(data, offsets, powers, units, width: int, min_literal: int):
    """(kind, text, position, name, place, (words, slots)) of all windows, the last two None for plain ones.

    A text shorter than a window is one plain window.
    """
    tokens = tokens_in(data, offsets, powers)
    words, template, slot, text = canonical(data, tokens, powers, units)
    count = np.bincount(text, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    short = [(i, int(first[i]), int(count[i])) for i in np.flatnonzero((count > 0) & (count < width))]
    n = len(words) - width + 1
    if n > 0:
        at = np.flatnonzero(text[:n] == text[width - 1:width - 1 + n])
        plain = B.windows(words, width)[at]
        typed = B.windows(template, width)[at] ^ _U(0x5851F42D4C957F2D)
        marks = np.concatenate([[0], np.cumsum(slot)])
        slots = (marks[width:] - marks[:-width])[at]
        usable = (slots > 0) & (width - slots >= min_literal)
        yield RAW, text[at], at - first[text[at]], plain, None, None
        yield RAW, text[at][usable], (at - first[text[at]])[usable], typed[usable], at[usable], (words, slot)
    for i, start, k in short:
        name = B.windows(words[start:start + k], k)
        yield RAW, np.array([i]), np.array([0]), name, None, None
    for kind in (WHOLE, OPENERS):
        words, template, slot, text = whole_slots(data, tokens, powers, units, kind == OPENERS)
        n = len(words) - width + 1
        if n <= 0:
            continue
        count = np.bincount(text, minlength=len(offsets) - 1)
        first = np.concatenate([[0], np.cumsum(count)])[:-1]
        marks = np.concatenate([[0], np.cumsum(slot)])
        at = np.flatnonzero((text[:n] == text[width - 1:]) & (width - (marks[width:] - marks[:-width]) >= min_literal))
        name = B.windows(template, width)[at] ^ _U(0x14057B7EF767814F * kind)
        yield kind, text[at], at - first[text[at]], name, at, (words, slot)


def _windows(width: int, min_literal: int, bitmap, id_columns):
    def run(batches):
        powers = B.Powers()
        units = _unit_hashes(powers)
        for batch in batches:
            for rows, data, offsets in B.pieces(batch):
                ids = [rows.column(c).to_numpy(zero_copy_only=False) for c in id_columns]
                for kind, text, pos, name, at, held in windows_of(data, offsets, powers, units, width, min_literal):
                    keep = slice(None) if bitmap is None else bitmaps.holds(bitmap, B.signed(name))
                    text, pos, name = text[keep], pos[keep], name[keep]
                    if not len(text):
                        continue
                    if at is None:
                        slots = [[]] * len(text)
                    else:
                        words, slot = held
                        slots = [B.signed(words[i:i + width][slot[i:i + width]]) for i in at[keep]]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(x[text]) for x in ids), pa.array(np.full(len(text), kind, dtype=np.int32)), pa.array(pos.astype(np.int32)), pa.array(B.signed(name)),
                         pa.array(slots, type=pa.list_(pa.int64()))], names=[*id_columns, "kind", "pos", "name", "slots"])

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """A key for every row that also tells rows without doc_id apart by their text."""
    return docs.withColumns({"_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)),
                             "_h": F.xxhash64(F.coalesce("text", F.lit("")))})


def contaminations(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, min_literal: int = MIN_LITERAL,
                   min_tokens: int = MIN_TOKENS, verbatim: int | None = None) -> DataFrame:
    """(doc, h, item_id, n_tokens, changed): items found in rows of ``docs`` (see ``keyed`` for doc and h).

    An item is found where windows on one offset cover ``min_tokens`` tokens
    (or the whole of a shorter item) with consistent slots, or where plain
    windows alone cover ``verbatim`` tokens (if given). ``changed`` says
    that some slot has another value than in the item.
    """
    items = (benchmark.filter("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
             .mapInArrow(_windows(width, min_literal, None, ["item_id"]), "item_id bigint, kind int, pos int, name bigint, slots array<bigint>"))
    items = cut_lineage(items.select("item_id", "kind", F.col("pos").alias("item_pos"), "name", F.col("slots").alias("item_slots")).distinct(), "items")
    ends = items.groupBy("item_id", "kind").agg((F.max("item_pos") + 1).alias("n_windows"))
    bitmap = bitmaps.gather(items, "name")
    texts = keyed(docs).select(F.col("_doc").alias("doc"), F.col("_h").alias("h"), "text")
    hits = (texts.mapInArrow(_windows(width, min_literal, bitmap, ["doc", "h"]), HITS).join(items, ["name", "kind"])
            .select("doc", "h", "item_id", "kind", (F.col("pos") - F.col("item_pos")).alias("offset"), "item_pos", "slots", "item_slots"))
    hits = cut_lineage(hits.distinct(), "hits")
    place = ["doc", "h", "item_id", "kind", "offset"]
    slots = (hits.select(*place, F.explode(F.arrays_zip("item_slots", "slots")).alias("s"))
             .groupBy(*place, "s.item_slots").agg(F.count_distinct("s.slots").alias("values"),
                                                  F.max(F.col("s.slots") != F.col("s.item_slots")).alias("changed"))
             .groupBy(*place).agg((F.max("values") > 1).alias("mixed"), F.max("changed").alias("changed")))
    # of single tokens, only template windows carry slots
    runs = hits.groupBy(*place).agg(F.count_distinct("item_pos").alias("windows"),
                                    F.count_distinct(F.when((F.col("kind") == RAW) & (F.size("slots") == 0), F.col("item_pos"))).alias("plain"))

    def enough(windows: str, tokens: int):
        return F.col(windows) >= F.least(F.lit(tokens - width + 1), F.col("n_windows"))

    runs = runs.join(slots, place, "left").join(ends, ["item_id", "kind"]).withColumn("whole", F.coalesce(~F.col("mixed"), F.lit(True)))
    found = F.col("whole") & enough("windows", min_tokens)
    found = runs.filter(found if verbatim is None else found | enough("plain", verbatim)).withColumn(
        "windows", F.when(F.col("whole"), F.col("windows")).otherwise(F.col("plain")))
    return found.groupBy("doc", "h", "item_id").agg(
        (F.max("windows") + (width - 1)).alias("n_tokens"), F.max(F.coalesce("changed", F.lit(False))).alias("changed"))


def judge(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, contaminated, n_items, item_id, n_tokens, changed.

    ``item_id`` is the item with most tokens found (the smallest id on ties)
    and n_tokens its tokens; both null for clean rows. Null and empty texts
    are clean; rows without doc_id and repeated rows are judged by their text.
    Benchmark rows without item_id or words match nothing. An empty benchmark
    leaves all rows clean. Extra columns are ignored.
    """
    found = contaminations(docs, benchmark, **kw).groupBy("doc", "h").agg(
        F.count(F.lit(1)).alias("n_items"), F.max("changed").alias("changed"),
        F.max_by(F.struct("item_id", "n_tokens"), F.struct(F.col("n_tokens"), -F.col("item_id"))).alias("best"))
    rows = keyed(docs).select("doc_id", F.col("_doc").alias("doc"), F.col("_h").alias("h"))
    return rows.join(found, ["doc", "h"], "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.col("best.item_id").alias("item_id"), F.col("best.n_tokens").cast("long").alias("n_tokens"),
        F.coalesce("changed", F.lit(False)).alias("changed"))


def remove(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    found = cut_lineage(contaminations(docs, benchmark, **kw).select("doc", "h").distinct(), "leaks")
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "doc_id", "text")
    return (keyed(row).join(found, (F.col("_doc") == F.col("doc")) & (F.col("_h") == F.col("h")), "left_anti").select("_row.*"))
