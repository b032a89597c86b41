"""Repeated passages by hashes of windows, in place of longest previous factors from a suffix order.

No suffix order and no factor lengths are computed; in terms of suffixes, this
is why the passages are the same:

Texts are byte strings; a suffix stands for the position it starts at, and
positions are ordered by (doc_id, byte). Suffixes are compared to a depth of
``length`` bytes, the shortest passage of interest; suffixes that agree so far
tie and are ordered by position. In this order the previous smaller position
of a suffix is the row before it if that row agrees, the next smaller position
lies beyond the interval and agrees on less, so the longest previous factor
reaches ``length`` exactly when an interval holds an earlier position. The
union of the passages found at that depth is the union of the full factors,
since the factor of a following position is at most one byte shorter.

Sorting all suffixes would move the text two hundred times over. Instead:

* Every window of ``length`` bytes has an anchor, the least hash of a
  ``gram`` inside it. Equal windows have equal anchors, so windows of one
  anchor (a *run*) are handled as one suffix interval, about one per
  50 bytes, and a run whose anchor is unique is dropped at once.
* Runs of equal content form an interval as a whole. Only where one anchor has
  runs of different content (at the borders of copies) one run of each content
  is opened into its windows.
* Intervals are aggregates by name (a minimum and a count), so no interval,
  however long, is gathered or sorted in one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.runtime import cut_lineage

from . import bitmaps
from . import bytesops as B

LENGTH = 200
GRAM = 96
_NO_ID = -(1 << 63)
_U = np.uint64

RUNS = "doc bigint, h bigint, start int, n int, anchor bigint, name bigint"


def anchored_runs(data, offsets, powers, length: int, gram: int):
    """Runs of windows with one anchor: (text, first start, windows, hash of the anchor, hash of the content)."""
    size, width = len(data), length - gram + 1
    starts = size - length + 1
    if starts <= 0:
        return None
    sums = B.prefix_hash(data, powers)
    grams = size - gram + 1
    hashes = B.mix((sums[gram:] - sums[:grams]) * powers.down[:grams])
    # order by hash, then by place: the low bits hold the place
    bits = _U(int(size).bit_length())
    keys = np.full(-(-grams // width) * width, ~_U(0))
    keys[:grams] = (hashes >> bits << bits) | np.arange(grams, dtype=np.uint64)
    table = keys.reshape(-1, width)
    before = np.minimum.accumulate(table, axis=1).ravel()
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[:starts], before[width - 1:width - 1 + starts])
    at = np.flatnonzero(np.arange(starts) + length <= np.repeat(offsets[1:], np.diff(offsets))[:starts])
    if not len(at):
        return None
    anchor = (least[at] & ((_U(1) << bits) - _U(1))).astype(np.int64)
    text = np.searchsorted(offsets, at, side="right") - 1
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    low, high = at[first], at[last]
    names = B.span_hash(sums, low, high + length, powers)
    return text[first], low, high - low + 1, hashes[anchor[first]], names


def _runs(length: int, gram: int, bitmap=None, only_anchor: bool = False):
    def run(batches):
        powers = B.Powers()
        for batch in batches:
            for rows, data, offsets in B.pieces(batch):
                found = anchored_runs(data, offsets, powers, length, gram)
                if found is None:
                    continue
                text, low, n, anchor, names = found
                keep = slice(None) if bitmap is None else bitmaps.holds(bitmap, B.signed(anchor))
                text, low, n, anchor, names = (x[keep] for x in (text, low, n, anchor, names))
                if only_anchor:
                    yield pa.RecordBatch.from_arrays([pa.array(B.signed(anchor))], names=["anchor"])
                    continue
                doc = rows.column("doc").to_numpy(zero_copy_only=False)[text]
                h = rows.column("h").to_numpy(zero_copy_only=False)[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc), pa.array(h), pa.array((low - offsets[text]).astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array(B.signed(anchor)), pa.array(B.signed(names))],
                    names=["doc", "h", "start", "n", "anchor", "name"])

    return run


def _opened(length: int, bitmap=None):
    """Windows of the listed runs: their names, or (for names in the bitmap) names and places."""
    def run(batches):
        powers = B.Powers()
        for batch in batches:
            for rows, data, offsets in B.pieces(batch):
                sums = B.prefix_hash(data, powers)
                for i, (doc, h, runs) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("doc", "h", "runs")))):
                    at = np.unique(np.concatenate([np.arange(r["start"], r["start"] + r["n"]) for r in runs]))
                    names = B.signed(B.span_hash(sums, at + offsets[i], at + offsets[i] + length, powers))
                    if bitmap is None:
                        yield pa.RecordBatch.from_arrays([pa.array(names)], names=["name"])
                        continue
                    keep = bitmaps.holds(bitmap, names)
                    k = int(keep.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, doc, dtype=np.int64)), pa.array(np.full(k, h, dtype=np.int64)),
                         pa.array(at[keep].astype(np.int32)), pa.array(names[keep])], names=["doc", "h", "start", "name"])

    return run


def repeated_spans(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Passages with a match elsewhere: (doc, h, start, size, earlier).

    ``earlier`` says whether a match lies before the passage. Rows are whole
    runs or single windows and overlap.
    """
    anchors = (texts.mapInArrow(_runs(length, gram, only_anchor=True), "anchor bigint").groupBy("anchor")
               .agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("anchor"))
    anchors = cut_lineage(anchors, "anchors")
    runs = texts.mapInArrow(_runs(length, gram, bitmaps.gather(anchors, "anchor")), RUNS)
    runs = cut_lineage(runs.join(anchors, "anchor"), "runs")

    place = F.struct("doc", "h", "start")
    intervals = runs.groupBy("name", "anchor").agg(
        F.count(F.lit(1)).alias("times"), F.min(place).alias("first"), F.min("n").alias("n"))
    intervals = cut_lineage(intervals, "intervals")
    whole = (runs.join(intervals.filter("times > 1").select("name", "first"), "name")
             .select("doc", "h", "start", (F.col("n") + (length - 1)).alias("size"), (place > F.col("first")).alias("earlier")))

    several = (intervals.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1").select("anchor"))
    opened = (intervals.join(several, "anchor").select("first.doc", "first.h", "first.start", "n")
              .groupBy("doc", "h").agg(F.collect_list(F.struct("start", "n")).alias("runs")))
    opened = cut_lineage(opened, "opened")
    wanted = bitmaps.gather(opened.select(F.xxhash64("doc", "h").alias("k")), "k")

    def only_wanted(batches):
        for batch in batches:
            keep = bitmaps.holds(wanted, batch.column("k").to_numpy())
            yield batch.select(["doc", "h", "text"]).filter(pa.array(keep))

    held = texts.withColumn("k", F.xxhash64("doc", "h")).mapInArrow(only_wanted, "doc bigint, h bigint, text string")
    held = cut_lineage(held.join(opened, ["doc", "h"]).select("doc", "h", "text", "runs"), "texts")
    names = (held.mapInArrow(_opened(length), "name bigint").groupBy("name")
             .agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("name"))
    names = cut_lineage(names, "names")
    windows = (held.mapInArrow(_opened(length, bitmaps.gather(names, "name")), "doc bigint, h bigint, start int, name bigint")
               .join(names, "name"))
    windows = cut_lineage(windows, "windows")
    firsts = windows.groupBy("name").agg(F.min(place).alias("first"))
    single = windows.join(firsts, "name").select("doc", "h", "start", F.lit(length).alias("size"),
                                                 (place > F.col("first")).alias("earlier"))
    return whole.unionByName(single)


def _cut(batches):
    """Removes the spans; spans of a row are merged, overlapping and touching ones become one."""
    for batch in batches:
        for rows, data, offsets in B.pieces(batch):
            out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "starts", "ends", "kept", "sha")}
            for i, spans in enumerate(rows.column("spans").to_pylist()):
                body = data[offsets[i]:offsets[i + 1]]
                gone = np.zeros(len(body) + 1, dtype=np.int32)
                if spans:
                    s = np.array([x["start"] for x in spans])
                    np.add.at(gone, s, 1)
                    np.add.at(gone, s + [x["size"] for x in spans], -1)
                covered = np.cumsum(gone)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
                kept = body[~covered].tobytes()
                out["n_bytes"].append(len(body)), out["n_removed"].append(int(covered.sum())), out["n_spans"].append(len(edge) // 2)
                out["starts"].append(edge[0::2].astype(np.int32)), out["ends"].append(edge[1::2].astype(np.int32))
                out["kept"].append(kept), out["sha"].append(hashlib.sha256(kept).hexdigest())
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *(pa.array(v, type=t) for v, t in zip(out.values(), kinds))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "starts", "ends", "kept", "kept_sha256"])


CUT = ("doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, starts array<int>, ends array<int>, "
       "kept binary, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: str = "first") -> DataFrame:
    """Texts of ``docs`` (doc_id, text) without passages of ``length`` bytes or more that occur elsewhere.

    With ``keep="first"`` the first occurrence (by doc_id, then position)
    stays; with ``keep="none"`` all go. Returns one row per input row: doc_id,
    n_bytes, n_removed, n_spans, the removed spans (``starts``, ``ends``), the
    remaining bytes ``kept`` and their ``kept_sha256``. Cuts may fall inside a
    UTF-8 character, so ``kept`` is binary.

    A null text is an empty one. Rows without doc_id come before all others.
    Rows of the same doc_id are matched with each other like any two rows;
    rows equal in doc_id and text are one place under ``keep="first"`` and so
    both keep their first occurrence, and are copies of each other under
    ``keep="none"``. Texts shorter than ``length`` stay whole. Extra columns
    are ignored. Windows are named by 64-bit hashes.
    """
    if keep not in ("first", "none"):
        raise ValueError(f"keep must be 'first' or 'none', not {keep!r}")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"), F.xxhash64("text").alias("h"), "text")
    spans = repeated_spans(texts.select("doc", "h", "text"), length, gram)
    if keep == "first":
        spans = spans.filter("earlier")
    spans = spans.groupBy("doc", "h").agg(F.collect_set(F.struct("start", "size")).alias("spans"))
    return texts.join(spans, ["doc", "h"], "left").select("doc_id", "text", "spans").mapInArrow(_cut, CUT)
