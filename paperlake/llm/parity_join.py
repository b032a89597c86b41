"""Similar documents by a join of parity sketches over sets of word shingles.

The set of a document is split by hash into parts; the sketch of a part is the
exclusive-or of the hashes in it. A token that is in only one of two sets
changes at most one part, so the number of differing parts bounds the
symmetric difference from below. Two sets of sizes n <= m with a Jaccard
similarity of 4/5 or more differ in at most (n + m) / 9 <= n / 4 tokens.

* Size band j holds pairs whose smaller set has 2^j to 2^(j+1) - 1 tokens;
  a set works in the bands of its own size and of four fifths of it. All sets
  of a band are split in the same way.
* Pigeonhole: with D the most tokens that may differ, walk the parts that are
  not empty in a fixed order. Before the first part that two linked sets have
  in common, each has at most D others, so the first D + 1 parts of both hold
  it, and an equi-join on (band, part, sketch) finds the pair.
* Sets with no more than D parts in use (a chance of hash, tiny sets only) add
  their empty parts; two of them then meet there.
* A finer sketch with one parity bit per hash value, as many bits as tokens,
  drops most false candidates by its Hamming distance; the rest is verified
  on the texts.

Only components are wanted, so a group that shares a part is not expanded
into pairs: members are compared with a few pivots first, linked members fall
together, and only what is still apart is compared in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperlake.operators.cells import to_cells
from paperlake.runtime import cut_lineage

from . import bitmaps
from . import bytesops as B
from .graph import components

WORDS = 5
PERCENT = 80
PIVOT_ROUNDS = 3
BLOCK_ROWS = 256
LOW_KEYS = 16
_SEEN = 200_000  # set ids a task remembers so as not to send a copy's sketches again

SIGNATURES = "doc_id bigint, n int, set_id bigint, bits binary, keys array<bigint>"


def shingle_sets(data, offsets, powers, width: int = WORDS):
    """For each text of a piece its distinct shingle hashes, sorted."""
    starts, ends, doc = B.word_bounds(data, offsets)
    words = B.word_hashes(data, starts, ends, powers)
    grams = B.windows(words, width)
    count = np.bincount(doc, minlength=len(offsets) - 1) if len(doc) else np.zeros(len(offsets) - 1, dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(count)])
    for i in range(len(offsets) - 1):
        n, at = int(count[i]), int(first[i])
        if n >= width:
            yield np.unique(grams[at:at + n - width + 1])
        elif n:
            yield B.windows(words[at:at + n], n)
        else:
            yield np.zeros(0, dtype=np.uint64)


def parity_bits(values: np.ndarray) -> np.ndarray:
    """One parity bit per hash value; the number of bits is the next power of two of the set size, 64 at least.

    Sketches of different sizes are folded to the smaller one before they are
    compared, which keeps the bound.
    """
    bits = max(64, 1 << (len(values) - 1).bit_length()) if len(values) else 64
    flips = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little")


def part_keys(values: np.ndarray) -> np.ndarray:
    """Join keys of a set: band, part and sketch in 64 bits."""
    n = len(values)
    if n < 4:  # a link needs equal sets
        return np.zeros(0, dtype=np.uint64)
    most = n // 4
    out = []
    for band in sorted({n.bit_length() - 1, (-(-4 * n // 5)).bit_length() - 1}):
        if band < 2:
            continue
        bits = band + 1 if band <= 3 else band
        part = (values >> np.uint64(64 - bits)).astype(np.int64)  # values are sorted, so parts come in order
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sketch, used = np.bitwise_xor.reduceat(values, cuts), part[cuts].astype(np.uint64)
        if len(used) <= most:
            empty = np.setdiff1d(np.arange(1 << bits, dtype=np.uint64), used)
            used, sketch = np.concatenate([used, empty]), np.concatenate([sketch, np.zeros(len(empty), dtype=np.uint64)])
        else:
            used, sketch = used[:most + 1], sketch[:most + 1]
        out.append(B.mix(sketch + B.mix(used * np.uint64(64) + np.uint64(band))))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def set_id(values: np.ndarray) -> int:
    """64-bit name of a set; any two of N different sets get one name with a chance of N^2 / 2^65."""
    if not len(values):
        return 0
    total = np.add.reduce(B.mix(values ^ np.uint64(0xA0761D6478BD642F)))
    return int((B.mix(np.array([total ^ np.uint64(len(values))], dtype=np.uint64)) | np.uint64(1)).view(np.int64)[0])


def _signatures(width: int):
    def run(batches):
        powers, seen = B.Powers(), set()
        for batch in batches:
            for rows, data, offsets in B.pieces(batch):
                sizes, ids, bits, keys = [], [], [], []
                for doc_id, values in zip(rows.column("doc_id").to_pylist(), shingle_sets(data, offsets, powers, width)):
                    name = set_id(values)
                    sizes.append(len(values)), ids.append(name)
                    if name in seen or not len(values) or doc_id is None:
                        bits.append(None), keys.append(None)
                        continue
                    seen = seen if len(seen) < _SEEN else set()
                    seen.add(name)
                    bits.append(parity_bits(values).tobytes())
                    keys.append(B.signed(part_keys(values)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(sizes, type=pa.int32()), pa.array(ids, type=pa.int64()),
                     pa.array(bits, type=pa.binary()), pa.array(keys, type=pa.list_(pa.int64()))],
                    names=["doc_id", "n", "set_id", "bits", "keys"])

    return run


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    while len(bits) > size:
        bits = bits[:len(bits) // 2] ^ bits[len(bits) // 2:]
    return bits


def may_link(n: int, x: bytes, m: int, y: bytes) -> bool:
    """Whether sizes and sketches leave a similarity of 4/5 possible."""
    if 5 * min(n, m) < 4 * max(n, m):
        return False
    x, y = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
    size = min(len(x), len(y))
    return int(np.bitwise_count(fold(x, size) ^ fold(y, size)).sum()) <= (n + m) // 9


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _filter_pairs(batches):
    for batch in batches:
        c = batch.to_pydict()
        keep = [may_link(*row) for row in zip(c["na"], c["bits_a"], c["nb"], c["bits_b"])]
        yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))


def _listed(bitmap: np.ndarray):
    """Rows whose hash ``k`` is in the bitmap: most of those that the join after it would drop are not shuffled."""
    def run(batches):
        for batch in batches:
            yield batch.drop_columns(["k"]).filter(pa.array(bitmaps.holds(bitmap, batch.column("k").to_numpy())))

    return run


def _verify(width: int):
    def sets(batch, name, powers):
        for _, data, offsets in B.pieces(batch, name):
            yield from shingle_sets(data, offsets, powers, width)

    def run(batches):
        powers = B.Powers()
        for batch in batches:
            keep = [linked(x, y) for x, y in zip(sets(batch, "text_a", powers), sets(batch, "text_b", powers))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, type=pa.bool_()))

    return run


def _near(x, table) -> list[int]:
    """Ids in ``table`` (bits length -> columns) that ``x`` may be linked with and is not joined to yet."""
    _, own, component, n, bits, *_ = x
    bits = np.frombuffer(bits, dtype=np.uint8)
    out = []
    for size, (ids, components_, sizes, grid) in table.items():
        width = min(size, len(bits))
        while grid.shape[1] > width:
            grid = grid[:, :grid.shape[1] // 2] ^ grid[:, grid.shape[1] // 2:]
        distance = np.bitwise_count(grid ^ fold(bits, width)).sum(axis=1, dtype=np.int64)
        keep = ((components_ != component) & (5 * np.minimum(n, sizes) >= 4 * np.maximum(n, sizes))
                & (distance <= (n + sizes) // 9))
        out += ids[keep].tolist()
    return out


def _columns(rows) -> dict:
    by_size: dict[int, list] = {}
    for r in rows:
        by_size.setdefault(len(r[4]), []).append(r)
    return {size: (*(np.array([r[k] for r in same], dtype=np.int64) for k in (1, 2, 3)),
                   np.stack([np.frombuffer(r[4], dtype=np.uint8) for r in same])) for size, same in by_size.items()}


def _cell_pairs(batches):
    """Pairs of one cell of the grid whose sketches are near and whose components differ."""
    for rows in _cells(batches):
        left = [r for r in rows if r[0] == 0]
        right = [r for r in rows if r[0] == 1] or left
        table, key = _columns(right), rows[0][6]
        low = {r[1]: {k for k in r[5] if k < key} for r in rows}
        # a pair that shares a lower key is found there
        out = {(min(x[1], y), max(x[1], y)) for x in left for y in _near(x, table) if low[x[1]].isdisjoint(low[y])}
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, type=pa.int64()) for v in zip(*out)], names=["a", "b"])


def _cells(batches):
    held, current = [], None
    for batch in batches:
        c = batch.to_pydict()
        for cell, *row in zip(c["cell"], *(c[k] for k in ("side", "id", "component", "n", "bits", "lowest", "key"))):
            if held and cell != current:
                yield held
                held = []
            current = cell
            held.append(row)
    if held:
        yield held


def similar_documents(docs: DataFrame, width: int = WORDS, pivot_rounds: int = PIVOT_ROUNDS,
                      block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Sets and links of ``docs`` (doc_id, text): ``(signatures, labels)``.

    ``signatures`` has one row per input row: doc_id, n_shingles, set_id.
    ``labels`` has (set_id, component_id) for every set held by a row with a
    doc_id, except the empty one. No link between different sets is lost.

    Null and empty texts and texts of white space have no shingles and no
    links. Rows without a doc_id cannot be named as a component and neither
    join nor extend one. Rows with the same doc_id count as one document with
    several sets. Extra columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signatures = cut_lineage(texts.mapInArrow(_signatures(width), SIGNATURES), "sets")
    named = signatures.filter("doc_id is not null and n > 0")
    nodes = named.groupBy("set_id").agg(F.min("doc_id").alias("id"), F.max("n").alias("n"), F.max("bits").alias("bits"))

    keyed = signatures.filter("keys is not null").select(F.explode("keys").alias("key"), "set_id")
    # a part held by one set only joins nothing
    by_key = Window.partitionBy("key")
    shared = (keyed.withColumn("lo", F.min("set_id").over(by_key)).withColumn("hi", F.max("set_id").over(by_key))
              .filter("lo <> hi").select("key", "set_id").distinct())
    nodes = cut_lineage(nodes, "nodes")
    # the long columns stay with the nodes: a set has many keys
    members = cut_lineage(shared.join(nodes.select("set_id", "id"), "set_id").select("key", "id"), "members")
    # one document id may hold several sets: they are one node
    listed = members.select("id").distinct()
    sketches = cut_lineage(nodes.select("id", "n", "bits").join(listed, "id").distinct(), "sketches")
    own = (named.groupBy("doc_id").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi")).filter("lo <> hi")
           .select("doc_id").join(named, "doc_id").join(nodes.select("set_id", "id"), "set_id")
           .select(F.col("doc_id").alias("a"), F.col("id").alias("b")))
    links = cut_lineage(own, "links")

    named_texts = texts.filter("doc_id is not null and text is not null").withColumn("k", F.xxhash64("doc_id"))

    def verify(pairs: DataFrame) -> DataFrame:
        # of the texts only those in a pair are shuffled
        ids = pairs.select(F.xxhash64("a").alias("k")).unionByName(pairs.select(F.xxhash64("b").alias("k")))
        some = named_texts.mapInArrow(_listed(bitmaps.gather(ids, "k")), "doc_id bigint, text string")
        left = some.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
        right = some.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
        found = pairs.join(left, "a").join(right, "b").mapInArrow(_verify(width), "a bigint, b bigint")
        return cut_lineage(found.distinct(), "links")

    # groups that have fallen into one component are done and drop out of the next turn
    open_groups = members
    for turn in range(pivot_rounds + 1):
        labels = components(links)
        placed = open_groups.join(labels.withColumnRenamed("node", "id"), "id", "left").select(
            "key", "id", F.coalesce("component", "id").alias("component"))
        apart = Window.partitionBy("key")
        placed = (placed.withColumn("lo", F.min("component").over(apart)).withColumn("hi", F.max("component").over(apart))
                  .filter("lo <> hi").drop("lo", "hi"))
        placed = cut_lineage(placed, "open")
        open_groups = placed.select("key", "id")
        if turn < pivot_rounds:
            # by hash, so that every turn has other pivots; turn 0 takes the smallest id
            order = F.col("id") if turn == 0 else F.xxhash64("id", F.lit(turn))
            pivots = placed.groupBy("key").agg(F.min_by(F.struct("id", "component"), order).alias("p"))
            pairs = (placed.join(pivots, "key").filter("component <> p.component")
                     .select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b")).distinct())
            pairs = (pairs.join(sketches.selectExpr("id a", "n na", "bits bits_a"), "a")
                     .join(sketches.selectExpr("id b", "n nb", "bits bits_b"), "b")
                     .mapInArrow(_filter_pairs, "a bigint, b bigint"))
        else:
            # the lowest open keys of each set tell in most cells that a pair meets in an earlier one too
            lowest = placed.groupBy("id").agg(F.slice(F.array_sort(F.collect_set("key")), 1, LOW_KEYS).alias("lowest"))
            rows = placed.join(sketches.join(lowest, "id"), "id")
            pairs = to_cells(rows, ["key"], "id", block_rows).mapInArrow(_cell_pairs, "a bigint, b bigint").distinct()
        pairs = cut_lineage(pairs, "pairs")
        if turn == pivot_rounds or not pairs.isEmpty():
            links = cut_lineage(links.unionByName(verify(pairs)), "links")
    labels = components(links)
    labels = (nodes.select("set_id", F.col("id").alias("node")).join(labels, "node", "left")
              .select("set_id", F.coalesce("component", "node").alias("component_id")))
    return signatures.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "set_id"), labels


def component_table(docs: DataFrame, **kw) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    A document without shingles is its own component; a row without doc_id has
    a null component.
    """
    signatures, labels = similar_documents(docs, **kw)
    return (signatures.join(labels, "set_id", "left")
            .select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id"))
                    .when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def representatives(docs: DataFrame, by_text: bool = False, **kw) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does, with all their columns.

    It is the one with the smallest doc_id. Of rows that share a doc_id any
    one stays, whatever their texts. With ``by_text`` they are one document
    only if their texts are equal, and of these the row that is smallest as
    JSON stays; rows without shingles all stay. Rows without doc_id stay.
    The list of dropped ids is joined against the rows, which are shuffled
    only if it is too long to be broadcast.
    """
    again = docs.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).count().filter("count > 1")
    again = cut_lineage(again.select("doc_id"), "repeated")
    if not by_text or again.isEmpty():
        signatures, labels = similar_documents(docs, **kw)
        placed = signatures.filter("doc_id is not null and n_shingles > 0").join(labels, "set_id")
        dropped = cut_lineage(placed.filter("doc_id <> component_id").select("doc_id").distinct(), "copies")
        rows = docs.join(dropped, "doc_id", "left_anti")
        if again.isEmpty():
            return rows
        return rows.join(again, "doc_id", "left_anti").unionByName(rows.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    # a repeated id gives way to a hash of id and text, which names a row by both
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("doc_id").cast("long").alias("_doc"), "text")
    marked = row.join(again.select(F.col("doc_id").alias("_doc"), F.lit(True).alias("_again")), "_doc", "left")
    node = F.when(F.col("_again"), F.xxhash64("_doc", F.coalesce("text", F.lit("")))).otherwise(F.col("_doc"))
    marked = marked.select("_row", "_doc", "text", "_again", node.alias("_node"))
    signatures, labels = similar_documents(marked.select(F.col("_node").alias("doc_id"), "text"), **kw)
    nodes = signatures.filter("doc_id is not null and n_shingles > 0").withColumnRenamed("doc_id", "_node")
    placed = nodes.join(labels, "set_id").join(marked.select("_node", "_doc").distinct(), "_node").select("_node", "_doc", "component_id")
    first = placed.groupBy("component_id").agg(F.min(F.struct("_doc", "_node")).alias("first"))
    dropped = cut_lineage(placed.join(first, "component_id").filter("_node <> first._node").select("_node").distinct(), "copies")
    same = cut_lineage(nodes.groupBy("_node").count().filter("count > 1").select("_node"), "same")
    rows = marked.join(dropped, "_node", "left_anti")
    one = rows.join(same, "_node", "left_semi").groupBy("_node").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return rows.join(same, "_node", "left_anti").select("_row.*").unionByName(one.select("_row.*"))
