"""The trie of conversation prefixes, with totals of subtrees by time-forward processing.

Each distinct sequence of first turns is a node. A node is named by two 64-bit
polynomial hashes of the turns on its path (the turns themselves enter as the
halves of an MD5), so prefixes of any length are told apart without walking
down the trie level by level, and a prefix sum over the sorted turns gives all
names of a conversation: tasks scan their range of rows, and the driver joins
the ranges by one record for the first and the last conversation of each.

Totals of subtrees (leaves, tokens, children) flow from the deepest level to
the root. Within a shard, nodes come in reverse level order and send their
totals to their parents through a priority queue that spills sorted runs, so a
node finds the messages of all its children when its turn comes. Shards are

* whole subtrees of at most ``light`` turns below their root, and
* of the remaining heavy nodes, bands of ``band`` levels below one band root.

Each level has at most turns / light heavy nodes, so with the default
``light = sqrt(turns * band)`` no shard exceeds that bound, also where one
conversation, or one opening turn, holds a third of all rows. The totals of
light shards are added up by parent; those of bands are passed on along the
band roots, of which there are at most turns / light per band, and then
enter the bands above them.
"""

from __future__ import annotations

import heapq
import math
import struct
import tempfile
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake.runtime import cut_lineage

from .mixing import tokens_of

GROUP = 20  # conversations that share the opening turns of the first of them
HEADS = 4  # numbers of shared opening turns: 0 up to HEADS - 1
BAND = 1024
HELD = 200_000  # messages that a queue keeps in memory
CHUNK = 1 << 14  # ids of one piece of a hashed list

_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_MASK = (1 << 64) - 1


# --- prefix sums over sorted rows ------------------------------------------

def _power_table(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _scan(passed: list[str]):
    """Counts the rows of each conversation and sums their hashed turns, from the first row of the task on.

    ``length`` of the first row of a conversation is handed on to its other
    rows. Two extra rows hold the state after the first conversation of the
    task (``edge`` 1) and after the last one (2).
    """

    def run(batches):
        part = TaskContext.get().partitionId()
        powers = [_power_table(b, 1 << 13) for b in _BASES]
        state = first = None  # (conversation, rows, two sums, length) after the last row, after the first conversation

        def batch_of(columns, passing):
            return pa.RecordBatch.from_arrays([*columns, *passing], names=["part", "conv_id", "k", "l1", "l2", "q1", "q2", "length", "edge", *passed])

        def edge(at, mark, kinds):
            conv, count, sums, length = at
            values = [part, conv, count, *map(_signed, sums), 0, 0, length, mark]
            types = [pa.int32(), *[pa.int64()] * 7, pa.int32()]
            return batch_of([pa.array([v], type=t) for v, t in zip(values, types)], [pa.nulls(1, t) for t in kinds])

        kinds = []
        for whole in batches:
            kinds = [whole.schema.field(name).type for name in passed]
            for at in range(0, whole.num_rows, 1 << 13):
                batch = whole.slice(at, 1 << 13)
                n = batch.num_rows
                convs = batch.column("conv_id").to_numpy(zero_copy_only=False)
                opens = np.concatenate([[True], convs[1:] != convs[:-1]])
                starts = np.flatnonzero(opens)
                of = np.cumsum(opens) - 1
                inside = np.arange(n) - starts[of]
                head = int(starts[1]) if len(starts) > 1 else n
                goes_on = state is not None and int(convs[0]) == state[0]
                if state is not None and not goes_on and first is None:
                    first = state
                body = np.frombuffer(b"".join(batch.column("body").to_pylist()), dtype="<u8").reshape(n, 2)
                rows, until, before = inside + 1, [], []
                lengths = batch.column("length").to_numpy(zero_copy_only=False).astype(np.float64)[starts]
                if goes_on:
                    rows[:head] += state[1]
                    lengths[0] = np.nan if state[3] is None else state[3]
                for lane, table in enumerate(powers):
                    term = body[:, lane] * table[inside]
                    running = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(term, dtype=np.uint64)])
                    total = running[1:] - running[starts][of]
                    if goes_on:
                        shift = np.uint64(pow(_BASES[lane], state[1], 1 << 64))
                        total[:head] = total[:head] * shift + np.uint64(state[2][lane])
                        term[:head] *= shift
                    until.append(total)
                    before.append(total - term)

                def after(row):
                    length = lengths[of[row]]
                    return int(convs[row]), int(rows[row]), [int(u[row]) for u in until], None if np.isnan(length) else int(length)

                if first is None and len(starts) > 1:
                    first = after(head - 1)
                state = after(n - 1)
                known = lengths[of]
                yield batch_of(
                    [pa.array(np.full(n, part, dtype=np.int32)), pa.array(convs), pa.array(rows), *(pa.array(u.view(np.int64)) for u in until + before),
                     pa.array(np.nan_to_num(known).astype(np.int64), mask=np.isnan(known)), pa.nulls(n, pa.int32())],
                    [batch.column(name) for name in passed])
        if state is not None:
            yield edge(first or state, 1, kinds)
            yield edge(state, 2, kinds)

    return run


def _join_up(carry: dict, passed: list[str]):
    """Adds what earlier tasks saw of the first conversation of a range."""

    def run(batches):
        for batch in batches:
            parts = batch.column("part").to_numpy(zero_copy_only=False)
            convs = batch.column("conv_id").to_numpy(zero_copy_only=False)
            rows = batch.column("k").to_numpy(zero_copy_only=False).copy()
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.float64)
            held = {name: batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64).copy() for name in ("l1", "l2", "q1", "q2")}
            for part in np.unique(parts).tolist():
                if part in carry:
                    conv, count, sums, known = carry[part]
                    mine = (parts == part) & (convs == conv)
                    rows[mine] += count
                    for name in held:
                        lane = int(name[1]) - 1
                        held[name][mine] = held[name][mine] * np.uint64(pow(_BASES[lane], count, 1 << 64)) + np.uint64(sums[lane])
                    if known is not None:
                        length[mine] = known
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(rows), *(pa.array(held[name].view(np.int64)) for name in ("l1", "l2", "q1", "q2")),
                 pa.array(np.nan_to_num(length).astype(np.int64), mask=np.isnan(length)), *(batch.column(name) for name in passed)],
                names=["conv_id", "k", "h1", "h2", "p1", "p2", "length", *passed])

    return run


def carried(edges: list) -> dict:
    """What each range of rows starts with: {part: (conversation, rows, sums, length)} from the edge rows in order of part."""
    out, state = {}, None
    for part, first, last in edges:
        conv, count, sums, length = first
        if state is not None and state[0] == conv:
            out[part] = state
            sums = [(s * pow(b, state[1], 1 << 64) + t) & _MASK for s, b, t in zip(sums, _BASES, state[2])]
            joined = (conv, state[1] + count, sums, state[3] if length is None else length)
            state = joined if last[0] == conv else last
        else:
            state = last
    return out


def along(rows: DataFrame, order: list[Column], passed: dict[str, str]) -> DataFrame:
    """Counts (``k``) and hashes (``h1``, ``h2``; ``p1``, ``p2`` without the row itself) of the rows of each conversation up to each row.

    ``rows`` has conv_id, body (16 bytes), length and the ``passed`` columns;
    ``order`` sorts a conversation and ends with a column that tells equal rows
    apart, so that the ranges of the sort can cut through any of them.
    """
    kinds = "".join(f", {name} {kind}" for name, kind in passed.items())
    order = [F.col("conv_id").asc(), *order]
    local = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _scan(list(passed)), "part int, conv_id bigint, k bigint, l1 bigint, l2 bigint, q1 bigint, q2 bigint, length bigint, edge int" + kinds)
    local = cut_lineage(local, "turn-runs")
    edges: dict = {}
    for r in local.filter("edge is not null").select("part", "edge", "conv_id", "k", "l1", "l2", "length").collect():
        edges.setdefault(r["part"], {})[r["edge"]] = (r["conv_id"], r["k"], [r["l1"] & _MASK, r["l2"] & _MASK], r["length"])
    carry = carried([(part, edges[part][1], edges[part][2]) for part in sorted(edges)])
    return local.filter("edge is null").drop("edge").mapInArrow(
        _join_up(carry, list(passed)), "conv_id bigint, k bigint, h1 bigint, h2 bigint, p1 bigint, p2 bigint, length bigint" + kinds)


# --- rebuilt conversations -------------------------------------------------

def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, body, words and a number of the row; null roles and texts are empty, rows without conv_id are left out."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    body = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    return (conversations.filter("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), body.alias("body"),
                    tokens_of(text).alias("words"), F.monotonically_increasing_id().alias("row")))


def shared_heads(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def rebuilt(conversations: DataFrame) -> DataFrame:
    """One row per turn of every rebuilt conversation, and one of depth 0 before them.

    conv_id, depth, the hashes of the node (h1, h2) and of its parent (p1, p2),
    length of the conversation, words of the turn.
    """
    turns = cut_lineage(turns_of(conversations), "turns")
    placed = along(turns.withColumn("length", F.lit(None).cast("long")), [F.col("turn").asc_nulls_first(), F.col("body"), F.col("row")],
                   {"body": "binary", "words": "bigint"}).select("conv_id", F.col("k").alias("pos"), "body", "words")
    placed = cut_lineage(placed, "placed-turns")
    c = F.col("conv_id")
    convs = placed.groupBy("conv_id").agg(F.max("pos").alias("n")).select("conv_id", "n", shared_heads(c).alias("h"), (c - c % GROUP).alias("top"))
    taken = F.least("h", F.coalesce("m", F.lit(0)))
    opened = (convs.join(convs.select(F.col("conv_id").alias("top"), F.col("n").alias("m")), "top", "left")
              .select("conv_id", (taken + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("length")))
    none = F.lit(None).cast("long")
    empty = F.lit(bytes(16))
    heads = placed.filter(F.col("pos") < HEADS).select(F.col("conv_id").alias("top"), "pos", "body", "words")
    shared = (convs.filter("h > 0").select("conv_id", "h", "top").join(heads, "top").filter("pos <= h"))
    rows = (opened.select("conv_id", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("pos"), empty.alias("body"), F.lit(0).cast("long").alias("words"), "length")
            .unionByName(shared.select("conv_id", F.lit(1).alias("kind"), "pos", "body", "words", none.alias("length")))
            .unionByName(placed.filter(F.col("pos") > shared_heads(c)).select("conv_id", F.lit(2).alias("kind"), "pos", "body", "words", none.alias("length"))))
    done = along(rows, [F.col("kind"), F.col("pos")], {"words": "bigint"})
    return cut_lineage(done.select("conv_id", (F.col("k") - 1).alias("depth"), "h1", "h2", "p1", "p2", "length", "words"), "rebuilt-turns")


# --- time-forward processing -----------------------------------------------

class Queue:
    """Messages (three numbers of the key, three values) in order of key; beyond ``held`` of them, sorted runs go to a scratch file of the task.

    The scratch file has no name and ends with the task, so a task that is run
    again elsewhere needs nothing of it.
    """

    BLOCK = 4096  # messages read from a run at a time

    def __init__(self, held: int = HELD):
        self.held, self.heap, self.fronts, self.file = held, [], [], None
        self.form = struct.Struct("<6q")

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.held:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        messages, self.heap = sorted(self.heap), []
        start = self.file.seek(0, 2)
        for at in range(0, len(messages), self.BLOCK):
            self.file.write(b"".join(self.form.pack(*m) for m in messages[at:at + self.BLOCK]))
        self._advance(self._run(start, len(messages)))

    def _run(self, start: int, n: int):
        size = self.form.size
        for at in range(0, n, self.BLOCK):
            self.file.seek(start + at * size)
            yield from self.form.iter_unpack(self.file.read(min(self.BLOCK, n - at) * size))

    def _advance(self, run) -> None:
        message = next(run, None)
        if message is not None:
            heapq.heappush(self.fronts, (message, id(run), run))

    def take(self, key: tuple):
        """Takes out the messages of ``key``, which is at most the smallest key held."""
        while True:
            if self.heap and self.heap[0][:3] == key:
                yield heapq.heappop(self.heap)
            elif self.fronts and self.fronts[0][0][:3] == key:
                message, _, run = heapq.heappop(self.fronts)
                self._advance(run)
                yield message
            else:
                return

    def __bool__(self) -> bool:
        return bool(self.heap or self.fronts)


_PASSED = "h1 bigint, h2 bigint, p1 bigint, p2 bigint, depth bigint, top boolean"


def _forward(held: int):
    def run(batches):
        queue = Queue(held)
        for batch in batches:
            out = []
            names = ("depth", "h1", "h2", "p1", "p2", "top", "children", "leaves", "saved")
            for depth, h1, h2, p1, p2, top, children, leaves, saved in zip(*(batch.column(name).to_pylist() for name in names)):
                for message in queue.take((-depth, h1, h2)):
                    children, leaves, saved = children + message[3], leaves + message[4], saved + message[5]
                if not top:
                    queue.push((1 - depth, p1, p2, 1, leaves, saved))
                out.append((children, leaves, saved))
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in ("h1", "h2", "p1", "p2", "depth", "top")] + [pa.array([r[i] for r in out], type=pa.int64()) for i in range(3)],
                names=["h1", "h2", "p1", "p2", "depth", "top", "children", "leaves", "saved"])
        if queue:
            raise RuntimeError("a node is not in the shard of its child")

    return run


def within_shards(nodes: DataFrame, shard: list[str] | None, held: int) -> DataFrame:
    """Totals of subtrees inside shards: own and incoming values of a node and those of its descendants in the shard.

    ``top`` marks the roots of shards, which send nothing. Without ``shard``
    all nodes are one shard.
    """
    dealt = nodes.repartition(*shard) if shard else nodes.coalesce(1)
    return dealt.sortWithinPartitions(F.desc("depth"), "h1", "h2").select(
        "h1", "h2", "p1", "p2", "depth", "top", "children", "leaves", "saved").mapInArrow(
        _forward(held), _PASSED + ", children bigint, leaves bigint, saved bigint")


def _incoming(totals: DataFrame) -> DataFrame:
    """What the roots of shards hand to their parents, by parent."""
    return totals.filter("top and depth > 0").groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _receive(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    got = messages.select("h1", "h2", *(F.col(c).alias(f"in_{c}") for c in ("children", "leaves", "saved")))
    plus = {c: F.col(c) + F.coalesce(f"in_{c}", F.lit(0)) for c in ("children", "leaves", "saved")}
    return nodes.join(got, ["h1", "h2"], "left").withColumns(plus).drop("in_children", "in_leaves", "in_saved")


def subtree_totals(nodes: DataFrame, rows: DataFrame, light: int, band: int = BAND, held: int = HELD) -> DataFrame:
    """(h1, h2, children, leaves, saved): totals of every node over its subtree.

    ``nodes`` has h1, h2, p1, p2, depth, conv_id (a member that has no smaller
    one), weight (turns of members below the node) and own values;
    ``rows`` the path of every conversation (conv_id, depth, h1, h2).
    """
    small, heavy = nodes.filter(F.col("weight") <= light), nodes.filter(F.col("weight") > light)
    roots = small.join(heavy.select(F.col("h1").alias("p1"), F.col("h2").alias("p2")), ["p1", "p2"], "left_semi").select("h1", "h2").unionByName(
        small.filter("depth = 0").select("h1", "h2"))
    # paths of conversations that give a node its name; copies give none, so a root meets at most as many as it has nodes
    named = rows.join(nodes.select("conv_id").distinct(), "conv_id", "left_semi").select("conv_id", "h1", "h2")
    entry = named.join(roots, ["h1", "h2"]).select("conv_id", F.col("h1").alias("s1"), F.col("h2").alias("s2"))
    dealt = small.join(entry, "conv_id").withColumn("top", (F.col("h1") == F.col("s1")) & (F.col("h2") == F.col("s2")))
    low = cut_lineage(within_shards(dealt, ["s1", "s2"], held), "light-shards")

    heavy = _receive(heavy, _incoming(low))
    marks = rows.filter((F.col("depth") > 0) & (F.col("depth") % band == 0))

    def below(df: DataFrame, depth: Column, names: list[str]) -> DataFrame:
        """Adds the node of the same conversation at that depth; the root has the hashes 0."""
        at = marks.select("conv_id", F.col("depth").alias("_at"), F.col("h1").alias(names[0]), F.col("h2").alias(names[1]))
        return (df.withColumn("_at", depth).join(at, ["conv_id", "_at"], "left").drop("_at")
                .withColumns({n: F.coalesce(n, F.lit(0)) for n in names}))

    depth = F.col("depth")
    heavy = cut_lineage(below(heavy, depth - depth % band, ["s1", "s2"]).withColumn("top", depth % band == 0), "heavy-nodes")
    high = within_shards(heavy, ["s1", "s2"], held)
    if not heavy.filter(depth >= band).isEmpty():
        # totals of the band roots first, along the band roots; what they hold enters the bands above them
        ends = high.filter("top").join(heavy.select("h1", "h2", "conv_id"), ["h1", "h2"])
        ends = below(ends, depth - band, ["u1", "u2"]).select(
            "h1", "h2", F.col("u1").alias("p1"), F.col("u2").alias("p2"), (depth / band).cast("long").alias("depth"), "children", "leaves", "saved",
            F.col("p1").alias("q1"), F.col("p2").alias("q2"))
        ends = cut_lineage(ends, "band-roots")
        whole = within_shards(ends.withColumn("top", depth == 0), None, held)
        handed = whole.select("h1", "h2", "depth", "leaves", "saved").join(ends.select("h1", "h2", F.col("q1").alias("p1"), F.col("q2").alias("p2")), ["h1", "h2"])
        handed = _incoming(handed.withColumn("top", F.lit(True)))
        high = within_shards(_receive(heavy, handed), ["s1", "s2"], held)
    out = ["h1", "h2", "children", "leaves", "saved"]
    return low.select(*out).unionByName(high.select(*out))


# --- lists of ids ----------------------------------------------------------

def _pieces(size: int):
    def run(batches):
        for batch in batches:
            a, b, c = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("h1", "h2", "conv_id"))
            cuts = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
            cuts = np.unique(np.concatenate([cuts, np.arange(0, len(a), size)]))
            ends = np.concatenate([cuts[1:], [len(a)]])
            texts = [",".join(map(str, c[i:j].tolist())) for i, j in zip(cuts, ends)]
            yield pa.RecordBatch.from_arrays([pa.array(a[cuts]), pa.array(b[cuts]), pa.array(c[cuts]), pa.array(texts)], names=["h1", "h2", "first", "ids"])

    return run


def _digests(batches):
    key, state = None, None
    for batch in batches:
        done = []
        for a, b, ids in zip(*(batch.column(name).to_pylist() for name in ("h1", "h2", "ids"))):
            if (a, b) == key:
                state.update(b"," + ids.encode())
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (a, b), sha256(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done]), pa.array([d[2] for d in done])], names=["h1", "h2", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([state.hexdigest()])], names=["h1", "h2", "ends_sha256"])


def list_digests(members: DataFrame, size: int = CHUNK) -> DataFrame:
    """(h1, h2, ends_sha256): SHA-256 of the comma-joined conv_ids of each node, ascending.

    Ids are sorted in ranges that may cut through a node, and joined there to
    texts of up to ``size`` ids; only these reach the task that hashes the
    node, which reads them in order and holds one batch.
    """
    order = ["h1", "h2", "conv_id"]
    texts = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _pieces(size), "h1 bigint, h2 bigint, first bigint, ids string")
    return texts.repartition("h1", "h2").sortWithinPartitions("h1", "h2", "first").select("h1", "h2", "ids").mapInArrow(
        _digests, "h1 bigint, h2 bigint, ends_sha256 string")


# --- the operator ----------------------------------------------------------

def prefix_trie(conversations: DataFrame, light: int | None = None, band: int = BAND, held: int = HELD) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A null role or text is empty, a null turn comes first; turns of equal
    number follow each other in a fixed order of their content. Rows without
    conv_id belong to no conversation and are left out; repeated rows are turns
    of their own. An empty table has no conversation and no node. Other columns
    are ignored. ``light`` and ``band`` shape the shards and change no result.
    """
    rows = rebuilt(conversations)
    if light is None:
        light = max(1, math.isqrt(rows.count() * band))
    nodes = rows.groupBy("h1", "h2").agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"), F.sum(F.col("length") - F.col("depth")).alias("weight"))
    nodes = nodes.withColumns({"children": F.lit(0).cast("long"), "leaves": (F.col("weight") == 0).cast("long"),
                               "saved": (F.col("n_convs") - 1) * F.col("words")})
    nodes = cut_lineage(nodes, "trie-nodes")
    totals = subtree_totals(nodes, rows, light, band, held)
    ends = list_digests(rows.filter("depth = length"))
    parents = nodes.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.drop("children", "leaves", "saved").join(totals, ["h1", "h2"]).join(ends, ["h1", "h2"], "left").join(parents, ["p1", "p2"])
            .select("conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs",
                    F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256")))
