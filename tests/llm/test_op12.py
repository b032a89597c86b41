import re
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from paperlake.llm import turn_trie as T

KEYS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SHAPE = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Nodes from explicit prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in own.items()}
    member = defaultdict(list)
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        top = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        full[c] = tuple(own.get(top, [])[:h] + turns[h:])
        for d in range(len(full[c]) + 1):
            member[full[c][:d]].append(c)
    out = []
    children = defaultdict(int)
    for p in member:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, who in member.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(who) - 1) * words
    for p, who in member.items():
        ends = sorted(c for c in who if full[c] == p)
        out.append((min(who), len(p), min(member[p[:-1]]) if p else None, len(who), children[p], leaves[p], saved[p],
                    sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r[k] for k in KEYS) for r in frame.collect()), key=str)


def talk(prose):
    rows = []
    for c in range(0, 130):
        n = [1, 2, 3, 4, 6, 9][c % 6]
        for t in range(n):
            same = t < 2 and c % 3 == 0 or t < 5 and c % 13 == 0 or c % 10 == 7
            rows.append((c, t, ["user", "assistant"][t % 2], prose(t if same else 1000 * c + t, 4 + t)))
    rows += [(c, t, "user", prose(t, 3)) for c in (300, 301, 320) for t in range(70)]  # long paths that part late
    rows += [(320, 70, "user", "other"), (321, 0, "user", "a"), (322, 0, "user", "a"), (-3, 0, "user", "neg"), (-25, 1, None, "neg")]
    rows += [(400, None, "user", "first"), (400, 0, None, None), (400, 0, None, None), (400, 1, "user", ""), (None, 0, "user", "gone")]
    return rows


@pytest.mark.parametrize("shape", [{}, {"light": 6, "band": 4, "held": 3}, {"light": 1, "band": 1, "held": 1}])
def test_against_brute_force(spark, prose, shape):
    rows = talk(prose)
    frame = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 as h1", "'x' as depth", "null as part").repartition(5)
    assert got(T.prefix_trie(frame, **shape)) == brute(rows)


def test_one_conversation_over_all_ranges(spark):
    rows = [(5, t, "user", f"t{t % 7}") for t in range(260)] + [(6, t, "user", f"t{t % 7}") for t in range(40)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(T.prefix_trie(spark.createDataFrame(rows, SHAPE).repartition(7), light=30, band=16, held=10)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_table(spark):
    assert T.prefix_trie(spark.createDataFrame([], SHAPE)).collect() == []


def test_queue_spills_and_keeps_order():
    queue = T.Queue(held=5)
    keys = [(-(i * 37 % 50), i % 3, 0) for i in range(400)]
    for i, k in enumerate(keys):
        queue.push((*k, 1, i, 2 * i))
    assert queue.file is not None
    for k in sorted(set(keys)):
        assert sorted(m[4] for m in queue.take(k)) == [i for i, x in enumerate(keys) if x == k]
    assert not queue


def test_digests_in_pieces(spark):
    rows = [(n, -n, c) for n in range(3) for c in range(-20, 50 * (n + 1))]
    frame = spark.createDataFrame(rows, "h1 long, h2 long, conv_id long").repartition(3)
    for size in (7, 1 << 14):
        for r in T.list_digests(frame, size).collect():
            ids = ",".join(str(c) for n, _, c in sorted(rows) if n == r["h1"])
            assert r["ends_sha256"] == sha256(ids.encode()).hexdigest()
