import itertools
import random

import numpy as np

from paperlake.llm import parity_join as P
from paperlake.llm.graph import components

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def by_hand(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    parent = {i: i for i, _ in docs if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, s), (b, t) in itertools.combinations(sets, 2):
        if a is not None and b is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return sorted((-1 if i is None else i, len(s), -1 if i is None else find(i)) for i, s in sets)


def rows_of(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_shingles"], -1 if r["component_id"] is None else r["component_id"]) for r in df.collect())


def corpus(prose):
    rng = random.Random(3)
    docs = []
    for base in range(25):
        words = prose(base, rng.choice([4, 5, 8, 9, 12, 25, 60, 200, 500])).split()
        for copy in range(rng.randrange(1, 6)):
            mine = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                mine[rng.randrange(len(mine))] = "edit" + str(rng.randrange(1000))
            docs.append(" ".join(mine[rng.randrange(0, 1 + len(mine) // 30):]))
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_equals_brute_force(spark, prose):
    docs = corpus(prose)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(P.component_table(frame)) == by_hand(docs)
    # without pivots and with small blocks everything is compared in the grid
    assert rows_of(P.component_table(frame, pivot_rounds=0, block_rows=2)) == by_hand(docs)


def test_filters_lose_no_link():
    """Sets on both sides of the limit: linked ones share a key and pass the sketch."""
    rng = np.random.default_rng(5)
    for n in [4, 5, 6, 7, 8, 9, 10, 12, 15, 16, 17, 31, 33, 64, 100, 127, 129, 400, 1025]:
        for _ in range(20):
            base = np.unique(rng.integers(0, 2 ** 64, n + 300, dtype=np.uint64))
            rng.shuffle(base)
            gone, new = rng.integers(0, n // 5 + 1), rng.integers(0, n // 4 + 1)
            x = np.sort(base[:n])
            y = np.sort(np.concatenate([base[gone:n], base[n:n + new]]))
            if not P.linked(x, y):
                continue
            assert P.may_link(len(x), P.parity_bits(x).tobytes(), len(y), P.parity_bits(y).tobytes())
            assert P.set_id(x) == P.set_id(y) or set(P.part_keys(x)) & set(P.part_keys(y)), (n, gone, new)


def test_odd_documents(spark, odd_documents, no_documents):
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    got = rows_of(P.component_table(odd_documents))
    assert got == by_hand(docs)
    assert P.component_table(no_documents).count() == 0
    kept = P.representatives(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 7, 8, 9]


def test_representatives_of_repeated_ids(spark, prose):
    """Rows of one doc_id with different texts are documents of their own."""
    texts = [prose(500 + i, 40) for i in range(6)]
    rows = [(5, t, "a") for t in texts] + [(5, texts[0], "b"), (5, None, "a"), (5, "", "a"), (5, "", "a"),
                                            (3, texts[1] + " extra", "a"), (9, texts[2] + " extra", "a"), (8, prose(600, 40), "a")]
    for turn in (rows, rows[::-1]):
        frame = spark.createDataFrame(turn, "doc_id long, text string, source string")
        kept = sorted(((r["doc_id"], r["text"], r["source"]) for r in P.representatives(frame, by_text=True).collect()), key=str)
        want = [(5, t, "a") for i, t in enumerate(texts) if i != 1] + [(5, None, "a"), (5, "", "a"), (5, "", "a"), (3, texts[1] + " extra", "a"), (8, prose(600, 40), "a")]
        assert kept == sorted(want, key=str)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (7, 7), (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}
