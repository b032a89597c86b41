import hashlib
import random
from collections import Counter

import pytest

from paperlake.llm import lpf


def by_hand(docs, length, keep):
    """docs in order; bytes covered by strings that start elsewhere (keep none) or earlier (keep first)."""
    count, seen, out = Counter(), set(), []
    for _, t in docs:
        x = (t or "").encode()
        count.update(x[i:i + length] for i in range(len(x) - length + 1))
    for d, t in docs:
        x = (t or "").encode()
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            w = x[i:i + length]
            if (count[w] > 1) if keep == "none" else (w in seen):
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(x, gone) if not g)
        out.append((d or 0, len(x), sum(gone), len([1 for p in bytes(gone).split(b"\0") if p]), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def rows_of(df):
    return sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def corpus(prose):
    rng = random.Random(2)
    passages = [prose(100 + i, rng.randrange(5, 60)) for i in range(6)]
    docs = []
    for i in range(40):
        parts = [prose(i, rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            parts.append(p[rng.randrange(0, 40):len(p) - rng.randrange(0, 40)])
        docs.append((i, " ".join(parts) + rng.choice(["", "é" * 30, "aaaa" * 40, "abab" * 50])))
    return docs


@pytest.mark.parametrize("keep", ["none", "first"])
def test_equals_brute_force(spark, prose, keep):
    docs = corpus(prose)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for length, gram in ((60, 20), (200, 96)):
        assert rows_of(lpf.remove_repeats(frame, length, gram, keep)) == by_hand(docs, length, keep)


def test_odd_documents(spark, odd_documents, no_documents, prose):
    docs = sorted(((r["doc_id"], r["text"]) for r in odd_documents.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert rows_of(lpf.remove_repeats(odd_documents, 50, 20, "none")) == by_hand(docs, 50, "none")
    kept = {r["doc_id"]: r for r in lpf.remove_repeats(odd_documents, 50, 20).collect()}
    assert kept[None]["n_removed"] == 0 and kept[1]["n_removed"] == kept[6]["n_removed"] == kept[1]["n_bytes"]
    assert lpf.remove_repeats(no_documents).count() == 0
    with pytest.raises(ValueError):
        lpf.remove_repeats(no_documents, keep="last")


def test_rows_with_equal_short_hashes(spark, clashing_texts):
    short, long = clashing_texts
    frame = spark.createDataFrame([(None, short), (None, long), (1, long)], "doc_id long, text string")
    got = sorted((r["n_bytes"], r["n_removed"]) for r in lpf.remove_repeats(frame, keep="none").collect())
    n = len(long.encode())
    assert got == sorted([(len(short.encode()), 0), (n, n), (n, n)])
