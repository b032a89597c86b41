"""The inverted-list index against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlake import kernels
from paperlake.operators import ivf, similar


def rows(frame):
    return sorted((r["pmid"], r["rank"], r["related"]) for r in frame.collect())


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 16))
    out = {f"v{i:03d}": centres[i % 8] + rng.normal(scale=0.3, size=16) for i in range(240)}
    out |= {f"c{i:03d}": centres[0] for i in range(60)}  # a hot group of copies
    return out | {"null": None, "zero": [0.0] * 16, "short": [1.0, 2.0]}


@pytest.fixture(scope="module")
def index(spark, make_embeddings, vectors):
    frame = make_embeddings({k: v for k, v in vectors.items() if k != "short"})
    return frame, ivf.build(make_embeddings(vectors), ivf.train(frame, lists=6, parts=4, codewords=32))


def test_all_lists_and_long_shortlists_are_exact(spark, index):
    frame, built = index
    exact = rows(similar.related_all(frame, 5))
    assert rows(ivf.index_topk(built, 5, probes=6, size=400)) == exact
    assert built.rows.count() == 241 and built.rows.filter("id = 'c000'").first()["ids"] == [f"c{i:03d}" for i in range(6)]


def test_blocks_change_nothing(index):
    frame, built = index
    few = rows(ivf.index_topk(built, 5, probes=2, size=10))
    assert few == rows(ivf.index_topk(built, 5, probes=2, size=10, block_rows=7))
    asked = F.col("pmid").isin("v007", "c011")
    assert rows(ivf.index_topk(built, 5, probes=2, size=10, asked=asked)) == [r for r in few if r[0] in ("v007", "c011")]


def test_recall_and_costs(index):
    frame, built = index
    near = ivf.index_topk(built, 5, probes=2, size=20)
    assert similar.recall(near, similar.related_all(frame, 5)).first()["recall"] > 0.9
    cost = ivf.index_costs(built, probes=2, size=20).first()
    assert 0 < cost["compared"] <= 20 / 241 + 1e-9 and cost["compared"] < cost["scanned"] < 0.7


def test_one_vector_reads_its_lists_only(index, vectors):
    frame, built = index
    got = ivf.nearest(built, vectors["v010"], 5, probes=6, size=400).collect()
    want = similar.similar_topk(frame, vectors["v010"], 5).collect()
    assert [(r["pmid"], round(r["similarity"], 9)) for r in got] == [(r["pmid"], round(r["similarity"], 9)) for r in want]
    plan = ivf.nearest(built, vectors["v010"], 5, probes=1)._jdf.queryExecution().toString()
    assert "PushedFilters: [In(list" in plan or "PushedFilters: [IsNotNull(list), EqualTo(list" in plan
    for nothing in (None, [0.0] * 16, [1.0]):
        assert ivf.nearest(built, nothing).collect() == []


def test_codes_and_lists(vectors):
    points = np.array([v for k, v in vectors.items() if v is not None and len(v) == 16 and k != "zero"])
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    coarse = kernels.lloyd(unit, 6, 10, 1)
    near = np.array([((coarse - u) ** 2).sum(axis=1).argmin() for u in unit])
    assert (kernels.nearest_rows(unit, coarse) == near).all()
    books = (unit[:16] - coarse[near[:16]]).reshape(16, 4, 4).transpose(1, 0, 2)
    owner, codes = kernels.product_codes(unit, coarse, books)
    back = kernels.decoded(owner, codes, coarse, books)
    assert np.allclose(back[:16], unit[:16])  # what the codewords were taken from comes back whole
    assert (kernels.probed_lists(unit, coarse, 3).sum(axis=1) == 3).all()


def test_nothing_to_train_on(make_embeddings):
    with pytest.raises(ValueError, match="no vectors"):
        ivf.train(make_embeddings({"a": None, "b": [0.0, 0.0]}), lists=2)
    with pytest.raises(ValueError, match="do not divide"):
        ivf.train(make_embeddings({"a": [1.0, 0.0, 1.0]}), lists=2, parts=2)
