import numpy as np
import pytest

from paperlake.llm import whitening as W

SHAPE = "vec_id long, embedding array<float>, label int"


def vectors(n=300, dim=6, seed=1):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, dim)) * np.linspace(0.2, 1.2, dim)).astype(np.float32)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], None) for i, v in rows], SHAPE)


def brute(x, k):
    u = np.unique(x, axis=0)
    n, sums = len(u), u.sum(axis=0)
    values, vecs = np.linalg.eigh(np.cov(u.T.astype(float), bias=True))
    values, vecs = values[::-1], vecs[:, ::-1]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ vecs[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def test_against_numpy(spark):
    v = vectors()
    odd = [(900, None), (901, []), (902, [1.0, None, 0, 0, 0, 0]), (903, [float("nan")] * 6), (904, [float("inf")] + [0.0] * 5),
           (905, [0.5, 0.5]), (906, [1e30] * 6)]
    rows = list(enumerate(v)) + [(i, v[0]) for i in range(1000, 1200)] + [(None, v[1]), (3, v[3]), (3, v[4])] + odd
    table = frame(spark, rows).selectExpr("*", "1 as component", "2L as n", "cast(null as string) as x", "'d' as dim").repartition(6)
    got = W.whiten(table).collect()
    kept = np.array([w for _, w in rows[:-len(odd)]], dtype=np.float64)
    n, deviation, whitened, explained = brute(np.floor(kept * 256).astype(np.int64), 4)
    assert len(got) == 4 * len(kept)
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["deviation"], r["n"]), {}).setdefault(r["component"], []).append(r)
    assert {(i, d) for i, d, _ in by} == {(i, int(d)) for (i, _), d in zip(rows, deviation)} and {m for *_, m in by} == {n}
    sign = {}
    for (i, _), d, w in zip(rows, deviation, whitened):
        for c in range(4):
            found = by[i, int(d), n][c + 1]
            assert abs(found[0]["explained"] / explained[c] - 1) < 1e-9 and found[0]["identity_error"] < 1e-9
            s = sign.setdefault(c, np.sign(found[0]["whitened"] * w[c]))
            assert any(abs(r["whitened"] - s * w[c]) < 1e-8 for r in found)


def test_few_and_no_vectors(spark):
    assert W.whiten(frame(spark, [])).collect() == []
    assert W.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    assert W.whiten(frame(spark, [(1, [1, 2]), (2, [1, 2])])).collect() == []  # no variance
    line = W.whiten(frame(spark, [(i, [i, 2 * i, -i]) for i in range(5)])).collect()  # rank 1
    assert {r["component"] for r in line} == {1} and len(line) == 5
    assert line[0]["explained"] == pytest.approx(1) and line[0]["identity_error"] < 1e-12
    # of two equally frequent lengths the larger counts
    assert {r["vec_id"] for r in W.whiten(frame(spark, [(1, [1]), (2, [2]), (3, [1, 0]), (4, [2, 0])])).collect()} == {3, 4}


def test_exact_sums():
    rng = np.random.default_rng(2)
    z = np.concatenate([rng.integers(-500, 500, (9000, 4)), rng.integers(-(1 << 40), 1 << 40, (3, 4))])
    assert (W.products(z) == z.astype(object).T @ z.astype(object)).all()
    x = rng.integers(-1000, 1000, (50, 4))
    assert (W.unpack(W.pa.array(W.pack(x * 100)), 4) == x * 100).all()
    assert W.deviations(x, 7, [3, -4, 5, 0]) == [sum((7 * int(v) - s) ** 2 for v, s in zip(r, [3, -4, 5, 0])) for r in x]
    assert W.deviations(np.array([[1 << 31]]), 4, [0]) == [None] and W.deviations(np.array([[1 << 29]]), 4, [0]) == [1 << 62]


@pytest.mark.parametrize("values", [[3, 2, 1, 0.5, 0.1, 0.01], [5, 5, 5, 2, 2, 0], [1, 1 - 1e-9, 1 - 2e-9, 1e-3, 1e-3 - 1e-12, 1e-8], [0] * 6])
def test_refinement_beyond_single_precision(values):
    rng = np.random.default_rng(3)
    q = W.polish(W.polish(np.linalg.qr(rng.normal(size=(6, 6)))[0].astype(np.longdouble)))
    v = np.array(values, dtype=np.longdouble)
    a = q @ np.diag(v) @ q.T
    found, x = W.eigenvectors((a + a.T) / 2)
    assert np.abs(found - v).max() < 1e-17 and np.abs(x.T @ x - np.eye(6)).max() < 1e-17
    assert np.abs(a @ x - x * found).max() < 1e-17
    for i in range(6):  # vectors of values that stand apart
        others = np.delete(v, i)
        if np.abs(others - v[i]).min() > 1e-10:
            assert min(np.abs(x[:, i] - q[:, i]).max(), np.abs(x[:, i] + q[:, i]).max()) < 1e-9
