"""Whitened principal components of embeddings, with eigenvectors refined from single to extended precision.

Entries become whole numbers, ``floor(scale * entry)``, so the count, the sums
and the centred products of the distinct vectors are added up as integers: the
covariance is exact, whatever the partitioning. Its eigenvectors are found in
float32, which is cheap for wide vectors, and corrected by the iteration of
Ogita and Aishima, which needs only matrix products in the higher precision
(``numpy.longdouble``). Eigenvectors whose eigenvalues are too close for that
correction are turned by a small eigenproblem of their own, formed in the
higher precision after shifting the cluster to zero.

Only sums by matrix place and the eigenproblem reach the driver: dimension
squared numbers, whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake.runtime import cut_lineage

SCALE = 256
_ROWS = 4096  # rows of one product; with entries below 2^20 its sums stay below 2^53
_SMALL = 1 << 20
_LONG = 2.0 ** 63


# --- vectors ---------------------------------------------------------------

def usable(column: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that have ``dim`` entries, all of them finite, and their whole-number vectors."""
    lengths = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dim)
    flat = column.take(pa.array(rows)).flatten()
    values = pc.cast(flat, pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(rows), dim)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(values * scale)
        fine = ((x >= -_LONG) & (x < _LONG)).all(axis=1)
    return rows[fine], x[fine].astype(np.int64)


def pack(x: np.ndarray) -> list[bytes]:
    """Each vector as bytes, of two bytes an entry where that is enough; equal vectors have equal bytes."""
    narrow = ((x >= -(1 << 15)) & (x < 1 << 15)).all(axis=1)
    out: list = [None] * len(x)
    for keep, kind in ((narrow, "<i2"), (~narrow, "<i8")):
        for i, row in zip(np.flatnonzero(keep).tolist(), x[keep].astype(kind)):
            out[i] = row.tobytes()
    return out


def unpack(column: pa.Array, dim: int) -> np.ndarray:
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dim), dtype=np.int64)
    for width, kind in ((2, "<i2"), (8, "<i8")):
        rows = np.flatnonzero(lengths == width * dim)
        held = b"".join(column.take(pa.array(rows)).to_pylist())
        out[rows] = np.frombuffer(held, dtype=kind).reshape(len(rows), dim)
    return out


def _packed(scale: int):
    def run(batches):
        for batch in batches:
            column = batch.column(0)
            for dim in pc.unique(pc.list_value_length(column)).drop_null().to_pylist():
                if dim:
                    _, x = usable(column, dim, scale)
                    yield pa.RecordBatch.from_arrays([pa.array([dim] * len(x), type=pa.int32()), pa.array(pack(x), type=pa.binary())], names=["dim", "x"])

    return run


# --- exact sums ------------------------------------------------------------

def _whole(places, values) -> pa.RecordBatch:
    """Integers of any size as (place, high, low), value = high * 2^64 + low."""
    return pa.RecordBatch.from_arrays(
        [pa.array(places, type=pa.int32()), pa.array([v >> 64 for v in values], type=pa.decimal128(38, 0)),
         pa.array([v & ((1 << 64) - 1) for v in values], type=pa.decimal128(38, 0))], names=["place", "high", "low"])


def _added(parts: DataFrame, size: int) -> list[int]:
    out = [0] * size
    for place, high, low in parts.groupBy("place").agg(F.sum("high"), F.sum("low")).collect():
        out[place] = (int(high) << 64) + int(low)
    return out


def _totals(dim: int):
    def run(batches):
        n, total = 0, np.zeros(dim, dtype=object)
        for batch in batches:
            x = unpack(batch.column(0), dim)
            n += len(x)
            # halves of the entries, so that no sum of a batch leaves 64 bits
            total = total + (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        if n:
            yield _whole(range(dim + 1), [int(v) for v in total] + [n])

    return run


def products(z: np.ndarray) -> np.ndarray:
    """Sum of the outer products of integer rows, exact, as Python integers."""
    dim = z.shape[1]
    out = np.zeros((dim, dim), dtype=object)
    small = ((z > -_SMALL) & (z < _SMALL)).all(axis=1)
    near = z[small].astype(np.float64)
    for at in range(0, len(near), _ROWS):
        block = near[at:at + _ROWS]
        out = out + (block.T @ block).astype(np.int64).astype(object)
    far = z[~small].astype(object)
    return out + far.T @ far if len(far) else out


def _scatter(dim: int, center: list[int]):
    upper = np.triu_indices(dim)

    def run(batches):
        total, seen = np.zeros((dim, dim), dtype=object), False
        middle = np.array(center, dtype=object)
        fits = all(abs(c) < 1 << 62 for c in center)
        for batch in batches:
            x = unpack(batch.column(0), dim)
            if fits and (abs(x) < 1 << 62).all():
                z = x - middle.astype(np.int64)
            else:
                z = x.astype(object) - middle
            total, seen = total + products(z), seen or len(x) > 0
        if seen:
            yield _whole((upper[0] * dim + upper[1]).tolist(), [int(v) for v in total[upper]])

    return run


# --- eigenvectors ----------------------------------------------------------

def extended(values) -> np.ndarray:
    """Integers of any size in the higher precision."""
    def one(v: int):
        out, v, sign = np.longdouble(0), abs(v), -1 if v < 0 else 1
        for shift in range((v.bit_length() // 32) * 32, -1, -32):
            out = out + np.ldexp(np.longdouble((v >> shift) & 0xFFFFFFFF), shift)
        return sign * out

    flat = np.array([one(int(v)) for v in np.asarray(values, dtype=object).ravel()], dtype=np.longdouble)
    return flat.reshape(np.shape(values))


def _size(a: np.ndarray):
    """Frobenius norm, an upper bound of the spectral one."""
    return np.sqrt((a * a).sum())


def refine_step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, object, object]:
    """One correction of approximate eigenvectors: (vectors, eigenvalues, distance below which values tie, size of the correction)."""
    unit = np.eye(len(a), dtype=a.dtype)
    r = unit - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    tie = 2 * (_size(s - np.diag(values)) + _size(a) * _size(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > tie
    move = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ move, values, tie, _size(move)


def polish(x: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns made orthonormal to the higher precision."""
    for _ in range(2):
        x = x @ (np.eye(x.shape[1], dtype=x.dtype) * 3 - x.T @ x) / 2
    return x


def split_clusters(a: np.ndarray, x: np.ndarray, values: np.ndarray, tie) -> np.ndarray:
    """Turns the vectors of each run of tied eigenvalues by the eigenvectors of the shifted matrix within their span."""
    order = np.argsort(values)
    x = x.copy()
    breaks = np.flatnonzero(np.diff(values[order]) > tie) + 1
    for group in np.split(order, breaks):
        if len(group) > 1:
            span, _ = np.linalg.qr(x[:, group].astype(np.float64))
            span = polish(span.astype(a.dtype))
            shifted = span.T @ (a @ span) - values[group].mean() * np.eye(len(group), dtype=a.dtype)
            size = np.abs(shifted).max()
            if size > 0:
                inner = (shifted + shifted.T) / (2 * size)
                x[:, group] = span @ np.linalg.eigh(inner.astype(np.float64))[1].astype(a.dtype)
    return x


def eigenvectors(a: np.ndarray, steps: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors (columns) of a symmetric matrix of the higher precision."""
    dim = len(a)
    top = np.abs(a).max() if dim else 0
    if not top:
        return np.zeros(dim, dtype=a.dtype), np.eye(dim, dtype=a.dtype)
    a = a / top
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(a.dtype)
    eps = np.finfo(a.dtype).eps
    last, stalled = np.inf, 0
    for _ in range(steps):
        x, values, tie, moved = refine_step(a, x)
        # settled, or at the rounding error of the products
        stalled = stalled + 1 if moved >= last / 2 else 0
        if moved <= eps * dim or stalled > 3:
            break
        last = moved
        x = split_clusters(a, x, values, tie)
    x = polish(x)
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    lead = x[np.abs(x).argmax(axis=0), np.arange(dim)]
    return values[order] * top, x * np.where(lead < 0, -1, 1)


# --- the operator ----------------------------------------------------------

@dataclass
class Whitening:
    dim: int
    scale: int
    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues of the kept components, falling
    vectors: np.ndarray  # unit eigenvectors, one a column
    trace: float
    identity_error: float | None = None

    @property
    def center(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])

    @property
    def projection(self) -> np.ndarray:
        return (self.vectors / np.sqrt(self.values)).astype(np.float64)


def fit_vectors(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(dim, x): each distinct whole-number vector once."""
    packed = rows.select(vector).mapInArrow(_packed(scale), "dim int, x binary")
    return cut_lineage(packed.distinct(), "whitening-fit")


def fit(rows: DataFrame, components: int | None = 4, vector: str = "embedding", scale: int = SCALE) -> Whitening | None:
    """The whitening of the distinct vectors; None where there is no usable vector.

    Components without variance (an eigenvalue of nothing but rounding) are
    left out, so there are at most as many as the rank of the vectors.
    """
    listed = fit_vectors(rows, vector, scale)
    common = listed.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return None
    dim = common["dim"]
    x = listed.filter(F.col("dim") == dim).select("x")
    *sums, n = _added(x.mapInArrow(_totals(dim), "place int, high decimal(38,0), low decimal(38,0)"), dim + 1)
    center = [(2 * s + n) // (2 * n) for s in sums]
    scatter = _added(x.mapInArrow(_scatter(dim, center), "place int, high decimal(38,0), low decimal(38,0)"), dim * dim)
    scatter = np.array(scatter, dtype=object).reshape(dim, dim)
    scatter = scatter + np.triu(scatter, 1).T
    # what the whole-number centre leaves of the mean is taken off exactly; n * n times the covariance
    left = np.array([s - n * c for s, c in zip(sums, center)], dtype=object)
    exact = n * scatter - np.outer(left, left)
    values, vectors = eigenvectors(extended(exact))
    trace = sum(int(exact[i, i]) for i in range(dim))
    keep = values > float(dim * np.finfo(np.float64).eps) * extended([trace])[0]
    keep[len(values) if components is None else components:] = False
    model = Whitening(dim, scale, n, sums, values[keep] / (np.longdouble(n) * np.longdouble(n)), vectors[:, keep],
                      float(Fraction(trace, n * n)))
    model.identity_error = measure(x, model)
    return model


def _moments(model: Whitening):
    dim, center, projection = model.dim, model.center, model.projection
    k = projection.shape[1]

    def run(batches):
        first, second, seen = np.zeros(k), np.zeros((k, k)), False
        for batch in batches:
            w = (unpack(batch.column(0), dim) - center) @ projection
            first, second, seen = first + w.sum(axis=0), second + w.T @ w, seen or len(w) > 0
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(k + k * k), type=pa.int32()), pa.array(np.concatenate([first, second.ravel()]))], names=["place", "value"])

    return run


def measure(x: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit vectors minus the identity."""
    k = model.projection.shape[1]
    if not k:
        return None
    sums = np.zeros(k + k * k)
    for place, value in x.mapInArrow(_moments(model), "place int, value double").groupBy("place").agg(F.sum("value")).collect():
        sums[place] = value / model.n
    return float(np.abs(sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * x - sums)^2, exact; None beyond 64 bits."""
    rough = ((x.astype(np.float64) * float(n) - np.array([float(s) for s in sums])) ** 2).sum(axis=1)
    with np.errstate(over="ignore"):
        wrap = np.array([s & ((1 << 64) - 1) for s in sums], dtype=np.uint64)
        y = x.view(np.uint64) * np.uint64(n & ((1 << 64) - 1)) - wrap
        out = (y * y).sum(axis=1, dtype=np.uint64).view(np.int64).tolist()  # exact modulo 2^64
    for i in np.flatnonzero(rough > _LONG * 0.99).tolist():
        value = sum((n * v - s) ** 2 for v, s in zip(x[i].tolist(), sums))
        out[i] = value if value < 1 << 63 else None
    return out


def _whitened(model: Whitening):
    dim, scale, n, sums = model.dim, model.scale, model.n, model.sums
    center, projection, error = model.center, model.projection, model.identity_error
    share = [float(v) / model.trace for v in model.values.astype(np.float64)]
    k = projection.shape[1]

    def run(batches):
        for batch in batches:
            rows, x = usable(batch.column(1), dim, scale)
            if not k or not len(rows):
                continue
            m = len(rows)
            again = pa.array(np.repeat(rows, k))
            spread = pa.array(deviations(x, n, sums), type=pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), spread, pa.array(((x - center) @ projection).ravel()),
                 pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def apply(rows: DataFrame, model: Whitening | None, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable row and component."""
    fields = [T.StructField(id, rows.schema[id].dataType), *(T.StructField(name, kind) for name, kind in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()),
        ("explained", T.DoubleType()), ("identity_error", T.DoubleType())))]
    if model is None:
        return rows.sparkSession.createDataFrame([], T.StructType(fields))
    return rows.select(id, vector).mapInArrow(_whitened(model), T.StructType(fields))


def whiten(rows: DataFrame, components: int | None = 4, id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error of every usable row.

    Rows drop out whose vector is null or empty, holds a null, non-finite or
    ``scale`` times too large (beyond 64 bits) entry, or has not the length
    that most distinct vectors have (of two equally frequent lengths the larger
    counts). Rows with a null or repeated id stay, each with its own result;
    repeated vectors count once in the fit. An empty table, or vectors that are
    all equal, give no rows, as there is no component with variance. Other
    columns are ignored.
    """
    return apply(rows, fit(rows, components, vector, scale), id, vector)
