"""Operator 12, embedding whitening: principal components by QDWH spectral divide and conquer, broadcast to all rows.

Vectors become whole numbers x = floor(1024 c) + 100000. Spark adds up their number, the sums of each dimension (exact) and
the products of the centred values (whole numbers as well: doubles hold them exactly below 2^53). The driver holds one
matrix of dimension^2 doubles, never rows. There the covariance is split recursively: the polar factor of the matrix
shifted by its mean eigenvalue (QDWH: dynamically weighted Halley steps by QR, Nakatsukasa and Higham, 2013) has +1 and -1
for eigenvalues above and below the shift, so (U + I) / 2 projects on the upper invariant subspace; each side is compressed
and split again until single vectors are left. The upper side goes first, and it ends once the components wanted are out.
The whitening matrix (dimension x components) is broadcast.

Definite results: vectors that are null or hold a null or a non-finite entry have no rows and take no part. A shorter vector
counts as if zeros followed, up to the longest. Null keys and repeated rows are rows like others; an empty table gives an
empty one. floor(1024 c) saturates at 2^61 on either side; a deviation that a long can't hold is null. A component without variance (up
to rounding) has null ``whitened`` and takes no part in ``identity_error``, which is null if no component has any. ``explained`` is null if
nothing varies. Equal eigenvalues: any orthonormal basis of their subspace. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
_EPS = np.finfo(float).eps


# ------------------------------------------------------------------ spectral divide and conquer

def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix: its eigenvectors, with the signs of its eigenvalues."""
    size = len(a)
    x, low = a / np.linalg.norm(a), _EPS
    while True:
        d = np.cbrt(4 * (1 - low**2) / low**4)
        p = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + d)))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        basis = np.linalg.qr(np.vstack([np.sqrt(r) * x, np.eye(size)]))[0]
        after = q / r * x + (p - q / r) / np.sqrt(r) * basis[:size] @ basis[size:].T
        after = (after + after.T) / 2
        moved = np.linalg.norm(after - x)
        x, low = after, min(1.0, low * (p + q * low**2) / (1 + r * low**2))
        if abs(1 - low) < 10 * _EPS and moved < np.cbrt(_EPS) * np.sqrt(size):
            return x


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the invariant subspaces above and below the mean eigenvalue."""
    size, rng = len(a), np.random.default_rng(len(a))
    mean = np.trace(a) / size
    spread = np.linalg.norm(a - mean * np.eye(size)) / np.sqrt(size)
    best = None
    for shift in mean + spread * np.array([0, 1e-3, -1e-3, 0.02, -0.02, 0.1, -0.1]):
        projector = (polar(a - shift * np.eye(size)) + np.eye(size)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < size:
            continue
        upper, lower = np.linalg.qr(projector @ rng.standard_normal((size, rank)))[0], None
        for _ in range(2):  # a second step of subspace iteration takes away what the random start left
            upper = np.linalg.qr(projector @ upper)[0]
            lower = np.linalg.qr(np.hstack([upper, (np.eye(size) - projector) @ rng.standard_normal((size, size - rank))]))[0][:, rank:]
        off = np.linalg.norm(upper.T @ a @ lower)
        if best is None or off < best[0]:
            best = off, upper, lower
        if off <= 100 * _EPS * size * np.linalg.norm(a):
            break  # an eigenvalue close to the shift would leave the blocks coupled: then another shift
    return best[1], best[2]


def leading(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    scale = np.linalg.norm(a)
    values, columns = [], []
    todo = [(a, np.eye(len(a)))] if len(a) else []
    while todo and len(values) < wanted:
        part, basis = todo.pop()
        size = len(part)
        mean = np.trace(part) / size
        if size == 1 or np.linalg.norm(part - mean * np.eye(size)) <= 4 * _EPS * scale:
            for k in range(size):
                values.append(float(part[k, k]))
                columns.append(basis[:, k])
            continue
        upper, lower = split(part)
        for side in (lower, upper):  # the last one in is the first one out
            inner = side.T @ part @ side
            todo.append(((inner + inner.T) / 2, basis @ side))
    order = np.argsort(-np.array(values[:wanted]), kind="stable")
    vectors = np.array(columns[:wanted]).reshape(len(order), len(a))[order].T
    return np.array([v @ a @ v for v in vectors.T]), vectors


# ------------------------------------------------------------------ sums over all rows

def usable(table: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id, v (array<double>): rows whose vector has only finite entries."""
    v = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return table.select(F.col(f"`{key}`").cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & ~bad)


def scaled(column: pa.Array, width: int | None = None) -> np.ndarray:
    """floor(SCALE c) of each entry as int64, (rows, width); OFFSET is left off, so missing entries are zeros."""
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.floor(np.asarray(column.flatten(), dtype=float) * SCALE)
    flat = np.clip(flat, -(2.0**61), 2.0**61).astype(np.int64)
    width = int(lengths.max(initial=0)) if width is None else width
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _sums(x: np.ndarray) -> list[int]:
    """Column sums, exact at any size."""
    if len(x) * float(np.abs(x.astype(float)).max(initial=0)) < 2.0**62:
        return [int(s) for s in x.sum(axis=0)]
    return [int(s) for s in x.astype(object).sum(axis=0)]


def counted(vectors: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and the sums of x over them, by dimension: one row per dimension comes to the driver."""
    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, []
        for batch in batches:
            own = _sums(scaled(batch.column(0)))
            total = [a + b for a, b in zip(total + [0] * (len(own) - len(total)), own + [0] * (len(total) - len(own)))]
            rows += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total)), pa.int32()),
                                          pa.array([Decimal(v) for v in (rows, *total)], pa.decimal128(38, 0))], ["i", "s"])

    sums = vectors.select("v").mapInArrow(partial, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))
    found = {r["i"]: int(r["s"]) for r in sums.collect()}
    n = found.get(-1, 0)
    return n, [found[i] + n * OFFSET for i in range(len(found) - 1)]


def _products(vectors: DataFrame, made, width: int) -> np.ndarray:
    """Sum of made(batch)^T made(batch) over all batches: each task adds up its own, the upper triangle is shuffled."""
    upper = np.triu_indices(width)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = made(batch.column(0))
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper])], ["i", "j", "p"])

    sums = vectors.select("v").mapInArrow(partial, "i int, j int, p double").groupBy("i", "j").agg(F.sum("p").alias("p"))
    out = np.zeros((width, width))
    for r in sums.toLocalIterator():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["p"]
    return out


# ------------------------------------------------------------------ the operator

@dataclass
class Whitening:
    """What was fitted: ``sums`` of x, eigenvalues ``e`` and ``vectors`` (columns) of its covariance, that one's trace."""

    n: int
    sums: list[int]
    e: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def __post_init__(self):
        self.varies = self.e > len(self.sums) * 8 * _EPS * max(self.trace, 0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - mean, x without OFFSET."""
        whole, rest = self._mean()
        return (x - whole).astype(float) - rest

    def _mean(self) -> tuple[np.ndarray, np.ndarray]:
        parts = [divmod(s - self.n * OFFSET, self.n) for s in self.sums]
        return np.array([w for w, _ in parts], dtype=np.int64), np.array([r / self.n for _, r in parts])

    def matrix(self) -> np.ndarray:
        """(dimensions, components): centred rows times this are white; zero for components without variance."""
        return self.vectors * np.where(self.varies, 1 / np.sqrt(np.where(self.varies, self.e, 1)), 0)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact."""
        sums = np.array([s - self.n * OFFSET for s in self.sums], dtype=object)
        most = self.n * float(np.abs(x.astype(float)).max(initial=0)) + max([abs(float(s)) for s in sums], default=0)
        if most < 2.0**61 and max(1, len(self.sums)) * most**2 < 2.0**62:
            return (((self.n * x - sums.astype(np.int64)) ** 2).sum(axis=1)).tolist()
        exact = ((self.n * x.astype(object) - sums) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in exact]


def fit(table: DataFrame, components: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id") -> Whitening | None:
    """Fitted on every usable vector; None if there is none."""
    vectors = usable(table, vector, key)
    n, sums = counted(vectors)
    if not n:
        return None
    width = len(sums)
    blank = Whitening(n, sums, np.zeros(0), np.zeros((width, 0)), 0.0)
    whole, rest = blank._mean()
    products = _products(vectors, lambda column: (scaled(column, width) - whole).astype(float), width)
    covariance = products / n - np.outer(rest, rest)  # whole-number centring leaves less than one, taken off here
    fitted = Whitening(n, sums, *leading(covariance, min(components, width)), float(np.trace(covariance)))
    if fitted.varies.any():
        white = fitted.matrix()[:, fitted.varies]
        again = _products(vectors, lambda column: fitted.centred(scaled(column, width)) @ white, white.shape[1]) / n
        fitted.identity_error = float(np.abs(again - np.eye(len(again))).max())
    return fitted


def whiten(table: DataFrame, fitted: Whitening | None, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """A row per usable vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    vectors = usable(table, vector, key)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fitted is None:
        return vectors.where("false").selectExpr("vec_id", "cast(null as int) component", "0L n", "0L deviation", "0D whitened", "0D explained", "0D identity_error").to(
            vectors.sparkSession.createDataFrame([], schema).schema)
    sent = vectors.sparkSession.sparkContext.broadcast((fitted, fitted.matrix()))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, matrix = sent.value
        k = matrix.shape[1]
        explained = [e / model.trace if model.trace > 0 else None for e in model.e]
        for batch in batches:
            size = batch.num_rows
            x = scaled(batch.column(1), len(model.sums))
            white = (model.centred(x) @ matrix).reshape(-1)
            deviations = pa.array(model.deviations(x), pa.int64())
            own = np.repeat(np.arange(size), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(own)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)), pa.array(np.full(size * k, model.n)),
                 deviations.take(pa.array(own)), pa.array(white, mask=np.tile(~model.varies, size)), pa.array(explained * size, pa.float64()),
                 pa.array([model.identity_error] * (size * k), pa.float64())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(rows, schema)
