"""Whitening on principal components found by QDWH spectral divide and conquer.

The covariance of the distinct vectors is summed on the executors; it is a
matrix of the dimension squared, whatever the rows.  The polar factor of the
shifted covariance, by the QR-based dynamically weighted Halley iteration, is the
matrix sign function: half of it plus the identity projects on the eigenvectors
above the shift.  Bases of that subspace and of its complement split the matrix
in two, and so on until a part is a multiple of the identity.  Parts of larger
eigenvalues are split first, and no others than the components asked for need.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairgrade.llm.vectors import integer_vectors
from pairgrade.sources.sinks import materialize

COMPONENTS = 4
EPS = float(np.finfo(float).eps)
#: Shifts tried in turn: the mean eigenvalue and so many deviations from it.
SHIFTS = (0.0, 0.01, -0.01, 0.1, -0.1, 0.03, -0.03, 0.3, -0.3)


# ---------------------------------------------------------------------------
# Spectral divide and conquer (numpy, on one matrix of the dimension squared)
# ---------------------------------------------------------------------------
def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix that has an inverse."""
    eye = np.eye(len(a))
    x = a / np.linalg.norm(a)
    low = min(1.0, 1.0 / np.linalg.norm(np.linalg.inv(x), 1))  # at most the least singular value
    for _ in range(50):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square ** 2)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:len(a)] @ q[len(a):].T)
        else:
            new = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(eye + wc * (x.T @ x), x.T).T
        new = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        moved = np.linalg.norm(new - x)
        x = new
        if 1 - low <= 10 * EPS and moved <= np.cbrt(EPS):
            break
    return x


def split_at(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below ``shift``;
    nothing if one is empty or the shift lies too close to an eigenvalue."""
    n = len(a)
    try:
        sign = polar_factor(a - shift * np.eye(n))
    except np.linalg.LinAlgError:
        return None
    projector = (sign + np.eye(n)) / 2
    trace = np.trace(projector)
    k = int(round(trace)) if np.isfinite(trace) else 0
    if not 0 < k < n:
        return None
    start = np.random.default_rng(n).standard_normal((n, k))
    for _ in range(2):
        start, _ = np.linalg.qr(projector @ start)
    both, _ = np.linalg.qr(start, mode="complete")
    above, below = both[:, :k], both[:, k:]
    if np.linalg.norm(below.T @ a @ above) > 100 * n * EPS * np.linalg.norm(a):
        return None
    return above, below


def leading_components(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows): the ``wanted`` largest of a
    symmetric matrix, falling.  Eigenvalues that rounding cannot tell apart
    share their subspace, of which any basis serves."""
    a = (a + a.T) / 2
    scale = np.linalg.norm(a)
    found: list[np.ndarray] = []
    todo = [np.eye(len(a))]
    while todo and len(found) < wanted:
        basis = todo.pop()
        own = basis.T @ a @ basis
        own = (own + own.T) / 2
        mean = np.trace(own) / len(own)
        spread = np.linalg.norm(own - mean * np.eye(len(own)))
        parts = None
        if len(own) > 1 and spread > len(own) * EPS * scale:
            tried = (split_at(own, mean + t * spread / np.sqrt(len(own))) for t in SHIFTS)
            parts = next((p for p in tried if p is not None), None)
        if parts is None:
            found.extend(basis.T)
        else:
            todo += [basis @ parts[1], basis @ parts[0]]
    vectors = np.array(found)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    values = np.einsum("ij,jk,ik->i", vectors, a, vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[order]


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------
@dataclass
class Whitening:
    """``sums`` are exact; ``values`` and ``vectors`` (rows) those of the
    covariance of the ``n`` distinct vectors."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim)


def fit_whitening(fit: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """``fit``: (x), distinct vectors of one dimension, one at least.  The
    driver gets ``dim`` sums and a matrix of ``dim`` squared numbers.

    Components without variance (of an eigenvalue that rounding cannot tell
    from zero) are left out."""
    sums = (fit.select(F.posexplode("x").alias("at", "x"))
            .groupBy("at").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("total"), F.count("*").alias("n"))
            .orderBy("at").collect())
    n, totals = sums[0].n, [int(row.total) for row in sums]
    mean = np.array([t / n for t in totals])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                centred = _matrix(batch.column(0), dim) - mean
                acc += centred.T @ centred
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(list(acc))],
                                         names=["i", "products"])

    cells = (fit.mapInArrow(products, "i int, products array<double>")
             .select("i", F.posexplode("products").alias("j", "product"))
             .groupBy("i", "j").agg(F.sum("product").alias("product")).toArrow())
    cov = np.zeros((dim, dim))
    cov[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["product"].to_numpy() / n
    trace = float(np.trace(cov))
    values, vectors = leading_components(cov, min(components, dim))
    some = values > dim * EPS * trace
    return Whitening(n, totals, values[some], vectors[some], trace)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S) squared, exact; null beyond a long."""
    top = n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, sums), default=0)
    if top * top * x.shape[1] < 1 << 63:
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return [v if v < 1 << 63 else None for v in exact]


def _project(rows: DataFrame, dim: int, model: Whitening) -> DataFrame:
    """``vec_id, deviation, w``: the whitened vector."""
    mean = np.array([t / model.n for t in model.sums])
    turn = (model.vectors / np.sqrt(model.values)[:, None]).T
    sent = rows.sparkSession.sparkContext.broadcast((model.n, model.sums, mean, turn))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, mean, turn = sent.value
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1), dim)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(_deviations(x, n, sums), pa.int64()), pa.array(list((x - mean) @ turn))],
                    names=["vec_id", "deviation", "w"])

    return rows.select("vec_id", "x").mapInArrow(run, "vec_id bigint, deviation bigint, w array<double>")


def whitened_embeddings(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                        components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error),
    a row for each usable vector and component.

    Which vectors are usable, and their integers: ``integer_vectors``.  The fit
    list has each distinct vector once, however often it stands; repeated rows
    are whitened each, also those without an id.  A component without variance
    has no rows, so a table with fewer than two distinct vectors, or an empty
    one, gives none.  ``deviation`` is null beyond a long.  Other columns are
    ignored."""
    rows, dim = integer_vectors(df, id_col, vector_col)
    empty = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, " \
            "identity_error double"
    if not dim:
        return df.sparkSession.createDataFrame([], empty)
    fit = materialize(rows.select("x").distinct(), "whitening-fit")
    model = fit_whitening(fit, dim, components)
    k = len(model.values)
    if not k:
        return df.sparkSession.createDataFrame([], empty)
    w = [F.col("w")[i] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = _project(fit.select(F.lit(0).cast("bigint").alias("vec_id"), "x"), dim, model).agg(
        *[F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return (_project(rows, dim, model).select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"),
                    "deviation", "whitened", share[F.col("at")].alias("explained"),
                    F.lit(float(error)).alias("identity_error")))
