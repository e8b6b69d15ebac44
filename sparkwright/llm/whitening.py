"""Embedding whitening by principal components.

Vectors become whole numbers x = floor(64 * c) + 1000000. The fit list is every distinct x vector once (a
grouping by the vector, combined map-side, so a vector that holds a third of the rows is one row per task). Its
per-dimension sums S are exact. Every task subtracts the whole number nearest the mean before it multiplies, so a
partial covariance is a small matrix of whole numbers; the partial matrices are added up by cell and only the
d x d matrix reaches the driver (d is the dimension of one vector, never a number of rows). There it is brought to
tridiagonal form by Householder reflections; Sturm counts bisect for the leading eigenvalues, inverse iteration
finds their vectors (those of close eigenvalues are kept orthogonal to each other), and the reflections
bring them back. Components are broadcast (at most d x k numbers) and rows are projected where they lie.

Defined cases: rows whose vector is null, empty, or holds a null, a non-finite entry or one of magnitude 2^31 or
more (its x and their products would not fit) are dropped. Vectors of another length than the table's are
dropped as well; the table's length is the one most distinct vectors have, the longer one in a tie. Repeated rows
and repeated or null ids are rows of their own with equal results. Directions with no more than 1e-11 of the largest
eigenvalue hold no measurable variance and are not components: a table of one distinct vector, like an empty
one, gives no rows. A deviation that does not fit a long is null. Other columns of the table are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkwright.session import stored

SCALE, SHIFT = 64.0, 1_000_000
LARGEST = float(1 << 31)
NO_VARIANCE = 1e-11


@dataclass
class Whitening:
    """n distinct vectors with sums S; components as rows (k x d), their eigenvalues and the covariance's trace."""
    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None = None


# ---------------------------------------------------------------- symmetric eigenproblem (one d x d matrix)
def householder(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and unit reflection vectors of a symmetric matrix's tridiagonal form."""
    a = a.copy()
    d = len(a)
    reflections = []
    for k in range(d - 2):
        v = a[k + 1:, k].copy()
        length = np.linalg.norm(v)
        if length > 0:
            v[0] += np.copysign(length, v[0])
            v /= np.linalg.norm(v)
            block = a[k + 1:, k + 1:]
            p = block @ v
            w = p - (v @ p) * v
            block -= 2.0 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1:, k] -= 2.0 * v * (v @ a[k + 1:, k])
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def count_below(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: for every point of ``at``, how many eigenvalues of the tridiagonal matrix lie below it."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    q = diag[0] - at
    below = (q < 0).astype(int)
    for i in range(1, len(diag)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = diag[i] - at - off[i - 1] ** 2 / q
        below += q < 0
    return below


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected until no double lies between its bounds."""
    d = len(diag)
    reach = np.abs(np.r_[off, 0.0]) + np.abs(np.r_[0.0, off])
    lo = np.full(k, (diag - reach).min())
    hi = np.full(k, (diag + reach).max())
    span = max(abs(lo[0]), abs(hi[0]))
    lo, hi = lo - 1e-12 * span - 1e-300, hi + 1e-12 * span + 1e-300
    rank = d - np.arange(k)                    # the j-th largest has d - j eigenvalues at or below it
    while True:
        mid = lo + (hi - lo) / 2
        if ((mid <= lo) | (mid >= hi)).all():
            return mid
        above = count_below(diag, off, mid) >= rank
        hi, lo = np.where(above, mid, hi), np.where(above, lo, mid)


def _solver(diag: np.ndarray, off: np.ndarray, shift: float, floor: float):
    """Solve (T - shift) y = b again and again: elimination with row exchanges, pivots of at least ``floor``."""
    d = len(diag)
    p, u, w, below = diag - shift, np.r_[off, 0.0], np.zeros(d), np.r_[off, 0.0]
    factor, swapped = np.zeros(d), np.zeros(d, bool)
    for i in range(d - 1):
        if abs(below[i]) > abs(p[i]):
            swapped[i] = True
            factor[i] = p[i] / below[i]
            p[i], u[i], w[i], p[i + 1], u[i + 1] = below[i], p[i + 1], u[i + 1], u[i] - factor[i] * p[i + 1], -factor[i] * u[i + 1]
        else:
            if abs(p[i]) < floor:
                p[i] = floor
            factor[i] = below[i] / p[i]
            p[i + 1] -= factor[i] * u[i]
    if abs(p[-1]) < floor:
        p[-1] = floor

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.copy()
        for i in range(d - 1):
            if swapped[i]:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= factor[i] * y[i]
        for i in range(d - 1, -1, -1):
            rest = u[i] * y[i + 1] if i + 1 < d else 0.0
            rest += w[i] * y[i + 2] if i + 2 < d else 0.0
            y[i] = (y[i] - rest) / p[i]
        return y
    return solve


def tridiagonal_vectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) by inverse iteration; a cluster's vectors are orthogonalised in every step."""
    d = len(diag)
    norm = max(np.abs(diag).max(), np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    floor, gap = np.finfo(float).eps * norm, 1e-3 * norm
    found: list[np.ndarray] = []
    cluster = 0                                # first vector of the cluster that the current value belongs to
    shift = np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > gap:
            cluster = j
        # equal eigenvalues get shifts a few roundings apart, so that their systems differ
        shift = min(value, shift - 4 * floor) if j > cluster else value
        solve = _solver(diag, off, shift, floor)
        y = np.random.default_rng(j).uniform(-1.0, 1.0, d)
        for _ in range(5):
            y = solve(y / np.linalg.norm(y))
            y /= np.abs(y).max()
            for _ in range(2):                 # twice is enough for orthogonality to rounding
                for z in found[cluster:]:
                    y -= (z @ y) * z
        found.append(y / np.linalg.norm(y))
    return np.array(found)


def leading_components(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of a symmetric matrix, largest first, at most k, without null directions."""
    diag, off, reflections = householder(cov)
    values = leading_eigenvalues(diag, off, min(k, len(diag)))
    values = values[values > NO_VARIANCE * max(values[0], 0.0)]
    if not len(values):
        return values, np.zeros((0, len(diag)))
    vectors = tridiagonal_vectors(diag, off, values)
    for i in range(len(reflections) - 1, -1, -1):
        v, part = reflections[i], vectors[:, i + 1:]
        part -= 2.0 * np.outer(part @ v, v)
    return values, vectors


# ---------------------------------------------------------------- Spark side
def whole_numbers(vector: str = "embedding") -> Column:
    """The vector as x, null where the row is to be dropped."""
    c = F.col(f"`{vector}`").cast("array<double>")
    fits = (F.size(c) > 0) & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LARGEST))
    return F.when(fits, F.transform(c, lambda e: F.floor(e * F.lit(SCALE)).cast("long") + F.lit(SHIFT)))


def _matrix(batch: pa.RecordBatch, name: str, d: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().reshape(-1, d)


def _added(parts: DataFrame, d: int) -> np.ndarray:
    """Cells of partial matrices (row, cells) added up by Spark; d x d numbers come to the driver."""
    cells = parts.select("row", F.posexplode("cells").alias("at", "v")).groupBy("row", "at").agg(F.sum("v").alias("v"))
    table = cells.toArrow()
    out = np.zeros((table.column("row").to_numpy().max(initial=-1) + 1, d))
    out[table.column("row").to_numpy(), table.column("at").to_numpy()] = table.column("v").to_numpy()
    return out


def _cross_products(prepare, d: int):
    """Task body: the sums and the cross products of prepare(x), one row of cells per row of the matrix (sums last)."""
    def run(batches):
        total, cross = np.zeros(d), np.zeros((d, d))
        for batch in batches:
            y = prepare(batch)
            total += y.sum(axis=0)
            cross += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array([*cross, total], pa.list_(pa.float64()))],
                                         names=["row", "cells"])
    return run


def fit(df: DataFrame, k: int = 16, vector: str = "embedding") -> Whitening | None:
    """Whitening of df's vectors with up to k components; None if no vector is left or none varies."""
    x = df.select(whole_numbers(vector).alias("x")).where(F.col("x").isNotNull())
    distinct = stored(x.groupBy("x").agg(F.lit(1).alias("one")).select("x", F.size("x").alias("d")), "distinct_vectors")
    length = distinct.groupBy("d").count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    if length is None:
        return None
    d, n = int(length["d"]), int(length["count"])
    rows = distinct.where(F.col("d") == d).select("x")

    def sums(batches):
        total = np.zeros(d, np.int64)
        for batch in batches:
            total += _matrix(batch, "x", d).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], names=["s"])

    total = (rows.mapInArrow(sums, "s array<long>").select(F.posexplode("s").alias("at", "v"))
             .groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect())      # d rows
    exact = np.array([int(r["v"]) for r in sorted(total, key=lambda r: r["at"])], object)
    whole = np.array([(2 * int(s) + n) // (2 * n) for s in exact], np.int64)          # the whole number nearest S / n
    rest = np.array([(int(s) - n * int(m)) / n for s, m in zip(exact, whole)])         # S / n - whole, within a half

    # whole-number products: exact in doubles, whatever the order, while a cell's total stays under 2^53
    cells = _added(rows.mapInArrow(_cross_products(lambda b: (_matrix(b, "x", d) - whole).astype(float), d),
                                   "row int, cells array<double>"), d)
    cov = cells[:d] / n - np.outer(rest, rest)
    values, vectors = leading_components((cov + cov.T) / 2, k)
    model = Whitening(n, exact, vectors, values, float(np.trace(cov)))
    if not len(values):
        return None
    model.identity_error = _identity_error(rows, model, whole, rest)
    return model


def _projector(model: Whitening, whole: np.ndarray, rest: np.ndarray):
    scaled = (model.components / np.sqrt(model.eigenvalues)[:, None]).T
    return lambda x: ((x - whole).astype(float) - rest) @ scaled


def _identity_error(rows: DataFrame, model: Whitening, whole: np.ndarray, rest: np.ndarray) -> float:
    """Largest entry of |covariance of the whitened fit list - identity|, from another pass over it."""
    d, k, project = len(whole), len(model.eigenvalues), _projector(model, whole, rest)
    cells = _added(rows.mapInArrow(_cross_products(lambda b: project(_matrix(b, "x", d)), k), "row int, cells array<double>"), k)
    mean = cells[k] / model.n
    return float(np.abs(cells[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(y: np.ndarray, n: int, offset: np.ndarray) -> list:
    """Sum over dimensions of (n y - offset)^2 as exact whole numbers; None where it does not fit a long."""
    far = n * float(np.abs(y).max(initial=0)) + float(max(map(abs, offset), default=0))
    if far * far * y.shape[1] < 2.0 ** 62:
        z = n * y - offset.astype(np.int64)
        return (z * z).sum(axis=1).tolist()
    z = n * y.astype(object) - offset
    return [int(v) if v < 1 << 63 else None for v in (z * z).sum(axis=1)]


def transform(df: DataFrame, model: Whitening, vector: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all but the vector) in a struct ``row``, ``deviation`` and ``whitened`` (array of k doubles)."""
    keep = [c for c in df.columns if c != vector] if keep is None else keep
    n, d = model.n, len(model.sums)
    whole = np.array([(2 * int(s) + n) // (2 * n) for s in model.sums], np.int64)
    offset = np.array([int(s) - n * int(m) for s, m in zip(model.sums, whole)], object)
    project = _projector(model, whole, np.array([o / n for o in offset]))
    x = whole_numbers(vector)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in keep], F.lit(None).cast("boolean").alias("_")).alias("row"), x.alias("x")) \
        .where(F.col("x").isNotNull() & (F.size("x") == d)).withColumn("row", F.col("row").dropFields("_") if keep else F.col("row"))

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            values = _matrix(batch, "x", d)
            white = project(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(_deviations(values - whole, n, offset), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(white) + 1) * white.shape[1], pa.int32()), pa.array(white.ravel()))],
                names=["row", "deviation", "whitened"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, deviation long, whitened array<double>")


OUTPUT = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def components_of_rows(df: DataFrame, k: int = 16, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per remaining row and component: id, component (from 1), n, deviation, whitened, explained, identity_error."""
    model = fit(df, k, vector)
    if model is None:
        return df.sparkSession.createDataFrame([], OUTPUT.format(id=df.schema[id_col].dataType.simpleString())) \
            .withColumnRenamed("vec_id", id_col)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
    return transform(df, model, vector, [id_col]).select(
        F.col(f"row.`{id_col}`").alias(id_col), "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        id_col, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("at")].alias("explained"), F.lit(model.identity_error).alias("identity_error"))
