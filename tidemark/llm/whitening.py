"""PCA whitening of embeddings.

Entries become integers x = floor(64 * c) + 1,000,000. The fit list, each distinct
x once, is written by Spark; two passes over it give the exact sums S with the
covariance centred before multiplying: tasks add up blocks in numpy and emit
partial sums, which Spark adds. Only the d x d matrix reaches the driver (d at most
``MAX_DIMENSIONS``). There Householder reflections make it tridiagonal, Sturm counts
bisect the leading eigenvalues, and inverse iteration gives their vectors,
reorthogonalised within clusters of near eigenvalues. The projection is broadcast. A
third pass over the fit list measures how far the whitened covariance is from the
identity.

Rows whose vector is null, or holds null or non-finite entries or entries with
|64 * c| >= 2**52 (which have no exact x), are dropped, as are vectors of another
length than most (of equally frequent lengths the greater counts). Repeated vectors
count once in the fit and are projected each; null or repeated vec_ids are kept.
Components whose eigenvalue is zero to double precision can't be whitened: their
``whitened`` is null, and they are left out of ``identity_error`` (null if none is
left). ``explained`` is null if all vectors are equal. A ``deviation`` beyond a long
is null. Equal eigenvalues: any orthonormal vectors of their space, the same for all
rows. Very long vectors: beyond ``MAX_DIMENSIONS`` an error. An empty table gives an
empty result. Only the two named columns are read, so others can't clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import dropped, shuffle_width, table, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
MAX_DIMENSIONS = 2048
BLOCK = 4096
EPS = float(np.finfo(float).eps)
LONG = 2**63 - 1

PROJECTED = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
             "identity_error double")


# -- symmetric eigenproblem -----------------------------------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder: diagonal, off-diagonal and the reflectors (row k acts on entries k + 1 on)."""
    a = np.array(matrix, float)
    n = len(a)
    reflectors = np.zeros((max(n - 2, 0), n))
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        scale = np.abs(x[1:]).max()
        if scale == 0:
            continue
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        v = x / np.linalg.norm(x)
        reflectors[k, k + 1:] = v
        block = a[k + 1:, k + 1:]
        p = block @ v
        w = p - (v @ p) * v
        block -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] -= 2 * v * (v @ a[k + 1:, k])
        a[k, k + 1:] = a[k + 1:, k]
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sturm counts: for each x the number of eigenvalues less than it."""
    floor = EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny) * EPS
    q = diagonal[0] - x
    count = (q < 0).astype(int)
    for d, e in zip(diagonal[1:], off):
        q = np.where(np.abs(q) < floor, -floor, q)
        q = d - x - e * e / q
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k greatest eigenvalues, falling, each bisected until its interval can't be halved."""
    n = len(diagonal)
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    low, high = low - 2 * EPS * np.abs(low), high + 2 * EPS * np.abs(high)
    rank = n - 1 - np.arange(k)                     # eigenvalues below the one sought
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            return high
        above = count_below(diagonal, off, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, floor: float) -> np.ndarray:
    """(T - shift) y = right by elimination with row exchanges; zero pivots count as ``floor``."""
    n = len(diagonal)
    b, c, d = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    y = right.copy()
    for i in range(n - 1):
        low = off[i]
        if abs(low) > abs(b[i]):
            factor = b[i] / low
            b[i], c[i], d[i], b[i + 1], c[i + 1] = (low, b[i + 1], c[i + 1], c[i] - factor * b[i + 1],
                                                    -factor * c[i + 1])
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
        else:
            b[i] = b[i] if abs(b[i]) > floor else floor
            factor = low / b[i]
            b[i + 1] -= factor * c[i]
            y[i + 1] -= factor * y[i]
    b[-1] = b[-1] if abs(b[-1]) > floor else floor
    for i in range(n - 1, -1, -1):
        y[i] = (y[i] - (c[i] * y[i + 1] if i + 1 < n else 0) - (d[i] * y[i + 2] if i + 2 < n else 0)) / b[i]
        if i > 1 and abs(y[i]) > 1e200:
            y /= 1e200
    return y


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of falling eigenvalues by inverse iteration."""
    n = len(diagonal)
    norm = max(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0), np.finfo(float).tiny)
    rng = np.random.default_rng(12)
    found = np.zeros((len(values), n))
    first, shift = 0, 0.0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            first = k                                # a gap: a new cluster begins
        # equal shifts would give equal vectors: move them apart within a cluster
        shift = value if k == first else min(value, shift - 10 * EPS * norm)
        y = rng.standard_normal(n)
        for _ in range(6):
            y = solve_shifted(diagonal, off, shift, y, EPS * norm)
            y /= np.abs(y).max()
            for _ in range(2):
                y -= found[first:k].T @ (found[first:k] @ y)
            y /= np.linalg.norm(y)
        found[k] = y
    return found


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as rows."""
    scale = np.abs(matrix).max(initial=0)
    if scale == 0:
        return np.zeros(k), np.eye(k, len(matrix))
    diagonal, off, reflectors = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, off, k)
    vectors = tridiagonal_vectors(diagonal, off, values)
    for v in reflectors[::-1]:
        vectors -= 2 * np.outer(vectors @ v, v)
    vectors = np.linalg.qr(vectors.T)[0].T
    # the vectors' own quotients are closer than the bisected values
    values = np.einsum("ij,jk,ik->i", vectors, matrix, vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[order]


# -- passes over the vectors ------------------------------------------------------------------

def as_integers(vectors: DataFrame, vector: str) -> DataFrame:
    """Usable rows with the column ``x`` of longs and no ``vector``."""
    usable = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double") * SCALE) < 2.0**52))
    return (vectors.filter(F.col(vector).isNotNull()).filter(usable)
            .withColumn("x", F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT))
            .drop(vector))


def _blocks(batches, width: int):
    """(batch, rows x width longs) of at most ``BLOCK`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(width: int):
    def run(batches):
        total = [0] * width
        for _, x in _blocks(batches, width):
            safe = int(np.abs(x).max(initial=0)) * len(x) < 2**62
            total = [a + int(b) for a, b in zip(total, (x if safe else x.astype(object)).sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(map(str, total), pa.string())],
                                         names=["i", "part"])
    return run


class Centre:
    """The mean S / n as a whole part and a rest, so that x - S / n loses no digit."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]
        self.fraction = np.array([r / n for r in self.rest])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.fraction

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)**2 of each row, exactly; None if no long holds it."""
        d = x - self.whole
        most = (int(np.abs(d).max(initial=0)) + 1) * self.n
        if most * most * x.shape[1] < LONG:
            return ((self.n * d - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * d.astype(object) - np.array(self.rest, object)) ** 2).sum(axis=1)
        return [int(v) if v <= LONG else None for v in exact]


def _products(centre: dict, width: int, project: np.ndarray | None = None):
    """Partial sums of centred products (of the projections, if given), upper triangle."""
    def run(batches):
        centred = Centre(**centre)
        size = width if project is None else len(project)
        total, first = np.zeros((size, size)), np.zeros(size)
        for _, x in _blocks(batches, width):
            c = centred(x) if project is None else centred(x) @ project.T
            total += c.T @ c
            first += c.sum(axis=0)
        i, j = np.triu_indices(size)
        # the sums themselves travel as row -1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, np.full(size, -1)), pa.int32()), pa.array(np.append(j, np.arange(size)), pa.int32()),
             pa.array(np.append(total[i, j], first))], names=["i", "j", "part"])
    return run


def _covariance(fit: DataFrame, centre: dict, width: int, project: np.ndarray | None = None) -> np.ndarray:
    """Covariance over the fit list, divisor n; one row of the matrix' triangle an entry on the driver."""
    rows = (fit.mapInArrow(_products(centre, width, project), "i int, j int, part double")
            .groupBy("i", "j").agg(F.sum("part").alias("part")).toArrow())
    i, j, part = (rows.column(c).to_numpy() for c in ("i", "j", "part"))
    size = width if project is None else len(project)
    mean = np.zeros(size)
    mean[j[i < 0]] = part[i < 0] / centre["n"]
    out = np.zeros((size, size))
    out[i[i >= 0], j[i >= 0]] = out[j[i >= 0], i[i >= 0]] = part[i >= 0] / centre["n"]
    return out - np.outer(mean, mean)


def whiten(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS
           ) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error) for every usable
    vector and each of its first ``components`` components."""
    spark = vectors.sparkSession
    usable = as_integers(vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v")), "v")
    lengths = (usable.filter(F.size("x") > 0).groupBy(F.size("x").alias("d")).count()
               .orderBy(F.desc("count"), F.desc("d")).first())
    if lengths is None:
        return spark.createDataFrame([], PROJECTED)
    width = lengths["d"]
    if width > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {width} dimensions: at most {MAX_DIMENSIONS}")
    usable = usable.filter(F.size("x") == width)
    # equal vectors meet after a partial aggregate in each task
    fit = written(usable.select("x").distinct(), "whiten-fit")
    n = fit.count()
    # partial sums: at most one set of matrix entries a shuffle partition
    fit = fit.coalesce(shuffle_width(spark))
    sums = (fit.mapInArrow(_sums(width), "i int, part string").groupBy("i")
            .agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s")).collect())
    centre = {"n": n, "sums": [int(s) for _, s in sorted((r["i"], r["s"]) for r in sums)]}
    covariance = _covariance(fit, centre, width)
    k = min(components, width)
    values, axes = leading_eigenpairs(covariance, k)
    trace = float(np.trace(covariance))
    positive = values > width * EPS * max(values[0], 0.0)
    project = axes[positive] / np.sqrt(values[positive])[:, None]
    error = None
    if positive.any():
        error = float(np.abs(_covariance(fit, centre, width, project) - np.eye(len(project))).max())
    dropped(fit)
    explained = [float(v) / trace if trace > 0 else None for v in values]
    shared = spark.sparkContext.broadcast((project, explained, positive))

    def run(batches):
        project, explained, positive = shared.value
        centred = Centre(**centre)
        for part, x in _blocks(batches, width):
            rows = len(x)
            white = np.full((rows, k), np.nan)
            white[:, positive] = centred(x) @ project.T
            each = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                 pa.array(np.full(rows * k, n), pa.int64()), pa.array(centred.deviation(x), pa.int64()).take(pa.array(each)),
                 pa.array(white.ravel(), mask=np.tile(~positive, rows)), pa.array(explained * rows, pa.float64()),
                 pa.array([error] * (rows * k), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return usable.select("vec_id", "x").mapInArrow(run, PROJECTED)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 16 leading whitened components of every usable embedding."""
    return whiten(table(spark, sf_dir, "embeddings"))
