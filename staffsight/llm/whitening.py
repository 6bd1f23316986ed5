"""Operator 13, embedding whitening by spectrum slicing.

Fit. Entries become integers, so sums are exact and do not depend on how rows are dealt: one pass
counts the vectors and sums each dimension, a second sums the products of entries that were
centred at the rounded mean; the rest of the mean (below one half) is taken out of the exact
sums, and only then is the covariance rounded to doubles. What reaches the driver is one number
for each pair of dimensions, however many rows there are.

Spectrum slicing. The LDL^T factors of the covariance minus a shift have as many positive pivots
as there are eigenvalues above the shift (Sylvester). Bisection by these counts isolates each
leading eigenvalue in an interval of its own; inverse iteration from the middle and Rayleigh
quotient iteration, which converges cubically, find its vector. A quotient that leaves the
interval halves the interval and starts anew. At the end the counts just below and just above the
quotient must be k and k - 1, which certifies the component's number. Eigenvalues closer than
the rounding of the matrix cannot be told apart: they share one interval, and their vectors are
an orthonormal basis of its space.

Transform. Each row is centred by the exact sums, projected and scaled; the covariance of the
whitened rows is then measured on the written rows themselves.

Defined results: vectors that are null, or hold null or non-finite entries, are dropped, as are
those with an entry of 2^40 or more in size (their sums would not fit) and those of another length
than most (ties: the longer); repeated rows count each; a null vec_id is kept; directions
without variance (an eigenvalue that is zero within rounding) give no component, so that equal
vectors, a single one or an empty table give no rows; only vec_id and the vectors are read.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save, ship

ship(__name__)

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Entries must be smaller than this; vectors may be this long, as a matrix of that width meets the driver.
LARGEST, MAX_DIM = float(1 << 40), 4096
#: Sums of products below this are exact in doubles.
EXACT = 1 << 53


def usable(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, v (array of double) of the rows that take part, but for their length."""
    rows = embeddings.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST))
    return rows.where(F.col("v").isNotNull() & F.forall("v", fine))


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    """The entries of a batch of vectors as integers, a row for each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return np.floor(SCALE * flat).astype(np.int64) + SHIFT


def _size(values: np.ndarray) -> int:
    return int(np.abs(values).max(initial=0))


def _sums(dim: int):
    def run(batches):
        total, n = np.zeros(dim, object), 0
        for batch in batches:
            x = _integers(batch.column(0), dim)
            total += x.astype(object).sum(0) if _size(x) * max(len(x), 1) >= 1 << 62 else x.sum(0)
            n += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array([str(int(t)) for t in total], pa.string())], names=["i", "n", "total"])
    return run


def _products(dim: int, centre: np.ndarray):
    """Exact sums of products of centred entries over a task's rows."""
    def run(batches):
        total = np.zeros((dim, dim), object)
        for batch in batches:
            y = _integers(batch.column(0), dim) - centre
            step = EXACT // max(_size(y), 1) ** 2
            if step:
                for at in range(0, len(y), step):
                    part = y[at:at + step].astype(np.float64)
                    total += (part.T @ part).astype(np.int64)
            else:
                total += y.T.astype(object) @ y.astype(object)
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array([str(int(t)) for t in total[i, j]], pa.string())], names=["i", "j", "total"])
    return run


def positives(matrix: np.ndarray) -> int:
    """Number of positive eigenvalues, by LDL^T with pivots of one or two rows (Bunch and Kaufman)."""
    a, count = matrix.copy(), 0
    limit = (1 + 17 ** 0.5) / 8

    def swap(p, q):
        a[[p, q]] = a[[q, p]]
        a[:, [p, q]] = a[:, [q, p]]

    while len(a):
        column = np.abs(a[1:, 0])
        r = int(column.argmax()) + 1 if len(column) else 0
        largest = column[r - 1] if r else 0.0
        if max(abs(a[0, 0]), largest) == 0:
            a = a[1:, 1:]
            continue
        wide = 1
        if abs(a[0, 0]) < limit * largest:
            row = np.abs(a[r])
            row[r] = 0
            if abs(a[0, 0]) * row.max() < limit * largest ** 2:
                if abs(a[r, r]) >= limit * row.max():
                    swap(0, r)
                else:
                    swap(1, r)
                    wide = 2
        if wide == 1:
            count += a[0, 0] > 0
            a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0] / a[0, 0])
        else:  # such a pair of rows has one positive and one negative eigenvalue
            count += 1
            a = a[2:, 2:] - a[2:, :2] @ np.linalg.solve(a[:2, :2], a[:2, 2:])
    return int(count)


class Slices:
    """Counts of eigenvalues above shifts, and the brackets that they give."""

    def __init__(self, matrix: np.ndarray):
        self.matrix, self.size = matrix, len(matrix)
        self.trace = float(np.trace(matrix))
        #: What rounding can move an eigenvalue.
        self.blur = 8 * self.size * np.finfo(float).eps * self.trace
        self.known = {self.trace * 1.01: 0}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = positives(self.matrix - shift * np.eye(self.size))
        return self.known[shift]

    def bracket(self, k: int) -> tuple[float, float]:
        """Shifts with at least k, and with fewer than k, eigenvalues above."""
        return (max(s for s, n in self.known.items() if n >= k), min(s for s, n in self.known.items() if n < k))

    def isolate(self, k: int) -> tuple[float, float]:
        """The bracket of the k-th eigenvalue alone, or one as narrow as rounding lets it be."""
        low, high = self.bracket(k)
        while self.known[low] - self.known[high] > 1 and high - low > self.blur:
            self.above((low + high) / 2)
            low, high = self.bracket(k)
        return low, high


def _solve(matrix: np.ndarray, shift: float, v: np.ndarray, nudge: float) -> np.ndarray:
    """Unit columns along (matrix - shift)^-1 v."""
    for step in (0.0, nudge, 3 * nudge):
        try:
            out = np.linalg.solve(matrix - (shift + step) * np.eye(len(matrix)), v)
        except np.linalg.LinAlgError:
            continue
        largest = np.abs(out).max(axis=0)
        if np.isfinite(out).all() and (largest > 0).all():
            out = out / largest
            return out / np.linalg.norm(out, axis=0)
    return v / np.linalg.norm(v, axis=0)


def _apart(v: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """v without its part along the vectors found so far, as a unit vector."""
    for _ in range(2):
        for u in found:
            v = v - (u @ v) * u
    return v / np.linalg.norm(v)


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Values (falling) and unit vectors (rows) of the ``count`` leading eigenpairs with variance.

    ``matrix`` is a covariance. A vector's entry of largest size is positive.
    """
    size = len(matrix)
    slices = Slices(matrix)
    values, vectors = [], []
    if not slices.trace > 0:
        return np.zeros(0), np.zeros((0, size))
    count = min(count, slices.above(slices.blur))
    start = np.random.default_rng(size).standard_normal((size, size))
    while len(values) < count:
        k = len(values) + 1
        low, high = slices.isolate(k)
        alone = slices.known[low] - slices.known[high] == 1
        if alone:
            value, vector = _rayleigh(slices, k, start[0], vectors)
            group = [(value, vector)]
        else:
            block = start[:slices.known[low] - slices.known[high]].T
            for _ in range(4):
                block = _solve(matrix, (low + high) / 2, block, slices.blur)
                block = np.linalg.qr(block - sum((np.outer(u, u @ block) for u in vectors), np.zeros_like(block)))[0]
            group = sorted(((float(u @ matrix @ u), u) for u in block.T), key=lambda g: -g[0])
        for value, vector in group[:count - len(values)]:
            values.append(value)
            vectors.append(vector * np.sign(vector[np.abs(vector).argmax()]))
    return np.array(values), np.array(vectors).reshape(-1, size)


def _quotient(matrix: np.ndarray, v: np.ndarray) -> tuple[float, float]:
    """Rayleigh quotient of a unit vector and the size of its residual."""
    image = matrix @ v
    value = float(v @ image)
    return value, float(np.linalg.norm(image - value * v))


def _rayleigh(slices: Slices, k: int, start: np.ndarray, found: list[np.ndarray]) -> tuple[float, np.ndarray]:
    """The k-th eigenpair, which is alone in its bracket."""
    matrix = slices.matrix
    while True:
        low, high = slices.bracket(k)
        v = _apart(start, found)
        for _ in range(3):
            v = _apart(_solve(matrix, (low + high) / 2, v, slices.blur), found)
        value, off = _quotient(matrix, v)
        while off:  # until the residual falls no further
            closer = _apart(_solve(matrix, value, v, slices.blur), found)
            next_value, next_off = _quotient(matrix, closer)
            if not next_off < off:
                break
            v, value, off = closer, next_value, next_off
        # an eigenvalue lies within ``off`` of the quotient; the counts around it say which one
        margin = max(off, slices.blur)
        if low - margin <= value <= high + margin and off <= slices.blur:
            if slices.above(value - 2 * margin) >= k and slices.above(value + 2 * margin) < k:
                return value, v
        if high - low <= slices.blur:
            raise ArithmeticError(f"component {k} cannot be certified")
        slices.above((low + high) / 2)


def fit(vectors: DataFrame, dim: int) -> tuple[int, list[int], np.ndarray]:
    """n, exact sums by dimension, and the covariance of integer vectors (divisor n) in doubles."""
    only = vectors.select("v")
    sums = only.mapInArrow(_sums(dim), "i int, n long, total string").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("i").collect()
    n, totals = int(sums[0]["n"]), [int(r["total"]) for r in sums]
    centre = [(2 * s + n) // (2 * n) for s in totals]
    rows = only.mapInArrow(_products(dim, np.array(centre, np.int64)), "i int, j int, total string").groupBy("i", "j").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    rest = [s - n * c for s, c in zip(totals, centre)]
    covariance = np.zeros((dim, dim))
    for i, j, total in rows:
        covariance[i, j] = covariance[j, i] = float(Fraction(n * int(total) - rest[i] * rest[j], n * n))
    return n, totals, covariance


def _whiten(dim: int, n: int, totals: list[int], values: np.ndarray, vectors: np.ndarray):
    scaled = vectors.T / np.sqrt(values)
    sums = np.array(totals, object)

    def run(batches):
        for batch in batches:
            x = _integers(batch.column(1), dim)
            if _size(x) * n < 1 << 62:
                off = n * x - sums.astype(np.int64)
                small = _size(off) ** 2 * dim < 1 << 62
                deviation = (off * off).sum(1) if small else (off.astype(object) ** 2).sum(1)
            else:
                off = n * x.astype(object) - sums
                deviation = (off ** 2).sum(1)
            w = (off.astype(np.float64) / n) @ scaled
            at = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([str(int(d)) for d in deviation], pa.string()), pa.ListArray.from_arrays(at, pa.array(w.ravel()))],
                names=["vec_id", "deviation", "whitened"])
    return run


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, n, deviation (decimal), whitened (array), explained (array), identity_error for every row that takes part."""
    rows = usable(embeddings, id_col, vec_col)
    spark = rows.sparkSession
    schema = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    most = rows.groupBy(F.size("v").alias("dim")).count().where("dim > 0").orderBy(F.desc("count"), F.desc("dim")).first()
    if most is None:
        return spark.createDataFrame([], schema)
    dim = most["dim"]
    if dim > MAX_DIM:
        raise ValueError(f"vectors have {dim} entries; {MAX_DIM} at most are supported")
    rows = rows.where(F.size("v") == dim)
    n, totals, covariance = fit(rows, dim)
    values, vectors = leading(covariance, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    made = save(rows.mapInArrow(_whiten(dim, n, totals, values, vectors), "vec_id long, deviation string, whitened array<double>"), "whitened")
    count = len(values)
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    flat = made.select(*(F.get("whitened", F.lit(i)).alias(f"w{i}") for i in range(count)))
    covered = flat.agg(*(F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs)).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(covered, pairs))
    explained = F.array(*(F.lit(float(v / np.trace(covariance))) for v in values))
    return made.select("vec_id", F.lit(n).cast("long").alias("n"), F.col("deviation").cast("decimal(38,0)").alias("deviation"), "whitened",
                       explained.alias("explained"), F.lit(float(error)).alias("identity_error"))


def whitening_report(embeddings: DataFrame) -> DataFrame:
    """The query: a row for each vector and component; a deviation beyond a long is null."""
    rows = whiten(embeddings)
    flat = rows.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "explained", "identity_error",
                       F.posexplode("whitened").alias("place", "whitened"))
    return flat.select("vec_id", (F.col("place") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                       F.get("explained", F.col("place")).alias("explained"), "identity_error")
