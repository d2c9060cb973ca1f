"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written

STEPS, SHIFT = 64, 1_000_000
LARGEST = float(1 << 40)  # |64 * entry| beyond this counts as not finite
COMPONENTS = 16
LONG = (1 << 63) - 1
OUTPUT = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def grid_rows(column: pa.Array) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Vectors as integers on the grid, less the shift: for each length, (length, rows, matrix) of the usable ones."""
    if pa.types.is_fixed_size_list(column.type):
        column = column.cast(pa.list_(column.type.value_type))
    values = column.flatten()
    flat = np.asarray(values.cast(pa.float64()).fill_null(np.nan), np.float64)
    size = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(column), 0), np.int64)
    ends = np.cumsum(size)
    with np.errstate(invalid="ignore", over="ignore"):
        wide = flat * STEPS
        good = np.abs(wide) <= LARGEST
    fine = size > 0
    fine[np.searchsorted(ends, np.flatnonzero(~good), "right")] = False
    grid, out = np.floor(np.where(good, wide, 0.0)).astype(np.int64), []
    for d in np.unique(size[fine]).tolist():
        rows = np.flatnonzero(fine & (size == d))
        out.append((d, rows, grid[(ends[rows] - d)[:, None] + np.arange(d)]))
    return out


def packed(matrix: np.ndarray) -> list[bytes]:
    """Each row in the narrowest of 2, 4 or 8 bytes an entry that holds it: equal rows, equal bytes."""
    most = np.abs(matrix).max(axis=1)
    out = np.empty(len(matrix), object)
    for low, high, kind in ((-1, 1 << 15, "<i2"), (1 << 15, 1 << 31, "<i4"), (1 << 31, 1 << 62, "<i8")):
        rows = np.flatnonzero((most >= low) & (most < high))
        for i, row in zip(rows.tolist(), matrix[rows].astype(kind), strict=True):
            out[i] = row.tobytes()
    return out.tolist()


def unpacked(blobs: pa.Array, d: int) -> np.ndarray:
    """The rows that ``packed`` wrote, as one matrix."""
    out = np.empty((len(blobs), d), np.int64)
    for i, blob in enumerate(blobs.to_pylist()):
        out[i] = np.frombuffer(blob, f"<i{len(blob) // d}")
    return out


def grid_vectors(vectors: DataFrame, column: str) -> DataFrame:
    """(d, x): every usable vector's length and packed grid entries."""

    def run(batches):
        for batch in batches:
            for d, rows, matrix in grid_rows(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), d, np.int32)), pa.array(packed(matrix), pa.binary())], names=["d", "x"])

    return vectors.select(column).mapInArrow(run, "d int, x binary")


def column_sums(fit: DataFrame, d: int) -> list[int]:
    """Exact sums of the grid entries of each dimension. A task sends one row a dimension."""

    def run(batches):
        total = None
        for batch in batches:
            part = unpacked(batch.column(0), d).sum(axis=0).astype(object)  # Python integers do not overflow
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array([str(v) for v in total])], names=["i", "part"])

    parts = fit.select("x").mapInArrow(run, "i int, part string")
    found = parts.groupBy("i").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    return [int(total) for _, total in sorted((r["i"], r["total"]) for r in found)]


class Centre:
    """Exact mean of the fit list: entries become n * x - S without rounding."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n = n
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], object)

    def scaled(self, matrix: np.ndarray) -> np.ndarray:
        """n * x - S, as long where that holds it, else as Python integers."""
        near = matrix - self.base
        if int(np.abs(near).max(initial=0) + 1) * self.n <= LONG:
            return near * self.n - self.rest.astype(np.int64)
        return near.astype(object) * self.n - self.rest

    def __call__(self, matrix: np.ndarray) -> np.ndarray:
        """x - S / n."""
        near = (matrix - self.base).astype(np.float64)
        return near - (self.rest / self.n).astype(np.float64)


def deviations(scaled: np.ndarray) -> list[int | None]:
    """Row sums of squares, exact; null where a long cannot hold one."""
    largest = int(np.abs(scaled).max(initial=0))
    if largest * largest * scaled.shape[1] <= LONG:
        return (scaled * scaled).sum(axis=1).tolist()
    exact = (scaled.astype(object) ** 2).sum(axis=1)
    return [v if v <= LONG else None for v in exact]


def second_moments(fit: DataFrame, d: int, k: int, project) -> np.ndarray:
    """Sum over the fit list of y y' for the k numbers ``project`` makes of each vector, and their sums in the last row.

    Every task adds up its vectors and sends the upper triangle once, which Spark sums; k * k numbers reach the driver."""

    def run(batches):
        total, line = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            y = project(unpacked(batch.column(0), d))
            total += y.T @ y
            line += y.sum(axis=0)
        i, j = np.triu_indices(k)
        at, value = np.concatenate([i * k + j, k * k + np.arange(k)]), np.concatenate([total[i, j], line])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(value)], names=["at", "part"])

    rows = fit.select("x").mapInArrow(run, "at long, part double").groupBy("at").agg(F.sum("part").alias("total")).collect()
    out = np.zeros((k + 1) * k)
    for r in rows:
        out[r["at"]] = r["total"]
    out = out.reshape(k + 1, k)
    out[:k] = np.triu(out[:k]) + np.triu(out[:k], 1).T
    return out


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """Columns g with a = sum of g g', the largest remaining diagonal entry first, until only rounding is left."""
    left, d = a.astype(np.float64).copy(), len(a)
    floor, columns = d * np.finfo(float).eps * max(np.diag(a).max(initial=0.0), 0.0), []
    for _ in range(d):
        p = int(np.argmax(np.diag(left)))
        if left[p, p] <= floor:
            break
        g = left[:, p] / np.sqrt(left[p, p])
        left -= np.outer(g, g)
        left[p], left[:, p] = 0.0, 0.0
        columns.append(g)
    return np.array(columns).T if columns else np.zeros((d, 0))


def rounds_of(r: int):
    """Rounds of disjoint pairs that together meet all pairs of r columns once."""
    ring = list(range(r)) + [None] * (r % 2)
    half = len(ring) // 2
    for _ in range(max(len(ring) - 1, 0)):
        pairs = [(a, b) for a, b in zip(ring[:half], reversed(ring[half:]), strict=True) if a is not None and b is not None]
        yield np.array([min(x) for x in pairs], int), np.array([max(x) for x in pairs], int)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``factor`` rotated from the right until its columns are orthogonal to rounding."""
    g = np.ascontiguousarray(factor.T)  # a row is a column of the factor
    limit = 4 * np.finfo(float).eps
    for _ in range(sweeps):
        worst = 0.0
        for p, q in rounds_of(len(g)):
            a, b = g[p], g[q]
            aa, bb, ab = (a * a).sum(axis=1), (b * b).sum(axis=1), (a * b).sum(axis=1)
            off = np.abs(ab) / np.sqrt(np.maximum(aa * bb, np.finfo(float).tiny))
            worst = max(worst, float(off.max(initial=0.0)))
            turn = off > limit
            zeta = (bb - aa) / np.where(turn, 2 * ab, 1.0)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            s = c * t
            g[p], g[q] = c[:, None] * a - s[:, None] * b, s[:, None] * a + c[:, None] * b
        if worst <= limit * np.sqrt(g.shape[1]):
            break
    return g.T


def principal_axes(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns; each vector's entry of largest size is positive."""
    g = one_sided_jacobi(pivoted_cholesky(covariance))
    norm = np.sqrt((g * g).sum(axis=0))
    order = np.argsort(-norm, kind="stable")
    order = order[norm[order] > 0]
    axes = g[:, order] / norm[order]
    if axes.size:
        axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    return norm[order] ** 2, axes


def whiten(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every usable vector: one row a vector and component.

    A vector is left out if it is null or empty, or holds a null, a non-finite entry or one of 64 * entry beyond 2**40.
    Entries become long x = floor(64 * entry) + 1,000,000. The fit list is each distinct x once; all moments are its
    own, centred on its exact mean before they are multiplied. Where lengths differ, that of most distinct vectors
    counts (of equals the longest), others are left out. Repeated rows and null keys give their rows each time. Only
    components above rounding exist: a fit list of one vector, or of vectors on a line, has none or one. ``deviation``
    is null where a long cannot hold it. Other columns are ignored. An empty table gives an empty result.

    The distinct vectors are written once, in 2 bytes an entry as a rule, and read by tasks that send sums alone; the
    driver holds matrices of (dimension)**2 and solves them.
    """
    spark, kind = vectors.sparkSession, vectors.schema[key].dataType.simpleString()
    schema = OUTPUT.format(id=kind)
    fit = written(grid_vectors(vectors, column).distinct(), "fit")
    lengths = fit.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        forget(fit)
        return spark.createDataFrame([], schema)
    d, n = lengths[0]["d"], lengths[0]["count"]
    usable = fit.where(F.col("d") == d)
    centre = Centre(n, column_sums(usable, d))
    moments = second_moments(usable, d, d, centre)
    variance, axes = principal_axes(moments[:d] / n)
    trace = float(np.trace(moments[:d]) / n)
    k = min(components, len(variance))
    scale = axes[:, :k] / np.sqrt(variance[:k])
    error = 0.0
    if k:
        white = second_moments(usable, d, k, lambda m: centre(m) @ scale)
        mean = white[k] / n
        error = float(np.abs(white[:k] / n - np.outer(mean, mean) - np.eye(k)).max())
    forget(fit)
    share = variance[:k] / trace if k else variance[:0]

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for length, rows, matrix in grid_rows(batch.column(1)):
                if length != d or not k:
                    continue
                for a in range(0, len(rows), 4096):
                    part, at = matrix[a : a + 4096], rows[a : a + 4096]
                    m = len(at)
                    wide = pa.array(np.repeat(np.arange(m), k))
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                            pa.array(deviations(centre.scaled(part)), pa.int64()).take(wide), pa.array((centre(part) @ scale).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
                        ],
                        names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                    )

    return vectors.select(F.col(key).alias("vec_id"), F.col(column)).mapInArrow(run, schema)
