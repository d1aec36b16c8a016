"""Whitening of embeddings by singular values of their centred rows.

The covariance is never formed: squaring would lose the small singular values.

1. Every task reduces its centred rows, block by block, to a triangle by QR;
   triangles are merged in groups, in levels, until one is left.  It is as wide
   as the vectors, whatever their number.
2. The last triangle is brought to bidiagonal form by Householder reflections.
3. dqds (the differential quotient-difference transform with shifts) finds the
   singular values of the bidiagonal matrix to high relative accuracy.
4. For each wanted value a stationary and a progressive transform are twisted
   together where their pivot is smallest, which gives the singular vector; close
   values are separated once more within the space that their vectors span.

The last triangle and what follows are on the driver: d x d numbers for vectors of
length d, for any number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE = 256
COMPONENTS = 4
BLOCK_BYTES = 16 << 20  # rows that one QR step takes in
FAN_IN = 16  # triangles merged in one task
CLOSE = 1e-3  # relative distance of eigenvalues below which their vectors are separated together
EPS = np.finfo(float).eps


# ---- dense steps on one small matrix

def bidiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right transformation of a square matrix:
    ``a = U B V'`` with orthogonal U (not kept) and V, B upper bidiagonal."""
    a = np.array(a, float)
    n = a.shape[0]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        w = x.copy()
        size = np.linalg.norm(x)
        if size == 0:
            return w, 0.0
        w[0] += np.copysign(size, x[0])
        return w, 2.0 / (w @ w)

    for k in range(n):
        w, beta = reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(w, w @ a[k:, k:])
        if k + 1 < n:
            w, beta = reflector(a[k, k + 1:])
            a[k:, k + 1:] -= beta * np.outer(a[k:, k + 1:] @ w, w)
            v[:, k + 1:] -= beta * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds transform of the qd array; None if the shift is beyond the smallest eigenvalue."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    for i in range(n - 1):
        if d < 0:
            return None
        top = d + e[i]
        new_q[i] = top
        if top == 0:
            new_e[i] = 0.0
            d = q[i + 1] - shift
            continue
        ratio = q[i + 1] / top
        new_e[i] = e[i] * ratio
        d = d * ratio - shift
    if d < 0:
        return None
    new_q[-1] = d
    return new_q, new_e


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if scale == 0:
        return np.zeros(len(diagonal))
    found: list[float] = []
    work = [([float(x) ** 2 for x in diagonal / scale], [float(x) ** 2 for x in above / scale], 0.0)]
    while work:
        q, e, sigma = work.pop()
        failures = 0
        while q:
            if len(q) == 1:
                found.append(q[0] + sigma)
                break
            split = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (sigma + min(q[i], q[i + 1])) or e[i] < 1e-300), None)
            if split is not None:
                work.append((q[:split + 1], e[:split], sigma))
                q, e = q[split + 1:], e[split + 1:]
                continue
            if q[0] < q[-1] and sigma == 0 and failures == 0 and q[0] * 2.25 < q[-1]:
                q, e = q[::-1], e[::-1]  # graded the other way round: the small end belongs below
            # the smaller eigenvalue of the last two rows, kept below by what lies above them
            trace, product = q[-2] + e[-1] + q[-1], q[-2] * q[-1]
            root = max(trace * trace / 4 - product, 0.0) ** 0.5
            least = product / (trace / 2 + root) if trace else 0.0
            shift = 0.0 if failures > 3 else least * (0.98 if len(q) > 2 else 1 - 4 * EPS) * 0.25 ** failures
            if len(q) > 2:
                shift = max(shift - (e[-2] * e[-1]) ** 0.5 * (0.25 if failures else 0.0), 0.0)
            done = _step(q, e, shift)
            if done is None:
                failures += 1
                continue
            q, e = done
            sigma, failures = sigma + shift, 0
    return np.sort(np.array(found))[::-1] * scale * scale


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B for the eigenvalue ``value``, B upper bidiagonal,
    from a twisted factorisation of B'B - value."""
    n = len(diagonal)
    tiny = EPS * max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0), 1e-150)
    a = np.where(np.abs(diagonal) < tiny, tiny, diagonal)
    d, low = a * a, above / a[:-1]
    small = max(EPS * EPS * max(value, d.max()), 1e-290)

    def pivot(x: float) -> float:
        return x if abs(x) > small else -small

    s, down = np.empty(n), np.empty(n - 1)
    s[0] = -value
    for i in range(n - 1):
        down[i] = d[i] * low[i] / pivot(s[i] + d[i])
        s[i + 1] = down[i] * low[i] * s[i] - value
    p, up = np.empty(n), np.empty(n - 1)
    p[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):
        ratio = d[i] / pivot(d[i] * low[i] ** 2 + p[i + 1])
        up[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - value
    gamma = s + p + value
    k = int(np.abs(gamma).argmin())
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
        if abs(z[i + 1]) > 1e100:
            z /= abs(z[i + 1])
    return z / np.linalg.norm(z)


def leading_components(triangle: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values, falling, of a square matrix and its first ``k`` right singular vectors (columns)."""
    d = triangle.shape[0]
    diagonal, above, right = bidiagonalise(triangle)
    values = dqds(diagonal, above)
    k = min(k, d)
    if not k or values[0] == 0:
        return values, right[:, :k]
    b = np.diag(diagonal) + np.diag(above, 1)
    gram = b.T @ b
    out = np.zeros((d, 0))
    while out.shape[1] < k:
        first = out.shape[1]
        stop = first + 1
        while stop < d and values[stop - 1] - values[stop] <= CLOSE * values[stop - 1]:
            stop += 1
        z = np.stack([twisted_vector(diagonal, above, v) for v in values[first:stop]], axis=1)
        if stop - first > 1 or not np.isfinite(z).all():
            z = _separate(gram, np.nan_to_num(z), values[first:stop], out)
        out = np.concatenate([out, z], axis=1)
    basis, _ = np.linalg.qr(out)  # rounding only: the columns are orthogonal already
    basis *= np.sign((basis * out).sum(axis=0))
    return values, (right @ basis)[:, :k]


def _separate(gram: np.ndarray, z: np.ndarray, values: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Eigenvectors of close eigenvalues: inverse iteration on the space of the
    twisted vectors, then the small problem within it."""
    d, m = z.shape
    fill = np.cos(np.outer(np.arange(1, d + 1), np.arange(1, m + 1)))
    z = np.linalg.qr(z + 1e-3 * fill / np.linalg.norm(fill, axis=0))[0]
    # just beside the values, so that the matrix can be solved with
    shifted = gram - (values.mean() + 1e-10 * np.linalg.norm(gram)) * np.eye(d)
    for _ in range(3):
        z = np.linalg.solve(shifted, z)
        for _ in range(2):
            z -= others @ (others.T @ z)
            z = np.linalg.qr(z)[0]
    _, turn = np.linalg.eigh(z.T @ gram @ z)
    return z @ turn[:, ::-1]


# ---- distributed steps

def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).reshape(-1, width)


def _sums(width: int):
    """Exact sums a dimension, as text: they may exceed a long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for batch in batches:
            x = _matrix(batch.column(0), width)
            n += len(x)
            high, low = x >> 32, x & 0xFFFFFFFF  # halves cannot overflow in sums of up to 2 ** 31 rows
            total = [t + (int(h) << 32) + int(v) for t, h, v in zip(total, high.sum(axis=0), low.sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()), pa.array([str(v) for v in (*total, n)])], ["dim", "total"])
    return run


def _triangles(width: int, mean: np.ndarray):
    """One triangle a task, of its centred rows."""
    rows = max(width, BLOCK_BYTES // (8 * max(width, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triangle, held, size = np.zeros((0, width)), [], 0
        for batch in batches:
            x = _matrix(batch.column(0), width) - mean
            for a in range(0, len(x), rows):
                held.append(x[a:a + rows])
                size += len(held[-1])
                if size >= rows:
                    triangle, held, size = np.linalg.qr(np.concatenate([triangle, *held]), mode="r"), [], 0
        if held:
            triangle = np.linalg.qr(np.concatenate([triangle, *held]), mode="r")
        if len(triangle):
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(triangle).tobytes()])], ["triangle"])
    return run


def _merge(width: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        triangle = np.zeros((0, width))
        for blob in group.column("triangle"):
            triangle = np.linalg.qr(np.concatenate([triangle, np.frombuffer(blob.as_py()).reshape(-1, width)]), mode="r")
        return pa.table({"triangle": [np.ascontiguousarray(triangle).tobytes()]})
    return run


def reduced_triangle(fit: DataFrame, width: int, mean: np.ndarray, fan_in: int = FAN_IN) -> np.ndarray:
    """The triangle of the centred rows ``x`` of ``fit``, merged by groups of ``fan_in`` tasks' triangles a level."""
    level = written(fit.select("x").mapInArrow(_triangles(width, mean), "triangle binary"), "whitening-triangles")
    while (left := level.count()) > fan_in:
        groups = -(-left // fan_in)
        # the hash of a triangle deals them out alike on every run
        level = written(level.groupBy(F.pmod(F.xxhash64("triangle"), F.lit(groups)).alias("g")).applyInArrow(_merge(width), "triangle binary"), "whitening-triangles")
        if groups == 1:
            break
    blobs = sorted(r.triangle for r in level.collect())  # at most fan_in triangles of width x width
    out = np.zeros((width, width))
    for blob in blobs:
        out = np.linalg.qr(np.concatenate([out, np.frombuffer(bytes(blob)).reshape(-1, width)]), mode="r")
    return out


def _whitened(x: np.ndarray, mean: np.ndarray, axes: np.ndarray, spread: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(spread > 0, ((x - mean) @ axes) / spread, np.nan)


def _moments(width: int, mean: np.ndarray, axes: np.ndarray, spread: np.ndarray):
    """Count, sums and sums of products of the whitened rows of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = axes.shape[1]
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = np.nan_to_num(_whitened(_matrix(batch.column(0), width), mean, axes, spread))
            total += w.sum(axis=0)
            products += w.T @ w
        flat = np.concatenate([total, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], ["at", "v"])
    return run


def _rows(width: int, n: int, total: list[int], mean: np.ndarray, axes: np.ndarray, spread: np.ndarray):
    """``(vec_id, deviation, whitened)`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            top = n * int(np.abs(x).max(initial=0)) + max(map(abs, total), default=0)
            if width * top * top < 1 << 63:
                deviation = ((x * n - np.array(total, np.int64)) ** 2).sum(axis=1).tolist()
            else:
                deviation = [sum((n * v - s) ** 2 for v, s in zip(row, total, strict=True)) for row in x.tolist()]
                deviation = [v if v < 1 << 63 else None for v in deviation]
            w = _whitened(x, mean, axes, spread)
            values = pa.array(w.ravel(), from_pandas=True)  # NaN becomes null
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(x) + 1) * w.shape[1], w.shape[1] or 1)[:len(x) + 1], pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), lists], ["vec_id", "deviation", "w"])
    return run


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Leading whitened components of every usable row of ``embeddings``.

    Entries become whole numbers, ``floor(scale * entry)``.  The model is fitted on
    each distinct vector once.  Per row and component: ``vec_id``, ``component``
    (from 1), ``n`` (distinct vectors), ``deviation`` (the exact sum of squares of
    ``n * x - sum``; null beyond a long), ``whitened``, ``explained`` and
    ``identity_error``, measured on the whitened vectors themselves.

    Rows whose vector is null, empty or holds a null or non-finite entry, or one
    beyond a long, are left out, as are vectors of another length than the
    commonest (ties: the longest).  A null ``vec_id`` and repeated rows stay.  Without
    any spread ``explained`` and ``whitened`` are null; a component of no spread has
    ``explained`` 0 and a null ``whitened``, and counts not in ``identity_error``.
    Fewer dimensions than ``components`` give as many components; an empty table an
    empty result.  Equal values leave their vectors free up to rotation: one choice
    is made for all rows.
    """
    spark = embeddings.sparkSession
    doubles = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v")).where("v is not null and size(v) > 0")
    finite = doubles.where(F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < F.lit(2.0 ** 62 / scale))))
    widths = finite.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("width")).first()
    if widths is None:
        return spark.createDataFrame([], OUT)
    width = widths.width
    rows = finite.where(F.size("v") == width).select("vec_id", F.transform("v", lambda c: F.floor(c * F.lit(float(scale)))).alias("x"))
    fit = written(rows.select("x").distinct(), "whitening-fit")
    sums = {r.dim: int(r.total) for r in fit.mapInArrow(_sums(width), "dim int, total string")
            .groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")).collect()}  # width + 1 rows
    total, n = [sums[k] for k in range(width)], sums[width]
    mean = np.array([s / n for s in total])
    values, axes = leading_components(reduced_triangle(fit, width, mean), components)
    values = np.where(values > values[0] * (width * EPS) ** 2, values, 0.0) / n
    k = axes.shape[1]
    spread, trace = np.sqrt(values[:k]), float(values.sum())
    got = {r["at"]: r.v for r in fit.mapInArrow(_moments(width, mean, axes, spread), "at int, v double")
           .groupBy("at").agg(F.sum("v").alias("v")).collect()}  # components ** 2 + components rows
    flat = np.array([got[i] for i in range(k + k * k)]) / n
    covariance = flat[k:].reshape(k, k) - np.outer(flat[:k], flat[:k])
    live = spread > 0
    error = float(np.abs(covariance - np.eye(k))[np.ix_(live, live)].max()) if live.any() else None
    explained = [float(v / trace) if trace > 0 else None for v in values[:k]]
    each = F.explode(F.arrays_zip(F.sequence(F.lit(1), F.lit(k)).alias("component"), F.col("w"), F.array(*(F.lit(e).cast("double") for e in explained)).alias("explained")))
    return rows.mapInArrow(_rows(width, n, total, mean, axes, spread), "vec_id long, deviation long, w array<double>") \
        .select("vec_id", "deviation", each.alias("c")) \
        .select("vec_id", F.col("c.component").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", F.col("c.w").alias("whitened"),
                F.col("c.explained").alias("explained"), F.lit(error).cast("double").alias("identity_error"))
