"""Whitening of embeddings by a bidiagonal qd solver.

Entries become integers, so sums and deviations are exact. The centred rows are reduced by QR decompositions: of
blocks of rows inside a task, of the tasks' triangles in groups, and of what is left on the driver, which
gets one triangle of at most d x d numbers. There Householder reflections make it bidiagonal, the
differential qd algorithm with shifts (dqds) finds the singular values to high relative accuracy, and twisted
factorisations of B'B - s^2 give their vectors; directions of a cluster of close values are made orthogonal.
The covariance itself is never formed, so small eigenvalues keep their digits.
"""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerhouse.llm.common import saved

EPS = np.finfo(float).eps
SCALE, SHIFT = 1024.0, 100_000
BLOCK_ROWS = 4096
MOST = 1 << 40
FAN = 16


# The solver: a triangle of d x d numbers on the driver.

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, v) with U' r v upper bidiagonal: diagonal a, b above it; v is orthogonal, U is not needed."""
    m = np.array(r, float)
    n = m.shape[0]
    v = np.eye(n)

    def mirror(x):
        w = x.copy()
        norm = np.linalg.norm(x)
        if norm == 0.0 or not np.any(x[1:]):
            return None
        w[0] += math.copysign(norm, x[0])
        return w / np.linalg.norm(w)

    for k in range(n):
        if k < n - 1 and (w := mirror(m[k:, k])) is not None:
            m[k:, k:] -= 2 * np.outer(w, w @ m[k:, k:])
        if k < n - 2 and (w := mirror(m[k, k + 1:])) is not None:
            m[k:, k + 1:] -= 2 * np.outer(m[k:, k + 1:] @ w, w)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Singular values, falling, of the bidiagonal matrix with diagonal a and b above it.

    One transformation takes q, e to those of a similar matrix less a shift; a shift that would make a q negative
    is taken back. The shift is below the smallest value of the part at work: Gershgorin's bound on the trailing entries.
    """
    q, e = [x * x for x in map(float, a)], [x * x for x in map(float, b)]
    found, sigma = [], 0.0
    parts = [(0, len(q) - 1, 0.0)] if len(q) else []
    while parts:
        lo, hi, sigma = parts.pop()
        tries = 0
        while hi >= lo:
            if hi == lo:
                found.append(q[hi] + sigma)
                break
            # Entries that no longer count end the part or cut it.
            if e[hi - 1] <= EPS * EPS * (sigma + q[hi]) or e[hi - 1] <= 1e-290:
                found.append(q[hi] + sigma)
                hi -= 1
                tries = 0
                continue
            cut = next((k for k in range(hi - 2, lo - 1, -1) if e[k] <= EPS * EPS * (sigma + min(q[k], q[k + 1])) or e[k] <= 1e-290), None)
            if cut is not None:
                parts.append((lo, cut, sigma))
                lo = cut + 1
                continue
            if q[lo] < q[hi] and tries % 8 == 7:  # graded the other way: turn the part over
                q[lo:hi + 1] = q[lo:hi + 1][::-1]
                e[lo:hi] = e[lo:hi][::-1]
            least, d = math.inf, q[lo]
            for k in range(lo, hi):  # the smallest value of an unshifted sweep bounds the smallest square from above
                least = min(least, d)
                d = q[k + 1] * (d / (d + e[k]))
            least = min(least, d)
            guess = max(0.0, least - math.sqrt(q[hi] * e[hi - 1])) if tries % 3 else 0.9 * _lower(q, e, lo, hi)
            for shift in (guess, guess / 4, 0.0):
                done = _sweep(q, e, lo, hi, shift)
                if done:
                    sigma += shift
                    break
            tries += 1
    return np.sqrt(np.maximum(0.0, np.sort(np.array(found))[::-1]))


def _lower(q: list, e: list, lo: int, hi: int) -> float:
    """A bound below the smallest eigenvalue of the part, from Gershgorin's circles; 0 if they reach below."""
    least = math.inf
    for k in range(lo, hi + 1):
        before = math.sqrt(q[k - 1] * e[k - 1]) if k > lo else 0.0
        after = math.sqrt(q[k] * e[k]) if k < hi else 0.0
        least = min(least, q[k] + (e[k - 1] if k > lo else 0.0) - before - after)
    return max(0.0, least)


def _sweep(q: list, e: list, lo: int, hi: int, shift: float) -> bool:
    """One dqds transformation in place; False, and nothing done, if the shift was too large."""
    new_q, new_e = [0.0] * (hi - lo + 1), [0.0] * (hi - lo)
    d = q[lo] - shift
    for k in range(lo, hi):
        if d < 0.0 or (shift and d == 0.0):
            return False
        s = d + e[k]
        new_q[k - lo] = s
        if s == 0.0:
            new_e[k - lo], d = 0.0, q[k + 1] - shift
            continue
        t = q[k + 1] / s
        new_e[k - lo] = e[k] * t
        d = d * t - shift
    if d < 0.0:
        return False
    new_q[-1] = d
    q[lo:hi + 1], e[lo:hi] = new_q, new_e
    return True


def _twisted(diagonal: np.ndarray, off: np.ndarray, at: float) -> np.ndarray:
    """A unit vector of the symmetric tridiagonal matrix for its eigenvalue ``at``, from the twisted factorisation.

    Forward elimination from the top and backward from the bottom meet where the remaining entry is smallest.
    """
    n = len(diagonal)
    tiny = EPS * (abs(diagonal).max() + (abs(off).max() if n > 1 else 0.0)) + 1e-300
    top, bottom = np.empty(n), np.empty(n)
    top[0] = diagonal[0] - at
    for k in range(1, n):
        top[k - 1] = top[k - 1] if abs(top[k - 1]) > tiny * EPS else math.copysign(tiny * EPS, top[k - 1])
        top[k] = diagonal[k] - at - off[k - 1] ** 2 / top[k - 1]
    bottom[n - 1] = diagonal[n - 1] - at
    for k in range(n - 2, -1, -1):
        bottom[k + 1] = bottom[k + 1] if abs(bottom[k + 1]) > tiny * EPS else math.copysign(tiny * EPS, bottom[k + 1])
        bottom[k] = diagonal[k] - at - off[k] ** 2 / bottom[k + 1]
    twist = int(np.argmin(np.abs(top + bottom - (diagonal - at))))
    z = np.zeros(n)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -off[k] / top[k] * z[k + 1]
        if abs(z[k]) > 1e150:
            z /= abs(z[k])
    for k in range(twist + 1, n):
        z[k] = -off[k - 1] / bottom[k] * z[k - 1]
        if abs(z[k]) > 1e150:
            z /= abs(z[k])
    return z / np.linalg.norm(z)


def right_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Columns: right singular vectors of the bidiagonal matrix for the ``count`` largest of its ``values``.

    Close values give nearly the same twisted vector. Such a cluster is iterated together: each vector is solved for
    once more, against the ones before it, and the cluster is turned to the directions of its own small matrix.
    """
    diagonal = a ** 2 + np.concatenate([[0.0], b ** 2])
    off = a[:-1] * b
    n, out, draw = len(a), [], np.random.default_rng(11)
    full = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    last, k = len(values), 0
    while k < min(count, last):
        end = k + 1
        while end < last and values[end - 1] - values[end] <= 1e-4 * values[0]:
            end += 1
        group = []
        for i in range(k, end):
            z = _twisted(diagonal, off, values[i] ** 2)
            before = np.array(group).T if group else np.zeros((n, 0))
            rest = z - before @ (before.T @ z)
            if np.linalg.norm(rest) < 0.5:  # the same direction again: inverse iteration from another start
                shifted = full - (values[i] ** 2 + 16 * EPS * values[0] ** 2) * np.eye(n)
                rest = draw.standard_normal(n)
                for _ in range(4):
                    rest -= before @ (before.T @ rest)
                    rest = np.linalg.solve(shifted, rest / np.linalg.norm(rest))
                    rest /= np.linalg.norm(rest)
            rest -= before @ (before.T @ rest)
            rest /= np.linalg.norm(rest)
            group.append(rest - before @ (before.T @ rest))
        z = np.linalg.qr(np.array(group).T)[0]
        if end - k > 1:
            w, turn = _small_eigen(z.T @ full @ z)
            z = z @ turn[:, np.argsort(-w)]
        out.append(z)
        k = end
    return np.concatenate(out, axis=1)[:, :count] if out else np.zeros((n, 0))


def _small_eigen(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of the nearly diagonal matrix of a cluster, by Jacobi rotations."""
    m, turn = (m + m.T) / 2, np.eye(len(m))
    for _ in range(30):
        if np.abs(m - np.diag(np.diag(m))).max() <= EPS * np.abs(np.diag(m)).max():
            break
        for i in range(len(m)):
            for j in range(i + 1, len(m)):
                if m[i, j] == 0.0:
                    continue
                angle = 0.5 * math.atan2(2 * m[i, j], m[j, j] - m[i, i])
                c, s = math.cos(angle), math.sin(angle)
                rotation = np.array([[c, s], [-s, c]])
                m[:, [i, j]] = m[:, [i, j]] @ rotation
                m[[i, j], :] = rotation.T @ m[[i, j], :]
                turn[:, [i, j]] = turn[:, [i, j]] @ rotation
    return np.diag(m).copy(), turn


def directions(triangle: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, falling; columns with the directions of the first ``count`` of them above rounding)."""
    a, b, v = bidiagonal(triangle)
    values = dqds(a, b)
    rank = int(np.sum(values > len(values) * EPS * values[:1].sum())) if len(values) else 0
    z = v @ right_vectors(a, b, values, min(count, rank))
    return values, z


# The rows: exact integers inside tasks.

def _integers(batch: pa.RecordBatch, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows of a batch that hold a whole finite vector, and their integers."""
    column = batch.column(1)
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])
    flat = column.flatten().cast(pa.float64())
    bad = ~np.isfinite(flat.fill_null(math.nan).to_numpy(zero_copy_only=False))
    wrong = np.concatenate([[0], np.cumsum(bad)])
    rows = np.flatnonzero((lengths == dimensions) & (wrong[ends[1:]] == wrong[ends[:-1]]))
    x = flat.to_numpy(zero_copy_only=False)[(ends[rows][:, None] + np.arange(dimensions)).ravel()].reshape(-1, dimensions)
    x = np.floor(SCALE * x)
    if x.size and np.abs(x).max() >= MOST:
        raise OverflowError("an entry is too large to be a whole number here")
    return rows, x.astype(np.int64) + SHIFT


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact."""
    if x.size and n * float(np.abs(x).max()) >= 2.0 ** 62:
        raise OverflowError("n times an entry does not fit in 64 bits")
    return n * x - sums


def _numbers(batches, dimensions: int):
    """One row per task and dimension with the exact sum, and one with the count as dimension -1."""
    n, sums = 0, [0] * dimensions
    for batch in batches:
        _, x = _integers(batch, dimensions)
        for block in np.array_split(x, max(1, len(x) // BLOCK_ROWS)):
            n += len(block)
            sums = [s + int(t) for s, t in zip(sums, block.sum(0))]
    if n:
        yield pa.record_batch([
            pa.array(range(-1, dimensions), pa.int32()), pa.array([Decimal(s) for s in (n, *sums)], pa.decimal128(38, 0))],
            names=["dimension", "total"])


def _triangle(blocks, dimensions: int) -> np.ndarray:
    """The triangle of all blocks of rows, reduced one after the other."""
    r = np.zeros((0, dimensions))
    for block in blocks:
        r = np.linalg.qr(np.concatenate([r, block]), mode="r")
    return r


def _sent(r: np.ndarray, part: int):
    yield pa.record_batch([pa.array([part], pa.int64()), pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], names=["part", "r"])


def whiten(vectors: DataFrame, count: int = 8, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error), ``count`` for each vector.

    Vectors that are null or hold null or infinite entries give no rows; nor do those of another length than most
    (the longer length, if two are equally common), as they lie in another space. Null vec_ids stay null, repeated
    rows are repeated. Components without variance (equal vectors, or fewer of them than dimensions) cannot be
    scaled and give no rows. No vectors, no rows.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vec"))
    fields = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = vectors.sparkSession
    whole = rows.filter("vec is not null and not exists(vec, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    common = whole.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if common is None or common.d == 0:
        return spark.createDataFrame([], fields)
    d = common.d

    sums = rows.mapInArrow(lambda batches: _numbers(batches, d), "dimension int, total decimal(38,0)").groupBy("dimension").agg(
        F.sum("total").alias("total")).orderBy("dimension").collect()
    n, *sums = (int(row.total) for row in sums)
    if max(abs(s) for s in sums) >= 1 << 62:
        raise OverflowError("a sum does not fit in 64 bits")
    total = np.array(sums, np.int64)

    def centred(batches):
        for batch in batches:
            for block in np.array_split(x := _integers(batch, d)[1], max(1, len(x) // BLOCK_ROWS)):
                yield _deviations(block, n, total) / n

    def triangles(batches):
        yield from _sent(_triangle(centred(batches), d), TaskContext.get().partitionId())

    def merged(batches):
        part, held = 0, np.zeros((0, d))
        for batch in batches:
            for part, r in zip(batch.column(0).to_pylist(), batch.column(1)):
                held = np.linalg.qr(np.concatenate([held, np.array(r.as_py()).reshape(-1, d)]), mode="r")
        if len(held):
            yield from _sent(held, part // FAN)

    found = saved(rows.mapInArrow(triangles, "part long, r array<double>"), "triangles")
    left = rows.rdd.getNumPartitions()
    while left > FAN:  # a tree: each task reduces the triangles of a group
        left = math.ceil(left / FAN)
        found = saved(found.repartition(left, F.floor(F.col("part") / FAN)).sortWithinPartitions("part").mapInArrow(
            merged, "part long, r array<double>"), "triangles")
    parts = [np.array(row.r).reshape(-1, d) for row in found.orderBy("part").collect() if row.r]
    triangle = _triangle(parts, d)
    triangle = np.concatenate([triangle, np.zeros((d - len(triangle), d))])
    values, towards = directions(triangle, count)
    if not towards.shape[1]:
        return spark.createDataFrame([], fields)
    kept = towards.shape[1]
    scale = towards / (values[:kept] / math.sqrt(n))
    explained = values[:kept] ** 2 / (triangle ** 2).sum()

    def moments(batches):
        held = np.zeros((kept + 1, kept))  # sums, then products; the rows are centred already
        for block in centred(batches):
            w = block @ scale
            held += np.concatenate([w.sum(0)[None], w.T @ w])
        yield pa.record_batch([pa.array(range(held.size), pa.int32()), pa.array(held.ravel())], names=["place", "total"])

    held = rows.mapInArrow(moments, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    held = np.array([row.total for row in held.orderBy("place").collect()]).reshape(kept + 1, kept) / n
    error = float(np.abs(held[1:] - np.outer(held[0], held[0]) - np.eye(kept)).max())

    def whitened(batches):
        for batch in batches:
            index, x = _integers(batch, d)
            ids = batch.column(0).take(pa.array(index)).to_pylist()
            for a in range(0, len(x), BLOCK_ROWS):
                apart = _deviations(x[a:a + BLOCK_ROWS], n, total)
                if apart.size and d * float(np.abs(apart).max()) ** 2 >= 2.0 ** 62:
                    squares = [sum(int(t) ** 2 for t in row) for row in apart]
                else:
                    squares = (apart ** 2).sum(1).tolist()
                k = len(apart)
                yield pa.record_batch([
                    pa.array(np.repeat(np.array(ids[a:a + BLOCK_ROWS], object), kept).tolist(), pa.int64()),
                    pa.array(np.tile(np.arange(1, kept + 1), k), pa.int32()), pa.array(np.full(k * kept, n), pa.int64()),
                    pa.array([s for s in squares for _ in range(kept)], pa.int64()), pa.array((apart / n @ scale).ravel()),
                    pa.array(np.tile(explained, k)), pa.array(np.full(k * kept, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(whitened, fields)
