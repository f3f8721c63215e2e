"""Whitening of vectors: blockwise QR, a bidiagonal matrix, its singular values by dqds, its vectors by twists.

The rows are never multiplied with each other: the triangular factor R of the centred rows has their
singular values and directions. R is dimension x dimension; it is reduced in a tree of tasks, and
only the last one, which does not grow with the rows, comes to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import Store, finite

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Factors R that one task joins to one.
FAN_IN = 16
#: Quantised components are held to this range, far beyond any that can be told apart.
LIMIT = 1 << 60
EPS = np.finfo(float).eps


# In tasks


def quantise(batches):
    """Rows (vec_id, vector) with every component x as floor(1024 x) + 100000, held within +-2^60."""
    for batch in batches:
        lists = batch.column(1)
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        x = np.clip(np.floor(SCALE * values), -LIMIT, LIMIT).astype(np.int64) + OFFSET
        borders = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy()))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(borders), pa.array(x))], names=["vec_id", "x"]
        )


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def column_sums(batches):
    """(place, sum, rows) of each dimension over one task's rows; the halves of a number are added apart."""
    high = low = None
    rows = 0
    for batch in batches:
        x = matrix(batch.column(0))
        rows += len(x)
        halves = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
        high, low = halves if high is None else (high + halves[0], low + halves[1])
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(high))), pa.array(high), pa.array(low), pa.array([rows] * len(high))],
            names=["place", "high", "low", "rows"],
        )


def centred(x: np.ndarray, count: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S as long, and x - S/n. The long is exact where it fits: numbers wrap around."""
    wrapped = np.array([int(s) & (2**64 - 1) for s in sums], np.uint64).view(np.int64)
    with np.errstate(over="ignore"):
        exact = x * np.int64(count) - wrapped
    mean, rest = sums // count, (sums % count).astype(np.float64) / count
    return exact, (x - mean.astype(np.int64)).astype(np.float64) - rest


def factors(count: int, sums: np.ndarray):
    """The triangular factor of one task's centred rows, row by row under a number of the task's own."""

    def task(batches):
        held = np.zeros((0, len(sums)))
        for batch in batches:
            _, rows = centred(matrix(batch.column(0)), count, sums)
            held = np.linalg.qr(np.vstack([held, rows]), mode="r")
        yield from triangle(held)

    return task


def triangle(factor: np.ndarray):
    if len(factor):
        yield pa.RecordBatch.from_arrays([pa.array([r.tolist() for r in factor], pa.list_(pa.float64()))], names=["r"])


def moments(model: Whitening):
    """Sums of the whitened rows of a task and of their products: components + 1 rows."""

    def task(batches):
        k = len(model.roots)
        total = np.zeros((k + 1, k))
        for batch in batches:
            white = model.apply(matrix(batch.column(0)))
            total += np.vstack([white.T @ white, white.sum(axis=0)])
        rows, columns = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows.ravel()), pa.array(columns.ravel()), pa.array(total.ravel())], names=["i", "j", "total"]
        )

    return task


def squares(exact: np.ndarray, near: np.ndarray) -> pa.Array:
    """Row sums of squares, exact; null where they pass a long. near: about the same numbers as doubles."""
    with np.errstate(over="ignore"):
        total = (exact * exact).sum(axis=1)
    about = (near * near).sum(axis=1)
    total = total.astype(object)
    for row in np.flatnonzero(about > 2.0**63 * (1 - 1e-9)):  # near the border, or beyond it
        value = sum(v * v for v in exact[row].tolist()) if about[row] < 2.0**63 * (1 + 1e-9) else 2**63
        total[row] = value if value < 2**63 else None
    return pa.array(total.tolist(), pa.int64())


def emit(model: Whitening, error: float):
    def task(batches):
        k = len(model.roots)
        for batch in batches:
            x = matrix(batch.column(1))
            exact, near = centred(x, model.count, model.sums)
            deviations = squares(exact, near * model.count)
            row = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(row), model.count)),
                    deviations.take(pa.array(row)),
                    pa.array(model.apply(x).ravel()),
                    pa.array(np.tile(model.explained, len(x))),
                    pa.array(np.full(len(row), error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return task


# The small matrix


def reflect(x: np.ndarray) -> tuple[np.ndarray, float]:
    """The Householder vector (of length sqrt 2, or zero) that takes x to a multiple of the first unit, and that."""
    norm = np.linalg.norm(x)
    if norm == 0.0:
        return np.zeros_like(x), 0.0
    v = x / norm
    sign = -1.0 if v[0] < 0 else 1.0
    v[0] += sign
    return v * (np.sqrt(2.0) / np.linalg.norm(v)), -sign * norm


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, superdiagonal, and the right reflections of an upper bidiagonal matrix like r."""
    a, size = r.copy(), len(r)
    diagonal, above, right = np.zeros(size), np.zeros(max(size - 1, 0)), []
    for k in range(size):
        v, diagonal[k] = reflect(a[k:, k].copy())
        a[k:, k + 1 :] -= np.outer(v, v @ a[k:, k + 1 :])
        if k + 1 < size:
            w, above[k] = reflect(a[k, k + 1 :].copy())
            a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k + 1 :] @ w, w)
            right.append(w)
    return diagonal, above, right


def qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential quotient-difference step: new q and e, and the numbers d, negative if the shift was too large."""
    size, d = len(q), q[0] - shift
    out, off, ds = [0.0] * size, [0.0] * (size - 1), [d]
    for i in range(size - 1):
        out[i] = d + e[i]
        ratio = q[i + 1] / out[i] if out[i] else 0.0
        off[i] = e[i] * ratio
        d = d * ratio - shift
        ds.append(d)
    out[-1] = d
    return out, off, ds


def squared_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an unreduced bidiagonal matrix by dqds, in falling order.

    Shifts are taken from below only, so every value is found to high relative accuracy: first a bold
    one by the smallest d, then, where that went too far, Newton's step 1 / sum(1 / d), which never does.
    """
    q, e = (diagonal * diagonal).tolist(), (above * above).tolist()
    found, shifted = [], 0.0
    while q:
        if len(q) == 1:
            found.append(q.pop() + shifted)
            continue
        if e[-1] <= EPS * EPS * (shifted + q[-1]) or e[-1] <= np.finfo(float).tiny:
            found.append(q.pop() + shifted)
            e.pop()
            continue
        if 1.5 * q[0] < q[-1]:  # the small end must be the last
            q.reverse()
            e.reverse()
        plain, off, ds = qd_step(q, e, 0.0)
        least = min(ds)
        newton = 1.0 / sum(1.0 / d for d in ds) if least > 0 else 0.0
        q, e = plain, off
        for shift in (least * 0.999 - e[-1] if ds[-1] == least else 0.0, newton * (1 - 8 * len(q) * EPS)):
            if shift > max(newton * 0.5, EPS * shifted):
                out, off, ds = qd_step(q, e, shift)
                if min(ds) >= 0:
                    q, e, shifted = out, off, shifted + shift
                    break
    return np.sort(np.array(found))[::-1]


def kept_off_zero(x: float, tiny: float) -> float:
    return x if abs(x) > tiny else tiny if x >= 0 else -tiny


def twisted_vector(q: np.ndarray, e: np.ndarray, value: float) -> np.ndarray:
    """The eigenvector of B'B for an eigenvalue, from the twisted factorisation with the smallest middle.

    B'B - value = L D L' from the top and U D U' from the bottom; where the two meet best, one row of
    the system is all but zero, and the vector follows from it by multiplications only.
    """
    size = len(q)
    # B'B is tridiagonal: diagonal q[i] + e[i-1], off-diagonal sqrt(q[i] * e[i])
    tiny = EPS * EPS * max(q.max(), np.finfo(float).tiny)
    top, bottom = np.empty(size), np.empty(size)
    s, p = np.empty(size), np.empty(size)
    s[0] = -value
    for i in range(size - 1):  # stationary, from the top
        top[i] = kept_off_zero(s[i] + q[i], tiny)
        s[i + 1] = s[i] * (e[i] / top[i]) - value
    p[-1] = q[-1] - value
    for i in range(size - 2, -1, -1):  # progressive, from the bottom
        bottom[i + 1] = kept_off_zero(p[i + 1] + e[i], tiny)
        p[i] = p[i + 1] * (q[i] / bottom[i + 1]) - value
    middle = np.abs(s + p + value)
    at = int(np.argmin(middle))
    z = np.zeros(size)
    z[at] = 1.0
    off = np.sqrt(q[: size - 1] * e)
    for i in range(at - 1, -1, -1):
        z[i] = -(off[i] / top[i]) * z[i + 1]
    for i in range(at, size - 1):
        z[i + 1] = -(off[i] / bottom[i + 1]) * z[i]
    return z / np.linalg.norm(z)


def right_vectors(diagonal: np.ndarray, above: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values of an upper bidiagonal matrix and their right vectors, by rows.

    Negligible off-diagonals cut the matrix; each part is solved alone. Vectors of values that lie
    together are made orthogonal to those before, from another start where nothing is left.
    """
    size = len(diagonal)
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(0), np.zeros((0, size))
    diagonal = np.where(np.abs(diagonal) < scale * EPS * EPS, scale * EPS * EPS, diagonal) / scale
    above = above / scale
    cut = np.abs(above) <= EPS / 8 * np.minimum(np.abs(diagonal[:-1]), np.abs(diagonal[1:]))
    cut |= np.abs(above) <= EPS * EPS
    found = []
    borders = [0, *(np.flatnonzero(cut) + 1), size]
    for first, last in zip(borders, borders[1:]):
        a, b = diagonal[first:last], above[first : last - 1]
        found += [(value, first, last) for value in squared_values(a, b)]
    found.sort(key=lambda x: (-x[0], x[1]))
    # a direction is one only above what rounding leaves of a rank that is not full
    found = [x for x in found if x[0] > (EPS * size) ** 2 * found[0][0] * 4096][:count]
    signs = signs_of(diagonal, above)
    random, vectors = np.random.default_rng(5), []
    for value, first, last in found:
        z = np.zeros(size)
        z[first:last] = twisted_vector(diagonal[first:last] ** 2, above[first : last - 1] ** 2, value)
        z *= signs
        z = orthogonal(z, vectors)
        if z is None:  # the values lie so near that the twist gave a vector we have
            z = in_complement(diagonal, above, value, vectors, random)
        vectors.append(z)
    return np.array([x[0] for x in found]) * scale * scale, np.array(vectors).reshape(len(found), size)


def signs_of(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Signs that turn the vectors of the matrix of absolute values into those of this one."""
    steps = np.where(diagonal[:-1] * above < 0, -1.0, 1.0)
    return np.concatenate(([1.0], np.cumprod(steps)))


def orthogonal(z: np.ndarray, vectors: list[np.ndarray]) -> np.ndarray | None:
    for _ in range(2):
        for v in vectors:
            z = z - (v @ z) * v
    norm = np.linalg.norm(z)
    return z / norm if norm > 0.5 else None


def in_complement(diagonal, above, value, vectors, random) -> np.ndarray:
    """A vector of the same value, orthogonal to those found: inverse iteration on the tridiagonal B'B."""
    size = len(diagonal)
    middle = diagonal**2 + np.concatenate(([0.0], above**2))
    full = np.diag(middle) + np.diag(diagonal[:-1] * above, 1) + np.diag(diagonal[:-1] * above, -1)
    shifted = full - value * (1 + 4 * EPS) * np.eye(size)
    z = random.normal(size=size)
    for _ in range(4):
        for v in vectors:
            z = z - (v @ z) * v
        z = np.linalg.solve(shifted, z / np.linalg.norm(z))
    for _ in range(2):
        for v in vectors:
            z = z - (v @ z) * v
    return z / np.linalg.norm(z)


# The model


@dataclass
class Whitening:
    """What whitens a row: (x - S/n) projected on the components, over the roots of their eigenvalues."""

    count: int
    sums: np.ndarray
    components: np.ndarray
    roots: np.ndarray
    explained: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        _, rows = centred(x, self.count, self.sums)
        return rows @ self.components.T / self.roots


def usable(vectors: DataFrame) -> DataFrame:
    """Vectors without null or non-finite entries, of the length that most of them have, quantised.

    Of two lengths equally frequent the larger counts. Vectors of another length, or none, have no
    place in the covariance and are left out.
    """
    good = vectors.select("vec_id", "embedding").where(finite(F.col("embedding")) & (F.size("embedding") > 0))
    lengths = good.groupBy(F.size("embedding").alias("length")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    good = good.where(F.size("embedding") == (most[0]["length"] if most else 0))
    doubles = good.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    return doubles.mapInArrow(quantise, "vec_id long, x array<long>")


def fit(store: Store, rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn the whitening of quantised rows; None without rows.

    Sums are exact. Components without variance beyond rounding are left out, so there may be fewer.
    """
    x = rows.select("x")
    sums = x.mapInArrow(column_sums, "place long, high long, low long, rows long").groupBy("place")
    totals = sums.agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "rows")))
    totals = sorted(totals.collect())
    if not totals:
        return None
    count = int(totals[0]["rows"])
    exact = np.array([(int(t["high"]) << 32) + int(t["low"]) for t in totals], dtype=object)
    tree = store.keep(numbered(x.mapInArrow(factors(count, exact), "r array<double>")), "factors")
    while True:
        parts = tree.select("part").distinct().count()
        if parts <= 1:
            break
        joined = tree.repartition("part").sortWithinPartitions("part").mapInArrow(by_part, "part long, r array<double>")
        following = store.keep(joined.withColumn("part", F.expr(f"part div {FAN_IN}")), "factors")
        store.drop(tree)
        tree = following
    size = len(exact)
    # one factor, or the same number from all: it has at most `size` rows
    r = np.zeros((size, size))
    last = np.linalg.qr(np.array([row["r"] for row in tree.select("r").collect()]).reshape(-1, size), mode="r")
    r[: len(last)] = last
    store.drop(tree)
    total = float((r * r).sum())
    diagonal, above, right = bidiagonal(r)
    values, vectors = right_vectors(diagonal, above, components)
    for k in range(len(right) - 1, -1, -1):
        tail = vectors[:, k + 1 :]
        tail -= np.outer(tail @ right[k], right[k])
    return Whitening(count, exact, vectors, np.sqrt(values / count), values / total if total else values)


def numbered(factor_rows: DataFrame) -> DataFrame:
    """Rows of factors under the number of the task that made them, by groups of FAN_IN."""
    return factor_rows.withColumn("part", F.expr(f"spark_partition_id() div {FAN_IN}").cast("long")).select("part", "r")


def by_part(batches):
    """Joins the factors of each part, which stand one after the other."""
    part, held = None, None
    for batch in batches:
        parts = batch.column(0).to_numpy(zero_copy_only=False)
        rows = matrix(batch.column(1))
        cuts = np.flatnonzero(np.diff(parts)) + 1
        for first, last in zip([0, *cuts], [*cuts, len(parts)], strict=True):
            if first == last:
                continue
            if parts[first] != part:
                if held is not None:
                    yield from labelled(part, held)
                part, held = int(parts[first]), np.zeros((0, rows.shape[1]))
            held = np.linalg.qr(np.vstack([held, rows[first:last]]), mode="r")
    if held is not None:
        yield from labelled(part, held)


def labelled(part: int, factor: np.ndarray):
    for one in triangle(factor):
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(factor), pa.int64()), one.column(0)], names=["part", "r"])


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened vectors: one row per vector and component.

    Columns vec_id, component (from 1), n, deviation, whitened, explained, identity_error. Vectors that
    are null or hold null or non-finite entries are dropped, as those of an odd length (see usable);
    a row without vec_id, and rows that share one, count each. Components without variance do not
    appear: equal rows, or a single one, give none. deviation is null where it passes a long. An
    empty table gives an empty table.
    """
    spark = vectors.sparkSession
    store = Store(spark, "whitening")
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    rows = usable(vectors)
    model = fit(store, rows, components)
    if model is None or not len(model.roots):
        return spark.createDataFrame([], schema)
    totals = rows.select("x").mapInArrow(moments(model), "i long, j long, total double")
    found = np.zeros((len(model.roots) + 1, len(model.roots)))
    for one in totals.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        found[one["i"], one["j"]] = one["total"]
    mean = found[-1] / model.count
    covariance = found[:-1] / model.count - np.outer(mean, mean)
    error = float(np.abs(covariance - np.eye(len(model.roots))).max())
    return rows.mapInArrow(emit(model, error), schema)
