"""Whitening of embeddings from the singular values of their centred rows.

Tasks reduce their centred rows to triangles by QR, block by block; triangles are
stacked and reduced again in rounds until one is left, R, whose R'R is n times the
covariance. R is d x d, so its own reduction is no work of the rows: Householder
reflections make it bidiagonal, dqds finds all singular values of that to high
relative accuracy, and twisted factorisations of the shifted product give the
vectors. All rows are then projected in one more pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointloom.llm.shared import map_batches, sliced, written

#: Triangles that one task stacks, and rows of a block that it reduces at once.
FAN, BLOCK = 32, 2048
EPS = np.finfo(np.float64).eps


# ---- singular vectors of a triangle -------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal and upper diagonal of Q'RP, and the right reflections (first column, unit vector)."""
    a, d, right = r.copy(), len(r), []

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.abs(x).max(initial=0.0)
        if size == 0 or not np.any(x[1:]):
            return None
        v = x / size
        v[0] += np.copysign(np.sqrt((v * v).sum()), v[0])
        return v / np.sqrt((v * v).sum())

    for k in range(d):
        v = reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 2 < d:
            v = reflector(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
                right.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One differential quotient-difference step with a shift, and its pivots; None if the shift exceeds the least eigenvalue."""
    out_q, out_e = [], []
    d = q[0] - shift
    pivots = [d]
    for k in range(len(q) - 1):
        if d < 0:
            return None
        top = d + e[k]
        ratio = q[k + 1] / top if top > 0 else 0.0
        out_q.append(top)
        out_e.append(e[k] * ratio)
        d = d * ratio - shift
        pivots.append(d)
    return None if d < 0 else ([*out_q, d], out_e, pivots)


def singular_squares(diag: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling.

    Each round is a step without a shift, whose pivots bound the least value from both
    sides (their least from above, the inverse of their inverses' sum from below), and
    one with the largest shift that keeps all pivots positive. Values part from the end.
    """
    found: list[float] = []
    parts = [((diag * diag).tolist(), (upper * upper).tolist(), 0.0)]
    while parts:
        q, e, moved = parts.pop()
        while q:
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS * EPS * (moved + min(q[k], q[k + 1]))), -1)
            if cut == len(q) - 2:  # also a single value
                found.append(q.pop() + moved)
                del e[-1:]
                continue
            if cut >= 0:
                parts.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
            if q[0] < q[-1]:  # the same matrix from its other end: small values part sooner
                q, e = q[::-1], e[::-1]
            q, e, pivots = dqds(q, e, 0.0)
            least = min(pivots)
            if least == 0:  # singular: the next round parts the zero
                if q[-1] == 0:
                    e[-1] = 0.0
                continue
            below = (1 - 8 * len(q) * EPS) / sum(1 / d for d in pivots)
            for shift in (least * (1 - 8 * EPS), least * 0.75, below):
                step = dqds(q, e, shift)
                if step is not None:
                    q, e, _ = step
                    moved += shift
                    break
    return np.sort(np.array(found))[::-1]


class Twisted:
    """B'B - value as factors from both ends that meet at any row; B is upper bidiagonal."""

    def __init__(self, diag: np.ndarray, upper: np.ndarray, value: float):
        n, tiny = len(diag), EPS * EPS * max(value, 1e-300)
        d, low = (diag * diag).tolist(), (upper / diag[:-1]).tolist()
        self.down, self.left, s = [0.0] * n, [0.0] * n, [-value] * n
        for k in range(n):
            self.down[k] = d[k] + s[k] or tiny
            if k + 1 < n:
                self.left[k] = d[k] * low[k] / self.down[k]
                s[k + 1] = self.left[k] * low[k] * s[k] - value
        self.up, self.right, p = [0.0] * n, [0.0] * n, [d[-1] - value] * n
        p[-1] = self.up[-1] = p[-1] or tiny
        for k in range(n - 2, -1, -1):
            self.up[k + 1] = d[k] * low[k] * low[k] + p[k + 1] or tiny
            ratio = d[k] / self.up[k + 1]
            self.right[k] = low[k] * ratio
            p[k] = p[k + 1] * ratio - value or tiny
        self.middle = [(x + y + value) or tiny for x, y in zip(s, p)]
        self.order = sorted(range(n), key=lambda k: abs(self.middle[k]))

    def vector(self, row: int) -> np.ndarray:
        """The vector that is 1 at ``row`` and that B'B - value takes to a multiple of that unit vector."""
        z = [0.0] * len(self.down)
        z[row] = 1.0
        for k in range(row - 1, -1, -1):
            z[k] = -self.left[k] * z[k + 1]
        for k in range(row, len(z) - 1):
            z[k + 1] = -self.right[k] * z[k]
        return unit(np.array(z))

    def solved(self, b: np.ndarray) -> np.ndarray:
        """One step of inverse iteration, by the factors that meet at the least middle."""
        row, w, n = self.order[0], b.tolist(), len(self.down)
        for k in range(1, row + 1):
            w[k] -= self.left[k - 1] * w[k - 1]
        for k in range(n - 2, row - 1, -1):
            w[k] -= self.right[k] * w[k + 1]
        w = [x / (self.down[k] if k < row else self.up[k] if k > row else self.middle[k]) for k, x in enumerate(w)]
        for k in range(row - 1, -1, -1):
            w[k] -= self.left[k] * w[k + 1]
        for k in range(row, n - 1):
            w[k + 1] -= self.right[k] * w[k]
        return unit(np.array(w))


def unit(z: np.ndarray) -> np.ndarray:
    z = z / max(np.abs(z).max(), 1e-300)
    return z / np.sqrt((z * z).sum())


def apart(z: np.ndarray, others: np.ndarray) -> np.ndarray:
    """``z`` without its share in the orthonormal columns ``others``, taken off until rounding is all that is left."""
    for _ in range(3):
        z = unit(z - others @ (others.T @ z))
    return z


#: Values nearer than this share of themselves form a cluster, whose vectors are made orthogonal one after the other by so many steps of inverse iteration.
NEAR, STEPS = 1e-4, 3


def right_vectors(diag: np.ndarray, upper: np.ndarray, squares: np.ndarray, k: int) -> np.ndarray:
    """Right singular vectors (columns) of a bidiagonal matrix for its first ``k`` squared values.

    Values that rounding can't tell apart have vectors that are orthogonal and belong to
    their common space to about 1e-8; all others are good to double precision.
    """
    size = max(np.abs(diag).max(), np.abs(upper).max(initial=0.0), 1e-150)
    diag = np.where(np.abs(diag) < EPS * EPS * size, EPS * EPS * size, diag)
    out = np.zeros((len(diag), k))
    begin = 0
    for j in range(k):
        if j and squares[j - 1] - squares[j] > NEAR * squares[j - 1]:
            begin = j
        t = Twisted(diag, upper, float(squares[j]))
        others = out[:, begin:j]
        for row in t.order:
            z = t.vector(row)
            if j > begin:
                z = z - others @ (others.T @ z)
            if j == begin or np.abs(z).max() > 0.1 / len(z):
                break
        for _ in range(STEPS if j > begin else 0):
            z = apart(t.solved(apart(z, others)), others)
        out[:, j] = unit(z)
    return out


def principal(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of R, falling, and its first ``k`` right vectors (columns; the largest entry is positive).

    Vectors of values that rounding can't tell from zero are left zero.
    """
    diag, upper, right = bidiagonal(r)
    squares = singular_squares(diag, upper)
    known = int((squares[:k] > (16 * len(squares) * EPS) ** 2 * squares[0]).sum())
    v = np.hstack([right_vectors(diag, upper, squares, known), np.zeros((len(r), k - known))])
    for at, w in reversed(right):
        v[at:] -= 2 * np.outer(w, w @ v[at:])
    top = np.abs(v).argmax(axis=0)
    return squares, v * np.where(v[top, np.arange(k)] < 0, -1.0, 1.0)


# ---- over the rows -----------------------------------------------------------------


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): vectors whose entries are all there, finite and of a size that 64 times them fits a long."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 56)))
    return vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(F.coalesce((F.size("v") > 0) & fine, F.lit(False)))


def integers(column: pa.Array, dims: int) -> np.ndarray:
    """floor(64 c) + 1000000 of each entry, as longs."""
    return np.floor(64 * column.flatten().to_numpy(zero_copy_only=False)).astype(np.int64).reshape(-1, dims) + 1_000_000


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(size, dim, n, s): a task's vectors of each length, and their sums by dimension, exact."""
    held: dict[int, list] = {}
    for batch in sliced(batches):
        sizes = np.diff(batch.column(0).offsets.to_numpy())
        for d in np.unique(sizes).tolist():
            x = integers(batch.column(0).filter(pa.array(sizes == d)), d)
            safe = int(np.abs(x).max()) * len(x) < 1 << 62
            s = x.sum(axis=0).tolist() if safe else [sum(c) for c in x.T.tolist()]
            n, before = held.get(d, (0, [0] * d))
            held[d] = [n + len(x), [a + b for a, b in zip(before, s)]]
    for d, (n, s) in held.items():
        columns = [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array([str(x) for x in s])]
        yield pa.RecordBatch.from_arrays(columns, names=["size", "dim", "n", "s"])


class Centre:
    """Means of integer columns, taken off exactly: the whole part as integers, the rest as a fraction."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([(s % n) / n for s in sums])

    def rows(self, column: pa.Array) -> np.ndarray:
        return (integers(column, len(self.sums)) - self.whole).astype(np.float64) - self.rest

    def deviations(self, column: pa.Array) -> list[int | None]:
        """Sum of (n x - S)^2 over the dimensions, exact; null where a long can't hold it."""
        x = integers(column, len(self.sums))
        far = (int(np.abs(x - self.whole).max(initial=0)) + 1) * self.n
        if far * far * len(self.sums) < 1 << 63:
            y = (x - self.whole) * self.n - np.array([s % self.n for s in self.sums], np.int64)
            return (y * y).sum(axis=1).tolist()
        totals = [sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums)) for row in x.tolist()]
        return [t if t < 1 << 63 else None for t in totals]


def triangle(rows: list[np.ndarray]) -> np.ndarray:
    """R of the stacked rows, d x d."""
    stacked = np.vstack(rows)
    if len(stacked) < stacked.shape[1]:
        stacked = np.vstack([stacked, np.zeros((stacked.shape[1] - len(stacked), stacked.shape[1]))])
    return np.linalg.qr(stacked, mode="r")


def reduced(rows: DataFrame, centre: Centre) -> np.ndarray:
    """R of all centred rows: a triangle a task, then up to ``FAN`` of them together in rounds, so that the last task and the driver see d x d numbers."""
    dims = len(centre.sums)
    schema = "part int, r array<double>"

    def row(part: int, r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([r.ravel()], pa.list_(pa.float64()))], names=["part", "r"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = None
        for batch in sliced(batches, BLOCK):
            r = triangle(([] if r is None else [r]) + [centre.rows(batch.column(0))])
        if r is not None:
            yield row(TaskContext.get().partitionId(), r)

    def stack(key: tuple, table: pa.Table) -> pa.Table:
        ordered = table.sort_by("part").column("r").combine_chunks().flatten().to_numpy().reshape(-1, dims, dims)
        return pa.Table.from_batches([row(key[0].as_py(), triangle(list(ordered)))])

    found = written(rows.select("v").mapInArrow(first, schema), "triangles")
    parts = (found.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        found = found.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).withColumn("to", F.col("part")).groupBy("to").applyInArrow(lambda k, t: stack(k, t.select(["part", "r"])), schema)
        parts = -(-parts // FAN)
    return np.array(found.first()["r"]).reshape(dims, dims)


def whitened(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each row and component.

    Rows whose vector is null, empty or holds null or non-finite entries (or some beyond
    2^56) are left out, and so are those of another length than most have (the longer of
    two lengths that are equally frequent): they lack entries. All others are fitted.
    Components without variance have whitened 0 and no part in ``identity_error``, which is
    measured on all rows; ``explained`` is 0 where nothing varies. ``deviation`` is null
    where a long can't hold it. Rows may repeat, ids may be null. Without rows to fit
    the result is empty; other columns are not read.
    """
    spark = vectors.sparkSession
    schema = f"`{id_col}` bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = usable(vectors, id_col, vector_col)
    sums = rows.select("v").mapInArrow(summed, "size int, dim int, n bigint, s string")
    totals = written(sums.groupBy("size", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")), "sums")
    top = totals.orderBy(F.desc("n"), F.desc("size")).first()
    if top is None:
        return spark.createDataFrame([], schema)
    centre = Centre(top["n"], [int(r["s"]) for r in totals.where(F.col("size") == top["size"]).orderBy("dim").collect()])
    rows = rows.where(F.size("v") == top["size"])
    k = min(components, top["size"])
    squares, directions = principal(reduced(rows, centre), k)
    values, trace = squares / centre.n, float(squares.sum() / centre.n)
    varies = directions.any(axis=0)
    scale = np.where(varies, 1 / np.sqrt(np.where(varies, values[:k], 1.0)), 0.0)
    explained = values[:k] / trace if trace > 0 else np.zeros(k)

    def projected(column: pa.Array) -> np.ndarray:
        return centre.rows(column) @ directions * scale

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, both = np.zeros(k), np.zeros((k, k))
        for batch in sliced(batches):
            w = projected(batch.column(0))
            total, both = total + w.sum(axis=0), both + w.T @ w
        i, j = np.indices((k + 1, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(np.vstack([both, total]).ravel())], names=["i", "j", "s"])

    table = np.zeros((k + 1, k))
    for r in rows.select("v").mapInArrow(moments, "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        table[r["i"], r["j"]] = r["s"] / centre.n
    left = np.abs(table[:k] - np.outer(table[k], table[k]) - np.eye(k))[np.ix_(varies, varies)]
    error = float(left.max(initial=0.0))

    def emit():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            m = batch.num_rows
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, centre.n, np.int64)),
                pa.array(centre.deviations(batch.column(1)), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(projected(batch.column(1)).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
            ]
            return pa.RecordBatch.from_arrays(columns, names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

        return step

    return map_batches(rows.select(F.col("id").cast("bigint").alias("id"), "v"), emit, schema)
