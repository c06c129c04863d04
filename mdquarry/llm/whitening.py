"""Whitening of embeddings by an incremental eigendecomposition.

A spectrum is (n, sums, eigenvalues d and eigenvectors Q of the scatter matrix
sum (x - mean)(x - mean)').

1. Every task runs through its vectors in blocks and keeps one spectrum
   (:class:`Spectrum`). A block is centred and rotated (QR) to at most ``dim``
   rows of equal scatter; each row, and the shift between the block's mean and
   the mean so far, is a centred rank-one update Q diag(d) Q' + z z'. The new
   eigenvalues are the roots of the secular equation 1 + sum z_i^2 / (d_i - t),
   one between two old ones; entries with z_i = 0 and equal d_i are deflated
   first (:func:`rank_one`).
2. The tasks' spectra are combined ``FAN`` at a time, round by round: the
   eigenpairs of one are successive rank-one updates of the other, and one
   more update stands for the distance of their means.
3. The last spectrum's vectors are the basis of a distributed Rayleigh-Ritz
   step: all vectors, centred by the exact sums, are projected on it, the
   projected scatter is added up over the tasks, and its small eigenproblem
   turns the basis into the final components.

What reaches the driver has a size set by the dimension alone (one spectrum,
dim * dim sums, components * components sums).

Edge cases: vectors that are null, empty, or hold null or non-finite entries,
or entries that are no 64-bit number once scaled, take no part; of vectors of
different sizes the most frequent size takes part (ties: the smaller one);
repeated ids and rows count as often as they occur, null ids are handed on;
components without variance (within double precision of the whole) are left
out, so one vector, or equal vectors only, give no rows, like an empty table; a deviation beyond 64 bits is null;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from .common import groups, keep, read

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
BLOCK = 4096  # vectors rotated together
FAN = 16  # spectra combined by a task
_EPS = np.finfo(np.float64).eps
_LOW = np.int64((1 << 32) - 1)


def to_integers(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """id, vector array<long>: floor(scale * c) + shift of the vectors that take part."""
    v, limit = F.col("vector"), F.lit(float(2**62))
    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double") * scale) < limit), F.lit(False)))
    x = vectors.where(ok).select("id", F.transform(
        v, lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(shift).cast("long")).alias("vector"))
    sizes = x.groupBy(F.size("vector").alias("dim")).count()
    best = sizes.orderBy(F.col("count").desc(), "dim").first()
    return x.where(F.size("vector") == (best["dim"] if best else 0))


def _secular(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + z z' for rising distinct d and non-zero z, and the matrix d_j - value_i (row j).

    Root i lies between d_i and d_(i+1). It is sought as a distance from the
    nearer of both, so that differences to the poles keep their precision.
    """
    z2 = z * z
    top = np.append(d[1:], d[-1] + z2.sum())
    middle = (d + top) / 2
    with np.errstate(divide="ignore", over="ignore"):
        right = 1 + (z2[:, None] / (d[:, None] - middle[None, :])).sum(axis=0) < 0  # the root is above the middle
        right[-1] = False
        origin = np.where(right, top, d)
        gap = d[:, None] - origin[None, :]
        low, high = np.where(right, middle - top, 0.0), np.where(right, 0.0, middle - d)
        high[-1] = z2.sum()  # not top - d, which is 0 for a small z beside a large d
        for _ in range(80):
            t = (low + high) / 2
            below = 1 + (z2[:, None] / (gap - t[None, :])).sum(axis=0) < 0
            low, high = np.where(below, t, low), np.where(below, high, t)
            if (high - low <= 2 * _EPS * np.abs(high + low)).all():
                break
        t = (low + high) / 2
    far = gap - t[None, :]
    return origin + t, far


def rank_one(d: np.ndarray, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and vectors (columns) of q diag(d) q' + v v'."""
    z = q.T @ v
    size = max(float(np.abs(d).max(initial=0.0)), float(z @ z))
    if size == 0:
        return d, q
    tiny = 8 * _EPS * size
    # equal eigenvalues: a reflection of their space leaves one of them with a part in z
    cuts = np.flatnonzero(np.r_[True, np.diff(d) > tiny, True])
    wide = np.flatnonzero(np.diff(cuts) > 1)
    if len(wide):
        q, z = q.copy(), z.copy()
        for a, b in zip(cuts[wide], cuts[wide + 1]):
            u = z[a:b].copy()
            norm = np.sqrt(u @ u)
            if norm == 0:
                continue
            sign = 1.0 if u[-1] >= 0 else -1.0
            u[-1] += sign * norm
            q[:, a:b] -= np.outer(q[:, a:b] @ u, u) * (2 / (u @ u))
            z[a:b] = 0
            z[b - 1] = -sign * norm
    live = np.abs(z) * np.sqrt(size) > tiny
    if not live.any():
        return d, q
    dl, zl = d[live], z[live]
    new, far = _secular(dl, zl)
    # the z whose exact eigenvalues the computed roots are: with it the vectors are orthogonal
    poles = dl[None, :] - dl[:, None]
    np.fill_diagonal(poles, 1.0)
    z_hat = np.sqrt(np.abs(np.prod(-far / poles, axis=1))) * np.sign(zl)
    w = z_hat[:, None] / far
    w /= np.sqrt((w * w).sum(axis=0))
    d, q = d.copy(), q.copy()
    d[live], q[:, live] = new, q[:, live] @ w
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


class Spectrum:
    """n, exact sums and the eigendecomposition of the scatter of the vectors seen so far."""

    def __init__(self, dim: int):
        self.n, self.high, self.low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        self.d, self.q = np.zeros(dim), np.eye(dim)

    @property
    def sums(self) -> list[int]:
        """Exact sums of the components; kept as sums of upper and lower halves, which don't overflow."""
        return [(int(h) << 32) + int(l) for h, l in zip(self.high, self.low)]

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def _join(self, n: int, high: np.ndarray, low: np.ndarray, mean: np.ndarray, rows: np.ndarray) -> None:
        """Takes in n vectors of the given sums whose scatter is rows' rows: one rank-one update for each row."""
        if self.n:
            rows = np.vstack([rows, (mean - self.mean()) * np.sqrt(self.n * (n / (self.n + n)))])
        for v in rows:
            if v.any():
                self.d, self.q = rank_one(self.d, self.q, v)
        self.n, self.high, self.low = self.n + n, self.high + high, self.low + low

    def add(self, x: np.ndarray) -> None:
        """Takes in a block of integer vectors (rows)."""
        part = Spectrum(x.shape[1])
        part.n, part.high, part.low = len(x), (x >> np.int64(32)).sum(axis=0), (x & _LOW).sum(axis=0)
        mean = part.mean()
        rows = x - mean
        if len(rows) > rows.shape[1]:
            rows = np.linalg.qr(rows, mode="r")
        self._join(part.n, part.high, part.low, mean, rows)

    def merge(self, other: "Spectrum") -> None:
        """Takes in another spectrum: its eigenpairs are the rows."""
        if other.n:
            rows = (other.q * np.sqrt(np.maximum(other.d, 0.0))).T
            self._join(other.n, other.high, other.low, other.mean(), rows)

    def pack(self) -> bytes:
        return b"".join([np.array([self.n, len(self.d)], "<i8").tobytes(), self.high.astype("<i8").tobytes(),
                         self.low.astype("<i8").tobytes(), self.d.astype("<f8").tobytes(), self.q.astype("<f8").tobytes()])

    @classmethod
    def unpack(cls, data: bytes) -> "Spectrum":
        n, dim = (int(v) for v in np.frombuffer(data, "<i8", 2))
        s = cls(dim)
        s.n = n
        s.high, s.low = np.frombuffer(data, "<i8", 2 * dim, 16).reshape(2, dim)
        floats = np.frombuffer(data, "<f8", dim + dim * dim, 16 + 16 * dim)
        s.d, s.q = floats[:dim], floats[dim:].reshape(dim, dim)
        return s


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column whose lists have equal sizes."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def spectrum(x: DataFrame) -> Spectrum | None:
    """The spectrum of all vectors of :func:`to_integers`; None if there are none."""
    def partial(batches):
        from pyspark import TaskContext

        s = None
        for b in batches:
            if b.num_rows:
                m = _matrix(b.column(0))
                s = s or Spectrum(m.shape[1])
                for at in range(0, len(m), BLOCK):
                    s.add(m[at:at + BLOCK])
        if s:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.array([s.pack()], pa.binary())], ["g", "data"])

    def combine(batches):
        for b, off in groups(batches):
            for a, z in zip(off, off[1:]):
                first, *rest = (Spectrum.unpack(v) for v in b.column(1).slice(a, z - a).to_pylist())
                for s in rest:
                    first.merge(s)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, 1), pa.array([first.pack()], pa.binary())],
                                                 ["g", "data"])

    schema = "g long, data binary"
    rows = keep(x.select("vector").mapInArrow(partial, schema), "spectra")
    n = rows.count()
    while n > 1:
        up = rows.select(F.floor(F.col("g") / FAN).cast("long").alias("g"), "data")
        up = up.repartition(max(1, n // FAN), "g").sortWithinPartitions("g", "data")
        rows = keep(up.mapInArrow(combine, schema), "spectra")
        n = rows.count()
    last = rows.first()
    return Spectrum.unpack(bytes(last["data"])) if last else None


def _centred(m: np.ndarray, n: int, sums: list[int], mean: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """x - sums / n of integer vectors; and n * x - sums, if that is exact in 64 bits, else None."""
    widest = max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))
    if n * widest < 2**61 and all(abs(s) < 2**61 for s in sums):
        exact = n * m - np.array(sums, np.int64)
        return exact / n, exact
    return m - mean, None


def _added(x: DataFrame, per_block, size: int) -> np.ndarray:
    """Sums over all vectors of the ``size`` numbers that ``per_block`` makes of a block; only these reach the driver."""
    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                m = _matrix(b.column(0))
                for at in range(0, len(m), BLOCK):
                    part = per_block(m[at:at + BLOCK])
                    total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["i", "v"])

    rows = x.select("vector").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["i"]] = r["v"]
    return out


def refine(x: DataFrame, s: Spectrum) -> tuple[np.ndarray, np.ndarray, float]:
    """Rayleigh-Ritz over all vectors: falling eigenvalues of the covariance, its vectors (columns), its trace."""
    n, sums, mean, q = s.n, s.sums, s.mean(), np.linalg.qr(s.q)[0]
    dim = len(q)

    def per_block(m):
        y = _centred(m, n, sums, mean)[0] @ q
        return (y.T @ y).reshape(-1)

    t = _added(x, per_block, dim * dim).reshape(dim, dim) / n
    e, w = np.linalg.eigh((t + t.T) / 2)
    return e[::-1], (q @ w)[:, ::-1], float(np.trace(t))


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error, from (id, vector array).

    One row for each vector that takes part and component (from 1, by falling
    eigenvalue). deviation is the sum of (n * x - sums)^2; explained is the
    eigenvalue's share of the trace; identity_error is the largest difference
    between the covariance of the whitened columns and the identity.
    """
    spark = vectors.sparkSession
    schema = StructType([StructField("id", vectors.schema["id"].dataType), StructField("component", IntegerType()),
                         StructField("n", LongType()), StructField("deviation", LongType()),
                         StructField("whitened", DoubleType()), StructField("explained", DoubleType()),
                         StructField("identity_error", DoubleType())])
    x = keep(to_integers(vectors.select("id", "vector"), scale, shift), "integers")
    s = spectrum(x)
    if s is None:
        return spark.createDataFrame([], schema)
    e, v, trace = refine(x, s)
    k = int((e[:components] > len(e) * _EPS * max(trace, 0.0) * 16).sum())
    if not k:
        return spark.createDataFrame([], schema)
    n, sums, mean = s.n, s.sums, s.mean()
    to_white = v[:, :k] / np.sqrt(e[:k])

    def moments(m):
        y = _centred(m, n, sums, mean)[0] @ to_white
        return np.append((y.T @ y).reshape(-1), y.sum(axis=0))

    added = _added(x, moments, k * k + k) / n
    away = added[:k * k].reshape(k, k) - np.outer(added[k * k:], added[k * k:]) - np.eye(k)
    error = float(np.abs(away).max())
    explained = e[:k] / trace

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                m = _matrix(part.column(1))
                y, exact = _centred(m, n, sums, mean)
                if exact is None:
                    deviation = [sum((n * a - t) ** 2 for a, t in zip(row, sums)) for row in m.tolist()]
                    deviation = [a if a < 2**63 else None for a in deviation]
                else:
                    wide = (exact.astype(np.float64) ** 2).sum(axis=1) >= 2.0**62
                    deviation = (exact * exact).sum(axis=1).tolist()
                    for i in np.flatnonzero(wide).tolist():
                        total = sum(a * a for a in exact[i].tolist())
                        deviation[i] = total if total < 2**63 else None
                row = np.repeat(np.arange(len(m)), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(m))),
                     pa.array(np.full(len(row), n, np.int64)), pa.array(deviation, pa.int64()).take(pa.array(row)),
                     pa.array((y @ to_white).reshape(-1)), pa.array(np.tile(explained, len(m))),
                     pa.array(np.full(len(row), error))], schema.names)

    return x.select("id", "vector").mapInArrow(run, schema)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return whiten(e).withColumnRenamed("id", "vec_id")
