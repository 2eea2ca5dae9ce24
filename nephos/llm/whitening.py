"""Whitening of embeddings: streamed moments, merged in parallel, and a symmetric QR eigen-solve.

Each task adds its vectors one by one to a mean and a matrix of centred second
moments (Welford's rank-one update).  Tasks' moments meet in GROUPS tasks and then
in one, always two at a time by the parallel update formula, in the order of the
partitions; one matrix of d x d numbers reaches the driver, whatever the number of
vectors.  There a Householder reduction and implicit QR steps with Wilkinson's
shift give eigenvalues and unit eigenvectors.  Every vector is then centred by the
exact mean and projected.

Entries count as whole numbers, floor(SCALE * c) + SHIFT, so sums and the squared
deviation from the mean are exact.

Defined cases: rows whose vector is null, or holds a null, a non-finite entry or
one of BOUND or more in size, are left out; so are vectors of another length than
the commonest (the greater of two as common), and empty ones.  A null id is kept.
Equal vectors, repeated rows and equal ids give equal rows, each its own.  Vectors
may have any length that one task can hold.  Components whose eigenvalue is rounding
noise have no whitened value (null), and do not count for the identity error; with
no spread at all explained and identity_error are null.  Equal eigenvalues share
their space, in any basis of it, the same for all rows.  A squared deviation beyond
a long is null.  Extra columns, whatever their names, are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nephos.llm.common import map_arrow
from nephos.session import ship_package

SCALE, SHIFT, BOUND = 1024, 100_000, float(2**38)
COMPONENTS = 8
#: Tasks in which the partitions' moments meet first.
GROUPS = 16
_STATE = "part int, n bigint, sums array<bigint>, mean array<double>, m2 array<double>"


class Moments:
    """Count, exact sums of whole entries, mean, and centred second moments of vectors."""

    def __init__(self, d: int):
        self.n, self.sums, self.mean, self.m2 = 0, np.zeros(d, np.int64), np.zeros(d), np.zeros((d, d))
        self._outer = np.empty((d, d))

    def add(self, row: np.ndarray) -> None:
        """Welford: the mean moves, and the matrix gains one rank-one term."""
        self.n += 1
        delta = row - self.mean
        self.mean += delta / self.n
        np.multiply.outer(delta, delta, out=self._outer)
        self._outer *= (self.n - 1) / self.n
        self.m2 += self._outer

    def merge(self, n: int, sums: np.ndarray, mean: np.ndarray, m2: np.ndarray) -> None:
        """The parallel update formula."""
        if n:
            total, delta = self.n + n, mean - self.mean
            self.m2 += m2 + np.multiply.outer(delta, delta) * (self.n * n / total)
            self.mean += delta * (n / total)
            self.sums = self.sums + sums
            self.n = total

    def batch(self, part: int) -> pa.RecordBatch:
        lists = [pa.array([x.tolist()], t) for x, t in ((self.sums, pa.list_(pa.int64())), (self.mean, pa.list_(pa.float64())), (self.m2.reshape(-1), pa.list_(pa.float64())))]
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([self.n], pa.int64()), *lists], names=["part", "n", "sums", "mean", "m2"])


def matrix(vectors: pa.ListArray, d: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def whole(vectors: np.ndarray) -> np.ndarray:
    """The whole numbers that stand for entries; exact, as SCALE is a power of 2."""
    return np.floor(SCALE * vectors.astype(np.float64)).astype(np.int64) + SHIFT


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, vector): the rows that count, as doubles, before lengths are looked at."""
    v = F.col("vector")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= BOUND))
    return embeddings.select("vec_id", F.col(f"`{vector}`").cast("array<double>").alias("vector")).where(v.isNotNull() & ~bad & (F.size(v) > 0))


def common_length(rows: DataFrame) -> int:
    """The commonest length of ``vector``, the greater of two as common; 0 without rows."""
    sizes = rows.groupBy(F.size("vector").alias("d")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else 0


def moments(rows: DataFrame, d: int, integers: bool = True) -> Moments:
    """The moments of ``vector``, whole numbers or as it is."""
    ship_package(rows.sparkSession)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Moments(d)
        for batch in batches:
            x = matrix(batch.column(0), d)
            if integers:
                x = whole(x)
                state.sums += x.sum(axis=0)
                x = x.astype(np.float64)
            for row in x:
                state.add(row)
        if state.n:
            yield state.batch(TaskContext.get().partitionId())

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, part = Moments(d), None
        for batch in batches:
            part = batch.column(0)[0].as_py() if part is None and batch.num_rows else part
            for k in range(batch.num_rows):
                n, sums, mean, m2 = (batch.column(i)[k].as_py() for i in range(1, 5))
                state.merge(n, np.array(sums, np.int64), np.array(mean), np.array(m2).reshape(d, d))
        if state.n:
            yield state.batch(part)

    parts = rows.select("vector").mapInArrow(gather, _STATE)
    met = parts.repartition(GROUPS, F.col("part") % GROUPS).sortWithinPartitions("part").mapInArrow(meet, _STATE)
    last = met.repartition(1).sortWithinPartitions("part").mapInArrow(meet, _STATE).first()
    out = Moments(d)
    if last:
        out.merge(last["n"], np.array(last["sums"], np.int64), np.array(last["mean"]), np.array(last["m2"]).reshape(d, d))
    return out


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder reduction of a symmetric matrix: diagonal, off-diagonal, and Q transposed, with Q T Q' the matrix."""
    a, d = np.array(a, np.float64), len(a)
    qt = np.eye(d)
    for k in range(d - 2):
        x = a[k + 1 :, k]
        norm = np.linalg.norm(x)
        if norm == 0.0:
            continue
        v = x.copy()
        v[0] += np.copysign(norm, x[0])
        v /= np.linalg.norm(v)
        sub = a[k + 1 :, k + 1 :]
        p = sub @ v
        w = p - (v @ p) * v
        sub -= 2 * (np.multiply.outer(v, w) + np.multiply.outer(w, v))
        a[k + 1, k] = a[k, k + 1] = -np.copysign(norm, x[0])
        a[k + 2 :, k] = a[k, k + 2 :] = 0.0
        qt[k + 1 :] -= 2 * np.multiply.outer(v, v @ qt[k + 1 :])
    return np.diag(a).copy(), np.diag(a, -1).copy(), qt


def symmetric_qr(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors, as rows; the largest entry of each is positive."""
    diag, off, qt = tridiagonal(a)
    eps, hi = np.finfo(np.float64).eps, len(diag) - 1
    while hi > 0:
        near = np.abs(off[:hi]) <= eps * (np.abs(diag[:hi]) + np.abs(diag[1 : hi + 1]))
        off[:hi][near] = 0.0
        if off[hi - 1] == 0.0:
            hi -= 1
            continue
        cuts = np.flatnonzero(off[:hi] == 0.0)
        lo = int(cuts[-1]) + 1 if len(cuts) else 0
        half = (diag[hi - 1] - diag[hi]) / 2
        last = off[hi - 1]
        shift = diag[hi] - last * last / (half + np.copysign(np.hypot(half, last), half))
        x, z = diag[lo] - shift, off[lo]
        for k in range(lo, hi):
            r = np.hypot(x, z)
            c, s = (x / r, z / r) if r else (1.0, 0.0)
            if k > lo:
                off[k - 1] = r
            p, q, e = diag[k], diag[k + 1], off[k]
            diag[k] = c * c * p + 2 * c * s * e + s * s * q
            diag[k + 1] = s * s * p - 2 * c * s * e + c * c * q
            off[k] = c * s * (q - p) + (c * c - s * s) * e
            if k < hi - 1:
                x, z = off[k], s * off[k + 1]
                off[k + 1] *= c
            qt[k], qt[k + 1] = c * qt[k] + s * qt[k + 1], c * qt[k + 1] - s * qt[k]
    order = np.argsort(-diag, kind="stable")
    vectors = qt[order]
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    return diag[order], vectors * signs[:, None]


@dataclass(frozen=True)
class Whitener:
    """The fit: count, exact sums, eigenvalues and eigenvectors of the kept components, their shares of the trace."""

    d: int
    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: list[float | None]
    sound: int
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: whole numbers of 64 bits where they suffice, else of any size."""
        if self.n * (int(np.abs(x).max(initial=0)) + int(np.abs(self.sums).max(initial=0)) // max(self.n, 1) + 1) >= 2**62:
            x = x.astype(object)
        return self.n * x - self.sums

    def project(self, centred: np.ndarray) -> np.ndarray:
        """The sound components, scaled to variance 1."""
        return (centred.astype(np.float64) / self.n) @ (self.vectors[: self.sound] / np.sqrt(self.values[: self.sound, None])).T


def deviations(centred: np.ndarray) -> list[int | None]:
    """Sums of squares, exact; None beyond a long."""
    most = max((abs(int(v)) for v in (centred.max(initial=0), centred.min(initial=0))), default=0)
    if centred.dtype != object and most * most * centred.shape[1] < 2**62:
        return (centred * centred).sum(axis=1).tolist()
    sums = [sum(v * v for v in map(int, row)) for row in centred]
    return [s if s < 2**63 else None for s in sums]


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitener:
    """The whitener of ``vector``, all of length ``d``, with the identity error measured over all rows."""
    whole_moments = moments(rows, d)
    n = whole_moments.n
    values, vectors = symmetric_qr(whole_moments.m2 / max(n, 1))
    trace = float(np.trace(whole_moments.m2)) / max(n, 1)
    sound = int((values > d * np.finfo(np.float64).eps * max(float(values[0]), 0.0)).sum()) if trace > 0 else 0
    k = min(components, d)
    shares = [max(float(v), 0.0) / trace if trace > 0 else None for v in values[:k]]
    whitener = Whitener(d, n, whole_moments.sums, values[:k], vectors[:k], shares, min(sound, k))
    if not whitener.sound:
        return whitener

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        flat = whitener.project(whitener.centred(whole(matrix(batch.column(0), d))))
        offsets = pa.array(np.arange(len(flat) + 1, dtype=np.int32) * whitener.sound)
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(flat.reshape(-1)))], names=["vector"])

    after = moments(map_arrow(rows.select("vector"), run, "vector array<double>"), whitener.sound, integers=False)
    error = float(np.abs(after.m2 / after.n - np.eye(whitener.sound)).max())
    return Whitener(d, n, whitener.sums, whitener.values, whitener.vectors, shares, whitener.sound, error)


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each vector that counts and component."""
    rows = usable(embeddings, vector)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    d = common_length(rows)
    if not d:
        return embeddings.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("vector") == d)
    w = fit(rows, d, components)
    k = len(w.values)
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        centred = w.centred(whole(matrix(batch.column(1), d)))
        m = len(centred)
        flat = np.full((m, k), np.nan)
        flat[:, : w.sound] = w.project(centred)
        unsound = np.tile(np.arange(k) >= w.sound, m)
        columns = [
            batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
            pa.array(np.full(m * k, w.n, np.int64)),
            pa.array(deviations(centred), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
            pa.array(flat.reshape(-1), mask=unsound),
            pa.array(w.explained * m, pa.float64()),
            pa.array([w.identity_error] * (m * k), pa.float64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_arrow(rows, run, schema)
