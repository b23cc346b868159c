"""Whitening of embeddings by QDWH spectral divide and conquer (operator 12).

Vectors become whole numbers x = floor(scale * c). The fit takes each distinct x once, in three passes
over a table of the distinct vectors: their number and exact sums, the covariance of the centred
vectors, and the covariance of the whitened ones, which must be the identity. Only sums of fixed size
(a square of the dimension) leave the tasks, and they are added up in two levels.

The covariance V is split into invariant subspaces: for a shift s the polar factor U of V - s is found
by the dynamically weighted Halley iteration (QDWH); (U + 1) / 2 projects on the components with
eigenvalues above s, the rest belongs to the complement. Both are split again, down to single
components, the upper part first and the lower part only while components are still wanted. The mean
of a block's eigenvalues, known from its trace, is a shift that always has some on either side.

Rows whose vector is null, holds nulls or entries that are not finite, or has another length than most
vectors, are dropped. A component whose eigenvalue is 0 to working accuracy has no whitened value
(null). Entries beyond 64 bits take the nearest whole number of 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from .common import only, shared_folder

EPS = np.finfo(float).eps


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH."""
    n = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    least, eye = EPS / n, np.eye(n)  # a lower bound of the least singular value, as far as it matters here
    for _ in range(40):
        before = x
        square = min(1.0, least) ** 2
        d = (4 * (1 - square) / square**2) ** (1 / 3)
        root = math.sqrt(1 + d)
        wa = root + 0.5 * math.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:  # the inverse free form, stable for large weights
            q, _ = np.linalg.qr(np.vstack([math.sqrt(wc) * x, eye]))
            x = wb / wc * x + (wa - wb / wc) / math.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            lower = np.linalg.cholesky(eye + wc * (x.T @ x))
            x = wb / wc * x + (wa - wb / wc) * np.linalg.solve(lower.T, np.linalg.solve(lower, x.T)).T
        x = (x + x.T) / 2
        least = min(1.0, least * (wa + wb * square) / (1 + wc * square))
        if np.linalg.norm(x - before) <= (10 * EPS) ** (1 / 3) and abs(1 - least) < 10 * EPS:
            break
    return x


def _range(projector: np.ndarray, rank: int) -> np.ndarray:
    """An orthonormal basis of what a projector of this rank keeps."""
    basis = np.random.default_rng(rank).standard_normal((len(projector), rank))
    for _ in range(3):
        basis, _ = np.linalg.qr(projector @ basis)
    return basis


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below a shift; None if all eigenvalues are equal."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n))
    if spread <= 8 * n * EPS * np.linalg.norm(a):
        return None
    for turn in range(16):
        # A shift on an eigenvalue leaves the projector undecided; others lie a little beside it.
        shift = mean + spread / n * 0.03 * (turn + 1) // 2 * (-1) ** turn if turn else mean
        projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
        rank = int(round(np.trace(projector)))
        if 0 < rank < n and np.linalg.norm(projector @ projector - projector) < 1e-8 * n:
            return _range(projector, rank), _range(np.eye(n) - projector, n - rank)
    return None


def components(a: np.ndarray, wanted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns: the `wanted` highest, or all."""
    n = len(a)
    wanted = n if wanted is None else min(wanted, n)
    values, vectors = [], []
    blocks = [np.eye(n)]  # bases of subspaces still to be split, the highest eigenvalues last
    while blocks and len(values) < wanted:
        basis = blocks.pop()
        block = basis.T @ a @ basis
        block = (block + block.T) / 2
        parts = _split(block) if len(block) > 1 else None
        if parts is None:
            values += np.diag(block).tolist()
            vectors += list(basis.T)
            continue
        above, below = (np.linalg.qr(basis @ p)[0] for p in parts)
        blocks += [below, above]
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    return np.array(values)[order], np.array(vectors).reshape(-1, n)[order].T


def whole_numbers(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """key, x: the rows that take part, their entries as whole numbers."""
    entry = lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))
    good = F.forall(vector, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    kept = vectors.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & good).select(F.col(key).alias("key"), F.transform(vector, entry).alias("x"))
    lengths = kept.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return kept.where(F.size("x") == (lengths["n"] if lengths else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sums(rows: DataFrame, measure: Callable[[np.ndarray], np.ndarray], add: Callable[[np.ndarray, np.ndarray], np.ndarray], pack, unpack) -> np.ndarray | None:
    """Sum of `measure` over all batches: within tasks, then in a few tasks, then here."""

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                own = measure(_matrix(batch.slice(start, 1024)))
                total = own if total is None else add(total, own)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"data": pa.array([pack(total)], pa.binary())})

    def among(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column("data").to_pylist():
                own = unpack(data)
                total = own if total is None else add(total, own)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"data": pa.array([pack(total)], pa.binary())})

    found = rows.select("x").mapInArrow(within, "data binary").repartition(16).mapInArrow(among, "data binary").collect()
    total = None
    for row in found:
        own = unpack(row["data"])
        total = own if total is None else add(total, own)
    return total


def _exact(x: np.ndarray) -> list[int]:
    """Number of rows and the exact sums of the columns."""
    safe = len(x) * max(1, int(max(x.max(), -(x.min() + 1)))) < 1 << 62
    return [len(x), *(x.sum(axis=0).tolist() if safe else x.astype(object).sum(axis=0).tolist())]


class Fit:
    """Number, exact sums and the whitening matrix of the distinct vectors."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.floor = np.array([s // n for s in sums], object)
        self.rest = np.array([s % n for s in sums], np.int64)

    def from_floor(self, x: np.ndarray) -> np.ndarray:
        """x less the whole part of the mean, exact; as 64-bit numbers where they fit."""
        low, high = min(self.floor), max(self.floor)
        if max(abs(int(x.min()) - high), abs(int(x.max()) - low)) < 1 << 62:
            return x - self.floor.astype(np.int64)
        return x.astype(object) - self.floor

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.from_floor(x).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S)^2; null where it takes more than 64 bits."""
        near = self.from_floor(x)
        most = (int(np.abs(near).max()) + 1) * self.n
        if most * most * x.shape[1] < 1 << 63:
            return ((self.n * near - self.rest) ** 2).sum(axis=1).tolist()
        wide = self.n * near.astype(object) - self.rest.astype(object)
        return [v if v < 1 << 63 else None for v in (wide * wide).sum(axis=1).tolist()]


def _floats(d: int, e: int) -> tuple[Callable, Callable]:
    return lambda m: m.tobytes(), lambda b: np.frombuffer(b).reshape(d, e)


def whiten(vectors: DataFrame, wanted: int = 4, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """One row per vector and component, the component numbered from 1 by falling eigenvalue.

    key, component, n (distinct vectors), deviation (exact), whitened, explained (share of the
    variance; null if there is none) and identity_error (null without a component of positive variance).
    """
    spark = vectors.sparkSession
    schema = StructType(
        [StructField(key, vectors.schema[key].dataType), StructField("component", IntegerType()), StructField("n", LongType()), StructField("deviation", LongType()), *(StructField(c, DoubleType()) for c in ("whitened", "explained", "identity_error"))]
    )
    rows = whole_numbers(vectors, key, vector, scale)
    path = shared_folder(spark, "distinct-vectors")
    rows.select("x").distinct().write.parquet(path)
    distinct = spark.read.schema("x array<bigint>").parquet(path)
    counted = _sums(distinct, _exact, lambda a, b: [p + q for p, q in zip(a, b, strict=True)], lambda t: " ".join(map(str, t)).encode(), lambda b: [int(v) for v in b.split()])
    if counted is None:
        return spark.createDataFrame([], schema)
    fit = Fit(counted[0], counted[1:])
    d = len(fit.sums)

    def gram(x: np.ndarray) -> np.ndarray:
        centred = fit.centred(x)
        return centred.T @ centred

    covariance = _sums(distinct, gram, np.add, *_floats(d, d)) / fit.n
    covariance = (covariance + covariance.T) / 2
    values, directions = components(covariance, wanted)
    trace = float(np.trace(covariance))
    good = values > d * EPS * max(trace, np.finfo(float).tiny)
    whitening = directions[:, good] / np.sqrt(values[good])

    def whitened_gram(x: np.ndarray) -> np.ndarray:
        # The mean of what is whitened is 0 but for rounding, which the first row and column show.
        y = np.hstack([np.ones((len(x), 1)), fit.centred(x) @ whitening])
        return y.T @ y

    k = int(good.sum())
    moments = _sums(distinct, whitened_gram, np.add, *_floats(k + 1, k + 1)) / fit.n
    identity = moments[1:, 1:] - np.outer(moments[0, 1:], moments[0, 1:]) - np.eye(k)
    error = float(np.abs(identity).max()) if k else None
    explained = [float(v / trace) if trace > 0 else None for v in values]
    numbers = np.cumsum(good) - 1  # the column of each component in the whitening matrix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only()
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                x = _matrix(part)
                projected, far = fit.centred(x) @ whitening, fit.deviation(x)
                for c in range(len(values)):
                    own = pa.array(projected[:, numbers[c]], pa.float64()) if good[c] else pa.nulls(len(x), pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [part.column("key"), pa.array([c + 1] * len(x), pa.int32()), pa.array([fit.n] * len(x), pa.int64()), pa.array(far, pa.int64()), own,
                         *(pa.array([v] * len(x), pa.float64()) for v in (explained[c], error))],
                        schema.names,
                    )

    return rows.mapInArrow(run, schema)
