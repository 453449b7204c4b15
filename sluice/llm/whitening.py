"""Whitening of embeddings by polarisation.

Entries become integers, so every sum is exact. One pass sums each dimension, a second one the
squares of each centred dimension and of each centred sum of two dimensions. A covariance is half
of what the variance of a sum of two dimensions has above their own variances; the differences are
taken in whole numbers, so nothing cancels. The covariance matrix, whose size follows from the
dimensions and not from the rows, is then split into eigenvectors on the driver.

Centring is by the floor q of the mean, which keeps numbers small: with z = x - q and r the rest of
the sum S = n * q + r, the squares of n * x - S add up to n * (n * sum(z^2) - r^2).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.llm.common import Stage

#: Entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Scaled entries beyond this size count as this size, so that no sum outgrows 38 digits.
LARGEST = 1 << 45
COMPONENTS = 8
#: Numbers of a block that is squared at once; it stays in a core's cache.
BLOCK = 1 << 15
#: Eigenvalues below this share of the largest are rounding: such a component is not whitened.
NOISE = 1e-13

_TOTAL = pa.decimal128(38, 0)


def _usable(batch: pa.RecordBatch, column: int = 0) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows whose vector is whole, by length: row numbers and integer entries (rows x dimensions)."""
    vectors = batch.column(column)
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)  # nulls become NaN
    sizes = np.where(vectors.is_valid().to_numpy(zero_copy_only=False),
                     vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    whole = (sizes > 0) & (bad[ends] == bad[ends - sizes])
    found = {}
    for size in np.unique(sizes[whole]):
        rows = np.flatnonzero(whole & (sizes == size))
        entries = flat[(ends[rows] - size)[:, None] + np.arange(size)]
        scaled = np.clip(np.floor(entries * SCALE), -LARGEST, LARGEST)
        found[int(size)] = rows, scaled.astype(np.int64) + SHIFT
    return found


def _totals(rows: list[tuple]) -> pa.RecordBatch:
    a, b, total = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(map(Decimal, total), _TOTAL)], names=["a", "b", "total"]
    )


_SUMS = "a int, b int, total decimal(38,0)"


def _dimension_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one task: (length, dimension, sum of x); dimension -1 has the number of rows."""
    sums: dict[tuple[int, int], int] = defaultdict(int)
    for batch in batches:
        for size, (rows, x) in _usable(batch).items():
            sums[size, -1] += len(rows)
            high, low = (x >> 24).sum(axis=0), (x & 0xFFFFFF).sum(axis=0)
            for i in range(size):
                sums[size, i] += (int(high[i]) << 24) + int(low[i])
    yield _totals([(*key, total) for key, total in sums.items()])


class PairSums:
    """Sums of z_i^2 and (z_i + z_j)^2 over rows, exact at any size of the numbers."""

    def __init__(self, size: int):
        self.size = size
        self.total = np.zeros((size, size), object)
        self._running, self._bound = np.zeros((size, size), np.int64), 0

    def _flush(self) -> None:
        self.total += self._running
        self._running[:], self._bound = 0, 0

    def add(self, z: np.ndarray) -> None:
        step = max(BLOCK // self.size, 1)
        for first in range(0, len(z), step):
            block = np.ascontiguousarray(z[first:first + step].T)
            most = (2 * int(np.abs(block).max())) ** 2 * block.shape[1]
            if most >= 1 << 62:
                self._square(block.astype(object), self.total)
                continue
            if self._bound + most >= 1 << 62:
                self._flush()
            self._bound += most
            # Up to 2^53 doubles are as exact as integers, and faster.
            self._square(block.astype(np.float64) if most < 1 << 53 else block, self._running)

    @staticmethod
    def _square(block: np.ndarray, into: np.ndarray) -> None:
        def squares(rows: np.ndarray) -> np.ndarray:
            if rows.dtype == object:
                return (rows * rows).sum(axis=1)
            return np.einsum("ij,ij->i", rows, rows).astype(np.int64)

        for i in range(len(block)):
            into[i, i] += squares(block[i:i + 1])[0]
            if i + 1 < len(block):
                into[i, i + 1:] += squares(block[i + 1:] + block[i])

    def rows(self) -> list[tuple[int, int, int]]:
        self._flush()
        return [(i, j, int(self.total[i, j])) for i in range(self.size) for j in range(i, self.size)]


@dataclass(frozen=True)
class Whitening:
    """What is learned of n vectors: sums S = n * floor_mean + rest, eigenvalues falling, unit eigenvectors
    as columns, and the trace of the covariance matrix."""

    n: int
    floor_mean: tuple[int, ...]
    rest: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def size(self) -> int:
        return len(self.rest)

    def project(self, z: np.ndarray, components: int) -> np.ndarray:
        """Whitened coordinates of centred rows; NaN where a component has no variance."""
        centred = z - np.array([r / self.n for r in self.rest])
        values = self.values[:components]
        scale = np.where(values > NOISE * max(self.values[0], 0), values, np.nan) ** -0.5
        return centred @ self.vectors[:, :components] * scale

    def deviations(self, z: np.ndarray) -> np.ndarray:
        """Sum of (n * x - S)^2 for each row, exact; masked where it goes beyond a BIGINT."""
        rest = np.array(self.rest, np.float64)
        about = ((z * float(self.n) - rest) ** 2).sum(axis=1)
        # Sums modulo 2^64 are right for all that fit; only the edge needs a closer look.
        wrapped = (z.astype(np.uint64) * np.uint64(self.n) - np.array(self.rest, np.uint64)) ** 2
        exact = wrapped.sum(axis=1).astype(np.int64)
        over = about >= 2.0 ** 63
        for row in np.flatnonzero(np.abs(about / 2.0 ** 63 - 1) < 1e-6):
            over[row] = sum((self.n * int(v) - r) ** 2 for v, r in zip(z[row], self.rest)) >= 1 << 63
        return np.ma.array(exact, mask=over)


def covariances(n: int, rest: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix, divisor n, from sums of squares of centred dimensions and sums of two.

    Whole numbers up to the last division, which rounds once.
    """
    d = len(rest)
    own = [n * squares[i, i] - rest[i] ** 2 for i in range(d)]
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = own[i] / n ** 2
        for j in range(i + 1, d):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n ** 2)
    return out


def fit(vectors: DataFrame, vector_col: str = "embedding") -> Whitening | None:
    """Learn from all usable vectors; None if there are none.

    A vector is left out if it is null or empty or holds a null or non-finite entry. Vectors of
    another length than the commonest (of equal counts, the longest) cannot be compared and are
    left out too. Repeated vectors count as often.
    """
    stage = Stage(vectors.sparkSession, "whitening")
    source = vectors.select(F.col(vector_col).alias("vector"))
    sums = stage.write(source.mapInArrow(_dimension_sums, _SUMS).groupBy("a", "b").agg(F.sum("total").alias("total")), narrow=True)
    commonest = sums.filter("b = -1").orderBy(F.desc("total"), F.desc("a")).head()
    if commonest is None:
        stage.clear()
        return None
    d, n = commonest["a"], int(commonest["total"])
    total = {r["b"]: int(r["total"]) for r in sums.filter(F.col("a") == d).collect()}
    stage.clear()
    floor_mean, rest = zip(*(divmod(total[i], n) for i in range(d)))
    centre = np.array(floor_mean, np.int64)

    def pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = PairSums(d)
        for batch in batches:
            _, x = _usable(batch).get(d, (None, None))
            if x is not None:
                sums.add(x - centre)
        rows = sums.rows()
        for first in range(0, len(rows), 1 << 14):
            yield _totals(rows[first:first + (1 << 14)])

    pairs = source.mapInArrow(pair_sums, _SUMS).groupBy("a", "b").agg(F.sum("total").alias("total"))
    matrix = covariances(n, list(rest), {(r["a"], r["b"]): int(r["total"]) for r in pairs.collect()})
    values, basis = np.linalg.eigh(matrix)
    return Whitening(n, floor_mean, rest, values[::-1].copy(), basis[:, ::-1].copy(), float(np.trace(matrix)))


def transform(
    vectors: DataFrame, model: Whitening | None, vector_col: str = "embedding", carry: tuple[str, ...] = ("*",),
    components: int = COMPONENTS,
) -> DataFrame:
    """doc (struct of ``carry``), deviation and ``whitened``, an array of up to ``components`` coordinates.

    Rows that :func:`fit` leaves out are left out. A deviation too large for a BIGINT is null, and so
    is the coordinate of a component without variance. Without a model there are no rows.
    """
    source = vectors.select(F.struct(*carry).alias("doc"), F.col(vector_col).alias("vector"))
    schema = T.StructType([
        source.schema["doc"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType())),
    ])
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    centre = np.array(model.floor_mean, np.int64)
    width = min(components, model.size)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _usable(batch, 1).get(model.size, (None, None))
            if x is None:
                continue
            z = x - centre
            deviation = model.deviations(z)
            flat = model.project(z, width).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(deviation.data, mask=np.ma.getmaskarray(deviation)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.array(flat, mask=np.isnan(flat))
                    ),
                ],
                names=["doc", "deviation", "whitened"],
            )

    return source.mapInArrow(whiten, schema)


def identity_error(whitened: DataFrame, components: int) -> float | None:
    """Largest absolute entry of the whitened rows' covariance (divisor n) minus the identity.

    Measured on the rows themselves; components without variance do not count.
    """
    def entry(i: int, j: int) -> Column:
        a, b = (F.get("whitened", k) for k in (i, j))
        return F.abs(F.covar_pop(a, b) - (1.0 if i == j else 0.0)).alias(f"e_{i}_{j}")

    [row] = whitened.agg(*[entry(i, j) for i in range(components) for j in range(i, components)]).collect()
    return max((v for v in row if v is not None), default=None)


def whiten(
    vectors: DataFrame, vector_col: str = "embedding", carry: tuple[str, ...] = ("*",), components: int = COMPONENTS
) -> DataFrame:
    """One row per usable vector and component: doc, component, n, deviation, whitened, explained, identity_error."""
    model = fit(vectors, vector_col)
    rows = transform(vectors, model, vector_col, carry, components)
    if model is None:
        width, error, shares = 0, None, []
    else:
        rows = Stage(vectors.sparkSession, "whitened").write(rows)
        width = min(components, model.size)
        error = identity_error(rows, width)
        shares = [v / model.trace if model.trace > 0 else None for v in model.values[:width].tolist()]
    share = F.array(*[F.lit(s).cast("double") for s in shares]).cast("array<double>")
    return rows.select("doc", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "doc", (F.col("place") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation",
        "whitened", F.get(share, F.col("place")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
