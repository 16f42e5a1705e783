"""Embedding whitening by Chebyshev-filtered subspace iteration.

The covariance V of the vectors is never formed. A pass multiplies it with a block Q of a few dozen columns: every
task centres its rows, takes XᵀXQ of them, and hands on one small matrix. The polynomial recurrence of Chebyshev
turns a number of such passes into a filter that damps the lower part of the spectrum and lets the wanted end
grow; QR makes the block orthonormal again, Rayleigh-Ritz reads the eigenpairs off it. Sweeps go on until the
residuals of all wanted pairs are at the level of rounding. A few columns are drawn anew in every sweep, so that a
direction which the start has missed comes in.

Vectors become integers by `floor(scale * part) + offset`, whose sums are exact. Rows are centred by an integer
pivot first and then by the rest of the mean, so that a large offset costs no digits.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assortment.sources.lineage import cut

COMPONENTS = 32
SCALE = 64
OFFSET = 1_000_000
#: Passes per sweep, columns beyond the wanted ones, those drawn anew, and the most sweeps.
DEGREE = 10
FRESH = 2
SWEEPS = 60
#: Residuals relative to the largest eigenvalue: where the sweeps stop, and the most that is certified.
AIM = 4e-15
CERTIFIED = 1e-10
#: Tasks that add up what the tasks of a pass hand on; the driver adds as many matrices.
ADDERS = 16
#: Rows that a task works on at a time.
SLICE = 2048
#: Eigenvalues below this share of the largest are zero but for rounding.
NOTHING = 1e-11


@dataclass
class Whitening:
    """Number and sums of the vectors, components as columns of `axes` with their variances, and how exact they are."""

    n: int = 0
    sums: list[int] = field(default_factory=list)
    trace: float = 0.0
    values: np.ndarray = field(default_factory=lambda: np.empty(0))
    axes: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    residual: float = 0.0
    identity_error: float = 0.0
    passes: int = 0

    @property
    def pivot(self) -> np.ndarray:
        """The means as whole numbers, rounded down."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the means have beyond `pivot`."""
        return np.array([s % self.n / self.n for s in self.sums])


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite part."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def integer_rows(vectors: DataFrame, key: str, column: str, scale: int, offset: int) -> DataFrame:
    """(key, x) of the usable vectors, written once; a shorter vector counts as one with zeros at its end."""
    own = vectors.select(F.col(key).alias("key"), F.col(column).cast("array<double>").alias("v")).where(usable(F.col("v")))
    whole = F.transform("v", lambda v: F.floor(v * scale) + F.lit(offset).cast("long"))
    rows = cut(own.select("key", whole.alias("x")))
    sizes = rows.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if sizes.least == sizes.most:
        return rows
    zeros = F.array_repeat(F.lit(offset).cast("long"), F.lit(sizes.most) - F.size("x"))
    return rows.withColumn("x", F.concat("x", zeros))


def _matrix(batch) -> np.ndarray:
    column = batch.column("x")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (batch.slice(start, SLICE) for start in range(0, len(batch), SLICE))


def _added(rows: DataFrame, work: Callable[[np.ndarray], np.ndarray], dtype) -> np.ndarray | None:
    """The sum of `work(matrix)` over all rows; None without rows. The driver receives ADDERS arrays at most."""

    def add(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in parts:
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return add(work(_matrix(part)) for batch in batches for part in _slices(batch))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return add(np.frombuffer(value.as_py(), dtype) for batch in batches for value in batch.column(0))

    found = rows.select("x").mapInArrow(first, "sums binary").repartition(ADDERS).mapInArrow(again, "sums binary").collect()
    return sum(np.frombuffer(row.sums, dtype) for row in found) if found else None


def _count_and_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Exact: tasks add 64-bit numbers, in two halves so that they hold for any number of rows."""
    low = (1 << 24) - 1

    def work(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], (x >> 24).sum(0), (x & low).sum(0)])

    found = _added(rows, work, np.int64)
    if found is None:
        return 0, []
    n, d = int(found[0]), (len(found) - 1) // 2
    return n, [(int(a) << 24) + int(b) for a, b in zip(found[1:d + 1], found[d + 1:])]


class _Covariance:
    """Products of the covariance with a block, a pass over the rows each."""

    def __init__(self, rows: DataFrame, model: Whitening):
        self.rows, self.n, self.pivot, self.rest, self.passes = rows, model.n, model.pivot, model.rest, 0

    def __call__(self, block: np.ndarray) -> np.ndarray:
        pivot, rest = self.pivot, self.rest

        def work(x: np.ndarray) -> np.ndarray:
            centred = (x - pivot) - rest
            return (centred.T @ (centred @ block)).ravel()

        self.passes += 1
        return _added(self.rows, work, np.float64).reshape(block.shape) / self.n

    def trace(self) -> float:
        pivot, rest = self.pivot, self.rest
        return float(_added(self.rows, lambda x: np.array([np.square((x - pivot) - rest).sum()]), np.float64)[0]) / self.n


def _filtered(product, block: np.ndarray, first: np.ndarray, low: float, bound: float, top: float) -> np.ndarray:
    """Chebyshev polynomial of V, of degree DEGREE, applied to `block`: small on the eigenvalues low..bound, steep
    above, scaled to 1 at `top`. `first` is V times `block`."""
    half, centre = (bound - low) / 2, (bound + low) / 2
    sigma = half / (top - centre)
    twice = 2 / sigma
    before, now = block, (first - centre * block) * (sigma / half)
    for _ in range(DEGREE - 1):
        following = 1 / (twice - sigma)
        before, now = now, (product(now) - centre * now) * (2 * following / half) - sigma * following * before
        sigma = following
    return now


def _low_end(values: np.ndarray, d: int, trace: float, bound: float) -> float:
    """Where the lower spectrum about begins: the trace gives the mean of the eigenvalues that the block has not, and
    they spread below it about as they do above. Only the speed of the filter hangs on it."""
    mean = (trace - float(values.sum())) / (d - len(values))
    return max(0.0, 3 * mean - 2 * bound)


def _pairs(product, d: int, wanted: int, trace: float) -> tuple[np.ndarray, np.ndarray, float]:
    """The `wanted` largest eigenvalues, falling, their vectors as columns, and the largest residual."""
    rng = np.random.default_rng(0)
    width = min(d, wanted + max(8, wanted // 2))
    block = np.linalg.qr(rng.standard_normal((d, width)))[0]
    least = np.inf
    for _ in range(SWEEPS):
        moved = product(block)
        small = block.T @ moved
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, moved = block @ turn, moved @ turn
        residual = float(np.linalg.norm(moved - block * values, axis=0)[:wanted].max())
        top = max(float(values[0]), 0.0)
        still = residual >= least / 2
        least = min(least, residual)
        if residual <= AIM * top or (still and residual <= CERTIFIED * top):
            return values[:wanted], block[:, :wanted], residual
        if width < d:
            bound = max(float(values[-1 - FRESH]), 1e-6 * top)
            block = _filtered(product, block, moved, min(_low_end(values, d, trace, bound), 0.95 * bound), bound, top)
            block[:, width - FRESH:] = rng.standard_normal((d, FRESH))
        block = np.linalg.qr(np.linalg.qr(block)[0])[0]
    raise ArithmeticError(f"components not certified: residual {least} of {top}")


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Components of the (key, x) rows of `integer_rows`: at most `components`, and none without variance."""
    n, sums = _count_and_sums(rows)
    model = Whitening(n, sums)
    if not n or not sums:
        return model
    product = _Covariance(rows, model)
    model.trace = product.trace()
    if model.trace <= 0:
        return model
    values, axes, model.residual = _pairs(product, len(sums), min(components, len(sums)), model.trace)
    kept = values > NOTHING * values[0]
    model.values, model.axes, model.passes = values[kept], axes[:, kept], product.passes
    model.identity_error = _identity_error(rows, model)
    return model


def _projected(model: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    pivot, rest, turn = model.pivot, model.rest, model.axes / np.sqrt(model.values)
    return lambda x: ((x - pivot) - rest) @ turn


def _identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened rows minus the identity; measured, in one more pass."""
    white, k = _projected(model), len(model.values)

    def work(x: np.ndarray) -> np.ndarray:
        w = white(x)
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    found = _added(rows, work, np.float64) / model.n
    mean, second = found[:k], found[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(model: Whitening) -> Callable[[np.ndarray], pa.Array]:
    """Per row the sum of (n*x - S)^2 as decimal(38); exact, by 64-bit numbers where they hold it. More digits fail."""
    n, pivot, over = model.n, model.pivot, [s % model.n for s in model.sums]
    over64 = np.array(over, np.int64)
    kind = pa.decimal128(38, 0)

    def of(x: np.ndarray) -> pa.Array:
        near = x - pivot
        widest = int(np.abs(near).max(initial=0)) * n + n
        if widest * widest * len(over) < 1 << 62:
            return pa.array(np.square(near * n - over64).sum(1)).cast(kind)
        exact = [sum((int(v) * n - o) ** 2 for v, o in zip(row, over)) for row in near]
        return pa.array(exact, kind)

    return of


def applied(rows: DataFrame, model: Whitening) -> DataFrame:
    """(key, component, deviation, whitened, explained) per row and component, numbered from 1."""
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, component int, deviation decimal(38,0), whitened double, explained double"
    k = len(model.values)
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    white, deviation, share = _projected(model), _deviations(model), model.values / model.trace
    names = ["key", "component", "deviation", "whitened", "explained"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole):
                x, each = _matrix(batch), pa.array(np.repeat(np.arange(len(batch)), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column("key").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(batch))),
                    deviation(x).take(each), pa.array(white(x).ravel()), pa.array(np.tile(share, len(batch))),
                ], names)

    return rows.mapInArrow(work, schema)


def whitened(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS,
    scale: int = SCALE, offset: int = OFFSET,
) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) per usable vector and component.

    Rows with a null vector or a null or non-finite part are left out; a null key stays. Repeated rows count as
    often as they appear. Shorter vectors are filled up with zeros. Parts times `scale` have to fit into 48 bits.
    Components without variance (fewer vectors than components, constant parts) are left out, so one vector, equal
    vectors, empty vectors and an empty table give no rows. Other columns are not read.
    """
    rows = integer_rows(vectors, key, column, scale, offset)
    model = fit(rows, components)
    return applied(rows, model).select(
        F.col("key").alias(key), "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(model.identity_error).alias("identity_error"),
    )
