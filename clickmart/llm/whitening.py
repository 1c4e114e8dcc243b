"""Embedding whitening, the components found by spectrum slicing.

An entry c becomes the whole number x = floor(64 c) + 1000000.  The fit list is each distinct
vector once: n of them, sums S, covariance V = mean of (x - S/n)(x - S/n)'.

1. Tasks add up S exactly, then the products of the centred entries; one row per entry of S and V
   (dimensions squared, whatever the rows) comes to the driver.
2. Spectrum slicing.  V - s I = L D L' with symmetric pivoting, and by Sylvester's law the
   negative eigenvalues of D (blocks of one and two) count V's eigenvalues under s.  Bisection
   with these counts isolates each of the leading eigenvalues, largest first.
3. Rayleigh quotient iteration from the middle of the isolating interval converges cubically to
   the eigenvector, orthogonal to those already found; a quotient that leaves the interval
   halves it and starts again.  Eigenvalues that agree to double precision share an interval,
   and their vectors are some orthonormal basis.
4. Two more counts, just under and over the quotient, certify that it has its number.
5. Every remaining row is projected in the tasks; the covariance of the whitened fit list is
   measured, not assumed.

Defined cases: rows whose vector is null or empty or holds a null, NaN or infinite entry are
dropped; vectors of several lengths are an error; repeated rows and vectors keep their rows and
count once for the fit; null ids stay; components beyond the rank (variance up to 1e-12 of the
trace) don't exist, so a table with one distinct vector has no rows, nor has an empty one; a
deviation beyond a long is null; only id and vector are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import materialise

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Share of the trace up to which a variance counts as none.
NO_VARIANCE = 1e-12

_EPS = float(np.finfo(np.float64).eps)
_PIVOT = (1 + 17**0.5) / 8


# ---- spectrum slicing
def count_below(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix under ``shift``: the negative ones of D in an LDL'
    factorisation of the shifted matrix (complete pivoting, blocks of one or two)."""
    a = matrix - shift * np.eye(len(matrix))
    below = 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        off = np.abs(a)
        np.fill_diagonal(off, 0)
        p, (r, s) = int(diagonal.argmax()), np.unravel_index(off.argmax(), off.shape)
        largest = off[r, s]
        if max(diagonal[p], largest) <= np.finfo(float).tiny:
            break  # what is left has eigenvalue zero
        chosen = [p] if diagonal[p] >= _PIVOT * largest else [int(r), int(s)]
        rest = np.delete(np.arange(len(a)), chosen)
        pivot, side = a[np.ix_(chosen, chosen)], a[np.ix_(rest, chosen)]
        # a block of two has eigenvalues of both signs
        below += int(pivot[0, 0] < 0) if len(chosen) == 1 else 1
        a = a[np.ix_(rest, rest)] - side @ np.linalg.inv(pivot) @ side.T
        a = (a + a.T) / 2
    return below


class Slices:
    """The leading eigenpairs of a covariance matrix, largest eigenvalue first."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        radius = np.abs(matrix).sum(axis=1) - np.abs(np.diagonal(matrix))
        low, high = float((np.diagonal(matrix) - radius).min()), float((np.diagonal(matrix) + radius).max())
        self.scale = max(abs(low), abs(high), np.finfo(float).tiny)
        self.counts = {low - self.scale * 1e-3: 0, high + self.scale * 1e-3: len(matrix)}
        self.tolerance = 16 * len(matrix) * _EPS * self.scale

    def below(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = count_below(self.matrix, shift)
        return self.counts[shift]

    def halve(self, place: int, low: float, high: float) -> tuple[float, float]:
        middle = (low + high) / 2
        return (middle, high) if self.below(middle) <= place else (low, middle)

    def isolate(self, place: int) -> tuple[float, float]:
        """An interval that holds the eigenvalue with ``place`` smaller ones and no other, or
        others that agree with it."""
        low = max(s for s, n in self.counts.items() if n <= place)
        high = min(s for s, n in self.counts.items() if n > place)
        while self.below(high) - self.below(low) > 1 and high - low > self.tolerance:
            low, high = self.halve(place, low, high)
        return low, high

    def eigenvector(self, low: float, high: float, known: np.ndarray) -> tuple[float, np.ndarray] | None:
        """By Rayleigh quotient iteration, orthogonal to ``known``; None where it leaves the interval."""
        d = len(self.matrix)
        x = np.random.default_rng(d + len(known)).standard_normal(d)
        quotient, residual = (low + high) / 2, np.inf
        for step in range(40):
            try:
                x = np.linalg.solve(self.matrix - quotient * np.eye(d), x)
            except np.linalg.LinAlgError:  # the quotient is an eigenvalue to the last bit
                x = np.linalg.solve(self.matrix - (quotient + self.scale * _EPS) * np.eye(d), x)
            for _ in range(2):
                x = x / np.abs(x).max()
                x -= known.T @ (known @ x)
                x /= np.linalg.norm(x)
            if step < 2:
                continue  # inverse iteration from the middle first
            found = float(x @ self.matrix @ x)
            if not low - self.tolerance <= found <= high + self.tolerance:
                return None
            left = float(np.linalg.norm(self.matrix @ x - found * x))
            if left <= 2 * _EPS * self.scale or left >= residual and left <= self.tolerance:
                return found, x
            quotient, residual = found, left
        return (quotient, x) if residual <= self.tolerance else None

    def leading(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(values, vectors as rows) of up to ``most`` components with variance."""
        d = len(self.matrix)
        trace = float(np.trace(self.matrix))
        values, vectors = [], np.empty((0, d))
        for k in range(min(most, d)):
            place = d - 1 - k
            if trace <= 0 or self.below(NO_VARIANCE * trace) > place:
                break  # by the count, no variance is left
            low, high = self.isolate(place)
            while (pair := self.eigenvector(low, high, vectors)) is None:
                if high - low <= self.tolerance / 4:
                    raise ArithmeticError(f"component {k + 1}: no eigenvector in its interval")
                low, high = self.halve(place, low, high)
            value, vector = pair
            if not self.below(value - 2 * self.tolerance) <= place < self.below(value + 2 * self.tolerance):
                raise ArithmeticError(f"component {k + 1}: the counts don't confirm its number")
            values.append(value)
            vectors = np.vstack([vectors, vector])
        return np.array(values), vectors


# ---- on Spark
def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(batch.num_rows, -1)


def _summed(products: Callable[[np.ndarray], np.ndarray]):
    """Per task, the sum of ``products`` of its batches, as rows (i, j, value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = products(_matrix(batch))
                total = own if total is None else total + own
        if total is not None:
            i, j = np.indices(total.shape).reshape(2, -1)
            yield pa.record_batch([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total.ravel())], names=["i", "j", "value"])

    return run


def _collected(fit: DataFrame, products, kind: str, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all tasks; as many rows come to the driver as it has entries."""
    by = fit.mapInArrow(_summed(products), f"i int, j int, value {kind}").groupBy("i", "j")
    value = F.sum(F.col("value").cast("decimal(38,0)") if kind == "long" else F.col("value"))
    out = np.zeros(shape, dtype=object if kind == "long" else float)
    for r in by.agg(value.alias("value")).collect():
        out[r["i"], r["j"]] = int(r["value"]) if kind == "long" else r["value"]
    return out


def _projected(n: int, sums: np.ndarray, axes: np.ndarray, explained: np.ndarray, error: float):
    k = len(axes)
    exact = np.array([int(s) for s in sums], dtype=object)
    narrow = max(map(abs, exact.tolist()), default=0) < 2**62

    def deviations(x: np.ndarray) -> pa.Array:
        about = ((x.astype(float) * n - exact.astype(float)) ** 2).sum(axis=1)
        if narrow and float(np.abs(x).max(initial=0)) * n < 2**62 and about.max(initial=0) < 2**62:
            return pa.array(((x * n - exact.astype(np.int64)) ** 2).sum(axis=1))
        whole = [sum((int(a) * n - s) ** 2 for a, s in zip(row, exact, strict=True)) for row in x.tolist()]
        return pa.array([w if w < 2**63 else None for w in whole], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            whitened = (x - exact.astype(float) / n) @ axes.T
            rows = len(x)
            at = pa.array(np.repeat(np.arange(rows), k))
            yield pa.record_batch(
                [
                    batch.column("vec_id").take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, np.int64)),
                    deviations(x).take(at),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per remaining row and component, see RESULT."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    rows = rows.filter("v IS NOT NULL AND size(v) > 0 AND NOT exists(v, c -> c IS NULL OR isnan(c) OR abs(c) = double('Infinity'))")
    # without OFFSET, which every difference loses
    rows = rows.select("vec_id", F.expr(f"transform(v, c -> CAST(floor(CAST(c AS DOUBLE) * {SCALE}) AS LONG))").alias("x"))
    seen = rows.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("d"), F.max(F.expr("greatest(abs(array_min(x)), abs(array_max(x)))")).alias("far")).first()
    empty = vectors.sparkSession.createDataFrame([], RESULT)
    if seen["d"] is None:
        return empty
    d = seen["d"]
    if seen["least"] != d:
        raise ValueError(f"vectors of {seen['least']} to {d} entries")
    if seen["far"] < 2**31:
        rows = rows.withColumn("x", F.col("x").cast("array<int>"))  # half the shuffle
    fit = materialise(rows.select("x").distinct(), "fit")
    n = fit.count()
    sums = _collected(fit, lambda x: x.sum(axis=0, keepdims=True), "long", (1, d))[0]
    mean = np.array([s / n for s in sums])

    def scatter(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return centred.T @ centred

    covariance = _collected(fit, scatter, "double", (d, d)) / n
    values, found = Slices((covariance + covariance.T) / 2).leading(most)
    if not len(values):
        return empty
    axes = found / np.sqrt(values)[:, None]

    def whitened(x: np.ndarray) -> np.ndarray:
        z = (x - mean) @ axes.T
        return np.vstack([z.T @ z, z.sum(axis=0, keepdims=True)])

    k = len(values)
    moments = _collected(fit, whitened, "double", (k + 1, k)) / n
    error = float(np.abs(moments[:k] - np.outer(moments[k], moments[k]) - np.eye(k)).max())
    return rows.mapInArrow(_projected(n, sums, axes, values / np.trace(covariance), error), RESULT)


def query(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
