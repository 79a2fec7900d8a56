"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Spark does the work that grows with the rows: exact integer sums, then the exact integer scatter of the vectors less
their rounded mean (so products are small), then the projections and their moments. Each task adds up its own rows and
passes on one number for each cell. What reaches the driver has the size of the covariance, dimensions squared.

There, the scatter A is factored as L L' with the largest remaining diagonal entry as the next pivot; this stops where
nothing but rounding is left, which is the rank. Jacobi rotations then make the columns of L orthogonal without ever
forming A again: L J = U D. The squared column norms are the eigenvalues of A, and the normalised columns its
eigenvectors, to high relative accuracy, the small ones too.

Defined results: null vectors and those that hold null or non-finite components are dropped; a shorter vector counts as
padded with zeros; every other row counts, repeated rows and null ids too; other columns are ignored. Components whose
eigenvalue is zero do not exist: equal vectors, a single one, or an empty table give no rows. Equal eigenvalues come in
any order. A component too large for a long is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import bounded_batches, stored, table
from shelfcast.llm.vectors import largest, matrix, scaled_vectors

SCALE, OFFSET, COMPONENTS = 1024.0, 100_000, 8
#: Sums of products stay below this in 64 bits; beyond, Python's integers are used.
EXACT = 1 << 62
SWEEPS = 60
#: Partial sums are written as whole numbers split into high and low parts of this size.
PART = 1 << 40


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b in whole numbers, as Python integers where 64 bits might not do."""
    if largest(a) * largest(b) * max(1, len(a)) < EXACT:
        return a.T @ b
    return a.T.astype(object) @ b.astype(object)


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L (d, rank) and the order of rows with a[order][:, order] = L L'; L is lower triangular in that order."""
    d = len(a)
    left = a.astype(np.float64).copy()
    order = np.arange(d)
    factor = np.zeros((d, d))
    limit = d * np.finfo(np.float64).eps * max(left.diagonal().max(initial=0.0), 0.0)
    rank = 0
    for k in range(d):
        p = k + int(left.diagonal()[k:].argmax())
        if left[p, p] <= limit:
            break
        left[[k, p]] = left[[p, k]]
        left[:, [k, p]] = left[:, [p, k]]
        factor[[k, p]] = factor[[p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(left[k, k])
        factor[k + 1 :, k] = left[k + 1 :, k] / factor[k, k]
        left[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
        rank += 1
    return factor[:, :rank], order


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared norms, falling, and unit columns of factor @ J, where J is orthogonal and makes columns orthogonal."""
    u = factor.copy()
    n = u.shape[1]
    small = np.finfo(np.float64).eps * np.sqrt(max(len(u), 1))
    for _ in range(SWEEPS):
        turned = False
        for i in range(n - 1):
            for j in range(i + 1, n):
                a, b, c = u[:, i] @ u[:, i], u[:, j] @ u[:, j], u[:, i] @ u[:, j]
                if abs(c) <= small * np.sqrt(a * b):
                    continue
                turned = True
                zeta = (b - a) / (2 * c)
                t = (1.0 if zeta >= 0 else -1.0) / (abs(zeta) + np.hypot(1.0, zeta))
                cos = 1 / np.hypot(1.0, t)
                sin = cos * t
                u[:, i], u[:, j] = cos * u[:, i] - sin * u[:, j], sin * u[:, i] + cos * u[:, j]
        if not turned:
            break
    norms = np.sqrt((u * u).sum(axis=0))
    falling = np.argsort(-norms, kind="stable")
    return norms[falling] ** 2, u[:, falling] / norms[falling]


@dataclass(frozen=True)
class Whitening:
    """What ``fit_whitening`` learns: n vectors, their sums, the rounded mean, eigenvalues and components (d, rank)."""

    n: int
    sums: tuple[int, ...]
    middle: np.ndarray
    trace: float
    values: np.ndarray
    components: np.ndarray

    @property
    def width(self) -> int:
        return len(self.sums)

    def rest(self) -> list[int]:
        """sums - n * middle: what the rounded mean leaves, exactly."""
        return [s - self.n * m for s, m in zip(self.sums, self.middle.tolist())]

    def project(self, rows: np.ndarray, count: int) -> np.ndarray:
        """(rows, count): centred rows on the components, over the square roots of the eigenvalues."""
        centred = (rows - self.middle).astype(np.float64) - np.array([r / self.n for r in self.rest()])
        return centred @ (self.components[:, :count] / np.sqrt(self.values[:count]))

    def deviation(self, rows: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exactly."""
        rest = self.rest()
        low = rows - self.middle
        if (self.n * largest(low) + max(map(abs, rest), default=0)) ** 2 * max(1, self.width) < EXACT:
            away = self.n * low - np.array(rest, np.int64)
            return (away * away).sum(axis=1).tolist()
        return [sum((self.n * int(x) - r) ** 2 for x, r in zip(row, rest)) for row in low.tolist()]


def cell_sums(frame: DataFrame, width: int, pad: int, sums_of: Callable[[np.ndarray], list]) -> dict[int, int]:
    """Whole numbers that ``sums_of`` a batch's rows gives, added up over all rows, by place.

    A task passes on one row for each place; each number travels as two parts that add up without overflow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = np.array(sums_of(matrix(batch.column("v"), width, pad)), object)
            total = part if total is None else total + part
        if total is not None:
            high = [int(t) // PART for t in total]
            low = [int(t) % PART for t in total]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64())],
                ["place", "high", "low"],
            )

    parts = frame.select("v").mapInArrow(run, "place bigint, high bigint, low bigint")
    added = parts.groupBy("place").agg(
        F.sum(F.col("high").cast("decimal(28,0)")).alias("high"), F.sum(F.col("low").cast("decimal(28,0)")).alias("low")
    )
    return {r["place"]: int(r["high"]) * PART + int(r["low"]) for r in added.collect()}  # width squared at most


def fit_whitening(vectors: DataFrame, offset: int = OFFSET) -> Whitening | None:
    """Learn from every row of ``vectors`` (v array<bigint>); None where there is none."""
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = size["n"], size["width"] or 0
    if not n or not width:
        return None
    found = cell_sums(vectors, width, offset, lambda rows: exact_products(np.ones((len(rows), 1), np.int64), rows)[0])
    sums = tuple(found[i] for i in range(width))
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    upper = np.triu_indices(width)
    products = cell_sums(
        vectors, width, offset, lambda rows: exact_products(rows - middle, rows - middle)[upper].astype(object)
    )
    rest = [s - n * m for s, m in zip(sums, middle.tolist())]
    scatter = np.zeros((width, width))
    for place, (i, j) in enumerate(zip(*map(np.ndarray.tolist, upper))):
        # Exact in whole numbers; rounded once.
        scatter[i, j] = scatter[j, i] = (n * products[place] - rest[i] * rest[j]) / n
    factor, order = pivoted_cholesky(scatter)
    squares, columns = one_sided_jacobi(factor)
    components = np.zeros_like(columns)
    components[order] = columns
    return Whitening(n, sums, middle, float(scatter.trace()) / n, squares / n, components)


def identity_error(vectors: DataFrame, model: Whitening, count: int, offset: int = OFFSET) -> float:
    """Largest absolute entry of the covariance of the projections of all rows, less the identity."""
    width = model.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(count), np.zeros((count, count))
        for batch in batches:
            white = model.project(matrix(batch.column("v"), width, offset), count)
            first += white.sum(axis=0)
            second += white.T @ white
        values = np.concatenate([first, second.ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(values)), pa.int64()), pa.array(values, pa.float64())], ["place", "value"]
        )

    parts = vectors.select("v").mapInArrow(run, "place bigint, value double")
    rows = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    found = np.zeros(count + count * count)
    for r in rows:
        found[r["place"]] = r["value"] / model.n
    mean = found[:count]
    return float(np.abs(found[count:].reshape(count, count) - np.outer(mean, mean) - np.eye(count)).max())


def whiten(
    df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS,
    scale: float = SCALE, offset: int = OFFSET,
) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error for each usable row and component."""
    source = scaled_vectors(df, vector_column, scale, {"id": F.col(f"`{id_column}`")}, offset=offset)
    vectors = stored(source, "whiten-vectors")
    kind = vectors.schema["id"].dataType.simpleString()
    schema = f"`{id_column}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double"
    model = fit_whitening(vectors, offset)
    count = 0 if model is None else min(components, len(model.values))
    error = identity_error(vectors, model, count, offset) if count else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [id_column, "component", "n", "deviation", "whitened", "explained"]
        for batch in batches:
            if not count or not batch.num_rows:
                continue
            rows = matrix(batch.column("v"), model.width, offset)
            which = np.repeat(np.arange(len(rows)), count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(which)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(which), model.n, np.int64)),
                    pa.array(model.deviation(rows), pa.int64()).take(pa.array(which)),
                    pa.array(model.project(rows, count).ravel()),
                    pa.array(np.tile(model.values[:count] / model.trace, len(rows))),
                ],
                names,
            )

    return vectors.mapInArrow(run, schema).withColumn("identity_error", F.lit(error))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return whiten(table(spark, sf_dir, "embeddings"))
