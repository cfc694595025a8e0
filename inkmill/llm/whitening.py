"""Whitening of embeddings with components from FEAST contour integration.

Spark reduces the vectors to their covariance: the distinct quantised vectors (the fit list) are
written, then their exact sums and the centred products are added up per task, and per entry
across tasks. What comes to the driver is one symmetric matrix of the vectors' dimension, whatever
the number of rows. The rows are then projected in one narrow pass.

``feast`` takes the largest eigenpairs of that matrix. Inertia counts (signs of the pivots of a
symmetric factorisation of V - s I) tell how many eigenvalues lie above any s; bisection cuts the
spectrum from the top into intervals with few eigenvalues each, at points with none near. On each
interval a contour around it is integrated by Gauss-Legendre quadrature: solves with the complex
shifted matrix z I - V project a random block onto the interval's eigenspace. A Rayleigh-Ritz step
extracts the pairs, and projection is repeated until residuals are at rounding. An interval is
done when the pairs found inside it are as many as its inertia says, so none is missed.

Defined cases: a vector that is null or empty, or that holds null or non-finite entries, takes no
part and has no row. If lengths differ, the length of most distinct vectors counts (ties: the
longer) and others take no part. Repeated vectors count once in the fit list, but each row gets
its own result. Components of (numerically) no variance cannot be scaled to one and are not
returned, so constant vectors and a fit list of one give no rows. Equal eigenvalues give any
orthonormal base of their space, the same for all rows. Entries beyond a long after scaling are
held at its ends. A deviation beyond a long is null. Other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm.worker import small_batches
from inkmill.staging import spread, stage

LEVELS = 256
NODES = 12  # quadrature nodes on the upper half of a contour
CROWD = 8  # eigenvalues of an interval that is not cut further
ROUNDS = 30
NO_VARIANCE = 1e-12  # of the trace
_LONG = 2**63 - 1
_SAFE = 2**62


def quantised(vector: str) -> Column:
    """Floor of 256 times each entry, as longs; null for a vector that takes no part."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * LEVELS).cast("long"))
    return F.when(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite, whole)


@dataclass
class Moments:
    """Size, exact sums per dimension and covariance of the fit list."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    largest: int  # absolute entry

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def rows_of(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The batch's vectors as a matrix."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each distinct x once, all lengths; a written table."""
    return stage(vectors.where("x IS NOT NULL").select("x").distinct(), "fit-list")


def added_up(parts: DataFrame) -> list:
    """Sums of the arrays ``values`` of doubles, entry by entry: one row per entry."""
    entries = parts.select(F.posexplode("values").alias("at", "value"))
    return entries.groupBy("at").agg(F.sum("value").alias("value")).collect()


def moments(fitted: DataFrame) -> Moments | None:
    """Moments of the fit list's most frequent length; None if it is empty."""
    lengths = fitted.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).collect()
    if not lengths:
        return None
    n, dim = max((r["n"], r["dim"]) for r in lengths)
    same = fitted.where(F.size("x") == dim)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, largest = [0] * dim, 0
        for batch in batches:
            x = rows_of(batch, dim)
            if not len(x):
                continue
            most = max(int(x.max()), -int(x.min()))
            largest = max(largest, most)
            exact = x if most < _SAFE // len(x) else x.astype(object)
            sums = [a + int(b) for a, b in zip(sums, exact.sum(axis=0))]
        columns = [pa.array(range(dim + 1), pa.int32()), pa.array([str(v) for v in [*sums, largest]])]
        yield pa.record_batch(columns, ["at", "value"])

    exact = same.mapInArrow(totals, "at int, value string")
    number = F.col("value").cast("decimal(38,0)")
    found = exact.groupBy("at").agg(F.sum(number).alias("total"), F.max(number).alias("most")).collect()
    by_place = {r["at"]: r for r in found}
    sums = [int(by_place[i]["total"]) for i in range(dim)]
    mean = np.array([s / n for s in sums])
    upper = np.triu_indices(dim)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            centred = rows_of(batch, dim) - mean
            total += centred.T @ centred
        values = pa.array([total[upper]], pa.list_(pa.float64()))
        yield pa.record_batch([values], ["values"])

    covariance = np.zeros((dim, dim))
    for row in added_up(same.mapInArrow(products, "values array<double>")):
        i, j = upper[0][row["at"]], upper[1][row["at"]]
        covariance[i, j] = covariance[j, i] = row["value"] / n
    return Moments(n, sums, covariance, int(by_place[dim]["most"]))


def above(matrix: np.ndarray, shift: float) -> tuple[int, float]:
    """How many eigenvalues exceed ``shift``, and the least pivot: how near one of them is.

    The inertia of the shifted matrix, from its symmetric factorisation with pivots of one or
    two rows, the largest entries first (which bounds the growth of the rest).
    """
    rest = matrix - shift * np.eye(len(matrix))
    positive, least = 0, math.inf
    keep = (1 + math.sqrt(17)) / 8
    while len(rest):
        diagonal = np.abs(np.diag(rest))
        d = int(np.argmax(diagonal))
        off = np.abs(rest - np.diag(np.diag(rest)))
        p, q = divmod(int(np.argmax(off)), len(rest))
        pivots = [d] if diagonal[d] >= keep * off[p, q] else [p, q]
        others = np.setdiff1d(np.arange(len(rest)), pivots)
        block = rest[np.ix_(pivots, pivots)]
        if len(pivots) == 1:
            values = block[0]
        else:  # off-diagonal dominates: one eigenvalue of each sign
            middle, half = (block[0, 0] + block[1, 1]) / 2, (block[0, 0] - block[1, 1]) / 2
            reach = math.hypot(half, block[0, 1])
            values = np.array([middle - reach, middle + reach])
        positive += int((values > 0).sum())
        least = min(least, float(np.abs(values).min()))
        if least == 0:
            return positive, 0.0
        side = rest[np.ix_(others, pivots)]
        rest = rest[np.ix_(others, others)] - side @ np.linalg.solve(block, side.T)
    return positive, least


def clear_cut(matrix: np.ndarray, low: float, high: float) -> tuple[float, int]:
    """A shift near the middle of an interval, away from eigenvalues, and the count above it."""
    tries = [low + (high - low) * share for share in (0.5, 0.4375, 0.5625, 0.375, 0.625)]
    counted = [(above(matrix, s), s) for s in tries]
    (count, _), shift = max(counted, key=lambda c: c[0][1])
    return shift, count


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside) from the top, with ``wanted`` eigenvalues at least."""
    size = float(np.abs(matrix).sum(axis=1).max())  # bounds the spectrum
    pad = size * 1e-3 or 1.0
    waiting = [(-size - pad, size + pad, len(matrix), 0)]
    found: list[tuple[float, float, int]] = []
    while waiting and sum(c for _, _, c in found) < wanted:
        low, high, up_to_low, up_to_high = waiting.pop()
        inside = up_to_low - up_to_high
        if not inside:
            continue
        if inside <= CROWD and high - low <= 0.25 * max(abs(low), abs(high)) or high - low < 1e-9 * size:
            found.append((low, high, inside))
            continue
        cut, count = clear_cut(matrix, low, high)
        waiting.append((low, cut, up_to_low, count))
        waiting.append((cut, high, count, up_to_high))
    return found


def interval_pairs(matrix: np.ndarray, low: float, high: float, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``inside`` eigenpairs of an interval, by repeated projection and Rayleigh-Ritz."""
    dim = len(matrix)
    middle, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    angles = math.pi * (points + 1) / 2  # the upper half; the lower one is its mirror image
    size = float(np.abs(matrix).sum(axis=1).max())
    block = min(dim, 2 * inside + 4)
    rng = np.random.default_rng(41)
    base = rng.standard_normal((dim, block))
    for _ in range(ROUNDS):
        projected = np.zeros_like(base)
        for angle, weight in zip(angles, weights):
            turn = complex(math.cos(angle), math.sin(angle))
            shifted = (middle + radius * turn) * np.eye(dim) - matrix
            projected += (weight * radius / 2) * (turn * np.linalg.solve(shifted, base)).real
        base, strength, _ = np.linalg.svd(projected, full_matrices=False)
        base = base[:, strength > 1e-13 * strength[0]]
        values, turned = np.linalg.eigh(base.T @ matrix @ base)
        vectors = base @ turned
        residual = np.linalg.norm(matrix @ vectors - vectors * values, axis=0)
        good = (values > low) & (values < high) & (residual <= 1e-13 * size * math.sqrt(dim))
        if good.sum() == inside:
            return values[good], vectors[:, good]
        base = vectors
        if base.shape[1] < block:  # directions lost in rounding are drawn anew
            base = np.concatenate([base, rng.standard_normal((dim, block - base.shape[1]))], axis=1)
    raise RuntimeError(f"{int(good.sum())} eigenpairs of {inside} found between {low} and {high}")


def feast(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``wanted`` eigenvalues, falling, and their unit vectors as columns."""
    pairs = [interval_pairs(matrix, *found) for found in intervals(matrix, min(wanted, len(matrix)))]
    values = np.concatenate([v for v, _ in pairs])
    vectors = np.concatenate([v for _, v in pairs], axis=1)
    order = np.argsort(-values, kind="stable")[:wanted]
    # Vectors of neighbouring intervals are orthogonal to rounding; one step makes them so exactly.
    base, turned = np.linalg.qr(vectors[:, order])
    return values[order], base * np.sign(np.diag(turned))


@dataclass
class Whitening:
    """Projection of the fit list's x onto components of unit variance."""

    n: int
    sums: list[int]
    mean: np.ndarray
    projection: np.ndarray  # [dimension, component]
    explained: np.ndarray
    largest: int

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.projection

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2; None beyond a long."""
        reach = self.n * self.largest + max(map(abs, self.sums))
        if reach * reach * x.shape[1] < _SAFE:
            return ((x * self.n - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        apart = x.astype(object) * self.n - np.array(self.sums, object)
        return [v if v <= _LONG else None for v in (apart * apart).sum(axis=1)]


def fit(found: Moments, components: int) -> Whitening:
    trace = float(np.trace(found.covariance))
    dim = len(found.sums)
    if trace <= 0:
        return Whitening(found.n, found.sums, found.mean, np.zeros((dim, 0)), np.zeros(0), found.largest)
    scaled = found.covariance / trace  # the solver's bounds are relative, its shifts near one
    values, vectors = feast(scaled, components)
    used = values > NO_VARIANCE
    values, vectors = values[used], vectors[:, used]
    projection = vectors / np.sqrt(values * trace)
    return Whitening(found.n, found.sums, found.mean, projection, values, found.largest)


def identity_error(fitted: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    dim, k = model.projection.shape
    if not k:
        return 0.0
    n, parts = model.n, vars(model)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Whitening(**parts)
        total, square = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.whitened(rows_of(batch, dim))
            total += w.sum(axis=0)
            square += w.T @ w
        values = pa.array([np.concatenate([total, square.ravel()])], pa.list_(pa.float64()))
        yield pa.record_batch([values], ["values"])

    same = fitted.where(F.size("x") == dim)
    flat = np.zeros(k + k * k)
    for row in added_up(same.mapInArrow(products, "values array<double>")):
        flat[row["at"]] = row["value"] / n
    # x is centred before it is projected; what rounding left of the mean goes, too.
    covariance = flat[k:].reshape(k, k) - np.outer(flat[:k], flat[:k])
    return float(np.abs(covariance - np.eye(k)).max())


SCHEMA = (
    "{id} long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def whiten(vectors: DataFrame, components: int, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for each vector that takes part and each of its components, numbered from 1."""
    spark = vectors.sparkSession
    small_batches(spark)
    x = spread(vectors.select(id_col, vector)).select(F.col(id_col).cast("long").alias(id_col), quantised(vector).alias("x"))
    schema = SCHEMA.format(id=id_col)
    fitted = fit_list(x)
    found = moments(fitted)
    if found is None:
        return spark.createDataFrame([], schema)
    model = fit(found, components)
    error = identity_error(fitted, model)
    dim, k = model.projection.shape
    shared = spark.sparkContext.broadcast(vars(model))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Whitening(**shared.value)
        for batch in batches:
            matrix = rows_of(batch, dim)
            rows = len(matrix)
            deviation = pa.array(model.deviations(matrix), pa.int64())
            at = pa.array(np.repeat(np.arange(rows), k))
            columns = [
                batch.column(0).take(at),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.n)),
                deviation.take(at),
                pa.array(model.whitened(matrix).ravel()),
                pa.array(np.tile(model.explained, rows)),
                pa.array(np.full(rows * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return x.where(F.size("x") == dim).mapInArrow(project, schema)
