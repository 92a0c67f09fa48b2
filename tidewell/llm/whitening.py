"""Embedding whitening with a polarised covariance.

Entries become whole numbers, so every sum is exact. For each dimension, and for each sum of two dimensions, the squared centred values are
added up; the covariance of i and j is half of what the variance of their sum exceeds the sum of their variances by. Values are
centred at m, the whole number below their mean, before they are squared; the rest of the mean, r / n with 0 <= r < n, is taken off
exactly: n^2 var = n * sum((x - m)^2) - r^2. The driver gets one number for each pair of dimensions and gives them to ``eigh``.

Four passes over narrow data: distinct vectors (checkpointed), their sums, their squares, the covariance of the whitened ones; then all rows.
Sums leave a task as one row per number, so what is shuffled and collected depends on the dimensions, not on the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut_lineage, own_name, table

#: A value c becomes floor(SCALE * c) + OFFSET. Results have that many components at most.
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: From here on a double can't tell whole numbers apart: larger entries count as not finite.
LARGEST = 2**52
#: Rows that are worked on at a time; lengths of vectors whose models a pass holds.
SLICE, LOT = 2048, 16
#: Squares are summed in two parts, of which neither leaves a decimal(38).
PART = 10**18
#: Eigenvalues below this share of the largest are rounding: such components have no direction.
LEAST = 1e-13


@dataclass
class Model:
    """The whitening of the vectors of one length."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # components as rows
    values: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    @property
    def floors(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    @property
    def rests(self) -> np.ndarray:
        return np.array([s % self.n / self.n for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows of long vectors on the components, with variance 1; not a number where a component has no variance."""
        centred = (x - self.floors).astype(np.float64) - self.rests
        with np.errstate(divide="ignore", invalid="ignore"):
            return centred @ self.vectors.T / np.where(self.values > 0, np.sqrt(np.maximum(self.values, 0)), np.nan)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n x - S)^2 over the dimensions of each row, exact; None if a long can't hold it."""
        y, rests = x - self.floors, np.array([s % self.n for s in self.sums], dtype=object)
        widest = max(int(np.abs(y).max(initial=0)) + 1, 1) * self.n
        if widest * widest * max(len(self.sums), 1) < 1 << 63:
            d = y * self.n - rests.astype(np.int64)
            return (d * d).sum(axis=1).tolist()
        d = y.astype(object) * self.n - rests
        return [int(v) if v < 1 << 63 else None for v in (d * d).sum(axis=1)]


def usable(embedding: Column) -> Column:
    """Whether a vector is there and all its entries are numbers that whole numbers can stand for."""
    number = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < LARGEST / SCALE)
    return embedding.isNotNull() & (F.size(embedding) > 0) & F.coalesce(F.forall(embedding, number), F.lit(False))


def whole(embedding: Column) -> Column:
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(OFFSET).cast("long"))


def _matrices(batch: pa.RecordBatch, at: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix of long) of a batch's vectors, by length."""
    for i in range(0, batch.num_rows, SLICE):
        column = batch.column(at).slice(i, SLICE)
        sizes = np.asarray(column.value_lengths())
        for d in np.unique(sizes):
            places = np.flatnonzero(sizes == d)
            taken = column if len(places) == len(column) else column.take(pa.array(places))
            yield places + i, taken.flatten().to_numpy(zero_copy_only=False).reshape(-1, int(d))


def totals(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """By length of vectors: how many there are, and their sums by dimension."""
    long = fit.select(F.size("x").alias("d"), F.posexplode("x").alias("i", "v"))
    rows = long.groupBy("d", "i").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(rows, key=lambda r: (r["d"], r["i"])):
        out.setdefault(r["d"], (r["n"], []))[1].append(int(r["s"]))
    return out


def squares_of_sums(y: np.ndarray) -> list[list[int]]:
    """For every i, the exact sums over rows of (y_i + y_j)^2 for j = i, i + 1, ...; y_i + y_i stands for y_i alone."""
    largest = int(np.abs(y).max(initial=0))
    y = y if 4 * largest * largest * max(len(y), 1) < 1 << 63 else y.astype(object)
    out = []
    for i in range(y.shape[1]):
        t = y[:, i:] + y[:, i : i + 1]
        t[:, 0] = y[:, i]
        out.append([int(v) for v in (t * t).sum(axis=0)])
    return out


def polarised_squares(fit: DataFrame, sums: dict[int, tuple[int, list[int]]]) -> DataFrame:
    """``d``, ``i``, ``j``, and ``high`` and ``low`` parts of the sum of squares of what the values of i (i = j) or of i and j together are above the means' floors."""
    floors = {d: np.array([s // n for s in by], dtype=np.int64) for d, (n, by) in sums.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[list[int]]] = {}
        for b in batches:
            for _, x in _matrices(b, 0):
                d = x.shape[1]
                if d in floors:
                    more = squares_of_sums(x - floors[d])
                    held[d] = [[p + q for p, q in zip(u, v, strict=True)] for u, v in zip(held[d], more, strict=True)] if d in held else more
        for d, found in held.items():
            rows = [(d, i, i + k, v // PART, v % PART) for i, r in enumerate(found) for k, v in enumerate(r)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32()] * 3 + [pa.int64()] * 2, strict=True)], names=["d", "i", "j", "high", "low"])

    parts = fit.filter(F.size("x").isin(list(floors))).select("x").mapInArrow(run, "d int, i int, j int, high bigint, low bigint")
    return parts.groupBy("d", "i", "j").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")])


def solve(n: int, sums: list[int], squares: dict[tuple[int, int], int]) -> Model:
    """Eigenvectors of the covariance that the variances of dimensions and of their sums give."""
    dims = len(sums)
    rest = [s % n for s in sums]
    var = [n * squares[i, i] - rest[i] ** 2 for i in range(dims)]  # n^2 times the variance
    v = np.empty((dims, dims))
    for i in range(dims):
        v[i, i] = var[i] / n**2
        for j in range(i + 1, dims):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            v[i, j] = v[j, i] = (both - var[i] - var[j]) / (2 * n**2)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:COMPONENTS]
    values, vectors = values[order], vectors[:, order].T
    trace = sum(var) / n**2
    values = np.where(values > LEAST * max(float(values.max(initial=0)), 0.0), values, 0.0)
    return Model(n, sums, np.ascontiguousarray(vectors), values, values / trace if trace else np.zeros(len(values)))


def identity_errors(fit: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """By length: how far the covariance of the whitened vectors is from the identity at most, over components that have variance.

    Whitened values are centred as they are made, exactly but for rounding, so their products are those of centred values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for _, x in _matrices(b, 0):
                d = x.shape[1]
                if d in models:
                    w = np.nan_to_num(models[d].whitened(x))
                    held[d] = held.get(d, 0) + w.T @ w
        for d, m in held.items():
            i, j = np.triu_indices(len(m))
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(i), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(m[i, j])], names=["d", "i", "j", "s"])

    rows = fit.filter(F.size("x").isin(list(models))).select("x").mapInArrow(run, "d int, i int, j int, s double").groupBy("d", "i", "j").agg(F.sum("s").alias("s")).collect()
    out = dict.fromkeys(models, 0.0)
    for r in rows:
        m = models[r["d"]]
        if m.values[r["i"]] > 0 and m.values[r["j"]] > 0:
            out[r["d"]] = max(out[r["d"]], abs(r["s"] / m.n - (r["i"] == r["j"])))
    return out


def fit_models(vectors: DataFrame, sums: dict[int, tuple[int, list[int]]] | None = None) -> dict[int, Model]:
    """The whitening of each length of vectors. ``vectors``: distinct ``x``."""
    sums = totals(vectors) if sums is None else sums
    squares: dict[int, dict[tuple[int, int], int]] = {d: {} for d in sums}
    for r in polarised_squares(vectors, sums).collect():  # a number for each pair of dimensions
        squares[r["d"]][r["i"], r["j"]] = int(r["high"]) * PART + int(r["low"])
    models = {d: solve(n, by, squares[d]) for d, (n, by) in sums.items()}
    for d, e in identity_errors(vectors, models).items():
        models[d].identity_error = e
    return models


def project(rows: DataFrame, key: str, x: str, models: dict[int, Model]) -> DataFrame:
    """One row per vector (column ``x``) and component; lengths without a model have no rows."""
    kind = rows.schema[key].dataType.simpleString()
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for places, matrix in _matrices(b, 1):
                m = models[matrix.shape[1]]
                k, size = len(m.values), len(matrix)
                again = np.repeat(np.arange(size), k)
                w = m.whitened(matrix).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array(places[again])), pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()), pa.array(np.full(size * k, m.n), pa.int64()),
                        pa.array(m.deviations(matrix), pa.int64()).take(pa.array(again)), pa.array(w, mask=np.isnan(w)), pa.array(np.tile(m.explained, size)), pa.array(np.full(size * k, m.identity_error)),
                    ],
                    names=names,
                )

    return rows.filter(F.size(x).isin(list(models))).select(key, x).mapInArrow(run, f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Whitened vectors, one row per vector and component (at most 16, by falling variance).

    Rows whose vector is null or empty, holds a null or an entry that isn't finite (or is so large that whole numbers can't stand for it) are left
    out. Vectors of each length are whitened on their own. Components without variance (constant vectors, fewer distinct vectors than dimensions) have
    null ``whitened`` and 0 ``explained``; ``deviation`` is null where a long can't hold it. Repeated vectors count once in the fit and have rows
    each; null and repeated keys are kept; an empty table gives an empty table; other columns are not carried.
    """
    name = own_name(vectors.select(key), "x")
    rows = vectors.filter(usable(F.col(embedding))).select(F.col(key), whole(F.col(embedding)).alias(name))
    fit = cut_lineage(rows.select(F.col(name).alias("x")).distinct())
    sums = totals(fit)
    lengths = sorted(sums)
    out = None
    for i in range(0, max(len(lengths), 1), LOT):
        models = fit_models(fit, {d: sums[d] for d in lengths[i : i + LOT]})
        part = project(rows, key, name, models)
        out = part if out is None else out.unionByName(part)
    return out


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
