"""Whitening of embedding vectors on a fixed grid, with exact sums and eigenpairs found by spectrum slicing.

Entries are floored on a grid of 1/256 to integers, so that counts, sums and products are exact and do not depend on
how rows are dealt out. The model is fitted on the distinct grid vectors; what is gathered of it on the driver is one
matrix of the vectors' dimension.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.llm.spectrum import leading
from promptmill.session import materialise

#: Steps of the grid in one unit.
GRID = 256
#: Entries of this size or more are taken for damage, as infinities are; below it all sums fit 38 digits.
LARGEST = 2.0**32
#: Vector entries worked on at once.
_SLICE = 1 << 20
_EXACT = 1 << 53
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)
_DIGITS = Decimal(10) ** 38


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with ``sums`` per dimension; eigenvalues fall, ``vectors`` are unit rows."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else self.values


def _on_grid(batches: Iterator[pa.RecordBatch], length: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches, the places of their usable vectors of one length, and those vectors on the grid."""
    for batch in batches:
        column = batch.column("_vector")
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        step = max(1, _SLICE // max(1, int(sizes.max(initial=0))))
        for at in range(0, len(batch), step):
            part = batch.slice(at, step)
            lists = part.column("_vector")
            size = sizes[at : at + step]
            entries = pc.fill_null(lists.flatten(), float("nan")).to_numpy(zero_copy_only=False)
            good = np.abs(entries) < LARGEST  # also false for those that are no number
            ends = np.cumsum(size)
            wrong = np.concatenate(([0], np.cumsum(~good)))
            usable = lists.is_valid().to_numpy(zero_copy_only=False) & (wrong[ends] == wrong[ends - size]) & (size > 0)
            for one in np.unique(size[usable]).tolist() if length is None else [length]:
                rows = np.flatnonzero(usable & (size == one))
                if len(rows):
                    places = (ends[rows] - one)[:, None] + np.arange(one)
                    yield part, rows, np.floor(entries[places] * GRID).astype(np.int64)


def _packed(grid: np.ndarray) -> list[bytes]:
    """Each vector in the narrowest whole bytes that hold its entries: equal vectors give equal bytes."""
    size = np.maximum(grid.max(axis=1), -1 - grid.min(axis=1))
    width = sum((size > np.iinfo(kind).max).astype(int) for kind in _WIDTHS[:-1])
    out: list[bytes] = [b""] * len(grid)
    for at in np.unique(width).tolist():
        rows = np.flatnonzero(width == at)
        raw = np.ascontiguousarray(grid[rows].astype(_WIDTHS[at])).view(np.uint8).reshape(len(rows), -1)
        for row, own in zip(rows.tolist(), raw):
            out[row] = own.tobytes()
    return out


def _unpacked(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[np.ndarray]:
    for batch in batches:
        packed = batch.column("packed").to_pylist()
        for at in range(0, len(packed), max(1, _SLICE // length)):
            part = packed[at : at + max(1, _SLICE // length)]
            grid = np.empty((len(part), length), np.int64)
            for row, raw in enumerate(part):
                grid[row] = np.frombuffer(raw, _WIDTHS[(len(raw) // length).bit_length() - 1])
            yield grid


def _gram(rows: np.ndarray) -> np.ndarray:
    """Sums of products of columns, exact: in doubles where no sum can pass 2^53, else in whole numbers of any size."""
    most = int(np.abs(rows).max(initial=0))
    step = len(rows) if most == 0 else max(0, _EXACT // (most * most))
    if step == 0:
        wide = rows.astype(object)
        return wide.T.dot(wide)
    total = np.zeros((rows.shape[1],) * 2, object)
    for at in range(0, len(rows), max(step, 1)):
        part = rows[at : at + step].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _numbered(values: list[int], names: dict[str, list[int]]) -> pa.RecordBatch:
    columns = [pa.array(v, pa.int32()) for v in names.values()]
    columns.append(pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0)))
    return pa.RecordBatch.from_arrays(columns, [*names, "value"])


def fit_list(vectors: DataFrame, *, embedding: str = "embedding") -> DataFrame:
    """``length, packed``: each distinct grid vector of a table once, stored.

    Vectors that are null or empty or hold null, non-finite or damaged (``LARGEST``) entries are left out, as are those
    whose length is not that of most distinct ones (of the longest, among equals).
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, grid in _on_grid(batches):
            packed = pa.array(_packed(grid), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), grid.shape[1], np.int32)), packed], ["length", "packed"])

    given = vectors.select(F.col(embedding).cast("array<double>").alias("_vector"))
    distinct = materialise(given.mapInArrow(pack, "length int, packed binary").distinct())
    common = distinct.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    return distinct.filter(F.col("length") == (common["length"] if common else 0))


def fit(fitted: DataFrame, components: int = 4) -> Whitening:
    """The model of a ``fit_list``.

    The covariance has the divisor n and is centred on whole numbers first; what that leaves out of the mean is
    corrected exactly. Without vectors, or with one only, the model has no components.
    """
    shape = fitted.groupBy("length").count().first()
    if shape is None:
        return Whitening(0, (), 0.0, np.zeros(0), np.zeros((0, 0)))
    length, n = shape["length"], shape["count"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length, object)
        for grid in _unpacked(batches, length):
            total = total + grid.sum(axis=0).astype(object)  # at most 2^20 entries below 2^40
        yield _numbered(total.tolist(), {"i": list(range(length))})

    rows = fitted.select("packed")
    sums = [0] * length
    for row in rows.mapInArrow(add, "i int, value decimal(38,0)").groupBy("i").agg(F.sum("value").alias("value")).collect():
        sums[row["i"]] = int(row["value"])
    centre = np.array([round(s / n) for s in sums], np.int64)
    upper = np.triu_indices(length)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((length, length), object)
        for grid in _unpacked(batches, length):
            total = total + _gram(grid - centre)
        yield _numbered(total[upper].tolist(), {"i": upper[0].tolist(), "j": upper[1].tolist()})

    products = rows.mapInArrow(multiply, "i int, j int, value decimal(38,0)")
    covariance = np.zeros((length, length))
    rest = [s - n * int(c) for s, c in zip(sums, centre)]
    for i, j, value in products.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        covariance[i, j] = covariance[j, i] = (n * int(value) - rest[i] * rest[j]) / (n * n)
    values, found = leading(covariance, components)
    return Whitening(n, tuple(sums), float(np.trace(covariance)), values, found)


def _projection(model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """The mean, and what rows less the mean are multiplied with."""
    return np.array([s / model.n for s in model.sums]), (model.vectors / np.sqrt(model.values)[:, None]).T


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], rows.reshape(-1))


def whiten(vectors: DataFrame, model: Whitening, *, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, deviation, whitened`` per usable vector: ``whitened`` has one entry per component of the model.

    ``deviation`` is n^2 times the squared distance from the mean, exact (null beyond 38 digits). Rows that the model was
    not fitted for (see ``fit_list``) are left out; repeated rows and null ids stay; other columns are ignored.
    """
    length, n = len(model.sums), model.n
    kind = vectors.select(vec_id).schema[0].dataType.simpleString()
    given = vectors.select(F.col(vec_id).alias("_id"), F.col(embedding).cast("array<double>").alias("_vector"))
    if not n:
        return given.filter("false").select(
            F.col("_id").alias("vec_id"), F.lit(None).cast("decimal(38,0)").alias("deviation"), F.col("_vector").alias("whitened")
        )
    sums = np.array(model.sums, object)
    mean, onto = _projection(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows, grid in _on_grid(batches, length):
            ids = part.column("_id").take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [ids, _deviations(grid, n, sums), _lists((grid - mean) @ onto)], ["vec_id", "deviation", "whitened"]
            )

    return given.mapInArrow(project, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")


def _deviations(grid: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """The sum over dimensions of (n x - S)^2 per row: n^2 A - 2 n B + C with A = sum x^2, B = sum x S, C = sum S^2."""
    length = grid.shape[1]
    most, far = int(np.abs(grid).max(initial=0)), int(max(map(abs, sums), default=0))
    if length * max(most * most, most * far) < 1 << 62:
        squares, mixed = (grid * grid).sum(axis=1).tolist(), (grid @ sums.astype(np.int64)).tolist()
    else:
        wide = grid.astype(object)
        squares, mixed = (wide * wide).sum(axis=1).tolist(), wide.dot(sums).tolist()
    fixed = int((sums * sums).sum())
    exact = (n * n * a - 2 * n * b + fixed for a, b in zip(squares, mixed))
    return pa.array([Decimal(v) if v < _DIGITS else None for v in exact], pa.decimal128(38, 0))


def identity_error(fitted: DataFrame, model: Whitening) -> float:
    """The largest entry, in size, of the whitened fit list's covariance minus the identity; 0 without components."""
    k = len(model.values)
    if not k:
        return 0.0
    length = len(model.sums)
    mean, onto = _projection(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grid in _unpacked(batches, length):
            yield pa.RecordBatch.from_arrays([_lists((grid - mean) @ onto)], ["w"])

    w = F.col("w")
    entries = [F.covar_pop(w[i], w[j]) for i in range(k) for j in range(i, k)]
    found = fitted.select("packed").mapInArrow(project, "w array<double>").agg(*entries).first()
    wanted = [float(i == j) for i in range(k) for j in range(i, k)]
    return max(abs(f - w) for f, w in zip(found, wanted))
