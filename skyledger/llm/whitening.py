"""Whitening of vectors along the leading components of their covariance.

Vectors are turned into integers first, so that the list of distinct ones and its sums are exact.
Spark sums products of centred vectors over all partitions; the eigenvectors of the covariance, a
matrix that depends on the length of a vector alone, are found in one task by contour integration
(``contour``). What goes through the driver is sums and components per length of vectors: sixteen
vectors for each length there is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from skyledger.llm.common import write_counted
from skyledger.llm.contour import leading

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Larger absolute values, times SCALE, count as this one, so that integers stay exact in doubles.
LARGEST = 1 << 50
#: A task hands on a triangle of products; it gets so many vectors per row of it at least.
VECTORS_PER_ROW = 8
_INT64 = 2**63 - 1


def entries(vector: Column) -> Column:
    """The vector as integers; null if it, or an entry, is null or not finite."""
    values = vector.cast("array<double>")
    finite = F.forall(
        values,
        lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)),
    )
    limit = F.lit(float(LARGEST))
    whole = F.transform(
        values,
        lambda c: F.floor(F.greatest(F.least(c * SCALE, limit), -limit)).cast("long") + SHIFT,
    )
    return F.when(finite, whole)


@dataclass(frozen=True)
class Centre:
    """Size of the fit list and its exact sums."""

    n: int
    sums: list[int]

    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    def rest(self) -> np.ndarray:
        return np.array([s % self.n / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Entries less their mean; the whole part is taken off exactly."""
        return (x - self.whole()).astype(np.float64) - self.rest()

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of ``(n * x - sum) ** 2``; null where a long cannot hold it."""
        apart = x - self.whole()
        # n * x - sum = n * (x - whole) - remainder
        largest = self.n * (int(np.abs(apart).max(initial=0)) + 1)
        if largest * largest * max(x.shape[1], 1) <= _INT64:
            d = self.n * apart - np.array([s % self.n for s in self.sums], np.int64)
            return np.einsum("ij,ij->i", d, d).tolist()
        exact = (
            sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True))
            for row in x.tolist()
        )
        return [v if v <= _INT64 else None for v in exact]


@dataclass(frozen=True)
class Model:
    """Components of vectors of one length: eigenvalues, unit vectors and the share of each."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.vectors.T / np.sqrt(self.values)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, rows and matrix of the vectors of each length in a batch, but for empty ones."""
    column = batch.column("x")
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dim)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        if dim:
            yield dim, rows, flat.reshape(len(rows), dim)


def _centres(fit: DataFrame) -> dict[int, Centre]:
    """One row per length and place comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            for dim, rows, x in _by_length(batch):
                n, before = sums.get(dim, (0, [0] * dim))
                # high and low parts apart, so that no batch overflows
                high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
                added = [b + (h << 32) + w for b, h, w in zip(before, high, low, strict=True)]
                sums[dim] = (n + len(rows), added)
        for dim, (n, total) in sums.items():
            decimals = pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))
            columns = [[dim] * dim, list(range(dim)), [n] * dim]
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*arrays, decimals], ["dim", "place", "n", "total"])

    parts = fit.mapInArrow(run, "dim int, place int, n long, total decimal(38,0)")
    rows = parts.groupBy("dim", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    found: dict[int, dict[int, tuple[int, int]]] = {}
    for row in rows.collect():
        found.setdefault(row["dim"], {})[row["place"]] = (row["n"], int(row["total"]))
    return {
        dim: Centre(places[0][0], [places[i][1] for i in range(dim)])
        for dim, places in found.items()
    }


def _square_sums(fit: DataFrame, of) -> DataFrame:
    """``dim``, ``i``, ``j``, ``v``: sums of the products of the columns that ``of`` makes of the
    vectors of a length, for ``i <= j``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch):
                if (y := of(dim, x)) is not None:
                    sums[dim] = sums.get(dim, 0) + y.T @ y
        for dim, total in sums.items():
            i, j = np.triu_indices(len(total))
            columns = [np.full(len(i), dim, np.int32), i.astype(np.int32), j.astype(np.int32)]
            arrays = [pa.array(c) for c in (*columns, total[i, j])]
            yield pa.RecordBatch.from_arrays(arrays, ["dim", "i", "j", "v"])

    parts = fit.mapInArrow(run, "dim int, i int, j int, v double")
    return parts.groupBy("dim", "i", "j").agg(F.sum("v").alias("v"))


def _full(i: np.ndarray, j: np.ndarray, v: np.ndarray) -> np.ndarray:
    size = int(max(i.max(), j.max())) + 1
    matrix = np.zeros((size, size))
    matrix[i, j] = matrix[j, i] = v
    return matrix


def _models(fit: DataFrame, centres: dict[int, Centre], components: int) -> dict[int, Model]:
    def solve(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        columns = (table.column(c).to_numpy() for c in ("i", "j", "v"))
        matrix = _full(*columns) / centres[dim].n
        values, vectors = leading(matrix, components)
        share = values / np.trace(matrix) if len(values) else values
        schema = pa.schema(
            [("dim", pa.int32()), ("component", pa.int32()), ("value", pa.float64()),
             ("share", pa.float64()), ("vector", pa.list_(pa.float64()))]
        )
        numbers = list(range(len(values)))
        return pa.table(
            [[dim] * len(numbers), numbers, values.tolist(), share.tolist(), vectors.tolist()],
            schema=schema,
        )

    products = _square_sums(fit, lambda dim, x: centres[dim].centred(x))
    solved = products.groupBy("dim").applyInArrow(
        solve, "dim int, component int, value double, share double, vector array<double>"
    )
    found: dict[int, list] = {}
    for row in solved.collect():
        found.setdefault(row["dim"], []).append(row)
    models = {}
    for dim, rows in found.items():
        rows.sort(key=lambda r: r["component"])
        models[dim] = Model(
            centres[dim],
            np.array([r["value"] for r in rows]),
            np.array([r["vector"] for r in rows]).reshape(len(rows), dim),
            np.array([r["share"] for r in rows]),
        )
    return models


def _identity_errors(fit: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """How far the covariance of the whitened fit list is from the identity, per length."""

    def with_one(dim: int, x: np.ndarray) -> np.ndarray | None:
        if dim not in models:
            return None
        white = models[dim].whitened(x)
        return np.column_stack([white, np.ones(len(white))])

    sums: dict[int, list] = {}
    for row in _square_sums(fit, with_one).collect():
        sums.setdefault(row["dim"], []).append((row["i"], row["j"], row["v"]))
    errors = {}
    for dim, rows in sums.items():
        total = _full(*map(np.array, zip(*rows, strict=True)))
        mean = total[:-1, -1] / total[-1, -1]
        covariance = total[:-1, :-1] / total[-1, -1] - np.outer(mean, mean)
        errors[dim] = float(np.abs(covariance - np.eye(len(mean))).max())
    return errors


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """``vec_id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained`` and
    ``identity_error`` per row and component.

    Rows whose vector is null or holds a null or non-finite entry are dropped. Vectors of different
    lengths have a list, components and an error of their own each. Components whose eigenvalue is
    nought within rounding do not exist, so a single distinct vector, an empty one and an empty table give no
    rows. Repeated rows count once in the list and give rows each; a null id stays null. Entries
    beyond 2**44 in absolute value count as that, and a deviation that no long holds is null.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), entries(F.col(vector_col)).alias("x")
    ).where(F.col("x").isNotNull())
    # each distinct vector once; copies are combined before the shuffle
    fit, n = write_counted(rows.select("x").distinct(), "fit")
    centres = _centres(fit)
    widest = max(centres, default=1)
    some = fit.coalesce(max(1, n // (VECTORS_PER_ROW * widest)))
    models = _models(some, centres, components)
    models = {dim: m for dim, m in models.items() if len(m.values)}
    errors = _identity_errors(fit, models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in _by_length(batch):
                if dim not in models:
                    continue
                model = models[dim]
                white, k = model.whitened(x), len(model.values)
                ids = batch.column("vec_id").take(pa.array(np.repeat(at, k)))
                deviation = pa.array(model.centre.deviations(x), pa.int64())
                size = len(at) * k
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(size, model.centre.n, np.int64)),
                        deviation.take(pa.array(np.repeat(np.arange(len(at)), k))),
                        pa.array(white.ravel()),
                        pa.array(np.tile(model.explained, len(at))),
                        pa.array(np.full(size, errors[dim])),
                    ],
                    names,
                )

    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return rows.mapInArrow(
        run,
        "vec_id long, component int, n long, deviation long, whitened double, explained double,"
        " identity_error double",
    )
