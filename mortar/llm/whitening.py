"""Embedding whitening: principal components of the distinct vectors by contour integration, rows projected and scaled.

Entries become whole numbers, x = floor(256 c).  The fit list holds each distinct vector x once, so copies do not weigh.
Counts and sums over it are exact; its covariance (divisor n, centred before multiplying) is summed per task as one
dimensions x dimensions matrix, and ``feast`` finds the components on the driver, where nothing larger than that matrix
arrives.  A last pass over the fit list measures the covariance of the whitened vectors.

Defined results: rows whose vector is null, empty, or holds a null, NaN or infinite entry are dropped.  Vectors of
another length than most distinct vectors have (of equally frequent lengths the greatest) have no place in the fitted
space and are dropped as well.  x beyond the range of a long stands at its end.  Repeated rows and ids stay, each with its
own result.  Directions without variance are no components: equal vectors alone give no components, an empty table none.
``deviation`` is null where it passes a long; ``deviation_exact`` (38 digits) is there for tables that large.
Columns of the table are kept; added columns get leading underscores where their names are taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mortar.llm import columns, feast, scratch

COMPONENTS, SCALE = 4, 256
LONG = 2**63 - 1


@dataclass
class Model:
    """n distinct vectors with exact sums; components as columns, their eigenvalues, the trace, and the measured error."""

    dimensions: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def whole(vectors: DataFrame, column: str, name: str) -> DataFrame:
    """Rows whose vector can be used, with the column ``name`` of whole numbers."""
    usable = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    exact = F.transform(F.col(column).cast("array<double>"), lambda c: F.floor(c * SCALE).cast("long"))
    return vectors.filter(F.col(column).isNotNull() & (F.size(column) > 0) & usable).withColumn(name, exact)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _exact_sums(fit: DataFrame, dimensions: int) -> tuple[int, list[int]]:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dimensions
        for batch in batches:
            x = _matrix(batch.column("x"), dimensions)
            n += len(x)
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            sums = [s + (h << 32) + lo for s, h, lo in zip(sums, high, low)]
        if n:
            entries = pa.array([Decimal(v) for v in [n, *sums]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, dimensions), pa.int32()), entries], names=["i", "s"])

    total = fit.mapInArrow(partial, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))
    found = {r["i"]: int(r["s"]) for r in total.collect()}  # dimensions + 1 numbers
    return found.get(-1, 0), [found.get(i, 0) for i in range(dimensions)]


def _products(fit: DataFrame, mean: np.ndarray, project: np.ndarray | None = None) -> np.ndarray:
    """Sum over the fit list of y y^T, y the centred vector or its projection."""
    dimensions, size = len(mean), len(mean) if project is None else project.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((size, size)), False
        for batch in batches:
            y = _matrix(batch.column("x"), dimensions) - mean
            y = y if project is None else y @ project
            total += y.T @ y
            seen = seen or len(y) > 0
        if seen:
            i, j = np.triu_indices(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "p"]
            )

    summed = fit.mapInArrow(partial, "i int, j int, p double").groupBy("i", "j").agg(F.sum("p").alias("p"))
    found = summed.toArrow()  # half of dimensions x dimensions numbers
    out = np.zeros((size, size))
    i, j = (found.column(c).to_numpy() for c in ("i", "j"))
    out[i, j] = out[j, i] = found.column("p").to_numpy()
    return out


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Model:
    """Model of the distinct vectors of a table."""
    columns.need(vectors, column)
    distinct = whole(vectors.select(column), column, "x").select("x").distinct()
    distinct = scratch.stored(distinct, "fit")
    lengths = distinct.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return Model(0, 0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    dimensions = lengths[0]["d"]
    distinct = distinct.filter(F.size("x") == dimensions)
    n, sums = _exact_sums(distinct, dimensions)
    mean = np.array([s / n for s in sums])
    covariance = _products(distinct, mean) / n
    values, found = feast.greatest(covariance, components)
    error = 0.0
    if len(values):
        measured = _products(distinct, mean, found / np.sqrt(values)) / n
        error = float(np.abs(measured - np.eye(len(values))).max())
    return Model(dimensions, n, sums, values, found, float(np.trace(covariance)), error)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Exact sum over the dimensions of (n x - S)^2."""
    reach = max(abs(int(x.max())), abs(int(x.min()))) * n + max(map(abs, sums))
    if reach * reach * len(sums) <= LONG:
        y = x * n - np.array(sums)
        return pa.array((y * y).sum(axis=1)).cast(pa.decimal128(38, 0))
    y = x.astype(object) * n - np.array(sums, object)
    exact = (y * y).sum(axis=1)
    return pa.array([Decimal(int(v)) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))


def whiten(vectors: DataFrame, model: Model, column: str = "embedding") -> tuple[DataFrame, dict[str, str]]:
    """Rows that remain, with ``whitened`` (array of one number per component) and ``deviation_exact``; and these names."""
    columns.need(vectors, column)
    names = {n: columns.free_name(vectors, n) for n in ("whitened", "deviation_exact", "x")}
    rows = whole(vectors, column, names["x"]).filter(F.size(names["x"]) == model.dimensions)
    kept = [f for f in vectors.schema]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    dimensions, n, sums, mean = model.dimensions, model.n, model.sums, model.mean if model.n else None
    project = model.vectors / np.sqrt(model.values) if len(model.values) else np.zeros((dimensions, 0))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(names["x"]), dimensions)
            w = (x - mean) @ project
            bounds = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
            added = [pa.ListArray.from_arrays(bounds, pa.array(w.ravel())), _deviations(x, n, sums)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + added,
                names=[f.name for f in kept] + [names["whitened"], names["deviation_exact"]],
            )

    added = f"`{names['whitened']}` array<double>, `{names['deviation_exact']}` decimal(38,0)"
    return rows.mapInArrow(apply, f"{schema}, {added}"), names


def report(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact."""
    columns.need(vectors, "vec_id")
    model = fit(vectors, components=components)
    rows, names = whiten(vectors.select("vec_id", "embedding"), model)
    exact = F.col(names["deviation_exact"])
    shares = F.array(*[F.lit(float(v / model.trace)).cast("double") for v in model.values]).cast("array<double>")
    return rows.select("vec_id", exact, F.posexplode(names["whitened"]).alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.when(exact <= LONG, exact).cast("long").alias("deviation"),
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
        exact.alias("deviation_exact"),
    )
