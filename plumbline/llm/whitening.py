"""Whitening of embeddings by matrix-free block subspace iteration.

The covariance is never built: each pass over the data multiplies it with a block of columns, as X'(XQ)
over centred rows, summed in the tasks that read them. The products are kept beside the basis that they
belong to, so Rayleigh-Ritz gives the best components inside all blocks so far, and their residuals,
made orthogonal by QR, are the next block. A basis that has become too wide is cut back to its leading
directions. The passes end when the residuals of all wanted components are at the rounding of doubles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.sources.storage import written

#: Units of the grid that vectors are put on, in one.
GRID = 256
#: Columns of a block, and of the basis at most.
BLOCK, BASIS = 16, 128
#: Residuals, as parts of the largest eigenvalue: those that end the passes, and those that are taken for rounding if no pass lowers them.
SMALL, ROUNDING = 1e-14, 1e-11
#: Passes that must fail to halve the least residual.
STALE = 15
#: Passes after which the data are given up as having no such components.
PASSES = 1000
#: Groups of tasks whose arrays are added up before the driver gets them.
GROUPS = 256
#: Vectors that are handled at once, by their entries.
ENTRIES = 1 << 20


def on_grid(vector: Column) -> Column:
    """The vector's entries as double, times GRID, rounded down, as longs; out of a long's range: its nearest end."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * GRID))


def usable(vector: Column) -> Column:
    """Whether a vector is there and has finite entries only."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True))


def _blocks(batches: Iterator[pa.RecordBatch], column: str, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches, with their vectors as a table of longs."""
    step = max(1, ENTRIES // max(1, width))
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width)


def _summed(fit: DataFrame, work: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], kind: str) -> np.ndarray:
    """The sum of work(vectors) over all vectors, added up in tasks, then in groups of tasks, then here.

    So the driver gets at most GROUPS arrays.
    """
    width = shape[-1] if kind == "i8" else shape[0]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for _, x in _blocks(batches, "x", width):
            own = work(x)
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % GROUPS], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["g", "total"])

    def together(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, dtype=kind) for b in table.column("total").to_pylist())
        return pa.table({"total": pa.array([total.tobytes()], pa.binary())})

    parts = fit.mapInArrow(each, "g long, total binary").groupBy("g").applyInArrow(together, "total binary").collect()
    return sum((np.frombuffer(r["total"], dtype=kind).reshape(shape) for r in parts), np.zeros(shape, dtype=kind))


class Centre:
    """The number of vectors and the exact sums of their entries; differences from the mean."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.sums = n, sums
        self.most = max(map(abs, sums), default=0)

    def spread(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly: longs if they are sure to fit, else whole numbers of any size."""
        largest = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
        kind = np.int64 if largest * self.n + self.most < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.spread(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of the squares of spread for each vector; None where a long does not hold it."""
        apart = self.spread(x)
        if apart.dtype == np.int64 and apart.size and max(abs(int(apart.max())), abs(int(apart.min()))) ** 2 * x.shape[1] < 1 << 63:
            return (apart * apart).sum(axis=1).tolist()
        sums = (apart.astype(object) ** 2).sum(axis=1).tolist() if apart.size else [0] * len(x)
        return [s if s < 1 << 63 else None for s in sums]


def centre(fit: DataFrame, width: int) -> Centre:
    """Of the vectors x of fit: counted, and summed by the high and the low halves of their entries, which no sum overflows."""

    def work(x: np.ndarray) -> np.ndarray:
        return np.stack([np.full(width, len(x), dtype=np.int64), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])

    count, high, low = _summed(fit, work, (3, width), "i8").tolist()
    return Centre(count[0], [(h << 32) + w for h, w in zip(high, low, strict=True)])


def _orthonormal(block: np.ndarray, basis: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """An orthonormal block of as many columns, orthogonal to the basis; what the basis has already becomes random."""
    scale = np.linalg.norm(block, axis=0)
    block = block / np.where(scale > 0, scale, 1)
    for _ in range(4):
        block = block - basis @ (basis.T @ block)
        lost = np.linalg.norm(block, axis=0) < 1e-8
        block[:, lost] = rng.standard_normal((len(block), int(lost.sum())))
        block, upper = np.linalg.qr(block - basis @ (basis.T @ block))
        weak = np.abs(np.diag(upper)) < 1e-8
        block[:, weak] = rng.standard_normal((len(block), int(weak.sum())))
    return np.linalg.qr(block - basis @ (basis.T @ block))[0]


def leading(times: Callable[[np.ndarray], np.ndarray], width: int, wanted: int, block: int = BLOCK, most: int = BASIS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and unit eigenvectors of a symmetric matrix that is known by its products with blocks.

    Residuals below SMALL times the largest eigenvalue, or below ROUNDING times it and no longer falling,
    or of a basis of all dimensions, are computed again from fresh products, without what rounding has
    left in the kept ones. The wanted components are certified once that lowers them no further.
    """
    rng = np.random.default_rng(0)
    block, wanted = min(width, max(block, 2 * wanted)), min(width, wanted)
    most = max(most, 4 * block)
    basis = np.linalg.qr(rng.standard_normal((width, block)))[0]
    images, best, stale, certified = times(basis), np.inf, 0, np.inf
    for _ in range(PASSES):
        values, vectors, products, worst = _ritz(basis, images, wanted)
        stale = 0 if worst < best / 2 else stale + 1
        best = min(best, worst)
        if worst <= SMALL or basis.shape[1] == width or (worst <= ROUNDING and stale >= STALE):
            basis = np.linalg.qr(vectors[:, :block])[0]
            images = times(basis)
            values, vectors, products, worst = _ritz(basis, images, wanted)
            if worst <= SMALL or certified / 2 <= worst <= ROUNDING or basis.shape[1] == width:
                return values[:wanted], vectors[:, :wanted]
            best, stale, certified = np.inf, 0, worst
        elif basis.shape[1] + block > most:
            vectors, products = vectors[:, : 2 * block], products[:, : 2 * block]
        left = products - vectors * values[: vectors.shape[1]]
        more = _orthonormal(left[:, : min(block, width - vectors.shape[1])], vectors, rng)
        basis, images = np.hstack([vectors, more]), np.hstack([products, times(more)])
    raise ArithmeticError(f"no certified components after {PASSES} passes; the least residual was {best:.1e}")


def _ritz(basis: np.ndarray, images: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """The best eigenvalues inside a basis, falling, their vectors, these vectors' products, and the largest residual wanted."""
    small = basis.T @ images
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, vectors, products = values[::-1], basis @ turn[:, ::-1], images @ turn[:, ::-1]
    left = products[:, :wanted] - vectors[:, :wanted] * values[:wanted]
    return values, vectors, products, float(np.linalg.norm(left, axis=0).max()) / max(float(values[0]), np.finfo(float).tiny)


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error) for every usable row and component.

    Vectors are put on a grid (on_grid); the fit list has each different one once. Rows whose vector is
    null, or has null or non-finite entries, are left out, and so are rows whose vector has not the
    commonest length (of equally common ones the greatest) and empty vectors. deviation is exact, and
    null if it does not fit in a long. Components without spread have no whitened values and are left
    out, so fewer than components are returned if the vectors span less; one different vector, or none,
    gives no rows. Ids may be null or repeated, equal vectors get equal values, other columns are not read.
    """
    kind = dict(rows.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    own = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(usable(F.col("v"))).select("id", on_grid(F.col("v")).alias("x"))
    lengths = own.where(F.size("x") > 0).groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    empty = rows.sparkSession.createDataFrame([], schema)
    if lengths is None:
        return empty
    width = lengths["width"]
    own = own.where(F.size("x") == width)
    fit = written(own.select("x").distinct())
    mean = centre(fit, width)

    def times(block: np.ndarray) -> np.ndarray:
        def work(x: np.ndarray) -> np.ndarray:
            c = mean.centred(x)
            return c.T @ (c @ block)

        return _summed(fit, work, block.shape, "f8") / mean.n

    def squares(x: np.ndarray) -> np.ndarray:
        c = mean.centred(x)
        return np.einsum("ij,ij->j", c, c)

    trace = float(_summed(fit, squares, (width,), "f8").sum()) / mean.n
    if trace == 0:
        return empty
    values, vectors = leading(times, width, components)
    there = values > width * np.finfo(float).eps * 16 * values[0]
    values, vectors = values[there], vectors[:, there]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), range(len(values))] < 0, -1.0, 1.0)
    project = vectors / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = mean.centred(x) @ project
        padded = np.zeros((width, len(values) + 1))
        padded[: len(values), : len(values)], padded[: len(values), -1] = w.T @ w, w.sum(axis=0)
        return padded

    got = _summed(fit, moments, (width, len(values) + 1), "f8")[: len(values)] / mean.n
    error = float(np.abs(got[:, :-1] - np.outer(got[:, -1], got[:, -1]) - np.eye(len(values))).max())
    explained = values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for part, x in _blocks(batches, "x", width):
            at = np.repeat(np.arange(len(x)), k)
            columns = [part.column("id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array(np.full(len(at), mean.n), pa.int64())]
            columns += [pa.array(mean.deviations(x), pa.int64()).take(pa.array(at)), pa.array((mean.centred(x) @ project).ravel(), pa.float64())]
            columns += [pa.array(np.tile(explained, len(x)), pa.float64()), pa.array(np.full(len(at), error), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return own.mapInArrow(run, schema)
