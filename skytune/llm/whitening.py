"""Whitening of embeddings with MLlib's distributed block matrices.

Entries become whole numbers first, so sums are exact. The principal components are those of the
distinct vectors, each counted once. Rows, centred exactly, are indexed and gathered into blocks; the
transpose times the matrix is the scatter, whose eigenvectors are found on the driver (its size is
that of one vector squared); the matrix times the whitening matrix projects the rows.

``BlockMatrix`` lists its blocks on the driver, and pairs them there. Rows are therefore taken in
slabs of a bounded number of blocks, whose scatters add up.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import SparkContext, StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytune.session import release, written

#: Rows of a block, and blocks of a slab.
BLOCK_ROWS = 1024
SLAB_BLOCKS = 8192
#: Blocks that one task multiplies; their products are added up afterwards.
TOGETHER = 8
#: Rows of one task have numbers from the task's number times this on.
PER_TASK = 1 << 33

#: Whole numbers that entries become: floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 64, 1_000_000

SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


@dataclass(frozen=True)
class Slab:
    """A number, the rows of the tasks from ``first`` up to but without ``stop``, and how many."""

    number: int
    first: int
    stop: int
    rows: int


@dataclass(frozen=True)
class Fit:
    """Number and sums of distinct vectors; principal components as columns, by falling variance."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    total: float

    def whitening(self, most: int) -> np.ndarray:
        """Columns that project a centred vector on the first components, at unit variance."""
        return self.components[:, :most] / np.sqrt(self.variances[:most])


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x): rows whose vector is there and finite, entries as whole numbers."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    lost = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(v, lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    return rows.where(v.isNotNull() & ~lost).select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("x")
    )


def slabs(numbered: DataFrame, most: int) -> tuple[list[Slab], DataFrame]:
    """Tasks gathered in order until a slab would have more than ``most`` rows.

    Also where the rows of each task lie: (task, slab, begin).
    """
    sizes = numbered.groupBy(F.shiftright("row", 33).alias("task")).count().orderBy("task")
    found: list[Slab] = []
    places: list[tuple[int, int, int]] = []
    first = total = 0
    for task, size in sizes.collect():  # one row per task
        if total and total + size > most:
            found.append(Slab(len(found), first, task, total))
            first, total = task, 0
        places.append((task, len(found), total))
        total += size
    if total:
        found.append(Slab(len(found), first, 1 << 29, total))
    schema = "task long, slab int, begin long"
    return found, numbered.sparkSession.createDataFrame(places, schema)


def placed(numbered: DataFrame, places: DataFrame) -> DataFrame:
    """(slab, index, vec_id, x): rows by their place in a slab."""
    tasked = numbered.withColumn("task", F.shiftright("row", 33))
    index = F.col("begin") + F.col("row") - F.col("task") * PER_TASK
    return tasked.join(places, "task").select("slab", index.alias("index"), "vec_id", "x")


def offsets(n: int, sums: list[int]) -> Column:
    """n * x - sums, exact; beyond 64 bits it raises."""
    listed = F.array(*(F.lit(s).cast("long") for s in sums))
    return F.zip_with("x", listed, lambda a, s: F.lit(n).cast("long") * a - s)


@contextmanager
def blocks(rows: DataFrame, slab: Slab, n: int, sums: list[int]) -> Iterator[BlockMatrix]:
    """The centred vectors of rows (index, x) as distributed blocks; indexes may be missing."""
    away = F.transform(offsets(n, sums), lambda c: c.cast("double") / n)
    centred = rows.select("index", array_to_vector(away).alias("vector"))
    plain = MLUtils.convertVectorColumnsFromML(centred, "vector")
    width = len(sums)
    matrix = IndexedRowMatrix(plain, slab.rows, width).toBlockMatrix(BLOCK_ROWS, width)
    matrix.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield matrix
    finally:
        matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix; products of a few blocks each are made apart and added."""
    splits = max(1, math.ceil(matrix.numRowBlocks / TOGETHER))
    flipped, java = matrix.transpose()._java_matrix_wrapper, matrix._java_matrix_wrapper._java_model
    product = flipped.call("multiply", java, splits)
    width = matrix.colsPerBlock
    return BlockMatrix(product, width, width).toLocalMatrix().toArray()


def projected(matrix: BlockMatrix, small: np.ndarray, context: SparkContext) -> BlockMatrix:
    """The product with a matrix that fits into one block."""
    height, width = small.shape
    block = Matrices.dense(height, width, small.flatten("F").tolist())
    return matrix.multiply(BlockMatrix(context.parallelize([((0, 0), block)], 1), height, width))


def fitted(distinct: DataFrame, parts: list[Slab]) -> Fit | None:
    """Principal components of the distinct vectors (slab, index, x); None if there are none."""
    n, width, widest = distinct.agg(
        F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))
    ).first()
    if width != widest:
        raise ValueError(f"vectors have {width} to {widest} entries")
    if not n or not width:
        return None
    sums = list(distinct.agg(*(F.sum(F.col("x")[i]) for i in range(width))).first())
    total = np.zeros((width, width))
    for slab in parts:
        with blocks(distinct.where(F.col("slab") == slab.number), slab, n, sums) as matrix:
            total += scatter(matrix)
    covariance = (total + total.T) / 2 / n
    variances, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-variances, kind="stable")
    variances, vectors = variances[order], vectors[:, order]
    # what rounding alone can leave is no variance
    real = variances > max(variances[0], 0.0) * width * np.finfo(float).eps
    return Fit(n, sums, vectors[:, real], variances[real], float(np.trace(covariance)))


def whitened(
    rows: DataFrame,
    components: int = 16,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    slab_blocks: int = SLAB_BLOCKS,
) -> DataFrame:
    """Per row and component: (vec_id, component, n, deviation, whitened, explained, identity_error).

    Components count from 1 by falling variance, over the distinct whole-number vectors, of which
    there are ``n``; ``explained`` is the component's share of all variance, ``whitened`` the row's
    place along it at unit variance, ``deviation`` the sum of the squares of n * x - sums, exact.
    ``identity_error`` is how far the covariance of the whitened distinct vectors is from the
    identity, as measured.

    Rows whose vector is null or has a null or non-finite entry are left out. Vectors must be equally
    long. Components without variance are left out, so equal vectors, vectors without entries and
    an empty table give no rows. Rows and ids may repeat, ids may be null; other columns are not read.
    """
    spark = rows.sparkSession
    own = whole_vectors(rows, id_col, vector_col)
    numbered = written(own.withColumn("row", F.monotonically_increasing_id()), "vectors")
    parts, places = slabs(numbered, BLOCK_ROWS * slab_blocks)
    at = F.min(F.struct("slab", "index")).alias("at")
    once = placed(numbered, places).groupBy("x").agg(at).select("at.*", "x")
    distinct = written(once, "distinct-vectors", ["slab"])
    fit = fitted(distinct, parts)
    if fit is None or not len(fit.variances):
        release(numbered, distinct)
        return spark.createDataFrame([], SCHEMA)

    matrix = fit.whitening(components)
    width = matrix.shape[1]
    total = np.zeros((width, width))
    done = []
    for slab in parts:
        with blocks(distinct.where(F.col("slab") == slab.number), slab, fit.n, fit.sums) as known:
            total += scatter(projected(known, matrix, spark.sparkContext))
        near = F.col("row").between(slab.first * PER_TASK, slab.stop * PER_TASK - 1)
        mine = placed(numbered.where(near), places)
        with blocks(mine, slab, fit.n, fit.sums) as every:
            product = projected(every, matrix, spark.sparkContext).toIndexedRowMatrix()
            found = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
            found = found.select("index", vector_to_array("vector").alias("w"))
            squares = F.transform(offsets(fit.n, fit.sums), lambda c: c * c)
            deviation = F.aggregate(squares, F.lit(0).cast("long"), lambda a, c: a + c)
            told = mine.select("index", "vec_id", deviation.alias("deviation"))
            done.append(written(told.join(found, "index"), "whitened"))
    release(numbered, distinct)

    shares = F.array(*map(F.lit, (fit.variances[:width] / fit.total).tolist()))
    error = float(np.abs(total / fit.n - np.eye(width)).max())
    flat = reduce(DataFrame.unionByName, done).select(
        "vec_id", "deviation", F.posexplode("w").alias("place", "whitened")
    )
    return flat.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
