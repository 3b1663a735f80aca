"""Whitening of embeddings with distributed block matrices.

Centred rows get an index and become an MLlib BlockMatrix. Its transpose times
itself is the scatter matrix, small enough for the driver, where the
eigenvectors are found; the blocks times the whitening matrix give the projected
rows. The middle dimension of the scatter product is split, so that no task
reads more than a bounded number of row blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.ranks import numbered
from gaugeline.session import materialize

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000  # fixed values of the contract
LARGEST = float(1 << 53)  # of a scaled entry: larger ones count as this much
BLOCK_BYTES = 2 << 20
COLUMNS_A_BLOCK = 1024
BLOCKS_A_TASK = 16
LEAST_SHARE = 1e-12  # of the largest eigenvalue: below it a component has no spread to divide by


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its entries are numbers."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))), F.lit(False))


def integers(vector: Column) -> Column:
    """floor(64 * c) + 1000000 of every entry, as long."""
    return F.transform(vector, lambda c: F.floor(
        F.greatest(F.least(c.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))).cast("long") + SHIFT)


def fit_list(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int, int]:
    """(key, x, __place) of all usable rows, their number, and the dimension.

    Left out are rows whose vector is null, holds null, NaN or infinity, or has
    another length than most have (of equally frequent lengths the longest).
    Rows that repeat are rows of their own; a null key is kept.
    """
    usable = table.where(finite(F.col(vector)) & (F.size(vector) > 0)).select(F.col(key).alias("key"), integers(F.col(vector)).alias("x"))
    stored = materialize(usable, "whiten-integers")
    lengths = stored.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return numbered(stored, label="whiten"), 0, 0
    return numbered(stored.where(F.size("x") == lengths["d"]), label="whiten"), lengths["n"], lengths["d"]


def sums_of(rows: DataFrame, array: str, dimension: int) -> list:
    """The sum of every entry; null where it leaves the type."""
    return list(rows.agg(F.array(*[F.try_sum(F.get(array, F.lit(at))) for at in range(dimension)]).alias("s")).first()["s"])


def blocks_of(rows: DataFrame, array: str, means: list[float], n: int) -> BlockMatrix:
    """The rows less their mean as a block matrix; ``rows`` has __place and the array."""
    dimension = len(means)
    centred = F.zip_with(F.col(array), F.lit(means), lambda value, mean: value - mean)
    frame = MLUtils.convertVectorColumnsFromML(rows.select("__place", array_to_vector(centred).alias("v")), "v")
    height = max(1, BLOCK_BYTES // (8 * min(dimension, COLUMNS_A_BLOCK)))
    return IndexedRowMatrix(frame, n, dimension).toBlockMatrix(height, min(dimension, COLUMNS_A_BLOCK))


def product(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """``left`` times ``right``; the dimension they share is dealt to ``splits`` groups of tasks."""
    found = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(found, left.rowsPerBlock, right.colsPerBlock)


def covariance(blocks: BlockMatrix, n: int) -> np.ndarray:
    """Transpose times itself over n: as many numbers as columns squared."""
    scatter = product(blocks.transpose(), blocks, -(-blocks.numRowBlocks // BLOCKS_A_TASK))
    return scatter.toLocalMatrix().toArray() / n


def local_blocks(matrix: np.ndarray, blocks: BlockMatrix) -> BlockMatrix:
    """A small matrix in blocks that fit those it is multiplied with."""
    height, (rows, columns) = blocks.colsPerBlock, matrix.shape
    parts = [((at // height, 0), DenseMatrix(len(part), columns, part.ravel(order="F")))
             for at in range(0, rows, height) for part in [matrix[at:at + height]]]
    context = blocks.blocks.context
    return BlockMatrix(context.parallelize(parts, len(parts)), height, columns, rows, columns)


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: rows (key, deviation, whitened array), their number, and the spectrum."""

    rows: DataFrame
    n: int
    components: int
    explained: list  # by component; None without any spread
    identity_error: float | None


def whiten(table: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> Whitening:
    """Fit on all usable rows and project them.

    There are as many components as dimensions at most. A component whose
    eigenvalue is next to nothing beside the largest has whitened null, and
    identity_error is over the others (null without any). ``deviation`` is null where it
    leaves a long. Without usable rows there are none.
    """
    vectors, n, dimension = fit_list(table, key, vector)
    components = min(components, dimension)
    if n == 0:
        empty = vectors.select("key", F.lit(None).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
        return Whitening(empty, 0, 0, [], None)
    sums = sums_of(vectors, "x", dimension)
    rough = None if None not in sums else [s / n for s in sums_of(vectors.withColumn("x", F.col("x").cast("array<double>")), "x", dimension)]
    means = rough or [s / n for s in sums]
    blocks = blocks_of(vectors, "x", means, n)
    values, axes = np.linalg.eigh(covariance(blocks, n))
    values, axes = np.maximum(values[::-1], 0.0), axes[:, ::-1]
    spread = values[:components] > LEAST_SHARE * max(values[0], 0.0)
    usable = int(spread.sum())  # the eigenvalues fall
    total = float(values.sum())
    explained = [float(value) / total if total > 0 else None for value in values[:components]]

    apart = F.aggregate(
        F.zip_with(F.col("x"), F.lit(sums).cast("array<bigint>"), lambda x, s: F.try_subtract(F.try_multiply(x, F.lit(n).cast("long")), s)),
        F.lit(0).cast("long"), lambda total, d: F.try_add(total, F.try_multiply(d, d)))
    described = vectors.select("__place", "key", apart.alias("deviation"))
    if not usable:
        nothing = F.array_repeat(F.lit(None).cast("double"), components)
        return Whitening(described.select("key", "deviation", nothing.alias("whitened")), n, components, explained, None)

    matrix = axes[:, :usable] / np.sqrt(values[:usable])
    projected = product(blocks, local_blocks(matrix, blocks))
    rows = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    stored = materialize(rows.select(F.col("index").alias("__place"), vector_to_array("vector").alias("whitened")), "whiten-projected")
    middle = [s / n for s in sums_of(stored, "whitened", usable)]
    again = covariance(blocks_of(stored, "whitened", middle, n), n)
    error = float(np.abs(again - np.eye(usable)).max())
    missing = F.array_repeat(F.lit(None).cast("double"), components - usable)
    joined = described.join(stored, "__place").select("key", "deviation", F.concat("whitened", missing).alias("whitened"))
    return Whitening(joined, n, components, explained, error)


def whitening_report(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    found = whiten(table, components)
    explained = F.lit(found.explained).cast("array<double>") if found.explained else F.array().cast("array<double>")
    return found.rows.select(F.col("key").alias("vec_id"), "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(found.identity_error).cast("double").alias("identity_error"))
