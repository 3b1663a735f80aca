"""Exact nearest neighbours through k-means cells with distance bounds.

Vectors are stored by cell and cut into blocks of neighbouring distance to the
cell's centre. For unit vectors the cosine follows from the distance, so
the triangle inequality bounds how near a block can come to a query: no nearer
than the query's distance to the centre less the block's largest, or the block's
smallest less the query's. Each query first compares the blocks nearest to it, which gives a
distance to beat, and then those blocks whose bound does not exceed it. Queries
are a table: they meet blocks in a join, a bounded number at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gaugeline import fixed_values as fv
from gaugeline.operators.scale import top_rows
from gaugeline.session import materialize

SAMPLE = 20_000  # vectors that the centres are fitted on; all are stored
MOST_CELLS = 1024
BLOCK = 512  # vectors of a block
QUERIES_AT_ONCE = 256
SEEDS = 4  # vectors compared first, as a multiple of k
# Similarities closer than this are a tie, broken by id.
DECIMALS = 9
# Stands for the similarity of a vector without direction; it ranks last.
NO_DIRECTION = -2.0
NO_DIRECTION_AT = 6.0 ** 0.5  # the distance that belongs to it
NO_CELL = -1
SLACK = 1e-6


@dataclass(frozen=True)
class Cells:
    """Stored cells. ``centres`` has one row a cell, ``blocks`` (block, cell, low, high, n, rows) the vectors."""

    centres: DataFrame
    blocks: DataFrame
    dimension: int


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    return F.coalesce((F.size(vector) > 0) & F.forall(
        vector, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))), F.lit(False))


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one; a row without direction stays zero."""
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances of unit rows from centres."""
    square = (rows * rows).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :] - 2 * rows @ centres.T
    return np.sqrt(np.maximum(square, 0.0))


def _matrix(column, dimension: int) -> np.ndarray:
    """An Arrow list column as a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, dimension)


def _centres(rows: DataFrame, count: int, dimension: int, cells: int | None) -> np.ndarray:
    """Centres fitted on a sample of the vectors that have a direction."""
    wanted = cells or int(min(MOST_CELLS, max(1, round(count ** 0.5))))
    share = min(1.0, SAMPLE / max(count, 1))
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double")))
    some = rows.filter(F.shiftrightunsigned(F.xxhash64("id"), 11) / float(1 << 53) < share).withColumn("length", length).filter("length > 0")
    features = materialize(some.select(F.transform("embedding", lambda c: c.cast("double") / F.col("length")).alias("v")), "cell-sample")
    if wanted < 2 or features.isEmpty():
        return np.zeros((1, dimension))  # one cell around the origin
    model = KMeans(k=wanted, seed=7, maxIter=5, initMode="random", featuresCol="f").fit(features.select(array_to_vector("v").alias("f")))
    return np.array([np.asarray(centre) for centre in model.clusterCenters()])


def store_cells(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cells: int | None = None) -> Cells:
    """Store all usable vectors by cell.

    Left out are vectors that are null, hold null, NaN or infinity, or have
    another length than most (of equally frequent lengths the longest). The
    driver gets the centres, ``MOST_CELLS`` at most.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(usable(F.col(vector_col))).select(F.col(id_col).alias("id"), F.col(vector_col).alias("embedding"))
    lengths = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    dimension, count = (lengths["d"], lengths["n"]) if lengths else (0, 0)
    rows = rows.filter(F.size("embedding") == dimension)
    centres = _centres(rows, count, dimension, cells) if count else np.zeros((1, 0))
    shared = spark.sparkContext.broadcast(centres)
    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("away", T.DoubleType())])

    def assign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        middle = shared.value
        for batch in batches:
            data = unit(_matrix(batch.column(1), dimension))
            cell, away = np.zeros(len(data), np.int32), np.zeros(len(data))
            for start in range(0, len(data), 4096):
                found = distances(data[start:start + 4096], middle)
                cell[start:start + 4096] = found.argmin(axis=1)
                away[start:start + 4096] = found.min(axis=1)
            lost = ~data.any(axis=1)
            cell[lost], away[lost] = NO_CELL, 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away)], schema.names)

    placed = materialize(rows.mapInArrow(assign, schema), "cell-vectors")
    # Neighbours in distance lie side by side; blocks are cut by running number, so no cell is ever one task.
    order = ["cell", "away", "id"]
    numbered = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    blocks = numbered.groupBy("cell", F.expr(f"at div {BLOCK}").alias("block")).agg(
        F.min("away").alias("low"), F.max("away").alias("high"), F.count("*").alias("n"),
        F.collect_list(F.struct("id", "embedding")).alias("rows"))
    stored = materialize(blocks.select(F.monotonically_increasing_id().alias("block"), "cell", "low", "high", "n", "rows"), "cell-blocks")
    sizes = stored.groupBy("cell").agg(F.sum("n").alias("n"), F.max("high").alias("radius"))
    centre_rows = spark.createDataFrame(
        [(at, [float(x) for x in centre]) for at, centre in enumerate(centres)], "cell int, centre array<double>")
    return Cells(materialize(centre_rows.join(sizes, "cell", "left").select(
        "cell", "centre", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("radius", F.lit(0.0)).alias("radius")), "cell-centres"),
        stored, dimension)


def _visits(queries: DataFrame, cells: Cells, least: int | None) -> DataFrame:
    """(query_id, cell, distance) of the cells that a query has to look into.

    With ``least`` those are the nearest cells that hold so many vectors; else
    the cells whose bound is within the query's ``reach``.
    """
    spark = queries.sparkSession
    known = cells.centres.filter("n > 0").orderBy("cell").collect()  # MOST_CELLS rows at most
    centres = np.array([row["centre"] for row in known]).reshape(len(known), cells.dimension)
    shared = spark.sparkContext.broadcast((
        centres, np.array([row["cell"] for row in known], np.int32), np.array([row["n"] for row in known]),
        np.array([row["radius"] for row in known])))
    dimension = cells.dimension
    schema = T.StructType([queries.schema["query_id"], T.StructField("cell", T.IntegerType()), T.StructField("distance", T.DoubleType())])

    def look(batches: Iterator) -> Iterator:
        import pyarrow as pa

        middle, names, sizes, radius = shared.value
        for batch in batches:
            ids, reach = batch.column(0), batch.column(2).to_numpy(zero_copy_only=False)
            data = unit(_matrix(batch.column(1), dimension))
            for start in range(0, len(data), 1024):
                part = data[start:start + 1024]
                away = distances(part, middle)
                away[~part.any(axis=1)] = 0.0  # without direction, no cell is nearer than another
                bound = np.maximum(away - radius, 0.0)
                if least is None:
                    chosen = bound <= reach[start:start + 1024, None]
                else:
                    order = np.argsort(bound, axis=1, kind="stable")
                    before = np.cumsum(sizes[order], axis=1) - sizes[order]
                    chosen = np.zeros(bound.shape, bool)
                    np.put_along_axis(chosen, order, before < least, axis=1)
                q, c = np.nonzero(chosen)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(start + q)), pa.array(names[c]), pa.array(away[q, c])], schema.names)

    return queries.select("query_id", "embedding", "reach").mapInArrow(look, schema)


def _bound() -> Column:
    """How near a block can be to a query, from their distances to the cell's centre."""
    return F.greatest(F.lit(0.0), F.col("low") - F.col("distance"), F.col("distance") - F.col("high"))


def _compare(pairs: DataFrame, queries: DataFrame, cells: Cells, chunks: int, k: int) -> DataFrame:
    """(query_id, id, similarity): the ``k`` best rows of each block for each query that visits it."""
    schema = T.StructType([
        queries.schema["query_id"], T.StructField("id", cells.blocks.schema["rows"].dataType.elementType["id"].dataType),
        T.StructField("similarity", T.DoubleType())])
    dimension, decimals, no_direction = cells.dimension, DECIMALS, NO_DIRECTION
    asked = pairs.select("query_id", "block").join(queries.select("query_id", "embedding"), "query_id")
    # A bounded number of queries for each block: the hash deals them to chunks.
    grouped = asked.groupBy("block", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).alias("chunk")).agg(
        F.collect_list(F.struct("query_id", "embedding")).alias("queries"))

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for rows, some in zip(batch.column(0), batch.column(1)):
                rows, some = rows.values, some.values
                ids = rows.field("id")
                close = np.round(unit(_matrix(some.field("embedding"), dimension)) @ unit(_matrix(rows.field("embedding"), dimension)).T, decimals)
                lost = ~_matrix(rows.field("embedding"), dimension).any(axis=1)
                close[:, lost] = no_direction
                close[~_matrix(some.field("embedding"), dimension).any(axis=1)] = no_direction
                rank = np.argsort(np.argsort(ids.to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
                best = np.lexsort((np.broadcast_to(rank, close.shape), -close), axis=1)[:, :k]
                q = np.repeat(np.arange(len(close)), best.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [some.field("query_id").take(pa.array(q)), ids.take(pa.array(best.ravel())), pa.array(close[q, best.ravel()])],
                    schema.names)

    met = cells.blocks.select("block", "rows").join(grouped, "block").select("rows", "queries")
    return met.mapInArrow(scan, schema)


def _search(cells: Cells, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The hits, and the pairs of query and block that were compared."""
    asked = materialize(queries.filter(usable(F.col("embedding")) & (F.size("embedding") == cells.dimension)).select(
        "query_id", "embedding", F.lit(4.0).alias("reach")), "cell-queries")
    count = asked.count()
    chunks = max(1, -(-count // QUERIES_AT_ONCE))
    heads = cells.blocks.select("block", "cell", "low", "high", "n")
    near = _visits(asked, cells, SEEDS * k).join(heads, "cell").withColumn("bound", _bound())
    first = Window.partitionBy("query_id").orderBy("bound", "block").rowsBetween(Window.unboundedPreceding, -1)
    seeds = materialize(near.withColumn("before", F.coalesce(F.sum("n").over(first), F.lit(0))).filter(
        F.col("before") < SEEDS * k).select("query_id", "block"), "cell-seeds")
    found = top_rows(_compare(seeds, asked, cells, chunks, k), ["query_id"], [F.desc("similarity"), F.col("id")], k)
    last = found.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("similarity")).alias("last"))
    # Without k rows yet, everything is in reach.
    reach = F.when(F.col("last").isNull(), F.lit(4.0)).otherwise(F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * (F.col("last") - 2e-9))) + SLACK)
    reaching = materialize(asked.drop("reach").join(last, "query_id", "left").select("query_id", "embedding", reach.alias("reach")), "cell-reach")
    # Vectors without direction have no cell; they count as farther than any other.
    visits = _visits(reaching, cells, None).unionByName(
        reaching.select("query_id", F.lit(NO_CELL).alias("cell"), F.lit(0.0).alias("distance")))
    bound = F.when(F.col("cell") == NO_CELL, F.lit(NO_DIRECTION_AT)).otherwise(_bound())
    needed = materialize(visits.join(heads, "cell").join(reaching.select("query_id", "reach"), "query_id").filter(
        bound <= F.col("reach")).select("query_id", "block", "n"), "cell-visits")
    hits = top_rows(_compare(needed, asked, cells, chunks, k), ["query_id"], [F.desc("similarity"), F.col("id")], k)
    return hits, needed


def nearest_in_cells(cells: Cells, queries: DataFrame, k: int = fv.SEMANTIC_SIZE) -> DataFrame:
    """The ``k`` rows nearest to every query of (query_id, embedding), by cosine: the same as comparing all.

    Returns (query_id, id, similarity, rank); ties go by id. A query whose
    vector is not usable or has another length than the stored ones has no rows; one without
    direction is equally far from all. Query ids are unique.
    """
    return _search(cells, queries, k)[0]


def compared_vectors(cells: Cells, queries: DataFrame, k: int = fv.SEMANTIC_SIZE) -> DataFrame:
    """(query_id, compared, vectors): how many stored vectors each query is compared with, and how many there are."""
    needed = _search(cells, queries, k)[1]
    every = cells.blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return needed.groupBy("query_id").agg(F.sum("n").alias("compared"), F.lit(every).cast("long").alias("vectors"))
