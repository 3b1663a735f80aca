"""Exact nearest neighbours by cosine, and embedding of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import fixed_values as fv
from gaugeline.functions.text import counted, let, words
from gaugeline.operators.cells import nearest_in_cells, store_cells


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = fv.SEMANTIC_SIZE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``nearest_in_cells`` over vectors that are stored in cells for this search.

    Keep the cells (``store_cells``) to search the same vectors many times.
    Returns (query_id, id, similarity, rank).
    """
    return nearest_in_cells(store_cells(vectors, id_col, vector_col), queries, k)


def indicator_text(code: Column, name: Column, category: Column, description: Column) -> Column:
    """Text of an indicator for embedding; the description only if there is one."""
    head = F.concat(code, F.lit(" - "), name, F.lit(" - Category: "), category)
    return F.when(F.length(description) > 0, F.concat(head, F.lit(" - "), description)).otherwise(head)


def chunk_text(title: Column, text: Column) -> Column:
    """Text of a document chunk for embedding."""
    return F.concat(F.lit("Title: "), title, F.lit("\nContent: "), text)


def embedding_rows(embedded: DataFrame, source_type: str, source_id: str, metadata: list[str]) -> DataFrame:
    """Rows for the embeddings table from embedded texts, their columns kept as JSON."""
    return embedded.select(
        F.lit(source_type).alias("source_type"), F.col(source_id).cast("string").alias("source_id"), "text", "embedding",
        F.to_json(F.struct(*metadata)).alias("metadata"), F.current_timestamp().alias("created_at"))


def embed_with(
    df: DataFrame, embedder: Callable[[list[str]], list[list[float]]], text_col: str = "text",
    batch_size: int = fv.EMBED_BATCH,
) -> DataFrame:
    """Add ``embedding`` computed by a user function over batches of texts."""
    schema = T.StructType([*df.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            texts = batch[text_col].tolist()
            vectors: list = []
            for start in range(0, len(texts), batch_size):
                vectors.extend(embedder(texts[start:start + batch_size]))
            yield batch.assign(embedding=vectors)

    return df.mapInPandas(run, schema)


def embed_hashed(df: DataFrame, text_col: str = "text", dimension: int = 256) -> DataFrame:
    """Add ``embedding``: word counts hashed into ``dimension`` slots, unit length.

    The slot of a word is the first 32 bits of its md5, modulo ``dimension``; a
    text without words has all zeros. The default embedder, used where no model is given.
    """
    slot = lambda w: F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("long") % dimension

    def zeros(n: Column) -> Column:
        return F.array_repeat(F.lit(0.0).cast("float"), n.cast("int"))

    def unit(counts: Column) -> Column:
        length = F.sqrt(F.aggregate(counts, F.lit(0.0), lambda total, c: total + c["tf"] * c["tf"]))

        # The slots ascend: each one follows the zeros since the one before, so the work grows with words and slots.
        def filled(length: Column) -> Column:
            return F.concat(F.flatten(F.transform(counts, lambda c, n: F.array_append(
                zeros(c["word"] - F.coalesce(F.get(counts, n - 1)["word"], F.lit(-1)) - 1), (c["tf"] / length).cast("float")))),
                zeros(dimension - 1 - F.element_at(counts, -1)["word"]))

        return F.coalesce(let(length, filled), zeros(F.lit(dimension)))

    return df.withColumn("embedding", let(counted(F.transform(words(F.col(text_col)), slot)), unit))
