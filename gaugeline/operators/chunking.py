"""Splitting documents into overlapping chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv
from gaugeline.functions.text import let, paragraphs, sentences, slices

JOIN_CHARS = len(fv.PARAGRAPH_JOIN)
# Pieces that one inner fold of `chunk_bounds` goes over; any number gives the same chunks.
BOUND_BLOCK = 512


def text_pieces(text: Column, limit: int = fv.CHUNK_SIZE) -> Column:
    """Pieces of at most ``limit`` characters.

    A paragraph that fits stays whole; a longer one is cut into sentences and
    lines, and a longer sentence into slices.
    """

    def cut_sentence(sentence: Column) -> Column:
        return F.when(F.length(sentence) <= limit, F.array(sentence)).otherwise(
            slices(sentence, limit))

    def cut_paragraph(paragraph: Column) -> Column:
        cut = F.flatten(F.transform(sentences(paragraph), cut_sentence))
        return F.when(F.length(paragraph) <= limit, F.array(paragraph)).otherwise(cut)

    return F.flatten(F.transform(paragraphs(text), cut_paragraph))


def chunk_bounds(widths: Column, size: int, overlap: int) -> Column:
    """Where chunks begin, as structs (start, tail) of piece numbers from 1.

    ``start`` is a chunk's first own piece. ``tail`` is 0, or the piece from
    which on the last ``overlap`` characters before ``start`` are found.

    A fold copies its state at every step, so the state must stay small: an
    inner fold goes over ``BOUND_BLOCK`` widths at a time, and the outer one
    gathers what the blocks found.
    """
    none = F.array().cast("array<struct<start:int,tail:int>>")
    fresh = {"width": F.lit(0), "own": F.lit(0), "start": F.lit(0), "source": F.lit(0), "at": F.lit(0)}

    def state(found: Column, **values: Column) -> Column:
        return F.struct(found.alias("found"), *[values[name].alias(name) for name in fresh])

    def step(s: Column, piece: Column) -> Column:
        at = s["at"] + 1
        joined = s["width"] + JOIN_CHARS + piece
        carries = (F.lit(overlap) > 0) & (s["width"] > overlap) & (piece + JOIN_CHARS + overlap <= size)
        # What is carried reaches back beyond a chunk's own pieces only if these are shorter than it.
        source = F.when(s["own"] >= overlap, s["start"]).otherwise(s["source"])

        def begin(tail: Column, width: Column, source: Column) -> Column:
            found = F.array_append(s["found"], F.struct(at.alias("start"), tail.alias("tail")))
            return state(found, width=width, own=piece, start=at, source=source, at=at)

        return (
            F.when((s["width"] > 0) & (joined <= size), state(
                s["found"], width=joined, own=s["own"] + JOIN_CHARS + piece, start=s["start"], source=s["source"], at=at))
            .when(carries, begin(source, piece + JOIN_CHARS + overlap, source))
            .otherwise(begin(F.lit(0), piece, at))
        )

    def block(s: Column, part: Column) -> Column:
        last = F.aggregate(part, state(none, **{name: s[name] for name in fresh}), step)
        return let(last, lambda x: state(
            F.concat(s["found"], x["found"]), **{name: x[name] for name in fresh}))

    blocks = let(widths, lambda w: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0)), F.lit(BOUND_BLOCK)),
        lambda i: F.slice(w, i + 1, F.lit(BOUND_BLOCK))))
    return F.aggregate(blocks, state(none, **fresh), block, lambda s: s["found"])


def pack_pieces(pieces: Column, size: int = fv.CHUNK_SIZE, overlap: int = fv.CHUNK_OVERLAP) -> Column:
    """Greedily join pieces into chunks of at most ``size`` characters.

    A chunk that is closed leaves its last ``overlap`` characters at the head
    of the next one, if it is longer than that and the next piece still fits
    behind them. The work grows in proportion to the text.
    """

    def cut(p: Column, bounds: Column) -> Column:
        def joined(first: Column, end: Column) -> Column:
            return F.array_join(F.slice(p, first, end - first), fv.PARAGRAPH_JOIN)

        def chunk(b: Column, i: Column) -> Column:
            own = joined(b["start"], F.coalesce(F.get(bounds, i + 1)["start"], F.size(p) + 1))
            tail = F.right(joined(b["tail"], b["start"]), F.lit(overlap))
            return F.when(b["tail"] > 0, F.concat(tail, F.lit(fv.PARAGRAPH_JOIN), own)).otherwise(own)

        return F.transform(bounds, chunk)

    return let(pieces, lambda p: let(
        chunk_bounds(F.transform(p, F.length), size, overlap), lambda bounds: cut(p, bounds)))


def chunk_id(doc_id: Column, index: Column, text: Column) -> Column:
    """Hash of document, position and text, so equal boilerplate keeps distinct ids."""
    nul = F.char(F.lit(0))
    return F.md5(F.concat(doc_id.cast("string"), nul, index.cast("string"), nul, text))


def chunk_documents(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = fv.CHUNK_SIZE,
    overlap: int = fv.CHUNK_OVERLAP,
) -> DataFrame:
    """One row per chunk, with the other document columns carried along.

    Everything happens within the row of a document: no shuffle.
    """
    chunks = pack_pieces(text_pieces(F.col(text), size), size, overlap)
    carried = [c for c in documents.columns if c not in (doc_id, text)]
    exploded = documents.select(doc_id, *carried, F.posexplode(chunks).alias("chunk_index", "text"))
    return exploded.select(
        chunk_id(F.col(doc_id), F.col("chunk_index"), F.col("text")).alias("chunk_id"),
        F.col("chunk_index").cast("long").alias("chunk_index"),
        "text", doc_id, *carried,
    )


def chunk_statistics(chunks: DataFrame, approximate: bool = False) -> DataFrame:
    """Count, distinct ids and lengths over all chunks.

    Exact distinct counts shuffle every id; ``approximate=True`` keeps a sketch
    instead.
    """
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    return chunks.agg(
        F.count("*").alias("n_chunks"),
        distinct("chunk_id").alias("n_ids"),
        distinct("doc_id").alias("n_docs"),
        F.min(F.length("text")).alias("min_chars"),
        F.avg(F.length("text")).alias("mean_chars"),
        F.max(F.length("text")).alias("max_chars"),
    )


def text_coverage(documents: DataFrame, text: str = "text") -> DataFrame:
    """Documents with text against all documents."""
    return documents.agg(
        F.count_if(F.length(text) > 0).alias("n_with_text"), F.count("*").alias("n_docs"))
