"""Token ids of documents in ORC files, in ascending id order.

A file holds a range of ids, one row for each document with its ids as an
integer array. ORC run-length encodes the integers, keeps row indexes within
each stripe and a Bloom filter on doc_id, so readers take stripes side by side
and a look-up of ids skips files, stripes and row groups by metadata alone.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm.ranges import parts_of, pivots, range_of
from gaugeline.llm.tokens import encoder
from gaugeline.session import new_table_path

END_ID = 1
ROWS_AT_ONCE = 64
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(32 << 20),
}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write_token_files(docs: DataFrame, out: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Write shard, place, doc_id, n_tokens, before (ids of the shard's documents before it) and input_ids.

    Texts are dealt to ranges of doc_id (ties by text), sorted within a range
    and encoded as they stream by. A null or empty text has the end id only.
    """
    path = path or default_tokenizer()
    parts = parts_of(docs)
    cuts = pivots(docs, "doc_id", parts)
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    ordered = (
        docs.select(range_of(F.col("doc_id"), cuts).alias("shard"), "doc_id", "text")
        .repartitionById(parts, F.col("shard")).sortWithinPartitions("shard", "doc_id", "text"))

    def run(batches):
        encode = encoder(path, False).encode
        end = end_id.to_bytes(4, "little")
        place, before = 0, 0
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(low, ROWS_AT_ONCE)
                ids = [encode(text or "") + end for text in some.column(2).to_pylist()]
                counts = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(np.arange(place, place + len(ids))), some.column(1), pa.array(counts),
                     pa.array(before + ends - counts),
                     pa.ListArray.from_arrays(
                         pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), "<i4")))],
                    ["shard", "place", "doc_id", "n_tokens", "before", "input_ids"])
                place += len(ids)
                before += int(ends[-1])

    ordered.mapInArrow(
        run, f"shard int, place bigint, doc_id {doc_type}, n_tokens bigint, before bigint, input_ids array<int>"
    ).write.options(**ORC_OPTIONS).orc(out)


def read_token_files(spark: SparkSession, out: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The stored rows; with ``doc_ids`` only those, skipping what the indexes and Bloom filters rule out."""
    rows = spark.read.orc(out)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def file_report(spark: SparkSession, out: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document, from the files alone."""
    stored = read_token_files(spark, out)
    # One row for each shard; a shard's start is the sum of those before it.
    sizes = sorted((row["shard"], row["n"]) for row in stored.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    starts, total = {}, 0
    for shard, size in sizes:
        starts[shard] = total
        total += size

    def run(batches):
        for batch in batches:
            lists = batch.column(4)
            flat = np.asarray(lists.values, dtype="<i4")
            places = np.asarray(lists.offsets)
            crc = [zlib.crc32(flat[low:high]) for low, high in zip(places[:-1], places[1:], strict=True)]
            start = [starts[s] for s in batch.column(0).to_pylist()] + np.asarray(batch.column(2))
            counts = np.diff(places).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(start.astype(np.int64)), pa.array(counts), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    doc_type = stored.schema["doc_id"].dataType.simpleString()
    return stored.select("shard", "doc_id", "before", "n_tokens", "input_ids").mapInArrow(
        run, f"doc_id {doc_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_report(docs: DataFrame) -> DataFrame:
    """Encode, write to the shared folder, and report from the files.

    Rows that share a doc_id are documents of their own, in the order of their
    texts; a null doc_id comes first. Extra columns are not read; an empty
    table gives an empty result.
    """
    out = new_table_path(docs.sparkSession, "token-files")
    write_token_files(docs, out)
    return file_report(docs.sparkSession, out)
