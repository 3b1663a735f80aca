"""Best-two-fit packing of tokenised documents into sequences of equal capacity.

Only the histogram of piece lengths decides the packing, so the plan is made
from at most ``capacity`` counts, whatever the number of documents: a sequence
is filled greedily with the longest piece that fits; then its smallest piece
gives way to two unpacked ones that fill the gap more tightly. A filling that
can be repeated is taken as often as its pieces last, which is what packing one
sequence after another would do. Pieces find their place by their rank among
the pieces of their length, counted per task and summed over tasks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeline.llm.tokens import encoder
from gaugeline.session import materialize

CAPACITY = 1024
END_ID = 2


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _tightest_pair(lengths: np.ndarray, counts: np.ndarray, above: int, most: int) -> tuple[int, int] | None:
    """Two available lengths (ascending ``lengths``) with the largest sum in (above, most]."""
    if len(lengths) == 0:
        return None
    place = np.searchsorted(lengths, most - lengths, "right") - 1
    same = (place == np.arange(len(lengths))) & (counts < 2)
    place = np.where(same, place - 1, place)
    sums = np.where(place >= 0, lengths + lengths[place], 0)
    sums[sums > most] = 0
    best = int(sums.argmax())
    if sums[best] <= above:
        return None
    return int(lengths[best]), int(lengths[place[best]])


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: how often}) of every filling, until no piece is left."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        left[length] = count
    fillings = []
    while True:
        lengths = np.flatnonzero(left)
        if len(lengths) == 0:
            return fillings
        used: dict[int, int] = {}
        gap = capacity
        while gap:  # greedily: the longest that fits
            fitting = [x for x in lengths[:np.searchsorted(lengths, gap, "right")][::-1][:len(used) + 1] if left[x] > used.get(int(x), 0)]
            if not fitting:
                break
            length = int(fitting[0])
            count = int(min(gap // length, left[length] - used.get(length, 0)))
            used[length] = used.get(length, 0) + count
            gap -= count * length
        while gap:  # two for the smallest
            smallest = min(used)
            free = left.copy()
            for length, count in used.items():
                free[length] -= count
            open_lengths = np.flatnonzero(free)
            pair = _tightest_pair(open_lengths, free[open_lengths], smallest, gap + smallest)
            if pair is None:
                break
            used[smallest] -= 1
            if not used[smallest]:
                del used[smallest]
            for length in pair:
                used[length] = used.get(length, 0) + 1
            gap += smallest - sum(pair)
        times = min(int(left[length]) // count for length, count in used.items())
        for length, count in used.items():
            left[length] -= times * count
        fillings.append((times, used))


def tokenised_pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, task, nth (among the task's pieces of that length).

    A document longer than ``capacity`` is cut so that only its first piece may
    be shorter.
    """

    def run(batches):
        encode = encoder(path, True).encode
        end = end_id.to_bytes(4, "little")
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows, piece, start, length, crc, nth = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "") + end
                size = len(ids) // 4
                low, place = 0, 0
                while low < size:
                    high = min(low + (size % capacity if low == 0 and size % capacity else capacity), size)
                    rows.append(row)
                    piece.append(place)
                    start.append(low)
                    length.append(high - low)
                    crc.append(zlib.crc32(memoryview(ids)[4 * low:4 * high]))
                    nth.append(seen[high - low])
                    seen[high - low] += 1
                    low, place = high, place + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(rows), pa.int32()),
                 pa.array(nth, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {doc_type}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, nth bigint")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece, the end id. Rows that share a doc_id are
    documents of their own, each with pieces from 0. Extra columns are not
    read; an empty table gives an empty result.
    """
    # Tokens are counted and then forgotten; what is stored is one narrow row for each piece.
    pieces = materialize(tokenised_pieces(docs, path or default_tokenizer(), capacity, end_id), "pieces")
    counted = materialize(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {int(row["length"]): int(row["n"]) for row in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}

    first_rank = dict.fromkeys(histogram, 0)
    sequence, slots = 0, []
    for times, filling in plan(histogram, capacity):
        offset = 0
        for length, count in sorted(filling.items(), reverse=True):
            slots.append((length, first_rank[length], sequence, count, offset))
            first_rank[length] += times * count
            offset += count * length
        sequence += times
    table = np.array(sorted(slots), dtype=np.int64).reshape(-1, 5)

    def place(batches):
        # Rows of one length are together, in the order of their first rank.
        by_length = {int(x): table[table[:, 0] == x] for x in np.unique(table[:, 0])}
        for batch in batches:
            length, rank = np.asarray(batch.column(3)), np.asarray(batch.column(5))
            sequence_id, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length):
                own, rows = by_length[int(value)], np.flatnonzero(length == value)
                slot = own[np.searchsorted(own[:, 1], rank[rows], "right") - 1]
                inside = rank[rows] - slot[:, 1]
                sequence_id[rows] = slot[:, 2] + inside // slot[:, 3]
                offset[rows] = slot[:, 4] + inside % slot[:, 3] * value
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence_id), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    earlier = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    before = counted.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    # The counts grow with the tasks, so they are not broadcast.
    return pieces.join(before.hint("merge"), ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")
    ).mapInArrow(place, f"doc_id {doc_type}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
