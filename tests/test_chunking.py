"""The chunker against a plain character-by-character account of its rules."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import chunking


def expected_pieces(text, limit):
    import re

    out = []
    for block in re.split(r"\n\s*\n+|\r\n\s*\r\n+", text):
        block = block.strip()
        if 0 < len(block) <= limit:
            out.append(block)
        elif block:
            marked = re.sub(r"([.!?])\s+", "\\1\0", block).replace("\n", "\0")
            for sentence in filter(None, (s.strip() for s in marked.split("\0"))):
                while sentence:
                    out.append(sentence[:limit])
                    sentence = sentence[limit:]
    return out


def expected_chunks(text, size, overlap):
    done, current = [], None
    for piece in expected_pieces(text, size):
        if current is None:
            current = piece
        elif len(current + "\n\n" + piece) <= size:
            current += "\n\n" + piece
        else:
            done.append(current)
            keep = len(current) > overlap > 0 and len(piece) + overlap + 2 <= size
            current = (current[len(current) - overlap:] + "\n\n" if keep else "") + piece
    return done if current is None else [*done, current]


def random_text(rng):
    parts = []
    for _ in range(rng.randint(0, 12)):
        words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 30))) for _ in range(rng.randint(1, 25))]
        parts.append(" ".join(words) + rng.choice([".", "!", "", "?  "]))
        parts.append(rng.choice(["\n\n", "\n \n\n", " ", "\n", "\r\n\r\n", "  "]))
    return "".join(parts)


@pytest.mark.parametrize("size, overlap", [(60, 10), (60, 0), (200, 50), (1500, 200)])
def test_random_texts(spark, size, overlap):
    rng = random.Random(size + overlap)
    texts = [(i, random_text(rng)) for i in range(150)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {}
    for row in chunking.chunk_documents(df, size=size, overlap=overlap).orderBy("doc_id", "chunk_index").collect():
        got.setdefault(row["doc_id"], []).append((row["chunk_index"], row["text"], row["chunk_id"]))
    for doc_id, text in texts:
        wanted = [
            (i, c, hashlib.md5(f"{doc_id}\0{i}\0{c}".encode()).hexdigest())
            for i, c in enumerate(expected_chunks(text, size, overlap))]
        assert got.get(doc_id, []) == wanted


@pytest.mark.parametrize("block", [1, 3])
def test_chunks_do_not_depend_on_the_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(chunking, "BOUND_BLOCK", block)
    rng = random.Random(5)
    texts = [(i, random_text(rng)) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {}
    for row in chunking.chunk_documents(df, size=90, overlap=60).orderBy("doc_id", "chunk_index").collect():
        got.setdefault(row["doc_id"], []).append(row["text"])
    assert got == {i: c for i, text in texts if (c := expected_chunks(text, 90, 60))}


@pytest.mark.parametrize("line", ["é" * 37 + ". ", "word and more words here.\n"])
def test_very_long_text(spark, line):
    text = line * (2_000_000 // len(line))
    rows = chunks_of(spark, text)
    assert [r["text"] for r in rows] == expected_chunks(text, 1500, 200)


def chunks_of(spark, *texts):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_id string, text string")
    return chunking.chunk_documents(df).orderBy("doc_id", "chunk_index").collect()


def test_empty_and_short(spark):
    assert chunks_of(spark, "", "  \n\n  ") == []
    assert [r["text"] for r in chunks_of(spark, "short")] == ["short"]


def test_long_single_paragraph_is_cut(spark):
    lengths = [len(r["text"]) for r in chunks_of(spark, "x" * 4000)]
    assert lengths == [1500, 1500, 1202]


def test_repeated_text_gets_distinct_ids(spark):
    paragraph = "p" * 1400
    rows = chunks_of(spark, "\n\n".join([paragraph] * 3), "\n\n".join([paragraph] * 3))
    assert len({r["chunk_id"] for r in rows}) == len(rows) == 6


def test_statistics_and_coverage(spark):
    df = spark.createDataFrame([("a", "one"), ("b", ""), ("c", None)], "doc_id string, text string")
    assert tuple(chunking.text_coverage(df).first()) == (1, 3)
    stats = chunking.chunk_statistics(chunking.chunk_documents(df), approximate=True).first()
    assert (stats["n_chunks"], stats["n_ids"], stats["min_chars"]) == (1, 1, 3)
    assert chunking.chunk_documents(df.withColumn("lang", F.lit("en"))).columns == [
        "chunk_id", "chunk_index", "text", "doc_id", "lang"]
