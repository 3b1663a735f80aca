import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from gaugeline.llm.token_files import file_report, read_token_files, token_report, write_token_files
from tests.llm.corpora import TABLES, frame, odd_rows


def expected(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, found = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: r[1])


def test_round_trip(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").repartition(7)
    assert ordered(token_report(docs).collect()) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(spark):
    # The added tokens of rows 2 and 10 are one id each, which moves the start of every later document.
    rows = [*odd_rows(), (2, "a <|endoftext|> b", "en", "a"), (10, "<|startoftext|>x<|ENDOFTEXT|>", "en", "a")]
    docs = frame(spark, rows, 4)
    assert ordered(token_report(docs).collect()) == expected([(i, t) for i, t, *_ in rows])
    assert token_report(docs.limit(0)).collect() == []


def test_look_up_by_id_is_pushed_down(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    write_token_files(docs, str(tmp_path / "out"))
    some = read_token_files(spark, str(tmp_path / "out"), [3, 77, -1])
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString()
    assert sorted(r["doc_id"] for r in some.collect()) == [3, 77]
    stored = read_token_files(spark, str(tmp_path / "out")).orderBy("shard", "place").collect()
    assert [r["doc_id"] for r in stored] == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    assert file_report(spark, str(tmp_path / "out")).count() == docs.count()
