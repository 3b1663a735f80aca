import os
from collections import Counter

import duckdb

import corpus_pipeline
from gaugeline.llm import quality
from gaugeline.session import new_table_path
from tests.llm.corpora import TABLES, frame, odd_rows, plain_words
from tests.llm.test_language_id import guesses
from tests.llm.test_mixing import targets_by_rounds
from tests.llm.test_packing import check


def classes(docs, size=5, percent=80):
    """Connected components of the documents whose sets of word shingles are alike, by comparing all pairs."""
    sets = {}
    for doc_id, text in docs:
        words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in plain_words(text)]
        runs = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
        sets[doc_id] = runs or ({tuple(words)} if words else set())
    root = {doc_id: doc_id for doc_id in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for at, one in enumerate(ids):
        for other in ids[at + 1:]:
            both = len(sets[one] & sets[other])
            if both and 100 * both >= percent * (len(sets[one]) + len(sets[other]) - both):
                low, high = sorted((top(one), top(other)))
                root[high] = low
    return {doc_id: top(doc_id) for doc_id in ids}


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "near_dedup", "source_mix", "best_fit_packing"]


def test_each_stage_equals_brute_force_on_what_the_one_before_kept(spark, tmp_path):
    docs = given = spark.read.parquet(f"{TABLES}/documents.parquet")
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, TABLES).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        before = docs.select("doc_id", "text", "lang", "source").collect()
        ids = Counter(r["doc_id"] for r in after.select("doc_id").collect())
        if name == "quality_rules":
            con = duckdb.connect()
            con.execute(f"CREATE VIEW documents AS SELECT * FROM '{TABLES}/documents.parquet'")
            assert ids == Counter(row[0] for row in con.execute(f"SELECT doc_id FROM ({quality.SQL}) WHERE kept").fetchall())
        elif name == "language_id":
            found = guesses([(r["doc_id"], r["text"], r["lang"]) for r in before])
            assert ids == Counter(i for i, (lang, score) in found.items() if lang != "und" and score >= 0.5)
        elif name == "near_dedup":
            assert ids == Counter(set(classes([(r["doc_id"], r["text"]) for r in before]).values()))
        elif name == "source_mix":
            words, largest, texts = Counter(), Counter(), {}
            for r in before:
                size = len(plain_words(r["text"]))
                texts[r["doc_id"]] = (r["text"], r["source"], size)
                words[r["source"]] += size
                largest[r["source"]] = max(largest[r["source"]], size)
            taken = Counter()
            for r in after.collect():
                assert (r["text"], r["source"]) == texts[r["doc_id"]][:2]
                taken[r["source"]] += texts[r["doc_id"]][2]
            assert max(ids.values()) <= 3
            for source, target in targets_by_rounds(words).items():
                assert abs(taken[source] - target) <= largest[source] / 2 + 1e-6
        elif name == "best_fit_packing":
            texts = {}
            for r in before:
                texts.setdefault(r["doc_id"], []).append(r["text"])
            check(after.collect(), texts, 1024)
        if place < 4:
            assert after.columns == given.columns and after.count() > 0
        docs = after


def test_run_on_the_table(spark):
    folder = os.path.dirname(new_table_path(spark, "x"))
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    rows = corpus_pipeline.run(spark, TABLES)
    # What is left are the stages' results.
    assert sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before) == sorted(f"pipeline-{name}" for name, _ in corpus_pipeline.STAGES)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 0


def test_stages_on_odd_and_empty_tables(spark):
    docs = frame(spark, odd_rows())
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, TABLES).count()
        assert stage(spark, docs.limit(0), TABLES).count() == 0
