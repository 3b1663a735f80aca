"""A stored index gives the rows of a full search, reads less, and follows changes of the corpus."""

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import scale, search, stored_index
from gaugeline.plans import adapt

SF = "/root/testdata/sf0.001"
FIELDS = [("text", 1.0, "text")]
MIXED = [("title", 3.0, "text"), ("code", 2.0, "keyword"), ("body", 1.0, "text")]
WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "common", "common", "common"]


def found(df):
    return sorted(tuple(r) for r in df.select("query_id", "id", "score", "rank").collect())


def corpus(spark, count, seed=1):
    """Rows of random words, some of them null, empty or equal."""
    import random

    chance, rows = random.Random(seed), []
    for i in range(count):
        body = " ".join(chance.choices(WORDS, k=chance.randint(1, 30)))
        rows.append((f"r{i:05d}", chance.choice([None, "", "Alpha report", body[:20]]), f"C{i % 7}", body if i % 11 else "same words"))
    return spark.createDataFrame(rows, "id string, title string, code string, body string").repartition(5)


def asked(spark):
    return spark.createDataFrame(
        [(1, "alpha common"), (2, "C3"), (3, "rare"), (4, "comon epsilom zeta"), (5, ""), (6, None), (7, " ".join(WORDS)), (8, "same words")],
        "query_id int, query string")


@pytest.mark.parametrize("fuzzy", [False, True])
def test_equals_a_full_search(spark, tmp_path, fuzzy):
    rows, queries = corpus(spark, 900), asked(spark)
    stored_index.write_index(rows, str(tmp_path / "i"), "id", MIXED)
    for k in (1, 7, 2000):
        expected = found(search.search(rows, queries, "id", MIXED, k=k, fuzzy=fuzzy))
        assert found(stored_index.search_stored(spark, str(tmp_path / "i"), queries, k, fuzzy)) == expected and expected


def test_changes_equal_an_index_of_the_changed_corpus(spark, tmp_path):
    folder, queries = str(tmp_path / "i"), asked(spark)
    rows = corpus(spark, 300).cache()
    number = F.substring("id", 2, 9).cast("int")
    stored_index.write_index(rows.filter(number < 200), folder, "id", MIXED)
    stored_index.add_rows(rows.filter(number >= 150).withColumn("body", F.concat(F.coalesce("body", F.lit("")), F.lit(" alpha rare"))), folder)
    stored_index.delete_rows(rows.filter(number % 4 == 0), folder)
    stored_index.delete_rows(spark.createDataFrame([("nobody",), (None,)], "id string"), folder)
    changed = rows.withColumn("body", F.when(number >= 150, F.concat(F.coalesce("body", F.lit("")), F.lit(" alpha rare"))).otherwise(
        F.col("body"))).filter(number % 4 != 0)
    expected = found(search.search(changed, queries, "id", MIXED, k=9))
    assert found(stored_index.search_stored(spark, folder, queries, 9)) == expected
    before = len(stored_index.read_manifest(spark, folder)["segments"])
    stored_index.merge_segments(spark, folder)
    assert before == 4 and len(stored_index.read_manifest(spark, folder)["segments"]) == 1
    assert found(stored_index.search_stored(spark, folder, queries, 9)) == expected


def test_most_postings_are_left_out(spark, tmp_path):
    """A word of nearly every row and rare ones: only blocks that can reach the k-th score are scored."""
    rows = spark.range(20_000).select(
        F.format_string("d%06d", "id").alias("id"),
        F.concat_ws(" ", F.expr("repeat('common ', cast(1 + pmod(hash(id), 5) as int))"), F.concat(F.lit("w"), F.pmod(F.hash("id", F.lit(3)), F.lit(300)).cast("string")),
                    F.expr("repeat('filler ', cast(pmod(hash(id, 9), 40) as int))")).alias("text"))
    queries = spark.createDataFrame([(i, f"common w{i} filler") for i in range(40)], "query_id int, query string")
    folder = str(tmp_path / "i")
    stored_index.write_index(rows, folder, "id", FIELDS)
    assert found(stored_index.search_stored(spark, folder, queries, 10, False)) == found(search.search(rows, queries, "id", FIELDS, 10, False))
    report = stored_index.scored_postings(spark, folder, queries, 10, False).agg(F.sum("scored").alias("s"), F.sum("postings").alias("p")).first()
    assert report["p"] > 1_000_000 and report["s"] < 0.5 * report["p"]


def test_documents_score_less_than_half(spark):
    folder = adapt.document_index(spark, "/root/testdata/sf0.01")
    queries = spark.read.parquet(f"{SF}/benchmark.parquet").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    report = stored_index.scored_postings(spark, folder, queries, 10, False).agg(F.sum("scored").alias("s"), F.sum("postings").alias("p")).first()
    print("scored", report["s"], "of", report["p"])
    assert 0 < report["s"] < 0.5 * report["p"]


def test_empty_corpus_queries_and_repeated_ids(spark, tmp_path):
    none = corpus(spark, 1).limit(0)
    stored_index.write_index(none, str(tmp_path / "a"), "id", MIXED)
    assert found(stored_index.search_stored(spark, str(tmp_path / "a"), asked(spark))) == []
    stored_index.add_rows(corpus(spark, 30), str(tmp_path / "a"))
    assert found(stored_index.search_stored(spark, str(tmp_path / "a"), asked(spark), 5)) == found(
        search.search(corpus(spark, 30), asked(spark), "id", MIXED, 5))
    assert found(stored_index.search_stored(spark, str(tmp_path / "a"), asked(spark).limit(0))) == []
    repeated = corpus(spark, 20).unionByName(corpus(spark, 20)).unionByName(corpus(spark, 1).withColumn("id", F.lit(None).cast("string")))
    stored_index.write_index(repeated, str(tmp_path / "b"), "id", MIXED)
    assert found(stored_index.search_stored(spark, str(tmp_path / "b"), asked(spark), 5)) == found(
        search.search(corpus(spark, 20), asked(spark), "id", MIXED, 5))
    with pytest.raises(FileExistsError):
        stored_index.write_index(none, str(tmp_path / "b"), "id", MIXED)


def test_rows_in_reach_of_many_queries_are_dealt_by_their_scores(spark, tmp_path, monkeypatch):
    """Equal rows that every query asks for count once for each query and row, in the blocks and in the final scores."""
    counts = []
    monkeypatch.setattr(stored_index, "deal_by", lambda df, keys, n, per=50: counts.append(n) or scale.deal_by(df, keys, n, 50))
    rows = spark.createDataFrame([(i, "same words") for i in range(40)], "id long, text string")
    queries = spark.createDataFrame([(q, "same") for q in range(20)], "query_id long, query string")
    stored_index.write_index(rows, str(tmp_path / "i"), "id", FIELDS)
    hits = stored_index.search_stored(spark, str(tmp_path / "i"), queries, 3, fuzzy=False)
    assert counts[-3:] == [20 * 40] * 3
    scores = [r for r in hits.collect()]
    assert sorted((r["query_id"], r["id"], r["rank"]) for r in scores) == [(q, i, i + 1) for q in range(20) for i in range(3)]


def test_rows_that_cannot_beat_the_leading_ones_are_not_scored(spark, tmp_path, monkeypatch):
    """Of 320 rows with the stronger word, some are scored whole; those only equal to the k-th best and after it are not."""
    counts = []
    monkeypatch.setattr(stored_index, "deal_by", lambda df, keys, n, *per: counts.append(n) or scale.deal_by(df, keys, n, *per))
    rows = spark.range(2_560).select(
        "id", F.concat_ws(" ", F.concat(F.lit("a"), (F.col("id") % 8).cast("string")),
                          F.concat(F.lit("b"), (F.floor(F.col("id") / 8) % 8).cast("string"))).alias("text"))
    queries = spark.createDataFrame([(q, f"a{q} b{q}") for q in range(8)], "query_id long, query string")
    stored_index.write_index(rows, str(tmp_path / "i"), "id", FIELDS)
    hits = found(stored_index.search_stored(spark, str(tmp_path / "i"), queries, 3, fuzzy=False))
    assert hits == found(search.search(rows, queries, "id", FIELDS, 3, fuzzy=False)) and len(hits) == 24
    assert max(counts[-2:]) <= 8 * 3 * stored_index.LEADERS


def test_rows_after_the_kth_score_with_more_to_come_are_scored(spark, tmp_path, monkeypatch):
    """The best rows may have their words outside the blocks read first, whichever rows lead."""
    monkeypatch.setattr(stored_index, "LEADERS", 1)
    queries = asked(spark)
    rows = corpus(spark, 900, seed=4)
    stored_index.write_index(rows, str(tmp_path / "i"), "id", MIXED)
    for k in (1, 5):
        assert found(stored_index.search_stored(spark, str(tmp_path / "i"), queries, k)) == found(search.search(rows, queries, "id", MIXED, k=k))
