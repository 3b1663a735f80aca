"""Search, vectors, fusion, graph and context against brute force on small fixtures."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv
from gaugeline.operators import cells, context, fusion, graph, search, vector
from gaugeline.operators.gold import seed_indicators
from gaugeline.plans import catalogue

PROPS = "map<string,string>"


# --- Words and edit distance -------------------------------------------------


def distance(a, b):
    """Edits with swaps of neighbours, other edits allowed around a swap."""
    best = {a: 0}
    for step in (1, 2):
        for word in [w for w, d in best.items() if d == step - 1]:
            for i in range(len(word) + 1):
                near = [word[:i] + word[i + 1:]] if i < len(word) else []
                near += [word[:i] + c + word[i:] for c in "abc"]
                near += [word[:i] + c + word[i + 1:] for c in "abc"] if i < len(word) else []
                near += [word[:i] + word[i + 1] + word[i] + word[i + 2:]] if i + 1 < len(word) else []
                for n in near:
                    best.setdefault(n, step)
    return best.get(b)


def test_edit_distance(spark):
    rng = random.Random(7)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choices("abc", k=rng.randint(2, 7)))
        b = "".join(rng.choices("abc", k=rng.randint(2, 7)))
        pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a string, b string")
    for row in df.withColumn("d", search.edit_distance(F.col("a"), F.col("b"))).collect():
        assert row["d"] == distance(row["a"], row["b"]), row


@pytest.mark.parametrize("short", [6, search.SHORT_WORD])
def test_candidates_miss_no_match(spark, monkeypatch, short):
    monkeypatch.setattr(search, "SHORT_WORD", short)
    rng = random.Random(11)
    asked = sorted({"".join(rng.choices("abc", k=rng.randint(1, 8))) for _ in range(60)})
    known = sorted({"".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(250)})
    asked_df = spark.createDataFrame([("f", w) for w in asked], "field string, word string")
    known_df = spark.createDataFrame([("f", w) for w in known], "field string, word string")
    got = {(r["word"], r["known_word"]): r["distance"] for r in search.match_words(asked_df, known_df).collect()}
    wanted = {}
    for a, k in itertools.product(asked, known):
        allowed = 0 if len(a) <= 2 else 1 if len(a) <= 5 else 2
        d = distance(a, k)
        if d is not None and d <= allowed:
            wanted[a, k] = d
    assert got == wanted


def edited(rng, word, edits):
    """``word`` after that many random edits, swaps among them."""
    for _ in range(edits):
        i = rng.randrange(len(word) - 1)
        word = rng.choice([
            word[:i] + word[i + 1:], word[:i] + rng.choice("abc") + word[i:],
            word[:i] + rng.choice("abc") + word[i + 1:], word[:i] + word[i + 1] + word[i] + word[i + 2:]])
    return word


def test_long_words_meet_after_two_edits(spark):
    rng = random.Random(13)
    pairs = []
    for n in range(600):
        word = "".join(rng.choices("abcdefgh", k=rng.randint(9, 40)))
        pairs.append((word, edited(rng, word, rng.randint(0, 2))))
    asked = spark.createDataFrame([("f", a) for a, _ in pairs], "field string, word string")
    known = spark.createDataFrame([("f", k) for _, k in pairs], "field string, word string").distinct()
    got = {(r["word"], r["known_word"]) for r in search.match_words(asked, known).collect()}
    assert got >= set(pairs)


def test_keys_of_long_words_grow_with_their_length(spark):
    df = spark.createDataFrame([("x" * 13,), ("ab" * 127,)], "w string")
    for row in df.select("w", F.size(search.half_keys(F.col("w"))).alias("n")).collect():
        assert row["n"] == len(row["w"]) + 2


# --- BM25 ---------------------------------------------------------------------


def bm25(docs, query, k):
    n, avg = len(docs), sum(len(d.split()) for _, d in docs) / len(docs)
    scores = {}
    for word in query.split():
        df = sum(word in d.split() for _, d in docs)
        for doc_id, d in docs:
            tf = d.split().count(word)
            if tf:
                idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                norm = 1.2 * (0.25 + 0.75 * len(d.split()) / avg)
                scores[doc_id] = scores.get(doc_id, 0) + idf * tf / (tf + norm)
    return [(i, round(s, 6)) for i, s in sorted(scores.items(), key=lambda x: (-round(x[1], 6), x[0]))[:k]]


def small_corpus():
    rng = random.Random(3)
    words = ["the", "gdp", "rate", "trade", "price", "index", "labor"]
    # The word "the" is in every document: one key holds a third of all words.
    return [(i, " ".join(["the"] * 4 + rng.choices(words, k=rng.randint(1, 12)))) for i in range(120)]


QUERIES = [(0, "the gdp rate"), (1, "price price index"), (2, "labor"), (3, "nothing matches here")]
FIELDS = [("text", 1.0, "text")]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_bm25_with_broadcast_and_with_shuffled_weights(spark, request, threshold):
    docs = small_corpus()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    corpus = spark.createDataFrame(docs, "doc_id long, text string")
    queries = spark.createDataFrame(QUERIES, "query_id long, query string")
    hits = search.search(corpus, queries, "doc_id", FIELDS, k=7, fuzzy=False).orderBy("query_id", "rank").collect()
    for query_id, query in QUERIES:
        assert [(r["id"], r["score"]) for r in hits if r["query_id"] == query_id] == bm25(docs, query, 7)


def test_index_in_buckets_is_searched_without_moving_it(spark):
    corpus = spark.createDataFrame(small_corpus(), "doc_id long, text string")
    queries = spark.createDataFrame(QUERIES, "query_id long, query string")
    stored = search.store_index(search.index_words(corpus, "doc_id", FIELDS), "word_index", 4)
    hits = search.search_index(stored, queries, FIELDS, k=7, fuzzy=False, by_id=True)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id") == 0
    expected = search.search(corpus, queries, "doc_id", FIELDS, k=7, fuzzy=False)
    assert sorted(hits.collect()) == sorted(expected.collect())
    spark.sql("drop table word_index")


def test_best_field_boosts_and_misspelling(spark):
    queries = spark.createDataFrame([(1, "inflaton"), (2, "SP.POP.TOTL"), (3, "tarde")], "query_id long, query string")
    hits = search.search(seed_indicators(spark), queries, k=3).orderBy("query_id", "rank").collect()
    first = {}
    for row in hits:
        first.setdefault(row["query_id"], row["id"])
    assert first[1] == "FP.CPI.TOTL.ZG"  # one letter missing
    assert first[2] == "SP.POP.TOTL"  # the whole code, a keyword
    assert first[3] in {"NE.EXP.GNFS.ZS", "BN.CAB.XOKA.GD.ZS", "NE.IMP.GNFS.ZS", "ST.INT.RCPT.CD", "TM.TAX.MRCH.SM.AR"}


# --- Vectors ---------------------------------------------------------------------


@pytest.mark.parametrize("block", [2000, 3])
def test_nearest_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(cells, "QUERIES_AT_ONCE", block)
    rng = np.random.default_rng(5)
    data = rng.normal(size=(200, 16)).astype("float32")
    data[50] = data[10]  # a tie, broken by id
    data[60] = 0.0  # no direction: last
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    rows = rows.repartition(5)
    queries = spark.createDataFrame([(q, data[q].tolist()) for q in range(8, 18)], "query_id long, embedding array<float>")
    got = {}
    for row in vector.nearest(rows, queries, 6).orderBy("query_id", "rank").collect():
        got.setdefault(row["query_id"], []).append(row["id"])
    d = data.astype("float64")
    norms = np.linalg.norm(d, axis=1)
    for q in range(8, 18):
        sims = [round(float(d[i] @ d[q] / (norms[i] * norms[q])), 9) if norms[i] else -2.0 for i in range(200)]
        assert got[q] == sorted(range(200), key=lambda i: (-sims[i], i))[:6]


def test_nearest_with_text_ids_and_small_parts(spark, monkeypatch):
    monkeypatch.setattr(cells, "BLOCK", 7)
    rows = spark.createDataFrame(
        [(f"r{i:02d}", [1.0, float(i % 7)]) for i in range(50)], "name string, embedding array<float>").repartition(3)
    queries = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "query_id string, embedding array<float>")
    hits = vector.nearest(rows, queries, 4, id_col="name").orderBy("query_id", "rank").collect()
    assert [r["id"] for r in hits if r["query_id"] == "a"] == ["r00", "r07", "r14", "r21"]
    assert [r["id"] for r in hits if r["query_id"] == "b"] == ["r06", "r13", "r20", "r27"]


def test_no_queries_no_hits(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([], "query_id long, embedding array<float>")
    assert vector.nearest(rows, queries, 3).count() == 0


def test_user_embedder_gets_batches(spark):
    def embedder(texts):
        assert 0 < len(texts) <= 20
        return [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([(i, "x" * i) for i in range(45)], "id long, text string").coalesce(1)
    out = vector.embed_with(df, embedder).collect()
    assert all(r["embedding"] == [float(r["id"]), 1.0] for r in out)


def test_hashed_embedder(spark):
    df = spark.createDataFrame([("a b a",), ("b a a",), ("",)], "text string")
    vectors = [r["embedding"] for r in vector.embed_hashed(df, dimension=32).collect()]
    assert vectors[0] == vectors[1] and abs(sum(x * x for x in vectors[0]) - 1) < 1e-6
    assert not any(vectors[2])


def test_hashed_embedder_fills_every_slot_in_its_place(spark):
    """Words in the first and the last slot, in neighbouring ones and in one slot together."""
    from hashlib import md5

    texts = [" ".join(f"w{i}" for i in range(n)) for n in (1, 2, 40, 400)] + ["w1 w1 w2", "...", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for dimension in (1, 3, 32):
        for row in vector.embed_hashed(df, dimension=dimension).collect():
            counts = [0] * dimension
            for word in (row["text"] or "").replace("...", "").split():
                counts[int(md5(word.encode()).hexdigest()[:8], 16) % dimension] += 1
            length = sum(c * c for c in counts) ** 0.5 or 1.0
            assert row["embedding"] == pytest.approx([c / length for c in counts], abs=1e-6)


def test_hashed_embed_reads_the_words_of_a_chunk_once(spark, tmp_path):
    spark.createDataFrame([(1, "a b a"), (2, None), (3, "...")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    slots = catalogue.QUERIES["hashed_embed"](spark, str(tmp_path))
    assert slots._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(lower(") == 1
    assert [r["weight"] for r in slots.orderBy("weight").collect()] == [round(1 / 5 ** 0.5, 5), round(2 / 5 ** 0.5, 5)]


def test_vectors_are_stored_in_tasks_of_bounded_rows(spark, tmp_path, monkeypatch):
    """The parts are one small file; their vectors come in as many tasks as their number needs."""
    part = spark.range(300).selectExpr(
        "id AS p_partkey", "concat('part ', id) AS p_name", "'B' AS p_brand", "'SMALL' AS p_type", "1 AS p_size")
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    tasks, embed = [], vector.embed_hashed
    monkeypatch.setattr(catalogue, "VECTORS_PER_TASK", 10, raising=False)
    monkeypatch.setattr(catalogue.vector, "embed_hashed", lambda df, **named: tasks.append(df.rdd.getNumPartitions()) or embed(df, **named))
    assert catalogue.QUERIES["embedding_store"](spark, str(tmp_path)).count() == 300
    assert tasks == [30]


# --- Fusion ------------------------------------------------------------------------


def test_fusion_counts_every_occurrence(spark):
    lexical = spark.createDataFrame(
        [(1, "a", 1, {"n": "la"}), (1, "b", 2, {"n": "lb"}), (2, "x", 1, {}), (2, "y", 1, {})],
        f"query_id int, id string, rank int, properties {PROPS}")
    semantic = spark.createDataFrame(
        [(1, "b", 1, "indicator", {"n": "sb"}), (1, "c", 2, "chunk", {"n": "sc"}), (1, "b", 3, "indicator", {})],
        f"query_id int, id string, rank int, source_type string, properties {PROPS}")
    rows = fusion.fuse(lexical, semantic).orderBy("query_id", "rank").collect()
    one = [r for r in rows if r["query_id"] == 1]
    assert [(r["id"], r["type"], r["properties"]["n"]) for r in one] == [
        ("b", "Indicator", "lb"), ("a", "Indicator", "la"), ("c", "Document", "sc")]
    assert abs(one[0]["score"] - (1 / 62 + 1 / 61 + 1 / 63)) < 1e-12
    assert [r["id"] for r in rows if r["query_id"] == 2] == ["y", "x"]  # ties: larger id first
    assert fusion.fuse(lexical, semantic, top_k=1).count() == 2


# --- Graph ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def small_graph(spark):
    countries = spark.createDataFrame(
        [("VNM", "Vietnam", "Asia", "Low"), ("THA", "Thailand", None, None)],
        "country_code string, country_name string, region string, income_group string")
    indicators = spark.createDataFrame(
        [("I1", "GDP", "gdp", "w", "USD", "d"), ("I2", "CPI", "prices", "w", "%", None), ("I3", "Lonely", "", "w", "", "")],
        "indicator_code string, indicator_name string, category string, source_system string, unit string, description string")
    docs = spark.createDataFrame(
        [("D1", "About GDP", "", "", "x", "Vietnam"), ("D2", "Other", None, "", "gdp;x", "THA; VNM"),
         ("D3", "None", "", "", "x", "Vietnam"), ("D4", "No country", "", "", "gdp", "")],
        "doc_id string, title string, doc_type string, abstract string, topics string, countries string")
    links = spark.createDataFrame([("VNM", "I1"), ("THA", "I1"), ("VNM", "I2")], "c string, i string").selectExpr(
        "'Country' src_type", "c src", "'HAS_INDICATOR' rel", "'Indicator' dst_type", "i dst")
    nodes = graph.country_nodes(countries).unionByName(graph.indicator_nodes(indicators)).unionByName(
        graph.category_nodes(indicators)).unionByName(graph.document_nodes(docs))
    edges = graph.category_edges(indicators).unionByName(links).unionByName(graph.document_country_edges(docs, countries))
    return graph.store_nodes(nodes), edges


def test_documents_are_about_countries_by_name_or_code(small_graph):
    _, edges = small_graph
    about = {(r["src"], r["dst"]) for r in edges.filter("rel = 'ABOUT'").collect()}
    assert about == {("D1", "VNM"), ("D2", "THA"), ("D2", "VNM"), ("D3", "VNM")}


def test_chain_rows(spark, small_graph):
    nodes, edges = small_graph
    wanted = spark.createDataFrame([("I1",), ("I2",), ("I3",), ("missing",)], "i string")
    rows = graph.indicator_rows(nodes, edges, wanted).orderBy("i", "row_no").collect()
    assert [(r["i"], r["cat"], r["c"], r["d"]) for r in rows] == [
        ("I1", "gdp", "THA", "D2"), ("I1", "gdp", "VNM", "D1"), ("I1", "gdp", "VNM", "D2"),
        ("I2", "prices", "VNM", None), ("I3", None, None, None)]
    capped = graph.indicator_rows(nodes, edges, wanted, cap=2).orderBy("i", "row_no").collect()
    assert [(r["i"], r["c"], r["d"]) for r in capped if r["i"] == "I1"] == [("I1", "THA", "D2"), ("I1", "VNM", "D1")]


def test_expansion_is_first_seen_and_capped(spark, small_graph):
    nodes, edges = small_graph
    anchors = spark.createDataFrame(
        [(1, 1, "Document", "D1"), (1, 2, "Country", "VNM"), (1, 3, "Indicator", "I1"), (2, 1, "Indicator", "I2")],
        "query_id int, rank int, type string, id string")
    rows = graph.expand(nodes, edges, anchors).orderBy("query_id", "place").collect()
    assert [r["id"] for r in rows if r["query_id"] == 1] == ["VNM", "I1", "gdp", "I2", "prices", "THA", "D2", "D1"]
    assert [r["id"] for r in rows if r["query_id"] == 2] == ["I2", "prices", "VNM"]
    assert rows[0]["properties"]["name"] == "Vietnam"
    assert graph.expand(nodes, edges, anchors, max_nodes=3).filter("query_id = 1").count() == 3


def test_upserts(spark, small_graph):
    nodes, edges = small_graph
    new = nodes.filter("id = 'VNM'").withColumn("name", F.lit("Viet Nam"))
    merged = graph.upsert_nodes(nodes, new)
    assert merged.count() == nodes.count()
    assert merged.filter("id = 'VNM'").first()["name"] == "Viet Nam"
    region = nodes.filter("id = 'VNM'").withColumn("properties", F.create_map(F.lit("region"), F.lit("Asia")))
    kept = graph.upsert_nodes(nodes, region).filter("id = 'VNM'").first()["properties"]
    assert kept == {**nodes.filter("id = 'VNM'").first()["properties"], "region": "Asia"}
    extra = spark.createDataFrame(
        [("Country", "THA", "HAS_INDICATOR", "Indicator", "I2"), ("Country", "THA", "HAS_INDICATOR", "Indicator", "I9"),
         ("Country", "VNM", "HAS_INDICATOR", "Indicator", "I1")],
        "src_type string, src string, rel string, dst_type string, dst string")
    assert graph.upsert_edges(edges, extra, merged).count() == edges.count() + 1


def test_containing_matches_brute_force(spark):
    rng = random.Random(9)
    texts = [(i, "".join(rng.choices("ab é", k=rng.randint(0, 30)))) for i in range(80)]
    terms = ["a", "é", "ab", "ba b", "aabb", "abab ab", "é é", "bbbbbbbb", "", None]
    got = graph.containing(
        spark.createDataFrame(texts, "i int, text string"), "text",
        spark.createDataFrame([(t,) for t in terms], "term string"), "term")
    assert {(r["i"], r["term"]) for r in got.collect()} == {
        (i, t) for i, x in texts for t in terms if t and t in x}


def test_topics_and_dashboards(spark):
    docs = spark.createDataFrame([("D1", "a; b;a"), ("D2", ""), ("D3", None)], "doc_id string, topics string")
    assert {(r["src"], r["dst"]) for r in graph.topic_edges(docs).collect()} == {("D1", "a"), ("D1", "b")}
    assert graph.topic_nodes(docs).count() == 2
    uses = spark.createDataFrame([("board", "t", "c"), ("board", "t", "c")], "dashboard string, table_name string, column_name string")
    assert [(r["rel"], r["dst"]) for r in graph.dashboard_edges(uses).collect()] == [("USES", "t.c")]


def test_lineage(spark):
    tables = {"silver": spark.range(1).selectExpr("id code", "id value").schema,
              "gold": spark.range(1).selectExpr("id code", "id extra").schema,
              "mart": spark.range(1).selectExpr("id code").schema}
    nodes, contains = graph.lineage_tables(spark, tables)
    assert nodes.groupBy("type").count().orderBy("type").collect() == [("DataColumn", 5), ("DataTable", 3)]
    upstream = spark.createDataFrame([("gold", "silver"), ("mart", "gold")], "table_name string, source_name string")
    derived = graph.column_derivations(contains, upstream)
    paths = graph.paths_up_to_two(derived, "DERIVED_FROM", "col", "up")
    assert {tuple(r) for r in paths.collect()} == {
        ("gold.code", "silver.code"), ("mart.code", "gold.code"), ("mart.code", "silver.code")}


# --- Context ---------------------------------------------------------------------------


def node_rows(spark, rows):
    df = spark.createDataFrame(rows, f"query_id int, place long, type string, id string, properties {PROPS}")
    return df.select("query_id", F.struct(F.lit(0).alias("part"), "place").alias("position"), "type", "id", "properties")


def test_rerank_by_type(spark):
    kinds = ["DataTable", "Other", "DataColumn", "Country", "Document", "Indicator", "Indicator"]
    rows = [(1, i, kind, f"n{i}", {"is_deprecated": "true"} if i == 6 else {}) for i, kind in enumerate(kinds)]
    out = context.rerank(node_rows(spark, rows), 100).orderBy("rank").collect()
    assert [r["type"] for r in out] == ["Indicator", "Document", "Country", "Other", "DataColumn", "DataTable"]
    assert [r["score"] for r in out] == [3.0, 2.5, 2.0, 1.0, 0.8, 0.5]


def test_blocks_and_budget(spark):
    rows = [(1, 1, "Indicator", "I", {"indicator_name": "GDP", "category": "gdp"}), (1, 2, "Country", "VNM", {"name": "Vietnam"}),
            (1, 3, "Document", "D", {"title": "T", "abstract": "", "text": "unused"}),
            (1, 4, "Document", "E", {"title": "U", "text": "x" * 2000}), (1, 5, "DataTable", "t", {})]
    ranked = spark.createDataFrame(rows, f"query_id int, rank int, type string, id string, properties {PROPS}")
    blocks = [r["block"] for r in context.context_blocks(ranked).orderBy("rank").collect()]
    assert blocks[0] == "[Doc_1] | Type: Indicator\nCode: I | Category: gdp\nName: GDP\nDescription: \n"
    assert blocks[1] == "[Doc_2] | Type: Country\nCode: VNM | Name: Vietnam\nRegion:  | Income: \n"
    assert blocks[2] == "[Doc_3] | Type: Document\nTitle: T\nContent: \n"
    assert blocks[3] == "[Doc_4] | Type: Document\nTitle: U\nContent: " + "x" * 1000 + "\n"
    assert blocks[4] == "[Doc_5] | Type: DataTable | ID: t\n"
    assert context.assemble(ranked).first()["context"] == "\n".join(blocks)
    width = len(blocks[0]) + len(blocks[1])
    assert context.context_blocks(ranked, max_chars=width).count() == 3  # the crossing block is kept
    assert context.context_blocks(ranked, max_chars=width - 1).count() == 2


def test_nodes_without_id_or_type_are_blocks_like_others(spark):
    ranked = spark.createDataFrame([(1, n, None, None, {}) for n in range(1, 2001)], f"query_id int, rank int, type string, id string, properties {PROPS}")
    text = context.assemble(ranked).first()["context"]
    used = blocks = 0
    while used <= 24000:
        blocks += 1
        used += len(f"[Doc_{blocks}] | Type:  | ID: \n")
    assert text.count("[Doc_") == blocks


def test_layer_weights(spark):
    df = spark.createDataFrame(
        [(1, {"layer": "gold"}), (2, {"layer": "bronze", "is_active": "false"}), (3, {})], f"id int, properties {PROPS}")
    assert [(r["id"], r["score"]) for r in context.score_layers(df).collect()] == [(1, 3.0), (3, 1.0)]


def test_questions_are_read(spark):
    df = spark.createDataFrame([(1, "So sánh lạm phát Việt Nam 2020")], "query_id int, query string")
    row = context.read_questions(df).first()
    assert row["countries"] == ["VNM"] and row["is_comparison"] and row["year"] == 2020
    assert row["search_text"].endswith("inflation CPI consumer price index Vietnam Viet Nam VN VNM")
    assert fv.COMPARISON_WORDS[0] in "so sánh"
