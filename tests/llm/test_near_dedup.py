import itertools
import random

import pytest
from pyspark.sql import functions as F

from gaugeline.llm.components import components
from gaugeline.llm.near_dedup import keep_one, near_classes, prefix_pairs, sketches_for
from tests.llm.corpora import frame, odd_rows, plain_words, prose

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    words = [w.translate(CAPITALS) for w in plain_words(text)]
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}


def brute_force(rows, size, percent):
    """doc_id -> (n_shingles, component), over rows with a doc_id; rows of one id are one document."""
    sets = [(i, shingle_set(text, size)) for i, text, *_ in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, one), (j, two) in itertools.combinations(sets, 2):
        if one and two and 100 * len(one & two) >= percent * len(one | two):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets}


def edited(text, seed, changes):
    words, chance = text.split(" "), random.Random(seed)
    for _ in range(changes):
        words[chance.randrange(len(words))] = f"edit{seed}x{chance.randrange(10**6)}"
    return " ".join(words)


def family_rows():
    """Near copies at all distances of one text, chains, exact copies, and texts that share a passage."""
    base, rows = prose(50, 200), []
    for n in range(60):
        rows.append((100 + n, edited(base, n, n % 9), "en", "a"))
    link = prose(51, 150)
    for n in range(12):  # each is linked to the next, the ends are not linked to each other
        link = edited(link, 500 + n, 3)
        rows.append((300 - n, link, "en", "a"))
    passage = prose(52, 60)
    for n in range(40):
        rows.append((400 + n, prose(600 + n, 20) + " " + passage + " " + prose(700 + n, 20), "en", "a"))
    return rows


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_classes_equal_brute_force(spark, size, percent):
    rows = family_rows() + [r for r in odd_rows() if r[0] is not None]
    found = near_classes(frame(spark, rows, 5), size, percent).collect()
    expected = brute_force(rows, size, percent)
    assert len(found) == len(rows)
    for row in found:
        assert (row["n_shingles"], row["component_id"]) == expected[row["doc_id"]]
        assert row["kept"] == (row["doc_id"] == row["component_id"])


def test_repeated_rows_lose_no_pair(spark):
    rows = []
    for n in range(40):
        words = [f"w{n}x{place}" for place in range(104)]
        rows += [(2 * n, " ".join(words), "en", "a"), (2 * n + 1, " ".join([*words[8:], *(f"new{n}x{k}" for k in range(8))]), "en", "a")]
    rows.append((0, prose(60, 104), "en", "a"))  # another text of the same length under a known id
    members = spark.createDataFrame([(i, i) for i in range(80)], "doc bigint, root bigint")
    wanted = {(2 * n + 1, 2 * n) for n in range(40)}
    for repeats in (1, 2, 3):
        texts = frame(spark, rows * repeats)
        assert wanted <= {tuple(r) for r in prefix_pairs(members, texts, 5, 85).collect()}


def test_classes_of_repeated_rows_equal_brute_force(spark):
    rows = family_rows()
    expected = brute_force(rows, 5, 80)
    found = near_classes(frame(spark, rows * 2, 5)).collect()
    assert len(found) == 2 * len(rows)
    assert all((r["n_shingles"], r["component_id"]) == expected[r["doc_id"]] for r in found)


def test_null_ids_are_left_alone(spark):
    rows = [r for r in near_classes(frame(spark, odd_rows())).collect() if r["doc_id"] is None]
    assert len(rows) == 2
    assert all(r["component_id"] is None and r["kept"] for r in rows)


def test_keep_one_keeps_columns_and_one_row_of_each_class(spark):
    docs = frame(spark, odd_rows())
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    # 8 is 6 in capitals, 7 and 9 repeat it.
    assert [i for null, i in ids if not null] == [1, 2, 3, 4, 5, 6, 12, 13, 14, 15]
    assert sum(null for null, _ in ids) == 2


def test_empty_table(spark):
    docs = frame(spark, odd_rows()).limit(0)
    assert near_classes(docs).collect() == []
    assert keep_one(docs).collect() == []


def test_recall_of_the_tables():
    for threshold in (0.8, 0.85):
        count = sketches_for(threshold, 3, 0.9995)
        assert (1 - (1 - threshold**3) ** count) ** 2 >= 0.9995
        assert (1 - (1 - threshold**3) ** (count - 1)) ** 2 < 0.9995


def test_components_of_stars_chains_and_cycles(spark):
    edges = [(1, n) for n in range(2, 60)] + [(n, n + 1) for n in range(100, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7), (None, 3)]
    links = spark.createDataFrame(edges, "a bigint, b bigint")
    found = components(links).groupBy("root").agg(F.sort_array(F.collect_set("node")).alias("nodes")).collect()
    assert sorted(r["nodes"] for r in found) == [list(range(1, 60)), list(range(100, 161)), [200, 201, 202]]
    assert components(links.limit(0)).collect() == []
