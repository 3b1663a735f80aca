import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeline.llm import merkle
from tests.llm.corpora import frame, odd_rows, prose


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    changed = None if n_chars is None else n_chars + more
    return sha("".join(map(field, (doc_id, source, lang, changed, text))))


def climb(nodes, fanout):
    """The top node and, for every leaf, its siblings per level as (before, after)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for own, place in enumerate(at):
            start = place - place % fanout
            run = nodes[start:start + fanout]
            paths[own].append(("".join(run[:place - start]), "".join(run[place - start + 1:])))
        nodes = [sha("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
        at = [place // fanout for place in at]
    return nodes[0], paths


def brute(rows, fanout=2):
    """rows of (doc_id, text, lang, source, n_chars) to result rows."""
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    found, tops = [], []
    for lang in langs:
        by_lang[lang].sort(key=lambda r: r[:3])
        tops.append(climb([r[2] for r in by_lang[lang]], fanout))
    root, upper = climb([top for top, _ in tops], fanout)
    for lang, (top, paths), above in zip(langs, tops, upper):
        for (_, _, digest, row), path in zip(by_lang[lang], paths):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = leaf(row, 1) if hit else digest
            for before, after in path + above:
                folded = sha(before + folded + after)
            proof = sha("".join(before + after for before, after in path + above))
            found.append((row[0], digest, top, root, proof, folded, folded == root))
    return Counter(found)


def with_sizes(rows):
    return [(i, text, lang, source, len(text or "")) for i, text, lang, source in rows]


def test_report_equals_brute_force_on_odd_rows(spark):
    rows = odd_rows()
    assert Counter(map(tuple, merkle.manifest_report(frame(spark, rows)).collect())) == brute(with_sizes(rows))


@pytest.mark.parametrize("sizes", [(1,), (2,), (1, 1, 1), (3, 5, 257), (600, 1, 256, 2, 7)])
def test_trees_of_different_heights(spark, sizes):
    rows = [(1000 * at + i, prose(i, 3), None if at == 1 else f"l{at}", "s") for at, size in enumerate(sizes) for i in range(size)]
    assert Counter(map(tuple, merkle.manifest_report(frame(spark, rows, 6)).collect())) == brute(with_sizes(rows))


def test_many_equal_rows_have_places_of_their_own(spark):
    rows = [(5, "same", "en", "a")] * 300 + [(i, "x", "de", "a") for i in range(40)]
    assert Counter(map(tuple, merkle.manifest_report(frame(spark, rows, 6)).collect())) == brute(with_sizes(rows))


@pytest.mark.parametrize("fanout", [3, 16])
def test_other_fanouts_fold_back_to_the_root(spark, fanout):
    rows = [(i, prose(i, 4), "en" if i % 3 else "fr", "s") for i in range(410)]
    found = merkle.manifest(frame(spark, rows), fanout=fanout).withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    expected = {(r[0], r[1], r[2], r[3]) for r in brute(with_sizes(rows), fanout)}
    assert {(r["doc_id"], r["leaf"], r["subroot"], r["root"]) for r in found} == expected
    assert all(r["folded"] == r["root"] for r in found)


def test_empty_table_and_too_small_fanout(spark):
    empty = frame(spark, [(1, "x", "en", "a")]).limit(0)
    assert merkle.manifest_report(empty).collect() == []
    with pytest.raises(ValueError):
        merkle.manifest(frame(spark, odd_rows()), fanout=1)


def test_nulls_keep_apart_from_their_written_form_and_the_largest_count(spark):
    docs = spark.createDataFrame(
        [(21, None, None, None, None), (21, "-", "-", "-", None), (21, "", "", "", 9223372036854775807), (3, "a1:b", "1", "", 0), (3, "1:b", "1a", "", 0)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = Counter(map(tuple, merkle.manifest_report(docs).collect()))
    assert found == brute([tuple(r) for r in docs.collect()]) and len({r[1] for r in found}) == 5


def test_proofs_fail_for_any_other_leaf(spark):
    rows = [(i, prose(i, 4), "en", "s") for i in range(20)]
    found = merkle.manifest(frame(spark, rows)).withColumn("other", merkle.fold(F.sha2(F.lit("x"), 256), F.col("path"))).collect()
    assert all(r["other"] != r["root"] for r in found)
