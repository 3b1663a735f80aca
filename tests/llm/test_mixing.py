import duckdb
import pytest

from gaugeline.llm import mixing
from gaugeline.llm.mixing import mix, take
from tests.llm.corpora import TABLES, frame, odd_rows, plain_words, prose


def targets_by_rounds(sizes):
    """Share by weight, fix what is above its limit, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in above}


ROWS = odd_rows() + [(100 + n, prose(n, 5 + n % 90), "en", "abcde"[n * n % 5]) for n in range(300)] + [
    (500, prose(1, 4), "en", "tiny"), (501, None, "en", "wordless")]


def test_targets_and_takes(spark):
    rows = mix(frame(spark, ROWS)).collect()
    assert len(rows) == len(ROWS)
    sizes, largest, taken = {}, {}, {}
    for i, text, _, source in ROWS:
        size = len(plain_words(text))
        sizes[source] = sizes.get(source, 0) + size
        largest[source] = max(largest.get(source, 0), size)
    expected = targets_by_rounds(sizes)
    for row in rows:
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(expected[row["source"]])
        assert row["taken"] % max(row["size"], 1) == 0 and row["taken"] <= 3 * row["size"]
        taken[row["source"]] = taken.get(row["source"], 0) + row["taken"]
    for source, target in expected.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1e-6


def test_null_ids_and_equal_rows_are_divided(spark):
    """A third of the ids null, another third one row over and over: targets are still met to half a document."""
    rows = [(None if n % 3 == 0 else 7 if n % 3 == 1 else n, prose(1 if n % 3 == 1 else n, 10 if n % 3 == 1 else 5 + n % 20), "en",
             "s" if n % 3 == 1 else "abcde"[n % 5]) for n in range(600)]
    found = mix(frame(spark, rows)).collect()
    by_source = {}
    for r in found:
        by_source.setdefault(r["source"], []).append(r)
    for source, inside in by_source.items():
        assert abs(sum(r["taken"] for r in inside) - inside[0]["target"]) <= max(r["size"] for r in inside) / 2 + 1e-6, source
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    mine = [(r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in found]
    assert sorted(mine, key=str) == sorted(con.execute(mixing.SQL).fetchall(), key=str)
    assert take(frame(spark, rows)).count() == sum(r["copies"] for r in found)


def test_rerun_and_partitioning_do_not_matter(spark):
    one = sorted(mix(frame(spark, ROWS, 2)).collect(), key=str)
    assert one == sorted(mix(frame(spark, ROWS, 7)).collect(), key=str)


def test_rows_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{TABLES}/documents.parquet'")
    expected = con.execute(mixing.SQL).fetchall()
    assert sorted(map(tuple, mixing.mixture_report(spark.read.parquet(f"{TABLES}/documents.parquet")).collect())) == sorted(expected)


def test_take_repeats_rows(spark):
    docs = frame(spark, ROWS)
    rows = take(docs)
    assert rows.columns == docs.columns
    words = sum(len(plain_words(r["text"])) for r in rows.collect())
    assert words == mix(docs).agg({"taken": "sum"}).collect()[0][0]


def test_empty_and_wordless(spark):
    docs = frame(spark, odd_rows())
    assert mix(docs.limit(0)).collect() == [] and take(docs.limit(0)).collect() == []
    blank = frame(spark, [(1, None, "en", "a"), (2, " ", "en", None)])
    assert [(r["target"], r["taken"]) for r in mix(blank).collect()] == [(0.0, 0)] * 2
