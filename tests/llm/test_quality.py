from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import quality
from gaugeline.llm.quality import Rule, cascade, counts, keep_good, order_rules, quality_report, standard_rules, word_list
from tests.llm.corpora import TABLES, frame, odd_rows, plain_words, prose


def brute_force(text):
    words = plain_words(text)
    lines = [line for line in (text or "").split("\n") if plain_words(line)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


ROWS = odd_rows() + [
    (20, "a b c d e " * 3 + prose(9, 30), "en", "a"),
    (21, "a a a a a a a a a a a a", "en", "a"),
    (22, "\n".join(["same line here now"] * 4 + [prose(10, 20)]), "en", "a"),
    (23, " | ".join(prose(11, 40).split()), "en", "a"),
    (24, "word### " * 3 + prose(12, 20) + "\r\x0c\x0b x\x85y z", "en", "a"),
    (25, "p q r s t u p q r s t", "en", "a"),
]


def test_counts_equal_brute_force(spark):
    found = quality_report(frame(spark, ROWS)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter((r["doc_id"], *[r[n] for n in names]) for r in found) == Counter((i, *brute_force(t)) for i, t, *_ in ROWS)
    for row in found:
        failed = row["n_words"] < 10 or 100 * row["n_repeat_words"] > 20 * row["n_words"]
        assert row["base_failed"] == failed
        assert not (failed and row["kept"])


def test_rows_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{TABLES}/documents.parquet'")
    expected = con.execute(quality.SQL).fetchall()
    found = [tuple(r) for r in quality_report(spark.read.parquet(f"{TABLES}/documents.parquet")).collect()]
    assert sorted(found) == sorted(expected)


def test_order_changes_no_verdict(spark):
    docs = frame(spark, ROWS).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    rules = standard_rules(text, counts(text, word_list(text)))
    verdicts = [
        sorted((r["doc_id"] or 0, r["no"]) for r in docs.select("doc_id", cascade(order).isNull().alias("no")).collect())
        for order in (rules, rules[::-1], order_rules(docs, rules))]
    assert verdicts[0] == verdicts[1] == verdicts[2]


def test_later_rules_are_not_run(spark):
    never = Rule("never", F.raise_error(F.lit("ran")).cast("boolean"))
    chain = cascade([Rule("all", F.col("id") >= 0), never])
    assert [r[0] for r in spark.range(5).select(chain).collect()] == ["all"] * 5
    with pytest.raises(Exception, match="ran"):
        spark.range(5).select(cascade([Rule("none", F.col("id") < 0), never])).collect()


def test_rules_are_ordered_by_rejections(spark):
    docs = spark.range(1000).withColumn("doc_id", F.col("id"))
    slow = F.length(F.sha2(F.repeat(F.col("id").cast("string"), 20_000), 512)) > 0
    rules = [Rule("rare", (F.col("id") == 1) & slow), Rule("none", F.lit(False)), Rule("most", F.col("id") > 100)]
    assert order_rules(docs, rules)[0].name == "most"
    assert order_rules(docs.limit(0), rules) == rules


def test_keep_good_keeps_columns(spark):
    docs = frame(spark, ROWS)
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    expected = Counter(r["doc_id"] for r in quality_report(docs).where("kept").collect())
    assert Counter(r["doc_id"] for r in kept.collect()) == expected
    assert keep_good(docs.limit(0)).collect() == []
    assert quality_report(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    docs = frame(spark, ROWS)
    for result in (quality_report(docs), keep_good(docs)):
        plan = result._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
