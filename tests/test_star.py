import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeline.functions.dates import generate_calendar
from gaugeline.operators import gold as g
from gaugeline.operators import quality, serving
from gaugeline.operators.silver import clean_chunks, clean_documents, clean_observations
from gaugeline.plans.medallion import build_star, run_batch
from gaugeline.schemas import CHUNKS, DOCUMENTS, OBSERVATIONS
from gaugeline.sources import sinks

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def observations(spark, rows):
    return spark.createDataFrame(rows, OBSERVATIONS)


def obs(code="VNM", indicator="SP.POP.TOTL", year=2020, value=1.0, at=T0, name="Vietnam"):
    return (code, name, indicator, indicator, year, value, at, "world_bank")


@pytest.fixture(scope="module")
def star(spark):
    rows = [obs(indicator=i, year=y, value=float(y) * k)
            for k, i in enumerate(["NY.GDP.MKTP.CD", "NY.GDP.MKTP.KD.ZG", "SP.POP.TOTL"], 1) for y in (2019, 2020, 2021)]
    rows += [obs(code="THA", name="Thailand", indicator="SP.POP.TOTL", value=70.5),
             obs(code="XXX", name="Nowhere"), obs(indicator="NO.SUCH.CODE")]
    return build_star(observations(spark, rows))


def test_latest_wins_and_nulls_go(spark):
    rows = [obs(value=1.0), obs(value=2.0, at=T1), obs(year=2021, value=None)]
    out = clean_observations(observations(spark, rows)).collect()
    assert [(r["year"], r["value"]) for r in out] == [(2020, 2.0)]


def test_codes_are_cleaned_before_or_after_deduplication(spark):
    df = observations(spark, [obs(code=" vnm"), obs(code="VNM", value=2.0, at=T1)])
    assert [r["value"] for r in clean_observations(df).collect()] == [2.0]
    assert sorted(r["value"] for r in clean_observations(df, raw_keys=True).collect()) == [1.0, 2.0]


def test_documents_and_chunks_are_cleaned(spark):
    docs = spark.createDataFrame(
        [(" d1 ", " T ", "a", "", "", "", "", "", "", T0, "s"), (None, "T", "a", "", "", "", "", "", "", T0, "s")], DOCUMENTS)
    assert [(r["doc_id"], r["title"]) for r in clean_documents(docs).collect()] == [("d1", "T")]
    chunks = spark.createDataFrame(
        [("c1", 0, "x", "d", "", "", "", "", "", "", T0, "s"), ("c2", 1, "", "d", "", "", "", "", "", "", T0, "s"),
         ("c3", 2, None, "d", "", "", "", "", "", "", T0, "s")], CHUNKS)
    assert [r["chunk_id"] for r in clean_chunks(chunks).collect()] == ["c1"]


def test_gold_tables(star):
    _, gold = star
    assert gold.dim_countries.count() == 10 and gold.dim_indicators.count() == 32
    assert [r["country_code"] for r in gold.dim_countries.orderBy("country_key").limit(2).collect()] == ["CHN", "IDN"]
    assert gold.fact.count() == 10  # unknown country and unknown indicator are dropped
    assert gold.dim_countries.columns == [
        "country_key", "country_code", "country_name", "region", "income_group", "is_asean", "is_primary"]
    assert gold.fact.columns == [
        "indicator_key", "country_key", "date_key", "period_start", "period_end", "value", "source_system", "loaded_at"]


def test_country_with_two_observed_names_fans_out(spark):
    silver = clean_observations(observations(spark, [obs(name="A"), obs(name="B", year=2021)]))
    seed = g.seed_countries(spark).filter("country_code = 'VNM'").withColumn("country_name", F.lit(None).cast("string"))
    assert sorted(r["country_name"] for r in g.enrich_countries(seed, silver).collect()) == ["A", "B"]


def test_serving(star):
    _, gold = star
    rows = serving.query_indicators(gold, "vnm", 0, 2020).collect()
    assert [(r["indicator_code"], r["year"]) for r in rows][:2] == [("NY.GDP.MKTP.CD", 2020), ("NY.GDP.MKTP.CD", 2019)]
    assert {r["year"] for r in rows} == {2019, 2020}
    assert serving.query_series(gold, "SP.POP.TOTL").count() == 4
    assert serving.query_series(gold, "SP.POP.TOTL", "tha").count() == 1
    with pytest.raises(serving.NotFound):
        serving.require_rows(serving.query_series(gold, "missing"))
    assert serving.fact_value(gold, "VNM", "SP.POP.TOTL").first()["year"] == 2021
    assert serving.fact_value(gold, "VNM", "SP.POP.TOTL", 2019).first()["value"] == 2019.0 * 3
    assert [r["year"] for r in serving.timeseries(gold, "VNM", "SP.POP.TOTL").collect()] == [2019, 2020, 2021]
    assert serving.series_by_names(gold, "Thailand", "Population total").first()["value"] == 70.5
    assert serving.country(gold, "vnm").first()["is_primary"] is True
    paged = serving.page(serving.query_indicators(gold), [F.col("year"), F.col("indicator_code"), F.col("country_code")], 2, 4)
    assert paged.count() == 4 and paged.first()["total"] == 10


def test_checks_pass_and_fail(spark, star):
    silver, gold = star
    as_of = dt.date(2024, 1, 1)
    quality.require_passed(quality.gold_checks(gold, as_of).unionByName(quality.staging_checks(silver)))
    counts = {r["check"]: r["violations"] for r in quality.gold_checks(gold, dt.date(2020, 6, 1)).collect()}
    assert counts["no_future_dates"] == 3
    worse = gold.fact.unionByName(gold.fact.limit(1).withColumn("country_key", F.lit(99).cast("long")))
    broken = g.Gold(gold.dim_countries, gold.dim_indicators.withColumn("category", F.lit("odd")), gold.dim_dates, worse)
    counts = {r["check"]: r["violations"] for r in quality.gold_checks(broken, as_of).collect()}
    assert counts["relationship:fact.country_key"] == 1 and counts["accepted:dim_indicators.category"] == 1
    with pytest.raises(quality.ChecksFailed, match="relationship:fact.country_key=1"):
        quality.require_passed(quality.gold_checks(broken, as_of))


def test_gdp_levels_must_be_positive_but_growth_may_not(spark):
    rows = [obs(indicator="NY.GDP.MKTP.CD", value=0.0), obs(indicator="NY.GDP.PCAP.CD", value=-1.0),
            obs(indicator="NY.GDP.MKTP.KD.ZG", value=-3.0)]
    _, gold = build_star(observations(spark, rows))
    counts = {r["check"]: r["violations"] for r in quality.gold_checks(gold, dt.date(2024, 1, 1)).collect()}
    assert counts["gdp_positive"] == 2
    levels = gold.dim_indicators.filter(F.col("indicator_code").isin("NY.GDP.MKTP.CD", "NY.GDP.PCAP.CD"))
    assert quality.non_positive(gold.fact, levels, "indicator_key").count() == 2


def test_range_rules(star):
    named = serving.named_facts(star[1])
    counts = {r["check"]: r["violations"] for r in quality.indicator_range_checks(named).collect()}
    assert counts == {"range:FP.CPI.TOTL.ZG": 0, "range:SP.POP.TOTL": 0, "range:NY.GDP.PCAP.CD": 0}


def test_batch_publishes_only_checked_tables(spark, tmp_path):
    good = observations(spark, [obs(value=5.0)])
    run_batch(good, sinks.path_writer(str(tmp_path / "good")), dt.date(2024, 1, 1), calendar=generate_calendar(spark, "2019-01-01", "2021-12-31"))
    assert spark.read.parquet(str(tmp_path / "good" / "fact_economic_indicators")).count() == 1
    bad = observations(spark, [obs(indicator="NY.GDP.MKTP.CD", value=-5.0)])
    with pytest.raises(quality.ChecksFailed):
        run_batch(bad, sinks.path_writer(str(tmp_path / "bad")), dt.date(2024, 1, 1))
    assert not (tmp_path / "bad").exists()


def test_conflicts_and_authority(spark):
    df = spark.createDataFrame(
        [("VNM", "i", 2020, "world", 100.0), ("VNM", "i", 2020, "office", 110.0), ("THA", "i", 2020, "world", 100.0),
         ("THA", "i", 2020, "office", 104.0)],
        "country_code string, indicator_code string, year int, source_system string, value double")
    assert [(r["country_code"], r["source_a"], r["source_b"]) for r in serving.source_conflicts(df).collect()] == [
        ("VNM", "office", "world")]
    chosen = {r["country_code"]: r["source_system"] for r in serving.authoritative(df, {"office": "VNM"}).collect()}
    assert chosen == {"VNM": "office", "THA": "world"}
    assert serving.authoritative(df, {"office": "VNM"}, "all").count() == 4


def test_facts_are_moved_without_what_is_made_of_the_rest(spark, monkeypatch):
    plans, store = {}, g.materialize

    def watched(df, label, *rest):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, label, *rest)

    monkeypatch.setattr(g, "materialize", watched)
    observed = spark.createDataFrame(
        [("VNM", "Vietnam", "NY.GDP.MKTP.CD", "GDP", 2020, 1.5, dt.datetime(2024, 1, 1), "world_bank")],
        "country_code string, country_name string, indicator_code string, indicator_name string, year long, value double,"
        " _ingested_at timestamp, _source string")
    _, gold = build_star(observed)
    moved = plans["fact"].split("RebalancePartitions")[1]
    assert "make_date(year" in plans["fact"] and ", 12, 31" not in moved and "source_system AS" not in moved
    assert [tuple(r) for r in gold.fact.select("period_start", "period_end", "value", "source_system").collect()] == [
        (dt.date(2020, 1, 1), dt.date(2020, 12, 31), 1.5, "world_bank")]
