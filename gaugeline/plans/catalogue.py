"""Every operator as a named query over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline import fixed_values as fv
from gaugeline.functions import dates, text, vectors
from gaugeline.operators import (
    cells,
    chat,
    chunking,
    context,
    fusion,
    graph,
    metrics,
    pages,
    quality,
    scale,
    search,
    serving,
    silver,
    stored_index,
    vector,
)
from gaugeline.plans import adapt, retrieval
from gaugeline.plans.adapt import table
from gaugeline.plans.layers import Layers
from gaugeline.session import materialize, new_table_path
from gaugeline.sources import gate, keyed, landed_pages, landing, sinks, tables
from gaugeline.streaming.events import read_event_stream, run_updates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


# --- Cleaning and star schema ----------------------------------------------


@query
def silver_dedup(spark, sf):
    return silver.clean_observations(adapt.order_observations(spark, sf), (F.col("obs_id"),))


@query
def silver_dedup_raw_keys(spark, sf):
    return silver.clean_observations(adapt.order_observations(spark, sf), (F.col("obs_id"),), raw_keys=True)


@query
def silver_documents(spark, sf):
    bronze = adapt.catalogue_documents(spark, sf).withColumns({
        "title": F.concat(F.lit("  "), "title", F.lit(" ")),
        "_ingested_at": F.lit(dt.datetime(2024, 7, 1)), "_source": F.lit("world_bank_docs")})
    return silver.clean_documents(bronze).drop("ingested_at")


@query
def silver_chunks(spark, sf):
    """Clean chunks of the conversation turns, one of which is blanked per conversation."""
    turns = table(spark, sf, "conversations")
    kept = F.when(F.col("turn") != 1, F.col("text")).otherwise("")
    bronze = turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("chunk_id"), F.col("turn").alias("chunk_index"),
        kept.alias("text"), F.col("conv_id").cast("string").alias("doc_id"),
        *[F.lit("").alias(c) for c in ("title", "display_date", "doc_type", "countries", "topics", "language")],
        F.lit(dt.datetime(2024, 7, 1)).alias("_ingested_at"), F.col("role").alias("_source"))
    return silver.clean_chunks(bronze).select("chunk_id", "chunk_index", "text", "doc_id", "source")


@query
def dim_countries(spark, sf):
    return adapt.order_star(spark, sf)[1].dim_countries


@query
def dim_indicators(spark, sf):
    return adapt.order_star(spark, sf)[1].dim_indicators


@query
def dim_dates(spark, sf):
    return adapt.order_calendar(spark, sf).orderBy("full_date")


@query
def calendar_sql(spark, sf):
    """The calendar of the years that have orders, from SQL: one call of the table function for each year."""
    dates.register_calendar(spark)
    table(spark, sf, "orders").selectExpr("year(o_orderdate) AS y").agg(
        F.min("y").alias("lo"), F.max("y").alias("hi")).createOrReplaceTempView("calendar_years")
    return spark.sql("""
        SELECT c.* FROM (SELECT explode(sequence(lo, hi)) AS y FROM calendar_years),
             LATERAL calendar(make_date(y, 1, 1), make_date(y, 12, 31)) AS c""")


@query
def fact_load(spark, sf):
    return adapt.order_star(spark, sf)[1].fact


@query
def fact_load_trade(spark, sf):
    return adapt.trade_star(spark, sf)[1].fact


# --- Serving ----------------------------------------------------------------


@query
def catalogue_countries(spark, sf):
    return serving.list_countries(adapt.order_star(spark, sf)[1])


@query
def catalogue_indicators(spark, sf):
    return serving.list_indicators(adapt.trade_star(spark, sf)[1])


@query
def country_lookup(spark, sf):
    return serving.country(adapt.order_star(spark, sf)[1], "nation_7")


@query
def indicators_by_country(spark, sf):
    return serving.query_indicators(adapt.order_star(spark, sf)[1], "nation_3", 1996, 2000)


@query
def indicators_open_range(spark, sf):
    return serving.query_indicators(adapt.trade_star(spark, sf)[1], "nation_3", 0, None)


@query
def indicators_filtered(spark, sf):
    gold = adapt.order_star(spark, sf)[1]
    return serving.query_indicators(
        gold, indicator_codes=["1-URGENT", "5-LOW"], category="trade", source_system="world_bank")


@query
def indicator_series(spark, sf):
    return serving.require_rows(serving.query_series(adapt.order_star(spark, sf)[1], "1-URGENT", "ALL"))


@query
def indicator_series_country(spark, sf):
    return serving.query_series(adapt.order_star(spark, sf)[1], "3-MEDIUM", "nation_12")


@query
def series_by_name(spark, sf):
    return serving.series_by_names(adapt.order_star(spark, sf)[1], "NATION_4", "Orders 2-HIGH")


@query
def fact_latest(spark, sf):
    return serving.latest_facts(adapt.trade_star(spark, sf)[1])


@query
def fact_for_year(spark, sf):
    return serving.fact_value(adapt.order_star(spark, sf)[1], "NATION_9", "1-URGENT", 1998)


@query
def fact_newest(spark, sf):
    return serving.fact_value(adapt.order_star(spark, sf)[1], "NATION_9", "1-URGENT")


@query
def fact_timeseries(spark, sf):
    return serving.timeseries(adapt.order_star(spark, sf)[1], "NATION_9", "1-URGENT")


@query
def paged_indicators(spark, sf):
    rows = serving.query_indicators(adapt.order_star(spark, sf)[1])
    order = [F.col("indicator_code"), F.col("country_code"), F.col("year").desc()]
    return serving.page(rows, order, page_no=3, page_size=50)


@query
def stored_pages(spark, sf):
    """The last full page by number, and as many rows after the last row of the third, from sorted facts."""
    folder = new_table_path(spark, "pages")
    order = [("indicator_code", False), ("country_code", False), ("year", True)]
    rows = serving.query_indicators(adapt.order_star(spark, sf)[1]).withColumn("year", F.col("year").cast("int"))
    total = pages.store_sorted(rows, folder, order, stride=100)["total"]
    last = pages.read_page(spark, folder, max(total // 50, 1), 50).drop("total").withColumn("page", F.lit("last"))
    third = pages.read_page(spark, folder, 3, 50).orderBy(F.desc("indicator_code"), F.desc("country_code"), "year").first()
    if third is None:
        return last
    key = {name: third[name] for name, _ in order}
    return longs(last.unionByName(pages.read_after(spark, folder, key, 50).withColumn("page", F.lit("fourth"))), "year")


def two_sources(spark, sf) -> DataFrame:
    """Order observations from two systems: customers' nations against a national office
    that reports the order nations' values of high-priority orders 3 to 9 percent off."""
    cleaned, _ = adapt.order_star(spark, sf)
    world = cleaned.select("country_code", "indicator_code", "year", "value", F.lit("world_bank").alias("source_system"))
    factor = 1.03 + (F.col("year") % 3) * 0.03
    office = cleaned.filter(F.col("indicator_code") == "2-HIGH").select(
        "country_code", "indicator_code", "year", (F.col("value") * factor).alias("value"),
        F.when(F.col("country_code") == "NATION_1", "office_1").otherwise("office_2").alias("source_system"))
    return world.unionByName(office)


@query
def conflict_view(spark, sf):
    found = serving.source_conflicts(two_sources(spark, sf))
    return found.withColumn("difference", F.round("difference", 9))


@query
def authoritative_source(spark, sf):
    homes = {"office_1": "NATION_1", "office_2": "NATION_2"}
    return serving.authoritative(two_sources(spark, sf), homes)


@query
def multi_source_grains(spark, sf):
    """Monthly and yearly totals in one table of dated values."""
    orders = table(spark, sf, "orders")
    parts = []
    for grain, unit in (("annual", "year"), ("monthly", "month")):
        period = F.date_trunc(unit, "o_orderdate").cast("date")
        parts.append(orders.groupBy(period.alias("period_start")).agg(F.count("*").alias("n_orders")).select(
            F.lit(grain).alias("grain"), "period_start", "n_orders"))
    return parts[0].unionByName(parts[1])


@query
def load_years(spark, sf):
    """Orders by the year a load run on their date would be for."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").groupBy(
        dates.load_year(day).cast("long").alias("load_year"),
        dates.is_quarter_end_month(day).alias("quarter_end")).agg(F.count("*").alias("n_orders"))


# --- Quality ----------------------------------------------------------------


@query
def dq_not_null(spark, sf):
    bronze = adapt.order_observations(spark, sf)
    return quality.null_counts(bronze, ["country_code", "indicator_code", "year", "value"], "observations")


@query
def dq_unique(spark, sf):
    bronze = adapt.order_observations(spark, sf)
    return quality.duplicates(bronze, ["country_code", "indicator_code", "year"])


@query
def dq_accepted(spark, sf):
    return quality.unexpected_values(table(spark, sf, "orders"), "o_orderstatus", ["F", "O"])


@query
def dq_relationships(spark, sf):
    """Line items whose supplier is not among the suppliers in credit."""
    in_credit = table(spark, sf, "supplier").filter(F.col("s_acctbal") > 0)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return quality.orphans(lines, "l_suppkey", in_credit, "s_suppkey").groupBy("l_suppkey").agg(
        F.count("*").alias("n_rows"))


@query
def dq_positive(spark, sf):
    """Customers of three segments whose balance is not positive."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    levels = customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD"))
    return quality.non_positive(customer, levels, "c_mktsegment", "c_acctbal")


@query
def dq_future(spark, sf):
    gold = adapt.order_star(spark, sf)[1]
    return quality.future_rows(gold.fact, gold.dim_dates, dt.date(2000, 6, 30))


@query
def dq_suite(spark, sf):
    cleaned, gold = adapt.order_star(spark, sf)
    checks = quality.gold_checks(gold, dt.date(2000, 6, 30), gdp_codes=["1-URGENT", "2-HIGH"])
    return checks.unionByName(quality.staging_checks(cleaned))


@query
def dq_ranges(spark, sf):
    named = serving.named_facts(adapt.order_star(spark, sf)[1])
    return quality.out_of_range(
        named.filter(F.col("indicator_code") == "3-MEDIUM"), "value", 100000.0, 400000.0
    ).select("country_code", "year", "value")


@query
def dq_named_ranges(spark, sf):
    """Violations of three ranges by code, two closed and one open, counted in one pass."""
    named = serving.named_facts(adapt.order_star(spark, sf)[1])
    return quality.indicator_range_checks(named, [
        ("1-URGENT", 50000.0, 300000.0), ("2-HIGH", 1000.0, None), ("3-MEDIUM", 100000.0, 400000.0)])


# --- Sinks and verification ---------------------------------------------------


@query
def seed_csv(spark, sf):
    """Nations kept as CSV with a header line, read back by their schema, beside a dataset ensured to be there."""
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    path, empty = new_table_path(spark, "seed"), new_table_path(spark, "ensured")
    nation.write.csv(path, header=True)
    seed = tables.read_seed(spark, path, nation.schema)
    sinks.ensure_dataset(spark, empty, nation.schema)
    return seed.unionByName(tables.read_dataset(spark, empty))


@query
def publish_counts(spark, sf):
    gold = adapt.order_star(spark, sf)[1]
    base = new_table_path(spark, "published")
    sinks.publish(gold.tables(), sinks.path_writer(base))
    return sinks.row_counts({n: tables.read_dataset(spark, f"{base}/{n}") for n in gold.tables()})


@query
def publish_gate(spark, sf):
    """The star published behind checks, then again with facts that must not be; counts of checks and of what readers see."""
    gold = adapt.order_star(spark, sf)[1]
    folder = new_table_path(spark, "gated")
    checks = {"fact_economic_indicators": [gate.not_null("value"), gate.not_null("country_key"), gate.within("value", 0, 10**9)],
              "dim_countries": [gate.not_null("country_code")]}
    first = gate.publish_checked(gold.tables(), folder, checks)
    spoilt = F.when(F.year("period_start") != 1995, F.col("value"))
    bad = {"fact_economic_indicators": gold.fact.withColumn("value", spoilt), "dim_countries": gold.dim_countries.limit(1)}
    second = gate.publish_checked(bad, folder, checks)
    seen = sinks.row_counts({name: gate.read_published(spark, folder, name) for name in gold.tables()})
    return longs(first.withColumn("attempt", F.lit(1)).unionByName(second.withColumn("attempt", F.lit(2))).unionByName(
        seen.select("table_name", F.lit("published").alias("check_name"), "n_rows", F.lit(0).cast("long").alias("n_failing"),
                    F.lit(None).cast("int").alias("version"), F.lit(3).alias("attempt"))), "attempt", "version")


@query
def layered_build(spark, sf):
    """Orders by country and year, built from raw tables through staging views by names alone."""
    layers = Layers({"raw_orders": adapt.order_observations(spark, sf), "seed_countries": adapt.country_seed(spark, sf)})

    @layers.add("mart_totals", ("mart_yearly", "stg_countries"), "marts")
    def totals(ref):
        joined = ref("mart_yearly").join(ref("stg_countries"), "country_code")
        return joined.groupBy("region").agg(F.sum("n").alias("n"), F.countDistinct("country_code").alias("n_countries"), F.max("year").alias("last_year"))

    @layers.add("mart_yearly", ("stg_observations",), "marts")
    def yearly(ref):
        return ref("stg_observations").groupBy("country_code", "year").agg(F.count("*").alias("n"))

    @layers.add("stg_observations", ("raw_orders",))
    def observations(ref):
        return silver.clean_observations(ref("raw_orders"), (F.col("obs_id"),))

    @layers.add("stg_countries", ("seed_countries",))
    def countries(ref):
        return ref("seed_countries").select("country_code", "region")

    return longs(layers.build(["mart_totals"])["mart_totals"], "n", "n_countries", "last_year")


@query
def layer_reconciliation(spark, sf):
    cleaned, gold = adapt.order_star(spark, sf)
    bronze = adapt.order_observations(spark, sf).filter(F.col("value").isNotNull())
    source = sinks.row_counts({"observations": bronze, "facts": cleaned, "countries": table(spark, sf, "nation")})
    target = sinks.row_counts({"observations": cleaned, "facts": gold.fact, "countries": gold.dim_countries})
    return sinks.reconcile(source, target)


@query
def bronze_profile(spark, sf):
    return adapt.order_observations(spark, sf).agg(
        F.count("*").alias("n_rows"), F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        F.countDistinct("indicator_code").alias("n_indicators"), F.countDistinct("country_code").alias("n_countries"))


@query
def partition_summary(spark, sf):
    """Rows of each year after writing the observations by year, twice for one year."""
    bronze = adapt.order_observations(spark, sf)
    path = new_table_path(spark, "by-year")
    sinks.write_by_year(bronze, path)
    sinks.write_by_year(bronze.filter(F.col("year") == 1997), path)
    stored = tables.read_observations(spark, path, bronze.schema)
    return stored.groupBy("year").agg(
        F.count("*").alias("n_rows"), F.countDistinct("indicator_code").alias("n_indicators"))


@query
def stored_files(spark, sf):
    """Rows counted through the file listing of a stored table."""
    path = new_table_path(spark, "files")
    sinks.write_by_year(adapt.order_observations(spark, sf), path)
    stored = tables.read_dataset(spark, tables.require_path(spark, path))
    files = tables.list_files(stored)
    year = F.regexp_extract("file_path", r"year=(\d+)", 1).cast("long")
    return files.filter(F.col("file_size") > 0).groupBy(year.alias("year")).agg(
        F.sum("n_rows").alias("n_rows"))


@query
def search_rows_upsert(spark, sf):
    """Search rows of the parts, the large ones re-described, merged by code into a second version."""
    gold = adapt.trade_star(spark, sf)[1]
    old = sinks.indicator_search_rows(gold.dim_indicators)
    new = old.filter(F.col("category") == "large").withColumn("description", F.lit("re-described"))
    path = new_table_path(spark, "search-rows")
    keyed.write_keyed(old, path, ["indicator_code"], 16)
    keyed.write_keyed(new, path, ["indicator_code"])
    return keyed.read_table(spark, path)


@query
def document_search_rows(spark, sf):
    docs = adapt.catalogue_documents(spark, sf).withColumn(
        "doc_type", F.when(F.col("doc_type") != "src3", F.col("doc_type")))
    return sinks.document_search_rows(docs)


# --- Landed API responses -----------------------------------------------------


@query
def normalise_observations(spark, sf):
    """Orders as JSON entries; only nations of even number have a known name."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    entry = F.to_json(F.struct(
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("economy"),
        F.col("o_orderpriority").alias("series"),
        F.concat(F.lit("YR"), F.year("o_orderdate").cast("string")).alias("time"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("value")))
    landed = orders.join(customer, orders.o_custkey == customer.c_custkey).select(entry.alias("body"))
    nation = table(spark, sf, "nation")
    countries = nation.filter(F.col("n_nationkey") % 2 == 0).select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"), F.col("n_name").alias("name"))
    series = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("code")).distinct().filter(
        F.col("code") != "5-LOW").withColumn("name", F.concat(F.lit("Orders "), "code"))
    rows = landing.normalise_observations(landed, countries, series)
    return rows.drop("_ingested_at")


def search_pages(spark, sf) -> DataFrame:
    """Search pages of 50 documents: one query finds all, a second finds the English ones again."""
    docs = table(spark, sf, "documents")
    record = F.struct(
        F.concat(F.lit("  Report \t no. "), F.col("doc_id").cast("string"), F.lit("  ")).alias("display_title"),
        F.create_map(F.lit("a"), F.lit("short"), F.lit("b"), F.col("text")).alias("abstracts"),
        F.when(F.col("lang") == "en", "2024-01-01").otherwise("").alias("display_date"),
        F.lit("2023-12-31").alias("docdt"),
        F.col("source").alias("docty"),
        F.array(F.col("lang"), F.col("source")).alias("count"),
        F.lit(" Trade  Policy ").alias("topicv3"),
        F.col("lang").alias("lang"))
    first = docs.select(F.lit(0).alias("query_no"), "doc_id", record.alias("record"))
    second = docs.filter(F.col("lang") == "en").select(F.lit(1).alias("query_no"), "doc_id", record.alias("record"))
    page_no = F.floor(F.col("doc_id") / fv.SEARCH_PAGE_SIZE).cast("int")
    entries = first.unionByName(second).withColumn("page", page_no)
    # A page holds at most 50 documents, so the list collected per page is bounded.
    listed = F.array_sort(F.collect_list(F.struct("doc_id", F.to_json("record").alias("record"))))
    as_json = F.transform(listed, lambda e: F.concat(F.lit('"'), e["doc_id"].cast("string"), F.lit('":'), e["record"]))
    return entries.groupBy("query_no", "page").agg(F.concat(
        F.lit('{"total": '), F.count("*").cast("string"), F.lit(', "documents": {'), F.array_join(as_json, ","),
        F.lit("}}")).alias("body"))


@query
def normalise_documents(spark, sf):
    return landing.normalise_documents(search_pages(spark, sf), max_results=None).drop("_ingested_at")


@query
def search_result_cap(spark, sf):
    capped = landing.normalise_documents(search_pages(spark, sf), max_results=fv.SEARCH_RESULT_CAP)
    return capped.select("doc_id", "title", "countries")


@query
def landed_source(spark, sf):
    """Landed pages read through their own format, conditions on the query left to it."""
    folder = new_table_path(spark, "landed")
    landed_pages.write_pages(search_pages(spark, sf), folder)
    pages = landed_pages.read_landed(spark, folder, 20).filter(F.col("query_no") == 1)
    return landing.normalise_documents(pages).drop("_ingested_at")


@query
def landed_stream(spark, sf):
    """Landed pages read as a stream that is started again after more of them arrived."""
    pages = materialize(search_pages(spark, sf), "pages")
    folder, stored, checkpoint = (new_table_path(spark, name) for name in ("landed", "pages-read", "progress"))
    for arrived in ((F.col("query_no") == 0) & (F.col("page") < 10), F.lit(True)):
        there = landed_pages.read_landed(spark, folder).select("query_no", "page")
        landed_pages.write_pages(pages.filter(arrived).join(there, ["query_no", "page"], "left_anti"), folder)
        landed_pages.stream_landed(spark, folder).writeStream.format("parquet").option("path", stored).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return landing.normalise_documents(tables.read_dataset(spark, stored)).drop("_ingested_at")


# --- Text ---------------------------------------------------------------------


@query
def doc_clean(spark, sf):
    cleaned = text.collapse_whitespace(F.col("text"))
    return adapt.documents(spark, sf).select(
        "doc_id", cleaned.alias("cleaned"), F.length(cleaned).cast("long").alias("n_chars"))


@query
def text_url_rewrite(spark, sf):
    """Addresses of extracted texts; every other page has a document address."""
    page = F.col("page_id").cast("string")
    address = F.concat(F.col("url"), F.lit("/pdf/"), page, F.when(F.col("page_id") % 2 == 0, ".PDF").otherwise(".html"))
    return table(spark, sf, "pages").select("page_id", text.text_url(address).alias("text_url"))


@query
def chunk_documents(spark, sf):
    return chunking.chunk_documents(adapt.documents(spark, sf).select("doc_id", "text"))


@query
def chunk_paragraphs(spark, sf):
    """Chunks of documents whose lines are set apart as paragraphs, of 600 characters with 80 carried."""
    spaced = F.replace("text", F.lit("\n"), F.lit("\n \n"))
    docs = adapt.documents(spark, sf).select("doc_id", spaced.alias("text"))
    return chunking.chunk_documents(docs, size=600, overlap=80)


@query
def chunk_stats(spark, sf):
    chunks = chunking.chunk_documents(adapt.documents(spark, sf).select("doc_id", "text"))
    return longs(chunking.chunk_statistics(chunks), "min_chars", "max_chars")


@query
def text_coverage(spark, sf):
    """Labelled documents that have a text, of all documents and labels."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id").distinct()
    return chunking.text_coverage(labels.join(docs, "doc_id", "left"))


@query
def sentence_split(spark, sf):
    docs = adapt.documents(spark, sf)
    return docs.select("doc_id", F.posexplode(text.sentences(F.col("text"))).alias("n", "sentence")).withColumn(
        "n", F.col("n").cast("long"))


@query
def fixed_slices(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.posexplode(text.slices(F.col("text"), 1000)).alias("n", "slice")).withColumn(
        "n", F.col("n").cast("long"))


@query
def delivery_slices(spark, sf):
    answers = table(spark, sf, "conversations").filter(F.col("role") == "assistant").select("conv_id", "turn", "text")
    pieces = chat.deliver(answers, marker="nicht", note="\n\n---\n*For information only.*")
    return longs(pieces, "piece_no")


@query
def citation_check(spark, sf):
    """Answers with labels put behind them, by turn and conversation."""
    turns = table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    conv = F.col("conv_id")
    label = (
        F.when(conv % 4 == 0, "")
        .when(conv % 4 == 1, F.concat(F.lit(" [Doc_1][Doc_"), F.col("turn").cast("string"), F.lit("]")))
        .when(conv % 4 == 2, " [Doc_0] [Doc_2]")
        .otherwise(" [Doc_x] [Doc_3]")
    )
    answers = turns.select("conv_id", "turn", F.concat("text", label).alias("text"), (F.col("turn") % 5).alias("blocks"))
    checked = chat.check_citations(answers)
    return checked.select("conv_id", "turn", "citations_ok",
                          text.citation_labels(F.col("text")).cast("long").alias("n_labels"))


# --- Search -------------------------------------------------------------------

DOCUMENT_FIELDS = [("text", 1.0, "text")]


@query
def bm25_documents(spark, sf):
    """Ten best documents for every benchmark text."""
    queries = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    hits = search.search(adapt.documents(spark, sf), queries, "doc_id", DOCUMENT_FIELDS, k=10, fuzzy=False)
    return longs(hits, "rank")


@query
def lexical_indicators(spark, sf):
    """Ten best parts for every benchmark text with a misspelt part name."""
    parts = adapt.part_seed(spark, sf)
    return longs(search.search(parts, adapt.part_questions(spark, sf), k=10), "rank")


@query
def search_all(spark, sf):
    """Indicators and documents found for the same questions, by type."""
    queries = adapt.part_questions(spark, sf)
    parts = search.search(adapt.part_seed(spark, sf), queries, k=5, fuzzy=False).withColumn("type", F.lit("indicator"))
    docs = adapt.catalogue_documents(spark, sf)
    fields = [("title", 2.0, "text"), ("abstract", 1.0, "text"), ("topics", 1.0, "text")]
    found = search.search(docs, queries, "doc_id", fields, k=5, fuzzy=False).withColumn("type", F.lit("document"))
    return longs(parts.unionByName(found), "rank")


@query
def fuzzy_terms(spark, sf):
    """Words of the documents that a word of a benchmark text may stand for."""
    index = search.index_words(adapt.documents(spark, sf), "doc_id", DOCUMENT_FIELDS)
    known = materialize(search.vocabulary(index), "vocabulary").filter(F.col("word") != search.ALL_ROWS)
    queries = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    matches = search.match_words(search.query_words(queries, DOCUMENT_FIELDS), known)
    return matches.select("word", "known_word", F.col("distance").cast("long").alias("distance"))


@query
def search_postings(spark, sf):
    """Stored word index of the parts, read back as one row per word."""
    path = new_table_path(spark, "index")
    sinks.write_dataset(search.index_words(adapt.part_seed(spark, sf), "indicator_code", fv.SEARCH_FIELDS), path)
    return longs(search.postings(tables.read_dataset(spark, path)), "len", "tf")


def benchmark_queries(spark, sf) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


@query
def search_stored(spark, sf):
    """Ten best documents for every benchmark text, from a stored index."""
    folder = adapt.document_index(spark, sf)
    return longs(stored_index.search_stored(spark, folder, benchmark_queries(spark, sf), 10, fuzzy=False), "rank")


@query
def search_after_update(spark, sf):
    """Ten best parts from an index to which parts were added, in which some changed and from which some went."""
    parts = adapt.part_seed(spark, sf)
    number = F.substring("indicator_code", 2, 20).cast("long")
    folder = new_table_path(spark, "changing-index")
    stored_index.write_index(parts.filter(number % 3 != 0).withColumn("description", F.lower("category")), folder)
    stored_index.add_rows(parts.filter((number % 3 == 0) | (number % 3 == 1)), folder)
    stored_index.delete_rows(parts.filter(number % 10 == 7), folder)
    return longs(stored_index.search_stored(spark, folder, adapt.part_questions(spark, sf), 10), "rank")


@query
def vector_topk(spark, sf):
    """Twenty nearest vectors to the first vector of every label."""
    rows = table(spark, sf, "embeddings")
    firsts = rows.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
    queries = firsts.join(rows.select("vec_id", "embedding"), "vec_id").select(
        F.col("label").cast("long").alias("query_id"), "embedding")
    hits = cells.nearest_in_cells(adapt.vector_cells(spark, sf), queries, fv.SEMANTIC_SIZE)
    return longs(hits, "rank").withColumn("similarity", F.round("similarity", 6))


@query
def vector_distances(spark, sf):
    """Distance of every vector from the first one of its label."""
    rows = table(spark, sf, "embeddings")
    firsts = rows.groupBy("label").agg(F.min("vec_id").alias("first_id"))
    heads = firsts.join(rows.select(F.col("vec_id").alias("first_id"), F.col("embedding").alias("head")), "first_id")
    near = rows.join(heads.select("label", "head"), "label")
    distance = vectors.cosine_distance(F.col("embedding"), F.col("head"))
    return near.select("vec_id", F.round(distance, 6).alias("distance"))


@query
def embedding_roundtrip(spark, sf):
    """Vectors written as text and read back, with their metadata as JSON."""
    written = adapt.source_vectors(spark, sf).withColumn("literal", vectors.vector_literal(F.col("embedding")))
    parsed = vectors.parse_vector(F.col("literal"))
    meta = F.from_json("metadata", "map<string,string>")
    return written.select(
        "row_id", "source_id", F.size(parsed).cast("long").alias("dimension"),
        (parsed == F.col("embedding")).alias("same"), meta["id"].alias("meta_id"), meta["label"].alias("meta_label"))


@query
def embedding_counts(spark, sf):
    return adapt.source_vectors(spark, sf).agg(
        F.count_if(F.col("source_type") == "indicator").alias("n_indicators"),
        F.count_if(F.col("source_type") == "document").alias("n_documents"),
        F.countDistinct("source_id").alias("n_sources"))


@query
def embed_text_compose(spark, sf):
    parts = adapt.part_seed(spark, sf).withColumn(
        "description", F.when(F.col("category") != "promo", F.col("description")))
    indicators = parts.select(
        F.lit("indicator").alias("source_type"), F.col("indicator_code").alias("source_id"),
        vector.indicator_text(F.col("indicator_code"), F.col("indicator_name"), F.col("category"), F.col("description")).alias("text"))
    docs = adapt.catalogue_documents(spark, sf)
    documents = docs.select(
        F.lit("document").alias("source_type"), F.col("doc_id").alias("source_id"),
        vector.chunk_text(F.col("title"), F.col("abstract")).alias("text"))
    return indicators.unionByName(documents)


VECTORS_PER_TASK = 50_000


@query
def embedding_store(spark, sf):
    """Embedding rows of the parts with their vectors, stored twice under the same keys.

    A vector is shown as its slots that are not zero, in hundred-thousandths.
    """
    # A row grows by its vector: the parts are dealt by their number, for the bytes of a file do not tell it.
    parts = adapt.part_seed(spark, sf)
    parts = scale.deal_by(parts, parts.columns, parts.count(), VECTORS_PER_TASK)
    texts = parts.withColumn("text", vector.indicator_text(
        F.col("indicator_code"), F.col("indicator_name"), F.col("category"), F.col("description")))
    columns = ["indicator_code", "indicator_name", "category", "description"]
    rows = vector.embedding_rows(vector.embed_hashed(texts, dimension=32), "indicator", "indicator_code", columns)
    path = new_table_path(spark, "embeddings")
    for _ in range(2):
        keyed.write_keyed(rows, path, ["source_type", "source_id", "text"], 16)
    shown = F.transform("embedding", lambda w, slot: F.when(w != 0, F.concat(
        slot.cast("string"), F.lit(":"), F.round(w.cast("double") * 100_000).cast("long").cast("string"))))
    return keyed.read_table(spark, path).select(
        "source_type", "source_id", "text", "metadata", F.array_join(shown, " ").alias("vector"))


@query
def hashed_embed(spark, sf):
    """Hashed word vectors of all chunks, one row for each slot that is not zero."""
    chunks = chunking.chunk_documents(adapt.documents(spark, sf).select("doc_id", "text"))
    embedded = vector.embed_hashed(chunks)
    # Taken out of the array as it is exploded: Spark tests an exploded column for entries first, which embeds every chunk twice.
    filled = F.filter(F.transform("embedding", lambda w, slot: F.struct(
        slot.cast("long").alias("slot"), w.alias("weight"))), lambda s: s["weight"] != 0)
    return embedded.select("chunk_id", "doc_id", F.inline(filled)).select(
        "chunk_id", "doc_id", "slot", F.round(F.col("weight").cast("double"), 5).alias("weight"))


@query
def embed_hook(spark, sf):
    """Parts embedded by a function of the user: characters, blanks and vowels of a text."""
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("text"))

    def embed(texts: list[str]) -> list[list[float]]:
        return [[len(t), t.count(" "), sum(t.count(v) for v in "aeiou")] for t in texts]

    parts_of = F.transform("embedding", lambda v: v.cast("double"))
    return vector.embed_with(parts, embed).select(
        "p_partkey", *[F.get(parts_of, n).alias(name) for n, name in enumerate(("n_chars", "n_blanks", "n_vowels"))])


@query
def rrf_fusion(spark, sf):
    fused = rrf_hits(spark, sf)
    return longs(fused.select("query_id", "id", "type", F.round("score", 9).alias("score"), "rank",
                              properties_text(F.col("properties")).alias("properties")), "rank")


def rrf_hits(spark, sf) -> DataFrame:
    """Anchors of the misspelt part questions."""
    asked = adapt.part_questions(spark, sf).withColumnRenamed("query", "search_text")
    lexical = retrieval.lexical_hits(
        adapt.part_seed(spark, sf), asked, fv.LEXICAL_SIZE_IN_RETRIEVAL, adapt.part_index(spark, sf))
    semantic = retrieval.semantic_hits(
        adapt.source_vectors(spark, sf), adapt.item_vectors(spark, sf), fv.SEMANTIC_SIZE_IN_RETRIEVAL,
        adapt.vector_cells(spark, sf))
    return fusion.fuse(lexical, semantic)


# --- Reading questions ----------------------------------------------------------


@query
def query_expansion(spark, sf):
    phrases = text.expand_phrases(F.col("query"))
    return adapt.questions(spark, sf).select("query_id", F.posexplode(phrases).alias("n", "phrase")).withColumn(
        "n", F.col("n").cast("long"))


@query
def country_resolution(spark, sf):
    codes = text.resolve_countries(F.col("query"))
    return adapt.questions(spark, sf).select("query_id", F.posexplode(codes).alias("n", "country_code")).withColumn(
        "n", F.col("n").cast("long"))


@query
def question_flags(spark, sf):
    read = context.read_questions(adapt.questions(spark, sf))
    return longs(read.select("query_id", "is_comparison", "year"), "year")


# --- Graph ----------------------------------------------------------------------


def properties_text(properties: Column) -> Column:
    entries = F.array_sort(F.map_entries(properties))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), "|")


@query
def graph_nodes(spark, sf):
    nodes, _ = adapt.trade_graph(spark, sf)
    return nodes.select("type", "id", properties_text(F.col("properties")).alias("properties"))


@query
def graph_node_ids(spark, sf):
    """Pages resolved to the first of code, name, document and own id that is there."""
    pages, page = table(spark, sf, "pages"), F.col("page_id")
    code = F.when(page % 4 == 0, F.concat(F.lit("P"), page.cast("string"))).otherwise("")
    name = F.when(page % 4 == 1, F.col("url"))
    doc = F.when(page % 4 == 2, page.cast("string"))
    return pages.select("page_id", graph.node_id(code, name, doc, F.concat(F.lit("node-"), page.cast("string"))).alias("node"))


@query
def graph_edges(spark, sf):
    return adapt.trade_graph(spark, sf)[1]


@query
def doc_country_edges(spark, sf):
    gold = adapt.order_star(spark, sf)[1]
    edges = graph.document_country_edges(adapt.catalogue_documents(spark, sf), gold.dim_countries)
    return edges.select(F.col("src").alias("doc_id"), F.col("dst").alias("country_code"))


@query
def doc_topic_edges(spark, sf):
    docs = adapt.catalogue_documents(spark, sf)
    nodes = graph.topic_nodes(docs).select(F.lit("").alias("doc_id"), F.col("id").alias("topic"))
    return graph.topic_edges(docs).select(F.col("src").alias("doc_id"), F.col("dst").alias("topic")).unionByName(nodes)


@query
def graph_upsert(spark, sf):
    """Countries renamed and edges added to stored tables; edges without both ends are left out.

    All nodes and edges as stored, in their second versions.
    """
    nodes, edges = adapt.trade_graph(spark, sf)
    new_name = F.concat(F.lit("The "), F.col("id"))
    renamed = nodes.filter(F.col("type") == "Country").withColumns(
        {"name": new_name, "properties": F.create_map(F.lit("name"), new_name)})
    node_path, edge_path = new_table_path(spark, "node-table"), new_table_path(spark, "edge-table")
    keyed.create_table(nodes, node_path, ["type", "id"], 16)
    keyed.merge_table(renamed, node_path, graph.upsert_nodes)
    merged = keyed.read_table(spark, node_path)
    extra = table(spark, sf, "supplier").select(
        F.lit("Country").alias("src_type"), F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("src"),
        F.lit("HAS_INDICATOR").alias("rel"), F.lit("Indicator").alias("dst_type"),
        F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("dst"))
    dangling = extra.withColumn("dst", F.concat(F.lit("Q"), "dst"))
    keyed.create_table(edges.select(*graph.EDGE_COLUMNS), edge_path, graph.EDGE_COLUMNS, 16)
    keyed.merge_table(extra.unionByName(dangling), edge_path, lambda old, new: graph.upsert_edges(old, new, merged))
    linked = keyed.read_table(spark, edge_path)
    return merged.select(
        F.lit("node").alias("kind"), F.col("type").alias("label"), "id", F.coalesce("name", F.lit("")).alias("name"),
        F.lit("").alias("target"), properties_text(F.col("properties")).alias("properties"),
    ).unionByName(linked.select(
        F.lit("edge").alias("kind"), F.col("rel").alias("label"), F.concat_ws(":", "src_type", "src").alias("id"),
        F.lit("").alias("name"), F.concat_ws(":", "dst_type", "dst").alias("target"), F.lit("").alias("properties")))


@query
def lineage_paths(spark, sf):
    """Messages with the one or two messages each follows in its conversation."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn")
    before = turns.withColumn("turn", F.col("turn") + 1).withColumn("_before", F.col("turn") - 1)
    linked = turns.join(before, ["conv_id", "turn"])
    name = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col(turn).cast("string"))
    edges = linked.select(
        F.lit("Message").alias("src_type"), name("turn").alias("src"), F.lit("DERIVED_FROM").alias("rel"),
        F.lit("Message").alias("dst_type"), name("_before").alias("dst"))
    return graph.paths_up_to_two(edges, "DERIVED_FROM", "message", "upstream")


@query
def graph_expand_indicator(spark, sf):
    """First rows of the chain from every part."""
    nodes, edges = adapt.trade_graph(spark, sf)
    parts = nodes.filter(F.col("type") == "Indicator").select(F.col("id").alias("i"))
    rows = graph.indicator_rows(nodes, edges, parts, lists=adapt.trade_lists(spark, sf))
    return longs(rows.select("i", "cat", "c", "d", "row_no"), "row_no")


@query
def graph_expand_country(spark, sf):
    nodes, edges = adapt.trade_graph(spark, sf)
    countries = nodes.filter(F.col("type") == "Country").select(F.col("id").alias("c"))
    return longs(graph.country_rows(nodes, edges, countries, lists=adapt.trade_lists(spark, sf)), "row_no")


@query
def graph_expand_lineage(spark, sf):
    """The chain with source tables, columns and their upstream columns."""
    nodes, edges = adapt.trade_graph(spark, sf)
    line_nodes, line_edges = adapt.lineage(spark, sf)
    nodes, edges = nodes.unionByName(line_nodes), edges.unionByName(line_edges)
    parts = adapt.anchors(spark, sf).filter(F.col("type") == "Indicator").select(F.col("id").alias("i"))
    return longs(graph.indicator_rows(nodes, edges, parts), "row_no")


def expanded_anchors(spark, sf) -> DataFrame:
    nodes, edges = adapt.trade_graph(spark, sf)
    return graph.expand(nodes, edges, adapt.anchors(spark, sf), max_nodes=50, lists=adapt.trade_lists(spark, sf))


@query
def graph_expand(spark, sf):
    """Nodes around the anchors of every benchmark text."""
    return longs(expanded_anchors(spark, sf).select("query_id", "place", "type", "id"), "place")


# --- Context ----------------------------------------------------------------------


def anchor_nodes(spark, sf) -> DataFrame:
    nodes, _ = adapt.trade_graph(spark, sf)
    return adapt.anchors(spark, sf).join(nodes, ["type", "id"]).select("query_id", "rank", "type", "id", "properties")


def ranked_nodes(spark, sf) -> DataFrame:
    def build():
        both = context.combine_nodes(anchor_nodes(spark, sf), expanded_anchors(spark, sf))
        flagged = F.when(F.col("id") == "P7", F.map_concat("properties", F.create_map(F.lit("is_deprecated"), F.lit("true"))))
        both = both.withColumn("properties", F.coalesce(flagged, F.col("properties")))
        return materialize(context.rerank(both, 100), "ranked")

    return adapt.once(spark, sf, "ranked_nodes", build)


@query
def rerank_nodes(spark, sf):
    return longs(ranked_nodes(spark, sf).select("query_id", "rank", "type", "id", "score"), "rank")


@query
def layer_boost(spark, sf):
    """Documents by the layer their language is kept in, the Spanish ones inactive."""
    layer = F.when(F.col("lang") == "en", "gold").when(F.col("lang") == "fr", "silver").when(F.col("lang") == "de", "bronze")
    docs = table(spark, sf, "documents").select(
        "doc_id", F.map_filter(F.create_map(
            F.lit("layer"), layer, F.lit("is_active"), F.when(F.col("lang") == "es", "false")),
            lambda _, v: v.isNotNull()).alias("properties"))
    return context.score_layers(docs).select("doc_id", "score")


@query
def assemble_context(spark, sf):
    return context.assemble(ranked_nodes(spark, sf))


@query
def fact_lines(spark, sf):
    """Facts for the parts of every benchmark text, whose text asks in one of three ways."""
    gold = adapt.trade_star(spark, sf)[1]
    item = F.col("item_id")
    asked = table(spark, sf, "benchmark").select(item.alias("query_id"), (item % 3 == 0).alias("is_comparison"),
        F.when(item % 3 == 1, 1999).alias("year"),
        F.array(F.concat(F.lit("NATION_"), (item % 25).cast("string")),
                F.concat(F.lit("NATION_"), ((item + 5) % 25).cast("string"))).alias("countries"))
    facts = context.question_facts(ranked_nodes(spark, sf), asked, gold)
    return longs(facts, "node_rank", "country_no", "year")


@query
def retrieve_context(spark, sf):
    """The whole batch: search, fuse, expand, rerank, look up facts, assemble."""
    _, gold = adapt.trade_star(spark, sf)
    nodes, edges = adapt.trade_graph(spark, sf)
    return retrieval.retrieve(
        adapt.part_questions(spark, sf), adapt.part_seed(spark, sf), adapt.source_vectors(spark, sf),
        adapt.item_vectors(spark, sf), nodes, edges, gold,
        index=adapt.part_index(spark, sf), cells=adapt.vector_cells(spark, sf),
        lists=adapt.trade_lists(spark, sf))


NATION_ALIASES = [(f"nation_{n}", f"NATION_{n}") for n in range(25)]


@query
def retrieve_facts(spark, sf):
    """Contexts with facts: questions about two countries over time, one in a year, one lately, and none.

    The facts are dated ten years later, as questions name years from 2000 on.
    Nodes that are anchors and expanded ones are shown twice.
    """
    _, gold = adapt.trade_star(spark, sf)
    gold = replace(gold, fact=gold.fact.withColumn("period_start", F.add_months("period_start", 120)))
    nodes, edges = adapt.trade_graph(spark, sf)
    one, other = (F.concat(F.lit("nation_"), ((F.col("query_id") + n) % 25).cast("string")) for n in (0, 5))
    ending = F.concat(F.lit(" of "), F.when(F.col("query_id") % 4 == 0, F.concat(one, F.lit(" and "), other, F.lit(" compare")))
                      .when(F.col("query_id") % 4 == 1, F.concat(one, F.lit(" 2005"))).otherwise(one))
    questions = adapt.part_questions(spark, sf).withColumn(
        "query", F.when(F.col("query_id") % 4 < 3, F.concat("query", ending)).otherwise(F.col("query")))
    return retrieval.retrieve(
        questions, adapt.part_seed(spark, sf), adapt.source_vectors(spark, sf), adapt.item_vectors(spark, sf), nodes, edges, gold,
        dedupe=False, index=adapt.part_index(spark, sf), cells=adapt.vector_cells(spark, sf), lists=adapt.trade_lists(spark, sf),
        aliases=NATION_ALIASES)


# --- Chat ----------------------------------------------------------------------------


def session_uuid(conv: Column) -> Column:
    h = F.md5(conv.cast("string"))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def chat_messages(spark, sf) -> DataFrame:
    """Turns as messages, a second apart, conversations a minute apart."""
    seconds = F.col("conv_id") * 60 + F.col("turn")
    created = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return table(spark, sf, "conversations").select(
        session_uuid(F.col("conv_id")).alias("session_id"), "role", F.col("text").alias("content"),
        created.alias("created_at"))


@query
def chat_sessions_recent(spark, sf):
    messages = chat_messages(spark, sf)
    sessions = messages.groupBy(F.col("session_id").alias("id")).agg(F.min("created_at").alias("created_at")).withColumn(
        "title", F.concat(F.lit("Chat "), F.left("id", F.lit(8))))
    return chat.recent_sessions(sessions)


@query
def chat_messages_recent(spark, sf):
    return chat.recent_messages(chat_messages(spark, sf))


@query
def append_messages(spark, sf):
    """Turns sent with session ids in several spellings; counts of what is stored."""
    conv = F.col("conv_id")
    spelt = (
        F.when(conv % 3 == 0, F.upper(session_uuid(conv)))
        .when(conv % 3 == 1, F.concat(F.lit("{"), F.md5(conv.cast("string")), F.lit("}")))
        .otherwise(F.concat(F.lit("no-session-"), conv.cast("string")))
    )
    requests = table(spark, sf, "conversations").select("conv_id", "turn", spelt.alias("session_id"), F.col("text").alias("query"))
    assigned = sinks.new_sessions(requests)
    sessions, messages = sinks.session_rows(assigned), sinks.message_rows(assigned)
    known = assigned.filter("not is_new").groupBy("session_id").agg(F.count("*").alias("n_messages"))
    fresh = sessions.agg(F.count("*").alias("n_messages")).select(F.lit("new").alias("session_id"), "n_messages")
    stored = messages.agg(F.count("*").alias("n_messages")).select(F.lit("all").alias("session_id"), "n_messages")
    return known.unionByName(fresh).unionByName(stored)


@query
def stored_messages(spark, sf):
    """Turns appended to the chat tables in two batches; what is stored, sessions that were opened named alike."""
    conv = F.col("conv_id")
    requests = table(spark, sf, "conversations").select(
        "role", F.when(conv % 3 != 2, F.upper(session_uuid(conv))).otherwise("").alias("session_id"),
        F.col("text").alias("query"))
    sessions, messages = new_table_path(spark, "sessions"), new_table_path(spark, "messages")
    for role in ("user", "assistant"):
        sinks.append_chat(requests.filter(F.col("role") == role).drop("role"), sessions, messages, role)
    opened = tables.read_dataset(spark, sessions).select(F.col("id").alias("session_id"), "title")
    return tables.read_dataset(spark, messages).join(opened, "session_id", "left").select(
        F.when(F.col("title").isNull(), F.col("session_id")).alias("session_id"), "role", "content",
        (F.col("title") == F.concat(F.lit("Chat "), F.left("session_id", F.lit(8)))).alias("is_titled"))


# --- Event metrics ---------------------------------------------------------------------


@query
def rate_per_minute(spark, sf):
    return metrics.rate(table(spark, sf, "events"))


VALUE_BOUNDS = [5.0, 10.0, 25.0, 50.0, 75.0, 100.0, 150.0, 200.0, 300.0]


@query
def p95_window(spark, sf):
    found = metrics.histogram_quantile(table(spark, sf, "events"), "value", VALUE_BOUNDS, 0.95, "1 hour")
    return found.withColumn("quantile", F.round("quantile", 6))


@query
def error_rate(spark, sf):
    return metrics.error_rate(table(spark, sf, "events"), F.col("event_type") == "error", "10 minutes", 600)


@query
def total_count(spark, sf):
    return metrics.total_count(table(spark, sf, "events"))


@query
def increase_5m(spark, sf):
    return metrics.increase(table(spark, sf, "events"))


@query
def rate_limit_violations(spark, sf):
    """Users with more than five events in a day."""
    return metrics.rate_limit_violations(table(spark, sf, "events"), "user_id", window="1 day")


def arriving_events(spark, sf, folder: str, part: int) -> None:
    """Put a third of the events, by time, into a folder as the next file."""
    events = table(spark, sf, "events")
    place = F.ntile(3).over(Window.orderBy("hour"))
    hours = events.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n")).withColumn("third", place)
    bounds = hours.groupBy("third").agg(F.min("hour").alias("low"), F.max("hour").alias("high")).filter(F.col("third") == part).first()
    if bounds is not None:
        hour = F.date_trunc("hour", "ts")
        events.filter((hour >= F.lit(bounds["low"])) & (hour <= F.lit(bounds["high"]))).write.mode("append").parquet(folder)


def streamed(spark, sf, name: str, keys: list[str], metric: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A metric run as a stream over events that arrive in three parts, stopped and started again before the last.

    Every window that a part changes is replaced in a keyed table, so the table
    has all windows, open ones too.
    """
    base = new_table_path(spark, name)
    for part in (1, 2, 3):
        arriving_events(spark, sf, f"{base}/in", part)
        if part > 1:
            stream = read_event_stream(spark, f"{base}/in", watermark="10 minutes")
            run_updates(stream, metric, f"{base}/out", keys, f"{base}/checkpoint")
    windows = keyed.read_table(spark, f"{base}/out")
    return windows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query
def stream_rate_per_minute(spark, sf):
    return streamed(spark, sf, "stream-rate", ["window_start", "event_type"], metrics.rate)


@query
def stream_p95_window(spark, sf):
    found = streamed(spark, sf, "stream-p95", ["window_start"], lambda events: metrics.histogram_quantile(
        events, "value", VALUE_BOUNDS, 0.95, "1 hour"))
    return found.withColumn("quantile", F.round("quantile", 6))


@query
def stream_increase_5m(spark, sf):
    return streamed(spark, sf, "stream-increase", ["window_start", "event_type"], metrics.increase)
