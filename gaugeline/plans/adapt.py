"""The given tables in the shapes the operators take.

The tables are a generic star schema with text; this module says what stands
for what: nations are countries, order priorities and parts are indicators,
orders and line items are observations, documents are documents, benchmark
texts and user turns are questions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.dates import calendar_between, year_end, year_start
from gaugeline.operators import cells, stored_index
from gaugeline.operators import graph as g
from gaugeline.operators.gold import Gold
from gaugeline.plans.medallion import build_star
from gaugeline.session import materialize, new_table_path
from gaugeline.sources.tables import spread_scan

_built: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build):
    """Build stored tables once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, spread over all cores."""
    return spread_scan(table(spark, sf_dir, "documents"), "doc_id")


# --- Observations from orders ----------------------------------------------


def order_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw observations: a pending order has no published value, and open
    orders write their country code carelessly."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    status = F.col("o_orderstatus")
    careless = F.concat(F.lit(" "), F.lower("n_name"), F.lit(" "))
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.when(status == "O", careless).otherwise(F.col("n_name")).alias("country_code"),
            F.concat(F.lit(" "), F.col("n_name")).alias("country_name"),
            F.col("o_orderpriority").alias("indicator_code"),
            F.concat(F.lit("Orders "), F.col("o_orderpriority")).alias("indicator_name"),
            F.year("o_orderdate").cast("long").alias("year"),
            F.when(status != "P", F.col("o_totalprice")).alias("value"),
            F.col("o_orderdate").alias("_ingested_at"),
            F.lit("world_bank").alias("_source"),
            F.col("o_orderkey").alias("obs_id"),
        )
    )


def country_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    in_asia = F.col("r_name") == "ASIA"
    income = (
        F.when(F.col("n_nationkey") % 3 == 0, "High income")
        .when(F.col("n_nationkey") % 3 == 1, "Upper-middle income")
        .otherwise("Lower-middle income")
    )
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("country_code"),
        F.when(~in_asia, F.col("n_name")).alias("country_name"),
        F.col("r_name").alias("region"),
        income.alias("income_group"),
        in_asia.cast("string").alias("is_asean"),
        (F.col("n_nationkey") == 0).cast("string").alias("is_primary"),
    )


def priority_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    priorities = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("code")).distinct()
    code = F.col("code")
    seed = priorities.select(
        code.alias("indicator_code"),
        F.concat(F.lit("Orders "), code).alias("indicator_name"),
        F.when(code.isin("1-URGENT", "2-HIGH"), "trade").otherwise("structure").alias("category"),
        F.lit("USD").alias("unit"),
        F.lit("annual").alias("frequency"),
        F.when(code == "5-LOW", "").otherwise(
            F.concat(F.lit("Total price of orders with priority "), code)).alias("description"),
    )
    return materialize(seed, "priority-seed")


def order_calendar(spark: SparkSession, sf_dir: str, source: str = "orders", day: str = "o_orderdate") -> DataFrame:
    """Calendar over the years that have rows."""
    years = table(spark, sf_dir, source).agg(
        F.min(F.year(day)).alias("first_year"), F.max(F.year(day)).alias("last_year"))
    return calendar_between(years.select(
        year_start(F.col("first_year")).alias("first_day"), year_end(F.col("last_year")).alias("last_day")))


def order_star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Gold]:
    """Silver and gold tables over the orders."""
    return once(spark, sf_dir, "order_star", lambda: build_star(
        order_observations(spark, sf_dir), country_seed(spark, sf_dir), priority_seed(spark, sf_dir),
        order_calendar(spark, sf_dir), (F.col("obs_id"),)))


# --- Observations from line items ------------------------------------------


def part_code(key: Column) -> Column:
    return F.concat(F.lit("P"), key.cast("string"))


def trade_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw observations with a part as indicator and the supplier's nation as country."""
    lines = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("country_code"),
            F.col("n_name").alias("country_name"),
            part_code(F.col("l_partkey")).alias("indicator_code"),
            part_code(F.col("l_partkey")).alias("indicator_name"),
            F.year("l_shipdate").cast("long").alias("year"),
            F.col("l_extendedprice").alias("value"),
            F.col("l_shipdate").alias("_ingested_at"),
            F.lit("world_bank").alias("_source"),
            "l_orderkey", "l_linenumber",
        )
    )


def part_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        part_code(F.col("p_partkey")).alias("indicator_code"),
        F.col("p_name").alias("indicator_name"),
        F.lower("p_type").alias("category"),
        F.lit("USD").alias("unit"),
        F.lit("annual").alias("frequency"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name"), F.lit(" size "),
                 F.col("p_size").cast("string")).alias("description"),
    )


def trade_star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Gold]:
    """Silver and gold tables over the line items."""
    return once(spark, sf_dir, "trade_star", lambda: build_star(
        trade_observations(spark, sf_dir), country_seed(spark, sf_dir), part_seed(spark, sf_dir),
        order_calendar(spark, sf_dir, "lineitem", "l_shipdate"),
        (F.col("l_orderkey"), F.col("l_linenumber"), F.col("value"))))


# --- Documents, questions, vectors -----------------------------------------

TOPICS = ["economy", "small", "medium", "promo", "standard", "large"]


def catalogue_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a title, two topics and two countries each."""
    docs = documents(spark, sf_dir)
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), "p_name")
    topics = F.array(*[F.lit(t) for t in TOPICS])
    number = F.col("doc_id")
    first_line = F.split_part("text", F.lit("\n"), F.lit(1))
    return docs.join(part, "doc_id", "left").select(
        number.cast("string").alias("doc_id"),
        F.concat(first_line, F.coalesce(F.concat(F.lit(" - "), "p_name"), F.lit(""))).alias("title"),
        F.col("text").alias("abstract"),
        F.lit("").alias("display_date"),
        F.col("source").alias("doc_type"),
        F.concat(F.lit("http://docs.example.org/pdf/"), number.cast("string"), F.lit(".pdf")).alias("pdf_url"),
        F.concat(F.lit("NATION_"), (number % 25).cast("string"), F.lit("; nation_"),
                 ((number * 7 + 3) % 25).cast("string"), F.lit(";NATION_"),
                 ((number * 3 + 1) % 25).cast("string")).alias("countries"),
        F.concat(F.get(topics, (number % 6).cast("int")), F.lit(";"),
                 F.get(topics, (F.floor(number / 6) % 6).cast("int"))).alias("topics"),
        F.col("lang").alias("language"),
    )


QUESTION_ENDINGS = [
    " lạm phát Việt Nam 2019",
    " So sánh tăng trưởng ASEAN",
    " GDP của Indonesia và Thái Lan (2021)",
    " dân số thế giới",
    " xuất khẩu Malaysia trend",
    " thất nghiệp Philippines x2004 2005 2010",
    " đầu tư Singapore compare Laos",
    "",
]


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn, ended with one of a few phrases."""
    turns = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    endings = F.array(*[F.lit(e) for e in QUESTION_ENDINGS])
    return turns.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"),
        F.concat("text", F.get(endings, ((F.col("conv_id") + F.col("turn")) % 8).cast("int"))).alias("query"),
    )


def part_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark text, ended with a misspelt part name and its type.

    The name loses its second character and swaps its last two.
    """
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"), "p_name", "p_type")
    n = F.length("p_name")
    misspelt = F.concat(
        F.left("p_name", F.lit(1)), F.substring("p_name", F.lit(3), n - 4),
        F.right("p_name", F.lit(1)), F.substring("p_name", n - 1, F.lit(1)))
    return table(spark, sf_dir, "benchmark").join(part, "item_id").select(
        F.col("item_id").alias("query_id"),
        F.concat("text", F.lit(" "), misspelt, F.lit(" "), F.lower("p_type")).alias("query"))


DOCUMENT_FIELDS = [("text", 1.0, "text")]


def document_index(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a stored word index of the documents."""

    def build():
        folder = new_table_path(spark, "document-index")
        stored_index.write_index(documents(spark, sf_dir).select("doc_id", "text"), folder, "doc_id", DOCUMENT_FIELDS)
        return folder

    return once(spark, sf_dir, "document_index", build)


def part_index(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a stored word index of the parts."""

    def build():
        folder = new_table_path(spark, "part-index")
        stored_index.write_index(part_seed(spark, sf_dir), folder)
        return folder

    return once(spark, sf_dir, "part_index", build)


def source_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding rows; even labels stand for parts, odd ones for documents."""
    kind = F.when(F.col("label") % 2 == 0, "indicator").otherwise("document")
    source_id = F.when(F.col("label") % 2 == 0, part_code(F.col("vec_id") % 50)).otherwise(
        (F.col("vec_id") % 200).cast("string"))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), source_id.alias("source_id"), kind.alias("source_type"),
        F.to_json(F.struct(source_id.alias("id"), F.col("label").cast("string").alias("label"))).alias("metadata"),
        "embedding",
    )


def vector_cells(spark: SparkSession, sf_dir: str) -> cells.Cells:
    """The embeddings in cells, by vec_id."""
    return once(spark, sf_dir, "vector_cells", lambda: cells.store_cells(table(spark, sf_dir, "embeddings")))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector that stands for each benchmark text."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id")).join(vectors, "query_id")


def trade_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of countries, parts, their types and the documents."""

    def build():
        _, gold = trade_star(spark, sf_dir)
        docs = catalogue_documents(spark, sf_dir)
        nodes = (
            g.country_nodes(gold.dim_countries)
            .unionByName(g.indicator_nodes(gold.dim_indicators))
            .unionByName(g.category_nodes(gold.dim_indicators))
            .unionByName(g.document_nodes(docs))
        )
        edges = (
            g.category_edges(gold.dim_indicators)
            .unionByName(g.country_indicator_edges(gold.fact, gold.dim_countries, gold.dim_indicators))
            .unionByName(g.document_country_edges(docs, gold.dim_countries))
        )
        return g.store_nodes(nodes), g.store_edges(edges)

    return once(spark, sf_dir, "trade_graph", build)


def trade_lists(spark: SparkSession, sf_dir: str) -> g.Lists:
    """Adjacency lists of the graph."""
    return once(spark, sf_dir, "trade_lists", lambda: g.store_lists(trade_graph(spark, sf_dir)[1]))


def lineage(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Table and column nodes of the line-item star, with their derivations."""
    silver, gold = trade_star(spark, sf_dir)
    tables = {"stg_observations": silver.schema}
    tables.update({name: df.schema for name, df in gold.tables().items()})
    nodes, contains = g.lineage_tables(spark, tables)
    upstream = spark.createDataFrame(
        [("dim_countries", "stg_observations"), ("fact_economic_indicators", "dim_countries"),
         ("fact_economic_indicators", "dim_indicators"), ("fact_economic_indicators", "dim_dates"),
         ("fact_economic_indicators", "stg_observations"), ("dim_indicators", "stg_observations")],
        "table_name string, source_name string")
    derived = g.column_derivations(contains, upstream)
    sourced = g.source_edges(gold.dim_indicators, "fact_economic_indicators")
    return nodes, contains.unionByName(derived).unionByName(sourced)


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four anchors for every benchmark text: two parts, a country and a document."""
    item = F.col("item_id")
    chosen = F.array(
        F.struct(F.lit(1).alias("rank"), F.lit("Indicator").alias("type"), part_code(item).alias("id")),
        F.struct(F.lit(2).alias("rank"), F.lit("Indicator").alias("type"), part_code(item + 1).alias("id")),
        F.struct(F.lit(3).alias("rank"), F.lit("Country").alias("type"),
                 F.concat(F.lit("NATION_"), (item % 25).cast("string")).alias("id")),
        F.struct(F.lit(4).alias("rank"), F.lit("Document").alias("type"), item.cast("string").alias("id")),
    )
    return table(spark, sf_dir, "benchmark").select(item.alias("query_id"), F.explode(chosen).alias("a")).select(
        "query_id", "a.rank", "a.type", "a.id")
