"""Reranking of nodes, facts for questions, and the context text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv
from gaugeline.functions.text import (
    contains_any,
    expand_phrases,
    mentioned_year,
    resolve_countries,
    thousands,
)
from gaugeline.operators.gold import Gold
from gaugeline.operators.scale import latest_rows, top_rows
from gaugeline.session import materialize


def read_questions(
    queries: DataFrame, word_boundary: bool = False, aliases: list[tuple[str, str]] | None = None
) -> DataFrame:
    """(query_id, query) with everything read off the question text.

    ``aliases`` are the names (lower case) and codes of the countries that a text may mention.
    """
    text = F.col("query")
    return queries.select(
        "query_id", "query",
        F.array_join(expand_phrases(text), " ").alias("search_text"),
        resolve_countries(text, aliases, word_boundary=word_boundary).alias("countries"),
        contains_any(text, fv.COMPARISON_WORDS).alias("is_comparison"),
        mentioned_year(text).alias("year"),
    )


def combine_nodes(anchors: DataFrame, expanded: DataFrame, dedupe: bool = True) -> DataFrame:
    """Anchors followed by expanded nodes, as (query_id, position, type, id, properties).

    A node that is both keeps its place as an anchor; ``dedupe=False`` keeps it
    twice.
    """
    both = anchors.select(
        "query_id", F.struct(F.lit(0).alias("part"), F.col("rank").cast("long").alias("place")).alias("position"),
        "type", "id", "properties",
    ).unionByName(expanded.select(
        "query_id", F.struct(F.lit(1).alias("part"), F.col("place").cast("long").alias("place")).alias("position"),
        "type", "id", "properties"))
    if not dedupe:
        return both
    return latest_rows(both, ["query_id", "type", "id"], [F.col("position")])


def type_weight(kind: Column, weights: list[tuple[str, float]] | None = None) -> Column:
    table = F.create_map(*[x for name, weight in (weights or fv.TYPE_WEIGHTS) for x in (F.lit(name), F.lit(weight))])
    return F.coalesce(F.try_element_at(table, kind), F.lit(fv.DEFAULT_WEIGHT))


def score_nodes(nodes: DataFrame, weights: list[tuple[str, float]] | None = None) -> DataFrame:
    """Drop deprecated nodes and weigh the rest by type; a missing flag keeps the node."""
    flag = F.try_element_at(F.col("properties"), F.lit("is_deprecated"))
    kept = nodes.filter(F.coalesce(flag != "true", F.lit(True)))
    return kept.withColumn("score", type_weight(F.col("type"), weights))


def score_layers(nodes: DataFrame, layer: str = "layer") -> DataFrame:
    """Weigh nodes by the layer of their data; nodes marked inactive go."""
    active = F.try_element_at(F.col("properties"), F.lit("is_active"))
    kept = nodes.filter(F.coalesce(active != "false", F.lit(True)))
    return kept.withColumn(
        "score", type_weight(F.try_element_at(F.col("properties"), F.lit(layer)), fv.LAYER_WEIGHTS))


def rerank(nodes: DataFrame, k: int, weights: list[tuple[str, float]] | None = None) -> DataFrame:
    """The ``k`` best nodes of every query; equal scores keep their order."""
    return top_rows(score_nodes(nodes, weights), ["query_id"], [F.col("score").desc(), F.col("position")], k)


def block_text(rank: Column, kind: Column, node: Column, properties: Column) -> Column:
    """The text block of one node, by its type; a null type or id is empty text."""
    kind, node = F.coalesce(kind, F.lit("")), F.coalesce(node, F.lit(""))

    def prop(*names: str) -> Column:
        return F.coalesce(*[F.try_element_at(properties, F.lit(n)) for n in names], F.lit(""))

    label = F.concat(F.lit(fv.CITATION_OPENING), rank.cast("string"), F.lit("] | Type: "))
    indicator = F.concat(
        label, F.lit("Indicator\nCode: "), node, F.lit(" | Category: "), prop("category"),
        F.lit("\nName: "), prop("name", "indicator_name"), F.lit("\nDescription: "), prop("description"), F.lit("\n"))
    country = F.concat(
        label, F.lit("Country\nCode: "), node, F.lit(" | Name: "), prop("name"),
        F.lit("\nRegion: "), prop("region"), F.lit(" | Income: "), prop("income_group"), F.lit("\n"))
    document = F.concat(
        label, F.lit("Document\nTitle: "), prop("title"),
        F.lit("\nContent: "), F.left(prop("abstract", "text"), F.lit(fv.DOCUMENT_CONTENT_CHARS)), F.lit("\n"))
    other = F.concat(label, kind, F.lit(" | ID: "), node, F.lit("\n"))
    return (
        F.when(kind == "Indicator", indicator).when(kind == "Country", country)
        .when(kind == "Document", document).otherwise(other)
    )


def context_blocks(ranked: DataFrame, max_chars: int = fv.CONTEXT_CHARS) -> DataFrame:
    """The blocks that fit: (query_id, rank, block).

    ``ranked`` has (query_id, rank, type, id, properties) with ranks from 1. A
    block is kept while the blocks before it have at most ``max_chars``
    characters, so the block that crosses the limit is the last one.
    """
    blocks = ranked.select(
        "query_id", "rank", block_text(F.col("rank"), F.col("type"), F.col("id"), F.col("properties")).alias("block"))
    before = F.expr(
        "sum(length(block)) over (partition by query_id order by rank"
        " rows between unbounded preceding and 1 preceding)")
    return blocks.withColumn("_before", before).filter(
        F.coalesce("_before", F.lit(0)) <= max_chars).drop("_before")


def joined_lines(rows: DataFrame, order: list[str], line: str, sep: str, name: str) -> DataFrame:
    """Lines of every query in order, joined to one text."""
    sorted_rows = F.array_sort(F.collect_list(F.struct(*order, line)))
    return rows.groupBy("query_id").agg(
        F.array_join(F.transform(sorted_rows, lambda r: r[line]), sep).alias(name))


def assemble(ranked: DataFrame, max_chars: int = fv.CONTEXT_CHARS) -> DataFrame:
    """(query_id, context): the kept blocks, one after the other."""
    return joined_lines(context_blocks(ranked, max_chars), ["rank"], "block", "\n", "context")


def fact_text(country: Column, indicator: Column, year: Column, value: Column, unit: Column) -> Column:
    return F.concat(
        F.lit("FACT: "), country, F.lit(" - "), indicator, F.lit(" ("), year.cast("string"), F.lit("): "),
        thousands(value), F.lit(" "), F.coalesce(unit, F.lit("")))


def question_facts(ranked: DataFrame, questions: DataFrame, gold: Gold) -> DataFrame:
    """Fact lines of every question: (query_id, node_rank, country_no, year, line).

    Every indicator among the nodes of a question is looked up for every
    country of the question: all years for a comparison, else the year the
    question names, else the latest year. All questions are answered by one
    join per kind of lookup.
    """
    asked = materialize(
        ranked.filter(F.col("type") == "Indicator")
        .select("query_id", F.col("rank").alias("node_rank"), F.col("id").alias("indicator_code"))
        .join(questions.select("query_id", "is_comparison", F.col("year").alias("asked_year"),
                               F.posexplode("countries").alias("country_no", "country_code")), "query_id"),
        "asked-facts")
    key = ["country_code", "indicator_code"]
    # The codes asked for become keys before the facts are read, so the scan is cut to their
    # countries, and the latest fact is looked for among the series asked for only.
    wanted = materialize(
        asked.select(*key).distinct()
        .join(gold.dim_countries.select("country_key", "country_code", "country_name"), "country_code")
        .join(gold.dim_indicators.select("indicator_key", "indicator_code", "indicator_name", "unit"), "indicator_code"),
        "asked-keys")
    facts = materialize(gold.fact.join(wanted, ["country_key", "indicator_key"]).select(
        *key, "country_name", "indicator_name", "unit", F.year("period_start").alias("year"), "period_start", "value"),
        "asked-series")
    latest = latest_rows(facts, key, [F.col("period_start").desc(), F.col("value").desc()])
    all_years = asked.filter("is_comparison").join(facts, key)
    one_year = asked.filter("not is_comparison and asked_year is not null").join(
        facts.withColumn("asked_year", F.col("year")), [*key, "asked_year"])
    newest = asked.filter("not is_comparison and asked_year is null").join(latest, key)
    columns = ["query_id", "node_rank", "country_no", "country_name", "indicator_name", "unit", "year", "value"]
    found = all_years.select(*columns).unionByName(one_year.select(*columns)).unionByName(newest.select(*columns))
    line = fact_text(F.col("country_name"), F.col("indicator_name"), F.col("year"), F.col("value"), F.col("unit"))
    return found.select("query_id", "node_rank", "country_no", "year", line.alias("line"))


def add_facts(contexts: DataFrame, facts: DataFrame) -> DataFrame:
    """Contexts with the fact lines of their question appended under a heading."""
    lines = joined_lines(facts, ["node_rank", "country_no", "year"], "line", "\n", "facts")
    heading = F.concat(F.lit("\n\n" + fv.FACTS_HEADING + "\n"), "facts")
    return contexts.join(lines, "query_id", "left").withColumn(
        "context", F.concat("context", F.coalesce(heading, F.lit("")))).drop("facts")
