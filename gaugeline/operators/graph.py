"""Entity and lineage graph as two tables, and expansion from anchor nodes.

``nodes`` has (type, id, name, topics, properties) and ``edges`` (src_type,
src, rel, dst_type, dst). A document's name is its title. Name and topics stand
beside the property map so that expansion does not read whole properties, and
stored nodes are partitioned by type (``store_nodes``). Expansion follows a fixed chain of optional steps; its rows are
ordered by the node ids along the chain, so the first n rows are well defined.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gaugeline import fixed_values as fv
from gaugeline.functions.text import let, or_empty, split_and_strip
from gaugeline.operators.scale import deal_by, top_rows
from gaugeline.session import materialize
from gaugeline.sources.sinks import newest, upsert

GRAM = 6

EDGE_COLUMNS = ["src_type", "src", "rel", "dst_type", "dst"]


def node_id(code: Column, name: Column, doc_id: Column, other: Column) -> Column:
    """First of code, name, doc_id and id that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in (code, name, doc_id, other)])


NODE_COLUMNS = ["type", "id", "name", "topics", "properties"]


def _node(kind: str, key: Column, **properties: Column) -> list[Column]:
    entries = [x for name, value in properties.items() for x in (F.lit(name), value.cast("string"))]
    name = properties.get("name", properties.get("title", F.lit(None)))
    topics = properties.get("topics", F.lit(None))
    return [F.lit(kind).alias("type"), key.cast("string").alias("id"), name.cast("string").alias("name"),
            topics.cast("string").alias("topics"), F.create_map(*entries).alias("properties")]


def store_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes as a table with one partition per type, so that a step reads its types only."""
    return materialize(nodes.select(*NODE_COLUMNS), "nodes", ("type",))


def _edge(src_type: str, src: Column, rel: str, dst_type: str, dst: Column) -> list[Column]:
    return [F.lit(src_type).alias("src_type"), src.cast("string").alias("src"), F.lit(rel).alias("rel"),
            F.lit(dst_type).alias("dst_type"), dst.cast("string").alias("dst")]


def store_edges(edges: DataFrame) -> DataFrame:
    """Edges as a table with one partition per relation."""
    return materialize(edges.select(*EDGE_COLUMNS), "edges", ("rel",))


def country_nodes(countries: DataFrame) -> DataFrame:
    return countries.select(*_node(
        "Country", F.col("country_code"), code=F.col("country_code"), name=F.col("country_name"),
        region=or_empty(F.col("region")), income_group=or_empty(F.col("income_group"))))


def indicator_nodes(indicators: DataFrame) -> DataFrame:
    return indicators.select(*_node(
        "Indicator", F.col("indicator_code"), code=F.col("indicator_code"), name=F.col("indicator_name"),
        source_system=or_empty(F.col("source_system")), unit=or_empty(F.col("unit")),
        description=or_empty(F.col("description"))))


def category_nodes(indicators: DataFrame) -> DataFrame:
    named = indicators.filter(F.length("category") > 0).select("category").distinct()
    return named.select(*_node("IndicatorCategory", F.col("category"), name=F.col("category")))


def category_edges(indicators: DataFrame) -> DataFrame:
    named = indicators.filter(F.length("category") > 0).select("indicator_code", "category").distinct()
    return named.select(*_edge(
        "Indicator", F.col("indicator_code"), "BELONGS_TO", "IndicatorCategory", F.col("category")))


def country_indicator_edges(fact: DataFrame, countries: DataFrame, indicators: DataFrame) -> DataFrame:
    """One edge per country and indicator with a fact; keys are made distinct first."""
    pairs = fact.select("country_key", "indicator_key").distinct()
    named = pairs.join(countries.select("country_key", "country_code"), "country_key").join(
        indicators.select("indicator_key", "indicator_code"), "indicator_key")
    return named.select("country_code", "indicator_code").distinct().select(*_edge(
        "Country", F.col("country_code"), "HAS_INDICATOR", "Indicator", F.col("indicator_code")))


def document_nodes(documents: DataFrame) -> DataFrame:
    return documents.select(*_node(
        "Document", F.col("doc_id"), doc_id=F.col("doc_id"), title=F.col("title"),
        doc_type=or_empty(F.col("doc_type")), abstract=or_empty(F.col("abstract")),
        topics=or_empty(F.col("topics"))))


def document_country_edges(documents: DataFrame, countries: DataFrame, sep: str = ";") -> DataFrame:
    """Documents to the countries they list by name or by code.

    Name and code are two equality joins, not one join with OR.
    """
    listed = documents.filter(F.length("countries") > 0).select(
        "doc_id", F.explode(split_and_strip(F.col("countries"), sep)).alias("listed"))
    by_name = listed.join(
        countries.select("country_code", F.col("country_name").alias("listed")), "listed")
    by_code = listed.join(
        countries.select("country_code", F.col("country_code").alias("listed")), "listed")
    about = by_name.select("doc_id", "country_code").unionByName(by_code.select("doc_id", "country_code"))
    return about.distinct().select(*_edge("Document", F.col("doc_id"), "ABOUT", "Country", F.col("country_code")))


def _topics(documents: DataFrame, sep: str) -> DataFrame:
    listed = documents.select("doc_id", F.explode(split_and_strip(or_empty(F.col("topics")), sep)).alias("topic"))
    return listed.filter(F.col("topic") != "").distinct()


def topic_nodes(documents: DataFrame, sep: str = ";") -> DataFrame:
    topics = _topics(documents, sep).select("topic").distinct()
    return topics.select(*_node("DocTopic", F.col("topic"), name=F.col("topic")))


def topic_edges(documents: DataFrame, sep: str = ";") -> DataFrame:
    """TAGGED edges from documents to the topics they list."""
    return _topics(documents, sep).select(*_edge("Document", F.col("doc_id"), "TAGGED", "DocTopic", F.col("topic")))


def dashboard_edges(uses: DataFrame) -> DataFrame:
    """USES edges of dashboards to columns, from (dashboard, table_name, column_name)."""
    fqn = F.concat_ws(".", "table_name", "column_name")
    return uses.distinct().select(*_edge("Dashboard", F.col("dashboard"), "USES", "DataColumn", fqn))


def lineage_tables(spark: SparkSession, tables: dict[str, T.StructType]) -> tuple[DataFrame, DataFrame]:
    """Table and column nodes with their CONTAINS edges, from table schemas."""
    rows = [(name, field.name) for name, schema in tables.items() for field in schema.fields]
    columns = spark.createDataFrame(rows, "table_name string, column_name string")
    fqn = F.concat_ws(".", "table_name", "column_name")
    nodes = columns.select("table_name").distinct().select(
        *_node("DataTable", F.col("table_name"), name=F.col("table_name"))
    ).unionByName(columns.select(*_node(
        "DataColumn", fqn, table_name=F.col("table_name"), column_name=F.col("column_name"))))
    edges = columns.select(*_edge("DataTable", F.col("table_name"), "CONTAINS", "DataColumn", fqn))
    return nodes, edges


def column_derivations(contains: DataFrame, upstream: DataFrame) -> DataFrame:
    """DERIVED_FROM edges between equally named columns of a table and its source.

    ``contains`` are CONTAINS edges and ``upstream`` has (table_name, source_name).
    """
    columns = contains.filter(F.col("rel") == "CONTAINS").select(
        F.col("src").alias("table_name"), F.col("dst").alias("fqn"),
        F.substring("dst", F.length("src") + 2, F.length("dst")).alias("column_name"))
    sources = columns.select(F.col("table_name").alias("source_name"), F.col("fqn").alias("source_fqn"), "column_name")
    return columns.join(upstream, "table_name").join(sources, ["source_name", "column_name"]).select(
        *_edge("DataColumn", F.col("fqn"), "DERIVED_FROM", "DataColumn", F.col("source_fqn")))


def source_edges(indicators: DataFrame, table_name: str) -> DataFrame:
    """SOURCED_FROM edges of the indicators to the table that holds their facts."""
    return indicators.select("indicator_code").distinct().select(*_edge(
        "Indicator", F.col("indicator_code"), "SOURCED_FROM", "DataTable", F.lit(table_name)))


def upsert_nodes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Nodes by (type, id); a new node replaces the old one, which leaves it the properties that the new one does not set."""
    latest = newest(new, ["type", "id"])
    before = old.select(
        F.col("type").alias("_type"), F.col("id").alias("_id"), F.col("properties").alias("_properties"))
    # The new nodes look up their old properties; the old table only meets the new keys.
    known = latest.join(
        before, F.col("type").eqNullSafe(F.col("_type")) & F.col("id").eqNullSafe(F.col("_id")), "left")
    unset = F.map_filter(
        F.coalesce("_properties", F.create_map().cast("map<string,string>")),
        lambda name, _: ~F.map_contains_key(F.coalesce("properties", F.create_map().cast("map<string,string>")), name))
    merged = known.withColumn(
        "properties", F.map_concat(F.coalesce("properties", F.create_map().cast("map<string,string>")), unset))
    return upsert(old, merged.select(*latest.columns), ["type", "id"])


def upsert_edges(old: DataFrame, new: DataFrame, nodes: DataFrame) -> DataFrame:
    """The old edges and those new ones that are not there yet and whose two ends exist."""
    keys = nodes.select("type", "id")
    sources = keys.withColumnsRenamed({"type": "src_type", "id": "src"})
    targets = keys.withColumnsRenamed({"type": "dst_type", "id": "dst"})
    added = new.select(*EDGE_COLUMNS).distinct().join(old.select(*EDGE_COLUMNS), EDGE_COLUMNS, "left_anti")
    return old.select(*EDGE_COLUMNS).unionByName(
        added.join(sources, ["src_type", "src"], "left_semi").join(targets, ["dst_type", "dst"], "left_semi").select(*EDGE_COLUMNS))


def step(edges: DataFrame, rel: str, near: str, far: str, backward: bool = False) -> DataFrame:
    """Edges of one relation as a two-column table."""
    chosen = edges.filter(F.col("rel") == rel)
    if backward:
        return chosen.select(F.col("dst").alias(near), F.col("src").alias(far))
    return chosen.select(F.col("src").alias(near), F.col("dst").alias(far))


def paths_up_to_two(edges: DataFrame, rel: str, near: str, far: str) -> DataFrame:
    """Pairs connected by one or two edges of a relation."""
    one = step(edges, rel, near, far)
    two = one.withColumnRenamed(far, "_middle").join(
        step(edges, rel, "_middle", far), "_middle").select(near, far)
    return one.unionByName(two).distinct()


@dataclass(frozen=True)
class Lists:
    """Adjacency lists: (step, node, far), ``far`` being the node's first ``cap`` neighbours in order."""

    rows: DataFrame
    cap: int

    def of(self, name: str, near: str, far: str) -> DataFrame:
        return self.rows.filter(F.col("step") == name).select(F.col("node").alias(near), F.col("far").alias(far))


def first_neighbours(pairs: DataFrame, cap: int) -> DataFrame:
    """(node, far): per node of (node, far) its first ``cap`` neighbours.

    Every map task sends on ``cap`` neighbours of a node at most, however many edges the node has.
    """
    first = top_rows(pairs, ["node"], [F.col("far")], cap)
    return first.groupBy("node").agg(F.sort_array(F.collect_list("far")).alias("far"))


# Step name, relation, and whether it is followed from its end to its start.
STEPS = [
    ("category", "BELONGS_TO", False),
    ("indicators", "HAS_INDICATOR", False),
    ("countries", "HAS_INDICATOR", True),
    ("source", "SOURCED_FROM", False),
    ("columns", "CONTAINS", False),
]
UPSTREAM = "upstream"


def store_lists(edges: DataFrame, cap: int = max(fv.INDICATOR_ROW_CAP, fv.COUNTRY_ROW_CAP)) -> Lists:
    """Adjacency lists of the relations that expansion follows, stored by step for many expansions.

    An expansion keeps the first rows of its chain, and of the rows that agree up
    to a step only the node's first neighbours can be among them, so lists of ``cap`` neighbours
    give the same rows as all edges. Edges that are there twice count twice.
    """
    lists = [first_neighbours(step(edges, rel, "node", "far", backward), cap).withColumn("step", F.lit(name))
             for name, rel, backward in STEPS]
    derived = step(edges, "DERIVED_FROM", "node", "far")
    # Of a column two steps up only the first neighbours of the one between can count.
    between = first_neighbours(derived, cap).select(F.col("node").alias("middle"), F.col("far").alias("next"))
    two = derived.withColumnRenamed("far", "middle").join(between, "middle").select("node", F.explode("next").alias("far"))
    lists.append(first_neighbours(derived.unionByName(two).distinct(), cap).withColumn("step", F.lit(UPSTREAM)))
    rows = reduce(DataFrame.unionByName, lists)
    return Lists(materialize(rows, "adjacency", ("step",)), cap)


def _lists_for(edges: DataFrame, lists: Lists | None, cap: int) -> Lists:
    if lists is None:
        return store_lists(edges, cap)
    if lists.cap < cap:
        raise ValueError(f"the lists hold {lists.cap} neighbours of a node; {cap} are asked for")
    return lists


def follow(rows: DataFrame, lists: Lists, name: str, near: str, far: str) -> DataFrame:
    """``rows`` with each neighbour of ``near`` in turn as ``far``; a row without any keeps null."""
    pairs = lists.of(name, near, "_far")
    return rows.join(pairs, near, "left").select(*rows.columns, F.explode_outer("_far").alias(far))


def containing(texts: DataFrame, text: str, terms: DataFrame, term: str) -> DataFrame:
    """Rows of ``texts`` with every term their text contains.

    A text that contains a term contains the term's first characters, so
    candidates come from an equality join on those, and only they are compared. The
    texts are dealt by their characters, each of which begins a candidate: many texts can lie in one small file.
    """
    keyed = materialize(terms.select(term).filter(F.length(term) > 0).distinct().withColumn(
        "_gram", F.left(term, F.lit(GRAM))), "terms")
    def grams(chars: Column, width: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(chars) - (width - 1))
        found = F.transform(starts, lambda i: F.array_join(F.slice(chars, i, width), ""))
        return F.when(F.size(chars) >= width, found).otherwise(F.array().cast("array<string>"))

    # Terms of fewer characters than GRAM are rare; their widths are only
    # unfolded when there are any.
    widths = {row["w"] for row in keyed.select(F.length("_gram").alias("w")).distinct().collect()}
    unfolded = F.array().cast("array<string>")
    if widths:
        unfolded = F.array_distinct(let(
            F.split(text, ""), lambda chars: F.concat(*[grams(chars, w) for w in sorted(widths)])))
    n_chars = texts.agg(F.sum(F.length(text))).first()[0] or 0
    return (
        deal_by(texts, texts.columns, n_chars * len(widths)).withColumn("_gram", F.explode(unfolded)).join(keyed, "_gram")
        .filter(F.contains(F.col(text), F.col(term)))
        .drop("_gram")
    )


def matching_documents(
    nodes: DataFrame, edges: DataFrame, wanted: DataFrame, cap: int
) -> DataFrame:
    """First ``cap`` documents for each (i_name, cat, c) of ``wanted``.

    A document about country ``c`` matches when its topics contain ``cat`` or
    its title contains ``i_name``. Categories and names are matched once each,
    however many rows share them, and each list is cut to ``cap`` documents per
    country before it is joined to the wanted rows.
    """
    about = step(edges, "ABOUT", "doc", "c")
    texts = nodes.filter(F.col("type") == "Document").select(
        F.col("id").alias("doc"), F.col("name").alias("title"), "topics")
    by_topic = containing(texts.select("doc", "topics"), "topics", wanted, "cat").join(about, "doc")
    by_topic = top_rows(by_topic, ["cat", "c"], [F.col("doc")], cap).select("cat", "c", "doc")
    by_title = containing(texts.select("doc", "title"), "title", wanted, "i_name").join(about, "doc")
    by_title = top_rows(by_title, ["i_name", "c"], [F.col("doc")], cap).select("i_name", "c", "doc")

    keys = wanted.select("i_name", "cat", "c").distinct()
    found = keys.join(by_topic, ["cat", "c"]).select("i_name", "cat", "c", "doc").unionByName(
        keys.join(by_title, ["i_name", "c"]).select("i_name", "cat", "c", "doc")).distinct()
    return top_rows(found, ["i_name", "cat", "c"], [F.col("doc")], cap).drop("rank")


def indicator_rows(
    nodes: DataFrame, edges: DataFrame, indicators: DataFrame, cap: int = fv.INDICATOR_ROW_CAP, lists: Lists | None = None
) -> DataFrame:
    """First ``cap`` rows of the chain from every indicator of (i).

    Steps: category, countries, source table, its columns, their upstream
    columns, documents. Every step is optional and keeps at least one row per
    row before it, so cutting to the first ``cap`` rows after each step gives
    the same rows as cutting once at the end. Without ``lists`` they are made for this call.
    """
    lists = _lists_for(edges, lists, cap)
    names = nodes.filter(F.col("type") == "Indicator").select(
        F.col("id").alias("i"), F.col("name").alias("i_name"))
    rows = indicators.select("i").distinct().join(names, "i")
    order: list[str] = []

    for name, near, far in [("category", "i", "cat"), ("countries", "i", "c"), ("source", "i", "src"),
                            ("columns", "src", "col"), (UPSTREAM, "col", "up")]:
        order.append(far)
        rows = top_rows(follow(rows, lists, name, near, far), ["i"], [F.col(c) for c in order], cap).drop("rank")
    rows = materialize(rows, "indicator-rows")
    documents = matching_documents(
        nodes, edges, rows.filter(F.col("c").isNotNull()).select("i_name", "cat", "c").distinct(), cap)
    documents = materialize(documents.select(
        "i_name", "c", F.coalesce("cat", F.lit("")).alias("_cat"), F.col("doc").alias("d")), "row-documents")
    on = ["i_name", "c", "_cat"]
    rows = rows.withColumn("_cat", F.coalesce("cat", F.lit("")))
    # A row becomes as many rows as it has documents; rows that start beyond
    # the cap are left out before the documents are joined.
    fan_out = documents.groupBy(*on).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("i").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(fan_out, on, "left").withColumn(
        "_before", F.coalesce(F.sum(F.coalesce("_n", F.lit(1))).over(earlier), F.lit(0)))
    rows = rows.filter(F.col("_before") < cap).join(documents, on, "left")
    return top_rows(rows, ["i"], [F.col(c) for c in [*order, "d"]], cap, "row_no").select(
        "i", "cat", "c", "src", "col", "up", "d", "row_no")


def country_rows(
    nodes: DataFrame, edges: DataFrame, countries: DataFrame, cap: int = fv.COUNTRY_ROW_CAP, lists: Lists | None = None
) -> DataFrame:
    """First ``cap`` rows of country, indicator and category from every country of (c)."""
    lists = _lists_for(edges, lists, cap)
    known = nodes.filter(F.col("type") == "Country").select(F.col("id").alias("c"))
    rows = follow(countries.select("c").distinct().join(known, "c"), lists, "indicators", "c", "i")
    rows = top_rows(rows, ["c"], [F.col("i")], cap).drop("rank")
    rows = follow(rows, lists, "category", "i", "cat")
    return top_rows(rows, ["c"], [F.col("i"), F.col("cat")], cap, "row_no").select("c", "i", "cat", "row_no")


def _nodes_of_rows(rows: DataFrame, anchor_type: str, anchor: str, columns: list[tuple[str, str]]) -> DataFrame:
    """(anchor_type, anchor, place, type, id): each node where it first occurs in the rows of its anchor."""
    width = len(columns)
    found = F.array(*[
        F.struct(F.lit(i).alias("column_no"), F.lit(kind).alias("type"), F.col(name).alias("id"))
        for i, (name, kind) in enumerate(columns)])
    return (
        rows.select(F.col(anchor).alias("anchor"), "row_no", F.explode(found).alias("n"))
        .filter(F.col("n.id").isNotNull())
        .groupBy("anchor", F.col("n.type").alias("type"), F.col("n.id").alias("id"))
        .agg(F.min(F.col("row_no") * width + F.col("n.column_no")).alias("place"))
        .withColumn("anchor_type", F.lit(anchor_type))
    )


def expand(
    nodes: DataFrame, edges: DataFrame, anchors: DataFrame, max_nodes: int = fv.EXPANSION_CAP,
    indicator_cap: int = fv.INDICATOR_ROW_CAP, country_cap: int = fv.COUNTRY_ROW_CAP, lists: Lists | None = None,
) -> DataFrame:
    """Nodes reached from the anchors of every query, in the order first seen.

    ``anchors`` has (query_id, rank, type, id). Each distinct anchor is expanded
    once, however many queries share it. Anchors other than indicators and
    countries lead nowhere. Returns (query_id, place, type, id, properties).
    """
    lists = _lists_for(edges, lists, max(indicator_cap, country_cap))
    indicators = anchors.filter(F.col("type") == "Indicator").select(F.col("id").alias("i"))
    countries = anchors.filter(F.col("type") == "Country").select(F.col("id").alias("c"))
    reached = _nodes_of_rows(
        indicator_rows(nodes, edges, indicators, indicator_cap, lists), "Indicator", "i",
        [("i", "Indicator"), ("cat", "IndicatorCategory"), ("c", "Country"), ("src", "DataTable"),
         ("col", "DataColumn"), ("up", "DataColumn"), ("d", "Document")],
    ).unionByName(_nodes_of_rows(
        country_rows(nodes, edges, countries, country_cap, lists), "Country", "c",
        [("c", "Country"), ("i", "Indicator"), ("cat", "IndicatorCategory")]))

    named = anchors.select(
        "query_id", F.col("rank").alias("anchor_rank"), F.col("type").alias("anchor_type"),
        F.col("id").alias("anchor"))
    seen = named.join(reached, ["anchor_type", "anchor"]).groupBy("query_id", "type", "id").agg(
        F.min(F.struct("anchor_rank", "place")).alias("first"))
    kept = top_rows(seen, ["query_id"], [F.col("first"), F.col("type"), F.col("id")], max_nodes, "place")
    # Stored, so that the properties are fetched by a join that knows how few
    # nodes it is for and does not move the node table.
    kept = materialize(kept.select("query_id", "place", "type", "id"), "expanded")
    return nodes.select("type", "id", "properties").join(kept, ["type", "id"]).select(
        "query_id", "place", "type", "id", "properties")
