"""Answering a batch of questions with context and facts."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv
from gaugeline.operators.cells import Cells, nearest_in_cells
from gaugeline.operators.context import (
    add_facts,
    assemble,
    combine_nodes,
    question_facts,
    read_questions,
    rerank,
)
from gaugeline.operators.fusion import fuse
from gaugeline.operators.gold import Gold
from gaugeline.operators.graph import Lists, expand
from gaugeline.operators.search import search
from gaugeline.operators.stored_index import search_stored
from gaugeline.operators.vector import nearest
from gaugeline.session import materialize

log = logging.getLogger(__name__)

HITS = "query_id {id}, id string, rank int, properties map<string,string>"
PROPERTIES = "map<string,string>"


def branch(
    name: str, build: Callable[[], DataFrame], empty: DataFrame, degrade: bool, failed: list[str]
) -> DataFrame:
    """Run one branch to a table.

    A failure is raised, unless the caller wants to ``degrade``: then the branch counts as
    empty and its name is added to ``failed``.
    """
    try:
        return materialize(build(), name)
    except PySparkException as error:
        if not degrade:
            raise
        log.warning("%s failed, going on without it: %s", name, error)
        failed.append(name)
        return empty


def lexical_hits(indicators: DataFrame, questions: DataFrame, size: int, index: str | None = None) -> DataFrame:
    """Indicator hits with the indicator's columns as properties.

    ``index`` is the folder of a stored index of the indicators; without it
    they are indexed for this search.
    """
    asked = questions.select("query_id", F.col("search_text").alias("query"))
    found = search(indicators, asked, k=size) if index is None else search_stored(asked.sparkSession, index, asked, size)
    # Stored, so that the join knows how few rows look up their properties.
    hits = materialize(found, "lexical-hits")
    columns = ["indicator_code", "indicator_name", "category", "description"]
    known = indicators.select(F.col("indicator_code").alias("id"), *columns).join(hits, "id")
    return known.select("query_id", "id", "rank", F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))]).alias("properties"))


def semantic_hits(vectors: DataFrame, query_vectors: DataFrame, size: int, cells: Cells | None = None) -> DataFrame:
    """Embedding hits; ``vectors`` has (row_id, source_id, source_type, metadata, embedding).

    ``cells`` are those of the vectors, by row_id; without them they are stored for this search.
    """
    found = nearest(vectors, query_vectors, size, id_col="row_id") if cells is None else nearest_in_cells(cells, query_vectors, size)
    hits = materialize(found, "semantic-hits")
    known = vectors.select(F.col("row_id").alias("id"), "source_id", "source_type", "metadata").join(hits, "id")
    return known.select(
        "query_id", F.col("source_id").alias("id"), "rank", "source_type", F.from_json("metadata", PROPERTIES).alias("properties"))


def retrieve(
    queries: DataFrame,
    indicators: DataFrame,
    vectors: DataFrame,
    query_vectors: DataFrame,
    nodes: DataFrame,
    edges: DataFrame,
    gold: Gold,
    use: tuple[str, ...] = ("lexical", "semantic", "graph"),
    max_nodes: int = fv.EXPANSION_CAP_IN_RETRIEVAL,
    dedupe: bool = True,
    degrade: bool = False,
    index: str | None = None,
    cells: Cells | None = None,
    lists: Lists | None = None,
    aliases: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """(query_id, query, context, n_nodes) for every query of (query_id, query).

    ``index``, ``cells`` and ``lists`` are stored beforehand for many batches
    (see ``lexical_hits``, ``semantic_hits`` and ``store_lists``). ``aliases``
    are countries by name, looked for as whole words, in place of the fixed ones.

    A branch that fails raises. With ``degrade`` the others go on, and a column
    ``failed_branches`` (array) names what every row had to do without.

    Each stage works on all questions at once and is stored, so that the next
    one plans with its real size. A question without any hit gets the fixed
    no-context message.
    """
    spark = queries.sparkSession
    questions = materialize(read_questions(queries, aliases is not None, aliases), "questions")
    id_type = questions.schema["query_id"].dataType.simpleString()
    no_hits = spark.createDataFrame([], HITS.format(id=id_type))
    no_semantic = no_hits.withColumn("source_type", F.lit("").cast("string"))

    failed: list[str] = []
    lexical, semantic = no_hits, no_semantic
    if "lexical" in use:
        lexical = branch(
            "lexical", lambda: lexical_hits(indicators, questions, fv.LEXICAL_SIZE_IN_RETRIEVAL, index), no_hits, degrade, failed)
    if "semantic" in use:
        semantic = branch(
            "semantic", lambda: semantic_hits(vectors, query_vectors, fv.SEMANTIC_SIZE_IN_RETRIEVAL, cells), no_semantic,
            degrade, failed)
    anchors = materialize(fuse(lexical, semantic), "anchors")

    no_nodes = spark.createDataFrame([], f"query_id {id_type}, place int, type string, id string, properties {PROPERTIES}")
    expanded = no_nodes
    if "graph" in use:
        expanded = branch("graph", lambda: expand(nodes, edges, anchors, max_nodes, lists=lists), no_nodes, degrade, failed)
    all_nodes = combine_nodes(anchors, expanded, dedupe)
    ranked = materialize(rerank(all_nodes, fv.FUSED_SIZE + max_nodes), "ranked")

    contexts = add_facts(assemble(ranked), question_facts(ranked, questions, gold))
    counts = ranked.groupBy("query_id").agg(F.count("*").alias("n_nodes"))
    answers = (
        questions.select("query_id", "query")
        .join(contexts, "query_id", "left")
        .join(counts, "query_id", "left")
        .select(
            "query_id", "query",
            F.coalesce("context", F.lit(fv.NO_CONTEXT_MESSAGE)).alias("context"),
            F.coalesce("n_nodes", F.lit(0)).alias("n_nodes"),
        )
    )
    return answers.withColumn("failed_branches", F.array(*map(F.lit, failed)).cast("array<string>")) if degrade else answers
