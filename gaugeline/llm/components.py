"""Connected components of a link table by contraction, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.session import materialize

MAX_ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); equal roots are connected.

    Each round hooks every node to the neighbour of smallest rank (or to itself)
    and replaces the nodes of the links by their parents. Rounds rank by id,
    which ends the star around a smallest id at once, and by a new hash in turn, so that no
    order of ids makes a long chain; their number grows with the logarithm of the nodes. Neighbours are combined in the map
    tasks, so a node with many links costs one row per task, and joins are left
    to adaptive skew splitting. Links with a null end are no links; an empty
    table has no components.
    """
    spark = links.sparkSession
    edges = materialize(
        links.select("a", "b").where("a <> b").distinct(), "component-links")
    parents: list[DataFrame] = []
    for turn in range(MAX_ROUNDS):
        if edges.isEmpty():
            break
        both = edges.union(edges.select("b", "a"))
        first = (lambda name: F.xxhash64(F.lit(turn), name)) if turn % 2 else (lambda name: F.lit(0).cast("long"))
        rank = lambda name, first=first: F.struct(first(name).alias("h"), F.col(name).alias("v"))
        hooked = both.groupBy("a").agg(F.min(rank("b")).alias("near"))
        parent = materialize(
            hooked.select(F.col("a").alias("node"), F.least("near", rank("a"))["v"].alias("parent")), "component-hooks")
        parents.append(parent)
        start = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        end = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        joined = edges.join(start, "a").join(end, "b").where("pa <> pb")
        edges = materialize(
            joined.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "component-links")
    else:
        raise RuntimeError("the links did not contract")
    if not parents:
        return spark.createDataFrame([], "node bigint, root bigint").select(
            F.col("node").cast(links.schema["a"].dataType), F.col("root").cast(links.schema["a"].dataType))
    found = parents[0].select("node", F.col("parent").alias("root"))
    for parent in parents[1:]:
        step = parent.select(F.col("node").alias("root"), F.col("parent").alias("next"))
        found = found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found
