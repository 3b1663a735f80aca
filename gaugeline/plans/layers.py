"""Layers of named tables that refer to each other, built in the order of their references.

A node says how its DataFrame is made from others by name. Staging nodes are views
(computed where they are used), marts are tables (stored once). Nothing is built before
all references are known to exist and to run in no circle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from gaugeline.plans.medallion import register_views
from gaugeline.session import materialize

VIEW, TABLE = "view", "table"
KINDS = {"staging": VIEW, "intermediate": VIEW, "marts": TABLE}

Ref = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Node:
    """``build`` gets ``ref``, which gives the DataFrame of a name in ``needs``; ``kind`` overrides that of the layer."""

    name: str
    build: Callable[[Ref], DataFrame]
    needs: tuple[str, ...] = ()
    layer: str = "staging"
    kind: str | None = None


class UnknownReference(LookupError):
    """A node refers to a name that neither a node nor a source has."""


class CircularReference(ValueError):
    """Nodes refer to each other in a circle."""


@dataclass
class Layers:
    """Nodes over named sources (seeds and raw tables)."""

    sources: dict[str, DataFrame]
    nodes: list[Node] = field(default_factory=list)

    def add(self, name: str, needs: tuple[str, ...] = (), layer: str = "staging", kind: str | None = None):
        """Decorator that makes a function of ``ref`` a node."""

        def register(build: Callable[[Ref], DataFrame]):
            self.nodes.append(Node(name, build, tuple(needs), layer, kind))
            return build

        return register

    def order(self, wanted: list[str] | None = None) -> list[Node]:
        """The nodes that ``wanted`` (default: all) need, each after those it refers to; equals by name."""
        known = {node.name: node for node in self.nodes}
        names = Counter([*self.sources, *[node.name for node in self.nodes]])
        doubled = sorted(name for name, n in names.items() if n > 1)
        if doubled:
            raise ValueError(f"names that stand for two things: {doubled}")
        waiting, needed = list(wanted if wanted is not None else known), set()
        while waiting:
            name = waiting.pop()
            if name in self.sources or name in needed:
                continue
            if name not in known:
                raise UnknownReference(name)
            needed.add(name)
            waiting.extend(known[name].needs)
        sorter = TopologicalSorter({name: [need for need in known[name].needs if need in known] for name in sorted(needed)})
        try:
            return [known[name] for name in sorter.static_order()]
        except CycleError as error:
            raise CircularReference(" -> ".join(error.args[1])) from error

    def build(self, wanted: list[str] | None = None, prefix: str | None = None) -> dict[str, DataFrame]:
        """DataFrames of all needed nodes by name; with ``prefix`` they are also views for SQL.

        A view is made anew wherever it is used; a table is stored as soon as it is reached, and what follows reads it.
        """
        found = dict(self.sources)
        for node in self.order(wanted):
            def ref(name: str, node: Node = node) -> DataFrame:
                if name not in node.needs:
                    raise UnknownReference(f"{node.name} does not name {name} among its needs")
                return found[name]

            df = node.build(ref)
            kind = node.kind or KINDS[node.layer]
            found[node.name] = materialize(df, node.name) if kind == TABLE else df
            if prefix is not None:
                register_views({node.name: found[node.name]}, prefix)
        return found


def sql_node(spark: SparkSession, text: str, prefix: str) -> Callable[[Ref], DataFrame]:
    """A node written in SQL over the views of the nodes before it."""
    return lambda ref: spark.sql(text.replace("{{", prefix).replace("}}", ""))
