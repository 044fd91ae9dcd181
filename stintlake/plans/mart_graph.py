"""Staging models and marts as a graph of declared dependencies.

A node names what it is built from and the column tests it must pass. Nodes
are built in the order of their dependencies: staging as temporary views over
the loaded tables, marts as store tables. A node that can't be built, or
(if ``strict``) whose tests fail, leaves out everything that depends on it, and
nothing else.
"""

from __future__ import annotations

import graphlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.operators import quality as QC
from stintlake.plans import marts as D
from stintlake.sources.binding import Star

REPORT = "model string, kind string, status string, rows bigint, failures bigint"


@dataclass
class Node:
    build: Callable
    needs: list[str] = field(default_factory=list)  # nodes, or loaded tables
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    team_parts: int = 1  # a table of rows per team's standings is written in so many parts, one after the other

    @property
    def kind(self) -> str:
        return "view" if self.build.__name__.startswith("stg_") else "table"


GRAPH = {
    "stg_results": Node(D.stg_results, ["results"], ["race_id", "driver_id", "constructor_id", "points"]),
    "stg_races": Node(D.stg_races, ["races"], ["race_id", "season"], ["race_id"]),
    "stg_drivers": Node(D.stg_drivers, ["drivers"], ["driver_id", "driver_name"], ["driver_id"]),
    "stg_pit_stops": Node(D.stg_pit_stops, ["pit_stops"]),
    "stg_qualifying": Node(D.stg_qualifying, ["qualifying"]),
    "stg_constructor_standings": Node(D.stg_constructor_standings, ["constructor_standings"]),
    "mart_driver_summary": Node(D.mart_driver_summary, ["stg_results", "stg_races", "stg_drivers"], ["driver_name", "points"], ["driver_name"]),
    "mart_pit_stop_efficiency": Node(D.mart_pit_stop_efficiency, ["stg_pit_stops", "stg_results", "stg_races"], ["avg_stop_ms"]),
    "mart_championship_progression": Node(D.mart_championship_progression, ["stg_constructor_standings", "stg_races"], team_parts=4),
    "mart_qualifying_vs_race": Node(D.mart_qualifying_vs_race, ["stg_results", "stg_qualifying", "stg_races"]),
}


def order(graph: dict[str, Node]) -> list[str]:
    """Nodes so that each comes after those it needs; a cycle is an error."""
    return [n for n in graphlib.TopologicalSorter({k: v.needs for k, v in graph.items()}).static_order() if n in graph]


def tests(model: DataFrame, name: str, node: Node) -> DataFrame:
    """The node's column tests (rows: model, column, test, failures)."""
    return QC.column_tests(model, name, not_null=node.not_null, unique=node.unique)


def _some_teams(star, part: int, parts: int):
    """The star with the standings of every so manieth team."""
    if parts == 1:
        return star
    own = F.pmod(F.hash("constructor_id"), F.lit(parts)) == part
    return Star(loader=lambda n: getattr(star, n).filter(own) if n == "constructor_standings" else getattr(star, n))


def build_marts(star, store, cid=None, graph: dict[str, Node] | None = None, strict: bool = False) -> DataFrame:
    """Build every node and return the report: one row per model with its
    status (ok, failed: tests; error: not built; skipped: needs one of these),
    rows (of tables) and failing values."""
    graph = graph or GRAPH
    spark, report, bad = store.spark, [], set()
    for name in order(graph):
        node = graph[name]
        status, rows, failures = "ok", None, None
        if bad & set(node.needs):
            status = "skipped"
        else:
            try:
                if node.kind == "view":
                    model = node.build(star)
                    model.createOrReplaceTempView(name)
                else:
                    store.write_parts(name, (node.build(_some_teams(star, part, node.team_parts), cid) for part in range(node.team_parts)))
                    model = store.read(name)
                    rows = model.count()
                if node.not_null or node.unique:
                    failures = tests(model, name, node).agg(F.sum("failures")).first()[0]
                    status = "failed" if failures else "ok"
            except (PySparkException, AttributeError, KeyError) as exc:
                status = f"error: {str(exc).splitlines()[0][:200]}"
        if status != "ok" and (strict or status != "failed"):
            bad.add(name)
        report.append((name, node.kind, status, rows, failures))
    return spark.createDataFrame(report, REPORT)
