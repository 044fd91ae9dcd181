"""Named query catalog: name -> callable(spark, sf_dir) -> DataFrame.

The registry replaces the reference's YAML-of-SQL catalog: ``run(name)``
for one query, ``run_all()`` for every one, ``names()`` to list them.
Each entry binds the test tables to the star schema and runs one plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stintlake.plans import checks as C
from stintlake.plans import ingest as G
from stintlake.plans import loads as LD
from stintlake.plans import marts as D
from stintlake.plans import models as M
from stintlake.plans import queries as Q
from stintlake.plans import series as K
from stintlake.operators import quality as QC
from stintlake.sources.binding import load_star

Entry = Callable[[SparkSession, str], DataFrame]


def _on_star(fn, **kw) -> Entry:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load_star(spark, sf_dir), **kw)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    run.plan = lambda star: fn(star, **kw)  # the plan over given star tables
    return run


def _duplicate_keys_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 on a raw table: rows, distinct (l_orderkey, l_linenumber), duplicates."""
    return QC.duplicate_keys(spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet"),
                             ["l_orderkey", "l_linenumber"], "lineitem")


def _raw(fn) -> Entry:
    """An entry that reads the driver tables directly (no star binding)."""
    fn.plan = None
    return fn


def registry() -> dict[str, Entry]:
    reg: dict[str, Entry] = {
        "driver_summary": _on_star(Q.driver_summary),
        "team_performance_overview": _on_star(Q.team_performance_overview),
        "driver_performance_comparison": _on_star(Q.driver_performance_comparison),
        "qualifying_vs_race_performance": _on_star(Q.qualifying_vs_race_performance),
        "circuit_performance_analysis": _on_star(Q.circuit_performance_analysis),
        "pit_stop_efficiency": _on_star(Q.pit_stop_efficiency),
        "fastest_pit_stops": _on_star(Q.fastest_pit_stops),
        "championship_progression": _on_star(Q.championship_progression),
        # the SQL-file form: first round of a season has no previous value
        "championship_progression_no_fallback": _on_star(Q.championship_progression, fallback=False),
        "driver_championship_battle": _on_star(Q.driver_championship_battle),
        "fastest_laps_analysis": _on_star(Q.fastest_laps_analysis),
        "reliability_analysis": _on_star(Q.reliability_analysis),
        "failure_modes": _on_star(Q.failure_modes),
        "race_start_analysis": _on_star(Q.race_start_analysis),
        "key_performance_indicators": _on_star(Q.key_performance_indicators),
        # documented name of the KPI query
        "kpi_summary": _on_star(Q.key_performance_indicators),
        "driver_summary_pipeline": _on_star(Q.driver_summary_pipeline),
        # one team, or teams by their refs: the filter reaches the scan
        "team_performance_overview_team": _on_star(Q.team_performance_overview, cid=9),
        "championship_progression_team": _on_star(Q.championship_progression, cid=9),
        "fastest_pit_stops_team": _on_star(Q.fastest_pit_stops, cid=9),
        "driver_summary_teams": _on_star(Q.driver_summary, refs=["nation_3", "nation_9"]),
        "teammate_delta_teams": _on_star(M.teammate_delta, refs=["nation_3", "nation_9"], inference=False),
        # staging and marts
        "stg_results": _on_star(D.stg_results),
        "stg_races": _on_star(D.stg_races),
        "stg_drivers": _on_star(D.stg_drivers),
        "stg_pit_stops": _on_star(D.stg_pit_stops),
        "stg_qualifying": _on_star(D.stg_qualifying),
        "stg_constructor_standings": _on_star(D.stg_constructor_standings),
        "mart_driver_summary": _on_star(D.mart_driver_summary),
        "mart_pit_stop_efficiency": _on_star(D.mart_pit_stop_efficiency),
        "mart_championship_progression": _on_star(D.mart_championship_progression),
        "mart_qualifying_vs_race": _on_star(D.mart_qualifying_vs_race),
        # statistical models (exact parts; *_inference / _ci add p-values
        # and intervals from the t / chi-square helpers)
        "teammate_delta": _on_star(M.teammate_delta, inference=False),
        "teammate_delta_inference": _on_star(M.teammate_delta),
        "grid_finish_ols": _on_star(M.grid_finish_ols, inference=False),
        "grid_finish_ols_inference": _on_star(M.grid_finish_ols, p_digits=9),
        "pit_z": _on_star(M.pit_z),
        "trajectory": _on_star(M.trajectory),
        "dnf_rate": _on_star(M.dnf_rate, with_ci=False),
        "dnf_rate_ci": _on_star(M.dnf_rate),
        "tyre_degradation": _on_star(M.tyre_degradation),
        "stints": _on_star(M.stints),
        "sector_means": _on_star(M.sector_means),
        # derived series
        "round_by_round": _on_star(K.round_by_round),
        "grid_finish": _on_star(K.grid_finish),
        "season_trajectory": _on_star(K.season_trajectory),
        "finish_positions": _on_star(K.finish_positions),
        "points_gap": _on_star(K.points_gap),
        "position_matrix": _on_star(K.position_matrix),
        "driver_ols_lines": _on_star(K.driver_ols_lines),
        "pit_sem": _on_star(K.pit_sem),
        "dnf_ci": _on_star(K.dnf_ci),
        "sector_gap": _on_star(K.sector_gap),
        "degradation_pivot": _on_star(K.degradation_pivot),
        "stint_bars": _on_star(K.stint_bars),
        "kpi_block": _on_star(K.kpi_block),
        "ticker": _on_star(K.ticker),
        "season_facets": _on_star(K.season_facets),
        "pit_stops_z": _on_star(K.pit_stops_z),
        "compound_map": _on_star(K.compound_map),
        "sectors_unpivoted": _on_star(K.sectors_unpivoted),
        "teammate_labels": _on_star(K.teammate_labels),
        "ols_fit_line": _on_star(K.ols_fit_line),
        # quality gates, contracts, model tests
        "quality_checks": _on_star(C.quality_checks),
        "quality_report": _on_star(C.quality_report),
        "contract_issues": _on_star(C.contract_issues),
        "enum_values": _on_star(C.enum_values),
        "column_tests": _on_star(C.column_tests),
        # ingest: landed nested documents -> flatten -> transform
        "flatten_results_json": _on_star(G.flatten_results_json),
        "flatten_qualifying_json": _on_star(G.flatten_qualifying_json),
        "flatten_pit_stops_json": _on_star(G.flatten_pit_stops_json),
        "flatten_standings_json": _on_star(G.flatten_standings_json),
        "flatten_races_json": _on_star(G.flatten_races_json),
        "flatten_constructor_standings_json": _on_star(G.flatten_constructor_standings_json),
        "flatten_circuits_json": _on_star(G.flatten_circuits_json),
        "flatten_seasons_json": _on_star(G.flatten_seasons_json),
        "flatten_constructors_json": _on_star(G.flatten_constructors_json),
        "flatten_drivers_json": _on_star(G.flatten_drivers_json),
        "broken_documents": _on_star(G.broken_documents),
        "ref_dropout": _on_star(G.ref_dropout),
        "laps_from_sessions": _on_star(G.laps_from_sessions),
        "pipeline_quality": _on_star(G.pipeline_quality),
        "pipeline_summary": _on_star(G.pipeline_summary),
        "pipeline_marts": _on_star(G.pipeline_marts),
        "rounds_by_year": _on_star(G.rounds_by_year),
        # loads, ledgers, streaming
        "upsert_results": _on_star(LD.upsert_results),
        "stream_upsert": _on_star(LD.stream_upsert),
        "slice_replace_laps": _on_star(LD.slice_replace_laps),
        "ledger_pending": _on_star(LD.ledger_pending),
        "completeness": _on_star(LD.completeness_results),
        "team_slice_sizes": _on_star(LD.team_slice_sizes),
        "dry_run_preview": _on_star(LD.dry_run_preview),
        "run_log": _on_star(LD.run_log),
        "resume_load": _on_star(LD.resume_load),
        "schema_drift": _on_star(LD.schema_drift),
        "duplicate_keys_lineitem": _raw(_duplicate_keys_lineitem),
    }
    return reg


def names() -> list[str]:
    return sorted(registry())


def run(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    reg = registry()
    if name not in reg:
        raise KeyError(f"unknown query {name!r}; known: {', '.join(sorted(reg))}")
    return reg[name](spark, sf_dir)


def run_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: f(spark, sf_dir) for n, f in registry().items()}
