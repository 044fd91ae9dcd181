"""Registered ingest entries: land star rows as nested documents, then run
the real ingest path on them (read, unwrap, flatten, parse durations,
resolve references, coerce)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.operators import transform as X
from stintlake.operators.joins import resolve_ref
from stintlake.sources import landing, nested


def _docs(t, make, name: str) -> DataFrame:
    docs = make(t)
    return nested.read_documents(docs.sparkSession, landing.land(docs, name, t.key))


def flatten_results_json(t) -> DataFrame:
    """Results documents → flattened rows → transform (refs to keys)."""
    raw = nested.flatten_results(_docs(t, landing.results_documents, "results"))
    return X.transform_results(raw, t.drivers, t.constructors)


def flatten_qualifying_json(t) -> DataFrame:
    """Qualifying documents → flattened rows (missing times as '') → refs to keys."""
    raw = nested.flatten_qualifying(_docs(t, landing.qualifying_documents, "qualifying"))
    return X.transform_qualifying(raw, t.drivers, t.constructors)


def flatten_pit_stops_json(t) -> DataFrame:
    """Pit stop documents (durations as text) → milliseconds parsed."""
    raw = nested.flatten_pit_stops(_docs(t, landing.pit_stop_documents, "pit_stops"))
    return X.transform_pit_stops(raw, t.drivers)


def flatten_standings_json(t) -> DataFrame:
    """Standings lists (two-level nesting, round 0 skipped) → driver standings."""
    raw = nested.flatten_standings(_docs(t, lambda s: landing.standings_documents(s, "driver"), "standings"))
    return X.transform_standings(raw, t.drivers, "driver_ref", "driver_id")


def flatten_constructor_standings_json(t) -> DataFrame:
    """Team standings lists → constructor standings (the same routine)."""
    docs = _docs(t, lambda s: landing.standings_documents(s, "constructor"), "constructor_standings")
    raw = nested.flatten_standings(docs, "ConstructorStandings", "Constructor", "constructor_ref", "constructorId")
    return X.transform_standings(raw, t.constructors, "constructor_ref", "constructor_id")


def flatten_races_json(t) -> DataFrame:
    """Race documents of the whole calendar → races (time suffix stripped, circuit ref → key, race key)."""
    raw = nested.flatten_races(_docs(t, landing.schedule_documents, "calendar"))
    return X.transform_races(raw, t.circuits)


def flatten_circuits_json(t) -> DataFrame:
    """S3: circuit pages → circuits, keys by ref."""
    return X.transform_circuits(nested.flatten_circuits(_docs(t, landing.circuit_documents, "circuits")))


def flatten_seasons_json(t) -> DataFrame:
    """Season pages → seasons."""
    return nested.flatten_seasons(_docs(t, landing.season_documents, "seasons"))


def flatten_constructors_json(t) -> DataFrame:
    """Constructor pages → constructors with surrogate keys by ref."""
    return X.transform_constructors(nested.flatten_constructors(_docs(t, landing.constructor_documents, "constructors")))


def flatten_drivers_json(t) -> DataFrame:
    """Driver pages → drivers, keys by ref in ranges."""
    return X.transform_drivers(nested.flatten_drivers(_docs(t, landing.driver_documents, "drivers")))


def broken_documents(t) -> DataFrame:
    """Calendar documents of which some are cut short, blank or of
    another shape: how many are kept for each reason, how many are good, and
    how many races the good ones give."""
    import uuid

    from stintlake.session import shared_dir

    spark = t.races.sparkSession
    r, v = F.col("race_id"), F.col("value")
    docs = landing.schedule_documents(t, ("race_id",)).select(
        F.when(r % 5 == 0, F.expr("substring(value, 1, CAST(length(value) / 2 AS INT))")).when(r % 7 == 0, F.lit(" "))
        .when(r % 11 == 0, F.regexp_replace(v, "MRData", "Other")).when(r % 13 == 0, F.regexp_replace(v, "RaceTable", "Listing")).otherwise(v).alias("value"))
    good, broken = nested.land_checked(spark, docs, shared_dir(spark, f"landing/checked-{uuid.uuid4().hex[:12]}"))
    counts = broken.groupBy(F.col("broken").alias("state")).agg(F.count(F.lit(1)).alias("documents"))
    return (counts.unionByName(good.agg(F.count(F.lit(1)).alias("documents")).select(F.lit("good").alias("state"), "documents"))
            .unionByName(nested.flatten_races(good).agg(F.count(F.lit(1)).alias("documents")).select(F.lit("races").alias("state"), "documents")))


def ref_dropout(t) -> DataFrame:
    """Resolve result driver refs against a map lacking one nationality's
    drivers: rows, unmapped, dropout %, level."""
    raw = t.results.join(t.drivers.select("driver_id", "driver_ref"), "driver_id").drop("driver_id")
    dim = t.drivers.filter(F.col("nationality") != "N0").select("driver_ref", "driver_id")
    _, drop = resolve_ref(raw, "driver_ref", "driver_id", dim)
    return drop.select("rows", "unmapped", F.floor(F.col("dropout_pct") * 1000 + 0.5).cast("double")
                       .alias("dropout_pct_x1000"), "level")


def rounds_by_year(t, start_year: int | None = None, end_year: int | None = None) -> DataFrame:
    """The distinct rounds of each season in range (long form); without
    a range, of every season of the races."""
    first, last = t.races.agg(F.min("year"), F.max("year")).first()
    return nested.rounds_by_year(t.races, first or 0 if start_year is None else start_year, last or 0 if end_year is None else end_year)


_RUNS: dict = {}

#: Laps of a landed file of sessions.
SESSION_ROWS = 1_000_000


def _pipeline(t):
    """One run of the whole pipeline per stored star and application: its
    three entries return parts of the same run."""
    import uuid

    from stintlake.plans.checks import END_YEAR, START_YEAR
    from stintlake.plans.pipeline import PipelineConfig, run_pipeline
    from stintlake.session import shared_dir

    spark = t.results.sparkSession
    run = (spark.sparkContext.applicationId, t.key or uuid.uuid4().hex)
    if run not in _RUNS:
        raw = shared_dir(spark, f"landing/raw-{uuid.uuid4().hex[:12]}")
        cfg = PipelineConfig(start_year=START_YEAR, end_year=END_YEAR, mode="full", sessions=lambda: _sessions(t, f"{uuid.uuid4().hex[:12]}"), every_race=True,
                             land=lambda table: landing.land_csv_table(t, raw, table), drop_raw=True)
        _RUNS[run] = run_pipeline(spark, raw, shared_dir(spark, f"pipeline/{uuid.uuid4().hex[:12]}"), cfg)
    return _RUNS[run]


def pipeline_quality(t) -> DataFrame:
    """S34 end to end on the star landed as raw CSVs and lap sessions:
    transform, contract, load, then the quality gate over the loaded tables."""
    return _pipeline(t).quality


def pipeline_summary(t) -> DataFrame:
    """S34 end to end: the driver summary printed after a pipeline run."""
    return _pipeline(t).summary


def pipeline_marts(t) -> DataFrame:
    """S33 in the pipeline: every staging model and mart with its status, rows and failing values."""
    return _pipeline(t).marts


def _sessions(t, own: str | None = None) -> str:
    """Folder of the laps landed as timing-feed sessions (written once per
    stored star; or, by the name ``own``, for one run alone)."""
    import uuid

    from stintlake.session import CODEC, shared_dir
    from stintlake.sources.store import write_once

    spark = t.results.sparkSession
    path = shared_dir(spark, f"landing/sessions-{own or t.key or uuid.uuid4().hex[:12]}")
    sessions = landing.lap_sessions(t)
    return write_once(spark, path, lambda p: sessions.write.option("compression", CODEC).option("maxRecordsPerFile", SESSION_ROWS).parquet(p))


def laps_from_sessions(t) -> DataFrame:
    """Timing-feed sessions (landed as Parquet) → laps rows via the
    race → code membership of the entries. The laps are stored, a part of the
    sessions after the other."""
    import uuid

    from stintlake.session import shared_dir
    from stintlake.sources.laps import laps_by_parts, team_race_codes
    from stintlake.sources.store import Store

    spark = t.results.sparkSession
    store = Store(spark, shared_dir(spark, f"laps/{uuid.uuid4().hex[:12]}"))
    store.write_parts("laps", laps_by_parts(spark, _sessions(t), team_race_codes(t.results, t.drivers)))
    return store.read("laps")
