"""The batch pipeline as one driver function.

raw CSV files (text refs) → transform jobs → contract coercion → load into the
versioned store (full refresh or keyed upsert, facts partitioned by year) with
a run record → lap sessions → quality gate → marts → driver summary. Each
table is read and written once: its rows, lost values and contract counts are
observed on that write, and a strict load that breaks the contract isn't
committed. The driver only sequences the jobs.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.operators import ledger as LG
from stintlake.operators import quality as QC
from stintlake.operators import transform as X
from stintlake.plans import queries as Q
from stintlake.plans.mart_graph import build_marts
from stintlake.schemas import LOAD_ORDER, PRIMARY_KEYS, SCHEMAS
from stintlake.session import cut_lineage
from stintlake.sources.binding import FACTS, Star, with_year
from stintlake.sources.files import read_csv_strings
from stintlake.sources.laps import laps_by_parts, laps_from_sessions, team_race_codes
from stintlake.sources.store import Store

# Column layout of the raw CSV files (the flattened source rows).
RAW_COLUMNS = {
    "circuits": ["circuit_ref", "circuit_name", "location", "country", "lat", "lng", "altitude", "url"],
    "seasons": ["year", "url"],
    "constructors": ["constructor_id", "constructor_ref", "constructor_name", "nationality", "url"],
    "drivers": ["driver_id", "driver_ref", "driver_number", "code", "forename", "surname", "dob",
                "nationality", "url"],
    "races": ["race_id", "year", "round", "circuit_ref", "race_name", "race_date", "race_time", "url"],
    "results": ["race_id", "driver_ref", "constructor_ref", "number", "grid", "position", "position_text",
                "position_order", "points", "laps", "time_result", "milliseconds", "fastest_lap",
                "fastest_lap_rank", "fastest_lap_time", "fastest_lap_speed", "status"],
    "qualifying": ["race_id", "driver_ref", "constructor_ref", "number", "position", "q1", "q2", "q3"],
    "pit_stops": ["race_id", "driver_ref", "stop", "lap", "time_of_day", "duration", "milliseconds"],
    "constructor_standings": ["race_id", "constructor_ref", "points", "position", "position_text", "wins"],
    "driver_standings": ["race_id", "driver_ref", "points", "position", "position_text", "wins"],
}


@dataclass
class PipelineConfig:
    start_year: int
    end_year: int
    mode: str = "full"            # "full" refresh or "incremental" upsert
    strict: bool = False          # contract issues raise instead of warn
    skip_transform: bool = False  # load already-clean tables from the store
    skip_load: bool = False
    skip_quality: bool = False
    every_race: bool = False      # the gate judges races of other seasons too
    skip_marts: bool = False
    sessions: str | Callable[[], str] | None = None  # folder of lap sessions (Parquet), or what lands it; none: no laps are loaded
    land: Callable[[str], None] | None = None  # lands a table's raw file, when it is to be read
    drop_raw: bool = False        # the raw files and the sessions that the run lands are its own: they go once they are loaded
    dry_run: bool = False         # only preview row counts
    team_id: int | None = None    # optional slice to one team
    truncate_points: bool = False
    min_year: int | None = None   # project scope: the range is clamped to it
    max_year: int | None = None


@dataclass
class PipelineResult:
    run_id: str | None = None
    loaded: dict = field(default_factory=dict)
    warnings: list = field(default_factory=list)
    preview: DataFrame | None = None
    quality: DataFrame | None = None
    summary: DataFrame | None = None
    marts: DataFrame | None = None  # model, kind, status, rows, failures


def check_year_range(start_year: int, end_year: int, min_year: int | None = None,
                     max_year: int | None = None, notes: list | None = None) -> tuple[int, int]:
    """Clamp the range to the project scope (with a note per clamp); an
    empty range after clamping is an error."""
    if min_year is not None and start_year < min_year:
        if notes is not None:
            notes.append(f"start_year {start_year} lies before the first season in scope; starting with {min_year}.")
        start_year = min_year
    if max_year is not None and end_year > max_year:
        if notes is not None:
            notes.append(f"end_year {end_year} lies after the last season in scope; ending with {max_year}.")
        end_year = max_year
    if start_year > end_year:
        raise ValueError(f"Invalid year range {start_year}-{end_year}.")
    return start_year, end_year


def raw_reader(spark: SparkSession, raw_dir: str, notes: list, land: Callable[[str], None] | None = None) -> Callable[[str], DataFrame]:
    """Reads a raw table by name, which ``land`` (if given) writes first."""
    def read(name: str) -> DataFrame:
        if land:
            land(name)
        # the place in the files: splits of a file are read in any order, rows of a split in theirs
        return read_csv_strings(spark, f"{raw_dir.rstrip('/')}/{name}.csv", RAW_COLUMNS[name], notes, seq=X.SEQ)

    return read


def transforms(raw: Callable[[str], DataFrame], truncate_points: bool = False) -> dict[str, Callable[[], DataFrame]]:
    """What makes each table of the raw ones, which are read by then."""
    circuits = functools.cache(lambda: X.transform_circuits(raw("circuits")))
    drivers = functools.cache(lambda: X.transform_drivers(raw("drivers")))
    constructors = functools.cache(lambda: X.transform_constructors(raw("constructors")))
    dim_c = lambda: circuits().select("circuit_ref", "circuit_id")
    dim_d = lambda: drivers().select("driver_ref", "driver_id")
    dim_k = lambda: constructors().select("constructor_ref", "constructor_id")
    return {
        "circuits": circuits,
        "seasons": lambda: X.conform(raw("seasons"), ["year", "url"], types={"year": "int"}),
        "constructors": constructors,
        "drivers": drivers,
        "races": lambda: X.transform_races(raw("races"), dim_c()),
        "results": lambda: X.transform_results(raw("results"), dim_d(), dim_k(), truncate_points),
        "qualifying": lambda: X.transform_qualifying(raw("qualifying"), dim_d(), dim_k()),
        "pit_stops": lambda: X.transform_pit_stops(raw("pit_stops"), dim_d()),
        "constructor_standings": lambda: X.transform_standings(raw("constructor_standings"), dim_k(),
                                                               "constructor_ref", "constructor_id"),
        "driver_standings": lambda: X.transform_standings(raw("driver_standings"), dim_d(), "driver_ref", "driver_id"),
    }


def _load(store: Store, name: str, raw: DataFrame, cfg: PipelineConfig, warnings: list) -> int:
    """Coerce and load one table; its stored rows."""
    seen = QC.LoadMetrics(raw, name)
    by = "year" if name in FACTS else None
    df = with_year(seen.df, store.read("races", SCHEMAS["races"])) if by else seen.df
    if cfg.mode == "incremental":
        df = cut_lineage(df, f"staged-{name}")  # observed here; of rows with one key the last of the file wins
        seen.judge(cfg.strict)
        store.merge_upsert(name, df, PRIMARY_KEYS[name], X.SEQ if X.SEQ in df.columns else [], by)
        n = store.read(name).count()
    else:
        store.write_full(name, df.drop(X.SEQ), by, check=lambda: seen.judge(cfg.strict))
        n = seen.rows
    warnings += [*seen.lost(), *seen.issues()]
    return n


def _load_laps(store: Store, cfg: PipelineConfig, warnings: list) -> int:
    """Laps from the sessions, for the drivers that the loaded results have
    entered. A failure is a warning: the other tables stay loaded."""
    try:
        sessions = cfg.sessions() if callable(cfg.sessions) else cfg.sessions
        results = store.read("results")
        if cfg.mode == "incremental":  # stored results may have the year that their race had before
            results = results.drop("year")
        codes = team_race_codes(results, store.read("drivers"), [cfg.team_id] if cfg.team_id is not None else None)
        if "year" not in codes.columns:
            codes = with_year(codes, store.read("races"))
        if cfg.mode == "incremental" and store.exists("laps"):
            store.replace_slice("laps", laps_from_sessions(store.spark.read.parquet(sessions), codes), "race_id")
        else:
            store.write_parts("laps", laps_by_parts(store.spark, sessions, codes), "year")
        if cfg.drop_raw and callable(cfg.sessions):
            store.fs.delete(sessions)
        return store.read("laps").count()
    except PySparkException as exc:
        warnings.append(f"No laps loaded: {str(exc).splitlines()[0]}")
        return 0


def run_pipeline(spark: SparkSession, raw_dir: str, store_root: str, cfg: PipelineConfig) -> PipelineResult:
    out = PipelineResult()
    cfg.start_year, cfg.end_year = check_year_range(cfg.start_year, cfg.end_year, cfg.min_year,
                                                    cfg.max_year, out.warnings)
    store = Store(spark, store_root)
    if cfg.skip_transform:
        tables = {n: functools.partial(store.read, n, SCHEMAS[n]) for n in RAW_COLUMNS}
    else:
        tables = transforms(raw_reader(spark, raw_dir, out.warnings, cfg.land), cfg.truncate_points)
    if cfg.dry_run:
        out.preview = LG.dry_run_preview({n: make() for n, make in tables.items()})
        return out
    if cfg.team_id is not None:
        held = {n: make() for n, make in tables.items()}
        held.update(LG.team_slice(Star(**held), cfg.team_id))
        tables = {n: functools.partial(held.get, n) for n in held}
    if not cfg.skip_load:
        if cfg.mode == "incremental":  # what is stored must still fit what is loaded
            known = {n: store.read(n) for n in LOAD_ORDER if n in SCHEMAS and store.exists(n)}
            out.warnings += [f"Stored table {x['table']}: {x['column'] or ''} {x['issue']}."
                             for x in LG.schema_drift(spark, known).collect()]  # a row per column at most
        log = LG.RunLog(store)
        out.run_id = log.start(raw_dir, cfg.mode)
        try:
            for name in LOAD_ORDER:
                if name not in tables:
                    continue
                out.loaded[name] = _load(store, name, tables[name](), cfg, out.warnings)
                log.table(out.run_id, name, out.loaded[name])
                if cfg.drop_raw and name in FACTS and cfg.team_id is None:  # nothing else is made from it
                    store.fs.delete(f"{raw_dir.rstrip('/')}/{name}.csv")
            if cfg.drop_raw:
                store.fs.delete(raw_dir)
            if cfg.sessions:
                out.loaded["laps"] = _load_laps(store, cfg, out.warnings)
                log.table(out.run_id, "laps", out.loaded["laps"])
            log.end(out.run_id, "success")
        except Exception:
            log.end(out.run_id, "failed")
            raise
    loaded = Star(loader=lambda n: store.read(n, SCHEMAS[n]))
    if not cfg.skip_quality:
        skipped = store.read("ledger").filter("state = 'skipped'") if store.exists("ledger") else None
        out.quality = QC.run_checks(loaded, cfg.start_year, cfg.end_year, skipped, isolate=True, every_race=cfg.every_race)
    if not cfg.skip_marts:
        out.marts = build_marts(loaded, store, cfg.team_id)
    out.summary = Q.driver_summary_pipeline(loaded)
    return out
