"""Run bookkeeping as tables: resume ledger, completeness guard, run log,
schema drift, dry-run preview, team slicing."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.schemas import SCHEMAS, family

LEDGER_SCHEMA = "dataset string, year int, round int, state string"


def ledger_pending(work: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rounds still to process: the work list minus every (dataset, year,
    round) already marked done or skipped (both states end the work)."""
    finished = ledger.filter(F.col("state").isin("done", "skipped")).select("dataset", "year", "round").distinct()
    return work.join(finished, ["dataset", "year", "round"], "left_anti")


def normalise_ledger(ledger: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """Clean a ledger: rounds as integers (non-digits dropped), years
    outside the range dropped, duplicates removed."""
    r = F.col("round").cast("string")
    return (ledger.filter(r.rlike(r"^[0-9]+$") & F.col("year").between(start_year, end_year))
            .select("dataset", F.col("year").cast("int").alias("year"), r.cast("int").alias("round"), "state")
            .distinct())


def completeness(facts: DataFrame, races: DataFrame, min_rows_per_race: int,
                 start_year: int, end_year: int) -> DataFrame:
    """Per season: races, fact rows, races with fewer than the minimum rows,
    and whether the table is complete (rows >= races × minimum)."""
    rs = races.filter(F.col("year").between(start_year, end_year)).select("race_id", "year")
    per_race = facts.groupBy("race_id").agg(F.count(F.lit(1)).alias("n"))
    j = rs.join(per_race, "race_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return (j.groupBy("year").agg(F.count(F.lit(1)).alias("races"), F.sum("n").alias("rows"),
                                  F.count_if(F.col("n") < min_rows_per_race).alias("short_races"))
            .withColumn("complete", F.col("rows") >= F.col("races") * min_rows_per_race))


def team_slice(t, team_id) -> dict[str, DataFrame]:
    """Tables narrowed to one team: tables with a team column by that
    column; pit stops and driver standings by the team's drivers (so the
    results must be sliced first)."""
    res = t.results.filter(F.col("constructor_id") == team_id)
    drivers = res.select("driver_id").distinct()
    out = {"results": res}
    for name in ("qualifying", "constructor_standings"):
        out[name] = getattr(t, name).filter(F.col("constructor_id") == team_id)
    out["constructors"] = t.constructors.filter(F.col("constructor_id") == team_id)
    for name in ("pit_stops", "driver_standings"):
        out[name] = getattr(t, name).join(drivers, "driver_id", "left_semi")
    return out


def team_slice_sizes(t) -> DataFrame:
    """Row counts of every team's slice in one pass per table: results and
    qualifying by team column; pit stops / driver standings through the
    distinct (team, driver) pairs."""
    pairs_ = t.results.select("constructor_id", "driver_id").distinct()
    parts = []
    for name in ("results", "qualifying", "constructor_standings"):
        parts.append(getattr(t, name).groupBy("constructor_id").agg(F.count(F.lit(1)).alias("rows"))
                     .withColumn("table", F.lit(name)))
    for name in ("pit_stops", "driver_standings"):
        parts.append(getattr(t, name).join(pairs_, "driver_id", "inner").groupBy("constructor_id")
                     .agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("constructor_id", "table", "rows")


def dry_run_preview(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and a status, as one frame (one plan)."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows",
            F.when(F.col("rows") > 0, "ready").otherwise("empty").alias("status"))
        out = c if out is None else out.unionByName(c)
    return out


def schema_drift(spark: SparkSession, stored: dict[str, DataFrame | None]) -> DataFrame:
    """Compare stored tables with the declared schemas: a missing table, a
    missing column or a changed type family is one issue row."""
    rows = []
    for name, sch in SCHEMAS.items():
        if name not in stored:
            continue
        df = stored[name]
        if df is None:
            rows.append((name, None, "missing table"))
            continue
        have = {f.name: f.dataType for f in df.schema.fields}
        for f in sch.fields:
            if f.name not in have:
                rows.append((name, f.name, "missing column"))
            elif family(have[f.name]) != family(f.dataType):
                rows.append((name, f.name, f"type {have[f.name].simpleString()} != {f.dataType.simpleString()}"))
    return spark.createDataFrame(rows, "table string, column string, issue string")


def version_drift(store, table: str, old: str | None = None, new: str | None = None) -> DataFrame:
    """What changed between two stored versions of a table (the last two
    unless named): table, column, issue, old_rows, new_rows. The schemas are
    those the versions' files were written with; the counts say how many rows
    of either version a reader with the other schema would misread."""
    vs = store.versions(table)
    old, new = old or vs[-2:][0], new or vs[-1]
    a, b = store.read(table, version=old), store.read(table, version=new)
    was, now = ({f.name: f.dataType.simpleString() for f in x.schema.fields} for x in (a, b))
    rows = ([(c, "column added") for c in now if c not in was] + [(c, "column removed") for c in was if c not in now]
            + [(c, f"type {was[c]} -> {now[c]}") for c in was if c in now and was[c] != now[c]])
    issues = store.spark.createDataFrame([(table, c, i) for c, i in rows], "table string, column string, issue string")
    n = [x.agg(F.count(F.lit(1))).scalar() for x in (a, b)]  # scalar subqueries
    return issues.select("*", n[0].alias("old_rows"), n[1].alias("new_rows"))


def load_rounds(store, table: str, rounds: DataFrame, source: DataFrame, keys: list[str], by: str, stop_after: int | None = None) -> int:
    """Load the pending rounds season by season and return how many seasons
    were done; each season's ledger rows are written after its data is
    committed. A run that stops anywhere is taken up where it was: a season
    whose data is there without its ledger rows is replaced as a whole.

    ``rounds``: dataset, year, round (the work); ``source``: the rows, with
    ``year`` and ``round``; ``keys``: columns of a round in the table.
    """
    spark = store.spark
    empty = spark.createDataFrame([], LEDGER_SCHEMA)
    ledger = store.read("ledger") if store.exists("ledger") else empty
    pending = ledger_pending(rounds, ledger)
    years = sorted(r[0] for r in pending.select("year").distinct().collect())  # a row per season
    for done, year in enumerate(years):
        if done == stop_after:
            return done
        due = pending.filter(F.col("year") == year)
        rows = source.filter(F.col("year") == year).join(due.select("year", "round"), ["year", "round"], "left_semi")
        rows = rows.drop("round") if "round" not in keys else rows
        if store.exists(table):
            store.replace_slice(table, rows, keys[0])
        else:
            store.write_full(table, rows, by)
        have = source.filter(F.col("year") == year).select("year", "round").distinct()
        state = due.join(have.withColumn("state", F.lit("done")), ["year", "round"], "left")
        store.append_rows("ledger", state.select("dataset", "year", "round", F.coalesce("state", F.lit("skipped")).alias("state")))
    return len(years)


class RunLog:
    """Pipeline run ledger in the store: one row per run (start, end,
    status, source, mode) and one per loaded table; the latest state of a
    run is its newest row (``max_by``)."""

    def __init__(self, store):
        self.store = store
        self.spark = store.spark

    def start(self, source: str, mode: str) -> str:
        run_id = uuid.uuid4().hex
        now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
        self.store.append_rows("pipeline_runs", self.spark.createDataFrame(
            [(run_id, now, None, "running", source, mode)], SCHEMAS["pipeline_runs"]))
        return run_id

    def table(self, run_id: str, name: str, rows: int) -> None:
        self.store.append_rows("pipeline_run_tables", self.spark.createDataFrame(
            [(run_id, name, int(rows))], SCHEMAS["pipeline_run_tables"]))

    def end(self, run_id: str, status: str) -> None:
        now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
        runs = self.store.read("pipeline_runs").filter(F.col("run_id") == run_id)
        first = runs.agg(F.min("started_at").alias("s"), F.first("source_url").alias("u"),
                         F.first("mode").alias("m")).first()
        self.store.append_rows("pipeline_runs", self.spark.createDataFrame(
            [(run_id, first["s"], now, status, first["u"], first["m"])], SCHEMAS["pipeline_runs"]))

    def runs(self) -> DataFrame:
        r = self.store.read("pipeline_runs", SCHEMAS["pipeline_runs"])
        key = F.struct(F.coalesce("ended_at", "started_at"), F.col("status") != "running")
        return r.groupBy("run_id").agg(*[F.max_by(c, key).alias(c) for c in
                                         ("started_at", "ended_at", "status", "source_url", "mode")])


def ledger_from_json(spark: SparkSession, path: str, dataset: str, start_year: int, end_year: int) -> DataFrame:
    """Progress files of the source (``{"years": {y: [rounds]}, "skipped":
    {y: [rounds]}}``, or the older flat ``{y: [rounds]}``) as ledger rows,
    normalised: digit rounds only, years in range, duplicates removed."""
    docs = spark.read.text(path, wholetext=True)
    m = F.from_json("value", "map<string,string>")
    years_txt = F.coalesce(m["years"], F.col("value"))  # flat form: the whole doc is the map
    parts = []
    for state, txt in (("done", years_txt), ("skipped", m["skipped"])):
        ymap = F.from_json(txt, "map<string,string>")
        rows = docs.select(F.explode(ymap).alias("year", "rounds")).filter(F.col("year").rlike(r"^[0-9]+$"))
        rows = rows.select(F.col("year").cast("int").alias("year"),
                           F.explode(F.from_json("rounds", "array<string>")).alias("round"))
        parts.append(rows.select(F.lit(dataset).alias("dataset"), "year", "round", F.lit(state).alias("state")))
    return normalise_ledger(parts[0].unionByName(parts[1]), start_year, end_year)
