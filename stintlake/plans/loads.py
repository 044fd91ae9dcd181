"""Registered load / ledger / streaming entries over the star tables.

Inputs are split out of the bound tables (seasons up to the middle one as the
first load, seasons from the middle one as updates with a changed status), then
the real load path runs on them: tables partitioned by year, keyed merge and
slice replace of the touched years, the resume ledger, completeness, run log,
and the streaming upsert.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from stintlake.operators import ledger as LG
from stintlake.schemas import PRIMARY_KEYS, SCHEMAS
from stintlake.session import CODEC, shared_dir
from stintlake.sources.binding import season_span
from stintlake.sources.store import Store
from stintlake.streaming.ingest import stream_upsert as _stream_upsert

RESULT_KEYS = PRIMARY_KEYS["results"]


def _fresh_store(t, name: str) -> Store:
    """A store of its own for each run: frames of earlier runs stay readable."""
    spark = t.results.sparkSession
    return Store(spark, shared_dir(spark, f"loads/{name}-{uuid.uuid4().hex[:12]}"))


def _split_year(t) -> int:
    first, last = season_span(t)
    return (first + last) // 2


def _first_load(t) -> DataFrame:
    return t.yearly("results").filter(F.col("year") <= _split_year(t))


def _updates(t) -> DataFrame:
    return t.yearly("results").filter(F.col("year") >= _split_year(t)).withColumn("status", F.concat(F.col("status"), F.lit(" (rev)")))


def upsert_results(t) -> DataFrame:
    """S20 + S22: full load of the early seasons, then a keyed upsert of the
    later ones (overlapping season: updated rows replace old ones). Files of
    the seasons before stay as they are."""
    st = _fresh_store(t, "upsert")
    st.write_full("results", _first_load(t), "year", dealt=t.dealt)
    st.merge_upsert("results", _updates(t), RESULT_KEYS, "status")
    return st.read("results").select(*t.results.columns)


def stream_upsert(t) -> DataFrame:
    """T1 + T2: the same two loads arrive as files; an ``availableNow``
    stream merges each micro-batch by key; run twice on one checkpoint."""
    spark = t.results.sparkSession
    st = _fresh_store(t, "stream")
    run = f"{st.root}/_run-{uuid.uuid4().hex[:10]}"
    src, ckpt = run + "/landing", run + "/checkpoint"
    _first_load(t).write.option("compression", CODEC).parquet(src + "/b1")
    schema = StructType([*SCHEMAS["results"].fields, StructField("year", IntegerType())])
    _stream_upsert(spark, src + "/*", schema, st, "results", RESULT_KEYS, ckpt, "status", partition_by="year")
    _updates(t).write.option("compression", CODEC).parquet(src + "/b2")
    _stream_upsert(spark, src + "/*", schema, st, "results", RESULT_KEYS, ckpt, "status", partition_by="year")
    st.fs.delete(run)  # batches consumed; the merged table is committed in the store
    return st.read("results").select(*t.results.columns)


def slice_replace_laps(t) -> DataFrame:
    """Reload the laps of the latest season: every lap of those races
    is replaced by the reloaded rows (here with track status '2')."""
    st = _fresh_store(t, "slice")
    laps = t.yearly("laps")
    st.write_full("laps", laps, "year", dealt=t.dealt)
    reload = laps.filter(F.col("year") == t.races.agg(F.max("year")).scalar()).withColumn("track_status", F.lit("2"))
    st.replace_slice("laps", reload, "race_id")
    return st.read("laps").select(*t.laps.columns)


def ledger_pending(t) -> DataFrame:
    """Rounds still to extract for the results feed: all rounds minus
    those done (rounds with qualifying rows) or skipped (rounds without
    results)."""
    work = t.races.select(F.lit("results").alias("dataset"), "year", "round")
    done = t.races.join(t.qualifying.select("race_id").distinct(), "race_id", "left_semi") \
        .select(F.lit("results").alias("dataset"), "year", "round", F.lit("done").alias("state"))
    skipped = t.races.join(t.results.select("race_id").distinct(), "race_id", "left_anti") \
        .select(F.lit("results").alias("dataset"), "year", "round", F.lit("skipped").alias("state"))
    ledger = LG.normalise_ledger(done.unionByName(skipped), *season_span(t))
    return LG.ledger_pending(work, ledger)


def completeness_results(t, min_rows_per_race: int = 5) -> DataFrame:
    """Per season, races, result rows, short races, complete flag."""
    return LG.completeness(t.results, t.races, min_rows_per_race, *season_span(t))


def team_slice_sizes(t) -> DataFrame:
    """Rows each team's slice keeps in every sliced table."""
    return LG.team_slice_sizes(t)


def dry_run_preview(t) -> DataFrame:
    """Rows per star table and a ready / empty status."""
    return LG.dry_run_preview({n: getattr(t, n) for n in t._NAMES})


def run_log(t) -> DataFrame:
    """Load every star table into a fresh store under a run record;
    returns the per-table row counts of that run."""
    st = _fresh_store(t, "runlog")
    log = LG.RunLog(st)
    run_id = log.start("landed-star", "full")
    for name in t._NAMES:
        st.write_full(name, getattr(t, name))
        log.table(run_id, name, st.read(name).count())
    log.end(run_id, "success")
    return st.read("pipeline_run_tables").select("table_name", "rows_loaded")


def schema_drift(t) -> DataFrame:
    """Three stored versions of the results: whole points and no status
    at first; an upsert of the last season that widens the one and adds the
    other; then a refresh without the number. What changed from each version to
    the next, with the rows of both."""
    st = _fresh_store(t, "drift")
    last = season_span(t)[1]
    rows = t.yearly("results")
    st.write_full("results", rows.filter(F.col("year") < last).withColumn("points", F.col("points").cast("int")).drop("status"), "year")
    st.merge_upsert("results", rows.filter(F.col("year") == last), RESULT_KEYS, "status", evolve=True)
    st.write_full("results", st.read("results").drop("number"), "year")
    a, b, c = st.versions("results")
    return LG.version_drift(st, "results", a, b).unionByName(LG.version_drift(st, "results", b, c))


def resume_load(t) -> DataFrame:
    """The results loaded season by season; a run that ends after
    three seasons, and one that fails between the data and the ledger of the
    fourth, are taken up by the last run."""
    st = _fresh_store(t, "resume")
    source = t.yearly("results").join(t.races.select("race_id", "year", "round"), ["race_id", "year"])  # a season's rows meet its races only
    rounds = t.races.select(F.lit("results").alias("dataset"), "year", "round")
    LG.load_rounds(st, "results", rounds, source, ["race_id"], "year", stop_after=3)
    half = source.filter(F.col("year") == season_span(t)[0] + 3).filter(F.col("round") % 2 == 0).withColumn("status", F.lit("unfinished"))
    st.replace_slice("results", half.drop("round"), "race_id")
    LG.load_rounds(st, "results", rounds, source, ["race_id"], "year")
    return st.read("results").select(*t.results.columns)
