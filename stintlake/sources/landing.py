"""Re-encode star tables as landed source documents (the nested result-API
shape), one JSON document per line. Used to give the ingest jobs real input
derived from the test tables; it only builds documents (``to_json`` of
structs, leaves as strings, a one-entry list written as a bare object) and
does none of the parsing, defaulting or key resolution the ingest does."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.session import shared_dir


def _str(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _list_or_object(items: Column) -> Column:
    """JSON text of an array, or of its only element when it has one."""
    return F.when(F.size(items) == 1, F.to_json(F.element_at(items, 1))).otherwise(F.to_json(items))


def _race() -> Column:
    return F.struct(
        _str("year").alias("season"), _str("round").alias("round"), F.col("race_name").alias("raceName"),
        _str("race_date").alias("date"), F.concat(F.col("race_time"), F.lit("Z")).alias("time"),
        F.col("url"), F.struct(F.col("circuit_ref").alias("circuitId")).alias("Circuit"))


def race_documents(t, list_name: str, entries: DataFrame, entry: Column) -> DataFrame:
    """One document per race: ``RaceTable.Races[0]`` carries the race and
    its ``list_name`` entries (list, or bare object for one entry)."""
    races = t.races.join(t.circuits.select("circuit_id", "circuit_ref"), "circuit_id", "left")
    per_race = entries.groupBy("race_id").agg(F.collect_list(entry).alias("items"))
    docs = races.join(per_race, "race_id", "inner").select(
        F.to_json(_race()).alias("race_json"), _list_or_object(F.col("items")).alias("items_json"))
    # splice the entries into the race object: {...race..., "<list>": <items>}
    race_obj = F.concat(F.expr("substring(race_json, 1, length(race_json) - 1)"),
                        F.lit(',"' + list_name + '":'), F.col("items_json"), F.lit("}"))
    return docs.select(F.concat(F.lit('{"MRData":{"total":"1","RaceTable":{"Races":['), race_obj,
                                F.lit("]}}}")).alias("value"))


def schedule_documents(t, keep: tuple = ()) -> DataFrame:
    """One document per race of the calendar, whether it has entries or not;
    ``keep`` names race columns to return beside it."""
    races = t.races.join(t.circuits.select("circuit_id", "circuit_ref"), "circuit_id", "left")
    return races.select(*keep, F.concat(F.lit('{"MRData":{"total":"1","RaceTable":{"Races":['), F.to_json(_race()), F.lit("]}}}")).alias("value"))


#: Items of a page of documents.
PAGE = 30


def _pages(items: DataFrame, table: str, list_name: str, key: str, item: Column) -> DataFrame:
    """Pages of a listing: at most PAGE items (rows with neighbouring keys) a document."""
    pages = items.groupBy(F.floor(F.col(key) / PAGE).alias("page")).agg(F.collect_list(F.to_json(item)).alias("items"))
    return pages.select(F.concat(F.lit('{"MRData":{"' + table + '":{"' + list_name + '":['), F.array_join("items", ","), F.lit("]}}}")).alias("value"))


def circuit_documents(t) -> DataFrame:
    place = F.struct(_str("lat").alias("lat"), _str("lng").alias("long"), F.col("location").alias("locality"), F.col("country"))
    return _pages(t.circuits, "CircuitTable", "Circuits", "circuit_id", F.struct(
        F.col("circuit_ref").alias("circuitId"), F.col("circuit_name").alias("circuitName"), F.col("url"), place.alias("Location")))


def season_documents(t) -> DataFrame:
    return _pages(t.seasons, "SeasonTable", "Seasons", "year", F.struct(_str("year").alias("season"), F.col("url")))


def constructor_documents(t) -> DataFrame:
    return _pages(t.constructors, "ConstructorTable", "Constructors", "constructor_id", F.struct(
        F.col("constructor_ref").alias("constructorId"), F.col("constructor_name").alias("name"), "nationality", "url"))


def driver_documents(t) -> DataFrame:
    return _pages(t.drivers, "DriverTable", "Drivers", "driver_id", F.struct(
        F.col("driver_ref").alias("driverId"), "code", F.col("forename").alias("givenName"), F.col("surname").alias("familyName"),
        _str("dob").alias("dateOfBirth"), "nationality", "url"))


def results_documents(t) -> DataFrame:
    res = t.results.join(t.drivers.select("driver_id", "driver_ref"), "driver_id") \
        .join(t.constructors.select("constructor_id", "constructor_ref"), "constructor_id")
    time = F.when(F.col("milliseconds").isNotNull(),
                  F.struct(F.col("time_result").alias("time"), _str("milliseconds").alias("millis")))
    fl = F.struct(_str("fastest_lap_rank").alias("rank"), _str("fastest_lap").alias("lap"),
                  F.when(F.col("fastest_lap_time").isNotNull(),
                         F.struct(F.col("fastest_lap_time").alias("time"))).alias("Time"),
                  F.struct(F.col("fastest_lap_speed").alias("speed")).alias("AverageSpeed"))
    entry = F.struct(
        _str("number").alias("number"),
        F.coalesce(_str("position"), F.col("position_text")).alias("position"),
        F.col("position_text").alias("positionText"), _str("points").alias("points"),
        _str("grid").alias("grid"), _str("laps").alias("laps"), F.col("status"),
        F.struct(F.col("driver_ref").alias("driverId")).alias("Driver"),
        F.struct(F.col("constructor_ref").alias("constructorId")).alias("Constructor"),
        time.alias("Time"), fl.alias("FastestLap"))
    return race_documents(t, "Results", res, entry)


def qualifying_documents(t) -> DataFrame:
    q = t.qualifying.join(t.drivers.select("driver_id", "driver_ref"), "driver_id") \
        .join(t.constructors.select("constructor_id", "constructor_ref"), "constructor_id")
    entry = F.struct(_str("number").alias("number"), _str("position").alias("position"),
                     F.nullif(F.col("q1"), F.lit("")).alias("Q1"), F.nullif(F.col("q2"), F.lit("")).alias("Q2"),
                     F.nullif(F.col("q3"), F.lit("")).alias("Q3"),
                     F.struct(F.col("driver_ref").alias("driverId")).alias("Driver"),
                     F.struct(F.col("constructor_ref").alias("constructorId")).alias("Constructor"))
    return race_documents(t, "QualifyingResults", q, entry)


def pit_stop_documents(t) -> DataFrame:
    p = t.pit_stops.join(t.drivers.select("driver_id", "driver_ref"), "driver_id")
    entry = F.struct(F.col("driver_ref").alias("driverId"), _str("stop").alias("stop"), _str("lap").alias("lap"),
                     F.col("time_of_day").alias("time"), F.col("duration"))
    return race_documents(t, "PitStops", p, entry)


def standings_documents(t, kind: str = "driver") -> DataFrame:
    """One document per race: ``StandingsTable.StandingsLists[0]`` with the
    standings after that round."""
    if kind == "driver":
        st = t.driver_standings.join(t.drivers.select("driver_id", "driver_ref"), "driver_id")
        ent = F.struct(F.col("driver_ref").alias("driverId")).alias("Driver")
        key = "DriverStandings"
    else:
        st = t.constructor_standings.join(t.constructors.select("constructor_id", "constructor_ref"),
                                          "constructor_id")
        ent = F.struct(F.col("constructor_ref").alias("constructorId")).alias("Constructor")
        key = "ConstructorStandings"
    entry = F.struct(_str("position").alias("position"), F.col("position_text").alias("positionText"),
                     _str("points").alias("points"), _str("wins").alias("wins"), ent)
    per = st.groupBy("race_id").agg(F.collect_list(entry).alias("items"))
    docs = per.join(t.races.select("race_id", "year", "round"), "race_id").select(
        F.to_json(F.struct(_str("year").alias("season"), _str("round").alias("round"))).alias("sl"),
        _list_or_object(F.col("items")).alias("items_json"))
    sl = F.concat(F.expr("substring(sl, 1, length(sl) - 1)"), F.lit(',"' + key + '":'), F.col("items_json"),
                  F.lit("}"))
    return docs.select(F.concat(F.lit('{"MRData":{"total":"1","StandingsTable":{"StandingsLists":['), sl,
                                F.lit("]}}}")).alias("value"))


def _landing_path(spark, name: str, key: str | None) -> str:
    return shared_dir(spark, f"landing/{name}-{key or uuid.uuid4().hex[:12]}")


def land(docs: DataFrame, name: str, key: str | None = None) -> str:
    """Write documents (one per line) to the shared checkpoint dir and
    return the folder. With ``key`` (the identity of the star they come
    from) the documents are written once and reused."""
    from stintlake.sources.store import write_once

    path = _landing_path(docs.sparkSession, name, key)
    # names and braces repeat in every document: packed, they take a small part of the disk
    return write_once(docs.sparkSession, path, lambda p: docs.write.option("compression", "gzip").text(p))


def raw_csv_table(t, name: str) -> DataFrame:
    """A star table in the raw CSV layout: text refs in place of the fact
    tables' keys (as the source delivers them)."""
    d = t.drivers.select("driver_id", "driver_ref")
    k = t.constructors.select("constructor_id", "constructor_ref")
    c = t.circuits.select("circuit_id", "circuit_ref")
    return {
        "circuits": lambda: t.circuits.orderBy("circuit_id").drop("circuit_id"),
        "seasons": lambda: t.seasons.orderBy("year"),
        "constructors": lambda: t.constructors.orderBy("constructor_id"),
        "drivers": lambda: t.drivers,
        "races": lambda: t.races.join(c, "circuit_id", "left").select(
            "race_id", "year", "round", "circuit_ref", "race_name", "race_date", "race_time", "url"),
        "results": lambda: t.results.join(d, "driver_id").join(k, "constructor_id").drop("driver_id", "constructor_id"),
        "qualifying": lambda: t.qualifying.join(d, "driver_id").join(k, "constructor_id").drop("driver_id", "constructor_id"),
        "pit_stops": lambda: t.pit_stops.join(d, "driver_id").drop("driver_id"),
        "constructor_standings": lambda: t.constructor_standings.join(k, "constructor_id").drop("constructor_id"),
        "driver_standings": lambda: t.driver_standings.join(d, "driver_id").drop("driver_id"),
    }[name]()


def land_csv_table(t, root: str, table: str) -> None:
    """Write a table of the raw CSV layout (header row, a folder named ``<table>.csv``)."""
    from stintlake.sources.store import write_once

    df = raw_csv_table(t, table)
    # tables as long as the calendar or the list of teams: one file each, in order
    w = df.coalesce(1) if table in ("circuits", "seasons", "constructors") else df
    write_once(df.sparkSession, f"{root}/{table}.csv", lambda p: w.write.option("header", True).option("compression", "gzip").csv(p))


def lap_sessions(t) -> DataFrame:
    """Laps as a timing feed: three-letter driver codes, day-time intervals
    for lap / sector / pit times, lower-case compounds, float counters."""
    def iv(c):
        return F.make_dt_interval(secs=F.col(c).cast("decimal(18,6)"))
    laps = t.laps.join(t.drivers.select("driver_id", "code"), "driver_id", "inner")
    return laps.select(
        "race_id", F.col("code").alias("Driver"), F.lit(True).alias("IsAccurate"),
        F.col("lap_number").cast("double").alias("LapNumber"),
        iv("lap_time_s").alias("LapTime"), iv("sector1_s").alias("Sector1Time"),
        iv("sector2_s").alias("Sector2Time"), iv("sector3_s").alias("Sector3Time"),
        F.lower("compound").alias("Compound"), F.col("tyre_life").cast("double").alias("TyreLife"),
        F.col("stint").cast("double").alias("Stint"), F.col("is_personal_best").alias("IsPersonalBest"),
        F.when(F.col("pit_in"), F.make_dt_interval(mins=F.lit(90))).alias("PitInTime"),
        F.when(F.col("pit_out"), F.make_dt_interval(mins=F.lit(91))).alias("PitOutTime"),
        F.col("track_status").alias("TrackStatus"))
