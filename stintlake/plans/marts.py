"""Staging views and mart tables.

Staging = light projections (renames, a derived ``is_dnf`` flag, the
null-propagating ``driver_name``); marts = aggregates over them. Marts are
per team (the mart's team variable); with ``cid=None`` every team is built
in one pass with the team as a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake import DNF_POSITION_ORDER
from stintlake.functions.columns import full_name, round_half_up
from stintlake.operators.joins import team_filter
from stintlake.plans import queries as Q

TEAM = "constructor_id"


def stg_results(t) -> DataFrame:
    """Results plus ``is_dnf`` (position_order equals the sentinel)."""
    return t.results.withColumn("is_dnf", F.col("position_order") == F.lit(DNF_POSITION_ORDER))


def stg_races(t) -> DataFrame:
    """Races with ``year`` as ``season``."""
    return t.races.select("race_id", F.col("year").alias("season"), "round", "circuit_id",
                          "race_name", "race_date", "race_time")


def stg_drivers(t) -> DataFrame:
    """Drivers with the null-propagating ``driver_name``."""
    return t.drivers.select("driver_id", "driver_ref",
                            full_name(null_safe=False).alias("driver_name"), "nationality", "dob")


def stg_pit_stops(t) -> DataFrame:
    """Pit stop columns of the staging layer."""
    return t.pit_stops.select("race_id", "driver_id", "stop", "lap", "time_of_day", "duration",
                              "milliseconds")


def stg_qualifying(t) -> DataFrame:
    """Qualifying columns of the staging layer."""
    return t.qualifying.select("race_id", "driver_id", TEAM, "number", "position", "q1", "q2", "q3")


def stg_constructor_standings(t) -> DataFrame:
    """Team standings columns of the staging layer."""
    return t.constructor_standings.select("race_id", TEAM, "points", "position", "position_text", "wins")


def _fact(t, cid) -> DataFrame:
    res = team_filter(stg_results(t), cid)
    return res.join(stg_races(t).select("race_id", "season"), "race_id", "inner")


def _named(agg: DataFrame, t) -> DataFrame:
    """Driver names joined to an aggregate by driver, not to the fact."""
    return agg.join(stg_drivers(t).select("driver_id", "driver_name"), "driver_id", "inner")


def mart_driver_summary(t, cid=None) -> DataFrame:
    """D3: career line per team and driver, FILTER-style aggregates."""
    fin = ~F.col("is_dnf")
    agg = (_fact(t, cid).groupBy(TEAM, "driver_id")
           .agg(F.count_distinct("season").alias("seasons"),
                F.count(F.lit(1)).alias("races"),
                F.sum("points").alias("points"),
                F.count_if(F.col("position") == 1).alias("wins"),
                F.count_if(F.col("position") <= 3).alias("podiums"),
                round_half_up(F.avg(F.when(fin, F.col("position_order"))), 1).alias("avg_finish"),
                F.count_if(F.col("is_dnf")).alias("dnfs"),
                F.min("season").alias("from_season"),
                F.max("season").alias("to_season")))
    named = _named(agg.join(t.constructors.select(TEAM, F.col("constructor_name").alias("team")), TEAM, "inner"), t)
    return (named.select(TEAM, "driver_id", "driver_name", "team", "seasons", "races", "points", "wins", "podiums",
                         "avg_finish", "dnfs", "from_season", "to_season")
            .orderBy(TEAM, F.col("points").desc(), "driver_id"))


def mart_pit_stop_efficiency(t, cid=None) -> DataFrame:
    """Pit timing per season and driver including the sample sigma."""
    return Q.pit_stop_efficiency(t, cid, with_std=True, null_safe_names=False)


def mart_championship_progression(t, cid=None) -> DataFrame:
    """Constructor standings by round with the gain since last round."""
    return Q.championship_progression(t, cid, season_col="season")


def mart_qualifying_vs_race(t, cid=None) -> DataFrame:
    """Grid against finish per driver and season (classified rows for
    the race averages, every row for the qualifying average)."""
    q = stg_qualifying(t).select("race_id", "driver_id", F.col("position").alias("qual_position"))
    df = _fact(t, cid).join(q, ["race_id", "driver_id"], "left")
    fin = ~F.col("is_dnf")
    gained = F.col("grid").cast("int") - F.col("position_order")
    agg = (df.groupBy(TEAM, "driver_id", "season")
           .agg(F.count(F.lit(1)).alias("races_started"),
                F.count("qual_position").alias("races_with_qualifying"),
                round_half_up(F.avg("qual_position"), 2).alias("avg_qual_position"),
                round_half_up(F.avg(F.when(fin, F.col("position_order"))), 2).alias("avg_race_position"),
                round_half_up(F.avg(F.when(fin, gained)), 2).alias("avg_positions_gained"),
                F.count_if((F.col("position_order") < F.col("grid")) & fin).alias("races_gained_positions")))
    return (_named(agg, t).select(TEAM, "driver_id", "driver_name", *agg.columns[2:])
            .orderBy(TEAM, F.col("season").desc(), F.col("avg_race_position").asc_nulls_last(), "driver_id"))
