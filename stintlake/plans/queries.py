"""The named analytical queries (catalog N1–N15), as DataFrame plans.

Each takes the star tables and a team selector. ``cid`` (an id, a list of
ids, or None for every team) or ``refs`` (team refs, None for all). With
every team selected the team becomes a grouping key, so one pass answers
the question for all teams; a single team is a filter pushed to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.functions.columns import (avg_finish, count_where, finished, is_dnf, pct,
                                         period_label, round_half_up)
from stintlake.operators.joins import star, team_by_refs, team_filter, with_driver_name
from stintlake.operators.windows import scan_levels, share_of_total, top_k, with_lag_delta
from stintlake.session import cut_lineage

TEAM = "constructor_id"

# Rounds per block when a team's standings of a season are split across tasks.
PROGRESSION_BLOCK = 64


def _pos(c: str = "position"):
    return F.col(c)


def _win():
    return count_where(_pos() == 1)


def _podium():
    return count_where(_pos() <= 3)


def _after(df: DataFrame, key: str, *cols: str) -> DataFrame:
    """The columns in order, with ``cols`` right after ``key``."""
    rest = [c for c in df.columns if c not in cols]
    at = rest.index(key) + 1
    return df.select(*rest[:at], *cols, *rest[at:])


def _named(agg: DataFrame, t, null_safe: bool = True) -> DataFrame:
    """Driver names joined to an aggregate by driver, not to the fact."""
    return _after(with_driver_name(agg, t.drivers, null_safe=null_safe), "driver_id", "driver_name")


def driver_summary(t, refs=None, sep: str = ",", with_seasons: bool = True,
                   team_alias: dict | None = None) -> DataFrame:
    """Career line per driver over the selected teams.

    ``team_alias`` maps long team names to a display name; the team list is
    then de-duplicated after mapping (two names of one team shown once)."""
    res = team_by_refs(t.results, t.constructors, refs)
    df = star(res, t.races, race_cols=("year",)).join(t.constructors.select(TEAM), TEAM, "left_semi")
    name = F.col("constructor_name")
    if team_alias:
        amap = F.create_map(*[F.lit(x) for kv in team_alias.items() for x in kv])
        name = F.coalesce(amap[name], name)
    aggs = [F.collect_set(TEAM).alias("team_ids")]  # a driver's teams
    if with_seasons:
        aggs.append(F.count_distinct("year").alias("seasons"))
    aggs += [
        F.count(F.lit(1)).alias("races"),
        F.sum("points").alias("points"),
        _win().alias("wins"),
        _podium().alias("podiums"),
        avg_finish(digits=1).alias("avg_finish"),
        count_where(is_dnf()).alias("dnfs"),
        F.min("year").alias("from_yr"),
        F.max("year").alias("to_yr"),
    ]
    lines = df.groupBy("driver_id").agg(*aggs)
    teams = (lines.select("driver_id", F.explode("team_ids").alias(TEAM))
             .join(t.constructors.select(TEAM, "constructor_name"), TEAM, "inner").groupBy("driver_id")
             .agg(F.array_join(F.array_sort(F.array_distinct(F.collect_set(name))), sep).alias("team")))
    out = with_driver_name(lines.drop("team_ids").join(teams, "driver_id", "inner"), t.drivers, "driver")
    return _after(out, "driver_id", "driver", "team").orderBy(F.col("points").desc(), "driver_id")


def team_performance_overview(t, cid=None) -> DataFrame:
    """Season totals per team."""
    df = star(team_filter(t.results, cid), t.races, race_cols=("year",))
    return (df.groupBy(TEAM, F.col("year").alias("season"))
            .agg(F.sum("points").alias("total_points"),
                 _win().alias("wins"),
                 _podium().alias("podiums"),
                 F.count(F.lit(1)).alias("total_races"),
                 avg_finish(digits=2).alias("avg_finish_position"),
                 pct(_pos() == 1).alias("win_percentage"))
            .orderBy(TEAM, F.col("season").desc()))


def driver_performance_comparison(t, cid=None) -> DataFrame:
    """Season × driver line per team."""
    df = star(team_filter(t.results, cid), t.races, race_cols=("year",))
    agg = (df.groupBy(TEAM, F.col("year").alias("season"), "driver_id")
           .agg(F.count(F.lit(1)).alias("races"),
                F.sum("points").alias("total_points"),
                _win().alias("wins"),
                _podium().alias("podiums"),
                count_where(_pos() <= 10).alias("points_finishes"),
                avg_finish(digits=2).alias("avg_finish"),
                count_where(is_dnf()).alias("dnfs")))
    return (_named(agg, t)
            .orderBy(TEAM, F.col("season").desc(), F.col("total_points").desc(), "driver_id"))


def qualifying_vs_race_performance(t, cid=None) -> DataFrame:
    """Qualifying against race finish per driver and year."""
    res = team_filter(t.results, cid)
    q = t.qualifying.select("race_id", "driver_id", F.col("position").alias("qual_position"))
    df = star(res, t.races, race_cols=("year",)).join(q, ["race_id", "driver_id"], "left")
    fin = finished()
    gained = F.col("grid").cast("int") - F.col("position_order").cast("int")
    agg = (df.groupBy(TEAM, "driver_id", "year")
           .agg(F.count(F.lit(1)).alias("races_started"),
                F.count("qual_position").alias("races_with_qualifying"),
                round_half_up(F.avg("qual_position"), 2).alias("avg_qual_position"),
                avg_finish(digits=2).alias("avg_race_position"),
                round_half_up(F.avg(F.when(fin, gained)), 2).alias("avg_positions_gained"),
                count_where((F.col("position_order") < F.col("grid")) & fin).alias("races_gained_positions")))
    return (_named(agg, t)
            .orderBy(TEAM, F.col("year").desc(), F.col("avg_race_position").asc_nulls_last(), "driver_id"))


def circuit_performance_analysis(t, cid=None, min_rows: int = 3, k: int = 15) -> DataFrame:
    """Circuits with at least ``min_rows`` results, best ``k`` per team
    by points per race (ties by circuit id)."""
    df = star(team_filter(t.results, cid), t.races, circuits=t.circuits, race_cols=())
    agg = (df.groupBy(TEAM, "circuit_id", "circuit_name", "country")
           .agg(F.count(F.lit(1)).alias("races_held"),
                _win().alias("wins"),
                _podium().alias("podiums"),
                avg_finish(digits=2).alias("avg_finish"),
                F.sum("points").alias("total_points"),
                round_half_up(F.avg("points"), 2).alias("avg_points_per_race"),
                pct(_pos() == 1).alias("win_rate"))
           .filter(F.col("races_held") >= min_rows))
    best = top_k(agg, TEAM, [F.col("avg_points_per_race").desc(), F.col("circuit_id")], k)
    return best.orderBy(TEAM, F.col("avg_points_per_race").desc(), "circuit_id")


def _team_stops(t, cid):
    res = team_filter(t.results, cid).select("race_id", "driver_id", TEAM)
    return t.pit_stops.join(res, ["race_id", "driver_id"], "inner")


def pit_stop_efficiency(t, cid=None, with_std: bool = False, null_safe_names: bool = True) -> DataFrame:
    """N6 (and mart D4 with ``with_std``): stop timing per season and driver."""
    df = star(_team_stops(t, cid), t.races, race_cols=("year",))
    aggs = [F.count(F.lit(1)).alias("total_stops"),
            F.min("milliseconds").alias("fastest_stop_ms"),
            round_half_up(F.avg("milliseconds"), 0).alias("avg_stop_ms"),
            F.max("milliseconds").alias("slowest_stop_ms")]
    if with_std:
        aggs.append(round_half_up(F.stddev_samp("milliseconds"), 0).alias("stddev_stop_ms"))
    return (_named(df.groupBy(TEAM, F.col("year").alias("season"), "driver_id").agg(*aggs), t, null_safe_names)
            .orderBy(TEAM, F.col("season").desc(), "avg_stop_ms", "driver_id"))


def fastest_pit_stops(t, cid=None, k: int = 10) -> DataFrame:
    """The ``k`` quickest stops per team (ties by race, driver, stop).
    Races and names are joined to those only, which are stored first: the
    planner then knows how few they are, and doesn't shuffle the races."""
    stops = _team_stops(t, cid).select(TEAM, "race_id", "driver_id", F.col("stop").alias("stop_number"),
                                       "lap", "duration", "milliseconds")
    best = cut_lineage(top_k(stops, TEAM, [F.col("milliseconds").asc_nulls_last(), F.col("race_id"),
                                           F.col("driver_id"), F.col("stop_number")], k), "fastest")
    best = _named(best.join(t.races.select("race_id", "year", "race_name"), "race_id", "inner"), t)
    return best.select(TEAM, "race_id", "year", "race_name", "driver_id", "driver_name",
                       "stop_number", "lap", "duration", "milliseconds").orderBy(TEAM, "milliseconds", "race_id", "driver_id", "stop_number")


def championship_progression(t, cid=None, fallback: bool = True, season_col: str = "year") -> DataFrame:
    """Team standings by round with the change since the previous
    round of the same season (the first round falls back to its own total
    unless ``fallback`` is False)."""
    cs = team_filter(t.constructor_standings, cid)
    df = cs.join(t.races.select("race_id", "year", "round", "race_name"), "race_id", "inner").select(
        TEAM, "race_id", F.col("year").alias(season_col), "round", "race_name",
        F.col("position").alias("championship_position"),
        F.col("points").alias("points_accumulated"),
        F.col("wins").alias("wins_accumulated"))
    out = with_lag_delta(df, [TEAM, season_col], "round", "points_accumulated",
                         prev="prev_points", delta="points_gained", fallback=fallback,
                         block=PROGRESSION_BLOCK, levels=scan_levels(t.last_round + 1, PROGRESSION_BLOCK))
    return out.orderBy(TEAM, F.col(season_col).desc(), "round")


def driver_championship_battle(t, cid=None) -> DataFrame:
    """Driver standings rows of the team's drivers, race by race."""
    res = team_filter(t.results, cid).select("race_id", "driver_id", TEAM)
    ds = t.driver_standings.join(res, ["race_id", "driver_id"], "inner")
    df = star(ds, t.races.select("race_id", "year", "round", "race_name"), t.drivers,
              race_cols=("year", "round", "race_name"))
    return (df.select(TEAM, "race_id", "year", "round", "race_name", "driver_id", "driver_name",
                      F.col("position").alias("championship_position"),
                      F.col("points").alias("points_accumulated"),
                      F.col("wins").alias("wins_accumulated"))
            .orderBy(TEAM, F.col("year").desc(), "round", "championship_position"))


def fastest_laps_analysis(t, cid=None) -> DataFrame:
    """Fastest-lap awards per season and driver (drivers with one or more)."""
    df = star(team_filter(t.results, cid), t.races, race_cols=("year",))
    fl = F.col("fastest_lap_rank") == 1
    agg = (df.groupBy(TEAM, F.col("year").alias("season"), "driver_id")
           .agg(count_where(fl).alias("fastest_laps"),
                F.count(F.lit(1)).alias("total_races"),
                pct(fl).alias("fastest_lap_percentage"))
           .filter(F.col("fastest_laps") > 0))
    return (_named(agg, t)
            .orderBy(TEAM, F.col("season").desc(), F.col("fastest_laps").desc(), "driver_id"))


def reliability_analysis(t, cid=None) -> DataFrame:
    """Retirements and finishes per season."""
    df = star(team_filter(t.results, cid), t.races, race_cols=("year",))
    return (df.groupBy(TEAM, F.col("year").alias("season"))
            .agg(F.count(F.lit(1)).alias("total_races"),
                 count_where(is_dnf()).alias("dnfs"),
                 pct(is_dnf()).alias("dnf_percentage"),
                 count_where(finished()).alias("finishes"),
                 pct(finished()).alias("finish_rate"))
            .orderBy(TEAM, F.col("season").desc()))


def failure_modes(t, cid=None, k: int = 10) -> DataFrame:
    """Result status counts and share of the team total, top ``k``."""
    agg = (team_filter(t.results, cid).groupBy(TEAM, "status")
           .agg(F.count(F.lit(1)).alias("occurrences")))
    agg = share_of_total(agg, "occurrences", part=TEAM, out="percentage")
    best = top_k(agg, TEAM, [F.col("occurrences").desc(), F.col("status")], k)
    return best.orderBy(TEAM, F.col("occurrences").desc(), "status")


def race_start_analysis(t, cid=None) -> DataFrame:
    """Outcome by starting slot (grid > 0, classified position known)."""
    df = team_filter(t.results, cid).filter((F.col("grid") > 0) & F.col("position").isNotNull())
    gained = F.col("grid").cast("int") - F.col("position_order").cast("int")
    return (df.groupBy(TEAM, F.col("grid").alias("starting_position"))
            .agg(F.count(F.lit(1)).alias("races_started"),
                 avg_finish(digits=2).alias("avg_finish_position"),
                 _win().alias("wins"),
                 _podium().alias("podiums"),
                 round_half_up(F.avg(F.when(finished(), gained)), 2).alias("avg_positions_gained"))
            .orderBy(TEAM, "starting_position"))


# Fixed metric labels of the KPI list, in catalog order.
KPI_METRICS = ["Total Races", "Total Wins", "Total Podiums", "Total Points",
               "Average Finish Position", "Win Rate %", "DNF Rate %"]


def key_performance_indicators(t, cid=None) -> DataFrame:
    """Seven (metric, value) rows per team from ONE scan (aggregate
    once, then unpivot) instead of seven separate scans."""
    res = team_filter(t.results, cid)
    one = res.groupBy(TEAM).agg(
        F.count(F.lit(1)).cast("double").alias("m0"),
        _win().cast("double").alias("m1"),
        _podium().cast("double").alias("m2"),
        F.sum("points").cast("double").alias("m3"),
        avg_finish(digits=2).alias("m4"),
        pct(_pos() == 1).alias("m5"),
        pct(is_dnf()).alias("m6"))
    pairs = ", ".join(f"'{name}', m{i}" for i, name in enumerate(KPI_METRICS))
    return one.select(TEAM, F.expr(f"stack({len(KPI_METRICS)}, {pairs}) AS (metric, value)"))


# Display names of the team's long names in the summary.
TEAM_ALIASES = {"Oracle Red Bull Racing": "Red Bull", "Red Bull Racing": "Red Bull"}


def driver_summary_pipeline(t, refs=None, team_alias: dict | None = None) -> DataFrame:
    """The pipeline's summary table: no seasons column, a period label
    ``2020–25``, whole points, team list (aliases applied, each name once)
    joined with ' · '."""
    base = driver_summary(t, refs, sep=" · ", with_seasons=False,
                          team_alias=TEAM_ALIASES if team_alias is None else team_alias)
    return base.select(
        "driver_id", "driver", "team",
        period_label("from_yr", "to_yr").alias("period"),
        "races", F.floor("points").cast("bigint").alias("points"),
        "wins", "podiums", "avg_finish", "dnfs"
    ).orderBy(F.col("points").desc(), "driver_id")
