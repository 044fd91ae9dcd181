"""Statistical models (M1–M8) as aggregate plans.

Per-group statistics are built-in aggregates (``avg``, ``stddev_samp``,
``regr_slope`` / ``regr_r2`` ...), so the per-group loops of a pandas
version become one partial + final HashAggregate. Only distribution
functions (t, chi-square) run in Python, as pandas UDFs over the
aggregated rows; chi-square quantiles are evaluated once per *distinct*
count and joined back.

Every model is per team: ``refs`` (team refs) or ``cid`` narrows the teams,
None keeps all of them with ``constructor_id`` as a key. Groups are by id;
names are labels (two drivers sharing a name stay apart).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.functions.columns import finished, full_name, round_even, round_half_up
from stintlake.functions.stats import chi2_ppf_udf, t_sf2_udf, t_test_udf
from stintlake.operators.joins import pairs, team_by_refs, team_filter, with_driver_name
from stintlake.session import cut_lineage

TEAM = "constructor_id"

# Fixed model parameters of the source analysis.
PIT_STOP_MIN_MS = 15000
PIT_STOP_MAX_MS = 60000
DRY_COMPOUNDS = ["SOFT", "MEDIUM", "HARD"]
GREEN_FLAG = "1"


def _team_results(t, refs=None, cid=None) -> DataFrame:
    return team_filter(team_by_refs(t.results, t.constructors, refs), cid)


def _team_laps(t, refs=None, cid=None) -> DataFrame:
    res = _team_results(t, refs, cid).select("race_id", "driver_id", TEAM, "position_order")
    return t.laps.join(res, ["race_id", "driver_id"], "inner")


# --- M1 -------------------------------------------------------------------

def teammate_delta(t, refs=None, cid=None, min_shared_races: int = 5,
                   inference: bool = True) -> DataFrame:
    """Finishing-position difference of teammates in shared classified races.

    ``delta = position_order(a) - position_order(b)`` for a < b (by id) in
    the same race and team; per pair: n >= ``min_shared_races``, mean, and
    (``inference``) a one-sample t-test against 0 with a 95 % t interval.
    Negative mean: driver a finishes ahead.
    """
    res = _team_results(t, refs, cid).filter(finished()) \
        .select("race_id", TEAM, "driver_id", "position_order")
    pr = pairs(res, ["race_id", TEAM], "driver_id", "position_order")
    delta = F.col("position_order_a").cast("int") - F.col("position_order_b").cast("int")
    agg = (pr.groupBy(TEAM, "driver_id_a", "driver_id_b")
           .agg(F.count(F.lit(1)).alias("n"),
                F.avg(delta).alias("mean"),
                F.stddev_samp(delta).alias("sd"))
           .filter(F.col("n") >= min_shared_races))
    names = t.drivers.select("driver_id", full_name().alias("nm"))
    agg = (agg.join(names.withColumnRenamed("driver_id", "driver_id_a").withColumnRenamed("nm", "driver_a"),
                    "driver_id_a", "inner")
              .join(names.withColumnRenamed("driver_id", "driver_id_b").withColumnRenamed("nm", "driver_b"),
                    "driver_id_b", "inner"))
    cols = [TEAM, "driver_id_a", "driver_a", "driver_id_b", "driver_b",
            round_even("mean", 3).alias("mean_delta")]
    if not inference:
        cols += [round_half_up("sd", 6).alias("sd_delta"), "n"]
        return agg.select(*cols).orderBy(TEAM, "mean_delta", "driver_id_a", "driver_id_b")
    test = t_test_udf(F.col("mean"), F.col("sd"), F.col("n").cast("double"))
    out = agg.select("*", test.alias("t"))
    lo = F.col("mean") - F.col("t.half_width")
    hi = F.col("mean") + F.col("t.half_width")
    return (out.select(*cols, round_even(lo, 3).alias("ci_lower"), round_even(hi, 3).alias("ci_upper"),
                       "n", round_even("t.p_value", 6).alias("p_value"))
            .orderBy(TEAM, "mean_delta", "driver_id_a", "driver_id_b"))


# --- M2 -------------------------------------------------------------------

def grid_finish_points(t, refs=None, cid=None) -> DataFrame:
    """Classified results with a real grid slot: (team, driver, year, grid, finish)."""
    res = _team_results(t, refs, cid).filter((F.col("grid") > 0) & finished())
    df = res.join(t.races.select("race_id", "year"), "race_id", "inner")
    df = with_driver_name(df, t.drivers, "driver")
    return df.select(TEAM, "driver_id", "driver", "year", "race_id",
                     F.col("grid").cast("int").alias("grid"),
                     F.col("position_order").cast("int").alias("finish"))


def grid_finish_ols(t, refs=None, cid=None, inference: bool = True, p_digits: int | None = None) -> DataFrame:
    """OLS finish ~ grid per team: slope, intercept, r², n (and the
    two-sided p of the slope, rounded where ``p_digits`` says so). Fewer than
    two points: nulls and n = 0."""
    pts = grid_finish_points(t, refs, cid)
    agg = pts.groupBy(TEAM).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.regr_slope("finish", "grid").alias("slope"),
        F.regr_intercept("finish", "grid").alias("intercept"),
        F.regr_r2("finish", "grid").alias("r2"))
    enough = F.col("cnt") >= 2
    out = agg.select(
        TEAM,
        F.when(enough, round_half_up("slope", 6)).alias("slope"),
        F.when(enough, round_half_up("intercept", 6)).alias("intercept"),
        F.when(enough, round_half_up("r2", 6)).alias("r2"),
        F.when(enough, F.col("cnt")).otherwise(F.lit(0).cast("bigint")).alias("n"),
        F.col("r2").alias("_r2"), F.col("cnt").alias("_n"), F.col("slope").alias("_s"))
    if inference:
        r2 = F.col("_r2")
        dfree = (F.col("_n") - 2).cast("double")
        tstat = F.sqrt(r2) * F.signum(F.col("_s")) * F.sqrt(F.try_divide(dfree, F.lit(1.0) - r2))
        p = F.when(F.col("_n") <= 2, F.lit(None).cast("double")) \
            .when(r2 >= 1.0, F.lit(0.0)).otherwise(t_sf2_udf(tstat, dfree))
        p = F.when(F.col("_n") >= 2, p)
        out = out.withColumn("p_value", p if p_digits is None else round_half_up(p, p_digits))
    return out.drop("_r2", "_n", "_s").orderBy(TEAM)


# --- M3 -------------------------------------------------------------------

def pit_stop_z(t, refs=None, cid=None) -> DataFrame:
    """Each stop of the selected teams as a z-score against its season's
    field (all stops within [15 s, 60 s]; population sigma)."""
    stops = t.pit_stops.filter(F.col("milliseconds").between(PIT_STOP_MIN_MS, PIT_STOP_MAX_MS)) \
        .join(t.races.select("race_id", "year", "race_name"), "race_id", "inner")
    season = stops.groupBy("year").agg(F.avg("milliseconds").alias("mu"),
                                        F.stddev_pop("milliseconds").alias("sigma"))
    res = _team_results(t, refs, cid).select("race_id", "driver_id", TEAM)
    z = (F.col("milliseconds") - F.col("mu")) / F.nullif(F.col("sigma"), F.lit(0.0))
    out = (stops.join(res, ["race_id", "driver_id"], "inner")
           .join(season, "year", "inner")
           .select(TEAM, "race_id", "year", "race_name", "driver_id", "stop", "milliseconds", z.alias("z"))
           .filter(F.col("z").isNotNull()))
    return with_driver_name(out, t.drivers, "driver")


def pit_z(t, refs=None, cid=None, min_stops: int = 5) -> DataFrame:
    """M3: per driver mean z, sample sd of z and stop count (n >= min)."""
    z = pit_stop_z(t, refs, cid)
    agg = (z.groupBy(TEAM, "driver_id", "driver")
           .agg(F.avg("z").alias("mean_z"), F.stddev_samp("z").alias("std_z"),
                F.count(F.lit(1)).alias("n_stops"))
           .filter(F.col("n_stops") >= min_stops))
    return agg.select(TEAM, "driver_id", "driver", round_half_up("mean_z", 6).alias("mean_z"),
                      round_half_up("std_z", 6).alias("std_z"), "n_stops") \
        .orderBy(TEAM, "mean_z", "driver_id")


# --- M4 -------------------------------------------------------------------

def trajectory(t, refs=None, cid=None) -> DataFrame:
    """M4: standings points and position per round, only for rounds the
    driver raced for the team."""
    res = _team_results(t, refs, cid).select("race_id", "driver_id", TEAM)
    ds = t.driver_standings.join(res, ["race_id", "driver_id"], "inner") \
        .join(t.races.select("race_id", "year", "round"), "race_id", "inner")
    ds = with_driver_name(ds, t.drivers, "driver")
    return ds.select(TEAM, "driver_id", "year", "round", "driver", "points", "position") \
        .orderBy(TEAM, "driver_id", "year", "round")


# --- M5 -------------------------------------------------------------------

def dnf_counts(t, refs=None, cid=None, min_races: int = 10) -> DataFrame:
    res = _team_results(t, refs, cid)
    agg = (res.groupBy(TEAM, "driver_id")
           .agg(F.count(F.lit(1)).alias("races"),
                F.sum(F.when(F.col("position_order") == 999, 1).otherwise(0)).cast("bigint").alias("dnfs"))
           .filter(F.col("races") >= min_races))
    return with_driver_name(agg, t.drivers, "driver") \
        .withColumn("rate", F.col("dnfs") / F.col("races"))


def dnf_rate(t, refs=None, cid=None, min_races: int = 10, with_ci: bool = True) -> DataFrame:
    """M5: retirement rate k/n per driver with the exact Poisson 95 %
    interval ``[chi2(.025; 2k) / 2n, chi2(.975; 2k + 2) / 2n]`` (lower 0
    when k = 0)."""
    agg = dnf_counts(t, refs, cid, min_races)
    cols = [TEAM, "driver_id", "driver", "races", "dnfs", round_half_up("rate", 6).alias("rate")]
    if not with_ci:
        return agg.select(*cols).orderBy(TEAM, F.col("rate").desc(), "driver_id")
    ks = agg.select("dnfs").distinct()
    q = ks.select("dnfs",
                  F.when(F.col("dnfs") > 0, chi2_ppf_udf(F.lit(0.025), (2 * F.col("dnfs")).cast("double")))
                  .otherwise(F.lit(0.0)).alias("q_lo"),
                  chi2_ppf_udf(F.lit(0.975), (2 * F.col("dnfs") + 2).cast("double")).alias("q_hi"))
    out = agg.join(q, "dnfs", "inner")
    return out.select(*cols,
                      round_half_up(F.col("q_lo") / (2 * F.col("races")), 6).alias("ci_lower"),
                      round_half_up(F.col("q_hi") / (2 * F.col("races")), 6).alias("ci_upper")) \
        .orderBy(TEAM, F.col("rate").desc(), "driver_id")


# --- M6 -------------------------------------------------------------------

def tyre_degradation(t, refs=None, cid=None, min_laps: int = 5) -> DataFrame:
    """M6: seconds lost per extra lap of tyre age, per driver and dry
    compound, on green-flag laps with tyre_life > 1 (OLS lap_time ~ tyre_life)."""
    laps = _team_laps(t, refs, cid).filter(
        F.col("compound").isin(DRY_COMPOUNDS) & F.col("lap_time_s").isNotNull()
        & (F.col("tyre_life") > 1) & (F.col("track_status") == GREEN_FLAG))
    agg = (laps.groupBy(TEAM, "driver_id", "compound")
           .agg(F.regr_slope("lap_time_s", "tyre_life").alias("slope"),
                F.regr_r2("lap_time_s", "tyre_life").alias("r2"),
                F.regr_count("lap_time_s", "tyre_life").alias("n"))
           .filter((F.col("n") >= min_laps) & F.col("slope").isNotNull()))
    agg = with_driver_name(agg, t.drivers, "driver")
    return agg.select(TEAM, "driver_id", "driver", "compound",
                      round_even("slope", 4).alias("deg_rate_s"),
                      round_even("r2", 3).alias("r2"), "n") \
        .orderBy(TEAM, "compound", "deg_rate_s", "driver_id")


# --- M7 -------------------------------------------------------------------

def _latest_races(t, res: DataFrame, seasons: list[int]) -> tuple[DataFrame, list[int]]:
    """Each team's latest race (by season and round) with laps of the team's
    drivers, and the seasons that were read for it: the last one, and one more
    before it as long as a team has none yet."""
    teams = cut_lineage(res.select(TEAM).distinct().filter(F.col(TEAM).isNotNull()), "teams")
    found, read = teams.withColumn("race_id", F.lit(None).cast("bigint")).limit(0), []
    for year in sorted(seasons, reverse=True):
        season = F.col("year") == year
        keys = t.yearly("laps").filter(season).select("race_id", "driver_id").distinct()
        raced = (res.filter(season).join(teams.join(found, TEAM, "left_anti"), TEAM, "left_semi")
                 .join(keys, ["race_id", "driver_id"], "left_semi")
                 .join(t.races.filter(season).select("race_id", "round"), "race_id", "inner"))
        # one row per team: stored, so that the planner sees its real (tiny) size and broadcasts it
        found = cut_lineage(found.unionByName(raced.groupBy(TEAM).agg(F.max_by("race_id", "round").alias("race_id"))), "latest_race")
        read.append(year)
        if teams.join(found, TEAM, "left_anti").isEmpty():
            break
    return found, read


def stints(t, refs=None, cid=None, year: int | None = None) -> DataFrame:
    """M7: stint structure of each team's latest race with lap data
    (latest by season and round; ``year`` restricts to one season).

    Plan: distinct (race, driver) keys of the laps (partially aggregated
    before the shuffle) find each team's latest race, season by season from the
    last, until every team has one; that per-team table is broadcast to pick
    the laps of those races. So laps are read of these seasons only, first
    their keys and then the picked races' rows, and not shuffled whole.
    """
    res = team_filter(team_by_refs(t.yearly("results"), t.constructors, refs), cid).select("race_id", "driver_id", TEAM, "position_order", "year")
    races = t.races.select("race_id", "year", "round", "race_name")
    known = races.filter(F.col("year").isNotNull() if year is None else F.col("year") == year).select("year").distinct()
    latest, seasons = _latest_races(t, res, [r["year"] for r in known.collect()])
    read = F.col("year").isin(seasons)
    entries = res.filter(read).drop("year").join(latest, [TEAM, "race_id"], "inner")
    laps = t.yearly("laps").filter(read).drop("year").join(latest.select("race_id").distinct(), "race_id", "left_semi") \
        .join(entries, ["race_id", "driver_id"], "inner") \
        .filter(F.col("compound").isNotNull() & ~F.col("compound").isin("UNKNOWN", ""))
    sel = with_driver_name(laps.join(races, "race_id", "inner"), t.drivers, "driver")
    return (sel.groupBy(TEAM, "race_id", "race_name", "year", "driver_id", "driver", "stint",
                        F.upper("compound").alias("compound"), "position_order")
            .agg(F.min("lap_number").alias("start_lap"), F.max("lap_number").alias("end_lap"),
                 F.count(F.lit(1)).alias("stint_laps"))
            .select(TEAM, "race_id", "race_name", "year", "driver_id", "driver", "stint", "compound",
                    "start_lap", "end_lap", "stint_laps",
                    F.coalesce(F.col("position_order"), F.lit(99)).alias("finish_pos"))
            .orderBy(TEAM, "finish_pos", "stint", "driver_id", "compound"))


# --- M8 -------------------------------------------------------------------

def sector_means(t, refs=None, cid=None, min_laps: int = 10, digits: int = 6,
                 require_lap_time: bool = True) -> DataFrame:
    """M8: mean sector times on green-flag laps with all three sectors
    (and a lap time), drivers with at least ``min_laps`` such laps."""
    cond = ((F.col("track_status") == GREEN_FLAG) & F.col("sector1_s").isNotNull()
            & F.col("sector2_s").isNotNull() & F.col("sector3_s").isNotNull())
    if require_lap_time:
        cond = cond & F.col("lap_time_s").isNotNull()
    # a driver's laps of a race are added up before they meet the results: a row crosses the network instead of each lap
    sectors = {"s1": "sector1_s", "s2": "sector2_s", "s3": "sector3_s"}
    sums = t.laps.filter(cond).groupBy("race_id", "driver_id").agg(
        *[F.sum(c).alias(k) for k, c in sectors.items()], F.count(F.lit(1)).alias("n"))
    res = _team_results(t, refs, cid).select("race_id", "driver_id", TEAM)
    n = F.sum("n")
    agg = (sums.join(res, ["race_id", "driver_id"], "inner").groupBy(TEAM, "driver_id")
           .agg(*[(F.sum(k) / n).alias(k) for k in sectors], n.alias("n"))
           .filter(F.col("n") >= min_laps))
    agg = with_driver_name(agg, t.drivers, "driver")
    out = agg.select(TEAM, "driver_id", "driver",
                     round_half_up("s1", digits).alias("s1_mean"),
                     round_half_up("s2", digits).alias("s2_mean"),
                     round_half_up("s3", digits).alias("s3_mean"), "n")
    return out.orderBy(TEAM, F.col("s1_mean") + F.col("s2_mean") + F.col("s3_mean"), "driver_id")
