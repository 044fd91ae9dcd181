"""Derived series and KPI datasets behind the dashboard charts.

Only the data is built here (the drawing is out of scope). Every series is
per team: ``cid`` selects teams, None keeps all with ``constructor_id`` as
a key. Windows over a team's whole season (K5) are nested scans over round
blocks (see ``operators.windows``) so a long season of one team is not one
task, and drivers are ranked within a team by ranges (``operators.ranges``);
windows over one driver's season stay plain (bounded by its rounds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stintlake.functions.columns import (clip, position_label, round_half_up, round_label,
                                         significance_label, sign_bucket, surname_of)
from stintlake.operators.joins import team_filter, with_driver_name
from stintlake.operators.ranges import numbered
from stintlake.operators.windows import delta_from_best, ffill, running_sum, scan_levels, segments
from stintlake.plans import models as M
from stintlake.session import cut_lineage

TEAM = "constructor_id"
ROUND_BLOCK = 64  # rounds per block for team-season windows


def round_by_round(t, cid=None, latest_only: bool = False) -> DataFrame:
    """K1: cumulative points (from results, not standings) and finishing
    order per team, driver, season and round. ``latest_only`` keeps each
    team's latest season, filtered *before* the running sums."""
    cols = ["race_id", "driver_id", TEAM, "points", "position_order"]
    if latest_only:
        res, races = _latest_season(team_filter(t.yearly("results"), cid), t.races)
        res = res.select(*cols)
    else:
        res, races = team_filter(t.results, cid).select(*cols), t.races
    df = res.join(races.select("race_id", "year", "round"), "race_id", "inner") \
        .withColumn("pts", F.coalesce(F.col("points"), F.lit(0.0)))
    # a driver's season is bounded by its rounds: a plain window suffices
    df = running_sum(df, [TEAM, "driver_id", "year"], "round", {"cum_points": "pts"})
    df = with_driver_name(df, t.drivers, "driver")
    return df.select(TEAM, "driver_id", "driver", "year", "round",
                     F.col("cum_points").alias("points"),
                     F.col("position_order").cast("int").alias("position"))


def grid_finish(t, cid=None) -> DataFrame:
    """K2: (grid, finish) of classified results with a grid slot, places
    gained and its gain / loss / same bucket."""
    g = M.grid_finish_points(t, cid=cid)
    gained = F.col("grid") - F.col("finish")
    return g.select("*", gained.alias("gained"), sign_bucket(gained).alias("bucket"))


def _latest_season(facts: DataFrame, races: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of each team's latest season, and the races of those seasons.

    The seasons come from (team, year) alone, of which the year is no column
    of the files. As a scalar list they then filter the partition column, so
    that files of other seasons aren't opened."""
    last = facts.filter(F.col("year").isNotNull()).groupBy(TEAM).agg(F.max("year").alias("year"))
    wanted = F.array_contains(last.agg(F.collect_set("year")).scalar(), F.col("year"))
    return facts.filter(wanted).join(last, [TEAM, "year"], "left_semi"), races.filter(wanted)


def season_trajectory(t, cid=None) -> DataFrame:
    """K3: latest season per team: cumulative points by round, win marker,
    and the final value of each driver."""
    k1 = round_by_round(t, cid, latest_only=True)
    last = k1.groupBy(TEAM, "driver_id").agg(F.max("round").alias("round")).withColumn("is_final", F.lit(True))
    return (k1.join(last, [TEAM, "driver_id", "round"], "left")
            .select(TEAM, "driver_id", "driver", "year", "round", "points", "position",
                    (F.col("position") == 1).alias("is_win"),
                    F.coalesce(F.col("is_final"), F.lit(False)).alias("is_final")))


def finish_positions(t, cid=None) -> DataFrame:
    """K4: classified finishing positions of the latest season (bump chart)."""
    k1 = round_by_round(t, cid, latest_only=True)
    return k1.filter(F.col("position") < 999).select(TEAM, "driver_id", "driver", "year", "round", "position")


def points_gap(t, cid=None) -> DataFrame:
    """K5: latest season, the two drivers with the most points (season
    maximum, ties by id): points per round carried forward, gap a − b,
    lead-change segment id, leader and margin (null until both scored).
    The latest-season rows feed six branches, so they are stored once."""
    k1 = cut_lineage(round_by_round(t, cid, latest_only=True), "k1_latest")
    best = k1.groupBy(TEAM, "driver_id", "driver").agg(F.max("points").alias("season_max"))
    # a filter on the row number is a group limit: two rows of a team and task meet
    w = Window.partitionBy(TEAM).orderBy(F.col("season_max").desc(), F.col("driver_id"))
    top2 = best.withColumn("slot", F.row_number().over(w)).filter(F.col("slot") <= 2)
    both = top2.groupBy(TEAM).agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") == 2)
    top2 = top2.join(both.select(TEAM), TEAM, "left_semi")
    rows = k1.join(top2.select(TEAM, "driver_id", "slot"), [TEAM, "driver_id"], "inner")
    names = top2.groupBy(TEAM).agg(
        F.max(F.when(F.col("slot") == 1, F.col("driver"))).alias("driver_a"),
        F.max(F.when(F.col("slot") == 2, F.col("driver"))).alias("driver_b"))
    wide = rows.groupBy(TEAM, "year", "round").agg(
        F.max(F.when(F.col("slot") == 1, F.col("points"))).alias("points_a"),
        F.max(F.when(F.col("slot") == 2, F.col("points"))).alias("points_b"))
    # a team's season can hold many rounds: both windows are block-split
    deep = scan_levels(t.last_round + 1, ROUND_BLOCK)
    wide = ffill(wide, TEAM, "round", ["points_a", "points_b"], ROUND_BLOCK, deep)
    wide = wide.withColumn("gap", F.col("points_a") - F.col("points_b"))
    seg = segments(wide.filter(F.col("gap").isNotNull()), TEAM, "round", "gap", "segment", ROUND_BLOCK, deep)
    out = wide.join(seg.select(TEAM, "round", "segment"), [TEAM, "round"], "left").join(names, TEAM, "inner")
    leader = F.when(F.col("gap") >= 0, surname_of("driver_a")).when(F.col("gap") < 0, surname_of("driver_b"))
    return out.select(TEAM, "year", "round", "driver_a", "driver_b", "points_a", "points_b", "gap",
                      "segment", leader.alias("leader"), F.abs("gap").alias("margin"))


def position_matrix(t, cid=None) -> DataFrame:
    """K6: long-form driver × (season, round) matrix of classified
    positions, clipped at 20, with labels."""
    k1 = round_by_round(t, cid).filter(F.col("position") < 999)
    return k1.select(TEAM, "driver_id", "driver", "year", "round",
                     clip("position", hi=20).alias("pos_clip"),
                     position_label("position").alias("label"),
                     round_label("year", "round").alias("yr_round"))


def driver_ols_lines(t, cid=None, min_points: int = 3) -> DataFrame:
    """K7: per driver the OLS line finish ~ grid (n >= 3) between the
    smallest and largest grid slot, and mean places gained."""
    pts = grid_finish(t, cid)
    agg = (pts.groupBy(TEAM, "driver_id", "driver")
           .agg(F.count(F.lit(1)).alias("n"),
                F.regr_slope("finish", "grid").alias("slope"),
                F.regr_intercept("finish", "grid").alias("intercept"),
                F.min("grid").alias("grid_min"), F.max("grid").alias("grid_max"),
                F.avg(F.col("grid") - F.col("finish")).alias("gained"))
           .filter((F.col("n") >= min_points) & F.col("slope").isNotNull()))
    return agg.select(TEAM, "driver_id", "driver", "n", "grid_min", "grid_max",
                      round_half_up("slope", 6).alias("slope"),
                      round_half_up("intercept", 6).alias("intercept"),
                      round_half_up(F.col("intercept") + F.col("slope") * F.col("grid_min"), 6).alias("finish_at_min"),
                      round_half_up(F.col("intercept") + F.col("slope") * F.col("grid_max"), 6).alias("finish_at_max"),
                      round_half_up("gained", 6).alias("mean_gained"))


def pit_sem(t, cid=None, min_stops: int = 5) -> DataFrame:
    """K8: pit z per driver with its standard error (0 when undefined) and
    a 0..1 colour scale over the team's drivers."""
    z = M.pit_z(t, cid=cid, min_stops=min_stops)
    span = z.groupBy(TEAM).agg(F.min("mean_z").alias("low"), F.max("mean_z").alias("high"))
    rng = F.greatest(F.col("high") - F.col("low"), F.lit(1e-9))
    return z.join(span, TEAM, "inner").select(TEAM, "driver_id", "driver", "mean_z", "n_stops",
                    round_half_up(F.coalesce(F.col("std_z") / F.sqrt(F.col("n_stops").cast("double")),
                                             F.lit(0.0)), 6).alias("sem"),
                    round_half_up((F.col("mean_z") - F.col("low")) / rng, 6).alias("norm"))


def dnf_ci(t, cid=None, min_races: int = 10) -> DataFrame:
    """K9: retirement rate with the one-sided distances to the interval ends."""
    d = M.dnf_rate(t, cid=cid, min_races=min_races)
    return d.select("*", clip(F.col("ci_upper") - F.col("rate"), lo=0.0).alias("err_upper"),
                    clip(F.col("rate") - F.col("ci_lower"), lo=0.0).alias("err_lower"))


def sector_gap(t, cid=None, min_laps: int = 10) -> DataFrame:
    """Each driver's gap to the team's best mean per sector, and who
    holds the best of each sector."""
    s = M.sector_means(t, cid=cid, min_laps=min_laps)
    g = delta_from_best(s, ["s1_mean", "s2_mean", "s3_mean"], part=TEAM)
    best = s.groupBy(TEAM).agg(
        *[F.min_by("driver", F.struct(c, "driver_id")).alias(f"best_{c[:2]}")
          for c in ("s1_mean", "s2_mean", "s3_mean")])  # per-team rows: small
    return g.join(best, TEAM, "inner").select(
        TEAM, "driver_id", "driver", "n", "s1_mean", "s2_mean", "s3_mean",
        *[round_half_up(f"{c}_gap", 6).alias(f"{c[:2]}_gap") for c in ("s1_mean", "s2_mean", "s3_mean")],
        "best_s1", "best_s2", "best_s3")


def _ranked(drivers: DataFrame, by) -> DataFrame:
    """One row per team and driver with its place (``driver_rank``) in the team."""
    return numbered(drivers, [TEAM], [by, F.col("driver_id")], "driver_rank").withColumn("driver_rank", F.col("driver_rank").cast("int"))


def degradation_pivot(t, cid=None, min_laps: int = 5) -> DataFrame:
    """Degradation rate per driver with one column per dry compound,
    drivers ranked by their mean rate."""
    d = M.tyre_degradation(t, cid=cid, min_laps=min_laps)
    wide = d.groupBy(TEAM, "driver_id", "driver").pivot("compound", M.DRY_COMPOUNDS).agg(F.first("deg_rate_s"))
    mean = d.groupBy(TEAM, "driver_id").agg(F.avg("deg_rate_s").alias("mean_rate"))
    rank = numbered(mean, [TEAM], [F.col("mean_rate"), F.col("driver_id")], "rank").withColumn("rank", F.col("rank").cast("int"))
    out = wide.join(rank, [TEAM, "driver_id"], "inner")
    return out.select(TEAM, "driver_id", "driver", F.col("SOFT").alias("soft"), F.col("MEDIUM").alias("medium"),
                      F.col("HARD").alias("hard"), round_half_up("mean_rate", 6).alias("mean_rate"), "rank")


def stint_bars(t, cid=None) -> DataFrame:
    """Horizontal stint bars (base = start lap − 1, width in laps),
    drivers ordered by finishing position."""
    s = cut_lineage(M.stints(t, cid=cid), "stints")  # ranked and returned: planned once
    order = _ranked(s.groupBy(TEAM, "driver_id").agg(F.min("finish_pos").alias("best_finish")), F.col("best_finish"))
    return s.join(order.select(TEAM, "driver_id", "driver_rank"), [TEAM, "driver_id"], "inner").select(
        TEAM, "race_id", "driver_id", "driver", "stint", "compound",
        (F.col("start_lap") - 1).alias("base"),
        (F.col("end_lap") - F.col("start_lap") + 1).alias("width"),
        "stint_laps", "finish_pos", "driver_rank")


def _raced(t, cid=None) -> DataFrame:
    """Team, driver, year, round, pts and position_order of every start of a known driver."""
    res = team_filter(t.results, cid).select("race_id", "driver_id", TEAM, "points", "position_order")
    return (res.join(t.races.select("race_id", "year", "round"), "race_id", "inner")
            .join(t.drivers.select("driver_id"), "driver_id", "left_semi")
            .withColumn("pts", F.coalesce(F.col("points"), F.lit(0.0))))


def _driver_seasons(raced: DataFrame) -> DataFrame:
    """Starts, retirements and points per team, driver and season. The points
    are the season's total, which is the largest running total too, as a
    result's points aren't negative (a rule of the contract)."""
    return raced.groupBy(TEAM, "driver_id", "year").agg(
        F.count(F.lit(1)).alias("starts"), F.count_if(F.col("position_order").cast("int") >= 999).alias("dnf_starts"), F.sum("pts").alias("points"))


def kpi_block(t, cid=None, min_races: int = 10) -> DataFrame:
    """One row of headline figures per team: starts, races, drivers,
    seasons, wins, podiums, poles, front-row starts, average and best
    finish, points (sum over driver-seasons of the season maximum), win and
    podium rates, reliability (from the retirement model, else from the
    starts)."""
    gf = grid_finish(t, cid)
    raced = _raced(t, cid)
    # distinct drivers and seasons are counted among the driver-seasons, races among the team's races
    a = _driver_seasons(raced).groupBy(TEAM).agg(
        F.sum("starts").alias("starts"), F.count_distinct("driver_id").alias("drivers"), F.count_distinct("year").alias("seasons"),
        F.sum("dnf_starts").alias("dnf_starts"), F.sum("points").alias("total_points"))
    met = raced.select(TEAM, "year", "round").distinct().groupBy(TEAM).agg(F.count(F.lit(1)).alias("races"))
    g = gf.groupBy(TEAM).agg(
        F.count_if(F.col("finish") == 1).alias("wins"),
        F.count_if(F.col("finish") <= 3).alias("podiums"),
        F.count_if(F.col("grid") == 1).alias("poles"),
        F.count_if(F.col("grid") <= 2).alias("front_row"),
        round_half_up(F.avg("finish"), 6).alias("avg_finish"),
        F.min("finish").alias("best_finish"))
    rel = M.dnf_counts(t, cid=cid, min_races=min_races).groupBy(TEAM).agg(
        F.sum("dnfs").alias("m_dnfs"), F.sum("races").alias("m_races"))
    out = a.join(met, TEAM).join(g, TEAM, "left").join(rel, TEAM, "left")
    z = F.lit(0).cast("bigint")
    wins, pods = F.coalesce("wins", z), F.coalesce("podiums", z)
    reliability = (F.when(F.coalesce("m_races", z) > 0, 100.0 * (1 - F.col("m_dnfs") / F.col("m_races")))
                   .when(F.col("starts") > 0, 100.0 * (1 - F.col("dnf_starts") / F.col("starts")))
                   .otherwise(F.lit(0.0)))
    return out.select(
        TEAM, "starts", "races", "drivers", "seasons", wins.alias("wins"), pods.alias("podiums"),
        F.coalesce("poles", z).alias("poles"), F.coalesce("front_row", z).alias("front_row"),
        F.coalesce("avg_finish", F.lit(0.0)).alias("avg_finish"),
        F.coalesce("best_finish", F.lit(0)).alias("best_finish"),
        "total_points",
        round_half_up(100.0 * wins / F.col("starts"), 6).alias("win_rate"),
        round_half_up(100.0 * pods / F.col("starts"), 6).alias("podium_rate"),
        round_half_up(reliability, 6).alias("reliability"))


def ticker(t, cid=None) -> DataFrame:
    """Per driver wins, podiums, poles, average finish and points
    (sum of season maxima), ordered by points."""
    pts = _driver_seasons(_raced(t, cid)).groupBy(TEAM, "driver_id").agg(F.sum("points").alias("points"))
    pts = with_driver_name(pts, t.drivers, "driver")
    gf = grid_finish(t, cid).groupBy(TEAM, "driver_id").agg(
        F.count_if(F.col("finish") == 1).alias("wins"),
        F.count_if(F.col("finish") <= 3).alias("podiums"),
        F.count_if(F.col("grid") == 1).alias("poles"),
        round_half_up(F.avg("finish"), 1).alias("avg_finish"))
    z = F.lit(0).cast("bigint")
    return (pts.join(gf, [TEAM, "driver_id"], "left")
            .select(TEAM, "driver_id", F.upper(F.trim("driver")).alias("name"), "points",
                    F.coalesce("wins", z).alias("wins"), F.coalesce("podiums", z).alias("podiums"),
                    F.coalesce("poles", z).alias("poles"), "avg_finish")
            .orderBy(TEAM, F.col("points").desc(), "driver_id"))


def season_facets(t, cid=None) -> DataFrame:
    """Standings points by round with race names, one facet per
    season; ``driver_rank`` orders drivers by their best points total."""
    res = team_filter(t.results, cid).select("race_id", "driver_id", TEAM)
    ds = t.driver_standings.join(res, ["race_id", "driver_id"], "inner") \
        .join(t.races.select("race_id", "year", "round", "race_name"), "race_id", "inner")
    ds = with_driver_name(ds, t.drivers, "driver")
    best = ds.groupBy(TEAM, "driver_id").agg(F.max("points").alias("best"))
    best = _ranked(best, F.col("best").desc())
    return ds.join(best.select(TEAM, "driver_id", "driver_rank"), [TEAM, "driver_id"], "inner") \
        .select(TEAM, "driver_id", "driver", "year", "round", "race_name", "points", "driver_rank")


def pit_stops_z(t, cid=None) -> DataFrame:
    """Every stop of the team in seconds and as a z-score (3 dp),
    drivers ranked by mean z (highest first)."""
    z = M.pit_stop_z(t, cid=cid)
    mean = z.groupBy(TEAM, "driver_id").agg(F.avg("z").alias("mz"))
    mean = _ranked(mean, F.col("mz").desc())
    return z.join(mean.select(TEAM, "driver_id", "driver_rank"), [TEAM, "driver_id"], "inner").select(
        TEAM, "race_id", "year", "race_name", "driver_id", "driver", "stop",
        round_half_up(F.col("milliseconds") / 1000.0, 2).alias("duration_s"),
        round_half_up("z", 3).alias("z"), "driver_rank")


def compound_map(t) -> DataFrame:
    """Lap-by-lap tyre compound of every driver in the latest season
    that has laps (missing compound shown as UNKNOWN)."""
    laps = t.yearly("laps")
    # laps are partitioned by year: the latest is found without opening a column, and prunes the files
    latest = F.col("year") == laps.agg(F.max("year")).scalar()
    races = t.races.filter(latest).select("race_id", "year", "round", "race_name")
    laps = laps.filter(latest).select("race_id", "driver_id", "lap_number", "compound")
    sel = with_driver_name(laps.join(races, "race_id", "inner"), t.drivers, "driver")
    return sel.select("year", "race_name", "round", "lap_number", "driver_id", "driver",
                      F.coalesce("compound", F.lit("UNKNOWN")).alias("compound"))


def sectors_unpivoted(t, cid=None, min_laps: int = 10) -> DataFrame:
    """Sector means (3 dp, laps need all three sectors) in long form:
    one row per driver and sector S1/S2/S3."""
    s = M.sector_means(t, cid=cid, min_laps=min_laps, digits=3, require_lap_time=False)
    long = s.unpivot([TEAM, "driver_id", "driver", "n"], ["s1_mean", "s2_mean", "s3_mean"], "sector", "time_s")
    label = F.upper(F.substring("sector", 1, 2))
    return long.select(TEAM, "driver_id", "driver", "n", label.alias("sector"), "time_s")


def teammate_labels(t, cid=None, min_shared_races: int = 5) -> DataFrame:
    """Teammate table with surname pair and significance stars."""
    d = M.teammate_delta(t, cid=cid, min_shared_races=min_shared_races)
    return d.select("*", F.concat(surname_of("driver_a"), F.lit(" vs "), surname_of("driver_b")).alias("pair"),
                    significance_label("p_value").alias("significance"))


def ols_fit_line(t, cid=None, points: int = 200) -> DataFrame:
    """The team's OLS line finish ~ grid sampled at ``points`` evenly
    spaced grid values between the smallest and largest grid slot."""
    pts = grid_finish(t, cid)
    fit = pts.groupBy(TEAM).agg(F.count(F.lit(1)).alias("n"),
                                F.regr_slope("finish", "grid").alias("slope"),
                                F.regr_intercept("finish", "grid").alias("intercept"),
                                F.min("grid").alias("lo"), F.max("grid").alias("hi")) \
        .filter((F.col("n") >= 2) & F.col("slope").isNotNull())
    step = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")
    x = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("i") / F.lit(float(points - 1))
    return fit.select(TEAM, "slope", "intercept", step, "lo", "hi").select(
        TEAM, "i", round_half_up(x, 6).alias("grid"),
        round_half_up(F.col("intercept") + F.col("slope") * x, 6).alias("finish"))
