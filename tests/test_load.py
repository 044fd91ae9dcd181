"""The load of the star: what a query makes it write, and writes by season."""

import os

from pyspark.sql import functions as F

from stintlake.plans import models as M
from stintlake.sources.binding import STAR_TABLES, bind, load_star, with_year
from stintlake.sources.store import Store

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_query_stores_only_the_tables_it_uses(spark, tmpdir_path):
    t = load_star(spark, SF, root=f"{tmpdir_path}/lazy")
    M.sector_means(t).collect()
    (sig,) = os.listdir(f"{tmpdir_path}/lazy")
    assert sorted(os.listdir(f"{tmpdir_path}/lazy/{sig}")) == ["constructors", "drivers", "entries", "races"]


def test_facts_of_an_entry_are_read_without_a_shuffle(spark, tmpdir_path):
    t = load_star(spark, SF, root=f"{tmpdir_path}/views")
    for name in ("results", "qualifying", "pit_stops", "laps"):
        assert "Exchange" not in _plan(t.yearly(name))
        assert "PartitionFilters: [isnotnull(year" in _plan(t.yearly(name).filter("year = 1997"))


def test_stored_star_equals_the_bound_tables(spark, tmpdir_path):
    stored, bound = load_star(spark, SF, root=f"{tmpdir_path}/same"), bind(spark, SF)
    for name in STAR_TABLES:
        a, b = getattr(stored, name), getattr(bound, name)
        assert a.columns == b.columns and a.count() > 0 and _same(a, b), name
    for name in ("results", "laps", "driver_standings"):
        years = getattr(stored, name).join(stored.races.select("race_id", "year"), "race_id", "left")
        assert _same(stored.yearly(name).select(*years.columns), years)


def test_dealt_rows_are_written_by_themselves(spark, tmpdir_path):
    st = Store(spark, f"{tmpdir_path}/dealt")
    rows = spark.createDataFrame([(1, 1995), (2, 1996), (3, None), (4, 1996)], "k int, year int")
    st.write_full("t", rows, "year", dealt=True)
    assert _same(st.read("t"), rows) and len(st.partition_files("t")) == 3
    st.replace_slice("t", spark.createDataFrame([(4, 1997), (5, 1997)], "k int, year int"), "k")
    assert sorted((r.k, r.year) for r in st.read("t").filter("k > 1 AND year > 0").collect()) == [(2, 1996), (4, 1997), (5, 1997)]
    words = rows.select("k", F.concat(F.lit("a b/"), F.col("k").cast("string")).alias("year"))
    st.write_full("w", words, "year", dealt=True)
    assert _same(st.read("w"), words)


def test_laps_of_a_race_are_added_up_before_they_meet_the_results(spark, tmpdir_path):
    t = load_star(spark, SF, root=f"{tmpdir_path}/sums")
    assert "partial_sum(sector1_s" in _plan(M.sector_means(t))


def test_stints_read_earlier_seasons_for_teams_without_laps_in_the_last(spark, tmpdir_path):
    t = load_star(spark, SF, root=f"{tmpdir_path}/stints")
    read = []
    t._tables["laps"] = t.laps  # opens the table
    last, lone = t.races.agg(F.max("year")).first()[0], 3
    laps = t.yearly("laps").join(t.results.select("race_id", "driver_id", "constructor_id"), ["race_id", "driver_id"])
    kept = laps.filter((F.col("constructor_id") != lone) | (F.col("year") < last - 1)).drop("constructor_id")
    t._by_year["laps"], t._tables["laps"] = kept, kept.drop("year")
    got = {r.constructor_id: (r.year, r.race_id) for r in M.stints(t).collect()}
    order = F.struct("year", "round")
    want = (kept.select("race_id", "driver_id").distinct().join(t.results, ["race_id", "driver_id"]).join(t.races, "race_id")
            .groupBy("constructor_id").agg(F.max_by(F.struct("year", "race_id"), order).alias("x")).collect())
    assert got == {r.constructor_id: tuple(r.x) for r in want} and got[lone][0] < last - 1

    opened = t.yearly
    t.__dict__["yearly"] = lambda name: read.append(name) or opened(name)
    M.stints(t, cid=[c for c in got if c != lone])
    assert read.count("laps") == 2  # the last season's keys, and the picked races


def test_laps_get_their_year_with_the_driver(spark):
    from stintlake.sources.landing import lap_sessions
    from stintlake.sources.laps import laps_from_sessions, team_race_codes
    from stintlake.sources.binding import with_year

    t = bind(spark, SF)
    codes = team_race_codes(t.results, t.drivers)
    laps = laps_from_sessions(lap_sessions(t), with_year(codes, t.races))
    want = with_year(laps_from_sessions(lap_sessions(t), codes), t.races).collect()
    assert laps.columns[-1] == "year" and want and sorted(laps.collect(), key=repr) == sorted(want, key=repr)


def test_laps_of_many_files_do_not_cross_the_network(spark, tmpdir_path, monkeypatch):
    """A part of the sessions at a time, with its races' entries in memory; parts with more of them are shuffled."""
    from stintlake.sources import laps as L
    from stintlake.sources.landing import lap_sessions

    t = bind(spark, SF)
    codes = with_year(L.team_race_codes(t.results, t.drivers), t.races)
    want = sorted(L.laps_from_sessions(lap_sessions(t), codes).collect(), key=repr)
    folder = f"{tmpdir_path}/sessions"
    lap_sessions(t).repartition(3).write.parquet(folder)
    monkeypatch.setattr(L, "PART_BYTES", 1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for most, join in ((500_000, "BroadcastHashJoin"), (10, "SortMergeJoin")):
            monkeypatch.setattr(L, "BROADCAST_ENTRIES", most)
            got = []
            for part in L.laps_by_parts(spark, folder, codes):
                plan = part._jdf.queryExecution().executedPlan().toString()
                assert join in plan and ("SortMergeJoin" in plan) == (most == 10)
                got.append(part.collect())
            assert len(got) == 3 and sorted((r for p in got for r in p), key=repr) == want
        # the races of a part meet the results before any other join
        some = spark.range(3).select(F.col("id").alias("race_id")).distinct()
        top = L.team_race_codes(t.results, t.drivers).join(F.broadcast(some), "race_id", "left_semi")._jdf.queryExecution().optimizedPlan().toString()
        lines = [x.split("Join ")[1].split(",")[0] for x in top.splitlines() if "Join " in x]
        assert lines.index("Inner") < lines.index("LeftSemi")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    monkeypatch.setattr(L, "PARTS", 1)
    assert len(list(L.laps_by_parts(spark, folder, codes))) == 1


def test_rows_of_the_load_cross_the_network_once(spark, tmpdir_path, monkeypatch):
    asked, hint = [], type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda df, name, *cols: asked.append(name) or hint(df, name, *cols))
    t = load_star(spark, SF, root=f"{tmpdir_path}/once")
    assert t.results.count() and t.driver_standings.count() and t.constructor_standings.count()
    st = Store(spark, f"{tmpdir_path}/once-more")
    rows = t.yearly("results")
    st.merge_upsert("r", rows.filter("year < 1998"), ["race_id", "driver_id"], "status", "year")
    st.merge_upsert("r", rows.filter("year >= 1997"), ["race_id", "driver_id"], "status")
    assert "rebalance" not in asked and _same(st.read("r"), rows)


def test_the_quickest_stops_are_stored_before_the_races_join(spark, tmpdir_path):
    from stintlake.plans import queries as Q

    plan = _plan(Q.fastest_pit_stops(load_star(spark, SF, root=f"{tmpdir_path}/quick")))
    assert "l_extendedprice" not in plan and "BroadcastHashJoin" in plan


def test_merged_rows_are_made_once(spark, tmpdir_path):
    from pyspark.sql.types import LongType

    made = spark.sparkContext.accumulator(0)
    st = Store(spark, f"{tmpdir_path}/merge")
    st.write_full("t", spark.range(40).selectExpr("id AS k", "id % 4 AS year"), "year")
    new = spark.range(20, 60).select(F.udf(lambda k: made.add(1) or k, LongType())("id").alias("k"), F.lit(9).cast("bigint").alias("year"))
    st.replace_slice("t", new, "k")
    assert made.value == 40 and st.read("t").count() == 60 and st.read("t").filter("year = 9").count() == 40


def test_a_resumed_season_meets_its_own_races(spark, tmpdir_path, monkeypatch):
    from stintlake.plans import loads

    class Seen(Exception):
        pass

    def look(store, table, rounds, source, *rest, **kw):
        raise Seen(_plan(source.filter("year = 1997")))

    monkeypatch.setattr(loads.LG, "load_rounds", look)
    try:
        loads.resume_load(load_star(spark, SF, root=f"{tmpdir_path}/resume"))
    except Seen as e:
        assert "EqualTo(year,1997)" in str(e)
    else:
        raise AssertionError("nothing was loaded")
