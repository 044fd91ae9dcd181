"""Ingest, transform and load behaviour (edge cases of the source ETL)."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from stintlake.functions.columns import duration_ms
from stintlake.operators import transform as X
from stintlake.operators.joins import resolve_ref
from stintlake.operators import ledger as LG
from stintlake.sources import nested
from stintlake.sources.files import read_csv_strings
from stintlake.sources.store import Store


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_missing_and_empty_files(spark, tmpdir_path):
    notes = []
    assert read_csv_strings(spark, f"{tmpdir_path}/nope.csv", ["a"], notes).count() == 0
    _write(f"{tmpdir_path}/empty.csv", "")
    assert read_csv_strings(spark, f"{tmpdir_path}/empty.csv", ["a"], notes).count() == 0
    assert len(notes) == 2


def test_header_only_file(spark, tmpdir_path):
    p = _write(f"{tmpdir_path}/circuits.csv", "circuit_ref,circuit_name,location,country,lat,lng,altitude,url\n")
    df = read_csv_strings(spark, p, ["circuit_ref", "circuit_name"])
    assert df.count() == 0 and df.columns == ["circuit_ref", "circuit_name"]


def test_unmapped_ref_dropped(spark):
    df = spark.createDataFrame([("red_bull",), ("unknown_team",)], "constructor_ref string")
    dim = spark.createDataFrame([(9, "red_bull")], "constructor_id int, constructor_ref string")
    out, drop = resolve_ref(df, "constructor_ref", "constructor_id", dim)
    assert [r.constructor_id for r in out.collect()] == [9]
    d = drop.collect()[0]
    assert (d.rows, d.unmapped, d.dropout_pct, d.level) == (2, 1, 50.0, "error")


def test_missing_map_gives_empty(spark):
    df = spark.createDataFrame([("max_verstappen",)], "driver_ref string")
    out, _ = resolve_ref(df, "driver_ref", "driver_id", None)
    assert out.count() == 0


def test_duplicate_ref_last_wins(spark):
    df = spark.createDataFrame([("max_verstappen",)], "driver_ref string")
    dim = spark.createDataFrame([(1, "max_verstappen"), (99, "max_verstappen")], "driver_id int, driver_ref string")
    out, _ = resolve_ref(df, "driver_ref", "driver_id", dim)
    assert [r.driver_id for r in out.collect()] == [99]


def test_unknown_ref_never_zero(spark):
    df = spark.createDataFrame([(202401, "ghost_driver", "red_bull")], "race_id string, driver_ref string, constructor_ref string")
    d = spark.createDataFrame([(1, "max_verstappen")], "driver_id bigint, driver_ref string")
    k = spark.createDataFrame([(9, "red_bull")], "constructor_id int, constructor_ref string")
    assert X.transform_results(df, d, k).count() == 0


def test_non_finisher_sentinel(spark):
    raw = spark.createDataFrame([("202401", "max_verstappen", "red_bull", "", "R", None, "3")],
                                "race_id string, driver_ref string, constructor_ref string, position string, "
                                "position_text string, position_order string, points string")
    d = spark.createDataFrame([(1, "max_verstappen")], "driver_id bigint, driver_ref string")
    k = spark.createDataFrame([(9, "red_bull")], "constructor_id int, constructor_ref string")
    r = X.transform_results(raw, d, k).collect()[0]
    assert r.position is None and r.position_order == 999 and r.points == 3.0 and r.milliseconds == 0


def test_truncate_points_option(spark):
    raw = spark.createDataFrame([("1", "a", "t", "0.5")],
                                "race_id string, driver_ref string, constructor_ref string, points string")
    d = spark.createDataFrame([(1, "a")], "driver_id bigint, driver_ref string")
    k = spark.createDataFrame([(9, "t")], "constructor_id int, constructor_ref string")
    assert X.transform_results(raw, d, k).collect()[0].points == 0.5
    assert X.transform_results(raw, d, k, truncate_points=True).collect()[0].points == 0.0


def test_invalid_date_kept_as_null(spark):
    raw = spark.createDataFrame([(1, "x", "not-a-date")], "driver_id int, driver_ref string, dob string")
    r = X.transform_drivers(raw).collect()[0]
    assert r.dob is None and r.driver_number == 0 and r.code == ""


def test_stable_ids_for_new_members(spark):
    existing = spark.createDataFrame([("monza", 1), ("spa", 2)], "circuit_ref string, circuit_id int")
    raw = spark.createDataFrame([("zandvoort",), ("spa",), ("imola",)], "circuit_ref string")
    got = {r.circuit_ref: r.circuit_id for r in X.assign_ids(raw, "circuit_ref", "circuit_id", existing).collect()}
    assert got == {"spa": 2, "imola": 3, "zandvoort": 4}


def test_pit_stop_duration_fallback(spark):
    d = spark.createDataFrame([(1, "a")], "driver_id bigint, driver_ref string")
    raw = spark.createDataFrame([("1", "a", "1", "20", "2.4", None)],
                                "race_id string, driver_ref string, stop string, lap string, duration string, milliseconds string")
    assert X.transform_pit_stops(raw, d).collect()[0].milliseconds == 2400
    raw2 = spark.createDataFrame([("1", "a", "1", "20", "2.4", "2500")],
                                 "race_id string, driver_ref string, stop string, lap string, duration string, milliseconds string")
    assert X.transform_pit_stops(raw2, d).collect()[0].milliseconds == 2500


@pytest.mark.parametrize("text,ms", [("25.123", int(25.123 * 1000)), ("1:02.5", 62500), ("", None),
                                     ("abc", None), ("1:xx", None), (" 2.4 ", 2400)])
def test_duration_ms(spark, text, ms):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(duration_ms("d")).collect()[0][0] == ms


def _doc(races):
    return json.dumps({"MRData": {"total": "1", "RaceTable": {"season": "2024", "Races": races}}})


def test_flatten_results_object_or_list(spark, tmpdir_path):
    one = {"season": "2024", "round": "1", "raceName": "A", "Circuit": {"circuitId": "silverstone"},
           "Results": {"number": "33", "position": "1", "positionText": "1", "points": "25",
                       "Driver": {"driverId": "max_verstappen"}, "Constructor": {"constructorId": "red_bull"},
                       "Time": {"millis": "5400000", "time": "1:30:00"}}}
    two = {"season": "2024", "round": "2", "Results": [
        {"position": "R", "positionText": "R", "Driver": {"driverId": "a"}, "Constructor": {"constructorId": "b"}},
        {"position": "2", "Driver": {"driverId": "c"}, "Constructor": {"constructorId": "d"}, "points": "18"}]}
    _write(f"{tmpdir_path}/p1.json", _doc([one]) + "\n" + _doc([two]) + "\n")
    rows = nested.flatten_results(nested.read_documents(spark, tmpdir_path)).orderBy("race_id", "driver_ref").collect()
    assert [(r.race_id, r.driver_ref, r.position, r.position_order, r.points, r.status) for r in rows] == [
        (202401, "max_verstappen", 1, 1, 25.0, "Finished"),
        (202402, "a", None, 999, 0.0, "Finished"),
        (202402, "c", 2, 2, 18.0, "Finished")]
    assert rows[0].milliseconds == 5400000 and rows[1].milliseconds is None


def test_first_table_fallback_and_no_envelope(spark, tmpdir_path):
    doc = json.dumps({"MRData": {"SomethingTable": {"Seasons": [{"season": "2023", "url": "u"}]}}})
    _write(f"{tmpdir_path}/s.json", doc + "\n" + json.dumps({"nope": 1}) + "\n")
    rows = nested.flatten_seasons(nested.read_documents(spark, tmpdir_path)).collect()
    assert [(r.year, r.url) for r in rows] == [(2023, "u")]


def test_standings_skip_round_zero(spark, tmpdir_path):
    lists = [{"season": "2024", "round": "0", "DriverStandings": []},
             {"season": "2024", "round": "3", "DriverStandings": {"position": "1", "points": "60", "wins": "2",
                                                                  "Driver": {"driverId": "max_verstappen"}}}]
    _write(f"{tmpdir_path}/st.json", json.dumps({"MRData": {"StandingsTable": {"StandingsLists": lists}}}))
    rows = nested.flatten_standings(nested.read_documents(spark, tmpdir_path)).collect()
    assert [(r.race_id, r.driver_ref, r.points, r.wins) for r in rows] == [(202403, "max_verstappen", 60.0, 2)]


def test_ledger_normalise_and_pending(spark):
    led = spark.createDataFrame([("results", 2024, "3", "done"), ("results", 2024, "1", "done"),
                                 ("results", 2024, "2", "skipped"), ("results", 2024, "1", "done"),
                                 ("results", 1990, "1", "done"), ("results", 2024, "x", "done")],
                                "dataset string, year int, round string, state string")
    clean = LG.normalise_ledger(led, 2020, 2025)
    assert sorted(r["round"] for r in clean.collect()) == [1, 2, 3]
    work = spark.createDataFrame([("results", 2024, r) for r in range(1, 6)], "dataset string, year int, round int")
    assert sorted(r["round"] for r in LG.ledger_pending(work, clean).collect()) == [4, 5]


def test_store_full_refresh_keeps_backup(spark, tmpdir_path):
    st = Store(spark, f"{tmpdir_path}/store")
    st.write_full("t", spark.createDataFrame([(1, "a")], "k int, v string"))
    st.write_full("t", spark.createDataFrame([(2, "b")], "k int, v string"))
    assert len(st.versions("t")) == 2
    assert [tuple(r) for r in st.read("t").collect()] == [(2, "b")]


def test_upsert_and_failed_upsert(spark, tmpdir_path):
    st = Store(spark, f"{tmpdir_path}/store")
    st.write_full("t", spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    st.merge_upsert("t", spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), "k", "v")
    assert sorted(tuple(r) for r in st.read("t").collect()) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(Exception):
        st.merge_upsert("t", spark.createDataFrame([(4,)], "other int"), "k", "v")
    assert sorted(tuple(r) for r in st.read("t").collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_of_repeated_keys_keeps_the_last(spark, tmpdir_path):
    st = Store(spark, f"{tmpdir_path}/store")
    twice = spark.createDataFrame([(2, 1, "x"), (2, 3, "z"), (2, 2, "y"), (5, 1, None)], "k int, seq int, v string")
    st.merge_upsert("t", twice, "k", "seq")
    assert sorted(tuple(r) for r in st.read("t").collect()) == [(2, 3, "z"), (5, 1, None)]
    st.merge_upsert("t", spark.createDataFrame([(2, 4, "a"), (2, 5, "b")], "k int, seq int, v string"), "k", "seq")
    assert sorted(tuple(r) for r in st.read("t").collect()) == [(2, 5, "b"), (5, 1, None)]


def test_signature_covers_nested_files(spark, tmpdir_path):
    st = Store(spark, f"{tmpdir_path}/store")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    df.write.partitionBy("k").parquet(f"{tmpdir_path}/t")
    before = st.input_signature([f"{tmpdir_path}/t"])
    assert before == st.input_signature([f"{tmpdir_path}/t"])
    df.limit(1).write.mode("append").parquet(f"{tmpdir_path}/t/k=2")
    assert before != st.input_signature([f"{tmpdir_path}/t"])


def test_dirty_text_becomes_null_not_an_error(spark):
    dims = spark.createDataFrame([("a", 1)], "driver_ref string, driver_id int")
    raw = spark.createDataFrame([("a", "7", "n/a", "bad")], "driver_ref string, race_id string, points string, wins string")
    raw = raw.withColumn("position", F.lit("x")).withColumn("position_text", F.lit("x"))
    r = X.transform_standings(raw, dims, "driver_ref", "driver_id").first()
    assert (r["points"], r["wins"], r["position"], r["race_id"]) == (0.0, 0, None, 7)
    stops = spark.createDataFrame([("a", "7", "1", "3", "21.5", "oops"), ("a", "7", "2", "9", "22", "22000")],
                                  "driver_ref string, race_id string, stop string, lap string, duration string, milliseconds string")
    assert sorted(x["milliseconds"] for x in X.transform_pit_stops(stops, dims).collect()) == [0, 22000]


def test_a_code_that_two_drivers_share_does_not_multiply_laps(spark):
    from datetime import timedelta

    from stintlake.sources.laps import ambiguous_codes, laps_from_sessions

    second = timedelta(seconds=90)
    lap = spark.createDataFrame([(1, "ABC", 1.0, second, second, second, second, "soft", 1.0, 1.0, True, True, None, None, "1")],
                                "race_id long, Driver string, LapNumber double, LapTime interval day to second, "
                                "Sector1Time interval day to second, Sector2Time interval day to second, Sector3Time interval day to second, "
                                "Compound string, TyreLife double, Stint double, IsPersonalBest boolean, IsAccurate boolean, "
                                "PitInTime interval day to second, PitOutTime interval day to second, TrackStatus string")
    codes = spark.createDataFrame([(1, "ABC", 4), (1, "ABC", 9)], "race_id long, code string, driver_id long")
    assert [r["driver_id"] for r in laps_from_sessions(lap, codes).collect()] == [9]
    assert [tuple(r) for r in ambiguous_codes(codes).collect()] == [(1, "ABC", 2)]


def test_a_short_file_is_read(spark, tmpdir_path):
    import os

    from pyspark.sql.types import IntegerType, StructField, StructType

    from stintlake.sources.files import read_table

    os.makedirs(tmpdir_path, exist_ok=True)
    with open(f"{tmpdir_path}/y.csv", "w") as f:
        f.write("y\n7")
    assert [r[0] for r in read_table(spark, f"{tmpdir_path}/y.csv", StructType([StructField("y", IntegerType())])).collect()] == [7]


def test_half_up_keeps_sign_and_nan(spark):
    from stintlake.functions.columns import race_id, round_half_up

    df = spark.createDataFrame([(-0.125,), (0.125,), (float("nan"),), (-0.001,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got[:2] == [-0.13, 0.13] and got[2] != got[2] and str(got[3]) == "0.0"
    keys = spark.createDataFrame([(2020, 99), (2020, 100), (2021, 0), (2020, 5)], "year int, round int").select(race_id()).collect()
    assert len({r[0] for r in keys}) == 4 and keys[3][0] == 202005


def test_seed_row_keeps_existing(spark, tmpdir_path):
    st = Store(spark, f"{tmpdir_path}/store")
    st.write_full("c", spark.createDataFrame([(9, "red_bull")], "constructor_id int, constructor_ref string"))
    st.insert_missing("c", spark.createDataFrame([(9, "other"), (10, "new")], "constructor_id int, constructor_ref string"),
                      "constructor_id")
    assert sorted(tuple(r) for r in st.read("c").collect()) == [(9, "red_bull"), (10, "new")]


def test_replace_slice(spark, tmpdir_path):
    st = Store(spark, f"{tmpdir_path}/store")
    st.write_full("laps", spark.createDataFrame([(1, 1, 90.0), (1, 2, 91.0), (2, 1, 80.0)], "race_id int, lap int, t double"))
    st.replace_slice("laps", spark.createDataFrame([(1, 1, 70.0)], "race_id int, lap int, t double"), "race_id")
    assert sorted(tuple(r) for r in st.read("laps").collect()) == [(1, 1, 70.0), (2, 1, 80.0)]


def test_absent_table_reads_empty_with_schema(spark, tmpdir_path):
    from stintlake.schemas import SCHEMAS
    st = Store(spark, f"{tmpdir_path}/store")
    assert st.read("laps", SCHEMAS["laps"]).count() == 0
    with pytest.raises(FileNotFoundError):
        st.read("laps")


def test_parameterised_sql_and_marts(spark, tmpdir_path):
    from stintlake.plans.sql import DRIVERS_OF_TEAMS, TEAM_SEASONS, execute_query
    from tests.fixtures import model_star

    star = model_star(spark)
    r = execute_query(spark, star, TEAM_SEASONS, {"cid": 9}).collect()[0]
    assert (r.season, r.total_points, r.wins, r.total_races) == (2024, 258.0, 6, 12)
    got = execute_query(spark, star, DRIVERS_OF_TEAMS, {"refs": F.array(F.lit("red_bull"))}).collect()
    assert sorted(x.driver_id for x in got) == [1, 2]
    st = Store(spark, f"{tmpdir_path}/marts")
    from stintlake.plans.mart_graph import build_marts

    assert {r.status for r in build_marts(star, st, 9).collect()} == {"ok"}
    assert st.read("mart_driver_summary").count() == 2


def test_invalid_refs_rejected(spark):
    from stintlake.plans import models as M
    from tests.fixtures import model_star

    with pytest.raises(ValueError):
        M.teammate_delta(model_star(spark), refs=["red_bull'; drop"])


def test_laps_from_sessions(spark):
    from stintlake.sources.laps import laps_from_sessions
    rows = [(202401, "VER", True, 1.0, datetime.timedelta(seconds=90.5), None, None, None, "soft", 1.0, 1.0, None,
             None, datetime.timedelta(minutes=91), "1"),
            (202401, "VER", None, 2.0, datetime.timedelta(seconds=91.0), None, None, None, "soft", 2.0, 1.0, None,
             None, None, "1"),
            (202401, "XXX", True, 1.0, datetime.timedelta(seconds=95.0), None, None, None, "hard", 1.0, 1.0, None,
             None, None, "1"),
            (202401, "VER", True, 3.0, None, None, None, None, "soft", 3.0, 1.0, None, None, None, "1")]
    sessions = spark.createDataFrame(rows, "race_id long, Driver string, IsAccurate boolean, LapNumber double, "
                                     "LapTime interval day to second, Sector1Time interval day to second, "
                                     "Sector2Time interval day to second, Sector3Time interval day to second, "
                                     "Compound string, TyreLife double, Stint double, IsPersonalBest boolean, "
                                     "PitInTime interval day to second, PitOutTime interval day to second, "
                                     "TrackStatus string")
    codes = spark.createDataFrame([(202401, "VER", 1)], "race_id long, code string, driver_id long")
    got = laps_from_sessions(sessions, codes).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.lap_number, r.lap_time_s, r.compound, r.pit_in, r.pit_out) == (1, 90.5, "SOFT", False, True)


def test_schema_drift_and_export(spark, tmpdir_path):
    from stintlake.schemas import SCHEMAS
    from stintlake.sources.files import export_csv

    drivers = spark.createDataFrame([], SCHEMAS["drivers"]).drop("code")
    issues = {(r.table, r.column, r.issue) for r in LG.schema_drift(spark, {"drivers": drivers, "laps": None}).collect()}
    assert issues == {("drivers", "code", "missing column"), ("laps", None, "missing table")}
    out = export_csv(spark.createDataFrame([(1, "a")], "k int, v string"), f"{tmpdir_path}/export")
    back = spark.read.option("header", True).csv(out).collect()
    assert [(r.k, r.v) for r in back] == [("1", "a")]


def test_completeness_and_team_slice(spark):
    from tests.fixtures import model_star

    star = model_star(spark)
    c = LG.completeness(star.results, star.races, 2, 2024, 2024).collect()[0]
    assert (c.races, c.rows, c.short_races, c.complete) == (6, 12, 0, True)
    c3 = LG.completeness(star.results, star.races, 3, 2024, 2024).collect()[0]
    assert (c3.short_races, c3.complete) == (6, False)
    sizes = {(r.table): r.rows for r in LG.team_slice_sizes(star).collect()}
    assert sizes == {"results": 12, "qualifying": 2, "constructor_standings": 6, "pit_stops": 6,
                     "driver_standings": 4}


def test_ledger_from_progress_files(spark, tmpdir_path):
    _write(f"{tmpdir_path}/p.json", json.dumps({"version": 1, "updated_at": "2024-01-01",
                                                "years": {"2024": [3, 1, 2, 1], "1990": [1]},
                                                "skipped": {"2024": [5, "x"]}}))
    rows = LG.ledger_from_json(spark, f"{tmpdir_path}/p.json", "results", 2020, 2025).collect()
    got = sorted((r.state, r["round"]) for r in rows)
    assert got == [("done", 1), ("done", 2), ("done", 3), ("skipped", 5)]
    flat = f"{tmpdir_path}/legacy"
    os.makedirs(flat)
    _write(f"{flat}/p.json", json.dumps({"2023": [2, 1]}))
    rows = LG.ledger_from_json(spark, flat, "results", 2020, 2025).collect()
    assert sorted((r.year, r["round"], r.state) for r in rows) == [(2023, 1, "done"), (2023, 2, "done")]
