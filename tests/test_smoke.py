"""End to end: raw CSV files → pipeline → loaded tables pass the gate."""

import os

from stintlake.plans.pipeline import PipelineConfig, run_pipeline

CSV = {
    "circuits.csv": "circuit_ref,circuit_name,location,country,lat,lng,altitude,url\n"
                    "silverstone,Silverstone Circuit,Silverstone,UK,52.07,-1.02,0,u\n",
    "seasons.csv": "year,url\n2024,u\n",
    "constructors.csv": "constructor_id,constructor_ref,constructor_name,nationality,url\n9,red_bull,Red Bull,Austrian,u\n",
    "drivers.csv": "driver_ref,driver_number,code,forename,surname,dob,nationality,url\n"
                   "max_verstappen,33,VER,Max,Verstappen,1997-09-30,Dutch,u\n",
    "races.csv": "race_id,year,round,circuit_ref,race_name,race_date,race_time,url\n"
                 "202401,2024,1,silverstone,British Grand Prix,2024-07-07,14:00:00,u\n",
    "results.csv": "race_id,driver_ref,constructor_ref,number,grid,position,position_text,position_order,points,laps,"
                   "time_result,milliseconds,fastest_lap,fastest_lap_rank,fastest_lap_time,fastest_lap_speed,status\n"
                   "202401,max_verstappen,red_bull,33,1,1,1,1,25,52,1:30:00,5400000,12,1,1:20.000,220.5,Finished\n",
    "qualifying.csv": "race_id,driver_ref,constructor_ref,number,position,q1,q2,q3\n"
                      "202401,max_verstappen,red_bull,33,1,1:21.0,1:20.5,1:20.0\n",
    "pit_stops.csv": "race_id,driver_ref,stop,lap,time_of_day,duration,milliseconds\n"
                     "202401,max_verstappen,1,20,14:40:00,2.4,2400\n",
    "constructor_standings.csv": "race_id,constructor_ref,points,position,position_text,wins\n202401,red_bull,25,1,1,1\n",
    "driver_standings.csv": "race_id,driver_ref,points,position,position_text,wins\n202401,max_verstappen,25,1,1,1\n",
}


def _land(root):
    for name, text in CSV.items():
        with open(os.path.join(root, name), "w") as fh:
            fh.write(text)


def test_pipeline_end_to_end(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    _land(raw)
    res = run_pipeline(spark, raw, os.path.join(tmpdir_path, "store"), PipelineConfig(2024, 2024))
    assert res.loaded["results"] == 1 and res.loaded["drivers"] == 1
    assert res.quality.collect() == []
    s = res.summary.collect()[0]
    assert (s.driver, s.team, s.period, s.races, s.points, s.wins) == ("Max Verstappen", "Red Bull", "2024–24", 1, 25, 1)


def test_pipeline_dry_run_and_year_check(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    _land(raw)
    res = run_pipeline(spark, raw, os.path.join(tmpdir_path, "store"), PipelineConfig(2024, 2024, dry_run=True))
    assert {r.table: r.rows for r in res.preview.collect()}["results"] == 1
    import pytest
    with pytest.raises(ValueError):
        run_pipeline(spark, raw, os.path.join(tmpdir_path, "store"), PipelineConfig(2025, 2024))


def test_incremental_mode_upserts(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    _land(raw)
    store = os.path.join(tmpdir_path, "store")
    run_pipeline(spark, raw, store, PipelineConfig(2024, 2024))
    res = run_pipeline(spark, raw, store, PipelineConfig(2024, 2024, mode="incremental"))
    assert res.loaded["results"] == 1  # same key: replaced, not duplicated


def test_year_range_clamp():
    import pytest

    from stintlake.plans.pipeline import check_year_range
    notes = []
    assert check_year_range(2015, 2030, 2020, 2025, notes) == (2020, 2025) and len(notes) == 2
    with pytest.raises(ValueError):
        check_year_range(2026, 2030, 2020, 2025)
