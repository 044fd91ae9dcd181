"""Quality gate: a clean fixture passes; one violation per check fires."""

import datetime

import pytest
from pyspark.sql import functions as F

from stintlake.operators import quality as QC
from stintlake.schemas import SCHEMAS
from stintlake.sources.binding import Star
from tests.fixtures import quality_base


def _fails(spark, **override):
    tables = quality_base(spark)
    tables.update(override)
    return {r.check: r for r in QC.run_checks(Star(**tables), 2024, 2024).collect()}


def _row(spark, table, base_row, **changes):
    names = [f.name for f in SCHEMAS[table].fields]
    d = dict(zip(names, base_row))
    d.update(changes)
    return spark.createDataFrame([tuple(d[n] for n in names)], SCHEMAS[table])


RES = (202401, 1, 9, 33, 1, 1, "1", 1, 25.0, 52, "1:30:00", 5400000, 12, 1, "1:20.000", "220.5", "Finished")
RACE = (202401, 2024, 1, 1, "R1", datetime.date(2024, 7, 7), "14:00:00", "")


def test_clean_fixture_passes(spark):
    assert _fails(spark) == {}


def test_no_results(spark):
    f = _fails(spark, results=spark.createDataFrame([], SCHEMAS["results"]))
    assert f["results_non_empty"].value == "0" and f["results_non_empty"].expected == "> 0"


def test_race_outside_range(spark):
    races = quality_base(spark)["races"].unionByName(_row(spark, "races", RACE, race_id=209901, year=2099))
    assert "races_outside_year_range" in _fails(spark, races=races)


def test_position_order_consistency(spark):
    f = _fails(spark, results=_row(spark, "results", RES, position_order=999))
    assert "results_position_order_consistency" in f


def test_missing_years(spark):
    f = {r.check: r for r in QC.run_checks(Star(**quality_base(spark)), 2023, 2024).collect()}
    assert f["missing_race_years"].value == "2023"


@pytest.mark.parametrize("col", ["points", "laps", "grid", "position_order"])
def test_negative_values(spark, col):
    bad = -1.0 if col == "points" else -1
    assert f"results_{col}_non_negative" in _fails(spark, results=_row(spark, "results", RES, **{col: bad}))


@pytest.mark.parametrize("table,pk,extra", [
    ("drivers", "driver_id", (1, "dup", 1, "D", "A", "B", None, "x", "")),
    ("constructors", "constructor_id", (9, "dup", "D", "x", "")),
    ("circuits", "circuit_id", (1, "dup", "D", "x", "x", 0.0, 0.0, 0, "")),
    ("races", "race_id", RACE)])
def test_duplicate_keys(spark, table, pk, extra):
    df = quality_base(spark)[table].unionByName(spark.createDataFrame([extra], SCHEMAS[table]))
    assert f"{table}_unique" in _fails(spark, **{table: df})


@pytest.mark.parametrize("child,key,check", [
    ("results", "race_id", "results_race_fk"), ("results", "driver_id", "results_driver_fk"),
    ("results", "constructor_id", "results_constructor_fk"), ("qualifying", "race_id", "qualifying_race_fk"),
    ("pit_stops", "race_id", "pit_stops_race_fk")])
def test_orphans(spark, child, key, check):
    df = quality_base(spark)[child].withColumn(key, F.lit(777).cast(SCHEMAS[child][key].dataType))
    assert check in _fails(spark, **{child: df})


def test_null_fk_counts_as_orphan(spark):
    df = quality_base(spark)["results"].withColumn("driver_id", F.lit(None).cast("bigint"))
    assert "results_driver_fk" in _fails(spark, results=df)


def test_races_missing_results_and_qualifying(spark):
    races = quality_base(spark)["races"].unionByName(_row(spark, "races", RACE, race_id=202402, round=2))
    f = _fails(spark, races=races)
    assert f["races_missing_results"].value == "1" and f["races_missing_qualifying"].value == "1"


def test_skipped_rounds_are_accounted(spark):
    races = quality_base(spark)["races"].unionByName(_row(spark, "races", RACE, race_id=202402, round=2))
    tables = quality_base(spark)
    tables["races"] = races
    skipped = spark.createDataFrame([("results", 2024, 2), ("qualifying", 2024, 2)],
                                    "dataset string, year int, round int")
    f = {r.check for r in QC.run_checks(Star(**tables), 2024, 2024, skipped).collect()}
    assert "races_missing_results" not in f and "races_missing_qualifying" not in f


LAP = (202401, 1, 1, 90.0, 30.0, 30.0, 30.0, "SOFT", 1, 1, False, False, False, "1")


@pytest.mark.parametrize("changes,check", [
    (dict(lap_time_s=20.0), "laps_lap_time_bounds"),
    (dict(compound="PURPLE"), "laps_invalid_compound"),
    (dict(driver_id=555), "laps_driver_fk"),
    (dict(race_id=555), "laps_race_fk")])
def test_lap_checks(spark, changes, check):
    assert check in _fails(spark, laps=_row(spark, "laps", LAP, **changes))


def test_lap_checks_skip_when_no_laps(spark):
    assert not [c for c in _fails(spark) if c.startswith("laps_")]


def test_check_error_becomes_row(spark):
    tables = quality_base(spark)
    tables["pit_stops"] = tables["pit_stops"].drop("race_id")
    f = _fails(spark, pit_stops=tables["pit_stops"])
    assert f["pit_stops_race_fk"].value.startswith("error:")


def test_contract_schema_and_values(spark):
    bad = quality_base(spark)["results"].drop("status").withColumn("points", F.lit(-1.0))
    issues = [r.issue for r in QC.validate(bad, "results").collect()]
    assert any("Missing required columns: status" in i for i in issues)
    assert any("points has 1 values below minimum 0" in i for i in issues)
    laps = _row(spark, "laps", LAP, compound="PURPLE")
    assert [r.issue for r in QC.validate(laps, "laps").collect()] == ["compound has unexpected value 'PURPLE' in 1 rows"]
    assert [r.issue for r in QC.validate(bad, "nope").collect()] == ["No schema contract defined for nope"]


def test_strict_raises_relaxed_warns(spark):
    only_name = spark.createDataFrame([("Silverstone",)], "circuit_name string")
    with pytest.raises(QC.ContractError):
        QC.enforce(only_name, "circuits", strict=True)
    assert QC.enforce(only_name, "circuits", strict=False)


def test_column_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, v string")
    got = {(r.column, r.test): r.failures for r in QC.column_tests(df, "m", ["v"], ["k"]).collect()}
    assert got == {("v", "not_null"): 1, ("k", "unique"): 1}


def test_coerce_counts_lost_values(spark):
    raw = spark.createDataFrame([("1", "2024-01-01", None), ("x", "bad", "t")], "driver_id string, dob string, code string")
    out, lost = QC.coerce(raw, "drivers")
    rows = out.collect()
    assert [r.driver_id for r in rows] == [1, None] and rows[1].dob is None and rows[0].code == ""
    assert {r.column: r.lost for r in lost.collect()} == {"driver_id": 1, "dob": 1}


def test_registered_gate_measures_its_year_range(spark):
    """Seasons aren't taken from the races, so that one can lie outside and one
    can be missing; a race outside must have results too."""
    from stintlake.plans.checks import END_YEAR, START_YEAR, quality_checks

    tables = quality_base(spark)
    tables["races"] = tables["races"].unionByName(_row(spark, "races", RACE, race_id=197601, year=1976))
    got = {r.check: r for r in quality_checks(Star(**tables)).collect()}
    assert got["races_outside_year_range"].value == str(tables["races"].count()) and got["races_outside_year_range"].failed
    assert got["missing_race_years"].value == ", ".join(map(str, range(START_YEAR, END_YEAR + 1)))
    assert got["races_missing_results"].value == "1" and got["races_missing_qualifying"].value == "1"
