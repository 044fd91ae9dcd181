"""One StructType per star table: the single source of truth for types,
keys and the load-time contract (required columns, type family of each
column, value constraints)."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DecimalType, DoubleType, FractionalType, IntegerType, IntegralType,
                               LongType, NumericType, StringType, StructField, StructType, TimestampType)

I, L, D, S, B, DT = IntegerType(), LongType(), DoubleType(), StringType(), BooleanType(), DateType()


def _s(*cols) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


SCHEMAS: dict[str, StructType] = {
    "circuits": _s(("circuit_id", I), ("circuit_ref", S), ("circuit_name", S), ("location", S),
                   ("country", S), ("lat", D), ("lng", D), ("altitude", I), ("url", S)),
    "seasons": _s(("year", I), ("url", S)),
    "constructors": _s(("constructor_id", I), ("constructor_ref", S), ("constructor_name", S),
                       ("nationality", S), ("url", S)),
    "drivers": _s(("driver_id", L), ("driver_ref", S), ("driver_number", I), ("code", S),
                  ("forename", S), ("surname", S), ("dob", DT), ("nationality", S), ("url", S)),
    "races": _s(("race_id", L), ("year", I), ("round", I), ("circuit_id", I), ("race_name", S),
                ("race_date", DT), ("race_time", S), ("url", S)),
    "results": _s(("race_id", L), ("driver_id", L), ("constructor_id", I), ("number", I), ("grid", I),
                  ("position", I), ("position_text", S), ("position_order", I), ("points", D),
                  ("laps", I), ("time_result", S), ("milliseconds", L), ("fastest_lap", I),
                  ("fastest_lap_rank", I), ("fastest_lap_time", S), ("fastest_lap_speed", S),
                  ("status", S)),
    "qualifying": _s(("race_id", L), ("driver_id", L), ("constructor_id", I), ("number", I),
                     ("position", I), ("q1", S), ("q2", S), ("q3", S)),
    "pit_stops": _s(("race_id", L), ("driver_id", L), ("stop", I), ("lap", I), ("time_of_day", S),
                    ("duration", S), ("milliseconds", L)),
    "constructor_standings": _s(("race_id", L), ("constructor_id", I), ("points", D), ("position", I),
                                ("position_text", S), ("wins", I)),
    "driver_standings": _s(("race_id", L), ("driver_id", L), ("points", D), ("position", I),
                           ("position_text", S), ("wins", I)),
    "laps": _s(("race_id", L), ("driver_id", L), ("lap_number", I), ("lap_time_s", D), ("sector1_s", D),
               ("sector2_s", D), ("sector3_s", D), ("compound", S), ("tyre_life", I), ("stint", I),
               ("is_personal_best", B), ("pit_in", B), ("pit_out", B), ("track_status", S)),
    "pipeline_runs": _s(("run_id", S), ("started_at", TimestampType()), ("ended_at", TimestampType()),
                        ("status", S), ("source_url", S), ("mode", S)),
    "pipeline_run_tables": _s(("run_id", S), ("table_name", S), ("rows_loaded", L)),
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "circuits": ["circuit_id"], "seasons": ["year"], "constructors": ["constructor_id"],
    "drivers": ["driver_id"], "races": ["race_id"], "qualifying": ["race_id", "driver_id"],
    "results": ["race_id", "driver_id", "constructor_id"], "pit_stops": ["race_id", "driver_id", "stop"],
    "constructor_standings": ["race_id", "constructor_id"], "driver_standings": ["race_id", "driver_id"],
    "laps": ["race_id", "driver_id", "lap_number"],
}

# Load order so that parents precede children (foreign keys).
LOAD_ORDER = ["circuits", "seasons", "constructors", "drivers", "races", "results", "qualifying",
              "pit_stops", "constructor_standings", "driver_standings", "laps"]

# Fixed values of the contract: columns a lap table may lack, lower bounds, allowed compounds.
OPTIONAL_COLUMNS = {"laps": ["sector1_s", "sector2_s", "sector3_s", "is_personal_best", "pit_in",
                             "pit_out", "track_status"]}
MIN_CONSTRAINTS = {"results": {"points": 0, "laps": 0, "position_order": 0}}
COMPOUNDS = ["SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET", "UNKNOWN"]
ENUM_CONSTRAINTS = {"laps": {"compound": COMPOUNDS}}


def family(dt) -> str:
    """Type family of a Spark type: numeric / string / datetime / boolean."""
    if isinstance(dt, NumericType):
        return "numeric"
    if isinstance(dt, StringType):
        return "string"
    if isinstance(dt, (DateType, TimestampType)):
        return "datetime"
    if isinstance(dt, BooleanType):
        return "numeric"  # 0/1 flags count as numeric in the contract
    return dt.simpleString()


FAMILIES = {
    "numeric": lambda dt: isinstance(dt, (NumericType, BooleanType)),
    "integer": lambda dt: isinstance(dt, IntegralType),
    "float": lambda dt: isinstance(dt, (FractionalType, DecimalType)),
    "string": lambda dt: isinstance(dt, StringType),
    "datetime": lambda dt: isinstance(dt, (DateType, TimestampType)),
}


def is_family(dt, name: str) -> bool:
    """Whether a Spark type is of a family that a contract can name; an
    unknown name is an error of the contract."""
    if name not in FAMILIES:
        raise KeyError(f"unknown type {name!r} in a contract; known: {', '.join(FAMILIES)}")
    return FAMILIES[name](dt)


def contract(table: str) -> dict | None:
    """Contract of a table, derived from its schema plus the fixed
    constraints: required columns, expected family per column, min / enum."""
    sch = SCHEMAS.get(table)
    if sch is None:
        return None
    optional = set(OPTIONAL_COLUMNS.get(table, []))
    return {
        "required": [f.name for f in sch.fields if f.name not in optional],
        "families": {f.name: family(f.dataType) for f in sch.fields},
        "min": MIN_CONSTRAINTS.get(table, {}),
        "enum": ENUM_CONSTRAINTS.get(table, {}),
    }
