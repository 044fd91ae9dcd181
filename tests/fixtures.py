"""Small star-schema fixtures (shapes of the reference's test data)."""

from __future__ import annotations

import datetime

from stintlake.schemas import SCHEMAS
from stintlake.sources.binding import Star

D = datetime.date

PIT_MS = [25123, 23456, 26789, 24000, 25500, 22000]


def _df(spark, table, rows):
    return spark.createDataFrame(rows, SCHEMAS[table])


def model_star(spark) -> Star:
    """Team 9 with drivers 1 and 2 over six races: driver 1 always starts
    2nd and wins (25 points), driver 2 always starts 1st and finishes 2nd
    (18 points); six pit stops of driver 1; ten laps in the first race."""
    races = [(202400 + r, 2024, r, 1, f"Race {r}", D(2024, 3, r), "14:00:00", "") for r in range(1, 7)]
    results = []
    for r in range(1, 7):
        rid = 202400 + r
        results.append((rid, 1, 9, 1, 2, 1, "1", 1, 25.0, 57, None, 5400000, 10, 1, None, "", "Finished"))
        results.append((rid, 2, 9, 11, 1, 2, "2", 2, 18.0, 57, None, 5401000, 12, 2, None, "", "Finished"))
    laps = []
    for drv in (1, 2):
        for n in range(1, 6):
            stint, comp, life = (1, "SOFT", n) if n <= 3 else (2, "MEDIUM", n - 3)
            laps.append((202401, drv, n, 90.0 + n * 0.1 + drv, 30.0, 30.0, 30.0 + n * 0.1 + drv, comp, life,
                         stint, False, n == 3, n == 4, "1"))
    return Star(
        circuits=_df(spark, "circuits", [(1, "silverstone", "Silverstone", "Silverstone", "UK", 52.07, -1.02, 0, "")]),
        constructors=_df(spark, "constructors", [(9, "red_bull", "Red Bull", "Austrian", "")]),
        drivers=_df(spark, "drivers", [
            (1, "max_verstappen", 33, "VER", "Max", "Verstappen", D(1997, 9, 30), "Dutch", ""),
            (2, "perez", 11, "PER", "Sergio", "Perez", D(1990, 1, 26), "Mexican", "")]),
        seasons=_df(spark, "seasons", [(2024, "")]),
        races=_df(spark, "races", races),
        results=_df(spark, "results", results),
        qualifying=_df(spark, "qualifying", [(202401, 1, 9, 1, 2, "1:21", "1:20", "1:19"),
                                             (202401, 2, 9, 11, 1, "1:21", "1:20", "1:18")]),
        pit_stops=_df(spark, "pit_stops", [(202400 + i + 1, 1, 1, 20, "14:40:00", f"{ms / 1000}", ms)
                                           for i, ms in enumerate(PIT_MS)]),
        driver_standings=_df(spark, "driver_standings", [
            (202401, 1, 25.0, 1, "1", 1), (202401, 2, 18.0, 2, "2", 0),
            (202402, 1, 50.0, 1, "1", 2), (202402, 2, 36.0, 2, "2", 0)]),
        constructor_standings=_df(spark, "constructor_standings", [
            (202400 + r, 9, 43.0 * r, 1, "1", r) for r in range(1, 7)]),
        laps=_df(spark, "laps", laps),
    )


def quality_base(spark) -> dict:
    """One clean row per table (the quality fixture's base)."""
    return dict(
        circuits=_df(spark, "circuits", [(1, "silverstone", "Silverstone", "x", "UK", 1.0, 1.0, 0, "")]),
        seasons=_df(spark, "seasons", [(2024, "")]),
        constructors=_df(spark, "constructors", [(9, "red_bull", "Red Bull", "x", "")]),
        drivers=_df(spark, "drivers", [(1, "max_verstappen", 33, "VER", "Max", "Verstappen", None, "x", "")]),
        races=_df(spark, "races", [(202401, 2024, 1, 1, "R1", D(2024, 7, 7), "14:00:00", "")]),
        results=_df(spark, "results", [(202401, 1, 9, 33, 1, 1, "1", 1, 25.0, 52, "1:30:00", 5400000, 12, 1,
                                        "1:20.000", "220.5", "Finished")]),
        qualifying=_df(spark, "qualifying", [(202401, 1, 9, 33, 1, "1:21.0", "1:20.5", "1:20.0")]),
        pit_stops=_df(spark, "pit_stops", [(202401, 1, 1, 20, "14:40:00", "2.4", 2400)]),
        driver_standings=_df(spark, "driver_standings", [(202401, 1, 25.0, 1, "1", 1)]),
        constructor_standings=_df(spark, "constructor_standings", [(202401, 9, 25.0, 1, "1", 1)]),
        laps=_df(spark, "laps", []),
    )
