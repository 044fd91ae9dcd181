"""Lap sessions (timing feed frames) → ``laps`` rows.

Input columns (one frame of many sessions, keyed by ``race_id``):
Driver (three-letter code), IsAccurate, LapNumber, LapTime, Sector1Time,
Sector2Time, Sector3Time (day-time intervals), Compound, TyreLife, Stint,
IsPersonalBest, PitInTime, PitOutTime (intervals) and TrackStatus.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.functions.columns import interval_seconds
from stintlake.session import CODEC, brief_shuffles, shared_dir

#: Bytes of session files whose laps are joined at once (larger files aren't cut), and how many such parts there are at most.
PART_BYTES, PARTS = 12 << 20, 512
#: Races or entries of a part that may be broadcast (about 100 bytes each in memory); beyond, its laps are shuffled.
BROADCAST_ENTRIES = 500_000


def _parts(spark: SparkSession, folder: str) -> list[list[str]]:
    """The files of a folder in groups of about PART_BYTES."""
    from stintlake.sources.store import _FS

    files = [(name, size) for name, size, _ in sorted(_FS(spark, folder).files(folder)) if not name.rsplit("/", 1)[1].startswith(("_", "."))]
    most = max(PART_BYTES, -(-sum(size for _, size in files) // PARTS))
    out, have = [], 0
    for name, size in files:
        if not out or have + size > most:
            out.append([])
            have = 0
        out[-1].append(name)
        have += size
    return out


def laps_by_parts(spark: SparkSession, folder: str, race_codes: DataFrame) -> Iterator[DataFrame]:
    """The laps of a folder of sessions (see ``laps_from_sessions``), some of
    its files at a time; a frame is to be written before the next is asked for.
    The entries of a part's races are few enough to be broadcast, so that laps,
    many to an entry, don't cross the network; if they are not, that part's do."""
    from stintlake.sources.store import _FS

    whole = spark.read.parquet(folder)
    parts = _parts(spark, folder)
    for files in parts:
        s = spark.read.schema(whole.schema).option("basePath", folder).parquet(*files)
        races = s.select("race_id").distinct()
        if races.limit(BROADCAST_ENTRIES + 1).count() > BROADCAST_ENTRIES:
            yield laps_from_sessions(s, race_codes)
            continue
        held = shared_dir(spark, f"stintlake-cut/codes-{uuid.uuid4().hex[:12]}")
        with brief_shuffles(spark):
            race_codes.join(F.broadcast(races), "race_id", "left_semi").write.option("compression", CODEC).parquet(held)
        codes = spark.read.schema(race_codes.schema).parquet(held)
        yield laps_from_sessions(s, codes, codes.count() <= BROADCAST_ENTRIES)
        _FS(spark, held).delete(held)
    if not parts:
        yield laps_from_sessions(whole, race_codes)


def laps_from_sessions(sessions: DataFrame, race_codes: DataFrame, few: bool = False) -> DataFrame:
    """Keep accurate laps (missing flag = not accurate) of the drivers
    entered for the team in that race, map code → driver id through
    ``race_codes`` (race_id, code, driver_id), intervals → seconds,
    compound upper-cased, pit flags from non-null pit times, and drop rows
    without driver or lap time. A ``year`` of the codes' races is returned as
    well: there it is a row an entry, not a lap. Where drivers of a race share a code, its laps
    go to the last of them (the largest id); ``ambiguous_codes`` lists them.
    ``few`` says that the codes fit into each executor's memory."""
    s = sessions.filter(F.coalesce(F.col("IsAccurate"), F.lit(False)))
    year = ["year"] if "year" in race_codes.columns else []
    one = race_codes.groupBy("race_id", F.col("code").alias("Driver"), *year).agg(F.max("driver_id").alias("driver_id"))
    s = s.join(F.broadcast(one) if few else one, ["race_id", "Driver"], "inner")
    out = s.select(
        "race_id", "driver_id",
        F.col("LapNumber").cast("int").alias("lap_number"),
        interval_seconds("LapTime").alias("lap_time_s"),
        interval_seconds("Sector1Time").alias("sector1_s"),
        interval_seconds("Sector2Time").alias("sector2_s"),
        interval_seconds("Sector3Time").alias("sector3_s"),
        F.upper("Compound").alias("compound"),
        F.col("TyreLife").cast("int").alias("tyre_life"),
        F.col("Stint").cast("int").alias("stint"),
        F.coalesce(F.col("IsPersonalBest"), F.lit(False)).alias("is_personal_best"),
        F.col("PitInTime").isNotNull().alias("pit_in"),
        F.col("PitOutTime").isNotNull().alias("pit_out"),
        F.col("TrackStatus").cast("string").alias("track_status"), *year)
    return out.filter(F.col("driver_id").isNotNull() & F.col("lap_time_s").isNotNull())


def ambiguous_codes(race_codes: DataFrame) -> DataFrame:
    """(race_id, code, n_drivers) of the codes that drivers of a race share."""
    return (race_codes.groupBy("race_id", "code").agg(F.count_distinct("driver_id").alias("n_drivers"))
            .filter("n_drivers > 1"))


def team_race_codes(results: DataFrame, drivers: DataFrame, team_ids=None) -> DataFrame:
    """(race_id, code, driver_id) of the drivers entered per race (for the
    given teams, or all): the race → code membership of the feed. A ``year`` of
    the results is returned as well."""
    res = results if team_ids is None else results.filter(F.col("constructor_id").isin(list(team_ids)))
    d = drivers.filter(F.col("code").isNotNull() & (F.col("code") != "")).select("driver_id", "code")
    return res.select("race_id", "driver_id", *({"year"} & set(res.columns))).join(d, "driver_id", "inner")
