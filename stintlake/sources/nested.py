"""Flatten landed result-API documents (nested JSON) into flat rows.

Input: one JSON document per file (``spark.read.text(dir, wholetext=True)``
reads a whole directory of pages in one scan, so pagination is simply the
union of the page files). Each document has the envelope::

    {"MRData": {"total": .., "<Name>Table": {.., "<List>": [ item, .. ]}}}

All leaves are strings, and any inner list may arrive as a single object.
Everything here is built-in column expressions (``from_json``, ``explode``,
struct access, ``coalesce``); no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from stintlake.functions.columns import race_id

from stintlake import DNF_POSITION_ORDER
from stintlake.functions.columns import duration_ms
from stintlake.session import CODEC

_TXT = "map<string,string>"


def read_documents(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Landed documents under ``path`` as rows ``(path, value)``: one JSON
    document per line (default), or one per file (``whole_file``, for
    pretty-printed pages)."""
    return spark.read.text(path, wholetext=whole_file).select(F.input_file_name().alias("path"), "value")


def checked_documents(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """``docs`` with ``broken``: null for a document that can be flattened,
    else why not. One pass over the text; nothing is dropped here."""
    doc = F.from_json(F.col(text_col), _TXT)
    mr = F.from_json(doc["MRData"], _TXT)
    table = F.get(F.filter(F.map_keys(mr), lambda k: k.endswith("Table")), F.lit(0))
    why = (F.when(F.trim(F.coalesce(F.col(text_col), F.lit(""))) == "", "empty")
           .when(doc.isNull() | (F.size(F.map_keys(doc)) == 0), "not JSON")
           .when(mr.isNull(), "no envelope").when(table.isNull(), "no table")
           .when(F.from_json(mr[table], _TXT).isNull(), "table not JSON"))
    return docs.withColumn("broken", why)


def land_checked(spark: SparkSession, docs: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write ``docs`` once, by whether they are broken, and return the good
    ones and the broken ones (with ``broken``, the reason). Both are read from
    the same written files, so every document is in one of them."""
    why = checked_documents(docs)
    why.withColumn("state", F.when(F.col("broken").isNull(), "good").otherwise("broken")).write.option("compression", CODEC).partitionBy("state").parquet(path)
    back = spark.read.schema(why.withColumn("state", F.lit("")).schema).parquet(path)
    return back.filter("state = 'good'").drop("state", "broken"), back.filter("state = 'broken'").drop("state")


def table_items(docs: DataFrame, table: str, item_schema: StructType, text_col: str = "value") -> DataFrame:
    """Unwrap ``MRData.<table>`` (else the first key ending in ``Table``),
    take the first list inside it and explode its items (parsed with
    ``item_schema``). A single object in place of the list counts as a
    one-item list; a document without the envelope yields no rows."""
    mr = F.from_json(F.from_json(F.col(text_col), _TXT)["MRData"], _TXT)
    any_table = F.get(F.filter(F.map_keys(mr), lambda k: k.endswith("Table")), F.lit(0))
    table_txt = F.coalesce(mr[table], mr[any_table])
    tmap = F.from_json(table_txt, _TXT)
    first_list = F.get(F.filter(F.map_values(tmap), lambda v: F.ltrim(v).startswith("[")), F.lit(0))
    items = as_list(first_list, item_schema)
    return docs.select("*", F.explode(items).alias("item")).drop(text_col)


def as_list(text: Column, item_schema: StructType) -> Column:
    """JSON text holding a list of objects, or a single object, as an array."""
    return F.when(text.isNotNull(),
                  F.coalesce(F.from_json(text, ArrayType(item_schema)),
                             F.array(F.from_json(text, item_schema))))


def _s(*names: str) -> StructType:
    return StructType.fromJson({"type": "struct", "fields": [
        {"name": n, "type": "string", "nullable": True, "metadata": {}} for n in names]})


def _nested(fields: dict) -> StructType:
    """Struct of string leaves; a dict value is a nested struct."""
    out = []
    for name, sub in fields.items():
        dt = _nested(sub).jsonValue() if isinstance(sub, dict) else "string"
        out.append({"name": name, "type": dt, "nullable": True, "metadata": {}})
    return StructType.fromJson({"type": "struct", "fields": out})


# Item shapes of the source documents (field names are the source's).
CIRCUIT = _nested({"circuitId": None, "circuitName": None, "url": None,
                   "Location": {"lat": None, "long": None, "locality": None, "country": None}})
SEASON = _s("season", "url")
CONSTRUCTOR = _s("constructorId", "name", "nationality", "url")
DRIVER = _s("driverId", "code", "givenName", "familyName", "dateOfBirth", "nationality", "url",
            "permanentNumber")
# Race items keep their inner lists as raw text: a list or a single object.
RACE = _nested({"season": None, "round": None, "raceName": None, "date": None, "time": None, "url": None,
                "Circuit": {"circuitId": None}, "Results": None, "QualifyingResults": None,
                "PitStops": None})
RESULT = _nested({"number": None, "position": None, "positionText": None, "points": None, "grid": None,
                  "laps": None, "status": None, "Driver": {"driverId": None},
                  "Constructor": {"constructorId": None}, "Time": {"time": None, "millis": None},
                  "FastestLap": {"rank": None, "lap": None, "Time": {"time": None},
                                 "AverageSpeed": {"speed": None}}})
QUALI = _nested({"number": None, "position": None, "Q1": None, "Q2": None, "Q3": None,
                 "Driver": {"driverId": None}, "Constructor": {"constructorId": None}})
PIT = _s("driverId", "stop", "lap", "time", "duration")
STANDINGS_LIST = _nested({"season": None, "round": None, "DriverStandings": None,
                          "ConstructorStandings": None})
STANDING = {"position": None, "positionText": None, "points": None, "wins": None}


def _int(c) -> Column:
    return F.trim(c).try_cast("int")


def _race_id(season, round_) -> Column:
    return race_id(_int(season), _int(round_)).alias("race_id")


def flatten_circuits(docs: DataFrame) -> DataFrame:
    it = table_items(docs, "CircuitTable", CIRCUIT)
    i = F.col("item")
    return it.select(
        F.coalesce(i.circuitId, F.lit("")).alias("circuit_ref"),
        F.coalesce(i.circuitName, F.lit("")).alias("circuit_name"),
        F.coalesce(i.Location.locality, F.lit("")).alias("location"),
        F.coalesce(i.Location.country, F.lit("")).alias("country"),
        F.trim(i.Location.lat).try_cast("double").alias("lat"),
        F.trim(i.Location.long).try_cast("double").alias("lng"),
        F.lit(None).cast("int").alias("altitude"),
        F.coalesce(i.url, F.lit("")).alias("url"))


def flatten_seasons(docs: DataFrame) -> DataFrame:
    it = table_items(docs, "SeasonTable", SEASON)
    return it.select(F.coalesce(_int(F.col("item.season")), F.lit(0)).alias("year"),
                     F.coalesce(F.col("item.url"), F.lit("")).alias("url"))


def flatten_constructors(docs: DataFrame) -> DataFrame:
    it = table_items(docs, "ConstructorTable", CONSTRUCTOR)
    i = F.col("item")
    return it.select(F.coalesce(i.constructorId, F.lit("")).alias("constructor_ref"),
                     F.coalesce(i["name"], F.lit("")).alias("constructor_name"),
                     F.coalesce(i.nationality, F.lit("")).alias("nationality"),
                     F.coalesce(i.url, F.lit("")).alias("url"))


def flatten_drivers(docs: DataFrame) -> DataFrame:
    it = table_items(docs, "DriverTable", DRIVER)
    i = F.col("item")
    return it.select(F.coalesce(i.driverId, F.lit("")).alias("driver_ref"),
                     F.lit(None).cast("int").alias("driver_number"),
                     F.coalesce(i.code, F.lit("")).alias("code"),
                     F.coalesce(i.givenName, F.lit("")).alias("forename"),
                     F.coalesce(i.familyName, F.lit("")).alias("surname"),
                     F.nullif(i.dateOfBirth, F.lit("")).alias("dob"),
                     F.coalesce(i.nationality, F.lit("")).alias("nationality"),
                     F.coalesce(i.url, F.lit("")).alias("url"))


def _races(docs: DataFrame) -> DataFrame:
    return table_items(docs, "RaceTable", RACE).select(F.col("item").alias("race"))


def flatten_races(docs: DataFrame) -> DataFrame:
    r = F.col("race")
    return _races(docs).select(
        _int(r.season).alias("year"), _int(r["round"]).alias("round"), _race_id(r.season, r["round"]),
        F.coalesce(r.Circuit.circuitId, F.lit("")).alias("circuit_ref"),
        F.coalesce(r.raceName, F.lit("")).alias("race_name"),
        F.coalesce(r.date, F.lit("")).alias("race_date"),
        F.regexp_replace(F.coalesce(r.time, F.lit("00:00:00Z")), "Z", "").alias("race_time"),
        F.coalesce(r.url, F.lit("")).alias("url"))


def _per_race(docs: DataFrame, list_field: str, schema: StructType) -> DataFrame:
    r = F.col("race")
    return _races(docs).select(_race_id(r.season, r["round"]),
                               F.explode(as_list(r[list_field], schema)).alias("x"))


def flatten_results(docs: DataFrame) -> DataFrame:
    """One row per classified or retired entry. Non-numeric position:
    position null and finishing order at the sentinel; points default 0,
    status default 'Finished'."""
    x = F.col("x")
    digits = x.position.rlike(r"^[0-9]+$")
    return _per_race(docs, "Results", RESULT).select(
        "race_id",
        F.coalesce(x.Driver.driverId, F.lit("")).alias("driver_ref"),
        F.coalesce(x.Constructor.constructorId, F.lit("")).alias("constructor_ref"),
        _int(x.number).alias("number"),
        _int(x.grid).alias("grid"),
        F.when(digits, x.position.cast("int")).alias("position"),
        F.coalesce(x.positionText, F.lit("")).alias("position_text"),
        F.when(digits, x.position.cast("int")).otherwise(F.lit(DNF_POSITION_ORDER)).alias("position_order"),
        F.coalesce(F.trim(x.points).try_cast("double"), F.lit(0.0)).alias("points"),
        F.when(F.length(x.laps) > 0, _int(x.laps)).alias("laps"),
        x.Time.time.alias("time_result"),
        F.when(F.length(x.Time.millis) > 0, F.trim(x.Time.millis).try_cast("bigint")).alias("milliseconds"),
        F.when(F.length(x.FastestLap.lap) > 0, _int(x.FastestLap.lap)).alias("fastest_lap"),
        F.when(F.length(x.FastestLap.rank) > 0, _int(x.FastestLap.rank)).alias("fastest_lap_rank"),
        x.FastestLap.Time.time.alias("fastest_lap_time"),
        x.FastestLap.AverageSpeed.speed.alias("fastest_lap_speed"),
        F.coalesce(x.status, F.lit("Finished")).alias("status"))


def flatten_qualifying(docs: DataFrame) -> DataFrame:
    x = F.col("x")
    return _per_race(docs, "QualifyingResults", QUALI).select(
        "race_id",
        F.coalesce(x.Driver.driverId, F.lit("")).alias("driver_ref"),
        F.coalesce(x.Constructor.constructorId, F.lit("")).alias("constructor_ref"),
        F.when(F.length(x.number) > 0, _int(x.number)).alias("number"),
        F.when(F.length(x.position) > 0, _int(x.position)).alias("position"),
        F.coalesce(x.Q1, F.lit("")).alias("q1"),
        F.coalesce(x.Q2, F.lit("")).alias("q2"),
        F.coalesce(x.Q3, F.lit("")).alias("q3"))


def flatten_pit_stops(docs: DataFrame) -> DataFrame:
    """Stops with the duration text parsed to milliseconds."""
    x = F.col("x")
    dur = F.coalesce(x.duration, F.lit(""))
    return _per_race(docs, "PitStops", PIT).select(
        "race_id",
        F.coalesce(x.driverId, F.lit("")).alias("driver_ref"),
        F.coalesce(_int(x.stop), F.lit(0)).alias("stop"),
        F.coalesce(_int(x.lap), F.lit(0)).alias("lap"),
        F.coalesce(x.time, F.lit("")).alias("time_of_day"),
        dur.alias("duration"),
        duration_ms(dur).alias("milliseconds"))


def flatten_standings(docs: DataFrame, entries_key: str = "DriverStandings",
                      entity_key: str = "Driver", ref_field: str = "driver_ref",
                      id_attr: str = "driverId") -> DataFrame:
    """Standings lists (one per round) → one row per entry; lists of
    round 0 are skipped. The same routine serves drivers and teams."""
    it = table_items(docs, "StandingsTable", STANDINGS_LIST)
    sl = F.col("item")
    rnd = F.coalesce(_int(sl["round"]), F.lit(0))
    per = it.filter(rnd > 0).select(
        _race_id(sl.season, sl["round"]),
        F.explode(as_list(sl[entries_key], _nested(STANDING | {entity_key: {id_attr: None}}))).alias("e"))
    e = F.col("e")
    return per.select(
        "race_id",
        F.coalesce(e[entity_key][id_attr], F.lit("")).alias(ref_field),
        F.coalesce(F.trim(e.points).try_cast("double"), F.lit(0.0)).alias("points"),
        F.coalesce(_int(e.position), F.lit(0)).alias("position"),
        F.coalesce(e.positionText, F.lit("")).alias("position_text"),
        F.coalesce(_int(e.wins), F.lit(0)).alias("wins"))


def rounds_by_year(races: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """The distinct rounds of each season in range, in long form
    (year, round) sorted; a season's round list is never gathered into
    one row, since its length is not bounded."""
    return (races.filter(F.col("year").between(start_year, end_year) & F.col("round").isNotNull())
            .select("year", F.col("round").cast("int").alias("round")).distinct()
            .orderBy("year", "round"))
