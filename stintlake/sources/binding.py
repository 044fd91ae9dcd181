"""Bind the driver's TPC-H-like tables to the race-season star schema.

The engine runs on race data (circuits, drivers, races, results, ...). The
test bed only offers TPC-H-like tables, so this module derives star-schema
tables from them by fixed rules. It only shapes input rows; every query and
model works on the derived tables as it would on real ones.

Rules (each table derived with plain DataFrame operations):

* circuits      nation ⋈ region; id = n_nationkey, country = r_name
* constructors  nation; id = n_nationkey, ref = lower(n_name)
* drivers       supplier; id = s_suppkey, forename / surname = s_name split at '#'
* races         orders ⋈ customer; race_id = o_orderkey, year of o_orderdate,
                round = rank in the year by (o_orderdate, o_orderkey),
                circuit = c_nationkey
* results       one lineitem per (l_orderkey, l_suppkey) (smallest row);
                constructor = supplier nation; position = l_linenumber,
                retired (position null, order 999) when l_returnflag = 'R'
* qualifying    results with driver_id % 7 <> 0; position 1 + l_partkey % 20
* pit_stops     every lineitem; stop = rank within (order, supplier)
* standings     running totals of results points / wins per season
* laps          5 + l_partkey % 11 laps per result, five-lap stints

The same rules are written as SQL text in ``stintlake.oracle`` for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stintlake import DNF_POSITION_ORDER
from stintlake.operators.ranges import numbered
from stintlake.operators.windows import running_sum, scan_levels

# Points for finishing positions 1..10 (current championship rules).
POINTS_BY_POSITION = [25, 18, 15, 12, 10, 8, 6, 4, 2, 1]

# Rounds per block when season running totals are split across tasks.
STANDINGS_BLOCK = 64


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Tables of rows about one race; stored, they are partitioned by its year.
FACTS = ("results", "qualifying", "pit_stops", "driver_standings", "constructor_standings", "laps")


class Star:
    """The star tables. Each attribute is a DataFrame; when built from a
    store, a table is opened on first use only (a query touching three
    tables lists and reads three)."""

    _NAMES = ("circuits", "constructors", "drivers", "seasons", "races", "results",
              "qualifying", "pit_stops", "driver_standings", "constructor_standings", "laps")

    def __init__(self, loader=None, key: str | None = None, **tables: DataFrame):
        self._loader = loader
        self._key = key  # identity of stored tables (None: in-memory frames)
        self._tables = dict(tables)
        self._by_year = {}  # stored facts, with the column they are partitioned by

    @property
    def key(self) -> str | None:
        return self.__dict__["_key"]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        tables = self.__dict__["_tables"]
        if name not in tables:
            loader = self.__dict__["_loader"]
            if loader is None or name not in self._NAMES:
                raise AttributeError(name)
            df = loader(name)
            if name in FACTS and "year" in df.columns:
                self.__dict__["_by_year"][name], df = df, df.drop("year")
            tables[name] = df
        return tables[name]

    def yearly(self, name: str) -> DataFrame:
        """A fact table with the ``year`` of its race. Stored facts are
        partitioned by it, so that a filter on the year prunes files."""
        df = getattr(self, name)
        by_year = self.__dict__["_by_year"]
        return by_year[name] if name in by_year else df.join(self.races.select("race_id", "year"), "race_id", "left")

    @property
    def dealt(self) -> bool:
        """Whether the facts are read from tables stored by year."""
        return self.key is not None

    @property
    def last_round(self) -> int:
        """Largest round of any season (0 without races); measured once."""
        if "_last_round" not in self.__dict__:
            self.__dict__["_last_round"] = self.races.agg(F.max("round")).first()[0] or 0
        return self.__dict__["_last_round"]

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in self._NAMES}

    def register(self, prefix: str = "") -> None:
        for name, df in self.as_dict().items():
            df.createOrReplaceTempView(prefix + name)


def _points(position) -> F.Column:
    expr = F.lit(0.0)
    for pos in range(len(POINTS_BY_POSITION), 0, -1):
        expr = F.when(position == pos, F.lit(float(POINTS_BY_POSITION[pos - 1]))).otherwise(expr)
    return F.when(position.isNull(), F.lit(0.0)).otherwise(expr)


def bind(spark: SparkSession, sf_dir: str) -> Star:
    """All star tables as lazy DataFrames over the driver tables."""
    dims = bind_dims(spark, sf_dir)
    facts = bind_facts(bind_entries(spark, sf_dir, dims["races"]), dims["races"])
    return Star(**dims, **{n: df.drop("year") for n, df in facts.items()})


def bind_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    races = bind_races(spark, sf_dir)
    return {**bind_members(spark, sf_dir), "seasons": seasons_of(races), "races": races}


def bind_members(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    supplier = _read(spark, sf_dir, "supplier")

    nat = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    circuits = nat.select(
        F.col("n_nationkey").alias("circuit_id"),
        F.lower("n_name").alias("circuit_ref"),
        F.col("n_name").alias("circuit_name"),
        F.col("n_name").alias("location"),
        F.col("r_name").alias("country"),
        (F.col("n_nationkey") * 2.5 - 30.0).alias("lat"),
        (F.col("n_regionkey") * 30.0 - 60.0).alias("lng"),
        (F.col("n_nationkey") * 10).alias("altitude"),
        F.concat(F.lit("circuit/"), F.lower("n_name")).alias("url"),
    )
    constructors = nat.select(
        F.col("n_nationkey").alias("constructor_id"),
        F.lower("n_name").alias("constructor_ref"),
        F.col("n_name").alias("constructor_name"),
        F.col("r_name").alias("nationality"),
        F.concat(F.lit("team/"), F.lower("n_name")).alias("url"),
    )

    parts = F.split(F.col("s_name"), "#")
    drivers = supplier.select(
        F.col("s_suppkey").alias("driver_id"),
        F.lower("s_name").alias("driver_ref"),
        (F.col("s_suppkey") % 100).cast("int").alias("driver_number"),
        F.upper(F.substring(F.element_at(parts, 2), -3, 3)).alias("code"),
        F.when(F.col("s_suppkey") % 17 == 5, F.lit(None).cast("string"))
         .otherwise(F.element_at(parts, 1)).alias("forename"),
        F.element_at(parts, 2).alias("surname"),
        F.date_add(F.lit("1970-01-01").cast("date"),
                   ((F.col("s_suppkey") * 37) % 9000).cast("int")).alias("dob"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("nationality"),
        F.concat(F.lit("driver/"), F.col("s_suppkey").cast("string")).alias("url"),
    )

    return dict(circuits=circuits, constructors=constructors, drivers=drivers)


def bind_races(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _read(spark, sf_dir, "customer")
    orders = _read(spark, sf_dir, "orders")

    # races: round = rank of the race within its year by (date, key), by ranges
    o = (orders.select("o_orderkey", "o_custkey", "o_orderdate")
         .withColumn("race_date", F.to_date("o_orderdate"))
         .withColumn("year", F.year("race_date").cast("int")))
    o = o.join(customer.select("c_custkey", "c_nationkey"), o.o_custkey == customer.c_custkey, "left")
    keep = {c: F.col(c) for c in ("o_orderkey", "race_date", "year", "c_custkey", "c_nationkey")}
    return (numbered(o, ["year"], [F.col("race_date"), F.col("o_orderkey")], "round", keep)
             .filter(F.col("c_custkey").isNotNull())
             .select(
                 F.col("o_orderkey").alias("race_id"),
                 "year",
                 F.col("round").cast("int").alias("round"),
                 F.col("c_nationkey").alias("circuit_id"),
                 F.concat(F.lit("Grand Prix "), F.col("o_orderkey").cast("string")).alias("race_name"),
                 "race_date",
                 F.lit("14:00:00").alias("race_time"),
                 F.concat(F.lit("race/"), F.col("o_orderkey").cast("string")).alias("url"),
             ))


def seasons_of(races: DataFrame) -> DataFrame:
    return races.select("year").distinct().select(
        "year", F.concat(F.lit("season/"), F.col("year").cast("string")).alias("url"))


LI_COLS = ["l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def bind_entries(spark: SparkSession, sf_dir: str, races: DataFrame) -> DataFrame:
    """Every lineitem with its rank (``stop``) within (order, supplier) by
    all of its columns (rank 1 is the result row, every rank a pit stop), with
    the year and round of its race and the team of its driver; null where the
    race or the driver isn't known.

    The join with the race comes first: dealt by order for it, the rows are
    dealt for the rank as well, and what is derived from them needs no shuffle.
    The team comes last, so that it doesn't cross the network with them."""
    lineitem = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", *LI_COLS)
    supplier = _read(spark, sf_dir, "supplier")
    team = supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.struct(F.col("s_nationkey").alias("id")).alias("team")).dropDuplicates(["l_suppkey"])
    race = races.select(F.col("race_id").alias("l_orderkey"), "year", "round").dropDuplicates(["l_orderkey"])
    w = Window.partitionBy("l_orderkey", "l_suppkey").orderBy(*LI_COLS)
    ranked = lineitem.join(race, "l_orderkey", "left").withColumn("stop", F.row_number().over(w))
    return ranked.join(team, "l_suppkey", "left").select("l_orderkey", "l_suppkey", *LI_COLS, "stop", "team", "round", "year")


def bind_results_src(entries: DataFrame) -> DataFrame:
    """One result per (order, supplier): the smallest lineitem row."""
    src = entries.filter((F.col("stop") == 1) & F.col("team").isNotNull())
    retired = F.col("l_returnflag") == "R"
    pos = F.when(retired, F.lit(None).cast("int")).otherwise(F.col("l_linenumber"))
    flag = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    # Fixed status text per (return flag, line status) pair.
    status = (F.when(flag == "AF", "Finished").when(flag == "AO", "+1 Lap")
              .when(flag == "NF", "Finished").when(flag == "NO", "+2 Laps")
              .when(flag == "RF", "Engine").when(flag == "RO", "Collision")
              .otherwise("Finished"))
    return src.select(
        F.col("l_orderkey").alias("race_id"),
        F.col("l_suppkey").alias("driver_id"),
        F.col("team.id").alias("constructor_id"),
        (F.col("l_suppkey") % 100).cast("int").alias("number"),
        (F.col("l_partkey") % 21).cast("int").alias("grid"),
        pos.alias("position"),
        F.when(retired, F.lit("R")).otherwise(F.col("l_linenumber").cast("string")).alias("position_text"),
        F.when(retired, F.lit(DNF_POSITION_ORDER)).otherwise(F.col("l_linenumber")).alias("position_order"),
        _points(pos).alias("points"),
        F.col("l_quantity").cast("int").alias("laps"),
        F.when(retired, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("+"), F.col("l_linenumber").cast("string"), F.lit(" pos"))).alias("time_result"),
        (F.floor("l_extendedprice").cast("bigint") * 60).alias("milliseconds"),
        F.col("l_quantity").cast("int").alias("fastest_lap"),
        F.when(F.col("l_linestatus") == "F", F.lit(1)).otherwise(F.col("l_linenumber") + 1).alias("fastest_lap_rank"),
        F.lit(None).cast("string").alias("fastest_lap_time"),
        (F.lit(200) + F.floor(F.col("l_tax") * 100).cast("int")).cast("string").alias("fastest_lap_speed"),
        status.alias("status"),
        F.col("l_partkey").alias("_partkey"),
        F.col("round").alias("_round"),
        "year",
    )


def bind_facts(entries: DataFrame, races: DataFrame, last_round: int | None = None) -> dict[str, DataFrame]:
    """The fact tables, each with the ``year`` of its race. ``last_round``
    (largest round of a season) sets how deep the scan over a team's season is
    nested; measured if not given."""
    results_src = bind_results_src(entries)
    return dict(results=results_src.drop("_partkey", "_round"), qualifying=bind_qualifying(results_src),
                pit_stops=bind_pit_stops(entries), driver_standings=bind_driver_standings(results_src),
                constructor_standings=bind_constructor_standings(results_src, races, last_round), laps=bind_laps(results_src))


def bind_qualifying(results_src: DataFrame) -> DataFrame:
    qpos = (F.col("_partkey") % 20 + 1).cast("int")
    return results_src.filter(F.col("driver_id") % 7 != 0).select(
        "race_id", "driver_id", "constructor_id", "number",
        qpos.alias("position"),
        F.concat(F.lit("1:2"), (F.col("_partkey") % 10).cast("string"), F.lit(".500")).alias("q1"),
        F.when(qpos > 15, F.lit("")).otherwise(
            F.concat(F.lit("1:2"), (F.col("_partkey") % 9).cast("string"), F.lit(".250"))).alias("q2"),
        F.when(qpos > 10, F.lit("")).otherwise(
            F.concat(F.lit("1:2"), (F.col("_partkey") % 8).cast("string"), F.lit(".125"))).alias("q3"),
        "year",
    )


def bind_pit_stops(entries: DataFrame) -> DataFrame:
    ms = F.floor("l_extendedprice").cast("bigint")
    pit = entries.select(
        F.col("l_orderkey").alias("race_id"),
        F.col("l_suppkey").alias("driver_id"),
        F.col("stop").cast("int").alias("stop"),
        F.col("l_quantity").cast("int").alias("lap"),
        ms.alias("milliseconds"),
        "year",
    )
    secs_txt = F.concat(F.floor(F.col("milliseconds") / 1000).cast("string"), F.lit("."),
                        F.lpad((F.col("milliseconds") % 1000).cast("string"), 3, "0"))
    min_txt = F.concat(F.floor(F.col("milliseconds") / 60000).cast("string"), F.lit(":"),
                       F.lpad(F.floor((F.col("milliseconds") % 60000) / 1000).cast("string"), 2, "0"),
                       F.lit("."), F.lpad((F.col("milliseconds") % 1000).cast("string"), 3, "0"))
    return pit.select(
        "race_id", "driver_id", "stop", "lap",
        F.concat(F.lit("14:"), F.lpad(F.col("lap").cast("string"), 2, "0"), F.lit(":00")).alias("time_of_day"),
        F.when(F.col("milliseconds") >= 60000, min_txt).otherwise(secs_txt).alias("duration"),
        "milliseconds", "year",
    )


def _raced(results_src: DataFrame) -> DataFrame:
    """Results of known races, with their round."""
    return results_src.filter(F.col("_round").isNotNull()).withColumnRenamed("_round", "round")


def bind_driver_standings(results_src: DataFrame) -> DataFrame:
    # a driver's season is bounded by its rounds: plain window; a team's
    # season holds all its drivers' rows: split by round blocks
    ds = running_sum(
        _raced(results_src).select("race_id", "driver_id", "year", "round", "points",
                                   F.when(F.col("position") == 1, 1).otherwise(0).alias("win")),
        ["driver_id", "year"], "round",
        {"cum_points": "points", "cum_wins": "win"})
    w_rank = Window.partitionBy("race_id").orderBy(F.col("cum_points").desc(), F.col("driver_id"))
    return ds.select(
        "race_id", "driver_id",
        F.col("cum_points").alias("points"),
        F.row_number().over(w_rank).alias("position"),
        F.row_number().over(w_rank).cast("string").alias("position_text"),
        F.col("cum_wins").cast("int").alias("wins"),
        "year",
    )


def bind_constructor_standings(results_src: DataFrame, races: DataFrame, last_round: int | None = None) -> DataFrame:
    if last_round is None:
        last_round = races.agg(F.max("round")).first()[0] or 0
    per_team = _raced(results_src).groupBy("race_id", "constructor_id", "year", "round").agg(
        F.sum("points").alias("points"),
        F.count(F.when(F.col("position") == 1, 1)).alias("win"))
    cs = running_sum(per_team, ["constructor_id", "year"], "round",
                     {"cum_points": "points", "cum_wins": "win"}, STANDINGS_BLOCK, scan_levels(last_round + 1, STANDINGS_BLOCK))
    w_rank_c = Window.partitionBy("race_id").orderBy(F.col("cum_points").desc(), F.col("constructor_id"))
    return cs.select(
        "race_id", "constructor_id",
        F.col("cum_points").alias("points"),
        F.row_number().over(w_rank_c).alias("position"),
        F.row_number().over(w_rank_c).cast("string").alias("position_text"),
        F.col("cum_wins").cast("int").alias("wins"),
        "year",
    )


def bind_laps(results_src: DataFrame) -> DataFrame:
    n = F.col("n")
    laps_base = results_src.select(
        "race_id", "driver_id", "year",
        F.explode(F.sequence(F.lit(1), (F.col("_partkey") % 11 + 5).cast("int"))).alias("n"))
    stint = ((n - 1) / 5).cast("int") + 1
    tyre = (n - 1) % 5 + 1
    compound = (F.when(stint == 1, F.when(F.col("race_id") % 2 == 0, "SOFT").otherwise("MEDIUM"))
                .when(stint == 2, F.lit("HARD"))
                .when(F.col("driver_id") % 5 == 0, F.lit("INTERMEDIATE"))
                .when(F.col("driver_id") % 5 == 1, F.lit(None).cast("string"))
                .when(F.col("driver_id") % 5 == 2, F.lit("UNKNOWN"))
                .otherwise(F.lit("MEDIUM")))
    wear = F.when(compound == "SOFT", 0.25).when(compound == "MEDIUM", 0.125).otherwise(0.0625)
    s1 = F.lit(25.0) + (F.col("driver_id") % 7) * 0.125 + tyre * 0.125
    s2 = F.lit(30.0) + (F.col("race_id") % 5) * 0.25
    lap_t = (F.lit(80.0) + (F.col("driver_id") % 13) * 0.25 + (F.col("race_id") % 17) * 0.5
             + tyre.cast("double") * wear)
    missing_lap = (F.col("race_id") + n) % 29 == 0
    return laps_base.select(
        "race_id", "driver_id",
        n.cast("int").alias("lap_number"),
        F.when(missing_lap, F.lit(None).cast("double")).otherwise(lap_t).alias("lap_time_s"),
        s1.alias("sector1_s"),
        s2.alias("sector2_s"),
        F.when(n % 13 == 0, F.lit(None).cast("double")).otherwise(lap_t - s1 - s2).alias("sector3_s"),
        compound.alias("compound"),
        tyre.cast("int").alias("tyre_life"),
        stint.cast("int").alias("stint"),
        ((tyre == 2) & (stint == 1)).alias("is_personal_best"),
        (tyre == 5).alias("pit_in"),
        ((tyre == 1) & (stint > 1)).alias("pit_out"),
        F.when((F.col("race_id") + n) % 6 == 0, F.lit("4")).otherwise(F.lit("1")).alias("track_status"),
        "year",
    )


SOURCE_TABLES = ["nation", "region", "supplier", "customer", "orders", "lineitem"]
STAR_TABLES = ["circuits", "constructors", "drivers", "seasons", "races", "results",
               "qualifying", "pit_stops", "driver_standings", "constructor_standings", "laps"]


def season_span(t) -> tuple[int, int]:
    """First and last season of the races (0, 0 without any)."""
    first, last = t.races.agg(F.min("year"), F.max("year")).first()
    return first or 0, last or 0


def with_year(facts: DataFrame, races: DataFrame) -> DataFrame:
    """A fact table with its races' year, the column it is stored by; null for
    rows of unknown races."""
    return facts.join(races.select("race_id", "year").dropDuplicates(["race_id"]), "race_id", "left").select(*facts.columns, "year")


def _code_version() -> str:
    """Fingerprint of the binding rules themselves: a changed rule gets a
    fresh load instead of stale stored tables."""
    import hashlib

    with open(__file__, "rb") as fh:
        return hashlib.sha1(fh.read()).hexdigest()[:10]


class _Load:
    """The star tables of one input by name, bound and stored on first use.

    Stored are the dimensions, the entries and the standings, which take a
    shuffle to bind; a query that doesn't use one of them doesn't pay for it.
    Results, qualifying, pit stops and laps are each entry's row in another
    form (laps: some rows of it), so they are read from the stored entries,
    whose year prunes files for them too, and aren't written a second time."""

    def __init__(self, spark: SparkSession, sf_dir: str, store):
        self.spark, self.sf_dir, self.store = spark, sf_dir, store

    def stored(self, name: str) -> DataFrame:
        if not self.store.exists(name):
            self._write(name)
        return self.store.read(name)

    def _write(self, name: str) -> None:
        if name == "entries":
            self.store.write_full(name, bind_entries(self.spark, self.sf_dir, self.stored("races")), "year", shuffled=True)
        elif name == "driver_standings":
            self.store.write_full(name, bind_driver_standings(bind_results_src(self.stored("entries"))), "year", shuffled=True)
        elif name == "constructor_standings":
            self.store.write_full(name, bind_constructor_standings(bind_results_src(self.stored("entries")), self.stored("races")), "year", shuffled=True)
        elif name == "seasons":
            self.store.write_full(name, seasons_of(self.stored("races")))
        elif name == "races":
            self.store.write_full(name, bind_races(self.spark, self.sf_dir))
        else:
            self.store.write_full(name, bind_members(self.spark, self.sf_dir)[name])

    def __call__(self, name: str) -> DataFrame:
        if name == "pit_stops":
            return bind_pit_stops(self.stored("entries"))
        if name in ("results", "qualifying", "laps"):
            src = bind_results_src(self.stored("entries"))
            return src.drop("_partkey", "_round") if name == "results" else bind_qualifying(src) if name == "qualifying" else bind_laps(src)
        return self.stored(name)


def load_star(spark: SparkSession, sf_dir: str, root: str | None = None,
              refresh: bool = False) -> Star:
    """The star tables of the input. Each is bound and stored when it is first
    used (see ``_Load``), all at once with ``refresh``; later calls read the
    stored tables. The store lives in the shared checkpoint folder and is keyed
    by a fingerprint of the input files, so changed inputs get a fresh load."""
    from stintlake.session import shared_dir
    from stintlake.sources.store import Store

    base = Store(spark, root or shared_dir(spark, "stintlake-star"))
    sig = base.input_signature([f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SOURCE_TABLES]) + "-" + _code_version()
    load = _Load(spark, sf_dir, Store(spark, f"{base.root}/{sig}"))
    if refresh:
        for name in ("races", "entries", "circuits", "constructors", "drivers", "seasons", "driver_standings", "constructor_standings"):
            load._write(name)
    return Star(loader=load, key=sig)
