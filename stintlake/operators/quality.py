"""Post-load integrity checks, contracts and column tests.

Result shape everywhere: a DataFrame of ``(check, value, expected)`` rows
(strings); any failure row means the gate fails. The checks of a table are
evaluated in ONE aggregate pass and unpivoted to rows; for the large fact
tables (results, laps) that pass includes the foreign keys, through left
joins to the distinct parent keys; qualifying and pit stops use anti joins.
A null key counts as an orphan. A
check whose plan cannot be built (missing table or column) becomes an
``error: ...`` row instead of aborting the run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from stintlake import DNF_POSITION_ORDER
from stintlake.schemas import COMPOUNDS, SCHEMAS, contract, is_family

CHECK_SCHEMA = "check string, value string, expected string"


def _rows(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def _agg_checks(df: DataFrame, checks: dict[str, Column], expected: dict[str, str]) -> DataFrame:
    """One pass: every count of the table as a column, then unpivot to rows."""
    one = df.agg(*[c.cast("bigint").alias(n) for n, c in checks.items()])
    long = one.unpivot([], list(checks), "check", "n")
    exp = F.create_map(*[x for n in checks for x in (F.lit(n), F.lit(expected.get(n, "0")))])
    return long.select("check", F.col("n").cast("string").alias("value"), exp[F.col("check")].alias("expected"))


def _with_parent_flags(child: DataFrame, fks: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Tag each child row with whether each foreign key finds a parent
    (parents reduced to distinct non-null keys, so a duplicated parent key
    cannot multiply rows). One pass then counts every orphan kind."""
    out = child
    for key, parent, flag in fks:
        keys = parent.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
        out = out.join(keys, key, "left")
    return out


def _orphans(child: DataFrame, parent: DataFrame, key: str) -> Column:
    return child.join(parent.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti") \
        .agg(F.count(F.lit(1)).alias("n"))


def _guard(spark, name: str, build: Callable[[], DataFrame], run: bool = False) -> DataFrame:
    """The check's rows, or one row with its error. An unbuildable plan shows
    at once; with ``run`` the check is also carried out here (a few rows), so
    that a failure of its job is a row too and the other checks go on."""
    try:
        df = build()
        df.schema  # force analysis: missing tables / columns surface here
        return _rows(spark, [tuple(r) for r in df.select("check", "value", "expected").collect()]) if run else df
    except (PySparkException, AttributeError, KeyError) as exc:
        msg = str(exc).split("\n")[0][:200]
        return _rows(spark, [(name, f"error: {msg}", "query_success")])


def quality_checks(t, start_year: int, end_year: int, skipped: DataFrame | None = None, isolate: bool = False,
                   every_race: bool = False) -> DataFrame:
    """Every check with its measured value: ``check, value, expected, failed``.
    ``isolate`` carries out each group of checks by itself (see ``_guard``), as
    the gate of a load does; else all are one plan.

    ``skipped``: (dataset, year, round) rows known to be absent at the
    source; they do not count as races missing results / qualifying.
    ``every_race``: races of seasons outside the range must have them as well.
    """
    spark = t.results.sparkSession
    parts: list[DataFrame] = []

    def add(name: str, build: Callable[[], DataFrame]) -> None:
        parts.append(_guard(spark, name, build, isolate))

    # non-empty, year range, primary-key uniqueness (one pass per table)
    # results: emptiness, three foreign keys and the value rules in ONE pass
    parents = {"race": "races", "driver": "drivers", "constructor": "constructors"}
    rules = {"results_non_empty": F.count(F.lit(1))}
    rules.update({f"results_{c}_non_negative": F.count_if(F.col(c).try_cast("double") < 0)
                  for c in ("points", "laps", "grid", "position_order")})
    rules["results_position_order_consistency"] = F.count_if(
        F.col("position").try_cast("int").between(1, 20) & (F.col("position_order").try_cast("int") == DNF_POSITION_ORDER))

    def results_pass(fks: list[str], own: dict[str, Column]) -> DataFrame:
        tagged = _with_parent_flags(t.results, [(f"{k}_id", getattr(t, parents[k]), f"__{k}") for k in fks])
        checks = own | {f"results_{k}_fk": F.count_if(F.col(f"__{k}").isNull()) for k in fks}
        return _agg_checks(tagged, checks, {"results_non_empty": "> 0"})

    try:  # all of them in one pass; where one can't be built, each by itself, so that it alone is reported
        together = results_pass(list(parents), rules)
        together.schema  # noqa: B018 - analysis
        parts.append(_rows(spark, [tuple(r) for r in together.collect()]) if isolate else together)
    except (PySparkException, AttributeError, KeyError):
        del parts[:]
        for name, rule in rules.items():
            add(name, lambda n=name, r=rule: results_pass([], {n: r}))
        for k in parents:
            add(f"results_{k}_fk", lambda k=k: results_pass([k], {}))
    add("drivers", lambda: _agg_checks(t.drivers, {
        "drivers_non_empty": F.count(F.lit(1)),
        "drivers_unique": F.count(F.lit(1)) - F.count_distinct("driver_id")},
        {"drivers_non_empty": "> 0"}))
    add("races", lambda: _agg_checks(t.races, {
        "races_non_empty": F.count(F.lit(1)),
        "races_outside_year_range": F.count_if((F.col("year") < start_year) | (F.col("year") > end_year)),
        "races_unique": F.count(F.lit(1)) - F.count_distinct("race_id")},
        {"races_non_empty": "> 0"}))
    add("constructors", lambda: _agg_checks(t.constructors, {
        "constructors_unique": F.count(F.lit(1)) - F.count_distinct("constructor_id")}, {}))
    add("circuits", lambda: _agg_checks(t.circuits, {
        "circuits_unique": F.count(F.lit(1)) - F.count_distinct("circuit_id")}, {}))
    # foreign keys (anti joins; a null key is an orphan)
    for child, key, parent in [("qualifying", "race_id", "races"), ("pit_stops", "race_id", "races")]:
        name = f"{child}_{key.replace('_id', '')}_fk"
        add(name, lambda c=child, k=key, p=parent, n=name: _orphans(getattr(t, c), getattr(t, p), k)
            .select(F.lit(n).alias("check"), F.col("n").cast("string").alias("value"),
                    F.lit("0").alias("expected")))
    # all seasons present (expected minus present)
    def missing_years() -> DataFrame:
        present = t.races.filter(F.col("year").between(start_year, end_year)).select("year").distinct()
        exp = spark.range(start_year, end_year + 1).select(F.col("id").cast("int").alias("year"))
        miss = exp.join(present, "year", "left_anti")
        return miss.agg(F.array_join(F.array_sort(F.collect_list("year")), ", ").alias("value")) \
            .select(F.lit("missing_race_years").alias("check"),
                    F.coalesce(F.nullif("value", F.lit("")), F.lit("")).alias("value"),
                    F.lit(f"All years {start_year}-{end_year}").alias("expected"))
    add("missing_race_years", missing_years)
    # races without results / qualifying, minus known skipped rounds
    for fact, name, ds in [("results", "races_missing_results", "results"),
                           ("qualifying", "races_missing_qualifying", "qualifying")]:
        def build(fact=fact, name=name, ds=ds) -> DataFrame:
            races = t.races if every_race else t.races.filter(F.col("year").between(start_year, end_year))
            miss = races.join(getattr(t, fact).select("race_id").distinct(), "race_id", "left_anti")
            if skipped is not None:
                sk = skipped.filter(F.col("dataset") == ds).select("year", "round")
                miss = miss.join(sk, ["year", "round"], "left_anti")
            return miss.agg(F.count(F.lit(1)).cast("string").alias("value")) \
                .select(F.lit(name).alias("check"), "value", F.lit("0").alias("expected"))
        add(name, build)
    # lap checks in one pass (all zero when there are no laps, as if skipped)
    def laps_pass() -> DataFrame:
        tagged = _with_parent_flags(t.laps, [("driver_id", t.drivers, "__driver"), ("race_id", t.races, "__race")])
        return _agg_checks(tagged, {
            "laps_lap_time_bounds": F.count_if(F.col("lap_time_s").isNotNull()
                                               & ((F.col("lap_time_s") < 60) | (F.col("lap_time_s") > 300))),
            "laps_invalid_compound": F.count_if(F.col("compound").isNotNull() & ~F.col("compound").isin(COMPOUNDS)),
            "laps_driver_fk": F.count_if(F.col("__driver").isNull()),
            "laps_race_fk": F.count_if(F.col("__race").isNull()),
        }, {})
    add("laps", laps_pass)

    allc = parts[0]
    for p in parts[1:]:
        allc = allc.unionByName(p)
    failed = (F.when(F.col("value").startswith("error:"), True)
              .when(F.col("expected") == "> 0", F.col("value") == "0")
              .when(F.col("check") == "missing_race_years", F.col("value") != "")
              .otherwise(F.col("value") != F.col("expected")))
    return allc.withColumn("failed", failed)


def run_checks(t, start_year: int, end_year: int, skipped: DataFrame | None = None, isolate: bool = False,
               every_race: bool = False) -> DataFrame:
    """The gate: failing checks only (empty frame = pass)."""
    return quality_checks(t, start_year, end_year, skipped, isolate, every_race).filter("failed").drop("failed")


# --- contracts -----------------------------------------------------------

def _static_issues(schema, table: str, c: dict) -> list[str]:
    """Missing required columns and wrong type families."""
    cols = {f.name: f.dataType for f in schema.fields}
    missing = [n for n in c["required"] if n not in cols]
    return ([f"Missing required columns: {', '.join(missing)}"] if missing else []) + \
        [f"{n} is not {fam}" for n, fam in c["families"].items() if n in cols and not is_family(cols[n], fam)]


def _below(name: str, bound) -> Column:
    return F.coalesce(F.col(name).cast("string").try_cast("double") < bound, F.lit(False))


def _unexpected(name: str, allowed) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != "") & ~F.col(name).isin(list(allowed))


def enum_findings(df: DataFrame, table: str) -> DataFrame:
    """Values outside the contract's lists, one row each: table, column, value,
    rows. Each row's bad values are exploded in one pass and counted with
    partial sums, so a column may have any number of them."""
    c = contract(table) or {"enum": {}}
    enums = {n: v for n, v in c["enum"].items() if n in df.columns}
    if not enums:
        return df.sparkSession.createDataFrame([], "table string, column string, value string, rows bigint")
    bad = F.array(*[F.when(_unexpected(n, v), F.struct(F.lit(n).alias("column"), F.col(n).cast("string").alias("value"))) for n, v in enums.items()])
    return (df.select(F.explode(F.filter(bad, lambda x: x.isNotNull())).alias("x")).groupBy("x.column", "x.value")
            .agg(F.count(F.lit(1)).alias("rows")).select(F.lit(table).alias("table"), "column", "value", "rows"))


def validate(df: DataFrame, table: str) -> DataFrame:
    """Contract issues of ``df`` as rows ``(table, issue)``.

    Schema-level issues (missing required column, wrong type family) come
    from the DataFrame schema without a job; values below a minimum are
    counted in one pass, and values outside a list (nulls skipped, '' allowed)
    give a row each with their count.
    """
    spark = df.sparkSession
    c = contract(table)
    if c is None:
        return spark.createDataFrame([(table, f"No schema contract defined for {table}")], "table string, issue string")
    out = spark.createDataFrame([(table, i) for i in _static_issues(df.schema, table, c)], "table string, issue string")
    bounds = {n: b for n, b in c["min"].items() if n in df.columns}
    if bounds:
        long = df.agg(*[F.count_if(_below(n, b)).alias(n) for n, b in bounds.items()]).unpivot([], list(bounds), "column", "n")
        bound = F.create_map(*[x for n, b in bounds.items() for x in (F.lit(n), F.lit(str(b)))])
        out = out.unionByName(long.filter("n > 0").select(F.lit(table).alias("table"), F.concat(
            "column", F.lit(" has "), F.col("n").cast("string"), F.lit(" values below minimum "), bound[F.col("column")]).alias("issue")))
    found = enum_findings(df, table)
    return out.unionByName(found.select("table", F.format_string("%s has unexpected value '%s' in %d rows", "column", "value", "rows").alias("issue")))


class ContractError(ValueError):
    pass


#: Issues that a raised or returned message names; more are counted only.
MOST_NAMED = 20


def enforce(df: DataFrame, table: str, strict: bool = True) -> list[str]:
    """Strict: raise on any contract issue. Relaxed: return them as warnings,
    the first ``MOST_NAMED`` of them."""
    issues = [r["issue"] for r in validate(df, table).limit(MOST_NAMED).collect()]
    if issues and strict:
        raise ContractError(f"Schema validation issues for {table}: {issues}")
    return issues


class LoadMetrics:
    """Rows, lost values and contract counts of a table, measured while it is
    written: ``df`` is to be written once, then ``warnings`` tells what the
    write saw. (A retried shuffle task can be counted again.)"""

    def __init__(self, raw: DataFrame, table: str):
        self.table, c = table, contract(table) or {"required": [], "families": {}, "min": {}, "enum": {}}
        df, lost = _coerced(raw, c, table)
        self.schema_issues = _static_issues(df.schema, table, c) if contract(table) else [f"No schema contract defined for {table}"]
        self._bounds = {n: b for n, b in c["min"].items() if n in df.columns}
        enums = {n: v for n, v in c["enum"].items() if n in df.columns}
        self._seen = Observation(f"load-{table}")
        self._lost = list(lost)
        # values lost are judged on the raw columns, which the coerced ones replace
        tagged = df if not lost else raw.select(*[F.struct(*[e.alias(n) for n, e in lost.items()]).alias("__lost"), *_selected(raw, c, table)])
        self.df = tagged.observe(
            self._seen, F.count(F.lit(1)).alias("rows"),
            *[F.sum(F.col(f"__lost.{n}").cast("int")).alias(f"lost_{n}") for n in lost],
            *[F.count_if(_below(n, b)).alias(f"min_{n}") for n, b in self._bounds.items()],
            *[F.count_if(_unexpected(n, v)).alias(f"enum_{n}") for n, v in enums.items()]).drop("__lost")
        self._enums = list(enums)

    @property
    def rows(self) -> int:
        return self._seen.get["rows"]

    def lost(self) -> list[str]:
        got = self._seen.get
        return [f"Coerced {got[f'lost_{n}']} invalid values to null in {self.table}.{n}." for n in self._lost if got[f"lost_{n}"]]

    def issues(self) -> list[str]:
        got = self._seen.get
        return (self.schema_issues
                + [f"{n} has {got[f'min_{n}']} values below minimum {b}" for n, b in self._bounds.items() if got[f"min_{n}"]]
                + [f"{n} has {got[f'enum_{n}']} unexpected values" for n in self._enums if got[f"enum_{n}"]])

    def judge(self, strict: bool) -> None:
        """To be called between the write and its commit."""
        if strict and self.issues():
            raise ContractError(f"Schema validation issues for {self.table}: {self.issues()}")


def coerce(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Contract coercion before validation: strings null → '', numeric and
    date columns parsed with ``try_cast`` (bad → null). Returns the frame
    and a one-row frame of values lost per coerced column."""
    c = contract(table)
    if c is None:
        return df, df.sparkSession.createDataFrame([], "column string, lost bigint")
    out, lost = _coerced(df, c, table)
    if not lost:
        return out, df.sparkSession.createDataFrame([], "column string, lost bigint")
    counts = df.agg(*[F.count_if(e).alias(n) for n, e in lost.items()])
    return out, counts.unpivot([], counts.columns, "column", "lost")


def _parsed(f, c: dict, table: str) -> Column | None:
    """How a column of another family than the contract's is parsed, if it is."""
    fam = c["families"].get(f.name)
    if fam not in ("numeric", "datetime") or is_family(f.dataType, fam):
        return None
    return F.col(f.name).cast("string").try_cast(SCHEMAS[table][f.name].dataType)


def _selected(df: DataFrame, c: dict, table: str) -> list[Column]:
    out = []
    for f in df.schema.fields:
        new = _parsed(f, c, table)
        if c["families"].get(f.name) == "string":
            new = F.coalesce(F.col(f.name).cast("string"), F.lit(""))
        out.append((F.col(f.name) if new is None else new).alias(f.name))
    return out


def _coerced(df: DataFrame, c: dict, table: str) -> tuple[DataFrame, dict[str, Column]]:
    """The coerced frame, and per parsed column whether a row loses its value."""
    lost = {f.name: F.col(f.name).isNotNull() & new.isNull() for f in df.schema.fields if (new := _parsed(f, c, table)) is not None}
    return df.select(*_selected(df, c, table)), lost


# --- column tests (not_null / unique) -----------------------------------

def column_tests(df: DataFrame, model: str, not_null=(), unique=()) -> DataFrame:
    """``not_null`` and ``unique`` tests of one model in one pass:
    rows ``(model, column, test, failures)``."""
    aggs, names = [], []
    for c in not_null:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}|not_null"))
        names.append(f"{c}|not_null")
    for c in unique:
        # duplicated non-null values: rows minus distinct values
        aggs.append((F.count(c) - F.count_distinct(c)).alias(f"{c}|unique"))
        names.append(f"{c}|unique")
    one = df.agg(*aggs)
    long = one.unpivot([], names, "k", "failures")
    return long.select(F.lit(model).alias("model"),
                       F.split("k", r"\|").getItem(0).alias("column"),
                       F.split("k", r"\|").getItem(1).alias("test"),
                       F.col("failures").cast("bigint").alias("failures"))


def duplicate_keys(df: DataFrame, keys, name: str = "table") -> DataFrame:
    """Primary-key check on any table: rows, distinct keys, duplicates."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    d = df.select(*keys).distinct().agg(F.count(F.lit(1))).scalar()
    n = df.agg(F.count(F.lit(1)).alias("rows"))
    return n.select(F.lit(name).alias("table"), "rows", d.alias("distinct_keys"),
                    (F.col("rows") - d).alias("duplicates"))
