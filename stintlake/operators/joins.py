"""Join helpers for the star schema.

Dimension tables (drivers, constructors, circuits) are joined without
explicit broadcast hints: Spark's planner broadcasts a side only when its
size estimate is under ``spark.sql.autoBroadcastJoinThreshold`` (a checked
bound), and AQE re-plans from measured shuffle sizes. Fact-to-fact joins on
(race_id, driver_id) shuffle on both keys.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.functions.columns import full_name


def team_filter(df: DataFrame, cid=None, col: str = "constructor_id") -> DataFrame:
    """Keep one team (int), several (list) or all (None). Pushed to the scan."""
    if cid is None:
        return df
    if isinstance(cid, (list, tuple, set)):
        return df.filter(F.col(col).isin(list(cid)))
    return df.filter(F.col(col) == F.lit(cid))


REF_PATTERN = re.compile(r"^[a-z0-9_]+$")


def check_refs(refs: Iterable[str]) -> list[str]:
    """Team refs must be lower-case words (letters, digits, '_')."""
    refs = list(refs)
    bad = [r for r in refs if not isinstance(r, str) or not REF_PATTERN.match(r)]
    if bad:
        raise ValueError(f"invalid team refs: {bad}")
    return refs


def team_by_refs(results: DataFrame, constructors: DataFrame, refs: Iterable[str] | None,
                 col: str = "constructor_id") -> DataFrame:
    """Keep rows whose team ref is in ``refs`` (a semi join, no columns added)."""
    if refs is None:
        return results
    refs = check_refs(refs)
    keep = constructors.filter(F.col("constructor_ref").isin(list(refs))).select(col)
    return results.join(keep, col, "left_semi")


def with_driver_name(df: DataFrame, drivers: DataFrame, out: str = "driver_name",
                     null_safe: bool = True, key: str = "driver_id") -> DataFrame:
    """Attach ``forename || ' ' || surname`` of the driver."""
    d = drivers.select(F.col("driver_id").alias(key),
                       full_name("forename", "surname", null_safe).alias(out))
    return df.join(d, key, "inner")


def star(results: DataFrame, races: DataFrame | None = None, drivers: DataFrame | None = None,
         constructors: DataFrame | None = None, circuits: DataFrame | None = None,
         race_cols=("year", "round"), driver_name: str | None = "driver_name",
         null_safe_names: bool = True) -> DataFrame:
    """Fact ⋈ races ⋈ drivers ⋈ constructors ⋈ circuits (inner, as the
    catalog queries do). Only requested dimension columns are carried."""
    out = results
    if races is not None:
        cols = ["race_id", *race_cols]
        if circuits is not None and "circuit_id" not in cols:
            cols.append("circuit_id")
        out = out.join(races.select(*cols), "race_id", "inner")
    if circuits is not None:
        out = out.join(circuits.select("circuit_id", "circuit_name", "country"), "circuit_id", "inner")
    if drivers is not None and driver_name:
        out = with_driver_name(out, drivers, driver_name, null_safe_names)
    if constructors is not None:
        out = out.join(constructors.select("constructor_id", "constructor_ref", "constructor_name"),
                       "constructor_id", "inner")
    return out


def pairs(df: DataFrame, group_cols, id_col: str, value_cols) -> DataFrame:
    """Ordered pairs ``a.id < b.id`` within each group (teammates in a race).

    An equi-join on the group keys with an inequality residual; groups are
    bounded by the team size per race (two drivers, at most a handful), so
    the output is linear in the input.
    """
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    value_cols = [value_cols] if isinstance(value_cols, str) else list(value_cols)
    a = df.select(*group_cols, *[F.col(c).alias(f"{c}_a") for c in [id_col, *value_cols]])
    b = df.select(*group_cols, *[F.col(c).alias(f"{c}_b") for c in [id_col, *value_cols]])
    return a.join(b, group_cols, "inner").filter(F.col(f"{id_col}_a") < F.col(f"{id_col}_b"))


def resolve_ref(df: DataFrame, ref_col: str, id_col: str, dim: DataFrame | None,
                seq_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Map a text reference to the integer key of a dimension.

    * the map is deduplicated per ref, the **last** row (highest ``seq_col``,
      or highest id when no order column is given) winning;
    * rows whose ref has no entry are dropped (never mapped to 0);
    * a missing map (``dim`` None) yields an empty result.

    Returns ``(mapped, dropout)``; ``dropout`` is a one-row frame with
    ``rows, unmapped, dropout_pct, level`` (level 'error' above 5 %).
    """
    if dim is None:
        empty = df.filter(F.lit(False)).withColumn(id_col, F.lit(None).cast("int"))
        drop = df.agg(F.count(F.lit(1)).alias("rows"),
                      F.count(F.lit(1)).alias("unmapped")) \
            .withColumn("dropout_pct", F.when(F.col("rows") > 0, F.lit(100.0)).otherwise(F.lit(0.0))) \
            .withColumn("level", F.when(F.col("rows") > 0, F.lit("error")).otherwise(F.lit("ok")))
        return empty, drop
    order = seq_col or id_col
    mapping = (dim.filter(F.col(ref_col).isNotNull())
               .groupBy(ref_col)
               .agg(F.max_by(F.col(id_col), F.col(order)).alias("__id")))
    tagged = df.join(mapping, ref_col, "left")
    mapped = tagged.filter(F.col("__id").isNotNull()) \
        .withColumn(id_col, F.col("__id")).drop("__id")
    dropout = tagged.agg(F.count(F.lit(1)).alias("rows"),
                         F.count(F.when(F.col("__id").isNull(), 1)).alias("unmapped"))
    pct = F.when(F.col("rows") > 0, F.col("unmapped") * 100.0 / F.col("rows")).otherwise(F.lit(0.0))
    dropout = dropout.withColumn("dropout_pct", pct).withColumn(
        "level", F.when(F.col("dropout_pct") > 5.0, "error")
        .when(F.col("unmapped") > 0, "warning").otherwise("ok"))
    return mapped, dropout
