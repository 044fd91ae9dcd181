"""Window operators: lag/delta, running sums, forward fill, segments,
shares, best-of-group deltas, last-per-group and top-k.

Spark evaluates a window partition inside one task. When a partition key
can be hot (a team, a season), the ``block`` argument splits the ordered
partition into ranges of the order column: each range is windowed in its
own task and a tiny per-range table carries what crosses range borders.
The result equals the plain window exactly; only the work is spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UNB = Window.unboundedPreceding


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def scan_levels(span: int | None, block: int) -> int:
    """Levels of block carries that leave at most ``block`` rows of a part in
    any one window, if the order column spans ``span`` values."""
    n, left = 0, span or 0
    while left > block:
        left, n = -(-left // block), n + 1
    return n


def _last(c):
    return F.last(c, ignorenulls=True)


def _total(kind: str, c: str, order: str) -> Column:
    """What a block hands on to the blocks after it."""
    if kind == "last":
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))
    return {"sum": F.sum, "xor": F.bit_xor}[kind](c)


def _fold(kind: str, before: Column, own: Column) -> Column:
    if kind == "last":
        return F.coalesce(own, before)
    zero = F.lit(0)
    before, own = F.coalesce(before, zero), F.coalesce(own, zero)
    return before + own if kind == "sum" else before.bitwiseXOR(own)


def prefix_scan(df: DataFrame, part, order, values: dict[str, Column | str], kind: str = "sum",
                inclusive: bool = True, block: int | None = None, levels: int = 1) -> DataFrame:
    """Add a running ``kind`` ("sum", "xor" of bits, or "last" non-null value)
    of ``values`` per ``part`` in ``order``, up to each row or to the one before.

    With ``block`` (order must then be one integer column) a window holds the
    rows of one block of the order column only. The blocks' totals are scanned
    in the same way, block by block of blocks, ``levels`` times; the last
    level is one window a part. With ``scan_levels`` that window holds at most
    ``block`` rows, so no task grows with a part. ``levels`` 0 is the plain
    window.
    """
    part, order = _cols(part), _cols(order)
    vals = {k: (F.col(v) if isinstance(v, str) else v) for k, v in values.items()}
    fn = {"sum": F.sum, "xor": F.bit_xor, "last": _last}[kind]
    frame = 0 if inclusive else -1
    if not block or levels < 1:
        w = Window.partitionBy(*part).orderBy(*order).rowsBetween(_UNB, frame)
        return df.select("*", *[fn(v).over(w).alias(k) for k, v in vals.items()])
    o, blk = order[0], f"__blk{levels}"  # names by level: a level's input holds those of the one below
    base = df.select("*", *[v.alias(f"__v_{k}") for k, v in vals.items()], _block(o, block).alias(blk))
    w_in = Window.partitionBy(*part, blk).orderBy(*order).rowsBetween(_UNB, frame)
    within = base.select("*", *[fn(f"__v_{k}").over(w_in).alias(f"__in_{k}") for k in vals])
    # totals from the windowed rows: they are dealt by (part, block) already,
    # so the aggregate adds no shuffle of the big side
    totals = within.groupBy(*part, blk).agg(*[_total(kind, f"__v_{k}", o).alias(f"__t_{k}") for k in vals])
    carried = prefix_scan(totals, part, blk, {f"__off_{k}": f"__t_{k}" for k in vals}, kind, False, block, levels - 1)
    keys = [*part, blk]
    carried = carried.select(*[F.col(c).alias(f"__key_{c}") for c in keys], *[f"__off_{k}" for k in vals])
    out = within.join(carried, [F.col(c).eqNullSafe(F.col(f"__key_{c}")) for c in keys], "inner")
    return out.select(*df.columns, *[_fold(kind, F.col(f"__off_{k}"), F.col(f"__in_{k}")).alias(k) for k in vals])


def _block(order: str, block: int) -> Column:
    return F.floor(F.col(order) / F.lit(block)).cast("bigint")


def running_sum(df: DataFrame, part, order, values: dict[str, Column | str],
                block: int | None = None, levels: int = 1) -> DataFrame:
    """Add ``ROWS UNBOUNDED PRECEDING .. CURRENT ROW`` sums of ``values`` per
    ``part`` ordered by ``order`` (unique within a part); see ``prefix_scan``
    for ``block`` and ``levels``."""
    return prefix_scan(df, part, order, values, "sum", True, block, levels)


def with_lag(df: DataFrame, part, order, value: str, out: str = "prev",
             block: int | None = None, levels: int = 1) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY part ORDER BY order)`` as column ``out``."""
    if not block or levels < 1:
        w = Window.partitionBy(*_cols(part)).orderBy(*_cols(order))
        return df.withColumn(out, F.lag(value).over(w))
    # in a struct, a null of the row before counts as its value
    held = prefix_scan(df, part, order, {"__prev": F.struct(F.col(value).alias("v"))}, "last", False, block, levels)
    return held.select(*df.columns, F.col("__prev.v").alias(out))


def with_lag_delta(df: DataFrame, part, order, value: str, prev: str = "prev_points",
                   delta: str = "points_gained", fallback: bool = True,
                   block: int | None = None, levels: int = 1) -> DataFrame:
    """Previous value and the change to it. With ``fallback`` the first row
    of a part takes its own value as the change (COALESCE form)."""
    out = with_lag(df, part, order, value, prev, block, levels)
    d = F.col(value) - F.col(prev)
    if fallback:
        d = F.coalesce(d, F.col(value))
    return out.withColumn(delta, d)


def ffill(df: DataFrame, part, order, cols: Sequence[str], block: int | None = None, levels: int = 1) -> DataFrame:
    """Forward fill: last non-null value at or before each row; see
    ``prefix_scan`` for ``block`` and ``levels``."""
    filled = prefix_scan(df, part, order, {f"__f_{c}": c for c in cols}, "last", True, block, levels)
    return filled.select(*[F.col(f"__f_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def segments(df: DataFrame, part, order, value: str, out: str = "segment", block: int | None = None,
             levels: int = 1) -> DataFrame:
    """Segment id that increases whenever the sign of ``value`` flips
    against the previous row (lead changes): a lag of the sign and a
    running sum of the flips; see ``prefix_scan`` for ``block`` and ``levels``."""
    tmp = df.withColumn("__sign", F.signum(F.col(value)))
    tmp = with_lag(tmp, part, order, "__sign", "__prev_sign", block, levels)
    changed = F.when(F.col("__prev_sign").isNull() | (F.col("__prev_sign") == F.col("__sign")), 0).otherwise(1)
    tmp = tmp.withColumn("__chg", changed)
    return running_sum(tmp, part, order, {out: "__chg"}, block, levels).drop("__sign", "__prev_sign", "__chg")


def _with_part(df: DataFrame, part, *aggs: Column) -> DataFrame:
    """Each row with aggregates of its part, by an aggregate (with partial
    sums) that is joined on: no task holds a whole part."""
    part = _cols(part) if part else []
    keys = [F.col(c).alias(f"__{c}") for c in part]
    if not part:
        keys, part = [F.lit(0).alias("__all")], []
    totals = df.groupBy(*keys).agg(*aggs)
    on = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in part] or [F.lit(0) == F.col("__all")]
    return df.join(totals, on).drop(*[f"__{c}" for c in part] or ["__all"])


def share_of_total(df: DataFrame, value: str, part=(), out: str = "share",
                   digits: int | None = 2) -> DataFrame:
    """``value * 100 / SUM(value)`` of the part."""
    from stintlake.functions.columns import round_half_up

    both = _with_part(df, part, F.sum(value).alias("__total"))
    s = F.col(value) * F.lit(100.0) / F.col("__total")
    return both.withColumn(out, round_half_up(s, digits) if digits is not None else s).drop("__total")


def delta_from_best(df: DataFrame, cols: Sequence[str], part=(), suffix: str = "_gap") -> DataFrame:
    """``x - min(x)`` over the rows of a part, per column."""
    both = _with_part(df, part, *[F.min(c).alias(f"__min_{c}") for c in cols])
    return both.select(*df.columns, *[(F.col(c) - F.col(f"__min_{c}")).alias(c + suffix) for c in cols])


def top_k(df: DataFrame, part, order: Sequence[Column], k: int) -> DataFrame:
    """k first rows per part in ``order`` (ties broken by the caller's keys).

    ``row_number() <= k`` is planned with a partial group limit before the
    shuffle, so at most k rows per part and map task cross the network.
    """
    part = _cols(part) if part else []
    w = (Window.partitionBy(*part) if part else Window.partitionBy()).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")
