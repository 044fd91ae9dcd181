"""Row numbers over a total order, without a task that sees a whole part.

The rows are range-partitioned by (part, order), so a part that holds a third
of all rows lies in many partitions. Every partition numbers its own rows; a
part that goes on in a later partition gets the number of its rows in the
earlier ones added. Only parts that cross a border need that, at most one per
border, so the joined table is as long as the number of partitions at most.
Where parts and partitions are few, a row's number follows from its place in
its partition alone, without a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlake.session import cut_lineage

#: Rows (a part in a partition each) of the table of first rows that is sent to all tasks; where there are more, windows number the rows.
FEW = 1 << 16


def numbered(df: DataFrame, part: Sequence[str], order: Sequence[Column], out: str = "rn",
             keep: dict[str, Column] | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY part ORDER BY order)`` as bigint
    column ``out`` (from 1). With no ``part`` the rows are numbered as a whole.

    ``order`` should be a total order; rows alike in it are numbered in any
    order. ``keep`` names the columns to return (evaluated after the sort, so
    that wide sort keys aren't written); all by default. The rows are written
    to the shared folder once: their partition must not change between uses.
    """
    part = list(part)
    keys = [F.col(c) for c in part]
    dealt = df.repartitionByRange(*keys, *order) if keys or order else df
    cols = {c: F.col(c) for c in df.columns} if keep is None else keep
    rows = cut_lineage(dealt.sortWithinPartitions(*keys, *order).select(
        *[v.alias(k) for k, v in cols.items()], F.monotonically_increasing_id().alias("__row")), "numbered")
    rows = rows.withColumn("__part", F.shiftright("__row", 33))
    held = rows.groupBy(*part, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    on = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in part] + [F.col("__part") == F.col("__p")]
    if held.count() <= FEW:  # their first rows fit beside every task, and the rows needn't meet again
        earlier = Window.partitionBy(*(part or [F.lit(0)])).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        start = held.select(*[F.col(c).alias(f"__k_{c}") for c in part], F.col("__part").alias("__p"),
                            (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first") + 1).alias("__start"))
        return rows.join(F.broadcast(start), on, "left").select(*cols, (F.col("__row") + F.col("__start")).alias(out))
    own = rows.withColumn(out, F.row_number().over(Window.partitionBy(*part, "__part").orderBy("__row")).cast("bigint"))
    if part:
        over = held.groupBy(*part).agg(F.count(F.lit(1)).alias("__parts")).filter("__parts > 1")
        split = held.join(over.select(*[F.col(c).alias(f"__k_{c}") for c in part]), on[:-1], "left_semi")
    else:
        split = held.withColumn("__all", F.lit(0))
    before = Window.partitionBy(*(part or ["__all"])).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per partition border at most, so the side is small whatever the input
    offset = split.select(*[F.col(c).alias(f"__k_{c}") for c in part], F.col("__part").alias("__p"),
                          F.sum("__n").over(before).alias("__before"))
    return (own.join(F.broadcast(offset), on, "left")
            .select(*cols, (F.col(out) + F.coalesce("__before", F.lit(0))).alias(out)))
