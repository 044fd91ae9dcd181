"""Block-split windows equal the plain windows (hot partitions)."""

import random

from pyspark.sql import functions as F

from stintlake.operators.windows import running_sum, top_k, with_lag, with_lag_delta


def _data(spark, n=3000):
    rnd = random.Random(7)
    rows, seen = [], set()
    while len(rows) < n:
        p = rnd.choice([1, 1, 1, 2, 3])          # partition 1 is hot
        o = rnd.randrange(0, 5000)
        if (p, o) in seen:
            continue
        seen.add((p, o))
        rows.append((p, o, float(rnd.randrange(0, 30)), None if rnd.random() < 0.05 else rnd.randrange(0, 9)))
    return spark.createDataFrame(rows, "p int, o int, v double, x int")


def test_running_sum_block_equals_plain(spark):
    df = _data(spark)
    a = running_sum(df, "p", "o", {"s": "v", "c": F.coalesce("x", F.lit(0))})
    b = running_sum(df, "p", "o", {"s": "v", "c": F.coalesce("x", F.lit(0))}, block=64)
    cols = ["p", "o", "s", "c"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_lag_block_equals_plain(spark):
    df = _data(spark)
    a = with_lag(df, "p", "o", "x", "prev")
    b = with_lag(df, "p", "o", "x", "prev", block=50)
    cols = ["p", "o", "prev"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_lag_delta_fallback(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (1, 2, 15.0), (1, 3, 15.0)], "p int, o int, v double")
    got = [r.d for r in with_lag_delta(df, "p", "o", "v", "pv", "d").orderBy("o").collect()]
    assert got == [10.0, 5.0, 0.0]
    got = [r.d for r in with_lag_delta(df, "p", "o", "v", "pv", "d", fallback=False).orderBy("o").collect()]
    assert got == [None, 5.0, 0.0]


def test_top_k_per_group(spark):
    df = _data(spark)
    got = top_k(df, "p", [F.col("v").desc(), F.col("o")], 3).collect()
    assert sorted({r.p for r in got}) == [1, 2, 3] and len(got) == 9


def test_ffill_block_equals_plain(spark):
    from stintlake.operators.windows import ffill
    df = _data(spark)
    a = ffill(df, "p", "o", ["x"])
    b = ffill(df, "p", "o", ["x"], block=37)
    cols = ["p", "o", "x"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_segments_block_equals_plain(spark):
    from stintlake.operators.windows import segments
    df = _data(spark).withColumn("g", F.col("v") - 15)
    a = segments(df, "p", "o", "g", "seg")
    b = segments(df, "p", "o", "g", "seg", block=41)
    cols = ["p", "o", "seg"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_nested_scan_equals_plain(spark):
    """Thousands of blocks of one part, three levels deep; the last window of
    a part holds at most a block of rows."""
    from stintlake.operators.windows import ffill, prefix_scan, scan_levels, segments
    df = (spark.range(12_000).select(F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id") % 3).cast("int").alias("p"),
                                     F.col("id").cast("int").alias("o"), (F.xxhash64("id") % 7).alias("v"),
                                     F.when(F.xxhash64("id") % 11 != 0, F.xxhash64("id") % 9).alias("x"), F.xxhash64("id").alias("h")))
    assert scan_levels(12_000, 4) == 6 and scan_levels(4, 4) == 0 and scan_levels(None, 4) == 0 and scan_levels(17, 4) == 2
    levels = scan_levels(12_000, 12)
    assert levels == 3
    df = df.withColumn("p", F.when(F.col("p") > 0, F.col("p")))  # a null part too
    rows = lambda d, *c: sorted(map(str, d.select("p", "o", *c).collect()))
    assert rows(running_sum(df, "p", "o", {"s": "v"}), "s") == rows(running_sum(df, "p", "o", {"s": "v"}, 12, levels), "s")
    assert rows(with_lag(df, "p", "o", "x", "l"), "l") == rows(with_lag(df, "p", "o", "x", "l", 12, levels), "l")
    assert rows(ffill(df, "p", "o", ["x"]), "x") == rows(ffill(df, "p", "o", ["x"], 12, levels), "x")
    g = df.withColumn("g", F.col("v") - 3)
    assert rows(segments(g, "p", "o", "g", "s"), "s") == rows(segments(g, "p", "o", "g", "s", 64, 2), "s")
    assert rows(prefix_scan(df, "p", "o", {"z": "h"}, "xor"), "z") == rows(prefix_scan(df, "p", "o", {"z": "h"}, "xor", True, 12, levels), "z")
    assert running_sum(df.limit(0), "p", "o", {"s": "v"}, 4, 3).count() == 0


def test_numbered_equals_row_number(spark):
    from pyspark.sql import Window
    from stintlake.operators.ranges import numbered
    df = _data(spark).withColumn("p", F.when(F.col("p") != 3, F.col("p")))  # a null part too
    for part in (["p"], []):
        order = [F.col("v").desc(), F.col("o"), F.col("p")]
        a = df.withColumn("rn", F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        try:
            b = numbered(df, part, order)
            crossing = b.filter("p = 1").count()
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
            spark.conf.set("spark.sql.shuffle.partitions", "2")
        assert crossing == df.filter("p = 1").count()
        key = lambda d: sorted(map(str, d.select("p", "o", "v", "x", "rn").collect()))
        assert key(a) == key(b)
    assert numbered(df.limit(0), ["p"], [F.col("o")]).count() == 0


def test_numbers_with_and_without_windows(spark, monkeypatch):
    from pyspark.sql import Window

    from stintlake.operators import ranges

    df = _data(spark).withColumn("p", F.when(F.col("p") != 3, F.col("p")))
    order = [F.col("v").desc(), F.col("o"), F.col("p")]
    key = lambda d: sorted(map(str, d.select("p", "o", "v", "x", "rn").collect()))
    for part in (["p"], []):
        few = ranges.numbered(df, part, order)
        assert "WindowExec" not in (plan := few._jdf.queryExecution().executedPlan().toString()) and "row_number" not in plan
        monkeypatch.setattr(ranges, "FEW", 0)
        assert key(few) == key(ranges.numbered(df, part, order)) == key(
            df.withColumn("rn", F.row_number().over(Window.partitionBy(*part).orderBy(*order))))
        monkeypatch.undo()
