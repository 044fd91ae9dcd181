"""Tolerant table reads and CSV edges.

A missing, empty or header-only input is not an error: it yields an empty
frame with the declared schema (and a note), so downstream jobs still plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def input_size(spark: SparkSession, path: str) -> int | None:
    """Total bytes under ``path`` (file or folder); None when absent."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    return int(fs.getContentSummary(p).getLength())


def read_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv",
               notes: list | None = None) -> DataFrame:
    """Read ``path`` with the declared schema (no inference). Missing or
    empty input (no bytes) gives an empty frame with that schema."""
    size = input_size(spark, path)
    if not size:
        if notes is not None:
            notes.append(f"no rows read: {path} is absent or has no bytes")
        return spark.createDataFrame([], schema)
    if fmt == "csv":
        return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return spark.read.schema(schema).format(fmt).load(path)


def read_csv_strings(spark: SparkSession, path: str, columns: list[str], notes: list | None = None,
                     seq: str | None = None) -> DataFrame:
    """A raw CSV read by header name, every column as STRING (coercion
    happens in the transform jobs, where bad values become null and are
    counted). Expected columns absent from the file are added as null;
    columns are matched by name, not position. ``seq`` names a column to add
    with each row's place in its files (file, split, row), which orders them."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StringType, StructField

    place = F.struct(F.lit("").alias("file"), F.lit(0).cast("long").alias("split"), F.lit(0).cast("long").alias("row"))
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    if seq:
        schema = schema.add(spark.range(0).select(place.alias(seq)).schema[0])
    size = input_size(spark, path)
    if not size:
        if notes is not None:
            notes.append(f"no rows read: {path} is absent or has no bytes")
        return spark.createDataFrame([], schema)
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    have = set(df.columns)
    if not have & set(columns):
        if notes is not None:
            notes.append(f"{path} has no expected columns.")
        return spark.createDataFrame([], schema)
    out = [(F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in columns]
    if seq:
        at = F.col("_metadata")
        out.append(F.struct(at.file_path.alias("file"), at.file_block_start.alias("split"), F.monotonically_increasing_id().alias("row")).alias(seq))
    return df.select(*out)


def export_csv(df: DataFrame, path: str) -> str:
    """Write a result set as CSV with a header (the commit protocol makes
    the folder appear whole or not at all)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path
