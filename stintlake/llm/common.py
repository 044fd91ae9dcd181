"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def small_batches(spark: SparkSession) -> None:
    """Documents go to Python in batches of 1,000 rows, unless the session
    asks for another size: both sides hold a whole batch beside the heap."""
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(size) == "10000":  # Spark's default
        spark.conf.set(size, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that other
    columns of the input can't clash with them."""
    return df.select(*[df[src].alias(dst) for dst, src in cols.items()])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder that the cluster names and read it
    back: cuts lineage and survives a lost executor."""
    path = shared_dir(df.sparkSession, f"stintlake-llm/{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id) -> F.Column:
    """True for the fifth of the ids that no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def release() -> None:
    """Give freed memory back to the system. Python workers live on between
    tasks, beside the executor's heap, and would keep their peak."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run):
    """A task's function over an iterator of batches that releases its memory at the end."""
    @functools.wraps(run)
    def inner(frames: Iterator) -> Iterator:
        try:
            yield from run(frames)
        finally:
            release()

    return inner


def blocks(frames: Iterator, limit: int, key: str = "text") -> Iterator:
    """Regroup a task's pandas batches into frames of about ``limit`` bytes of
    ``key`` (a longer row is a frame of its own). Bounds a task's memory."""
    import pandas as pd

    have, size = [], 0
    for pdf in frames:
        lens = pdf[key].str.len().fillna(0).to_numpy(np.int64)
        start = 0
        cum = np.cumsum(lens)
        base = 0
        for i in range(len(pdf)):
            if size + cum[i] - base >= limit:
                have.append(pdf.iloc[start:i + 1])
                yield pd.concat(have, ignore_index=True)
                have, size, start, base = [], 0, i + 1, cum[i]
        if start < len(pdf):
            have.append(pdf.iloc[start:])
            size += int(cum[-1] - base)
    if have:
        yield pd.concat(have, ignore_index=True)


#: DuckDB has no CRC-32: ``crc_table`` (one row, list ``crcs``) and ``crc32_sql`` state it.
CRC32_SQL = """crc_table AS (SELECT list(v ORDER BY i) AS crcs FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
               lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) AS r(i)))"""


def crc32_sql(of: str) -> str:
    """CRC-32 of a list of bytes (BIGINT), beside a join with ``crc_table``."""
    return f"xor(list_reduce(list_prepend(4294967295, {of}), lambda a, b: xor(a >> 8, crcs[(xor(a, b) & 255) + 1])), 4294967295)"
