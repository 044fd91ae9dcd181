"""Spark session and cluster-folder helpers."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession


#: How stored tables are packed.
CODEC = "zstd"
#: Spark's switch for shuffle files that are removed once the statement that made them has run.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "stintlake") -> SparkSession:
    """Session for local runs and tests.

    On a cluster the session comes from the launcher: an active session is
    returned as it is, and of the settings below only those are filled that
    neither the launcher nor an argument gives. AQE re-plans joins from measured sizes,
    coalesces small shuffle partitions and splits skewed join partitions;
    hot keys in aggregates are handled by partial (map-side) aggregation,
    and in windows by the block split of ``operators.windows``.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    given = SparkConf()  # what spark-submit and spark-defaults have set
    wanted = {
        "spark.master": f"local[{cpus}]",
        "spark.app.name": app_name,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("STINTLAKE_DRIVER_MEM", "16g"),
    }
    asked = {"spark.master": master, "spark.sql.shuffle.partitions": shuffle_partitions}
    fill = {k: v for k, v in wanted.items() if not given.contains(k)} | {k: str(v) for k, v in asked.items() if v is not None}
    active = SparkSession.getActiveSession()
    spark = active or SparkSession.builder.config(map=fill).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; only when it is unset on a local master (tests) do
    we pick one: executors of a cluster don't share the driver's folders.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that driver and executors share (master {master})")
        path = tempfile.mkdtemp(prefix="stintlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, for written tables that
    cut lineage (survives executor loss, unlike local checkpoints)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


@contextlib.contextmanager
def brief_shuffles(spark: SparkSession):
    """What is written inside reads its shuffle files once: they go when the
    write ends, and not whenever the driver's heap is collected."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def cut_lineage(df, name: str = "cut"):
    """Write ``df`` as Parquet under the shared checkpoint folder and read
    it back: later branches read the stored rows instead of recomputing
    (and re-planning) the whole lineage. Survives executor loss, unlike a
    local checkpoint."""
    import uuid

    spark = df.sparkSession
    path = shared_dir(spark, f"stintlake-cut/{name}-{uuid.uuid4().hex[:12]}")
    with brief_shuffles(spark):
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return spark.read.parquet(path)


def scale_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings sized to the input for a cluster run.

    * initial shuffle partitions: enough that each holds about
      ``target_partition_bytes`` of the (largest) shuffled input, and at
      least two waves of tasks over the cores; AQE then coalesces small ones
      and splits skewed join partitions;
    * scan splits of 256 MB, so a 100 TB scan is ~400k tasks of bounded size;
    * broadcast threshold kept at a checked 64 MB: only dimension-sized sides.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
