"""Versioned Parquet table store: full refresh, keyed upsert, slice replace.

Layout (any Hadoop-compatible file system, normally the shared folder the
cluster names in ``spark.checkpoint.dir``)::

    <root>/<table>/v<millis>-<id>/             one complete version (Parquet)
    <root>/<table>/v<millis>-<id>.committed    marker written after the data

    <root>/<table>/data/<col>=<value>/v=<id>/  of a table partitioned by <col>: the
                                               files that one commit wrote
    <root>/<table>/v<millis>-<id>.committed    marker: which of these are the version

Readers take the newest committed version, so a failed or concurrent
writer never exposes a partial table; the previous version stays on disk
as the backup of a full refresh. A table has one writer at a time.

Plain Parquet has no MERGE, so an upsert writes ``(target anti-join updates) ∪
updates`` anew: of a partitioned table only the partitions that hold an
updated row or get one, while the new version points to the other partitions'
files as they are; of another table everything. A filter on the partition
column prunes files.
"""

from __future__ import annotations

import json
import time
import urllib.parse
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructField, StructType

from stintlake.session import CODEC, brief_shuffles, cut_lineage


class _FS:
    """Minimal Hadoop FileSystem access through the session's JVM."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._root = self._Path(root)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return bool(self._fs.exists(self._Path(path)))

    def touch(self, path: str) -> None:
        out = self._fs.create(self._Path(path), True)
        out.close()

    def write_text(self, path: str, text: str) -> None:
        out = self._fs.create(self._Path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._Path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def list_names(self, path: str) -> list[str]:
        p = self._Path(path)
        if not self._fs.exists(p):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(p)]

    def rename(self, src: str, dst: str) -> bool:
        return bool(self._fs.rename(self._Path(src), self._Path(dst)))

    def delete(self, path: str) -> None:
        self._fs.delete(self._Path(path), True)

    def files(self, path: str) -> list[tuple[str, int, int]]:
        """Name, length and modification time of every file under ``path``."""
        out, found = [], self._fs.listFiles(self._Path(path), True)
        while found.hasNext():
            st = found.next()
            out.append((st.getPath().toString(), int(st.getLen()), int(st.getModificationTime())))
        return out


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fs = _FS(spark, self.root)

    # -- versions ---------------------------------------------------------
    def versions(self, table: str) -> list[str]:
        names = self.fs.list_names(f"{self.root}/{table}")
        done = sorted(n[: -len(".committed")] for n in names if n.endswith(".committed"))
        return done

    def current_path(self, table: str) -> str | None:
        """Folder of the current version (of a partitioned table: of all its versions)."""
        v = self.versions(table)
        if not v:
            return None
        return f"{self.root}/{table}/data" if self._parts(table) else f"{self.root}/{table}/{v[-1]}"

    def exists(self, table: str) -> bool:
        return bool(self.versions(table))

    def _parts(self, table: str, version: str | None = None) -> dict | None:
        """What a version of a partitioned table consists of: ``by`` (column),
        ``schema`` and ``parts`` ({folder of a value: id of the commit that
        wrote it}). None for a table that isn't partitioned or isn't there."""
        vs = [version] if version else self.versions(table)[-1:]
        text = self.fs.read_text(f"{self.root}/{table}/{vs[0]}.committed") if vs else ""
        return json.loads(text) if text else None

    def read(self, table: str, schema: StructType | None = None, version: str | None = None) -> DataFrame:
        """Current (or the given) version; an empty frame with ``schema`` when
        the table is absent (a missing input is not an error)."""
        vs = self.versions(table)
        if not vs:
            if schema is None:
                raise FileNotFoundError(f"table {table!r} has no committed version under {self.root}")
            return self.spark.createDataFrame([], schema)
        held = self._parts(table, version)
        if held is None:
            return self.spark.read.parquet(f"{self.root}/{table}/{version or vs[-1]}")
        return self._read_parts(table, held, list(held["parts"]))

    def _read_parts(self, table: str, held: dict, folders: list[str]) -> DataFrame:
        """The rows of some partitions. The schema comes from the marker, so no
        file is opened to learn it, and the partition column from the folders."""
        schema = StructType.fromJson(held["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{table}/data"
        paths = [f"{base}/{d}/v={held['parts'][d]}" for d in folders]
        found = self.spark.read.schema(StructType([*schema.fields, StructField("v", StringType())])).option("basePath", base).parquet(*paths)
        return found.select(*schema.fieldNames())

    def partition_files(self, table: str) -> dict[str, list[tuple[str, int, int]]]:
        """Files (path, length, time) of each partition of the current version."""
        held = self._parts(table) or {"parts": {}}
        return {d: sorted(self.fs.files(f"{self.root}/{table}/data/{d}/v={v}")) for d, v in held["parts"].items()}

    def _commit(self, table: str, df: DataFrame, partition_by: str | None = None, keep: dict | None = None, check=None,
                dealt: bool = False, shuffled: bool = False) -> str:
        """Write ``df`` as the next version; of a partitioned table, ``keep``
        names the partitions ({folder: commit}) that stay as they are. ``check``
        is called once the data is written: if it raises, the version never
        becomes visible. ``dealt`` says that ``df`` reads a table stored by
        ``partition_by``: a number's rows are then read and written by
        themselves, without a shuffle or sort of all of them. ``shuffled`` says
        that ``df`` comes out of a shuffle, so that its tasks are as many as its
        bytes ask for (AQE): each then writes a file of every value that it has,
        and the rows don't cross the network once more to meet by value."""
        check = check or (lambda: None)
        vid = f"v{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/{table}/{vid}"
        if partition_by is None:
            with brief_shuffles(self.spark):
                df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
            check()
            self.fs.touch(f"{path}.committed")
            return path
        base = f"{self.root}/{table}/data"
        with brief_shuffles(self.spark):
            self._write_values(df, base, partition_by, vid, dealt, shuffled)
        check()
        return self._mark(table, vid, df.schema, partition_by, keep)

    def _write_values(self, df: DataFrame, base: str, partition_by: str, vid: str, dealt: bool, shuffled: bool) -> None:
        if dealt and isinstance(df.schema[partition_by].dataType, IntegralType):
            values = [r[0] for r in df.select(partition_by).distinct().collect()]  # a row per partition
            with ThreadPoolExecutor(max_workers=4) as pool:
                list(pool.map(lambda x: df.filter(F.col(partition_by).eqNullSafe(F.lit(x))).drop(partition_by)
                              .write.option("compression", CODEC).parquet(f"{base}/{partition_by}={'__HIVE_DEFAULT_PARTITION__' if x is None else x}/v={vid}"), values))
        else:
            # rows of a value meet in few tasks, a value with many rows is split (AQE)
            ((df if shuffled else df.hint("rebalance", partition_by)).withColumn("v", F.lit(vid))
             .write.mode("append").option("compression", CODEC).partitionBy(partition_by, "v").parquet(base))

    def _mark(self, table: str, vid: str, schema: StructType, partition_by: str, keep: dict | None = None) -> str:
        """Make what has been written as ``vid`` the partitioned table's version."""
        base = f"{self.root}/{table}/data"
        new = {d: vid for d in self.fs.list_names(base) if d.startswith(f"{partition_by}=") and self.fs.exists(f"{base}/{d}/v={vid}")}
        fields = sorted(schema.fields, key=lambda f: f.name == partition_by)  # the partition column comes last
        self.fs.write_text(f"{self.root}/{table}/{vid}.committed", json.dumps({
            "by": partition_by, "schema": json.loads(StructType(fields).json()), "parts": {**(keep or {}), **new}}))
        return base

    # -- loads ------------------------------------------------------------
    def write_full(self, table: str, df: DataFrame, partition_by: str | None = None, check=None, dealt: bool = False,
                   shuffled: bool = False) -> str:
        """Full refresh: a new version replaces the current one; the old one is
        kept as the backup. See ``_commit`` for ``check``, ``dealt`` and ``shuffled``."""
        return self._commit(table, df, partition_by, check=check, dealt=dealt, shuffled=shuffled)

    def write_parts(self, table: str, frames: Iterable[DataFrame], partition_by: str | None = None) -> str:
        """Full refresh by the rows of one or more frames of one schema, each
        written before the next is asked for: what one of them shuffles is gone
        by then."""
        vid = f"v{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/{table}/{vid}" if partition_by is None else f"{self.root}/{table}/data"
        for df in frames:
            schema = df.schema
            rows = (df if partition_by is None else df.withColumn("v", F.lit(vid))).write.mode("append").option("compression", CODEC)
            with brief_shuffles(self.spark):
                (rows if partition_by is None else rows.partitionBy(partition_by, "v")).parquet(path)
        if partition_by is None:
            self.fs.touch(f"{path}.committed")
            return path
        return self._mark(table, vid, schema, partition_by)

    def _replace(self, table: str, rows: DataFrame, on: list[str], schema: StructType | None = None) -> str:
        """The next version: target rows that match none of ``rows`` in the
        columns ``on``, and ``rows``. Of a partitioned table, only partitions
        that hold a matching row or get one are read whole and written; if
        ``schema`` differs from theirs, all are."""
        held = self._parts(table)
        target, out = self.read(table), rows
        rows = rows if schema is None else as_schema(rows, schema)
        if schema is not None and {(f.name, f.dataType) for f in schema.fields} != {(f.name, f.dataType) for f in target.schema.fields}:
            kept = target.join(out.select(*on).distinct(), on, "left_anti")
            return self._commit(table, as_schema(kept, schema).unionByName(rows), held["by"] if held else None)
        if held is None:
            return self._commit(table, target.join(out.select(*on).distinct(), on, "left_anti").unionByName(rows.select(*target.columns)))
        by = held["by"]
        rows = cut_lineage(rows, "replace")
        out = cut_lineage(rows.select(*on).distinct(), "replaced")  # of the written rows: they aren't made a second time
        # the keys decide which partitions are touched; of the others no other column is read
        met = self.read(table).select(by, *[c for c in on if c != by])
        if len(on) == 1:  # a slice: many rows have its value, which cross the network once
            met = met.distinct()
        met = met.join(out, on, "left_semi").select(by)
        touched = {r[0] for r in rows.select(by).union(met).distinct().collect()}  # a row per partition at most
        value = lambda d: urllib.parse.unquote(d.split("=", 1)[1])
        names = {"__HIVE_DEFAULT_PARTITION__" if v is None else str(v) for v in touched}
        ours = [d for d in held["parts"] if value(d) in names]
        target = self._read_parts(table, held, ours)
        merged = target.join(out, on, "left_anti").unionByName(rows.select(*target.columns))
        # kept rows come from files of one value each, the others out of a shuffle or a written copy of it
        return self._commit(table, merged, by, {d: v for d, v in held["parts"].items() if d not in ours}, shuffled=True)

    def merge_upsert(self, table: str, updates: DataFrame, keys, order_by, partition_by: str | None = None, evolve: bool = False) -> str:
        """Insert-or-replace by primary key. Rows of ``updates`` win; target
        rows whose key is not in ``updates`` are kept. Of several updates of
        one key the last by ``order_by`` wins (see ``last_by_key``). When the
        table does not exist yet the updates become its first version. Order
        columns that begin with an underscore are not stored. ``evolve`` lets
        the updates add columns and widen types (see ``merged_schema``); else
        columns that the target lacks are left out."""
        keys = [keys] if isinstance(keys, str) else list(keys)
        updates = last_by_key(updates, keys, order_by)
        updates = updates.drop(*[c for c in updates.columns if c.startswith("_")])
        if not self.exists(table):
            return self._commit(table, updates, partition_by, shuffled=True)  # out of the aggregate by key
        schema = merged_schema(self.read(table).schema, updates.schema) if evolve else None
        return self._replace(table, updates, keys, schema)

    def insert_missing(self, table: str, rows: DataFrame, keys) -> str:
        """Seed rows, keeping existing ones when the key is already there."""
        keys = [keys] if isinstance(keys, str) else list(keys)
        if not self.exists(table):
            return self._commit(table, rows)
        target = self.read(table)
        new = rows.select(*target.columns).join(target.select(*keys), keys, "left_anti")
        return self._replace(table, new, keys)

    def replace_slice(self, table: str, df: DataFrame, slice_col: str, partition_by: str | None = None) -> str:
        """Delete every target row whose ``slice_col`` value occurs in ``df``
        and append ``df`` (the reload of a range of races / seasons)."""
        if not self.exists(table):
            return self._commit(table, df, partition_by)
        return self._replace(table, df, [slice_col])

    def append_rows(self, table: str, df: DataFrame) -> str:
        """Append (ledger tables): new files beside those of the current
        version; nothing that is there is read or written again. Columns
        that the rows lack are null."""
        path = self.current_path(table)
        if path is None:
            return self._commit(table, df)
        if self._parts(table):
            raise ValueError(f"table {table!r} is partitioned; ledgers aren't")
        have = set(df.columns)
        df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                    for f in self.spark.read.parquet(path).schema.fields]).write.mode("append").parquet(path)
        return path

    def vacuum(self, table: str, keep: int = 2) -> None:
        """Drop all but the newest ``keep`` committed versions (marker first,
        so a reader never picks a half-deleted version); files that a kept
        version points to stay."""
        vs = self.versions(table)
        gone, left = (vs[:-keep], vs[-keep:]) if keep > 0 else (vs, [])
        held = lambda many: {(d, v) for x in many for d, v in (self._parts(table, x) or {"parts": {}})["parts"].items()}
        files = held(gone) - held(left)
        for v in gone:
            self.fs.delete(f"{self.root}/{table}/{v}.committed")
            self.fs.delete(f"{self.root}/{table}/{v}")
        for d, v in files:
            self.fs.delete(f"{self.root}/{table}/data/{d}/v={v}")

    def input_signature(self, paths: list[str]) -> str:
        """Fingerprint of every data file under the input paths (name, length
        and modification time)."""
        import hashlib

        h = hashlib.sha1()
        for p in paths:
            for name, ln, mt in sorted(self.fs.files(p)):
                h.update(f"{name}:{ln}:{mt};".encode())
        return h.hexdigest()[:16]


#: Types that hold every value of the types to their left.
WIDER = ["int", "bigint", "double"]


class SchemaConflict(ValueError):
    """Rows that the stored table can't take without losing values."""


def merged_schema(old: StructType, new: StructType) -> StructType:
    """The columns of both, each with the wider type; a column whose types
    can't be merged is refused."""
    fields = {f.name: f for f in old.fields}
    for f in new.fields:
        have = fields.get(f.name)
        if have is None or have.dataType == f.dataType:
            fields.setdefault(f.name, f)
            continue
        kinds = [have.dataType.simpleString(), f.dataType.simpleString()]
        if not set(kinds) <= set(WIDER):
            raise SchemaConflict(f"column {f.name}: {kinds[1]} can't be merged into {kinds[0]}")
        if WIDER.index(kinds[1]) > WIDER.index(kinds[0]):
            fields[f.name] = f
    return StructType(list(fields.values()))


def as_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns and types of ``schema``; a column that ``df`` lacks is null."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def last_by_key(df: DataFrame, keys, order_by) -> DataFrame:
    """One row per key: the last by ``order_by``; of rows alike in that, the
    largest by the other columns, so that the result doesn't depend on the
    order of arrival. One aggregate with partial sums, so a key that many
    rows repeat is reduced before the shuffle."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    return (df.groupBy(*keys).agg(F.max(F.struct(*order_by, *rest)).alias("last"))
            .select(*[F.col(c) if c in keys else F.col(f"last.{c}").alias(c) for c in df.columns]))


def write_once(spark: SparkSession, path: str, write) -> str:
    """Materialise ``write(tmp_path)`` at ``path`` exactly once: written to a
    unique folder, then renamed into place; when another writer got there
    first, its copy is used. Returns ``path``."""
    fs = _FS(spark, path)
    if fs.exists(f"{path}/_SUCCESS"):
        return path
    tmp = f"{path}.tmp-{uuid.uuid4().hex[:10]}"
    with brief_shuffles(spark):
        write(tmp)
    if not fs.rename(tmp, path) or not fs.exists(f"{path}/_SUCCESS"):
        if not fs.exists(f"{path}/_SUCCESS"):
            raise RuntimeError(f"could not publish {path}")
    return path
