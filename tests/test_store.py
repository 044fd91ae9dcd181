"""Partitioned tables of the store: touched partitions only, pruning, versions."""

import pytest
from pyspark.sql import functions as F

from stintlake.sources.store import Store


def _rows(spark, n=90):
    return spark.range(n).select(F.col("id").alias("race_id"), (F.col("id") % 3).alias("driver_id"),
                                 (F.lit(2000) + F.col("id") % 9).cast("int").alias("year"), F.lit("old").alias("status"))


def _all(df):
    return sorted(tuple(r) for r in df.select("race_id", "driver_id", "year", "status").collect())


def test_upsert_leaves_other_partitions_files(spark, tmpdir_path):
    st = Store(spark, tmpdir_path)
    st.write_full("t", _rows(spark), partition_by="year")
    before = st.partition_files("t")
    assert len(before) == 9
    updates = _rows(spark, 120).filter("race_id % 9 = 4").withColumn("status", F.lit("new"))
    st.merge_upsert("t", updates, ["race_id", "driver_id"], "status")
    after = st.partition_files("t")
    assert {d for d in after if after[d] != before.get(d)} == {"year=2004"}
    expected = [(r, d, y, "new" if r % 9 == 4 else s) for r, d, y, s in _all(_rows(spark))] + [(r, r % 3, 2004, "new") for r in range(90, 120) if r % 9 == 4]
    assert _all(st.read("t")) == sorted(expected)
    # the version before is still whole
    assert _all(st.read("t", version=st.versions("t")[0])) == _all(_rows(spark))


def test_a_key_that_moves_leaves_its_old_partition(spark, tmpdir_path):
    st = Store(spark, tmpdir_path)
    st.write_full("t", _rows(spark, 18), partition_by="year")
    moved = spark.createDataFrame([(3, 0, 2010, "moved"), (5, 2, None, "no year")], "race_id long, driver_id long, year int, status string")
    st.merge_upsert("t", moved, ["race_id", "driver_id"], "status")
    got = {r["race_id"]: (r["year"], r["status"]) for r in st.read("t").collect()}
    assert len(got) == st.read("t").count() == 18 and got[3] == (2010, "moved") and got[5] == (None, "no year")
    st.merge_upsert("t", moved.withColumn("year", F.lit(2001)), ["race_id", "driver_id"], "status")
    assert "year=2010" not in st.partition_files("t") and "year=__HIVE_DEFAULT_PARTITION__" not in st.partition_files("t")
    assert {r["race_id"]: r["year"] for r in st.read("t").filter("race_id IN (3, 5)").collect()} == {3: 2001, 5: 2001}


def test_slice_replace_and_vacuum(spark, tmpdir_path):
    st = Store(spark, tmpdir_path)
    st.write_full("t", _rows(spark), partition_by="year")
    before = st.partition_files("t")
    reload = spark.createDataFrame([(8, 7, 2008, "again")], "race_id long, driver_id long, year int, status string")
    st.replace_slice("t", reload, "race_id")
    after = st.partition_files("t")
    assert {d for d in after if after[d] != before[d]} == {"year=2008"}
    assert [tuple(r) for r in st.read("t").filter("race_id = 8").select("driver_id", "status").collect()] == [(7, "again")]
    st.vacuum("t", keep=1)
    assert len(st.versions("t")) == 1 and st.read("t").count() == 90
    assert not st.fs.exists(before["year=2008"][0][0]) and st.fs.exists(before["year=2007"][0][0])
    st.insert_missing("t", reload.withColumn("race_id", F.lit(8888).cast("long")).unionByName(reload), ["race_id"])
    assert st.read("t").count() == 91


def test_a_filter_on_the_partition_column_prunes_files(spark, tmpdir_path):
    st = Store(spark, tmpdir_path)
    st.write_full("t", _rows(spark), partition_by="year")
    t = st.read("t")
    last = t.filter(F.col("year") == t.agg(F.max("year")).scalar())
    assert "PartitionFilters: [isnotnull(year" in last._jdf.queryExecution().toString()
    assert last.select(F.input_file_name().alias("f")).distinct().count() < t.select(F.input_file_name().alias("f")).distinct().count()
    assert {r["year"] for r in last.collect()} == {2008}


def test_empty_partitioned_table(spark, tmpdir_path):
    st = Store(spark, tmpdir_path)
    st.write_full("t", _rows(spark).limit(0), partition_by="year")
    assert st.exists("t") and st.read("t").count() == 0 and st.read("t").columns == ["race_id", "driver_id", "status", "year"]
    st.merge_upsert("t", _rows(spark, 9), ["race_id"], "status")
    assert st.read("t").count() == 9
    st.merge_upsert("t", _rows(spark).limit(0), ["race_id"], "status")
    assert st.read("t").count() == 9


def test_strict_check_keeps_a_version_invisible(spark, tmpdir_path):
    st = Store(spark, tmpdir_path)
    st.write_full("t", _rows(spark, 9), partition_by="year")

    def refuse():
        raise ValueError("no")

    for by in ("year", None):
        try:
            st.write_full("t", _rows(spark, 20), by, check=refuse)
        except ValueError:
            pass
    assert st.read("t").count() == 9 and len(st.versions("t")) == 1


def test_evolving_upsert(spark, tmpdir_path):
    import pytest

    from stintlake.operators.ledger import version_drift
    from stintlake.sources.store import SchemaConflict
    st = Store(spark, tmpdir_path)
    st.write_full("t", spark.createDataFrame([(1, 2000, 5), (2, 2001, 6)], "id long, year int, n int"), "year")
    more = spark.createDataFrame([(2, 2001, 6.5, "x")], "id long, year int, n double, note string")
    st.merge_upsert("t", more, ["id"], "n", evolve=True)
    assert sorted((r.id, r.n, r.note) for r in st.read("t").collect()) == [(1, 5.0, None), (2, 6.5, "x")]
    got = {tuple(r) for r in version_drift(st, "t").collect()}
    assert got == {("t", "n", "type int -> double", 2, 2), ("t", "note", "column added", 2, 2)}
    st.merge_upsert("t", more.drop("note"), ["id"], "n", evolve=True)  # without a column the row has null there
    with pytest.raises(SchemaConflict):
        st.merge_upsert("t", more.withColumn("n", F.lit("text")), ["id"], "note", evolve=True)


def test_shuffles_of_a_write_go_with_it(spark, tmpdir_path):
    import time

    from stintlake.session import SHUFFLES_GO

    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))

    st, before = Store(spark, f"{tmpdir_path}/brief"), held()
    rows = spark.range(1000).repartition(4, "id").withColumn("y", F.col("id") % 3)
    st.write_full("a", rows)
    st.write_full("b", rows, "y")
    st.write_parts("c", [rows, rows.limit(10)], "y")
    for _ in range(50):
        if held() <= before:
            break
        time.sleep(0.2)
    assert held() <= before and spark.conf.get(SHUFFLES_GO, "false") == "false"
    assert [st.read(n).count() for n in "abc"] == [1000, 1000, 1010]


def test_parts_are_one_version(spark, tmpdir_path):
    st = Store(spark, f"{tmpdir_path}/parts")
    rows = spark.range(10).withColumn("y", F.col("id") % 2)
    for by in (None, "y"):
        st.write_parts(f"t{by}", [rows.filter("id < 4"), rows.filter("id >= 4")], by)
        assert len(st.versions(f"t{by}")) == 1 and sorted(r.id for r in st.read(f"t{by}").collect()) == list(range(10))

        def broken():
            yield rows
            raise ValueError("no more")

        with pytest.raises(ValueError):
            st.write_parts(f"t{by}", broken(), by)
        assert len(st.versions(f"t{by}")) == 1 and st.read(f"t{by}").count() == 10
