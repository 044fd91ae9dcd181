"""Broken documents, resumed loads, load metrics, file order and the mart graph."""

import os

import pytest
from fixtures import model_star
from pyspark.sql import functions as F

from stintlake.operators import ledger as LG
from stintlake.operators import quality as QC
from stintlake.plans import mart_graph as MG
from stintlake.plans.pipeline import PipelineConfig, run_pipeline
from stintlake.sources import nested
from stintlake.sources.binding import bind
from stintlake.sources.store import Store
from test_smoke import CSV


def test_broken_documents_are_kept_and_counted(spark, tmpdir_path):
    good = '{"MRData":{"RaceTable":{"Races":[{"season":"2024","round":"1","raceName":"A"}]}}}'
    rows = [good, good[:40], "", "[]", '{"Other":{}}', '{"MRData":{"total":"1"}}', good.replace('"1"', '"2"'), None]
    docs = spark.createDataFrame([(v,) for v in rows], "value string").repartition(3)
    ok, broken = nested.land_checked(spark, docs, f"{tmpdir_path}/landed")
    assert ok.count() == 2 and broken.count() == 6
    assert {r["broken"]: r["n"] for r in broken.groupBy("broken").agg(F.count("*").alias("n")).collect()}["empty"] == 2
    assert sorted(r["round"] for r in nested.flatten_races(ok).collect()) == [1, 2]
    # flattening everything gives the good ones' rows, without an error
    assert nested.flatten_races(docs).count() == 2
    assert nested.land_checked(spark, docs.limit(0), f"{tmpdir_path}/none")[0].count() == 0


def _work(spark):
    source = spark.range(60).select(F.col("id").alias("race_id"), (F.lit(2000) + F.col("id") % 6).cast("int").alias("year"),
                                    (F.col("id") / 6).cast("int").alias("round"), F.lit("ok").alias("status")).filter("round <> 4")
    rounds = spark.range(60).select(F.lit("results").alias("dataset"), (F.lit(2000) + F.col("id") % 6).cast("int").alias("year"), (F.col("id") / 6).cast("int").alias("round"))
    return source, rounds


def test_a_stopped_load_is_taken_up(spark, tmpdir_path, monkeypatch):
    source, rounds = _work(spark)
    st, whole = Store(spark, f"{tmpdir_path}/a"), Store(spark, f"{tmpdir_path}/b")
    LG.load_rounds(whole, "t", rounds, source, ["race_id"], "year")
    assert LG.load_rounds(st, "t", rounds, source, ["race_id"], "year", stop_after=2) == 2
    # the third season's data is committed, its ledger rows aren't
    append = st.append_rows
    monkeypatch.setattr(st, "append_rows", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        LG.load_rounds(st, "t", rounds, source, ["race_id"], "year")
    monkeypatch.setattr(st, "append_rows", append)
    before = st.partition_files("t")
    assert LG.load_rounds(st, "t", rounds, source, ["race_id"], "year") == 4  # two were done
    after = st.partition_files("t")
    assert after["year=2000"] == before["year=2000"] and after["year=2002"] != before["year=2002"]
    for table in ("t", "ledger"):
        a, b = (sorted(map(str, x.read(table).collect())) for x in (st, whole))
        assert a == b
    assert whole.read("ledger").filter("state = 'skipped'").count() == 6
    assert LG.load_rounds(st, "t", rounds, source, ["race_id"], "year") == 0


def test_a_million_unexpected_values(spark):
    laps = spark.range(1_000_000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("compound"))
    found = QC.enum_findings(laps.unionByName(laps.limit(5)), "laps")
    assert found.agg(F.count("*"), F.sum("rows")).first()[:] == (1_000_000, 1_000_005)
    assert len(QC.enforce(laps, "laps", strict=False)) == QC.MOST_NAMED


def _land(tmpdir_path, **changed):
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw, exist_ok=True)
    for name, text in {**CSV, **changed}.items():
        with open(os.path.join(raw, name), "w") as fh:
            fh.write(text)
    return raw


def _results(*rows):
    head = CSV["results.csv"].split("\n")[0]
    line = "202401,max_verstappen,red_bull,33,1,1,1,1,{},52,1:30:00,5400000,12,1,1:20.000,220.5,{}"
    return "\n".join([head, *[line.format(*r) for r in rows], ""])


def test_load_metrics_and_file_order(spark, tmpdir_path):
    raw = _land(tmpdir_path)
    store = f"{tmpdir_path}/store"
    run_pipeline(spark, raw, store, PipelineConfig(2024, 2024, skip_marts=True))
    # of rows with one key the last of the file wins, whatever its values
    _land(tmpdir_path, **{"results.csv": _results((-3, "Zzz"), (25, "Finished"), (18, "Aaa"))})
    res = run_pipeline(spark, raw, store, PipelineConfig(2024, 2024, mode="incremental", skip_marts=True))
    row = Store(spark, store).read("results").collect()
    assert [(r["points"], r["status"], r["year"]) for r in row] == [(18.0, "Aaa", 2024)]
    assert "points has 1 values below minimum 0" in res.warnings
    with pytest.raises(QC.ContractError):
        run_pipeline(spark, raw, store, PipelineConfig(2024, 2024, strict=True, skip_marts=True))
    assert Store(spark, store).read("results").first()["status"] == "Aaa"  # the broken load isn't committed


def test_laps_marts_and_isolated_checks(spark, tmpdir_path):
    raw = _land(tmpdir_path)
    iv = lambda s: F.make_dt_interval(secs=F.lit(s).cast("decimal(18,6)"))
    spark.range(3).select(
        F.lit(202401).cast("long").alias("race_id"), F.lit("VER").alias("Driver"), F.lit(True).alias("IsAccurate"), (F.col("id") + 1.0).alias("LapNumber"),
        iv(90).alias("LapTime"), iv(30).alias("Sector1Time"), iv(30).alias("Sector2Time"), iv(30).alias("Sector3Time"),
        F.when(F.col("id") == 0, "slick").otherwise("soft").alias("Compound"), F.lit(1.0).alias("TyreLife"), F.lit(1.0).alias("Stint"), F.lit(False).alias("IsPersonalBest"),
        iv(1).alias("PitInTime"), iv(1).alias("PitOutTime"), F.lit("1").alias("TrackStatus")).write.parquet(f"{tmpdir_path}/sessions")
    res = run_pipeline(spark, raw, f"{tmpdir_path}/store", PipelineConfig(2024, 2024, sessions=f"{tmpdir_path}/sessions"))
    assert res.loaded["laps"] == 3
    assert {tuple(r) for r in res.quality.collect()} == {("laps_invalid_compound", "1", "0")}
    assert {r["status"] for r in res.marts.collect()} == {"ok"} and res.marts.count() == len(MG.GRAPH)
    res = run_pipeline(spark, raw, f"{tmpdir_path}/store2", PipelineConfig(2024, 2024, sessions=f"{tmpdir_path}/absent", skip_marts=True))
    assert any("No laps loaded" in w for w in res.warnings)


def test_mart_graph_skips_failed_branches(spark, tmpdir_path):
    star, st = model_star(spark), Store(spark, tmpdir_path)

    def stg_broken(t):
        return t.results.select("no_such_column")

    def mart_from_it(t, cid=None):
        return t.results

    def mart_alone(t, cid=None):
        return t.races.select("year", F.lit(None).cast("int").alias("empty"))

    def mart_of_failed(t, cid=None):
        return t.races

    graph = {"mart_of_failed": MG.Node(mart_of_failed, ["mart_alone"]), "mart_alone": MG.Node(mart_alone, ["races"], ["empty"]),
             "mart_from_it": MG.Node(mart_from_it, ["stg_broken"]), "stg_broken": MG.Node(stg_broken, ["results"])}
    assert MG.order(graph).index("stg_broken") < MG.order(graph).index("mart_from_it")
    got = {r["model"]: r for r in MG.build_marts(star, st, graph=graph).collect()}
    assert got["stg_broken"]["status"].startswith("error") and got["mart_from_it"]["status"] == "skipped"
    assert (got["mart_alone"]["status"], got["mart_alone"]["failures"], got["mart_of_failed"]["status"]) == ("failed", 6, "ok")
    strict = {r["model"]: r["status"] for r in MG.build_marts(star, st, graph=graph, strict=True).collect()}
    assert strict["mart_of_failed"] == "skipped"


def test_ids_by_ranges_equal_the_plain_form(spark):
    from pyspark.sql import Window
    from stintlake.operators.transform import assign_ids
    refs = spark.range(5000).select(F.concat(F.lit("r"), F.xxhash64("id").cast("string")).alias("ref"))
    known = refs.limit(0).withColumn("id", F.lit(7).cast("long"))
    plain = refs.withColumn("id", F.row_number().over(Window.orderBy("ref")).cast("bigint"))
    assert sorted(map(str, assign_ids(refs, "ref", "id", known).select("ref", "id").collect())) == sorted(map(str, plain.collect()))


def test_raw_files_of_the_run_go_once_they_are_loaded(spark, tmpdir_path):
    raw = _land(tmpdir_path)
    kept = run_pipeline(spark, raw, f"{tmpdir_path}/kept", PipelineConfig(2024, 2024))
    assert os.path.exists(f"{raw}/results.csv")
    with pytest.raises(QC.ContractError):  # what isn't loaded stays
        _land(tmpdir_path, **{"results.csv": _results((-3, "Zzz"))})
        run_pipeline(spark, raw, f"{tmpdir_path}/broken", PipelineConfig(2024, 2024, strict=True, drop_raw=True))
    assert os.path.exists(f"{raw}/results.csv") and os.path.exists(f"{raw}/drivers.csv")
    raw = _land(tmpdir_path)
    res = run_pipeline(spark, raw, f"{tmpdir_path}/gone", PipelineConfig(2024, 2024, drop_raw=True))
    assert not os.path.exists(raw) and res.loaded == kept.loaded
    assert sorted(map(tuple, res.marts.collect())) == sorted(map(tuple, kept.marts.collect()))
    assert res.summary.collect() == kept.summary.collect() and res.quality.collect() == kept.quality.collect()


def test_a_mart_in_parts_by_team_is_the_whole_mart(spark, tmpdir_path):
    t = bind(spark, "/root/testdata/sf0.001")
    st = Store(spark, f"{tmpdir_path}/marts")
    graph = {n: MG.GRAPH[n] for n in ("stg_constructor_standings", "stg_races", "mart_championship_progression")}
    rows = {r["model"]: r["rows"] for r in MG.build_marts(t, st, graph=graph).collect()}
    assert graph["mart_championship_progression"].team_parts > 1 and len(st.versions("mart_championship_progression")) == 1
    got, want = st.read("mart_championship_progression"), MG.D.mart_championship_progression(t)
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert rows["mart_championship_progression"] == want.count() > 0


def test_raw_tables_are_landed_when_they_are_read(spark, tmpdir_path):
    raw, seen = f"{tmpdir_path}/raw", []

    def land(table):
        seen.append((table, sorted(os.listdir(raw)) if os.path.exists(raw) else []))
        os.makedirs(raw, exist_ok=True)
        with open(f"{raw}/{table}.csv", "w") as fh:
            fh.write(CSV[f"{table}.csv"])

    res = run_pipeline(spark, raw, f"{tmpdir_path}/store", PipelineConfig(2024, 2024, land=land, drop_raw=True, skip_marts=True))
    assert len(seen) == len({x for x, _ in seen}) == len(CSV) and res.loaded["results"] == 1 and not os.path.exists(raw)
    there = dict(seen)["driver_standings"]  # of the facts before it no raw file is left
    assert "drivers.csv" in there and not {"results.csv", "qualifying.csv", "pit_stops.csv"} & set(there)


def test_sessions_that_the_run_lands_go_once_they_are_loaded(spark, tmpdir_path):
    iv, folder = F.make_dt_interval(secs=F.lit(90).cast("decimal(18,6)")), f"{tmpdir_path}/sessions"
    rows = spark.range(3).select(
        F.lit(202401).cast("long").alias("race_id"), F.lit("VER").alias("Driver"), F.lit(True).alias("IsAccurate"), (F.col("id") + 1.0).alias("LapNumber"),
        *[iv.alias(c) for c in ("LapTime", "Sector1Time", "Sector2Time", "Sector3Time", "PitInTime", "PitOutTime")],
        F.lit("soft").alias("Compound"), F.lit(1.0).alias("TyreLife"), F.lit(1.0).alias("Stint"), F.lit(False).alias("IsPersonalBest"), F.lit("1").alias("TrackStatus"))

    def land():
        rows.write.parquet(folder)
        return folder

    res = run_pipeline(spark, _land(tmpdir_path), f"{tmpdir_path}/own", PipelineConfig(2024, 2024, sessions=land, drop_raw=True, skip_marts=True))
    assert res.loaded["laps"] == 3 and not os.path.exists(folder)
    land()
    res = run_pipeline(spark, _land(tmpdir_path), f"{tmpdir_path}/given", PipelineConfig(2024, 2024, sessions=folder, drop_raw=True, skip_marts=True))
    assert res.loaded["laps"] == 3 and os.path.exists(folder)
    back = Store(spark, f"{tmpdir_path}/given").read("laps")
    assert {r["year"] for r in back.collect()} == {2024}
