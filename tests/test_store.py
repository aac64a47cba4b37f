"""Loads that are all or nothing, repeated batches, and enrichment of what is new."""

from __future__ import annotations

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from pacegrid import schema
from pacegrid.operators import calendar, quality
from pacegrid.plans import pipeline
from pacegrid.plans.queries import QUERIES
from pacegrid.sources import store as stores
from pacegrid.sources.layers import load_layers
from pacegrid.sources.store import Conflict, Load, Store
from pacegrid.streaming import ingest
from test_joins import ran
from test_pipeline import BEST_HEADER, counts, summaries, write_activity


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "k bigint, v string")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_load_that_breaks_changes_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), buckets=4)
    store.once("x", 0, lambda load: load.upsert("t", batch(spark, *[(i, "old") for i in range(20)]), "k"))
    before = rows_of(store.read("t"))
    broken = store.load()
    broken.upsert("t", batch(spark, (3, "new")), "k")
    broken.append("u", batch(spark, (1, "a")), ["k"])
    assert dict(broken.read("t").collect())[3] == "new"  # the load itself sees its changes
    assert rows_of(store.read("t")) == before
    with pytest.raises(KeyError):
        store.read("u")
    store.once("x", 1, lambda load: load.upsert("t", batch(spark, (4, "next")), "k"))
    assert dict(store.read("t").collect()) == {**{i: "old" for i in range(20)}, 4: "next"}
    assert len(store.sweep()) == 1  # the broken load's folder; every other is named still
    assert len(store.read("t").collect()) == 20
    assert not list((tmp_path / "s" / "scratch").glob("*"))


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=8)
    store.once("x", 0, lambda load: load.upsert("t", batch(spark, *[(i, "old") for i in range(50)]), "k"))
    store.once("x", 1, lambda load: load.upsert("t", batch(spark, (3, "new")), "k"))
    parts = store.state()["tables"]["t"]["parts"]
    assert sorted(len(live) for live in parts.values()) == [1, 7]
    files = store.read("t").select(F.input_file_name()).distinct().collect()
    assert len({f[0].rpartition("/")[0] for f in files}) == 8
    load = store.load()
    load.compact("t")
    load.commit()
    assert len(store.state()["tables"]["t"]["parts"]) == 1
    assert dict(store.read("t").collect()) == {**{i: "old" for i in range(50)}, 3: "new"}
    store.once("x", 2, lambda load: load.upsert("t", batch(spark, (3, "newer")), "k"))
    assert dict(store.read("t").collect())[3] == "newer" and store.read("t").count() == 50


def test_known_keys_are_read_in_touched_buckets_alone(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=16)
    store.once("x", 0, lambda load: load.insert_only("t", batch(spark, *[(i, "old") for i in range(200)]), "k"))
    load = store.load()
    some = batch(spark, (7, "late"), (1000, "new"))
    touched = load._touched(some, load.state["tables"]["t"], ["k"])
    known = load.known_keys("t", "k", some.schema["k"].dataType, touched)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "store_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert 0 < known.count() < 50
    load.insert_only("t", some, "k")
    load.commit()
    assert dict(store.read("t").collect()) == {**{i: "old" for i in range(200)}, 1000: "new"}


def test_insert_only_keeps_duplicates_and_rows_without_key(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    first = batch(spark, (1, "a"), (1, "a"), (2, "b"), (None, "n"))
    for turn in (0, 0, 1):
        store.once("x", turn, lambda load: load.insert_only("t", first, "k"))
    # The same batch again is the same load; as a new one, it brings its row without key anew.
    assert rows_of(store.read("t")) == sorted([(1, "a"), (1, "a"), (2, "b"), (None, "n"), (None, "n")], key=str)


def test_two_loads_at_a_time_do_not_mix(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    one, other = store.load(), store.load()
    one.append("t", batch(spark, (1, "one")), ["k"])
    other.append("t", batch(spark, (2, "other")), ["k"])
    one.commit()
    with pytest.raises(Conflict):
        other.commit()
    assert rows_of(store.read("t")) == [(1, "one")]


def test_replace_and_refresh_read_their_own_table(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=2)
    store.once("x", 0, lambda load: load.replace("t", batch(spark, (1, "a"), (1, "b"), (2, "c")), ["k"]))
    store.once("x", 1, lambda load: load.replace("t", load.read("t").where("v != 'a'"), ["k"]))
    assert rows_of(store.read("t")) == [(1, "b"), (2, "c")]
    store.once("x", 2, lambda load: load.refresh("r", load.read("t"), ["k"]))
    store.once("x", 3, lambda load: load.refresh("r", load.read("r").withColumn("w", F.lit(1)), ["k"]))
    assert rows_of(store.read("r")) == [(1, "b", 1), (2, "c", 1)]
    with pytest.raises(ValueError, match="schema"):
        store.load().replace("t", batch(spark, (1, "x")).withColumn("w", F.lit(1)), ["k"])
    load = store.load()
    load.replace("t", batch(spark), ["k"])
    load.commit()
    assert store.read("t").count() == 2


class Broken(Exception):
    pass


def clean_run(spark, raw, root):
    pipeline.run(spark, str(raw), root, summaries(spark, (1, 2)), profiles(spark))


def profiles(spark):
    return spark.createDataFrame([(7, "An", "x")], "athlete_id bigint, firstname string, bio string")


def state_of(spark, root):
    found = {}
    store = Store(spark, root)
    for name in store.state()["tables"]:
        df = store.read(name)
        found[name] = rows_of(df.drop("ingested_at", "load"))
    return found


def test_a_batch_that_breaks_at_any_write_is_repeated_cleanly(spark, tmp_path, monkeypatch):
    """All six tables change together: after each failure there is nothing, then everything."""
    raw = tmp_path / "raw"
    raw.mkdir()
    write_activity(raw, 1, 12, "2024-05-01")
    # Rows without a key come to bronze once, however often the batch is repeated.
    (raw / "bare.csv").write_text("time_s,lat\n1,2\n")
    write, commit, calls = Load._write, stores.replace_text, {"n": 0, "stop": 0}

    def breaking(self, *args):
        calls["n"] += 1
        if calls["n"] == calls["stop"]:
            raise Broken("write")
        return write(self, *args)

    monkeypatch.setattr(Load, "_write", breaking)
    clean_run(spark, raw, str(tmp_path / "clean"))
    expected, writes = state_of(spark, str(tmp_path / "clean")), calls["n"]
    assert len(expected["bronze/RunStream"]) == 13 and len(expected["silver/RunStream"]) == 12
    assert writes >= 16
    root = str(tmp_path / "lake")
    for stop in (writes // 2, writes):
        calls.update(n=0, stop=stop)
        with pytest.raises(Exception, match="write"):
            clean_run(spark, raw, root)
        assert state_of(spark, root) == {}
    calls.update(n=0, stop=0)

    # The pointer is written, but the stream does not come to know.
    def told_too_late(spark, path, text):
        commit(spark, path, text)
        if path.endswith(stores.POINTER):
            raise Broken("after")

    monkeypatch.setattr(stores, "replace_text", told_too_late)
    with pytest.raises(Exception, match="after"):
        clean_run(spark, raw, root)
    monkeypatch.setattr(stores, "replace_text", commit)
    assert state_of(spark, root) == expected
    clean_run(spark, raw, root)
    assert state_of(spark, root) == expected


def test_records_with_line_breaks_marks_and_other_headers(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    (raw / "a [1]_best.csv").write_text(
        BEST_HEADER + "1,2,\"two\nlines, \"\"quoted\"\"\",\"{'id': 5}\",\"{'id': 7}\",1500.0,1,2024-05-01T06:00:00Z,,5000,,[],0,9\n"
    )
    (raw / "b%20_best.csv").write_text("﻿elapsed_time,id,activity,name,athlete\n100,2,{'id': 6},x,{'id': 8}\n", encoding="utf-8")
    (raw / "c_best.csv").write_text("1,2,3\n4,5,6\n")  # no header that names a column
    (raw / "d_best.csv").write_text("")
    ingest.ingest_folder(spark, str(raw), root)
    found = pipeline.silver(spark, root, "RunBest").orderBy("id").collect()
    assert [(r.id, r.name, r.elapsed_time, r.activity_id, r.athlete_id, r.distance) for r in found] == [
        (1, 'two\nlines, "quoted"', 1500, 5, 7, 5000),
        (2, "x", 100, 6, 8, None),
    ]


def test_values_that_do_not_parse_are_kept(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    (raw / "x_run_1.csv").write_text("time_s,lat,hr_bpm\n1,north,120\n2,10.5,high\n3,nan,\n4,5,99999\n")
    (raw / "y_best.csv").write_text("id,name,activity,athlete\n1,5K,{'id': 5},{'id': 7}\n")
    ingest.ingest_folder(spark, str(raw), root)
    found = rows_of(Store(spark, root).read("bronze/Rejected"))
    assert found == [("x_run_1.csv", "hr_bpm", "high"), ("x_run_1.csv", "lat", "north")]
    kept = pipeline.silver(spark, root, "RunStream").orderBy("time_s").collect()
    assert [(r.lat, r.hr_bpm) for r in kept] == [(None, 120), (10.5, None), (None, None), (5.0, None)]


def points(spark, *activities, n=5):
    rows = [(a, t, 10 + t * 0.001, 106.0, t * 111.0, float(t % 3), 100 + t) for a in activities for t in range(n)]
    return spark.createDataFrame(
        rows, "activity_id bigint, time_s int, lat double, lon double, dist_m double, alt_m double, hr_bpm int"
    )


def test_enrichment_reads_what_is_new(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=4)
    store.once("x", 0, lambda load: load_layers(load, points(spark, 1, 2), "RunStream"))
    # 1 has both, 3 a summary alone, 2 points alone.
    store.once("x", 1, lambda load: pipeline.enrich(load, summaries(spark, (1, 3))))
    found = {r.activity_id: r.hr_max for r in store.read("silver/Activities").collect()}
    assert found == {1: 104, 3: None}
    assert [r.activity_id for r in store.read("silver/Waiting").collect()] == [3]
    assert {r.activity_id for r in store.read("silver/Unclaimed").collect()} == {2}
    old = set(store.read("silver/RunStream").inputFiles())

    store.once("x", 2, lambda load: load_layers(load, points(spark, 4, n=3), "RunStream"))
    load = store.load()
    waiting = load.read("silver/Waiting", pipeline.WAITING)
    chosen, _ = pipeline.points_to_enrich(load, waiting)
    assert not old & set(chosen.inputFiles()) and chosen.count() == 0
    # A summary for points that waited: their own buckets of the earlier load are read.
    claimed, _ = pipeline.points_to_enrich(load, waiting.unionByName(waiting.withColumn("activity_id", F.lit(2).cast("bigint"))))
    assert {r.activity_id for r in claimed.collect()} == {2}

    def last(load):
        load_layers(load, points(spark, 3), "RunStream")
        pipeline.enrich(load, summaries(spark, (1, 2, 3, 4)))

    store.once("x", 3, last)
    found = {r.activity_id: r.hr_max for r in store.read("silver/Activities").collect()}
    assert found == {1: 104, 2: 104, 3: 104, 4: 102}
    assert store.read("silver/Waiting").count() == 0 and store.read("silver/Unclaimed").count() == 0
    splits = store.read("silver/RunSplitKilometer").groupBy("activity_id").count().collect()
    assert {r.activity_id for r in splits} == {1, 2, 3, 4}
    # Nothing new: nothing changes.
    before = rows_of(store.read("silver/Activities"))
    store.once("x", 4, lambda load: pipeline.enrich(load, summaries(spark, (1, 2, 3, 4))))
    assert rows_of(store.read("silver/Activities")) == before


def test_gold_is_rebuilt_in_one_load(spark, tmp_path, monkeypatch):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    write_activity(raw, 1, 12, "2024-05-01")
    clean_run(spark, raw, root)
    assert counts(spark, root)["Athlete"] == 1
    races = spark.createDataFrame(
        [(7, 99, "Half-Marathon", dt.date(2024, 5, 28), 7000, 42.0, 21.0975)],
        "athlete_id bigint, activity_id bigint, target_distance_label string, race_date date, "
        "actual_sec int, elev_gain_m double, distance_km double",
    )
    loads = Store(spark, root).state()["loads"]
    found = pipeline.build_gold(spark, root, dt.date(2024, 6, 1), races).collect()
    assert len(found) == 17 and all(r.passed and r.n_failures == 0 for r in found)
    state = Store(spark, root).state()
    assert state["loads"] == loads + 1
    assert {f"gold/{name}" for name in schema.GOLD} <= set(state["tables"])


def test_checks_of_a_table_as_it_is_written(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "x", "a"), (1, "x", "a"), (None, "y", "b"), (2, None, "c")], "id int, method string, label string"
    )
    checks = [
        quality.TableChecks("t", df, ["id", "method"], ["id", "method"], {"method": ["x"]}, unique_combo=True),
        quality.TableChecks("t", df, ["id"], ["id"], unique=True),
    ]
    store = Store(spark, str(tmp_path))
    load = store.load()

    def write(rows):
        load.refresh("t", rows, ["id"])
        return load.read("t")

    found = quality.checked(df, checks, write)
    expected = {(r.test, r.n_failures) for r in quality.quality_suite(checks).collect()}
    assert set(found) == expected and len(found) == 6


def test_filters_reach_both_ways(spark):
    make = lambda rows, shape: spark.createDataFrame(rows, shape)
    left = calendar.filter_both_ways(
        {
            "days": make([(1,), (2,)], "day int"),
            "runs": make([(10, 1, 7), (11, 2, 8), (12, 3, 9)], "run int, day int, who int"),
            "starts": make([(10, 0.5), (12, 0.5)], "run int, lat double"),
            "people": make([(7,), (8,), (9,)], "who int"),
        },
        [("days", "runs", "day", False), ("runs", "starts", "run", True), ("runs", "people", "who", False)],
    )
    keys = {"days": "day", "runs": "run", "starts": "run", "people": "who"}
    assert {name: [r[keys[name]] for r in df.collect()] for name, df in left.items()} == {
        "days": [1, 2], "runs": [10], "starts": [10], "people": [7],
    }
    with pytest.raises(ValueError, match="branch"):
        calendar.filter_both_ways({}, [("a", "b", "k", True), ("c", "b", "k", True)])


def test_a_first_load_is_written_once(spark, tmp_path):
    """Into empty tables a batch goes in one pass; later ones are written aside and compared."""
    store = Store(spark, str(tmp_path / "lake"))
    load = store.load()
    load.insert_only("t", batch(spark, (1, "a"), (1, "b"), (None, "c")), "k")
    load.upsert("u", batch(spark, (1, "a"), (2, "b")), "k")
    assert not os.path.exists(load.scratch)
    load.commit()
    load = store.load()
    load.insert_only("t", batch(spark, (1, "x"), (2, "y"), (None, "z")), "k")
    load.upsert("u", batch(spark, (2, "c"), (3, "d")), "k")
    assert os.path.exists(load.scratch)
    load.commit()
    got = {n: sorted((r.k or 0, r.v) for r in store.read(n).collect()) for n in "tu"}
    assert got == {
        "t": [(0, "c"), (0, "z"), (1, "a"), (1, "b"), (2, "y")], "u": [(1, "a"), (2, "c"), (3, "d")]
    }
    assert sorted(r.k for r in store.read("t.keys").collect()) == [1, 2]


def test_keys_of_large_loads_are_merged_and_of_small_ones_sent(spark, tmp_path, monkeypatch):
    """Ids in order take next to nothing in files; the driver would hash and send them all."""
    planned, staged, write = [], Load.staged, Load._write

    def seen(df):
        planned.extend(how for how, of in ran(df) if of in ("LeftAnti", "LeftSemi"))
        return df

    monkeypatch.setattr(Load, "staged", lambda self, df: staged(self, seen(df)))
    monkeypatch.setattr(Load, "_write", lambda self, table, entry, df, keys: write(self, table, entry, seen(df), keys))
    store = Store(spark, str(tmp_path), buckets=4)

    def bring(turn, ids, v):
        planned.clear()
        rows = ids.select(F.col("id").alias("k"), F.lit(v).alias("v"))
        store.once("x", turn, lambda load: (load.upsert("latest", rows, "k"), load.insert_only("oldest", rows, "k")))
        return planned

    def counts_of(name):
        return {r.v: r["count"] for r in store.read(name).groupBy("v").count().collect()}

    assert bring(0, spark.range(300_000), 0) == []
    assert bring(1, spark.range(200_000, 400_000), 1) == ["SortMergeJoin"] * 3
    assert counts_of("latest") == {0: 200_000, 1: 200_000} and counts_of("oldest") == {0: 300_000, 1: 100_000}
    # The known keys are as many as ever.
    assert sorted(bring(2, spark.range(399_990, 400_010), 2)) == ["BroadcastHashJoin"] * 2 + ["SortMergeJoin"]
    assert counts_of("latest") == {0: 200_000, 1: 199_990, 2: 20}
    assert counts_of("oldest") == {0: 300_000, 1: 100_000, 2: 10}


def test_store_load_sends_neither_table_to_every_task(spark, tmp_path):
    days = ["2000-01-01", "2001-01-01", "2001-07-15"]  # in the first load, in both, in the second
    rows = [(i, 10 + i, 11987.0 * (i + 1), dt.datetime.fromisoformat(days[i % 3])) for i in range(30)]
    orders = spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    found = QUERIES["store_load"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted((r.activity_id, r.athlete_id, r.distance_km, r.first_km) for r in found.collect()) == [
        (i, 10 + i, (i + 1) * (1.0, 2.0, 2.0)[i % 3], (i + 1) * (1.0, 1.0, 2.0)[i % 3]) for i in range(30)
    ]


def test_gzipped_files(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    with gzip.open(raw / "a_run_1.csv.gz", "wt") as file:
        file.write("time_s,lat,hr_bpm\n1,10.5,n/a\n2,,90\n")
    (raw / "b_run_2.csv").write_text("hr_bpm,time_s\n99.0,2\n")
    with gzip.open(raw / "segments.csv.gz", "wt") as file:
        file.write("own,output\n1,2\n")
    ingest.ingest_folder(spark, str(raw), root)
    got = pipeline.silver(spark, root, "RunStream").orderBy("activity_id", "time_s").collect()
    assert [(r.activity_id, r.time_s, r.lat, r.hr_bpm) for r in got] == [
        (1, 1, 10.5, None), (1, 2, None, 90), (2, 2, None, 99)
    ]
    rejected = Store(spark, root).read("bronze/Rejected").collect()
    assert [(r.file_name, r.column_name, r.value) for r in rejected] == [("a_run_1.csv.gz", "hr_bpm", "n/a")]
