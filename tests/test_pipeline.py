from __future__ import annotations

import datetime as dt

import pytest

from pacegrid import schema
from pacegrid.operators import quality
from pacegrid.plans import pipeline
from pacegrid.sources import tables
from pacegrid.streaming import ingest

AS_OF = dt.date(2024, 6, 1)
BEST_HEADER = (
    "id,resource_state,name,activity,athlete,elapsed_time,moving_time,start_date,"
    "start_date_local,distance,pr_rank,achievements,start_index,end_index\n"
)


def write_activity(folder, activity, n_points, day):
    base = f"an_{day}_run_{activity}"
    lines = ["time_s,lat,lon,dist_m,alt_m,hr_bpm,cadence,watts"]
    lines += [f"{t},{10 + t * 0.001},106.0,{t * 111.0},{t % 3},{100 + t}.0,80," for t in range(n_points)]
    (folder / f"{base}.csv").write_text("\n".join(lines) + "\n")
    rows = [
        f"{activity}{i},2,{label},\"{{'id': {activity}, 'visibility': None}}\",\"{{'id': 7}}\","
        f"{sec - activity},{sec},{day}T06:00:00Z,{day}T13:00:00Z,5000,,[],0,9"
        for i, (label, sec) in enumerate([("5K", 1500), ("10K", 3200)])
    ]
    (folder / f"{base}_best.csv").write_text(BEST_HEADER + "\n".join(rows) + "\n")


def summaries(spark, ids):
    rows = [
        (i, "Run", 7, "An", dt.date(2024, 5, i), dt.datetime(2024, 5, i, 6), 3000, 10.0, 40.0)
        for i in ids
    ]
    return spark.createDataFrame(
        rows,
        "activity_id bigint, activity_type string, athlete_id bigint, athlete_name string, "
        "date date, start_time_utc timestamp, duration_sec int, distance_km double, "
        "elev_gain_m double",
    )


def counts(spark, root):
    return {t: pipeline.silver(spark, root, t).count() for t in schema.SILVER}


def test_files_to_gold(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    for activity in (1, 2, 3):
        write_activity(raw, activity, 20, f"2024-05-0{activity}")
    (raw / "track.gpx").write_text("<gpx/>")
    (raw / "segments.csv").write_text("own,output\n1,2\n")

    ingest.ingest_folder(spark, str(raw), root)
    pipeline.enrich_new_activities(spark, root, summaries(spark, (1, 2, 3)))
    assert counts(spark, root) == {
        "RunStream": 60,
        "RunBest": 6,
        "RunSegment": 0,
        "RunSplitKilometer": 9,
        "Activities": 3,
        "Athlete": 0,
    }

    # A new activity, and a late file for a known one, which is left out; nothing is added twice.
    write_activity(raw, 4, 10, "2024-05-04")
    (raw / "late_2024-05-01_run_1.csv").write_text(
        "time_s,lat,lon,dist_m,alt_m,hr_bpm,cadence,watts\n999,1,1,1,1,1,1,1\n"
    )
    ingest.ingest_folder(spark, str(raw), root)
    pipeline.enrich_new_activities(spark, root, summaries(spark, (1, 2, 3, 4)))
    after = counts(spark, root)
    assert (after["RunStream"], after["Activities"], after["RunBest"]) == (70, 4, 8)
    row = pipeline.silver(spark, root, "Activities").where("activity_id = 4").first()
    assert (row.hr_max, row.cad_max, row.elev_max) == (109, 80, 2.0)

    races = spark.createDataFrame(
        [(7, 99, "Half-Marathon", dt.date(2024, 5, 28), 7000, 42.0, 21.0975)],
        "athlete_id bigint, activity_id bigint, target_distance_label string, race_date date, "
        "actual_sec int, elev_gain_m double, distance_km double",
    )
    for _ in range(2):  # rebuilt, not added to
        pipeline.build_gold(spark, root, AS_OF, races)
    gold = {
        t: tables.read_table(spark, f"{root}/gold/{t}", s) for t, s in schema.GOLD.items()
    }
    assert gold["activity_start_location"].count() == 4
    assert gold["dim_date"].count() == 4 + 14
    assert gold["PBPrediction"].count() == 2
    assert gold["RaceForecast"].count() == 6  # two of the four checkpoints have efforts
    suite = quality.quality_suite(
        quality.gold_checks(
            gold["dim_date"],
            gold["activity_start_location"],
            gold["dim_distance_label"],
            gold["PBPrediction"],
            gold["RaceForecast"],
            schema.METHODS,
        )
    ).collect()
    assert len(suite) == 17 and all(r.passed for r in suite)


def test_failed_batch_is_repeated_cleanly(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    (raw / "a.csv").write_text("k,v\n1,a\n2,b\n")
    path, checkpoint = f"{root}/t", f"{root}/checkpoint"
    shape = schema.columns("k bigint, v string")
    rows = spark.readStream.schema(shape).option("header", True).csv(str(raw))

    def write_then_fail(batch):
        tables.insert_only(batch, path, "k")
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        ingest.ingest_stream(rows, write_then_fail, checkpoint).awaitTermination()
    query = ingest.ingest_table(spark, str(raw), shape, path, "k", checkpoint)
    query.awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]


def test_quality_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", "x"), (1, "b", "x"), (None, "a", "z"), (None, "a", "z")],
        "id int, label string, method string",
    )
    assert quality.not_null(df, "id").count() == 2
    assert [r.id for r in quality.unique(df, "id").collect()] == [1]
    assert quality.unique_combo(df, ["id", "label"]).count() == 1
    assert quality.accepted_values(df, "method", ["x", "y"]).count() == 2
    checks = quality.TableChecks(
        "t", df, ["id", "label", "method"], ["id"], {"method": ["x"]}, unique_combo=True
    )
    got = {r.test: (r.n_failures, r.passed) for r in quality.quality_suite([checks]).collect()}
    assert got == {
        "t.not_null_id": (2, False),
        "t.accepted_values_method": (2, False),
        "t.unique_key": (1, False),
    }
    single = quality.TableChecks("t", df, ["id"], ["id"], unique=True)
    assert {r.test: r.n_failures for r in single.failures().collect()} == {
        "t.not_null_id": 2,
        "t.unique_id": 1,
    }
    empty = quality.TableChecks("t", df.where("id > 9"), ["id"], ["id"], unique=True)
    assert [r.n_failures for r in empty.failures().collect()] == [0, 0]


def test_columns_by_name_and_files_of_one_activity_together(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    (raw / "a_run_1.csv").write_text("time_s,lat,hr_bpm\n1,10.5,120\n")
    (raw / "b_run_1.csv").write_text("hr_bpm,time_s\n99.0,2\n")
    ingest.ingest_folder(spark, str(raw), root)
    got = pipeline.silver(spark, root, "RunStream").orderBy("time_s").collect()
    assert [(r.time_s, r.lat, r.hr_bpm) for r in got] == [(1, 10.5, 120), (2, None, 99)]
