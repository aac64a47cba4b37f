from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pacegrid import schema
from pacegrid.sources import clean, files, payloads, tables


def json_rows(spark, rows, payload):
    texts = spark.createDataFrame([(json.dumps(r),) for r in rows], "text string")
    return payloads.parse_payload(texts, "text", payload)


def test_read_csv_by_name_with_bom_and_gaps(spark, tmp_path):
    path = tmp_path / "athletes.csv"
    path.write_text(
        "﻿athlete_id,lastname,weight,extra\n1,Lê,60.0,x\n2,,abc,y\n16255637938,Z,,z\n",
        encoding="utf-8",
    )
    got = files.read_csv_table(spark, str(path), schema.ATHLETE)
    assert got.schema == schema.ATHLETE
    rows = got.orderBy("athlete_id").collect()
    assert [(r.athlete_id, r.lastname, r.weight, r.city) for r in rows] == [
        (1, "Lê", 60, None),
        (2, None, None, None),
        (16255637938, "Z", None, None),
    ]


def test_read_csv_other_encoding(spark, tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes("athlete_id,lastname\n1,José\n".encode("latin-1"))
    got = files.read_csv_table(spark, str(path), schema.ATHLETE, encoding="ISO-8859-1")
    assert got.first().lastname == "José"


def test_nan_text_is_missing(spark, tmp_path):
    path = tmp_path / "points.csv"
    path.write_text("activity_id,time_s,lat,hr_bpm\n1,0,nan,72.0\n1,1,10.5,\n")
    rows = files.read_csv_table(spark, str(path), schema.RUN_STREAM).orderBy("time_s").collect()
    assert [(r.lat, r.hr_bpm) for r in rows] == [(None, 72), (10.5, None)]


def test_read_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.read_keys(spark, path, "activity_id").count() == 0
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "activity_id bigint")
    files.land(df, path)
    keys = files.read_keys(spark, path, "activity_id").collect()
    assert sorted(r.activity_id for r in keys) == [1, 2]
    with pytest.raises(ValueError):
        files.land(df, path, "xlsx")


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "z int, x int")
    rows = files.union_by_name([a, b]).orderBy("x").collect()
    assert [tuple(r) for r in rows] == [(1, 2, None), (4, None, 3)]


def test_file_names(spark):
    names = {
        "an_2024-05-01_run_123.csv": ("stream", 123),
        "an_2024-05-01_run_123_best.csv": ("best", None),
        "an_2024-05-01_run_123_segments.csv": ("segments", None),
        "manual.csv": ("stream", None),
        "an_2024-05-01_run_16255637938.csv": ("stream", 16255637938),
    }
    df = spark.createDataFrame([(n,) for n in names], "n string")
    rows = df.select(
        files.file_kind(F.col("n")).alias("kind"), files.activity_id_of_file(F.col("n")).alias("id")
    ).collect()
    assert [(r.kind, r.id) for r in rows] == list(names.values())


def test_normalise_activities(spark):
    raw = [
        {
            "id": 1,
            "type": "Run",
            "distance": 5000.0,
            "elapsed_time": 1500,
            "start_date": "2024-05-01T23:30:00Z",
            "start_date_local": "2024-05-02T06:30:00Z",
            "total_elevation_gain": 12.5,
            "athlete_id": 9,
            "athlete_name": "An",
            "unknown": {"x": 1},
        },
        {"id": 2, "type": "Run", "distance": None, "start_date_local": "", "athlete_id": 9},
    ]
    rows = payloads.normalise_activities(json_rows(spark, raw, payloads.SUMMARY)).collect()
    first, second = sorted(rows, key=lambda r: r.activity_id)
    assert (first.date, first.distance_km, first.avg_pace_sec_km) == (dt.date(2024, 5, 2), 5.0, 300)
    assert first.start_time_utc == dt.datetime(2024, 5, 1, 23, 30)
    assert (second.duration_sec, second.distance_km, second.avg_pace_sec_km) == (0, 0.0, None)
    assert (second.date, second.elev_gain_m, second.source) == (None, 0.0, "API")


def test_explode_streams(spark):
    raw = [
        {
            "activity_id": 1,
            "time": {"data": [0, 1]},
            "latlng": {"data": [[1.0, 2.0], [3.0, 4.0]]},
            "heartrate": {"data": [100, None]},
        },
        {"activity_id": 2, "time": {"data": [0]}},
    ]
    got = payloads.explode_streams(json_rows(spark, raw, payloads.STREAMS)).orderBy("time_s")
    assert got.columns == schema.RUN_STREAM.names
    assert [(r.activity_id, r.lat, r.lon, r.hr_bpm, r.watts) for r in got.collect()] == [
        (1, 1.0, 2.0, 100, None),
        (1, 3.0, 4.0, None, None),
    ]


def test_explode_efforts(spark):
    effort = {"id": 5, "name": "5K", "elapsed_time": 1500, "activity": {"id": 1}, "athlete": {"id": 2}}
    raw = [
        {"id": 1, "sport_type": "Run", "best_efforts": [effort], "segment_efforts": [effort]},
        {"id": 2, "sport_type": "Ride", "best_efforts": [effort], "segment_efforts": []},
        {"id": 3, "sport_type": "run"},
    ]
    parsed = json_rows(spark, raw, payloads.DETAIL)
    assert [r.athlete_id for r in payloads.explode_efforts(parsed, "best").collect()] == [2]
    assert payloads.explode_efforts(parsed, "segments").count() == 1
    with pytest.raises(ValueError):
        payloads.explode_efforts(parsed, "other")


def test_clean_best_and_segments(spark):
    raw = spark.createDataFrame(
        [("Đèo".encode().decode("latin-1"), "{'id': 3, 'x': None}", "{'id': 4}", "2024-05-01T06:00:00Z", 2, 1)],
        "name string, activity string, athlete string, start_date string, kom_rank int, "
        "resource_state int",
    )
    best, segment = clean.clean_best(raw).first(), clean.clean_segments(raw).first()
    assert (best.activity_id, best.athlete_id) == (3, 4)
    assert best.start_date == dt.datetime(2024, 5, 1, 6)
    assert best.name != "Đèo" and segment.name == "Đèo"
    assert segment.kom_rank == 2
    assert "resource_state" not in best.asDict() and "activity" not in best.asDict()


def test_profiles(spark):
    raw = spark.createDataFrame([(1, "x", "An", 7)], "id int, bio string, firstname string, athlete_id int")
    assert clean.clean_profiles(payloads.profiles_to_table(raw)).columns == ["athlete_id", "firstname"]


def loaded(spark, path, columns="k, v"):
    rows = spark.read.parquet(path).selectExpr(*columns.split(", ")).collect()
    return sorted(tuple(r) for r in rows)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "k bigint, v string")


def test_insert_only_first_load_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    first = batch(spark, (1, "a"), (1, "a"), (2, "b"))  # duplicates inside a batch stay
    tables.insert_only(first, path, "k")
    tables.insert_only(first, path, "k")
    assert loaded(spark, path) == [(1, "a"), (1, "a"), (2, "b")]
    tables.insert_only(batch(spark, (2, "late"), (3, "c")), path, "k")
    assert loaded(spark, path) == [(1, "a"), (1, "a"), (2, "b"), (3, "c")]


def test_insert_only_keeps_rows_without_key(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.insert_only(batch(spark, (None, "x"), (1, "a")), path, "k")
    rows = spark.read.parquet(path).collect()
    assert sorted(r.v for r in rows) == ["a", "x"]


def test_upsert_last_load_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(batch(spark, *[(i, "old") for i in range(50)]), path, "k", buckets=4)
    change = batch(spark, (3, "new"), (99, "new"))
    for _ in range(2):
        tables.upsert(change, path, "k", buckets=4)
    rows = dict(loaded(spark, path))
    assert len(rows) == 51 and rows[3] == rows[99] == "new" and rows[4] == "old"


def test_upsert_leaves_other_buckets_alone(spark, tmp_path):
    path = tmp_path / "t"
    tables.upsert(batch(spark, *[(i, "old") for i in range(50)]), str(path), "k", buckets=8)
    before = set(path.rglob("*.parquet"))
    tables.upsert(batch(spark, (3, "new")), str(path), "k", buckets=8)
    after = set(path.rglob("*.parquet"))
    assert len(before & after) == len(before) - 1 == 7


def test_upsert_refuses_another_number_of_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    old = batch(spark, *[(i, "old") for i in range(50)])
    tables.upsert(old, path, "k", buckets=8)
    with pytest.raises(ValueError, match="8 buckets, not 16"):
        tables.upsert(old, path, "k", buckets=16)
    tables.append_table(old, str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="not laid out"):
        tables.upsert(old, str(tmp_path / "plain"), "k")
    assert len(loaded(spark, path)) == 50


def test_replace_groups_deletes_the_whole_group(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(a, label, d) for a in (1, 2) for label in ("5K", "10K") for d in (1, 2)]
    make = lambda rows: spark.createDataFrame(rows, "a int, label string, d int")
    tables.replace_groups(make(rows), path, ["a", "label"], buckets=4)
    tables.replace_groups(make([(1, "5K", 9)]), path, ["a", "label"], buckets=4)
    got = loaded(spark, path, "a, label, d")
    assert got == sorted([r for r in rows if r[:2] != (1, "5K")] + [(1, "5K", 9)])


def test_create_table_once(spark, tmp_path):
    for _ in range(2):
        tables.create_table(spark, "gold.labels", schema.DISTANCE_LABEL, str(tmp_path / "labels"))
    tables.seed_labels(spark).write.insertInto("gold.labels")
    assert spark.table("gold.labels").count() == 13
    assert dict(spark.table("gold.labels").dtypes)["standard_distance_m"] == "double"


def test_load_layers(spark, tmp_path):
    root = str(tmp_path)
    raw = spark.createDataFrame(
        [(1, "5K", 1500, 10, 7, 0, 5), (1, "5K", 1500, 10, 7, 0, 5), (2, "5K", 1400, 11, 7, 0, 5)],
        "id bigint, name string, elapsed_time int, activity_id bigint, athlete_id bigint, "
        "start_index int, end_index int",
    )
    for _ in range(2):
        tables.load_layers(raw, root, "RunBest")
    bronze = spark.read.parquet(f"{root}/bronze/RunBest")
    silver = spark.read.parquet(f"{root}/silver/RunBest")
    assert bronze.count() == 3 and "ingested_at" in bronze.columns and "end_index" in bronze.columns
    assert silver.count() == 2 and silver.columns == schema.RUN_BEST.names


def test_refresh_and_read_table(spark, tmp_path):
    path = str(tmp_path / "dim")
    assert tables.read_table(spark, path, schema.DISTANCE_LABEL).count() == 0
    for _ in range(2):
        tables.refresh_table(tables.seed_labels(spark), path)
    assert tables.read_table(spark, path, schema.DISTANCE_LABEL).count() == 13


def test_files_with_different_headers(spark, tmp_path):
    (tmp_path / "one.csv").write_text("time_s,hr_bpm,lat\n1,100.0,5\n2,,6\n")
    (tmp_path / "two.csv").write_text("lat,other,time_s\n7,x,3\n")
    (tmp_path / "empty.csv").write_text("")
    got = files.read_csv_table(spark, str(tmp_path), schema.RUN_STREAM).orderBy("time_s").collect()
    assert [(r.time_s, r.hr_bpm, r.lat) for r in got] == [(1, 100, 5.0), (2, None, 6.0), (3, None, 7.0)]
