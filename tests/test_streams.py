from __future__ import annotations

import datetime as dt
import math
import random

import pytest

from pacegrid import schema
from pacegrid.operators import dedupe, streams

CHUNK = 1 << streams.CHUNK_BITS
POINT = "activity_id bigint, time_s int, lat double, lon double, dist_m double, alt_m double, "
POINT += "hr_bpm smallint, cadence smallint, watts int"


def points(spark, rows):
    return spark.createDataFrame(rows, schema.RUN_STREAM)


def point(activity, t, lat=10.0, lon=106.0, dist=None, alt=None, hr=None, cad=None, watts=None):
    return (activity, t, lat, lon, dist, alt, hr, cad, watts)


def haversine(a, b):
    if None in (*a, *b):
        return 0.0
    (la1, lo1), (la2, lo2) = [tuple(map(math.radians, p)) for p in (a, b)]
    h = math.sin((la2 - la1) / 2) ** 2
    h += math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * 6_371_000 * math.asin(math.sqrt(h))


def brute_splits(rows):
    """Sequential walk over each activity."""
    out = {}
    for activity in sorted({r[0] for r in rows}):
        cum, previous = 0.0, None
        for r in sorted((r for r in rows if r[0] == activity), key=lambda r: r[1]):
            hop = haversine(previous, (r[2], r[3])) if previous else 0.0
            previous, cum = (r[2], r[3]), cum + hop
            out.setdefault((activity, int(cum // 1000) + 1), []).append((r, hop, cum))
    return out


def brute_metrics(rows, activity):
    rows = sorted((r for r in rows if r[0] == activity), key=lambda r: r[1])
    alts = [r[5] for r in rows if r[5] is not None]
    steps = sum(
        (r[7] or 0) * (r[1] - p[1]) / 60 for p, r in zip(rows, rows[1:]) if r[7] is not None
    )
    up = sum(max(b - a, 0) for a, b in zip(alts, alts[1:])) if alts else None
    down = sum(max(a - b, 0) for a, b in zip(alts, alts[1:])) if alts else None
    last = rows[-1][4]
    stride = last / (2 * steps) if steps > 0 and last is not None else None
    return up, down, stride


def random_rows(seed):
    """Three activities that cross many chunk boundaries, with gaps in every channel."""
    rng = random.Random(seed)
    rows = []
    for activity in range(3):
        t, lat, lon = rng.randrange(5), 10.0, 106.0
        for _ in range(400):
            t += rng.choice([1, 1, 5, 60, CHUNK // 2, CHUNK * 2])
            lat, lon = lat + rng.gauss(0, 0.002), lon + rng.gauss(0, 0.002)
            gap = lambda value, p=0.2: None if rng.random() < p else value
            here = gap((lat, lon)) or (None, None)
            rows.append(
                point(
                    activity,
                    t,
                    *here,
                    gap(float(t)),
                    gap(rng.uniform(0, 300)),
                    gap(rng.randrange(90, 190)),
                    gap(rng.randrange(60, 100)),
                    gap(rng.randrange(100, 400), 0.9),
                )
            )
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_km_splits_against_sequential_walk(spark, seed):
    rows = random_rows(seed)
    expected = brute_splits(rows)
    got = streams.km_splits(points(spark, rows)).collect()
    assert len(got) == len(expected)
    for r in got:
        part = expected[(r.activity_id, r.segment_number)]
        times = [p[0][1] for p in part]
        assert (r.segment_start_time, r.segment_end_time) == (min(times), max(times))
        assert r.duration_s == max(times) - min(times)
        assert r.cumulative_distance_m == pytest.approx(part[-1][2])
        length = sum(p[1] for p in part)
        assert r.segment_distance_m == pytest.approx(length)
        if length:
            assert r.pace_sec_per_km == pytest.approx(r.duration_s / (length / 1000))
        else:
            assert r.pace_sec_per_km is None
        first = next((p[0][2] for p in part if p[0][2] is not None), None)
        assert r.start_lat == first
        hr = [p[0][6] for p in part if p[0][6] is not None]
        assert r.avg_hr_bpm == (pytest.approx(sum(hr) / len(hr)) if hr else None)


@pytest.mark.parametrize("seed", [1, 2])
def test_metrics_against_sequential_walk(spark, seed):
    rows = random_rows(seed)
    got = {r.activity_id: r for r in streams.activity_metrics(points(spark, rows)).collect()}
    for activity, r in got.items():
        up, down, stride = brute_metrics(rows, activity)
        assert r.total_ascent == pytest.approx(up)
        assert r.total_descent == pytest.approx(down)
        assert (r.stride_len_m is None) == (stride is None)
        if stride is not None:
            assert r.stride_len_m == pytest.approx(stride)
        hr = [x[6] for x in rows if x[0] == activity and x[6] is not None]
        assert r.hr_avg == pytest.approx(sum(hr) / len(hr))
        assert r.hr_max == max(hr)


def test_single_point(spark):
    rows = [point(1, 0, dist=0.0, alt=5.0, cad=80)]
    split = streams.km_splits(points(spark, rows)).collect()
    assert [(s.segment_number, s.duration_s, s.pace_sec_per_km) for s in split] == [(1, 0, None)]
    m = streams.activity_metrics(points(spark, rows)).first()
    assert (m.total_ascent, m.total_descent, m.stride_len_m) == (0.0, 0.0, None)


def test_altitude_edges(spark):
    rows = [point(1, t) for t in range(3)]  # no altitude at all
    rows += [point(2, t, alt=a) for t, a in enumerate([10.0, None, 14.0, None, 11.0])]
    rows += [point(3, t, alt=7.0) for t in range(3)]
    got = {r.activity_id: r for r in streams.activity_metrics(points(spark, rows)).collect()}
    assert (got[1].total_ascent, got[1].total_descent, got[1].elev_min) == (None, None, None)
    assert (got[2].total_ascent, got[2].total_descent) == (4.0, 3.0)
    assert (got[3].total_ascent, got[3].total_descent) == (0.0, 0.0)
    assert got[1].hr_avg is None and got[1].hr_max is None


def test_time_gaps_count_over_rows_without_cadence(spark):
    rows = [point(1, 0, cad=60), point(1, 10), point(1, 20, cad=90, dist=60.0)]
    m = streams.activity_metrics(points(spark, rows)).first()
    assert m.stride_len_m == pytest.approx(60 / (2 * 90 * 10 / 60))


def test_missing_coordinate_gives_no_hop(spark):
    rows = [point(1, 0), point(1, 1, None, None), point(1, 2, 10.005)]
    (split,) = streams.km_splits(points(spark, rows)).collect()
    assert split.segment_distance_m == 0.0 and split.pace_sec_per_km is None


def test_long_hop_skips_kilometres(spark):
    rows = [point(1, 0), point(1, 60, 10.05)]  # about 5.56 km in one hop
    got = streams.km_splits(points(spark, rows)).collect()
    assert sorted(r.segment_number for r in got) == [1, 6]


def test_one_hot_activity_spreads_over_chunks(spark):
    """Rows of one activity do not end up in one window group."""
    rows = [point(1, t * CHUNK // 4) for t in range(64)]
    hops = streams.hops(points(spark, rows))
    assert hops.count() == 64
    plan = hops._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(activity_id" in plan and "chunk" in plan


def test_first_gps_point_and_enrich(spark):
    activities = spark.createDataFrame(
        [(1, 9, "A", dt.date(2024, 1, 1), "Run", 5.0), (2, 9, "A", dt.date(2024, 1, 2), "Run", 6.0)],
        "activity_id bigint, athlete_id bigint, athlete_name string, date date, "
        "activity_type string, distance_km double",
    )
    stream = points(
        spark, [point(1, 0, None, None), point(1, 5, 1.0, 2.0, hr=150), point(1, 6, 3.0, 4.0)]
    )
    (start,) = streams.first_gps_point(activities, stream).collect()
    assert (start.activity_id, start.start_lat, start.start_lon) == (1, 1.0, 2.0)
    metrics = streams.activity_metrics(stream)
    rows = streams.enrich_activities(activities, metrics).orderBy("activity_id").collect()
    assert [r.hr_avg for r in rows] == [150.0, None]


def test_channel_series_leaves_out_silent_activities(spark):
    stream = points(
        spark,
        [point(1, 0, hr=100), point(1, 1), point(2, 0), point(3, 0, watts=5), point(3, 1, watts=6)],
    )
    got = streams.channel_series(stream).orderBy("activity_id", "time_s").collect()
    assert [(r.activity_id, r.has_hr, r.has_watts) for r in got] == [
        (1, True, False),
        (1, True, False),
        (3, False, True),
        (3, False, True),
    ]


def test_dedupe_keeps_first_by_order(spark):
    df = spark.createDataFrame(
        [(1, 0, 5, "b"), (1, 0, 4, "c"), (1, 1, 9, "a"), (1, 0, 4, "b")],
        "activity_id int, time_s int, seq int, v string",
    )
    got = dedupe.dedupe_on(df, ["activity_id", "time_s"], ["seq"]).orderBy("time_s").collect()
    assert [tuple(r) for r in got] == [(1, 0, 4, "b"), (1, 1, 9, "a")]
    report = dedupe.dedupe_report(df, ["activity_id", "time_s"]).first()
    assert tuple(report) == (4, 2, 2)
    empty = dedupe.dedupe_report(df.where("seq < 0"), ["activity_id", "time_s"]).first()
    assert tuple(empty) == (0, 0, 0)
