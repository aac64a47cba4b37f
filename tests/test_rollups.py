from __future__ import annotations

import datetime as dt

import pytest

from pacegrid.operators import calendar, rankings, readiness, rollups

AS_OF = dt.date(2025, 1, 8)  # a Wednesday


def day(offset):
    return AS_OF + dt.timedelta(days=offset)


def activities(spark, rows):
    """Rows of (activity_id, athlete_id, date, km, sec)."""
    full = [
        (i, a, d, dt.datetime.combine(d, dt.time(6)), km, sec, 10.0, 150.0, 80.0, f"A{a}")
        for i, a, d, km, sec in rows
    ]
    return spark.createDataFrame(
        full,
        "activity_id bigint, athlete_id bigint, date date, start_time_utc timestamp, "
        "distance_km double, duration_sec int, elev_gain_m double, hr_avg double, "
        "cad_avg double, athlete_name string",
    )


@pytest.fixture()
def athletes(spark):
    return spark.createDataFrame(
        [(1, "Ann", "Lee"), (2, "Bo", None), (3, None, None)],
        "athlete_id bigint, firstname string, lastname string",
    )


def test_week_totals_and_change(spark):
    acts = activities(
        spark,
        [
            (1, 1, day(0), 10.0, 3000),
            (2, 2, day(-2), 5.0, 1500),  # Monday of this week
            (3, 1, day(-3), 12.0, 4000),  # Sunday of last week
            (4, 1, day(-10), 99.0, 1),  # two weeks back
        ],
    )
    weeks = rollups.week_totals(acts, AS_OF)
    got = {r.week_rel: (r.total_km, r.n_runs, r.total_sec) for r in weeks.collect()}
    assert got == {0: (15.0, 2, 4500), 1: (12.0, 1, 4000)}
    change = {r.metric: (r.pct, r.pct_text) for r in rollups.wow(weeks).collect()}
    assert change["total_km"] == (25.0, "+25.0%")
    assert change["n_runs"] == (100.0, "+100.0%")
    none = rollups.wow(rollups.week_totals(acts.where("activity_id < 3"), AS_OF)).collect()
    assert {(r.last_week, r.pct, r.pct_text) for r in none} == {(0.0, None, "")}


def test_empty_month_is_one_row(spark):
    acts = activities(spark, [(1, 1, day(-40), 10.0, 3000)])
    row = rollups.month_totals(acts, AS_OF).first()
    assert tuple(row) == (None, 0, None)


def test_history_bound_is_strict(spark):
    acts = activities(
        spark,
        [
            (1, 1, dt.date(2024, 1, 8), 1.0, 60),
            (2, 1, dt.date(2024, 1, 9), 2.0, 60),
            (3, 1, dt.date(2024, 1, 10), 4.0, 60),
            (4, 1, dt.date(2024, 1, 11), 8.0, 60),
        ],
    )
    assert rollups.history(acts, "month", AS_OF).first().distance_km == 14.0
    assert rollups.history(acts, "week", AS_OF).first().distance_km == 8.0
    with pytest.raises(ValueError):
        rollups.history(acts, "year", AS_OF)


def test_runner_stats_and_day_runs(spark, athletes):
    acts = activities(
        spark,
        [(1, 3, day(0), 10.0, 3000), (2, 3, day(0), 5.0, 1500), (3, 3, day(-1), 0.0, 600)],
    )
    (r,) = rollups.runner_stats(acts, athletes, AS_OF).collect()
    assert (r.name, r.run_days, r.run_count, r.total_time) == ("", 2, 3, "1:25:00")
    runs = rollups.day_runs(acts, athletes, AS_OF).orderBy("activity_id").collect()
    assert [(x.name, x.pace_label) for x in runs] == [
        ("3", "5:00/km | 10.0 km"),
        ("3", "5:00/km | 5.0 km"),
    ]
    assert rollups.day_runs(acts, athletes, day(-1)).count() == 0


def test_day_grid_fills_days_off(spark, athletes):
    acts = activities(spark, [(1, 1, day(0), 10.0, 3000), (2, 1, day(-30), 7.0, 1)])
    grid = rollups.day_grid(calendar.dim_date(acts, AS_OF), acts, athletes, AS_OF)
    rows = grid.collect()
    assert len(rows) == 3 * 28
    assert sum(r.km for r in rows) == 10.0
    (run,) = [r for r in rows if r.km > 0]
    assert (run.date, run.day_name, run.day_of_week, run.week_number) == (
        AS_OF,
        "Wednesday",
        3,
        "Week 1",
    )


def test_dim_date(spark):
    acts = activities(spark, [(1, 1, dt.date(2024, 12, 25), 1.0, 1), (2, 1, AS_OF, 1.0, 1)])
    rows = {r.date: r for r in calendar.dim_date(acts, AS_OF).collect()}
    assert min(rows) == dt.date(2024, 12, 18) and max(rows) == dt.date(2025, 1, 15)
    assert len(rows) == 29
    r = rows[dt.date(2024, 12, 30)]
    assert (r.iso_year, r.iso_week, r.day_of_week) == (2024, 1, 1)
    assert rows[day(3)].days_ago == -3 and rows[day(7)].week_relative_to_today == -1
    assert calendar.dim_date(acts.where("activity_id < 0"), AS_OF).count() == 0


def test_top_bottom_and_ties(spark, athletes):
    acts = activities(
        spark, [(1, 1, day(0), 10.0, 100), (2, 2, day(0), 10.0, 200), (3, 3, day(0), 0.0, 300)]
    )
    per_athlete = rankings.week_per_athlete(acts, AS_OF)
    best = {r.metric: r for r in rankings.top_bottom(per_athlete, athletes).collect()}
    assert (best["total_km"].top_name, best["total_km"].bottom_name) == ("Ann Lee", "Ann Lee")
    assert (best["total_sec"].top_name, best["total_sec"].bottom_name) == ("3", "Ann Lee")
    ties = rankings.top_bottom_ties(per_athlete, athletes)
    rows = [(r.metric, r.side, r.name, r.n_tied) for r in rankings.tied_rows(ties).collect()]
    assert [x[2] for x in rows if x[:2] == ("total_km", "top")] == ["Ann Lee", "Bo"]
    assert {x[3] for x in rows if x[:2] == ("n_runs", "bottom")} == {3}
    still = rankings.top_bottom(
        rankings.week_per_athlete(acts.where("activity_id = 3"), AS_OF), athletes
    )
    only = {r.metric: (r.top_name, r.bottom_name, r.bottom_val) for r in still.collect()}
    assert only["total_km"] == ("3", "3", 0.0)


def test_many_ties_keep_all_rows(spark, athletes):
    acts = activities(spark, [(i, i, day(0), 10.0, 100) for i in range(1, 1502)])
    ties = rankings.top_bottom_ties(rankings.week_per_athlete(acts, AS_OF), athletes)
    got = rankings.tied_rows(ties)
    assert got.count() == 6 * 1501
    assert {r.n_tied for r in got.select("n_tied").distinct().collect()} == {1501}


def test_recent_and_latest(spark, athletes):
    acts = activities(spark, [(i, i % 2 + 1, day(-(i // 2)), 1.0 + i, 600) for i in range(50)])
    got = rankings.recent(acts, 20).collect()
    assert len(got) == 40 and {r.athlete_id for r in got} == {1, 2}
    assert max(r.activity_id for r in got) == 39
    one = rankings.recent(acts, 3, athlete_id=1).orderBy("rank").collect()
    assert [r.activity_id for r in one] == [0, 2, 4]
    assert one[0].label == "2025-01-08 — 1.0 km (10:00)"
    assert rankings.latest_activity(acts, athletes).first().activity_id == 1
    assert rankings.latest_run_text(acts).first().latest_run == "A2 - Jan 8, 2025 (06:00)"


def test_race_athletes_falls_back_to_all(spark, athletes):
    acts = activities(spark, [(1, 1, day(0), 21.2, 6000), (2, 7, day(0), 21.2, 6000)])
    got = readiness.race_athletes(acts, athletes, 19, 23, day(-1), day(1)).collect()
    assert [(r.athlete_id, r.name) for r in got] == [(1, "Ann Lee")]
    assert readiness.race_athletes(acts, athletes, 50, 60, day(-1), day(1)).count() == 3


def test_training_block_and_readiness(spark):
    race = dt.date(2025, 1, 5)  # a Sunday
    monday = lambda back: dt.date(2024, 12, 30) - dt.timedelta(weeks=back)
    acts = activities(
        spark,
        [
            (1, 1, monday(8), 20.0, 1),
            (2, 1, monday(8), 20.0, 1),
            (3, 1, monday(8), 10.0, 1),
            (4, 1, monday(5), 50.0, 1),  # same volume, later: the earlier peak counts
            (5, 1, monday(2), 25.0, 1),
            (6, 1, monday(1), 27.0, 1),
            (7, 1, monday(30), 99.0, 1),  # before the block
            (8, 2, monday(4), 0.0, 1),
            (9, 2, monday(3), 5.0, 1),
        ],
    )
    block = readiness.training_block(acts, race)
    ramp = [
        (r.week_start_date, r.ramp_pct, r.ramp_band)
        for r in readiness.ramp_rate(block).orderBy("athlete_id", "week_start_date").collect()
    ]
    assert ramp == [
        (monday(5), 0.0, "green"),
        (monday(2), -50.0, "red"),
        (monday(1), 8.0, "green"),
    ]  # athlete 2 rose from a zero week: no percentage
    got = {r.athlete_id: r for r in readiness.readiness(block, monday(2)).collect()}
    assert got[1].peak_week == monday(8) and got[1].longest_run == 50.0 and got[1].hit_18k
    assert got[1].consistency == 25.0
    assert (got[1].taper_km, got[1].taper_drop) == (25.0, -50.0)
    assert (got[2].taper_km, got[2].taper_drop) == (None, None)


def test_personal_bests_lists_every_distance(spark, athletes):
    efforts = spark.createDataFrame(
        [(1, "5K", 1500), (1, "5K", 1400), (1, "10K", 3000), (1, "odd", 1), (2, "20K", 9000)],
        "athlete_id bigint, name string, elapsed_time int",
    )
    got = rankings.personal_bests(athletes, efforts, athlete_id=1).orderBy("sort_order").collect()
    assert len(got) == 13
    assert {r.distance_label: r.personal_best for r in got if r.pb_sec} == {
        "5K": "23:20",
        "10K": "50:00",
    }
    preferred = {r.athlete_id: r.source_label for r in rankings.preferred_pb(efforts).collect()}
    assert preferred == {1: "10K", 2: "20K"}
