from __future__ import annotations

import datetime as dt
import random
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from pacegrid import schema
from pacegrid.operators import forecast, trend

METRES = dict(schema.DISTANCE_LABELS)
AS_OF = dt.date(2024, 6, 1)


def efforts(spark, rows):
    """Rows of (id, label, sec, date, activity_id, athlete_id)."""
    return spark.createDataFrame(
        [
            (i, label, sec, d and dt.datetime.combine(d, dt.time(7)), act, ath)
            for i, label, sec, d, act, ath in rows
        ],
        "id bigint, name string, elapsed_time int, start_date timestamp, activity_id bigint, "
        "athlete_id bigint",
    )


def activities(spark, rows):
    return spark.createDataFrame(
        rows, "activity_id bigint, distance_km double, elev_gain_m double"
    )


def days(n):
    return AS_OF - dt.timedelta(days=n)


def test_trend_edges(spark):
    rows = [
        *[(i, "5K", 1500 - 10 * i, days(30 - i), i, 1) for i in range(4)],  # falling line
        *[(i, "10K", 3000, days(30 - i), i, 1) for i in range(3)],  # constant time
        *[(i, "15K", 100 + i, days(10), i, 1) for i in range(3)],  # one date
        *[(i, "20K", 2000 - 990 * i, days(3 - i), i, 1) for i in range(3)],  # below one second
        *[(i, "30K", 9000, days(i), i, 1) for i in range(2)],  # too few
        *[(i, "1K", 200 + i, days(i) if i else None, i, 1) for i in range(3)],  # a date missing
    ]
    got = {r.distance_label: r for r in trend.pb_trend(efforts(spark, rows), AS_OF).collect()}
    assert set(got) == {"5K", "10K", "15K", "20K"}
    assert got["5K"].predicted_best_sec == pytest.approx(1200)
    assert got["5K"].r_squared == pytest.approx(1)
    assert (got["10K"].predicted_best_sec, got["10K"].r_squared) == (3000.0, 0.0)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        slope, intercept = np.polyfit([float(days(10).toordinal())] * 3, [100.0, 101.0, 102.0], 1)
    assert got["15K"].r_squared == 0.0
    assert got["15K"].predicted_best_sec == pytest.approx(
        slope * AS_OF.toordinal() + intercept, rel=1e-9
    )
    assert got["20K"].predicted_best_sec == 1.0


def test_trend_at_checkpoints_equals_trend_of_earlier_efforts(spark):
    rng = random.Random(3)
    rows = [
        (i, rng.choice(["5K", "10K"]), rng.randrange(1000, 4000), days(rng.randrange(200)), i, i % 2)
        for i in range(120)
    ]
    rows += [(900 + i, "15K", 4000, days(150 + i), i, 1) for i in range(4)]
    rows += [(910 + i, "20K", 4000 + i, days(150), i, 1) for i in range(4)]
    points = [(0, days(50)), (0, days(120)), (1, days(100)), (1, days(10)), (1, days(199))]
    asked = spark.createDataFrame(points, "athlete_id bigint, as_of_date date")
    got = {
        (r.athlete_id, r.as_of_date, r.distance_label): (r.predicted_best_sec, r.r_squared)
        for r in trend.trend_at(efforts(spark, rows), asked).collect()
    }
    expected = {}
    for athlete, at in points:
        earlier = [r for r in rows if r[5] == athlete and r[3] < at]
        fits = trend.pb_trend(efforts(spark, earlier), at).collect() if earlier else []
        for r in fits:
            expected[(athlete, at, r.distance_label)] = (r.predicted_best_sec, r.r_squared)
    assert set(got) == set(expected) and len(got) > 8
    for key, value in expected.items():
        assert got[key] == pytest.approx(value, rel=1e-7, abs=1e-7)


def brute_source(rows, parents, athlete, at):
    """Labels in order of preference, then the four pools in turn, then the fastest."""
    mine = [r for r in rows if r[5] == athlete and r[3] < at and r[2] is not None]
    for label in schema.SOURCE_PRIORITY:
        pool = [r for r in mine if r[1] == label]

        def fits(r, label=label):
            km = parents.get(r[4], (None, None))[0]
            return km is not None and 0.9 * METRES[label] <= km * 1000 <= 1.2 * METRES[label]

        near = [r for r in pool if r[3] >= at - dt.timedelta(days=90)]
        for tier, rows_of in enumerate(
            [[r for r in near if fits(r)], [r for r in pool if fits(r)], near, pool], 1
        ):
            if rows_of:
                best = min(rows_of, key=lambda r: (r[2], r[0]))
                return label, tier, best[0]
    return None


def test_source_effort_against_nested_search(spark):
    rng = random.Random(11)
    rows = [
        (
            i,
            rng.choice([*schema.SOURCE_PRIORITY[:3], "Marathon"]),
            rng.choice([None, *range(1000, 1010)]),
            days(rng.randrange(400)),
            rng.randrange(60),
            rng.randrange(8),
        )
        for i in range(300)
    ]
    parents = {a: (rng.choice([None, 4.9, 10.0, 14.0, 30.0]), 50.0) for a in range(50)}
    points = sorted({(rng.randrange(9), days(rng.randrange(420))) for _ in range(60)})
    got = forecast.source_effort(
        efforts(spark, rows),
        activities(spark, [(a, *v) for a, v in parents.items()]),
        spark.createDataFrame(points, "athlete_id bigint, as_of_date date"),
    ).collect()
    found = {
        (r.athlete_id, r.as_of_date): (r.source_distance_label, r.source_tier, r.source_id)
        for r in got
    }
    expected = {
        p: e for p in points if (e := brute_source(rows, parents, *p)) is not None
    }
    assert found == expected
    assert {tier for _, tier, _ in expected.values()} == {1, 2, 3, 4}


def test_source_effort_boundaries(spark):
    at = AS_OF
    acts = activities(spark, [(1, 9.0, 90.0), (2, 12.0, 0.0), (3, 12.001, 0.0), (4, 8.999, 0.0)])
    asked = spark.createDataFrame([(1, at)], "athlete_id bigint, as_of_date date")

    def chosen(*rows):
        found = forecast.source_effort(efforts(spark, list(rows)), acts, asked).collect()
        return [(r.source_id, r.source_tier) for r in found]

    assert chosen((1, "10K", 100, at, 1, 1)) == []  # on the day itself: too late
    assert chosen((1, "10K", 100, days(90), 1, 1)) == [(1, 1)]
    assert chosen((1, "10K", 100, days(91), 1, 1)) == [(1, 2)]
    assert chosen((1, "10K", 100, days(90), 2, 1)) == [(1, 1)]
    assert chosen((1, "10K", 100, days(90), 3, 1)) == [(1, 3)]
    assert chosen((1, "10K", 100, days(91), 4, 1)) == [(1, 4)]
    assert chosen((1, "10K", 100, days(5), 99, 1)) == [(1, 3)]  # parent unknown
    assert chosen((1, "5K", 1, days(5), 1, 1), (2, "10K", 999, days(300), 3, 1)) == [(2, 4)]


@pytest.fixture()
def one_race(spark):
    races = spark.createDataFrame(
        [(1, 77, "Half-Marathon", AS_OF, 6000, 42.195, 21.0975)],
        "athlete_id bigint, activity_id bigint, target_distance_label string, race_date date, "
        "actual_sec int, elev_gain_m double, distance_km double",
    )
    runs = efforts(spark, [(1, "10K", 2400, days(40), 1, 1), (2, "10K", 2300, days(10), 1, 1)])
    return races, runs, activities(spark, [(1, 10.0, 50.0)])


def test_backtest_checkpoints(spark, one_race):
    got = forecast.race_backtest(*one_race).collect()
    assert {r.as_of_date for r in got} == {days(28), days(14), days(7)}  # nothing 8 weeks before
    by = {(r.method, r.as_of_date): r for r in got}
    riegel = by[("riegel", days(28))]
    assert riegel.predicted_sec == pytest.approx(2400 * 2.10975**1.06)
    assert riegel.error_sec == pytest.approx(riegel.predicted_sec - 6000)
    assert riegel.error_pct == pytest.approx(riegel.error_sec / 60)
    assert by[("riegel", days(7))].source_pb_sec == 2300
    climb = by[("elevation_adjusted", days(28))].predicted_sec
    assert climb == pytest.approx((2400 - 2 * 5 * 10) * 2.10975**1.06 + 2 * 2 * 21.0975)
    final = forecast.final_forecast(forecast.race_backtest(*one_race)).collect()
    assert [(r.as_of_date, r.source_pb_sec) for r in final] == [(days(7), 2300.0)] * 3


@pytest.mark.parametrize(
    "r2, sec, blended", [(0.5, 2000.0, True), (0.499, 2000.0, False), (0.9, 120.0, False)]
)
def test_blend_conditions(spark, one_race, r2, sec, blended):
    fits = spark.createDataFrame(
        [(1, "10K", sec, AS_OF, r2)], schema.PB_PREDICTION
    )
    plain = {(r.method, r.as_of_date): r.predicted_sec for r in forecast.race_backtest(*one_race).collect()}
    for r in forecast.race_backtest(*one_race, trend=fits).collect():
        expected = plain[(r.method, r.as_of_date)]
        if blended:
            expected = 0.5 * expected + 0.5 * sec * 2.10975**1.06
        assert r.predicted_sec == pytest.approx(expected)


def test_sensitivity_and_what_if(spark):
    pbs = spark.createDataFrame(
        [(1, "10K", 10000.0, 2400.0)],
        "athlete_id bigint, source_label string, source_m double, source_sec double",
    )
    grid = forecast.sensitivity_grid(pbs).collect()
    assert len(grid) == 150
    sweep = sorted({r.source_sec for r in grid})
    assert sweep == pytest.approx(list(np.linspace(2400 * 0.7, 2400 * 1.3, 50)))
    scenarios = [
        {"delta_sec": 60, "target": "5K", "elev": 10.0, "exponent": 1.10},
        {"delta_sec": 0, "target": "400m", "elev": 0.0, "exponent": 1.06},
    ]
    got = {(r.scenario, r.method): r for r in forecast.what_if(pbs, scenarios).collect()}
    assert got[(0, "riegel")].predicted_sec == pytest.approx(2460 * 0.5**1.10)
    assert got[(0, "elevation_adjusted")].predicted_sec == pytest.approx(
        2460 * 0.5**1.06 + 2 * 10 * 5
    )
    assert got[(0, "riegel")].pace.endswith("/km")
    assert got[(1, "vdot")].predicted_sec is not None


def test_no_vdot_where_out_of_range(spark):
    pairs = spark.createDataFrame(
        [(60.0, 400.0, 0.0, 400.0, 0.0), (45.0, 400.0, None, 400.0, None)],
        "source_sec double, source_m double, source_elev double, target_m double, "
        "target_elev double",
    )
    rows = forecast.forecast(pairs).where(F.col("method") == "vdot").collect()
    got = {r.source_sec: r.predicted_sec for r in rows}
    assert got[60.0] == pytest.approx(60.0)
    assert got[45.0] is None


def test_pivot_and_error(spark, one_race):
    rf = forecast.race_backtest(*one_race)
    names = spark.createDataFrame(
        [(1, None, "Lee")], "athlete_id bigint, firstname string, lastname string"
    )
    (row,) = forecast.forecast_pivot(rf, names).collect()
    last = {r.method: r.error_pct for r in forecast.final_forecast(rf).collect()}
    assert (row.name, row.actual_time) == ("Lee", "1:40:00")
    assert row.riegel == pytest.approx(round(last["riegel"], 1))
    errors = {r.method: r.mape for r in forecast.method_error(rf).collect()}
    assert errors == pytest.approx({m: abs(v) for m, v in last.items()})
