from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from pacegrid.functions import calendar, geo, race, text


def one(spark, column, **values):
    """Evaluate a column over one row of literals."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first().x


def strings(spark, values):
    return spark.createDataFrame([(v,) for v in values], "s string")


@pytest.mark.parametrize(
    "seconds, expected",
    [
        (59, "0:59"),
        (60, "1:00"),
        (3599.4, "59:59"),
        (3599.5, "1:00:00"),
        (0.5, "0:00"),
        (1.5, "0:02"),
        (3600, "1:00:00"),
        (90061, "25:01:01"),
        (None, "-"),
    ],
)
def test_format_time(spark, seconds, expected):
    value = None if seconds is None else float(seconds)
    assert one(spark, text.format_time(F.lit(value).cast("double"))) == expected


def test_display_name(spark):
    rows = spark.createDataFrame(
        [(1, "Ann", "Lee"), (2, None, "Lee"), (3, None, None), (4, " ", "")],
        "id bigint, f string, l string",
    )
    with_id = text.display_name(F.col("f"), F.col("l"), F.col("id"))
    without = text.display_name(F.col("f"), F.col("l"))
    got = rows.select(with_id.alias("a"), without.alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [("Ann Lee", "Ann Lee"), ("Lee", "Lee"), ("3", ""), ("4", "")]


def test_signed_pct_and_pace(spark):
    assert one(spark, text.signed_pct(F.lit(6.25))) == "+6.2%"
    assert one(spark, text.signed_pct(F.lit(-0.5))) == "-0.5%"
    assert one(spark, text.signed_pct(F.lit(None).cast("double"))) == ""
    assert one(spark, text.pace_label(F.lit(1500), F.lit(5.0))) == "5:00/km | 5.0 km"


def test_repair_latin1(spark):
    garbled = "Đường".encode().decode("latin-1")
    cases = {
        "plain": "plain",
        garbled: "Đường",
        "café".encode().decode("latin-1"): "café",
        "café": "café",  # Latin-1 but not UTF-8 underneath
        "日本": "日本",
        "": "",
    }
    got = strings(spark, [*cases, None]).select(text.repair_latin1(F.col("s")).alias("x")).collect()
    assert [r.x for r in got] == [*cases.values(), None]


def test_nested_id(spark):
    cases = {
        "{'id': 123}": 123,
        "{'resource_state': 1, 'id': 77, 'visibility': None, 'flagged': True}": 77,
        "{'map': {'id': 5}, 'id': 9}": 9,
        "{'segments': [{'id': 5}, {'id': {'id': 6}}], 'id': 16255637938}": 16255637938,
        "{'map': {'id': 5}}": None,
        "{'uid': 4}": None,
        "{'id': 12": None,
        "not a dict": None,
        "{}": None,
        "{'a': {'b': {'c': {'d': {'e': {'id': 7}}}}}, 'id': 1}": 1,
        "{'name': \"x, 'id': 9, y\", 'id': 5}": 5,
        "{'name': 'it\\'s \\\\', 'id': 6}": 6,
        "{'id': 5, oops}": None,
        "{'id': 5} {'id': 6}": None,
        "{'id': -3}": -3,
    }
    got = strings(spark, [*cases, None]).select(text.nested_id(F.col("s")).alias("x")).collect()
    assert [r.x for r in got] == [*cases.values(), None]


def test_nested_id_by_one_pattern(spark):
    """Raw texts are answered by the pattern alone; what it takes is what parsing finds."""
    raw = [
        "{'id': 12, 'resource_state': 1}",
        "{'resource_state': 1, 'map': {'id': 5, 'kind': None}, 'id': 34, 'team': None}",
        " {\"a\": [1, 'x', -2.5], 'b': {}, \"id\": -7, 'c': True}\n",
        "{'name': 'it\" is', 'id': 0}",
    ]
    odd = [
        "{'id': 1, 'id': 2}", "{'id': 01}", "{'id': 1.5}", "{'id': 1,}", "{'id': 1} x", "{'id': 1}{}",
        "{'id': 99999999999999999999}", "{'a': {'b': {'id': 4}}, 'id': 3}", "{'a': 'b\\'id', 'id': 6}",
        "{'a': 1 'id': 2}", "{'a': abc, 'id': 2}", "['id', 1]", "{'a': [1,], 'id': 2}", "", "{}",
    ]
    s = F.col("s")
    by_pattern = F.regexp_extract(s, text._PLAIN_DICT, 1).try_cast("bigint")
    got = strings(spark, [*raw, *odd]).select(
        "s", by_pattern.alias("p"), text.nested_id(s).alias("x"), text._parsed_id(s).alias("y")
    ).collect()
    assert [r.p for r in got if r.s in raw] == [12, 34, -7, 0]
    assert [r for r in got if r.x != r.y or (r.p is not None and r.p != r.y)] == []


def test_utc_timestamp(spark):
    got = strings(spark, ["2024-05-01T06:00:00Z", "2024-05-01T06:00:00+02:00", "nonsense", None])
    rows = got.select(text.utc_timestamp(F.col("s")).cast("string").alias("x")).collect()
    assert [r.x for r in rows] == ["2024-05-01 06:00:00", "2024-05-01 04:00:00", None, None]


def test_week_math(spark):
    as_of = dt.date(2025, 1, 1)  # a Wednesday
    days = {
        dt.date(2024, 12, 29): (1, dt.date(2024, 12, 23)),
        dt.date(2024, 12, 30): (0, dt.date(2024, 12, 30)),
        dt.date(2025, 1, 5): (0, dt.date(2024, 12, 30)),
        dt.date(2025, 1, 6): (-1, dt.date(2025, 1, 6)),
        dt.date(2024, 12, 9): (3, dt.date(2024, 12, 9)),
    }
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(
        calendar.week_rel(F.col("d"), as_of).alias("rel"),
        calendar.week_start(F.col("d")).alias("start"),
        calendar.in_weeks(F.col("d"), as_of, 0, 1).alias("recent"),
        calendar.date_ordinal(F.col("d")).alias("ordinal"),
    ).collect()
    assert [(r.rel, r.start) for r in rows] == list(days.values())
    assert [r.recent for r in rows] == [rel in (0, 1) for rel, _ in days.values()]
    assert [r.ordinal for r in rows] == [d.toordinal() for d in days]
    monday = dt.date(2024, 12, 30)
    assert one(spark, calendar.week_rel(F.lit(dt.date(2024, 12, 29)), monday)) == 1


def test_month_window(spark):
    december = dt.date(2024, 12, 15)
    days = [dt.date(2024, 11, 30), dt.date(2024, 12, 1), dt.date(2024, 12, 31), dt.date(2025, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select(
        calendar.in_month(F.col("d"), december).alias("m"),
        calendar.in_month(F.col("d"), december, up_to_as_of=True).alias("mtd"),
    ).collect()
    assert [r.m for r in rows] == [False, True, True, False]
    assert [r.mtd for r in rows] == [False, True, False, False]


def test_haversine(spark):
    quarter = one(spark, geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)))
    assert quarter == pytest.approx(math.pi * 6_371_000 / 2)
    missing = geo.hop_m(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    assert one(spark, missing) == 0.0


def test_riegel_and_climb(spark):
    assert one(spark, race.riegel(F.lit(2400.0), F.lit(10000.0), F.lit(21097.5))) == pytest.approx(
        2400 * 2.10975**1.06
    )
    flat = race.climb_adjusted(
        F.lit(2400.0), F.lit(10000.0), F.lit(10.0), F.lit(21097.5), F.lit(5.0)
    )
    expected = (2400 - 2 * 10 * 10) * 2.10975**1.06 + 2 * 5 * 21.0975
    assert one(spark, flat) == pytest.approx(expected)


def _vdot(metres, sec):
    minutes = sec / 60
    v = metres / minutes
    cost = -4.60 + 0.182258 * v + 0.000104 * v * v
    share = 0.8 + 0.1894393 * math.exp(-0.012778 * minutes)
    return cost / (share + 0.2989558 * math.exp(-0.1932605 * minutes))


def _vdot_time(level, metres):
    """Bisection over [1, 600] minutes; None where there is no root."""
    lo, hi = 1.0, 600.0
    if not _vdot(metres, hi * 60) <= level <= _vdot(metres, lo * 60):
        return None
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _vdot(metres, mid * 60) > level else (lo, mid)
    return (lo + hi) / 2 * 60


def test_vdot_and_inverse(spark):
    cases = [
        (source, float(sec), target)
        for source in (400.0, 1609.344, 5000.0, 10000.0, 42195.0)
        for sec in (50, 200, 900, 2400, 9000, 30000)
        for target in (400.0, 5000.0, 21097.5, 42195.0)
    ]
    df = spark.createDataFrame(cases, "m double, sec double, to_m double")
    df = race.with_vdot(df, "m", "sec", "level")
    solved = race.with_vdot_time(df, "level", "to_m", "t").collect()
    n_null = 0
    for r in solved:
        assert r.level == pytest.approx(_vdot(r.m, r.sec), rel=1e-12)
        expected = _vdot_time(r.level, r.to_m)
        if expected is None:
            n_null += 1
            assert r.t is None
        else:
            assert r.t == pytest.approx(expected, rel=1e-10)
    assert 0 < n_null < len(cases)


def test_vdot_of_nothing(spark):
    df = spark.createDataFrame([(0.0,), (-5.0,), (None,)], "sec double")
    df = race.with_vdot(df.withColumn("m", F.lit(5000.0)), "m", "sec", "level")
    rows = race.with_vdot_time(df, "level", "m", "t").collect()
    assert [(r.level, r.t) for r in rows] == [(None, None)] * 3
