"""The registered queries as plain DuckDB SQL over the same test tables.

Written from the definitions, without the distribution measures of the Spark operators:
whole-activity windows, pairwise joins with ranking, bisection.
"""

from __future__ import annotations

from pacegrid import schema
from pacegrid.functions import race

AS_OF = "DATE '2001-07-25'"
MONDAY = "DATE '2001-07-23'"

_labels = ", ".join(
    f"('{name}', CAST({metres} AS DOUBLE), {i})"
    for i, (name, metres) in enumerate(schema.DISTANCE_LABELS, 1)
)
_priority = ", ".join(f"('{name}', {i})" for i, name in enumerate(schema.SOURCE_PRIORITY, 1))


def _name(ath: str, key: str | None) -> str:
    name = f"trim(coalesce({ath}.firstname, '') || ' ' || coalesce({ath}.lastname, ''))"
    return name if key is None else f"coalesce(nullif({name}, ''), CAST({key} AS VARCHAR))"


def _time_text(sec: str) -> str:
    s = f"CAST(round_even({sec}, 0) AS BIGINT)"
    return f"""CASE WHEN {sec} IS NULL THEN '-'
      WHEN {s} >= 3600 THEN printf('%d:%02d:%02d', {s} // 3600, {s} % 3600 // 60, {s} % 60)
      ELSE printf('%d:%02d', {s} // 60, {s} % 60) END"""


def _week_rel(date: str) -> str:
    return f"CAST(date_diff('day', CAST(date_trunc('week', {date}) AS DATE), {MONDAY}) // 7 AS INT)"


def _week_label(rel: str) -> str:
    return (
        f"CASE {rel} WHEN 0 THEN 'This Week' WHEN 1 THEN 'Last Week' "
        f"ELSE {rel} || ' Weeks Ago' END"
    )


def _hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371000 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * "
        f"pow(sin(radians({lon2} - {lon1}) / 2), 2)))"
    )


def _vdot(metres: str, minutes: str) -> str:
    c0, c1, c2 = race.COST
    decays = " + ".join(
        f"CAST({size} AS DOUBLE) * exp(-CAST({rate} AS DOUBLE) * ({minutes}))"
        for size, rate in race.SHARE_DECAYS
    )
    v = f"(({metres}) / ({minutes}))"
    return (
        f"(CAST({c0} AS DOUBLE) + CAST({c1} AS DOUBLE) * {v} + "
        f"CAST({c2} AS DOUBLE) * {v} * {v}) / (CAST(0.8 AS DOUBLE) + {decays})"
    )


# Named parts; each query lists those it needs, in order of use.
PARTS = {
    "athletes": """SELECT c_custkey AS athlete_id, c_mktsegment AS city, n_name AS country,
        CASE WHEN c_custkey % 10 <> 0 THEN c_name END AS firstname,
        CASE WHEN c_custkey % 10 <> 0 THEN c_mktsegment END AS lastname,
        CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
        CAST(50 + c_custkey % 40 AS INT) AS weight
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "activities": """SELECT o_orderkey AS activity_id,
        CASE WHEN o_orderkey % 7 = 0 THEN 'Ride' ELSE 'Run' END AS activity_type,
        o_custkey AS athlete_id, 'Athlete ' || o_custkey AS athlete_name,
        CAST(o_orderdate AS DATE) AS date, o_orderdate AS start_time_utc,
        CAST(floor(o_totalprice / 11987 * (240 + o_orderkey % 180)) AS INT) AS duration_sec,
        o_totalprice / 11987 AS distance_km,
        CAST(o_custkey % 37 AS DOUBLE) * 10 AS elev_gain_m,
        CASE WHEN o_orderkey % 11 <> 0 THEN CAST(120 + o_orderkey % 60 AS DOUBLE) END AS hr_avg,
        CAST(70 + o_orderkey % 25 AS DOUBLE) AS cad_avg
      FROM orders""",
    "raw_stream": """SELECT user_id AS activity_id, event_id,
        CAST(date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts) AS INT) AS time_s,
        CASE WHEN event_type <> 'error' THEN CAST(10.7 AS DOUBLE)
          + (event_id % 97) * CAST(0.00001 AS DOUBLE) END AS lat,
        CASE WHEN event_type <> 'error' THEN CAST(106.6 AS DOUBLE)
          + (event_id % 89) * CAST(0.00001 AS DOUBLE) END AS lon,
        CASE WHEN event_type <> 'click' THEN CAST(2.5 AS DOUBLE)
          * date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts) END AS dist_m,
        CASE WHEN event_type <> 'signup' THEN value END AS alt_m,
        CASE WHEN event_type <> 'view'
          THEN 60 + CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) END AS hr_bpm,
        CASE WHEN event_type <> 'purchase'
          THEN 70 + CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 30 END AS cadence,
        CASE WHEN event_type = 'click'
          THEN 3 * CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) END AS watts
      FROM events""",
    "stream": """SELECT * EXCLUDE (rn, event_id) FROM (SELECT *, row_number() OVER (
        PARTITION BY activity_id, time_s ORDER BY event_id) AS rn FROM raw_stream)
      WHERE rn = 1""",
    "hops": f"""SELECT *, coalesce({_hav("plat", "plon", "lat", "lon")}, 0) AS hop
      FROM (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM stream
        WINDOW w AS (PARTITION BY activity_id ORDER BY time_s))""",
    "kms": """SELECT *, CAST(floor(cum / 1000) AS INT) + 1 AS km FROM (SELECT *, sum(hop) OVER (
        PARTITION BY activity_id ORDER BY time_s ROWS UNBOUNDED PRECEDING) AS cum FROM hops)""",
    "splits": """SELECT activity_id, km AS segment_number, min(time_s) AS segment_start_time,
        max(time_s) AS segment_end_time,
        first(lat ORDER BY time_s) FILTER (WHERE lat IS NOT NULL) AS start_lat,
        first(lon ORDER BY time_s) FILTER (WHERE lon IS NOT NULL) AS start_lon,
        last(cum ORDER BY time_s) AS cumulative_distance_m, avg(hr_bpm) AS avg_hr_bpm,
        avg(cadence) AS avg_cadence, avg(watts) AS avg_watts, sum(hop) AS segment_distance_m,
        max(time_s) - min(time_s) AS duration_s,
        (max(time_s) - min(time_s)) / nullif(sum(hop) / 1000, 0) AS pace_sec_per_km
      FROM kms GROUP BY activity_id, km""",
    "metrics": """SELECT activity_id, avg(hr_bpm) AS hr_avg, CAST(max(hr_bpm) AS INT) AS hr_max,
        avg(cadence) AS cad_avg, CAST(max(cadence) AS INT) AS cad_max, min(alt_m) AS elev_min,
        max(alt_m) AS elev_max,
        CASE WHEN count(alt_m) > 0
          THEN coalesce(sum(alt_m - palt) FILTER (WHERE alt_m > palt), 0) END AS total_ascent,
        CASE WHEN count(alt_m) > 0
          THEN coalesce(sum(palt - alt_m) FILTER (WHERE alt_m < palt), 0) END AS total_descent,
        CASE WHEN sum(cadence * dt) > 0
          THEN last(dist_m ORDER BY time_s) / (2 * sum(cadence * dt) / 60.0) END AS stride_len_m
      FROM (SELECT *, coalesce(time_s - lag(time_s) OVER w, 0) AS dt,
          last_value(alt_m IGNORE NULLS) OVER (PARTITION BY activity_id ORDER BY time_s
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS palt
        FROM stream WINDOW w AS (PARTITION BY activity_id ORDER BY time_s))
      GROUP BY activity_id""",
    "start_points": """SELECT a.activity_id, athlete_id, athlete_name, date, activity_type,
        lat AS start_lat, lon AS start_lon
      FROM activities a JOIN (SELECT *, row_number() OVER (PARTITION BY activity_id
          ORDER BY time_s) AS rn FROM stream WHERE lat IS NOT NULL AND lon IS NOT NULL) p
        ON p.activity_id = a.activity_id AND rn = 1""",
    "calendar": f"""SELECT date, CAST(year(date) AS INT) AS iso_year,
        CAST(weekofyear(date) AS INT) AS iso_week, dayname(date) AS day_name,
        CAST(isodow(date) AS INT) AS day_of_week,
        CAST(date_trunc('week', date) AS DATE) AS week_start_date,
        {_week_rel("date")} AS week_relative_to_today,
        CAST(date_diff('day', date, {AS_OF}) AS INT) AS days_ago
      FROM (SELECT CAST(unnest(generate_series(min(date) - INTERVAL 7 DAY,
        max(date) + INTERVAL 7 DAY, INTERVAL 1 DAY)) AS DATE) AS date FROM activities)""",
    "weekly": f"""SELECT *, {_week_rel("date")} AS week_rel FROM activities""",
    "this_week": """SELECT athlete_id, sum(distance_km) AS total_km,
        count(DISTINCT activity_id) AS n_runs, sum(duration_sec) AS total_sec
      FROM weekly WHERE week_rel = 0 GROUP BY athlete_id""",
    "this_week_long": """SELECT athlete_id, 'total_km' AS metric, total_km AS val FROM this_week
      UNION ALL SELECT athlete_id, 'n_runs', CAST(n_runs AS DOUBLE) FROM this_week
      UNION ALL SELECT athlete_id, 'total_sec', CAST(total_sec AS DOUBLE) FROM this_week""",
    "ties": f"""SELECT l.athlete_id, metric, side, val, {_name("t", "l.athlete_id")} AS name
      FROM (SELECT *, 'top' AS side FROM this_week_long WHERE (metric, val) IN
          (SELECT (metric, max(val)) FROM this_week_long GROUP BY metric)
        UNION ALL SELECT *, 'bottom' FROM this_week_long WHERE (metric, val) IN
          (SELECT (metric, min(val)) FROM this_week_long WHERE val > 0 GROUP BY metric)) l
      LEFT JOIN athletes t ON t.athlete_id = l.athlete_id""",
    "labels": f"SELECT * FROM (VALUES {_labels}) v(distance_label, metres, sort_order)",
    "priorities": f"SELECT * FROM (VALUES {_priority}) v(name, rank)",
    "run_best": """SELECT l_orderkey * 10 + l_linenumber AS id, name,
        CAST(floor(metres / 1000 * (240 + 4 * l_quantity)) AS INT) AS elapsed_time,
        l_shipdate AS start_date, l_orderkey AS activity_id, o_custkey AS athlete_id
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN priorities ON rank = l_linenumber JOIN labels ON distance_label = name""",
    "pbs": "SELECT athlete_id, name, min(elapsed_time) AS pb_sec FROM run_best GROUP BY ALL",
    "preferred": """SELECT athlete_id, name AS source_label, metres AS source_m,
        CAST(pb_sec AS DOUBLE) AS source_sec
      FROM (SELECT *, row_number() OVER (PARTITION BY athlete_id ORDER BY rank) AS rn
        FROM pbs JOIN priorities USING (name)) JOIN labels ON distance_label = name
      WHERE rn = 1""",
    "races": """SELECT athlete_id, activity_id, 'Half-Marathon' AS target_distance_label,
        date AS race_date, duration_sec AS actual_sec, elev_gain_m, distance_km
      FROM activities WHERE distance_km BETWEEN 19 AND 23
        AND date BETWEEN DATE '2001-01-01' AND DATE '2001-06-30'""",
    "checkpoints": """SELECT *, CAST(race_date - to_days(CAST(7 * w AS INT)) AS DATE) AS as_of_date
      FROM races, (VALUES (8), (4), (2), (1)) v(w)""",
    "block": """SELECT athlete_id, CAST(date_trunc('week', date) AS DATE) AS week_start_date,
        sum(distance_km) AS km, max(distance_km) AS long_run_km,
        count(DISTINCT activity_id) AS n_runs, avg(hr_avg) AS avg_hr
      FROM activities WHERE date BETWEEN DATE '2001-06-24' - 112 AND DATE '2001-06-24'
      GROUP BY ALL""",
    "trend": f"""SELECT athlete_id, name AS distance_label,
        greatest(CASE WHEN min(d) = max(d) THEN avg(s) / 2 * (({AS_OF} - DATE '0001-01-01' + 1)
              / CAST(min(d) - DATE '0001-01-01' + 1 AS DOUBLE) + 1)
            WHEN min(s) = max(s) THEN avg(s)
            ELSE regr_slope(s, d - {AS_OF}) * 0 + regr_intercept(s, d - {AS_OF}) END, 1.0)
          AS predicted_best_sec,
        {AS_OF} AS prediction_date,
        CASE WHEN min(d) = max(d) OR min(s) = max(s) THEN 0.0
          ELSE regr_r2(s, d - {AS_OF}) END AS r_squared
      FROM (SELECT athlete_id, name, CAST(start_date AS DATE) AS d,
          CAST(elapsed_time AS DOUBLE) AS s FROM run_best)
      GROUP BY athlete_id, name HAVING count(*) >= 3""",
    "trend_at": """SELECT athlete_id, name AS distance_label, as_of_date,
        greatest(CASE WHEN min(d) = max(d) THEN avg(s) / 2 * ((as_of_date - DATE '0001-01-01' + 1)
              / CAST(min(d) - DATE '0001-01-01' + 1 AS DOUBLE) + 1)
            WHEN min(s) = max(s) THEN avg(s) ELSE regr_intercept(s, d - as_of_date) END, 1.0)
          AS predicted_best_sec,
        CASE WHEN min(d) = max(d) OR min(s) = max(s) THEN 0.0
          ELSE regr_r2(s, d - as_of_date) END AS r_squared
      FROM (SELECT DISTINCT athlete_id, as_of_date FROM checkpoints) c JOIN (
          SELECT athlete_id, name, CAST(start_date AS DATE) AS d,
            CAST(elapsed_time AS DOUBLE) AS s FROM run_best) USING (athlete_id)
      WHERE d < as_of_date GROUP BY athlete_id, name, as_of_date HAVING count(*) >= 3""",
    "source": """SELECT athlete_id, as_of_date, name AS source_distance_label,
        CAST(tier AS INT) AS source_tier, id AS source_id,
        CAST(elapsed_time AS DOUBLE) AS source_pb_sec, elev_per_km AS source_elev_per_km
      FROM (SELECT *, row_number() OVER (PARTITION BY athlete_id, as_of_date
            ORDER BY rank, tier, elapsed_time, id) AS rn
        FROM (SELECT c.athlete_id, c.as_of_date, b.name, b.id, b.elapsed_time, rank,
            a.elev_gain_m / nullif(a.distance_km, 0) AS elev_per_km,
            CASE WHEN fits AND near THEN 1 WHEN fits THEN 2 WHEN near THEN 3 ELSE 4 END AS tier
          FROM (SELECT DISTINCT athlete_id, as_of_date FROM checkpoints) c
          JOIN run_best b ON b.athlete_id = c.athlete_id AND b.start_date < c.as_of_date
          JOIN priorities p ON p.name = b.name JOIN labels l ON l.distance_label = b.name
          LEFT JOIN activities a ON a.activity_id = b.activity_id,
          LATERAL (SELECT coalesce(a.distance_km * 1000 BETWEEN CAST(0.9 AS DOUBLE) * metres
              AND CAST(1.2 AS DOUBLE) * metres, false) AS fits,
            b.start_date >= c.as_of_date - INTERVAL 90 DAY AS near) x))
      WHERE rn = 1""",
}

_FLAT = "(sec - 2 * climb * src / 1000)"


def _vdot_times(pairs: str) -> list[str]:
    """CTEs that solve ``pairs(k, level, metres)`` by bisection: ``solved(k, vdot_sec)``."""
    mid = "(lo + hi) / 2"
    return [
        f"bisect AS (SELECT k, level, metres, CAST(1 AS DOUBLE) AS lo, CAST(600 AS DOUBLE) AS hi, "
        f"0 AS i FROM {pairs} WHERE level <= {_vdot('metres', '1.0')} "
        f"AND level >= {_vdot('metres', '600.0')} "
        f"UNION ALL SELECT k, level, metres, "
        f"CASE WHEN {_vdot('metres', mid)} > level THEN {mid} ELSE lo END, "
        f"CASE WHEN {_vdot('metres', mid)} > level THEN hi ELSE {mid} END, i + 1 "
        f"FROM bisect WHERE i < 60)",
        "solved AS (SELECT k, (lo + hi) / 2 * 60 AS vdot_sec FROM bisect WHERE i = 60)",
    ]


def sql(parts: str, body: str, extra: list[str] | None = None) -> str:
    """``WITH`` the named parts, then extra CTEs, then the body."""
    ctes = [f"{name} AS ({PARTS[name]})" for name in parts.split()]
    ctes += extra or []
    keyword = "WITH RECURSIVE " if any(c.startswith("bisect ") for c in ctes) else "WITH "
    return (keyword + ",\n".join(ctes) + "\n" if ctes else "") + body


EFFORTS = "labels priorities run_best"
STREAM = "raw_stream stream"

_TOTALS = (
    "round(sum(distance_km), 4) AS total_km, count(DISTINCT activity_id) AS n_runs, "
    "CAST(sum(duration_sec) AS BIGINT) AS total_sec"
)
_SPLIT_COLUMNS = (
    "activity_id, segment_number, segment_start_time, segment_end_time, "
    "round(start_lat, 6) AS start_lat, round(start_lon, 6) AS start_lon, "
    "round(cumulative_distance_m, 4) AS cumulative_distance_m, "
    "round(avg_hr_bpm, 4) AS avg_hr_bpm, round(avg_cadence, 4) AS avg_cadence, "
    "round(avg_watts, 4) AS avg_watts, round(segment_distance_m, 4) AS segment_distance_m, "
    "duration_s, round(pace_sec_per_km, 4) AS pace_sec_per_km"
)
_FORECAST_COLUMNS = (
    "athlete_id, race_activity_id, target_distance_label, method, as_of_date, "
    "source_distance_label, round(source_pb_sec, 4) AS source_pb_sec, "
    "round(predicted_sec, 4) AS predicted_sec, round(actual_sec, 4) AS actual_sec, "
    "round(error_sec, 4) AS error_sec, round(error_pct, 4) AS error_pct"
)


def _backtest(body: str, blend: str = "", more: str = "") -> str:
    """The backtest as CTE ``rf``. ``blend`` is the join condition to the trend, if any."""
    trend_join = f"LEFT JOIN {blend} AND r_squared >= 0.5 AND predicted_best_sec > 120" if blend else ""
    trend_sec = "predicted_best_sec" if blend else "CAST(NULL AS DOUBLE)"
    trend_part = {"": "", "tr": "trend", "ta": "trend_at"}[blend.split(" ON ")[0][-2:].strip()]
    extra = [
        f"""paired AS (SELECT row_number() OVER () AS k, c.athlete_id,
          c.activity_id AS race_activity_id, target_distance_label, c.as_of_date,
          source_distance_label, source_pb_sec AS sec, CAST(actual_sec AS DOUBLE) AS actual_sec,
          sl.metres AS src, tl.metres AS metres, coalesce(source_elev_per_km, 0) AS climb,
          c.elev_gain_m / c.distance_km AS target_climb, {trend_sec} AS trend_sec,
          {_vdot("sl.metres", "source_pb_sec / 60")} AS level
        FROM checkpoints c JOIN source s
          ON s.athlete_id = c.athlete_id AND s.as_of_date = c.as_of_date
        JOIN labels sl ON sl.distance_label = source_distance_label
        JOIN labels tl ON tl.distance_label = target_distance_label {trend_join})""",
        *_vdot_times("paired"),
        f"""plain AS (SELECT p.*, 'riegel' AS method,
            sec * pow(metres / src, CAST(1.06 AS DOUBLE)) AS plain_sec FROM paired p
          UNION ALL SELECT p.*, 'vdot', vdot_sec FROM paired p LEFT JOIN solved USING (k)
          UNION ALL SELECT p.*, 'elevation_adjusted',
            {_FLAT} * pow(metres / src, CAST(1.06 AS DOUBLE)) + 2 * target_climb * metres / 1000
          FROM paired p)""",
        """rf AS (SELECT *, sec AS source_pb_sec, predicted_sec - actual_sec AS error_sec,
            (predicted_sec - actual_sec) / actual_sec * 100 AS error_pct
          FROM (SELECT *, CASE WHEN trend_sec IS NULL THEN plain_sec ELSE 0.5 * plain_sec
              + 0.5 * trend_sec * pow(metres / src, CAST(1.06 AS DOUBLE)) END AS predicted_sec
            FROM plain))""",
    ]
    parts = f"{EFFORTS} activities races checkpoints source {trend_part} {more}"
    return sql(parts, body, extra)


_TREND = (
    "trend tr ON tr.athlete_id = c.athlete_id AND tr.distance_label = source_distance_label"
)
_TREND_AT = (
    "trend_at ta ON ta.athlete_id = c.athlete_id AND ta.distance_label = source_distance_label "
    "AND ta.as_of_date = c.as_of_date"
)
_FINAL = """(SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY athlete_id, target_distance_label, method
    ORDER BY as_of_date DESC, race_activity_id DESC) AS rn FROM rf) WHERE rn = 1)"""

_day_grid = lambda weeks: sql(
    "activities athletes calendar",
    f"""SELECT t.athlete_id, week_relative_to_today AS week_rel,
      {_week_label("week_relative_to_today")} AS week_label,
      'Week ' || (week_relative_to_today + 1) AS week_number, day_name, day_of_week, d.date,
      round(coalesce(sum(distance_km), 0), 4) AS km
    FROM calendar d CROSS JOIN athletes t
    LEFT JOIN activities a ON a.date = d.date AND a.athlete_id = t.athlete_id
    WHERE week_relative_to_today BETWEEN 0 AND {weeks - 1} GROUP BY ALL""",
)
_history = lambda unit, bound: sql(
    "activities",
    f"""SELECT athlete_id, CAST(date_trunc('{unit}', date) AS DATE) AS period,
      round(sum(distance_km), 4) AS distance_km, CAST(sum(duration_sec) AS BIGINT) AS duration_sec,
      round(sum(elev_gain_m), 4) AS elev_gain_m, round_even(sum(duration_sec) / 3600 * 100, 0) / 100 AS hours
    FROM activities WHERE date > {bound} GROUP BY ALL""",
)
_pair_parts = f"{EFFORTS} pbs"
_pairs = """pairs AS (SELECT row_number() OVER () AS k, athlete_id, name,
    CAST(pb_sec AS DOUBLE) AS sec, src.metres AS src,
    CASE WHEN name <> '5K' THEN 2.5 ELSE 0 END AS climb, CAST(21097.5 AS DOUBLE) AS metres,
    {level} AS level FROM pbs JOIN labels src ON distance_label = name)""".format(
    level=_vdot("src.metres", "pb_sec / 60")
)
_load = """SELECT activity_id, athlete_id, date,
    round(CASE WHEN {old} THEN distance_km ELSE 2 * distance_km END, 4) AS distance_km
  FROM activities"""
_check = lambda test, count: f"SELECT '{test}' AS test, {count} AS n_rows"
_suite = lambda test, count: (
    f"SELECT '{test}' AS test, CAST(({count}) AS BIGINT) AS n_failures"
)
_dup = lambda table, key: (
    f"SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)"
)
_null = lambda table, column: f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
_garbled_effort = """SELECT o_orderkey AS activity_id, o_custkey AS athlete_id, name,
    100 AS elapsed_time FROM orders, priorities WHERE {where}"""

ORACLE: dict[str, str] = {
    "km_splits": sql(f"{STREAM} hops kms splits", f"SELECT {_SPLIT_COLUMNS} FROM splits"),
    "activity_metrics": sql(
        f"{STREAM} metrics",
        """SELECT activity_id, round(hr_avg, 4) AS hr_avg, hr_max, round(cad_avg, 4) AS cad_avg,
          cad_max, round(elev_min, 4) AS elev_min, round(elev_max, 4) AS elev_max,
          round(total_ascent, 4) AS total_ascent, round(total_descent, 4) AS total_descent,
          round(stride_len_m, 4) AS stride_len_m FROM metrics""",
    ),
    "enrich_activities": sql(
        f"activities {STREAM} metrics",
        """SELECT activity_id, round(distance_km, 4) AS distance_km, round(m.hr_avg, 4) AS hr_avg,
          cad_max, round(stride_len_m, 4) AS stride_len_m
        FROM activities LEFT JOIN metrics m USING (activity_id)""",
    ),
    "first_gps_point": sql(
        f"activities {STREAM} start_points",
        """SELECT * REPLACE (round(start_lat, 6) AS start_lat, round(start_lon, 6) AS start_lon)
        FROM start_points""",
    ),
    "dedupe_stream": sql(
        STREAM,
        """SELECT * REPLACE (round(lat, 6) AS lat, round(lon, 6) AS lon,
          round(dist_m, 4) AS dist_m, round(alt_m, 4) AS alt_m) FROM stream""",
    ),
    "dedupe_report": """SELECT count(*) AS rows_before,
        count(DISTINCT (l_orderkey, l_linenumber)) AS rows_after,
        count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS rows_dropped FROM lineitem""",
    "route_points": sql(
        STREAM,
        """SELECT activity_id, time_s, round(lat, 6) AS lat, round(lon, 6) AS lon FROM stream
        WHERE lat IS NOT NULL AND lon IS NOT NULL""",
    ),
    "split_table": sql(
        f"{STREAM} hops kms splits",
        f"""SELECT activity_id, segment_number, {_time_text("pace_sec_per_km")} || '/km'
          AS average_pace FROM splits""",
    ),
    "channel_series": sql(
        STREAM,
        """SELECT activity_id, time_s, hr_bpm, watts, n_hr > 0 AS has_hr, n_watts > 0 AS has_watts
        FROM (SELECT *, count(hr_bpm) OVER w AS n_hr, count(watts) OVER w AS n_watts FROM stream
          WINDOW w AS (PARTITION BY activity_id)) WHERE n_hr + n_watts > 0""",
    ),
    "week_gps_points": sql(
        f"activities athletes {STREAM}",
        f"""SELECT w.activity_id, time_s, round(lat, 6) AS lat, round(lon, 6) AS lon, w.athlete_id,
          {_name("t", "w.athlete_id")} AS name
        FROM activities w JOIN stream s ON s.activity_id = w.activity_id
        LEFT JOIN athletes t ON t.athlete_id = w.athlete_id
        WHERE date BETWEEN DATE '2000-07-17' AND DATE '2000-07-23' AND lat IS NOT NULL AND lon IS NOT NULL""",
    ),
    "dim_date": sql("activities calendar", "SELECT * FROM calendar"),
    "week_list": sql(
        "activities calendar",
        f"""SELECT DISTINCT week_start_date, week_relative_to_today AS week_rel,
          {_week_label("week_relative_to_today")} || ' (' || week_start_date || ')' AS week_label
        FROM calendar WHERE week_relative_to_today >= 0""",
    ),
    "filter_propagation": sql(
        "activities weekly athletes",
        """SELECT athlete_id, country FROM athletes WHERE athlete_id IN
          (SELECT athlete_id FROM weekly WHERE week_rel BETWEEN 0 AND 3)""",
    ),
    "week_kpis": sql(
        "activities weekly",
        f"SELECT week_rel, {_TOTALS} FROM weekly WHERE week_rel IN (0, 1) GROUP BY week_rel",
    ),
    "week_kpis_by_calendar": sql(
        "activities weekly", f"SELECT week_rel, {_TOTALS} FROM weekly GROUP BY week_rel"
    ),
    "wow_change": sql(
        "activities weekly",
        """SELECT metric, round(this_week, 4) AS this_week, round(last_week, 4) AS last_week,
          round(pct, 4) AS pct,
          CASE WHEN pct IS NULL THEN '' ELSE printf('%+.1f%%', round_even(pct, 1)) END AS pct_text
        FROM (SELECT *, (this_week - last_week) / nullif(last_week, 0) * 100 AS pct FROM (
          SELECT metric, coalesce(sum(v) FILTER (WHERE week_rel = 0), 0) AS this_week,
            coalesce(sum(v) FILTER (WHERE week_rel = 1), 0) AS last_week
          FROM (SELECT week_rel, 'total_km' AS metric, distance_km AS v FROM weekly
            UNION ALL SELECT week_rel, 'n_runs', 1 FROM weekly
            UNION ALL SELECT week_rel, 'total_sec', duration_sec FROM weekly)
          GROUP BY metric))""",
    ),
    "wow_by_athlete": sql(
        "activities weekly",
        """SELECT athlete_id, round(this_km, 4) AS this_km, round(last_km, 4) AS last_km,
          round((this_km - last_km) / nullif(last_km, 0) * 100, 4) AS pct
        FROM (SELECT athlete_id, sum(CASE week_rel WHEN 0 THEN distance_km ELSE 0 END) AS this_km,
            sum(CASE week_rel WHEN 1 THEN distance_km ELSE 0 END) AS last_km
          FROM weekly WHERE week_rel IN (0, 1) GROUP BY athlete_id)""",
    ),
    "month_kpis": sql(
        "activities",
        f"SELECT {_TOTALS} FROM activities WHERE year(date) = 2001 AND month(date) = 7",
    ),
    "month_to_date_kpis": sql(
        "activities",
        f"""SELECT {_TOTALS} FROM activities
        WHERE year(date) = 2001 AND month(date) = 7 AND date <= {AS_OF}""",
    ),
    "athletes_on_day": sql(
        "activities athletes",
        f"""SELECT count(DISTINCT athlete_id) AS n_athletes,
          (SELECT count(DISTINCT athlete_id) FROM athletes) AS of_athletes
        FROM activities WHERE date = {AS_OF}""",
    ),
    "latest_activity": sql(
        "activities athletes",
        f"""SELECT a.athlete_id, activity_id, CAST(start_time_utc AS DATE) AS start_time_utc,
          round(distance_km, 4) AS distance_km, {_name("t", "a.athlete_id")} AS name
        FROM activities a LEFT JOIN athletes t USING (athlete_id)
        ORDER BY a.start_time_utc DESC, activity_id DESC LIMIT 1""",
    ),
    "latest_run_text": sql(
        "activities",
        """SELECT max(athlete_name) || ' - ' || strftime(max(start_time_utc), '%b %-d, %Y (%H:%M)')
          AS latest_run FROM activities
        WHERE start_time_utc = (SELECT max(start_time_utc) FROM activities)""",
    ),
    "top_bottom_runner": sql(
        "activities weekly this_week this_week_long athletes",
        f"""SELECT b.metric, {_name("bt", "b.athlete_id")} AS top_name, round(b.val, 4) AS top_val,
          {_name("wt", "w.athlete_id")} AS bottom_name, round(w.val, 4) AS bottom_val
        FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY val DESC, athlete_id) AS rn
          FROM this_week_long) b
        JOIN (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY val, athlete_id) AS rn
          FROM this_week_long WHERE val > 0) w ON w.metric = b.metric AND w.rn = 1
        LEFT JOIN athletes bt ON bt.athlete_id = b.athlete_id
        LEFT JOIN athletes wt ON wt.athlete_id = w.athlete_id WHERE b.rn = 1""",
    ),
    "top_runner_ties": sql(
        "activities weekly this_week this_week_long athletes ties",
        "SELECT * REPLACE (round(val, 4) AS val) FROM ties",
    ),
    "tied_rows": sql(
        "activities weekly this_week this_week_long athletes ties",
        """SELECT * REPLACE (round(val, 4) AS val), count(*) OVER (PARTITION BY metric, side) AS n_tied
        FROM ties""",
    ),
    "day_runs_with_pace": sql(
        "activities athletes",
        f"""SELECT activity_id, {_name("t", "a.athlete_id")} AS name,
          round(distance_km, 4) AS distance_km,
          round(duration_sec / distance_km, 4) AS pace_sec,
          {_time_text("duration_sec / distance_km")} || '/km | '
            || printf('%.1f km', round_even(distance_km, 1)) AS pace_label
        FROM activities a LEFT JOIN athletes t USING (athlete_id)
        WHERE date = {AS_OF} AND distance_km > 0""",
    ),
    "day_pace": sql(
        "activities athletes",
        f"""SELECT a.athlete_id, round(sum(distance_km), 4) AS km,
          CAST(sum(duration_sec) AS BIGINT) AS sec, {_name("t", "a.athlete_id")} AS name,
          round(sum(duration_sec) / sum(distance_km), 4) AS pace_sec
        FROM activities a LEFT JOIN athletes t USING (athlete_id) WHERE date = {AS_OF}
        GROUP BY a.athlete_id, t.firstname, t.lastname""",
    ),
    "squad_4week": sql(
        "activities weekly athletes",
        f"""SELECT w.athlete_id, week_rel, CAST(date_trunc('week', date) AS DATE)
            AS week_start_date, round(sum(distance_km), 4) AS km,
          {_name("t", "w.athlete_id")} AS name, {_week_label("week_rel")} AS week_label
        FROM weekly w LEFT JOIN athletes t USING (athlete_id)
        WHERE week_rel BETWEEN 0 AND 3 GROUP BY ALL""",
    ),
    "volume_vs_time": sql(
        "activities weekly athletes",
        f"""SELECT w.athlete_id, round(sum(distance_km), 4) AS km,
          CAST(sum(duration_sec) AS BIGINT) AS sec, {_name("t", "w.athlete_id")} AS name
        FROM weekly w LEFT JOIN athletes t USING (athlete_id) WHERE week_rel = 1 GROUP BY ALL""",
    ),
    "runner_stats": sql(
        "activities weekly athletes",
        f"""SELECT *, {_time_text("total_sec")} AS total_time,
          round(run_days / 7.0, 4) AS run_frequency
        FROM (SELECT w.athlete_id, CAST(count(DISTINCT date) AS INT) AS run_days,
          round(avg(cad_avg), 4) AS avg_cadence, round(avg(hr_avg), 4) AS avg_hr,
          round(sum(distance_km), 4) AS total_km, count(DISTINCT activity_id) AS run_count,
          CAST(sum(duration_sec) AS BIGINT) AS total_sec, {_name("t", None)} AS name
          FROM weekly w LEFT JOIN athletes t USING (athlete_id) WHERE week_rel = 0 GROUP BY ALL)""",
    ),
    "run_frequency": sql(
        "activities",
        """SELECT athlete_id, CAST(date_trunc('week', date) AS DATE) AS week_start_date,
          CAST(count(DISTINCT date) AS INT) AS run_days,
          round(count(DISTINCT date) / 7.0, 4) AS run_frequency FROM activities GROUP BY ALL""",
    ),
    "athlete_week_kpis": sql(
        "activities weekly",
        f"""SELECT week_rel, athlete_id, {_TOTALS} FROM weekly WHERE week_rel IN (0, 1)
        GROUP BY week_rel, athlete_id""",
    ),
    "athlete_details": sql(
        "athletes", "SELECT athlete_id, sex, weight, city, country FROM athletes"
    ),
    "athlete_names": sql(
        "athletes", f"SELECT athlete_id, {_name('athletes', 'athlete_id')} AS name FROM athletes"
    ),
    "activity_card": sql(
        "activities",
        f"""SELECT activity_id, round(distance_km, 4) AS distance_km,
          {_time_text("duration_sec")} AS total_time FROM activities""",
    ),
    "history_monthly": _history("month", "DATE '2000-07-25'"),
    "history_weekly": _history("week", "DATE '2000-07-26'"),
    "day_grid": _day_grid(4),
    "day_grid_6week": _day_grid(6),
    "recent_20": sql(
        "activities",
        f"""SELECT athlete_id, activity_id, date, CAST(rank AS INT) AS rank,
          date || ' — ' || printf('%.1f', round_even(distance_km, 1)) || ' km ('
            || {_time_text("duration_sec")} || ')' AS label
        FROM (SELECT *, row_number() OVER (PARTITION BY athlete_id
            ORDER BY start_time_utc DESC, activity_id DESC) AS rank FROM activities)
        WHERE rank <= 20""",
    ),
    "personal_bests": sql(
        f"{EFFORTS} pbs athletes",
        f"""SELECT t.athlete_id, distance_label, sort_order, pb_sec,
          {_time_text("pb_sec")} AS personal_best
        FROM athletes t CROSS JOIN labels LEFT JOIN pbs p
          ON p.athlete_id = t.athlete_id AND name = distance_label""",
    ),
    "pb_map": sql(f"{EFFORTS} pbs", "SELECT * FROM pbs"),
    "preferred_pb": sql(f"{EFFORTS} pbs preferred", "SELECT * FROM preferred"),
    "athletes_with_efforts": sql(
        f"{EFFORTS} athletes",
        f"""SELECT b.athlete_id, count(DISTINCT b.name) AS n_labels,
          {_name("t", "b.athlete_id")} AS name
        FROM run_best b LEFT JOIN athletes t USING (athlete_id)
        GROUP BY b.athlete_id, t.firstname, t.lastname""",
    ),
    "effort_labels": sql(EFFORTS, "SELECT DISTINCT athlete_id, name FROM run_best"),
    "race_athletes": sql(
        "activities races athletes",
        f"""SELECT athlete_id, {_name("athletes", "athlete_id")} AS name FROM athletes
        WHERE athlete_id IN (SELECT athlete_id FROM races)""",
    ),
    "race_athletes_fallback": sql(
        "athletes",
        f"SELECT athlete_id, {_name('athletes', 'athlete_id')} AS name FROM athletes",
    ),
    "athletes_without_race": sql(
        "activities athletes",
        """SELECT athlete_id FROM athletes WHERE athlete_id NOT IN
          (SELECT athlete_id FROM activities WHERE distance_km BETWEEN 19 AND 23)""",
    ),
    "training_block": sql(
        "activities block",
        """SELECT athlete_id, week_start_date, round(km, 4) AS km,
          round(long_run_km, 4) AS long_run_km, n_runs, round(avg_hr, 4) AS avg_hr FROM block""",
    ),
    "ramp_rate": sql(
        "activities block",
        """SELECT athlete_id, week_start_date, round(ramp, 4) AS ramp_pct,
          CASE WHEN abs(ramp) > 30 THEN 'red' WHEN abs(ramp) > 10 THEN 'amber' ELSE 'green' END
            AS ramp_band
        FROM (SELECT *, (km / nullif(lag(km) OVER (PARTITION BY athlete_id
            ORDER BY week_start_date), 0) - 1) * 100 AS ramp FROM block) WHERE ramp IS NOT NULL""",
    ),
    "readiness_summary": sql(
        "activities block",
        """SELECT athlete_id, round(peak_km, 4) AS peak_km, peak_week,
          round(longest_run, 4) AS longest_run, longest_run >= 18 AS hit_18k,
          round(consistency, 4) AS consistency, round(taper_km, 4) AS taper_km,
          round((taper_km - peak_km) / nullif(peak_km, 0) * 100, 4) + 0 AS taper_drop
        FROM (SELECT athlete_id, max(km) AS peak_km,
          first(week_start_date ORDER BY km DESC, week_start_date) AS peak_week,
          max(long_run_km) AS longest_run,
          100.0 * count(*) FILTER (WHERE n_runs >= 3) / count(*) AS consistency,
          first(km ORDER BY week_start_date)
            FILTER (WHERE week_start_date >= DATE '2001-06-24' - 21) AS taper_km
          FROM block GROUP BY athlete_id)""",
    ),
    "pb_trend": sql(
        f"{EFFORTS} trend",
        """SELECT * REPLACE (round(predicted_best_sec, 4) AS predicted_best_sec,
          round(r_squared, 4) AS r_squared) FROM trend""",
    ),
    "pb_trend_at_checkpoints": sql(
        f"{EFFORTS} activities races checkpoints trend_at",
        """SELECT * REPLACE (round(predicted_best_sec, 4) AS predicted_best_sec,
          round(r_squared, 4) AS r_squared) FROM trend_at""",
    ),
    "pb_history": sql(
        EFFORTS,
        """SELECT athlete_id, name AS distance_label, CAST(start_date AS DATE) AS date,
          CAST(elapsed_time AS DOUBLE) AS sec FROM run_best""",
    ),
    "pb_projection": sql(
        f"{EFFORTS} trend",
        """SELECT * FROM (SELECT athlete_id, name AS distance_label, count(*) AS n_efforts,
            CAST(max(start_date) AS DATE) AS last_date,
            CAST(first(elapsed_time ORDER BY start_date DESC, elapsed_time) AS DOUBLE) AS last_sec
          FROM run_best GROUP BY athlete_id, name)
        LEFT JOIN (SELECT * REPLACE (round(predicted_best_sec, 4) AS predicted_best_sec,
            round(r_squared, 4) AS r_squared) FROM trend WHERE predicted_best_sec > 1)
          USING (athlete_id, distance_label)""",
    ),
    "riegel_forecast": sql(
        _pair_parts,
        """SELECT athlete_id, name,
          round(sec * pow(metres / src, CAST(1.06 AS DOUBLE)), 4) AS predicted_sec FROM pairs""",
        [_pairs],
    ),
    "vdot_forecast": sql(
        _pair_parts,
        """SELECT athlete_id, name, round(vdot_sec, 4) AS predicted_sec
        FROM pairs LEFT JOIN solved USING (k)""",
        [_pairs, *_vdot_times("pairs")],
    ),
    "elev_adjusted_forecast": sql(
        _pair_parts,
        f"""SELECT athlete_id, name, round({_FLAT} * pow(metres / src, CAST(1.06 AS DOUBLE))
          + 2 * 5 * metres / 1000, 4) AS predicted_sec FROM pairs""",
        [_pairs],
    ),
    "efforts_with_parent": sql(
        f"{EFFORTS} activities",
        """SELECT id, elapsed_time, round(distance_km, 4) AS activity_distance_km,
          round(elev_gain_m / nullif(distance_km, 0), 4) AS elev_per_km
        FROM run_best LEFT JOIN activities USING (activity_id)""",
    ),
    "source_effort": sql(
        f"{EFFORTS} activities races checkpoints source",
        """SELECT * REPLACE (round(source_elev_per_km, 4) AS source_elev_per_km) FROM source""",
    ),
    "race_backtest": _backtest(f"SELECT {_FORECAST_COLUMNS} FROM rf"),
    "race_backtest_blended": _backtest(f"SELECT {_FORECAST_COLUMNS} FROM rf", _TREND),
    "race_backtest_leak_free": _backtest(f"SELECT {_FORECAST_COLUMNS} FROM rf", _TREND_AT),
    "final_forecast": _backtest(f"SELECT {_FORECAST_COLUMNS} FROM {_FINAL}", _TREND),
    "forecast_pivot": _backtest(
        f"""SELECT f.athlete_id, target_distance_label,
          {_time_text("max(actual_sec)")} AS actual_time,
          {", ".join(
              f"round_even(max(error_pct) FILTER (WHERE method = '{m}') * 10, 0) / 10 AS {m}"
              for m in schema.METHODS
          )}, {_name("t", "f.athlete_id")} AS name
        FROM {_FINAL} f LEFT JOIN athletes t USING (athlete_id)
        GROUP BY f.athlete_id, target_distance_label, t.firstname, t.lastname""",
        _TREND,
        "athletes",
    ),
    "method_error_summary": _backtest(
        f"""SELECT target_distance_label, method, round(avg(abs(error_pct)), 4) AS mape,
          count(*) AS n_forecasts FROM {_FINAL} GROUP BY target_distance_label, method""",
        _TREND,
    ),
    "forecast_traceback": _backtest(
        f"""SELECT rf.athlete_id, {_name("t", "rf.athlete_id")} AS name, race_activity_id, method,
          as_of_date, round(predicted_sec / 60, 4) AS predicted_min
        FROM rf LEFT JOIN athletes t USING (athlete_id)""",
        _TREND,
        "athletes",
    ),
    "sensitivity_grid": sql(
        f"{EFFORTS} pbs preferred",
        f"""SELECT athlete_id, source_label, round(sec, 4) AS source_sec, point,
          'Half-Marathon' AS target, method, round(predicted_sec, 4) AS predicted_sec
        FROM (SELECT *, 'riegel' AS method,
            sec * pow(metres / source_m, CAST(1.06 AS DOUBLE)) AS predicted_sec FROM swept
          UNION ALL SELECT s.*, 'vdot', vdot_sec FROM swept s JOIN solved USING (k)
          UNION ALL SELECT *, 'elevation_adjusted', sec * pow(metres / source_m,
            CAST(1.06 AS DOUBLE)) + 2 * 5 * metres / 1000 FROM swept)""",
        [
            f"""swept AS (SELECT *, {_vdot("source_m", "sec / 60")} AS level
            FROM (SELECT row_number() OVER () AS k, athlete_id, source_label, source_m, point,
              CAST(21097.5 AS DOUBLE) AS metres,
              source_sec * (CAST(0.7 AS DOUBLE) + point * (CAST(0.6 AS DOUBLE) / 49)) AS sec
            FROM preferred, (SELECT CAST(unnest(generate_series(0, 49)) AS INT) AS point)))""",
            *_vdot_times("swept"),
        ],
    ),
    "what_if_grid": sql(
        f"{EFFORTS} pbs preferred",
        """SELECT athlete_id, scenario, method, round(predicted_sec, 4) AS predicted_sec,
          round(predicted_sec / metres * 1000, 4) AS pace_sec_per_km
        FROM (SELECT *, 'riegel' AS method, sec * pow(metres / source_m, e) AS predicted_sec
            FROM tried
          UNION ALL SELECT t.*, 'vdot', vdot_sec FROM tried t LEFT JOIN solved USING (k)
          UNION ALL SELECT *, 'elevation_adjusted', sec * pow(metres / source_m,
            CAST(1.06 AS DOUBLE)) + 2 * elev * metres / 1000 FROM tried)""",
        [
            f"""tried AS (SELECT *, CASE WHEN sec > 0
              THEN {_vdot("source_m", "nullif(sec, 0) / 60")} END AS level
            FROM (SELECT row_number() OVER () AS k, athlete_id, source_m, scenario,
              l.metres, elev, CAST(e AS DOUBLE) AS e, source_sec + delta AS sec
            FROM preferred, (VALUES (0, -300, 'Half-Marathon', 0, 1.00),
                (1, 0, 'Half-Marathon', 5, 1.06), (2, 300, 'Marathon', 50, 1.15),
                (3, 0, '400m', 5, 1.06)) v(scenario, delta, target, elev, e)
            JOIN labels l ON l.distance_label = target))""",
            *_vdot_times("tried"),
        ],
    ),
    "extract_nested_id": """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS activity_id FROM lineitem""",
    "clean_best": sql(
        EFFORTS,
        """SELECT id, name, elapsed_time, CAST(start_date AS DATE) AS start_date, activity_id,
          athlete_id FROM run_best""",
    ),
    "repair_text": """SELECT doc_id, md5(text) AS from_garbled, md5(text) AS from_clean
        FROM documents""",
    "clean_segments": """SELECT conv_id * 100 + turn AS id, md5(text) AS name_md5,
        conv_id AS activity_id, CAST(NULL AS BIGINT) AS athlete_id, 6 AS hour_utc,
        8 AS hour_local, 3 AS kom_rank FROM conversations""",
    "clean_profiles": sql("athletes", "SELECT * FROM athletes"),
    "normalise_activities": """SELECT activity_id, 'Run' AS activity_type, athlete_id,
          'A' AS athlete_name, date, date AS start_time_utc, duration_sec,
          round(km, 4) AS distance_km, elev_gain_m,
          round(duration_sec / nullif(km, 0), 4) AS avg_pace_sec_km, 'API' AS source
        FROM (SELECT o_orderkey AS activity_id, o_custkey AS athlete_id,
          CAST(o_orderdate AS DATE) AS date,
          CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderkey % 5000 + 600 AS INT) ELSE 0 END
            AS duration_sec,
          CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice / 11987 ELSE 0 END AS km,
          CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 300 AS DOUBLE) ELSE 0 END
            AS elev_gain_m FROM orders)""",
    "explode_streams": """SELECT o_orderkey AS activity_id, i * 5 AS time_s,
          CAST(10 + i * 0.5 AS DOUBLE) AS lat, CAST(100 - i * 0.25 AS DOUBLE) AS lon,
          CAST(i * 12.5 AS DOUBLE) AS dist_m, CAST(NULL AS DOUBLE) AS alt_m,
          CASE WHEN o_orderkey % 5 <> 0 THEN i + 120 END AS hr_bpm, CAST(NULL AS INT) AS cadence,
          CAST(NULL AS INT) AS watts
        FROM (SELECT o_orderkey, CAST(unnest(generate_series(0, 2 + o_orderkey % 4)) AS INT) AS i
          FROM orders WHERE o_orderkey % 6 <> 0)""",
    "explode_best_efforts": sql(
        "priorities", _garbled_effort.format(where="o_orderkey % 3 <> 0")
    ),
    "explode_segment_efforts": sql("priorities", _garbled_effort.format(where="rank <= 2")),
    "csv_round_trip": sql(
        "activities",
        """SELECT activity_id, date, duration_sec, round(distance_km, 4) AS distance_km, hr_avg,
          CAST(NULL AS VARCHAR) AS source FROM activities""",
    ),
    "read_keys": "SELECT DISTINCT l_orderkey FROM lineitem",
    "union_keys": """SELECT user_id AS activity_id FROM events
        UNION SELECT l_orderkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""",
    "new_activity_count": """SELECT count(DISTINCT o_orderkey) AS n_new FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    "union_by_name": sql(
        f"activities {EFFORTS}",
        """SELECT activity_id, round(distance_km, 4) AS distance_km,
          CAST(NULL AS INT) AS elapsed_time FROM activities
        UNION ALL SELECT activity_id, NULL, elapsed_time FROM run_best""",
    ),
    "insert_only_load": sql("activities", _load.format(old="date < DATE '2001-07-01'")),
    "upsert_load": sql("activities", _load.format(old="date < DATE '2000-07-01'")),
    "stream_ingest": sql("activities", _load.format(old="date < DATE '2001-07-01'")),
    "replace_groups_load": sql(
        EFFORTS,
        """SELECT athlete_id, name, date, sec FROM (SELECT *, date >= DATE '2000-07-01' AS later,
            bool_or(date >= DATE '2000-07-01') OVER (PARTITION BY athlete_id, name) AS replaced
          FROM (SELECT athlete_id, name, CAST(start_date AS DATE) AS date,
            min(elapsed_time) AS sec FROM run_best GROUP BY ALL))
        WHERE later OR NOT replaced""",
    ),
    "quality_suite": _backtest(
        "SELECT *, n_failures = 0 AS passed FROM ("
        + " UNION ALL ".join(
            [
                _suite("dim_date.not_null_date", _null("calendar", "date")),
                _suite("dim_date.unique_date", _dup("calendar", "date")),
                _suite(
                    "activity_start_location.not_null_activity_id",
                    _null("start_points", "activity_id"),
                ),
                _suite(
                    "activity_start_location.unique_activity_id",
                    _dup("start_points", "activity_id"),
                ),
                *[
                    _suite(f"dim_distance_label.{kind}_{column}", count("labels", column))
                    for column in ("distance_label", "sort_order")
                    for kind, count in (("not_null", _null), ("unique", _dup))
                ],
                *[
                    _suite(f"PBPrediction.not_null_{c}", _null("trend", c))
                    for c in ("athlete_id", "distance_label", "prediction_date")
                ],
                _suite(
                    "PBPrediction.unique_key",
                    _dup("trend", "athlete_id, distance_label, prediction_date"),
                ),
                *[
                    _suite(f"RaceForecast.not_null_{c}", _null("rf", c))
                    for c in ("athlete_id", "target_distance_label", "as_of_date")
                ],
                _suite(
                    "RaceForecast.accepted_values_method",
                    "SELECT count(*) FROM rf WHERE method NOT IN "
                    "('riegel', 'vdot', 'elevation_adjusted')",
                ),
                _suite(
                    "RaceForecast.unique_key",
                    _dup("rf", "athlete_id, target_distance_label, method, as_of_date"),
                ),
            ]
        )
        + ")",
        _TREND,
        f"calendar {STREAM} start_points",
    ),
    "quality_violations": sql(
        "raw_stream",
        " UNION ALL ".join(
            [
                _check("not_null_lat", f"({_null('raw_stream', 'lat')})"),
                _check("unique_orderkey", f"({_dup('lineitem', 'l_orderkey')})"),
                _check("unique_line", f"({_dup('lineitem', 'l_orderkey, l_linenumber')})"),
                _check(
                    "accepted_flag",
                    "(SELECT count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N'))",
                ),
            ]
        ),
    ),
}

# Silver has one effort of each id: the fastest, of equal ones the earliest.
_UNIQUE_BEST = [
    f"all_best AS ({PARTS['run_best']})",
    """run_best AS (SELECT * EXCLUDE copy FROM (SELECT *, row_number() OVER (
        PARTITION BY id ORDER BY elapsed_time, start_date) AS copy FROM all_best) WHERE copy = 1)""",
]
_one = lambda name, key: f"SELECT * FROM ({ORACLE[name]}) WHERE {key} = 4"
ORACLE |= {
    "filter_both_ways": sql(
        f"activities athletes calendar {STREAM} start_points",
        """, kept AS (SELECT a.activity_id, a.athlete_id FROM activities a
            JOIN start_points s ON s.activity_id = a.activity_id
            WHERE start_lat > 10.7003 AND a.date IN
              (SELECT date FROM calendar WHERE week_relative_to_today BETWEEN 0 AND 200))
        SELECT 'activities' AS of, activity_id AS id FROM kept
        UNION ALL SELECT 'starts', activity_id FROM kept
        UNION ALL SELECT 'athletes', athlete_id FROM athletes
          WHERE athlete_id IN (SELECT athlete_id FROM kept)""",
    ),
    "store_load": sql(
        "activities",
        """SELECT activity_id, athlete_id, date,
          round(CASE WHEN date < DATE '2000-07-01' THEN 1 ELSE 2 END * distance_km, 4) AS distance_km,
          round(CASE WHEN date < DATE '2001-07-01' THEN 1 ELSE 2 END * distance_km, 4) AS first_km
        FROM activities""",
    ),
    "store_replace_groups": ORACLE["replace_groups_load"],
    "ingest_mixed_headers": sql(
        "labels priorities",
        """SELECT id, CASE WHEN id % 5 = 0 THEN name || chr(10) || 'second "line", of it'
            ELSE name END AS name,
          elapsed_time, CASE WHEN id % 3 = 0 THEN elapsed_time END AS moving_time,
          CAST(start_date AS DATE) AS start_date,
          CASE WHEN id % 3 <> 1 THEN CAST(floor(metres) AS INT) END AS distance,
          activity_id, athlete_id
        FROM run_best JOIN labels ON distance_label = name""",
        _UNIQUE_BEST,
    ),
    "ingest_rejects": sql(
        EFFORTS,
        """SELECT 'moving_time' AS column_name, 'n/a' AS value, count(*) AS n_rows
        FROM run_best WHERE id % 3 = 0 AND id % 4 = 0 HAVING count(*) > 0""",
    ),
    "enrich_incremental": ORACLE["enrich_activities"],
    "files_to_gold": sql(
        "labels priorities",
        f"""SELECT t.athlete_id, t.distance_label, round(predicted_best_sec, 4) AS predicted_best_sec,
          prediction_date, round(r_squared, 4) AS r_squared, {MONDAY} AS week_start_date, sort_order
        FROM trend t JOIN labels l ON l.distance_label = t.distance_label""",
        [*_UNIQUE_BEST, f"trend AS ({PARTS['trend']})"],
    ),
    "gold_checks_on_write": ORACLE["quality_suite"],
    "one_athlete_recent": _one("recent_20", "athlete_id"),
    "one_athlete_bests": _one("personal_bests", "athlete_id"),
    "one_athlete_history": _one("history_monthly", "athlete_id"),
    "one_activity_series": _one("channel_series", "activity_id"),
    "one_activity_route": _one("route_points", "activity_id"),
}
