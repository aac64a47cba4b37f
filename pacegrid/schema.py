"""Table schemas, primary keys and fixed reference values."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def columns(listing: str) -> T.StructType:
    """A schema from ``name type, name type``; unlike DDL parsing this needs no session."""
    pairs = (item.split() for item in listing.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RUN_STREAM = columns(
    "activity_id bigint, time_s int, lat double, lon double, dist_m double, "
    "alt_m double, hr_bpm smallint, cadence smallint, watts int"
)
RUN_BEST = columns(
    "id bigint, name string, elapsed_time int, moving_time int, start_date timestamp, "
    "distance int, activity_id bigint, athlete_id bigint"
)
RUN_SEGMENT = columns(
    "id bigint, name string, elapsed_time int, moving_time int, start_date timestamp, "
    "start_date_local timestamp, distance double, start_index int, end_index int, "
    "average_cadence double, average_watts double, average_heartrate double, "
    "max_heartrate int, activity_id bigint, athlete_id bigint"
)
RUN_SPLIT = columns(
    "activity_id bigint, segment_number int, segment_start_time int, segment_end_time int, "
    "start_lat double, start_lon double, cumulative_distance_m double, avg_hr_bpm double, "
    "avg_cadence double, avg_watts double, segment_distance_m double, duration_s int, "
    "pace_sec_per_km double"
)
ACTIVITIES = columns(
    "activity_id bigint, activity_type string, athlete_id bigint, athlete_name string, "
    "date date, start_time_utc timestamp, duration_sec int, distance_km double, "
    "elev_gain_m double, avg_pace_sec_km double, source string, hr_avg double, hr_max int, "
    "cad_avg double, cad_max int, elev_min double, elev_max double, total_ascent double, "
    "total_descent double, stride_len_m double"
)
ATHLETE = columns(
    "athlete_id bigint, city string, country string, firstname string, lastname string, "
    "sex string, weight int"
)
DIM_DATE = columns(
    "date date, iso_year int, iso_week int, day_name string, day_of_week int, "
    "week_start_date date, week_relative_to_today int, days_ago int"
)
START_LOCATION = columns(
    "activity_id bigint, athlete_id bigint, athlete_name string, date date, "
    "activity_type string, start_lat double, start_lon double"
)
PB_PREDICTION = columns(
    "athlete_id bigint, distance_label string, predicted_best_sec double, "
    "prediction_date date, r_squared double"
)
RACE_FORECAST = columns(
    "athlete_id bigint, race_activity_id bigint, target_distance_label string, "
    "method string, as_of_date date, source_distance_label string, source_pb_sec double, "
    "predicted_sec double, actual_sec double, error_sec double, error_pct double"
)
DISTANCE_LABEL = columns(
    "distance_label string, standard_distance_m double, sort_order int"
)

# Bronze keeps some raw columns that silver leaves out.
BRONZE_EXTRA = {
    "RunBest": columns("start_index int, end_index int"),
    "RunSegment": columns(
        "device_watts boolean, visibility string, hidden boolean, kom_rank int"
    ),
    "Athlete": columns("id bigint"),
}

SILVER = {
    "RunStream": RUN_STREAM,
    "RunBest": RUN_BEST,
    "RunSegment": RUN_SEGMENT,
    "RunSplitKilometer": RUN_SPLIT,
    "Activities": ACTIVITIES,
    "Athlete": ATHLETE,
}
GOLD = {
    "dim_date": DIM_DATE,
    "activity_start_location": START_LOCATION,
    "dim_distance_label": DISTANCE_LABEL,
    "PBPrediction": PB_PREDICTION,
    "RaceForecast": RACE_FORECAST,
}

PRIMARY_KEY = {
    "RunStream": ["activity_id", "time_s"],
    "RunBest": ["id"],
    "RunSegment": ["id"],
    "RunSplitKilometer": ["activity_id", "segment_number"],
    "Activities": ["activity_id"],
    "Athlete": ["athlete_id"],
}

# The thirteen standard distances in metres, in display order.
DISTANCE_LABELS = [
    ("400m", 400.0),
    ("1/2 mile", 804.672),
    ("1K", 1000.0),
    ("1 mile", 1609.344),
    ("2 mile", 3218.688),
    ("5K", 5000.0),
    ("10K", 10000.0),
    ("15K", 15000.0),
    ("10 mile", 16093.44),
    ("20K", 20000.0),
    ("Half-Marathon", 21097.5),
    ("30K", 30000.0),
    ("Marathon", 42195.0),
]
# Labels a forecast may start from, most preferred first.
SOURCE_PRIORITY = ["10K", "15K", "5K", "20K", "10 mile", "1 mile", "30K"]

# Forecast method names.
METHODS = ["riegel", "vdot", "elevation_adjusted"]
