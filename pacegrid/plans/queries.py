"""The registered queries: each operator over whole test tables.

Queries of the athlete and activity views run for all athletes and activities at once, those
named ``one_…`` for one.
Outputs are rounded here, for comparison across engines; the operators do not round.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacegrid import schema
from pacegrid.functions.text import nested_id, repair_latin1
from pacegrid.operators import (
    calendar,
    dedupe,
    forecast,
    quality,
    rankings,
    readiness,
    rollups,
    streams,
    trend,
)
from pacegrid.plans import pipeline
from pacegrid.plans.bindings import AS_OF, KM_PRICE, MAP_DAY, RACE_DATE, RACE_DAYS, RACE_KM, Tables, dict_text
from pacegrid.session import work_folder
from pacegrid.sources import clean, files, payloads, tables
from pacegrid.sources.layers import load_layers
from pacegrid.sources.store import Load, Store, file_system, hadoop_path
from pacegrid.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Days that split the activities into an earlier and a later load.
FIRST_LOAD_UNTIL = dt.date(2001, 7, 1)
SECOND_LOAD_FROM = dt.date(2000, 7, 1)
TABLE_BUCKETS = 8
# An athlete and an activity to look at by themselves.
ONE_ATHLETE, ONE_ACTIVITY = 4, 4
DEGREES = {"lat", "lon", "start_lat", "start_lon"}

WHAT_IF = [
    {"delta_sec": -300, "target": "Half-Marathon", "elev": 0.0, "exponent": 1.00},
    {"delta_sec": 0, "target": "Half-Marathon", "elev": 5.0, "exponent": 1.06},
    {"delta_sec": 300, "target": "Marathon", "elev": 50.0, "exponent": 1.15},
    {"delta_sec": 0, "target": "400m", "elev": 5.0, "exponent": 1.06},
]


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a query under its function's name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(build(Tables(spark, folder)))

    QUERIES[build.__name__] = run
    return build


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles to ``digits`` places (degrees to six), small integers widened to int."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind == "double":
            column = F.round(column, 6 if name in DEGREES else digits)
        elif kind in ("smallint", "tinyint"):
            column = column.cast("int")
        columns.append(column.alias(name))
    return df.select(*columns)


# --- point streams ---------------------------------------------------------------------


@query
def km_splits(t: Tables) -> DataFrame:
    return streams.km_splits(t.stream())


@query
def activity_metrics(t: Tables) -> DataFrame:
    return streams.activity_metrics(t.stream())


@query
def enrich_activities(t: Tables) -> DataFrame:
    enriched = streams.enrich_activities(t.activities(), streams.activity_metrics(t.stream()))
    return enriched.select("activity_id", "distance_km", "hr_avg", "cad_max", "stride_len_m")


@query
def first_gps_point(t: Tables) -> DataFrame:
    return streams.first_gps_point(t.activities(), t.stream())


@query
def dedupe_stream(t: Tables) -> DataFrame:
    return t.stream()


@query
def dedupe_report(t: Tables) -> DataFrame:
    return dedupe.dedupe_report(t.read("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def route_points(t: Tables) -> DataFrame:
    return streams.gps_points(t.stream())


@query
def split_table(t: Tables) -> DataFrame:
    return streams.split_table(streams.km_splits(t.stream()))


@query
def channel_series(t: Tables) -> DataFrame:
    return streams.channel_series(t.stream())


@query
def week_gps_points(t: Tables) -> DataFrame:
    points = streams.gps_points(t.stream())
    return streams.points_of_week(t.activities(), t.athletes(), points, MAP_DAY)


# --- calendar --------------------------------------------------------------------------


@query
def dim_date(t: Tables) -> DataFrame:
    return calendar.dim_date(t.activities(), AS_OF)


@query
def week_list(t: Tables) -> DataFrame:
    return calendar.week_list(calendar.dim_date(t.activities(), AS_OF), AS_OF)


@query
def filter_propagation(t: Tables) -> DataFrame:
    """Start points and athletes left by a selection of four calendar weeks."""
    activities = t.activities()
    weeks = calendar.dim_date(activities, AS_OF).where("week_relative_to_today between 0 and 3")
    chosen = calendar.filter_by_dimension(activities, weeks, "date")
    return calendar.filter_by_dimension(t.athletes(), chosen, "athlete_id").select(
        "athlete_id", "country"
    )


@query
def filter_both_ways(t: Tables) -> DataFrame:
    """Activities and start points match row by row: a selection of weeks and one of start
    points reach each other's table, and the athletes are those of what is left."""
    activities = t.activities()
    starts = streams.first_gps_point(activities, t.stream())
    weeks = calendar.dim_date(activities, AS_OF).where("week_relative_to_today between 0 and 200")
    left = calendar.filter_both_ways(
        {
            "weeks": weeks,
            "activities": activities,
            "starts": starts.where(F.col("start_lat") > 10.7003),
            "athletes": t.athletes(),
        },
        [
            ("weeks", "activities", "date", False),
            ("activities", "starts", "activity_id", True),
            ("activities", "athletes", "athlete_id", False),
        ],
    )
    kinds = {"activities": "activity_id", "starts": "activity_id", "athletes": "athlete_id"}
    return files.union_by_name(
        [left[name].select(F.lit(name).alias("of"), F.col(key).alias("id")) for name, key in kinds.items()]
    )


# --- squad view ------------------------------------------------------------------------


@query
def week_kpis(t: Tables) -> DataFrame:
    return rollups.week_totals(t.activities(), AS_OF)


@query
def week_kpis_by_calendar(t: Tables) -> DataFrame:
    """All weeks, through the join with the calendar table."""
    activities = t.activities()
    weeks = calendar.dim_date(activities, AS_OF).select(
        "date", F.col("week_relative_to_today").alias("week_rel")
    )
    return activities.join(weeks, "date").groupBy("week_rel").agg(*rollups.totals())


@query
def wow_change(t: Tables) -> DataFrame:
    return rollups.wow(rollups.week_totals(t.activities(), AS_OF))


@query
def wow_by_athlete(t: Tables) -> DataFrame:
    return rollups.wow_by_athlete(t.activities(), AS_OF)


@query
def month_kpis(t: Tables) -> DataFrame:
    return rollups.month_totals(t.activities(), AS_OF)


@query
def month_to_date_kpis(t: Tables) -> DataFrame:
    return rollups.month_totals(t.activities(), AS_OF, up_to_as_of=True)


@query
def athletes_on_day(t: Tables) -> DataFrame:
    return rollups.athletes_on_day(t.activities(), t.athletes(), AS_OF)


@query
def latest_activity(t: Tables) -> DataFrame:
    latest = rankings.latest_activity(t.activities(), t.athletes())
    return latest.withColumn("start_time_utc", F.col("start_time_utc").cast("date"))


@query
def latest_run_text(t: Tables) -> DataFrame:
    return rankings.latest_run_text(t.activities()).select("latest_run")


@query
def top_bottom_runner(t: Tables) -> DataFrame:
    return rankings.top_bottom(rankings.week_per_athlete(t.activities(), AS_OF), t.athletes())


@query
def top_runner_ties(t: Tables) -> DataFrame:
    return rankings.top_bottom_ties(rankings.week_per_athlete(t.activities(), AS_OF), t.athletes())


@query
def tied_rows(t: Tables) -> DataFrame:
    per_athlete = rankings.week_per_athlete(t.activities(), AS_OF)
    return rankings.tied_rows(rankings.top_bottom_ties(per_athlete, t.athletes()))


@query
def day_runs_with_pace(t: Tables) -> DataFrame:
    return rollups.day_runs(t.activities(), t.athletes(), AS_OF)


@query
def day_pace(t: Tables) -> DataFrame:
    return rollups.day_pace(t.activities(), t.athletes(), AS_OF)


@query
def squad_4week(t: Tables) -> DataFrame:
    return rollups.squad_weeks(t.activities(), t.athletes(), AS_OF)


@query
def volume_vs_time(t: Tables) -> DataFrame:
    return rollups.volume_vs_time(t.activities(), t.athletes(), AS_OF, week=1)


@query
def runner_stats(t: Tables) -> DataFrame:
    return rollups.runner_stats(t.activities(), t.athletes(), AS_OF)


@query
def run_frequency(t: Tables) -> DataFrame:
    return rollups.run_frequency(t.activities())


# --- athlete view ----------------------------------------------------------------------


@query
def athlete_week_kpis(t: Tables) -> DataFrame:
    return rollups.week_totals(t.activities(), AS_OF, by=("athlete_id",))


@query
def athlete_details(t: Tables) -> DataFrame:
    return rollups.athlete_details(t.athletes())


@query
def athlete_names(t: Tables) -> DataFrame:
    return rollups.athlete_names(t.athletes())


@query
def activity_card(t: Tables) -> DataFrame:
    return rollups.activity_card(t.activities())


@query
def history_monthly(t: Tables) -> DataFrame:
    return rollups.history(t.activities(), "month", AS_OF)


@query
def history_weekly(t: Tables) -> DataFrame:
    return rollups.history(t.activities(), "week", AS_OF)


@query
def day_grid(t: Tables) -> DataFrame:
    activities = t.activities()
    days = calendar.dim_date(activities, AS_OF)
    return rollups.day_grid(days, activities, t.athletes(), AS_OF)


@query
def day_grid_6week(t: Tables) -> DataFrame:
    activities = t.activities()
    days = calendar.dim_date(activities, AS_OF)
    return rollups.day_grid(days, activities, t.athletes(), AS_OF, weeks=6)


@query
def recent_20(t: Tables) -> DataFrame:
    latest = rankings.recent(t.activities(), 20)
    return latest.drop("start_time_utc", "distance_km", "duration_sec")


@query
def personal_bests(t: Tables) -> DataFrame:
    return rankings.personal_bests(t.athletes(), t.run_best())


@query
def pb_map(t: Tables) -> DataFrame:
    return rankings.pb_map(t.run_best())


@query
def preferred_pb(t: Tables) -> DataFrame:
    return rankings.preferred_pb(t.run_best())


@query
def athletes_with_efforts(t: Tables) -> DataFrame:
    return rankings.athletes_with_efforts(t.run_best(), t.athletes())


@query
def effort_labels(t: Tables) -> DataFrame:
    return rankings.effort_labels(t.run_best())


# --- readiness -------------------------------------------------------------------------


@query
def race_athletes(t: Tables) -> DataFrame:
    return readiness.race_athletes(t.activities(), t.athletes(), *RACE_KM, *RACE_DAYS)


@query
def race_athletes_fallback(t: Tables) -> DataFrame:
    """Nobody has run this far, so all athletes are listed."""
    return readiness.race_athletes(t.activities(), t.athletes(), 1000.0, 1001.0, *RACE_DAYS)


@query
def athletes_without_race(t: Tables) -> DataFrame:
    return readiness.athletes_without_race(t.activities(), t.athletes(), *RACE_KM)


@query
def training_block(t: Tables) -> DataFrame:
    return readiness.training_block(t.activities(), RACE_DATE).drop("ramp_pct", "ramp_band")


@query
def ramp_rate(t: Tables) -> DataFrame:
    return readiness.ramp_rate(readiness.training_block(t.activities(), RACE_DATE))


@query
def readiness_summary(t: Tables) -> DataFrame:
    taper = RACE_DATE - dt.timedelta(weeks=readiness.TAPER_WEEKS)
    return readiness.readiness(readiness.training_block(t.activities(), RACE_DATE), taper)


# --- trend and forecast ----------------------------------------------------------------


@query
def pb_trend(t: Tables) -> DataFrame:
    return trend.pb_trend(t.run_best(), AS_OF)


@query
def pb_trend_at_checkpoints(t: Tables) -> DataFrame:
    return trend.trend_at(t.run_best(), forecast.checkpoints(t.races()))


@query
def pb_history(t: Tables) -> DataFrame:
    return trend.pb_history(t.run_best())


@query
def pb_projection(t: Tables) -> DataFrame:
    efforts = t.run_best()
    return trend.pb_projection(efforts, trend.pb_trend(efforts, AS_OF))


def _pairs(t: Tables) -> DataFrame:
    """Every athlete's best at each distance, towards a half marathon at 5 m/km."""
    return rankings.pb_map(t.run_best()).select(
        "athlete_id",
        "name",
        F.col("pb_sec").cast("double").alias("source_sec"),
        forecast.length_of(F.col("name")).alias("source_m"),
        F.when(F.col("name") != "5K", 2.5).alias("source_elev"),
        F.lit(21097.5).alias("target_m"),
        F.lit(5.0).alias("target_elev"),
    )


def _predicted(t: Tables, method: str) -> DataFrame:
    return forecast.forecast(_pairs(t), [method]).select("athlete_id", "name", "predicted_sec")


@query
def riegel_forecast(t: Tables) -> DataFrame:
    return _predicted(t, "riegel")


@query
def vdot_forecast(t: Tables) -> DataFrame:
    return _predicted(t, "vdot")


@query
def elev_adjusted_forecast(t: Tables) -> DataFrame:
    return _predicted(t, "elevation_adjusted")


@query
def efforts_with_parent(t: Tables) -> DataFrame:
    joined = forecast.with_parent(t.run_best(), t.activities())
    return joined.select("id", "elapsed_time", "activity_distance_km", "elev_per_km")


@query
def source_effort(t: Tables) -> DataFrame:
    points = forecast.checkpoints(t.races()).select("athlete_id", "as_of_date")
    return forecast.source_effort(t.run_best(), t.activities(), points)


def _backtest(t: Tables, blended: bool = True, leak_free: bool = False) -> DataFrame:
    efforts = t.run_best()
    fits = trend.pb_trend(efforts, AS_OF) if blended and not leak_free else None
    return forecast.race_backtest(
        t.races(), efforts, t.activities(), trend=fits, leak_free=leak_free
    )


@query
def race_backtest(t: Tables) -> DataFrame:
    return _backtest(t, blended=False)


@query
def race_backtest_blended(t: Tables) -> DataFrame:
    return _backtest(t)


@query
def race_backtest_leak_free(t: Tables) -> DataFrame:
    return _backtest(t, leak_free=True)


@query
def final_forecast(t: Tables) -> DataFrame:
    return forecast.final_forecast(_backtest(t))


@query
def forecast_pivot(t: Tables) -> DataFrame:
    return forecast.forecast_pivot(_backtest(t), t.athletes())


@query
def method_error_summary(t: Tables) -> DataFrame:
    return forecast.method_error(_backtest(t))


@query
def forecast_traceback(t: Tables) -> DataFrame:
    named = forecast.forecast_named(_backtest(t), t.athletes())
    return named.select(
        "athlete_id", "name", "race_activity_id", "method", "as_of_date", "predicted_min"
    )


@query
def sensitivity_grid(t: Tables) -> DataFrame:
    return forecast.sensitivity_grid(rankings.preferred_pb(t.run_best())).drop("source_m")


@query
def what_if_grid(t: Tables) -> DataFrame:
    grid = forecast.what_if(rankings.preferred_pb(t.run_best()), WHAT_IF)
    return grid.select("athlete_id", "scenario", "method", "predicted_sec", "pace_sec_per_km")


# --- cleaning and payloads -------------------------------------------------------------


@query
def extract_nested_id(t: Tables) -> DataFrame:
    """Ids out of dict texts; the text is cut short where the line is returned."""
    line = t.read("lineitem")
    whole = dict_text(F.col("l_orderkey"), ", 'name': 'x'")
    broken = F.expr("substring(text, 1, length(text) - 1)")
    texts = line.select(
        "l_orderkey", "l_linenumber", "l_returnflag", whole.alias("text")
    ).withColumn("text", F.when(F.col("l_returnflag") == "R", broken).otherwise(F.col("text")))
    return texts.select(
        "l_orderkey", "l_linenumber", nested_id(F.col("text")).alias("activity_id")
    )


@query
def clean_best(t: Tables) -> DataFrame:
    raw = t.run_best().select(
        "id",
        F.lit(2).alias("resource_state"),
        "name",
        dict_text(F.col("activity_id")).alias("activity"),
        dict_text(F.col("athlete_id"), ", 'team': None").alias("athlete"),
        "elapsed_time",
        F.date_format("start_date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("start_date"),
        F.lit(None).cast("string").alias("pr_rank"),
    )
    cleaned = clean.clean_best(raw)
    return cleaned.withColumn("start_date", F.col("start_date").cast("date"))


@query
def repair_text(t: Tables) -> DataFrame:
    """Whole texts, once as they are and once garbled; both must come out as they were."""
    texts = t.read("documents").select("doc_id", "text")
    garbled = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return texts.select(
        "doc_id",
        F.md5(repair_latin1(garbled)).alias("from_garbled"),
        F.md5(repair_latin1(F.col("text"))).alias("from_clean"),
    )


@query
def clean_segments(t: Tables) -> DataFrame:
    """Conversation turns as raw segment rows with garbled names."""
    raw = t.read("conversations").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"),
        F.decode(F.encode("text", "UTF-8"), "ISO-8859-1").alias("name"),
        dict_text(F.col("conv_id")).alias("activity"),
        F.lit("{'resource_state': 1}").alias("athlete"),
        F.lit("{}").alias("segment"),
        F.lit("2001-07-25T06:30:00Z").alias("start_date"),
        F.lit("2001-07-25T08:30:00Z").alias("start_date_local"),
        F.lit(3).alias("kom_rank"),
    )
    cleaned = clean.clean_segments(raw)
    return cleaned.select(
        "id",
        F.md5("name").alias("name_md5"),
        "activity_id",
        "athlete_id",
        F.hour("start_date").alias("hour_utc"),
        F.hour("start_date_local").alias("hour_local"),
        "kom_rank",
    )


@query
def clean_profiles(t: Tables) -> DataFrame:
    raw = t.athletes().select(
        "*",
        F.col("athlete_id").alias("id"),
        F.lit("x").alias("username"),
        F.lit(None).cast("string").alias("bio"),
    )
    return clean.clean_profiles(payloads.profiles_to_table(raw))


@query
def normalise_activities(t: Tables) -> DataFrame:
    """Orders written as summary JSON, with gaps, and read back."""
    key = F.col("o_orderkey")
    start = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    summary = F.struct(
        key.alias("id"),
        F.lit("Run").alias("type"),
        F.when(key % 13 != 0, F.col("o_totalprice") / KM_PRICE * 1000).alias("distance"),
        F.when(key % 17 != 0, (key % 5000 + 600).cast("int")).alias("elapsed_time"),
        start.alias("start_date"),
        start.alias("start_date_local"),
        F.when(key % 5 != 0, (key % 300).cast("double")).alias("total_elevation_gain"),
        F.col("o_custkey").alias("athlete_id"),
        F.lit("A").alias("athlete_name"),
    )
    texts = t.read("orders").select(F.to_json(summary).alias("text"))
    rows = payloads.normalise_activities(payloads.parse_payload(texts, "text", payloads.SUMMARY))
    return rows.withColumn("start_time_utc", F.col("start_time_utc").cast("date"))


@query
def explode_streams(t: Tables) -> DataFrame:
    """Orders written as stream payloads of three to six points, some without positions."""
    key = F.col("o_orderkey")
    steps = F.sequence(F.lit(0), (key % 4 + 2).cast("int"))

    def channel(values) -> F.Column:
        return F.struct(values.alias("data"))

    position = F.transform(
        steps, lambda i: F.array(F.lit(10.0) + i * F.lit(0.5), F.lit(100.0) - i * F.lit(0.25))
    )
    payload = F.struct(
        key.alias("activity_id"),
        channel(F.transform(steps, lambda i: i * 5)).alias("time"),
        F.when(key % 6 != 0, channel(position)).alias("latlng"),
        channel(F.transform(steps, lambda i: i * F.lit(12.5))).alias("distance"),
        F.when(key % 5 != 0, channel(F.transform(steps, lambda i: i + 120))).alias("heartrate"),
    )
    texts = t.read("orders").select(F.to_json(payload).alias("text"))
    return payloads.explode_streams(payloads.parse_payload(texts, "text", payloads.STREAMS))


def _effort_rows(t: Tables, kind: str) -> DataFrame:
    """Orders written as detail payloads with one effort per standard source distance."""
    key, athlete = F.col("o_orderkey"), F.col("o_custkey")
    effort = lambda label: F.struct(
        key.alias("id"),
        label.alias("name"),
        F.lit(100).alias("elapsed_time"),
        F.lit("2001-01-01T00:00:00Z").alias("start_date"),
        F.struct(key.alias("id")).alias("activity"),
        F.struct(athlete.alias("id")).alias("athlete"),
    )
    labels = F.array(*[F.lit(p) for p in schema.SOURCE_PRIORITY])
    detail = F.struct(
        key.alias("id"),
        F.when(key % 3 == 0, "Ride").otherwise("Run").alias("sport_type"),
        F.transform(F.slice(labels, 1, 2), effort).alias("segment_efforts"),
        F.transform(labels, effort).alias("best_efforts"),
    )
    texts = t.read("orders").select(F.to_json(detail).alias("text"))
    raw = payloads.parse_payload(texts, "text", payloads.DETAIL)
    return payloads.explode_efforts(raw, kind).select(
        "activity_id", "athlete_id", "name", "elapsed_time"
    )


@query
def explode_best_efforts(t: Tables) -> DataFrame:
    return _effort_rows(t, "best")


@query
def explode_segment_efforts(t: Tables) -> DataFrame:
    return _effort_rows(t, "segments")


# --- loads -----------------------------------------------------------------------------


def _load_rows(t: Tables) -> DataFrame:
    return t.activities().select("activity_id", "athlete_id", "date", "distance_km")


def _changed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("distance_km", F.col("distance_km") * 2)


@query
def csv_round_trip(t: Tables) -> DataFrame:
    path = work_folder(t.spark, "csv")
    files.land(t.activities().drop("start_time_utc"), path, "csv")
    back = files.read_csv_table(t.spark, path, schema.ACTIVITIES)
    return back.select("activity_id", "date", "duration_sec", "distance_km", "hr_avg", "source")


@query
def read_keys(t: Tables) -> DataFrame:
    path = work_folder(t.spark, "keys")
    files.land(t.read("lineitem").select("l_orderkey", "l_partkey"), path)
    return files.read_keys(t.spark, path, "l_orderkey")


@query
def union_keys(t: Tables) -> DataFrame:
    """Activities that have a stream or a best effort."""
    return files.union_keys(
        t.raw_stream().select("activity_id"), t.run_best().select("activity_id")
    )


@query
def new_activity_count(t: Tables) -> DataFrame:
    """Activities that are not yet loaded when those with efforts are."""
    return tables.count_new(
        t.activities(), t.run_best().select("activity_id").distinct(), "activity_id"
    )


@query
def union_by_name(t: Tables) -> DataFrame:
    return files.union_by_name(
        [
            t.activities().select("activity_id", "distance_km"),
            t.run_best().select("activity_id", "elapsed_time"),
        ]
    )


@query
def insert_only_load(t: Tables) -> DataFrame:
    """A second load brings changed rows for old and new keys; only new keys get in."""
    path, rows = work_folder(t.spark, "insert_only"), _load_rows(t)
    tables.insert_only(rows.where(F.col("date") < F.lit(FIRST_LOAD_UNTIL)), path, "activity_id")
    later = rows.where(F.col("date") >= F.lit(SECOND_LOAD_FROM))
    for _ in range(2):  # the repeat must not change anything
        tables.insert_only(_changed(later), path, "activity_id")
    return t.spark.read.parquet(path)


@query
def upsert_load(t: Tables) -> DataFrame:
    """A second load replaces the rows of its keys and adds new ones."""
    path, rows = work_folder(t.spark, "upsert"), _load_rows(t)
    first = rows.where(F.col("date") < F.lit(FIRST_LOAD_UNTIL))
    tables.upsert(first, path, "activity_id", TABLE_BUCKETS)
    later = _changed(rows.where(F.col("date") >= F.lit(SECOND_LOAD_FROM)))
    tables.upsert(later, path, "activity_id", TABLE_BUCKETS)
    return t.spark.read.parquet(path).drop("buckets", "bucket")


@query
def replace_groups_load(t: Tables) -> DataFrame:
    """Athlete and label groups of a later load replace all earlier rows of the group."""
    path, efforts = work_folder(t.spark, "replace_groups"), t.run_best()
    keys = ["athlete_id", "name"]
    day = F.col("start_date").cast("date")
    per_day = efforts.groupBy(*keys, day.alias("date")).agg(F.min("elapsed_time").alias("sec"))
    split = F.col("date") < F.lit(SECOND_LOAD_FROM)
    tables.replace_groups(per_day.where(split), path, keys, TABLE_BUCKETS)
    tables.replace_groups(per_day.where(~split), path, keys, TABLE_BUCKETS)
    return t.spark.read.parquet(path).drop("buckets", "bucket")


@query
def stream_ingest(t: Tables) -> DataFrame:
    """Two drops of CSV files ingested incrementally; the second repeats known keys."""
    root, rows = work_folder(t.spark, "ingest"), _load_rows(t)
    drops = [
        rows.where(F.col("date") < F.lit(FIRST_LOAD_UNTIL)),
        _changed(rows.where(F.col("date") >= F.lit(SECOND_LOAD_FROM))),
    ]
    for drop in drops:
        files.land(drop, f"{root}/raw", "csv")
        ingest.ingest_table(
            t.spark,
            f"{root}/raw",
            rows.schema,
            f"{root}/table",
            "activity_id",
            f"{root}/checkpoint",
        ).awaitTermination()
    return t.spark.read.parquet(f"{root}/table")


@query
def store_load(t: Tables) -> DataFrame:
    """Loads of two tables of a store: one breaks before its commit, one comes twice."""
    store, rows = Store(t.spark, work_folder(t.spark, "store"), TABLE_BUCKETS), _load_rows(t)
    first = rows.where(F.col("date") < F.lit(FIRST_LOAD_UNTIL))
    later = _changed(rows.where(F.col("date") >= F.lit(SECOND_LOAD_FROM)))

    def bring(load: Load, batch: DataFrame) -> None:
        load.upsert("latest", batch, "activity_id")
        load.insert_only("oldest", batch, "activity_id")

    store.once("loads", 0, lambda load: bring(load, first))
    bring(store.load(), _changed(later))
    for _ in range(2):
        store.once("loads", 1, lambda load: bring(load, later))
    oldest = store.read("oldest").select("activity_id", F.col("distance_km").alias("first_km"))
    # Both are whole tables: neither goes to every task, however small its files are.
    return store.read("latest").join(oldest.hint("merge"), "activity_id")


@query
def store_replace_groups(t: Tables) -> DataFrame:
    """Groups of a store's table replaced by a later load, after a load that broke."""
    store, efforts = Store(t.spark, work_folder(t.spark, "store"), TABLE_BUCKETS), t.run_best()
    keys = ["athlete_id", "name"]
    day = F.col("start_date").cast("date")
    per_day = efforts.groupBy(*keys, day.alias("date")).agg(F.min("elapsed_time").alias("sec"))
    split = F.col("date") < F.lit(SECOND_LOAD_FROM)
    store.once("days", 0, lambda load: load.replace("best", per_day.where(split), keys))
    store.load().replace("best", per_day.withColumn("sec", F.lit(0)), keys)
    store.once("days", 1, lambda load: load.replace("best", per_day.where(~split), keys))
    return store.read("best")


def _effort_files(t: Tables, folder: str, name: Column, moving: Column | None = None) -> None:
    """Raw effort files of three layouts: other orders and columns, whole numbers written with
    a fraction, a byte order mark, and names that may hold line breaks and quotes."""
    text = t.run_best().select(
        "id",
        F.lit("2").alias("resource_state"),
        name.alias("name"),
        dict_text(F.col("activity_id")).alias("activity"),
        dict_text(F.col("athlete_id"), ", 'team': None").alias("athlete"),
        F.col("elapsed_time").cast("string").alias("elapsed_time"),
        F.col("elapsed_time").cast("double").cast("string").alias("fraction"),
        (F.col("moving_time") if moving is None else moving).alias("moving_time"),
        F.date_format("start_date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("start_date"),
        "distance",
    )
    rest = ["name", "activity", "athlete"]
    layouts = [
        text.select("id", "resource_state", *rest, "elapsed_time", "moving_time", "start_date", "distance"),
        text.select("start_date", F.col("fraction").alias("elapsed_time"), *reversed(rest), "id"),
        text.select(F.col("id").alias("\ufeffid"), "distance", *rest, "start_date", "elapsed_time"),
    ]
    places = file_system(t.spark, folder)
    places.mkdirs(hadoop_path(t.spark, f"{folder}/raw"))
    for i, layout in enumerate(layouts):
        own = layout.where(F.col("\ufeffid" if i == 2 else "id") % 3 == i)
        own.write.option("header", True).option("escape", '"').csv(f"{folder}/layout-{i}", compression="gzip")
        # As many files as tasks wrote; a raw file is known by how its name ends.
        for found in places.listStatus(hadoop_path(t.spark, f"{folder}/layout-{i}")):
            part = found.getPath().getName()
            if part.endswith(".csv.gz"):
                places.rename(found.getPath(), hadoop_path(t.spark, f"{folder}/raw/{i}-{part[:-7]}_best.csv.gz"))


@query
def ingest_mixed_headers(t: Tables) -> DataFrame:
    """Effort files with three headers, line breaks in names, and a mark before a header."""
    folder = work_folder(t.spark, "ingest")
    broken = F.when(F.col("id") % 5 == 0, F.concat("name", F.lit('\nsecond "line", of it'))).otherwise(F.col("name"))
    _effort_files(t, folder, broken)
    for _ in range(2):
        ingest.ingest_folder(t.spark, f"{folder}/raw", f"{folder}/lake")
    best = pipeline.silver(t.spark, f"{folder}/lake", "RunBest")
    return best.withColumn("start_date", F.col("start_date").cast("date"))


@query
def ingest_rejects(t: Tables) -> DataFrame:
    """Values that their column cannot take, kept by an ingest: how many of each."""
    folder = work_folder(t.spark, "rejects")
    late = F.when(F.col("id") % 4 == 0, "n/a").when(F.col("id") % 4 == 1, "").otherwise(F.col("moving_time").cast("string"))
    _effort_files(t, folder, F.col("name"), late)
    ingest.ingest_folder(t.spark, f"{folder}/raw", f"{folder}/lake")
    rejected = Store(t.spark, f"{folder}/lake").read("bronze/Rejected")
    return rejected.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def enrich_incremental(t: Tables) -> DataFrame:
    """Two loads of points and summaries: either may come first, metrics are those of one load."""
    store = Store(t.spark, work_folder(t.spark, "enrich"), TABLE_BUCKETS)
    points, rows = t.stream(), t.activities()
    odd, late = F.col("activity_id") % 2 == 1, F.col("activity_id") % 3 == 0

    def bring(load: Load, points: DataFrame, rows: DataFrame) -> None:
        load_layers(load, points, "RunStream")
        pipeline.enrich(load, rows)

    store.once("days", 0, lambda load: bring(load, points.where(odd), rows.where(~late)))
    for _ in range(2):
        store.once("days", 1, lambda load: bring(load, points.where(~odd), rows))
    found = store.read("silver/Activities", schema.SILVER["Activities"])
    return found.select("activity_id", "distance_km", "hr_avg", "cad_max", "stride_len_m")


@query
def files_to_gold(t: Tables) -> DataFrame:
    """Effort files, points, summaries and profiles to silver in one load, then gold: the trend
    with its rows of the calendar and the labels."""
    folder = work_folder(t.spark, "gold")
    _effort_files(t, folder, F.col("name"))
    root = f"{folder}/lake"

    def then(load: Load) -> None:
        load_layers(load, t.stream(), "RunStream")
        load_layers(load, t.athletes(), "Athlete")
        pipeline.enrich(load, t.activities())

    ingest.ingest_folder(t.spark, f"{folder}/raw", root, then)
    pipeline.build_gold(t.spark, root, AS_OF, t.races())
    gold = {n: tables.read_table(t.spark, f"{root}/gold/{n}", s) for n, s in schema.GOLD.items()}
    days = gold["dim_date"].select(F.col("date").alias("prediction_date"), "week_start_date")
    labels = gold["dim_distance_label"].select("distance_label", "sort_order")
    return gold["PBPrediction"].join(days, "prediction_date").join(labels, "distance_label")


# --- one athlete, one activity -----------------------------------------------------------


@query
def one_athlete_recent(t: Tables) -> DataFrame:
    latest = rankings.recent(t.activities(), 20, ONE_ATHLETE)
    return latest.drop("start_time_utc", "distance_km", "duration_sec")


@query
def one_athlete_bests(t: Tables) -> DataFrame:
    return rankings.personal_bests(t.athletes(), t.run_best(), ONE_ATHLETE)


@query
def one_athlete_history(t: Tables) -> DataFrame:
    return rollups.history(t.activities(), "month", AS_OF, ONE_ATHLETE)


@query
def one_activity_series(t: Tables) -> DataFrame:
    return streams.channel_series(t.stream(), ONE_ACTIVITY)


@query
def one_activity_route(t: Tables) -> DataFrame:
    return streams.gps_points(t.stream(), ONE_ACTIVITY)


# --- quality ---------------------------------------------------------------------------


@query
def quality_suite(t: Tables) -> DataFrame:
    activities, efforts = t.activities(), t.run_best()
    fits = trend.pb_trend(efforts, AS_OF)
    checks = quality.gold_checks(
        calendar.dim_date(activities, AS_OF),
        streams.first_gps_point(activities, t.stream()),
        tables.seed_labels(t.spark),
        fits,
        forecast.race_backtest(t.races(), efforts, activities, trend=fits),
        schema.METHODS,
    )
    return quality.quality_suite(checks)


@query
def gold_checks_on_write(t: Tables) -> DataFrame:
    """The gold checks as the load that builds gold finds them."""
    root = work_folder(t.spark, "gold")
    load = Store(t.spark, root).load()
    for name, df in (("Activities", t.activities()), ("RunBest", t.run_best()), ("RunStream", t.stream())):
        load.append(f"silver/{name}", files.conform(df, schema.SILVER[name]), ["activity_id"])
    load.commit()
    return pipeline.build_gold(t.spark, root, AS_OF, t.races())


@query
def quality_violations(t: Tables) -> DataFrame:
    """Each check over raw tables that break it: the number of rows it returns."""
    lines, points = t.read("lineitem"), t.raw_stream()
    checks = {
        "not_null_lat": quality.not_null(points, "lat"),
        "unique_orderkey": quality.unique(lines, "l_orderkey"),
        "unique_line": quality.unique_combo(lines, ["l_orderkey", "l_linenumber"]),
        "accepted_flag": quality.accepted_values(lines, "l_returnflag", ["A", "N"]),
    }
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("test"), "n_rows")
        for name, df in checks.items()
    ]
    return files.union_by_name(counts)
