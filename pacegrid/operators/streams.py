"""Operators over GPS point streams, unique on ``(activity_id, time_s)``.

One activity may hold a large share of all points, so no window spans an activity.
Windows run within chunks of ``2**CHUNK_BITS`` seconds, which hold at most that many
points because the time is an integer and unique; one summary row per chunk then carries
totals and edges over to the next. As the time is a 32-bit integer, an activity has at
most ``2**(31 - CHUNK_BITS)`` chunks, which bounds the windows over summaries as well.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from pacegrid.functions.calendar import in_weeks
from pacegrid.functions.geo import hop_m
from pacegrid.functions.text import format_time
from pacegrid.operators.joins import salted_join
from pacegrid.operators.rollups import add_names

CHUNK_BITS = 14

_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def _by_time() -> WindowSpec:
    return Window.partitionBy("activity_id", "chunk").orderBy("time_s")


def _by_chunk() -> WindowSpec:
    return Window.partitionBy("activity_id").orderBy("chunk")


def _chunked(stream: DataFrame) -> DataFrame:
    placed = stream.where(F.col("activity_id").isNotNull() & F.col("time_s").isNotNull())
    return placed.withColumn("chunk", F.shiftright("time_s", CHUNK_BITS))


def hops(stream: DataFrame) -> DataFrame:
    """Add ``hop_m`` from the previous point, the running ``cum_m`` and its kilometre ``km``.

    The first hop of an activity is 0, and so is a hop from or to a missing coordinate.
    A hop belongs to the kilometre it ends in.
    """
    by_time, by_chunk = _by_time(), _by_chunk()
    local = (
        _chunked(stream)
        .withColumn("opens_chunk", F.lag("time_s").over(by_time).isNull())
        .withColumn(
            "hop_m",
            hop_m(
                F.lag("lat").over(by_time), F.lag("lon").over(by_time), F.col("lat"), F.col("lon")
            ),
        )
        .withColumn("local_m", F.sum("hop_m").over(by_time.rowsBetween(*_SO_FAR)))
    )
    chunks = local.groupBy("activity_id", "chunk").agg(
        F.max("local_m").alias("chunk_m"),
        F.min_by("lat", "time_s").alias("lat_in"),
        F.min_by("lon", "time_s").alias("lon_in"),
        F.max_by("lat", "time_s").alias("lat_out"),
        F.max_by("lon", "time_s").alias("lon_out"),
    )
    entry = hop_m(
        F.lag("lat_out").over(by_chunk),
        F.lag("lon_out").over(by_chunk),
        F.col("lat_in"),
        F.col("lon_in"),
    )
    before = F.sum(F.col("entry_m") + F.col("chunk_m")).over(by_chunk.rowsBetween(*_BEFORE))
    carried = chunks.withColumn("entry_m", entry).select(
        "activity_id",
        "chunk",
        "entry_m",
        (F.coalesce(before, F.lit(0.0)) + F.col("entry_m")).alias("start_m"),
    )
    # Every chunk has its summary row. A left join adds no filter to one side only, so that
    # both readings of the stream share the exchanges below.
    return (
        local.join(carried, ["activity_id", "chunk"], "left")
        .withColumn("hop_m", F.when(F.col("opens_chunk"), F.col("entry_m")).otherwise(F.col("hop_m")))
        .withColumn("cum_m", F.col("start_m") + F.col("local_m"))
        .withColumn("km", (F.floor(F.col("cum_m") / 1000) + 1).cast("int"))
        .drop("chunk", "opens_chunk", "local_m", "entry_m", "start_m")
    )


def km_splits(stream: DataFrame) -> DataFrame:
    """One row per activity and kilometre: time span, start, means, length and pace."""

    def first_known(column: str):
        return F.min_by(column, F.when(F.col(column).isNotNull(), F.col("time_s")))

    duration = F.col("segment_end_time") - F.col("segment_start_time")
    return (
        hops(stream)
        .groupBy("activity_id", F.col("km").alias("segment_number"))
        .agg(
            F.min("time_s").alias("segment_start_time"),
            F.max("time_s").alias("segment_end_time"),
            first_known("lat").alias("start_lat"),
            first_known("lon").alias("start_lon"),
            F.max("cum_m").alias("cumulative_distance_m"),
            F.avg("hr_bpm").alias("avg_hr_bpm"),
            F.avg("cadence").alias("avg_cadence"),
            F.avg("watts").alias("avg_watts"),
            F.sum("hop_m").alias("segment_distance_m"),
        )
        .withColumn("duration_s", duration)
        .withColumn(
            "pace_sec_per_km",
            F.try_divide(F.col("duration_s"), F.col("segment_distance_m") / 1000),
        )
    )


def activity_metrics(stream: DataFrame) -> DataFrame:
    """Per activity: heart rate, cadence, altitude range, ascent, descent and stride length."""
    by_time, by_chunk = _by_time(), _by_chunk()
    climb = F.col("alt_m") - F.last("alt_m", ignorenulls=True).over(by_time.rowsBetween(*_BEFORE))
    gap = F.col("time_s") - F.lag("time_s").over(by_time)
    known_alt_time = F.when(F.col("alt_m").isNotNull(), F.col("time_s"))
    chunks = (
        _chunked(stream)
        .withColumn("climb", climb)
        .withColumn("beats", F.col("cadence") * gap)
        .groupBy("activity_id", "chunk")
        .agg(
            F.sum("hr_bpm").alias("hr_sum"),
            F.count("hr_bpm").alias("hr_n"),
            F.max("hr_bpm").alias("hr_max"),
            F.sum("cadence").alias("cad_sum"),
            F.count("cadence").alias("cad_n"),
            F.max("cadence").alias("cad_max"),
            F.min("alt_m").alias("elev_min"),
            F.max("alt_m").alias("elev_max"),
            F.sum(F.greatest(F.col("climb"), F.lit(0.0))).alias("up"),
            F.sum(F.greatest(-F.col("climb"), F.lit(0.0))).alias("down"),
            F.sum("beats").alias("beats"),
            F.min("time_s").alias("time_in"),
            F.max("time_s").alias("time_out"),
            F.min_by("cadence", "time_s").alias("cadence_in"),
            F.min_by("alt_m", known_alt_time).alias("alt_in"),
            F.max_by("alt_m", known_alt_time).alias("alt_out"),
            F.max_by("dist_m", "time_s").alias("dist_out"),
        )
    )
    prior_alt = F.last("alt_out", ignorenulls=True).over(by_chunk.rowsBetween(*_BEFORE))
    across = (
        chunks.withColumn("climb_in", F.col("alt_in") - prior_alt)
        .withColumn(
            "beats_in",
            F.col("cadence_in") * (F.col("time_in") - F.lag("time_out").over(by_chunk)),
        )
        .groupBy("activity_id")
        .agg(
            F.try_divide(F.sum("hr_sum"), F.sum("hr_n")).alias("hr_avg"),
            F.max("hr_max").cast("int").alias("hr_max"),
            F.try_divide(F.sum("cad_sum"), F.sum("cad_n")).alias("cad_avg"),
            F.max("cad_max").cast("int").alias("cad_max"),
            F.min("elev_min").alias("elev_min"),
            F.max("elev_max").alias("elev_max"),
            F.sum(F.col("up") + F.greatest(F.col("climb_in"), F.lit(0.0))).alias("rise"),
            F.sum(F.col("down") + F.greatest(-F.col("climb_in"), F.lit(0.0))).alias("fall"),
            ((F.coalesce(F.sum("beats"), F.lit(0)) + F.coalesce(F.sum("beats_in"), F.lit(0))) / 60)
            .alias("steps"),
            F.max_by("dist_out", "chunk").alias("dist_m"),
        )
    )
    has_altitude = F.col("elev_min").isNotNull()
    return across.select(
        "activity_id",
        "hr_avg",
        "hr_max",
        "cad_avg",
        "cad_max",
        "elev_min",
        "elev_max",
        F.when(has_altitude, F.col("rise")).alias("total_ascent"),
        F.when(has_altitude, F.col("fall")).alias("total_descent"),
        F.when(F.col("steps") > 0, F.col("dist_m") / (2 * F.col("steps"))).alias("stride_len_m"),
    )


def enrich_activities(activities: DataFrame, metrics: DataFrame) -> DataFrame:
    """Activities with the stream metrics in place of same-named columns, if any."""
    measured = [c for c in metrics.columns if c != "activity_id"]
    return activities.drop(*measured).join(metrics, "activity_id", "left")


def gps_points(stream: DataFrame, activity_id: int | None = None) -> DataFrame:
    """Points that have a position, of all activities or of one."""
    points = stream.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    if activity_id is not None:
        points = points.where(F.col("activity_id") == activity_id)
    return points.select("activity_id", "time_s", "lat", "lon")


def first_gps_point(activities: DataFrame, stream: DataFrame) -> DataFrame:
    """One row per activity that has a positioned point: the earliest one."""
    first = (
        gps_points(stream)
        .groupBy("activity_id")
        .agg(
            F.min_by("lat", "time_s").alias("start_lat"),
            F.min_by("lon", "time_s").alias("start_lon"),
        )
    )
    columns = ["activity_id", "athlete_id", "athlete_name", "date", "activity_type"]
    return activities.select(*columns).join(first, "activity_id")


def channel_series(stream: DataFrame, activity_id: int | None = None) -> DataFrame:
    """Heart rate and power over time for activities that recorded either.

    ``has_hr`` and ``has_watts`` tell whether the activity has any value in the channel.
    """
    if activity_id is not None:
        stream = stream.where(F.col("activity_id") == activity_id)
    series = stream.select("activity_id", "time_s", "hr_bpm", "watts")
    channels = (
        series.groupBy("activity_id")
        .agg((F.count("hr_bpm") > 0).alias("has_hr"), (F.count("watts") > 0).alias("has_watts"))
        .where(F.col("has_hr") | F.col("has_watts"))
    )
    return salted_join(series, channels, "activity_id", "inner", ["time_s"])


def split_table(splits: DataFrame) -> DataFrame:
    return splits.select(
        "activity_id",
        "segment_number",
        F.concat(format_time(F.col("pace_sec_per_km")), F.lit("/km")).alias("average_pace"),
    )


def points_of_week(
    activities: DataFrame, athletes: DataFrame, points: DataFrame, as_of: dt.date, week: int = 0
) -> DataFrame:
    """Positioned points of the activities of one week, with the athlete's name."""
    chosen = activities.where(in_weeks(F.col("date"), as_of, week, week))
    named = add_names(chosen.select("activity_id", "athlete_id"), athletes)
    return salted_join(points, named, "activity_id", "inner", ["time_s"])
