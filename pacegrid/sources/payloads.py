"""Nested API payloads, landed as JSON, to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacegrid.functions.text import utc_timestamp
from pacegrid.schema import columns

# Shape of an activity summary.
SUMMARY = columns(
    "id bigint, type string, distance double, elapsed_time int, start_date string, "
    "start_date_local string, total_elevation_gain double, athlete_id bigint, athlete_name string"
)


def _channel(values: T.DataType) -> T.StructType:
    return T.StructType().add("data", T.ArrayType(values))


# Shape of a stream payload; every channel is an array of equal length.
STREAMS = (
    T.StructType()
    .add("activity_id", T.LongType())
    .add("time", _channel(T.IntegerType()))
    .add("latlng", _channel(T.ArrayType(T.DoubleType())))
    .add("distance", _channel(T.DoubleType()))
    .add("altitude", _channel(T.DoubleType()))
    .add("heartrate", _channel(T.IntegerType()))
    .add("cadence", _channel(T.IntegerType()))
    .add("watts", _channel(T.IntegerType()))
)
# Shape of the parts of an activity's detail payload that are read.
_EFFORT = (
    columns(
        "id bigint, name string, elapsed_time int, moving_time int, start_date string, "
        "distance double"
    )
    .add("activity", columns("id bigint"))
    .add("athlete", columns("id bigint"))
)
DETAIL = (
    columns("id bigint, sport_type string")
    .add("segment_efforts", T.ArrayType(_EFFORT))
    .add("best_efforts", T.ArrayType(_EFFORT))
)


def parse_payload(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """JSON text to the payload's columns; unknown keys are ignored, malformed text is NULL."""
    return df.select(F.from_json(text, schema).alias("p")).select("p.*")


def normalise_activities(raw: DataFrame) -> DataFrame:
    """Activity summaries to Activities rows.

    A missing and a null climb look the same here; both become 0.
    """
    metres = F.coalesce("distance", F.lit(0.0))
    elapsed = F.coalesce("elapsed_time", F.lit(0))
    return raw.select(
        F.col("id").alias("activity_id"),
        F.col("type").alias("activity_type"),
        "athlete_id",
        "athlete_name",
        F.substring("start_date_local", 1, 10).try_cast("date").alias("date"),
        utc_timestamp(F.col("start_date")).alias("start_time_utc"),
        elapsed.alias("duration_sec"),
        (metres / 1000).alias("distance_km"),
        F.coalesce("total_elevation_gain", F.lit(0.0)).alias("elev_gain_m"),
        F.try_divide(elapsed, metres / 1000).alias("avg_pace_sec_km"),
        F.lit("API").alias("source"),
    )


def explode_streams(raw: DataFrame) -> DataFrame:
    """Parallel channel arrays to one row per point; payloads without positions give none."""

    def channel(name: str) -> Column:
        return F.coalesce(F.col(f"{name}.data"), F.array())

    channels = {
        "time_s": "time",
        "latlng": "latlng",
        "dist_m": "distance",
        "alt_m": "altitude",
        "hr_bpm": "heartrate",
        "cadence": "cadence",
        "watts": "watts",
    }
    zipped = raw.where(F.col("latlng").isNotNull()).select(
        "activity_id", *[channel(source).alias(name) for name, source in channels.items()]
    )
    points = zipped.select("activity_id", F.inline(F.arrays_zip(*channels)))
    return points.select(
        "activity_id",
        "time_s",
        F.get("latlng", F.lit(0)).alias("lat"),
        F.get("latlng", F.lit(1)).alias("lon"),
        "dist_m",
        "alt_m",
        F.col("hr_bpm").try_cast("smallint").alias("hr_bpm"),
        F.col("cadence").try_cast("smallint").alias("cadence"),
        "watts",
    )


def explode_efforts(raw: DataFrame, kind: str) -> DataFrame:
    """Detail payloads to effort rows; ``best`` efforts count for running only."""
    if kind == "best":
        efforts = raw.where(F.lower("sport_type") == "run").select(F.inline("best_efforts"))
    elif kind == "segments":
        efforts = raw.select(F.inline("segment_efforts"))
    else:
        raise ValueError(f"kind must be 'best' or 'segments', not {kind!r}")
    return (
        efforts.withColumn("activity_id", F.col("activity.id"))
        .withColumn("athlete_id", F.col("athlete.id"))
        .withColumn("start_date", utc_timestamp(F.col("start_date")))
        .drop("activity", "athlete")
    )


def profiles_to_table(raw: DataFrame, athlete_id: str = "athlete_id") -> DataFrame:
    """Profile rows with the columns in name order; profiles may differ in their keys."""
    return raw.select(*sorted({*raw.columns, athlete_id}))
