"""Training block before a race."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacegrid.functions.calendar import day, week_start
from pacegrid.operators.rollups import athlete_names

TRAIN_WEEKS = 16
TAPER_WEEKS = 3
LONG_RUN_KM = 18


def race_athletes(
    activities: DataFrame,
    athletes: DataFrame,
    km_lo: float,
    km_hi: float,
    first: dt.date,
    last: dt.date,
) -> DataFrame:
    """Athletes with a run of that length in those days; all athletes if there is none."""
    raced = (
        activities.where(
            F.col("distance_km").between(km_lo, km_hi)
            & F.col("date").between(day(first), day(last))
        )
        .select("athlete_id")
        .distinct()
    )
    known = athlete_names(athletes)
    matching = known.join(raced, "athlete_id", "left_semi")
    return matching.unionByName(known.where(~matching.select("athlete_id").exists()))


def athletes_without_race(
    activities: DataFrame, athletes: DataFrame, km_lo: float, km_hi: float
) -> DataFrame:
    """Athletes that never ran a distance in the range."""
    raced = activities.where(F.col("distance_km").between(km_lo, km_hi)).select("athlete_id")
    return athletes.select("athlete_id").join(raced.distinct(), "athlete_id", "left_anti")


def training_block(
    activities: DataFrame,
    race_date: dt.date,
    weeks: int = TRAIN_WEEKS,
    athlete_id: int | None = None,
) -> DataFrame:
    """Weekly load per athlete up to a race, with the change from their previous active week.

    Weeks without runs have no row and are skipped by the change, not taken as zero.
    The window holds one row per week of the block.
    """
    if athlete_id is not None:
        activities = activities.where(F.col("athlete_id") == athlete_id)
    start = race_date - dt.timedelta(weeks=weeks)
    weekly = (
        activities.where(F.col("date").between(day(start), day(race_date)))
        .groupBy("athlete_id", week_start(F.col("date")).alias("week_start_date"))
        .agg(
            F.sum("distance_km").alias("km"),
            F.max("distance_km").alias("long_run_km"),
            F.countDistinct("activity_id").alias("n_runs"),
            F.avg("hr_avg").alias("avg_hr"),
        )
    )
    before = F.lag("km").over(Window.partitionBy("athlete_id").orderBy("week_start_date"))
    ramp = F.abs(F.col("ramp_pct"))
    return weekly.withColumn(
        "ramp_pct", F.try_divide(F.col("km") - before, before) * 100
    ).withColumn(
        "ramp_band",
        F.when(ramp.isNull(), F.lit(None).cast("string"))
        .when(ramp > 30, "red")
        .when(ramp > 10, "amber")
        .otherwise("green"),
    )


def ramp_rate(block: DataFrame) -> DataFrame:
    return block.where(F.col("ramp_pct").isNotNull()).select(
        "athlete_id", "week_start_date", "ramp_pct", "ramp_band"
    )


def readiness(block: DataFrame, taper_start: dt.date) -> DataFrame:
    """Peak, longest run, consistency and taper of each athlete's block."""
    week, km = F.col("week_start_date"), F.col("km")
    earliest_peak = F.max(
        F.when(km.isNotNull(), F.struct(km, (-F.unix_date(week)).alias("back"), week))
    )
    first_taper = F.min(F.when(week >= day(taper_start), F.struct(week, km)))
    summary = block.groupBy("athlete_id").agg(
        earliest_peak.alias("peak"),
        F.max("long_run_km").alias("longest_run"),
        (F.avg(F.when(F.col("n_runs") >= 3, 1.0).otherwise(0.0)) * 100).alias("consistency"),
        first_taper.alias("taper"),
    )
    peak_km, taper_km = F.col("peak.km"), F.col("taper.km")
    drop = F.try_divide(taper_km - peak_km, peak_km) * 100
    return summary.select(
        "athlete_id",
        peak_km.alias("peak_km"),
        F.col("peak.week_start_date").alias("peak_week"),
        "longest_run",
        (F.col("longest_run") >= LONG_RUN_KM).alias("hit_18k"),
        "consistency",
        taper_km.alias("taper_km"),
        F.when(taper_km != 0, drop).alias("taper_drop"),
    )
