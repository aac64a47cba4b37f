"""Latest rows, top and bottom athletes, personal bests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacegrid import schema
from pacegrid.functions.calendar import in_weeks
from pacegrid.functions.text import format_time
from pacegrid.operators.rollups import TOTALS, add_names, totals

# Longest run of tied names written into one text cell; beyond it read the tied rows.


def latest_activity(activities: DataFrame, athletes: DataFrame) -> DataFrame:
    """The latest activity; equal start times go to the larger id."""
    columns = ["activity_id", "athlete_id", "start_time_utc", "distance_km"]
    newest = [F.desc_nulls_last("start_time_utc"), F.desc("activity_id")]
    latest = activities.select(*columns).orderBy(*newest).limit(1)
    return add_names(latest, athletes)


def latest_run_text(activities: DataFrame) -> DataFrame:
    """Latest start time and the last name, in text order, among activities starting then."""
    starts = F.col("start_time_utc")
    latest = activities.agg(
        F.max(starts).alias("at"),
        F.max(F.when(starts.isNotNull(), F.struct(starts, "athlete_name"))).alias("row"),
    )
    when_text = F.date_format("at", "MMM d, yyyy (HH:mm)")
    return latest.select(
        "at", F.concat(F.col("row.athlete_name"), F.lit(" - "), when_text).alias("latest_run")
    )


def recent(activities: DataFrame, n: int = 20, athlete_id: int | None = None) -> DataFrame:
    """The ``n`` latest activities of each athlete, or of one."""
    if athlete_id is not None:
        activities = activities.where(F.col("athlete_id") == athlete_id)
    newest_first = Window.partitionBy("athlete_id").orderBy(
        F.desc_nulls_last("start_time_utc"), F.desc("activity_id")
    )
    label = F.concat(
        F.col("date").cast("string"),
        F.lit(" — "),
        F.format_string("%.1f", F.bround("distance_km", 1)),
        F.lit(" km ("),
        format_time(F.col("duration_sec")),
        F.lit(")"),
    )
    columns = ["athlete_id", "activity_id", "date", "start_time_utc", "distance_km", "duration_sec"]
    return (
        activities.select(*columns)
        .withColumn("rank", F.row_number().over(newest_first))
        .where(F.col("rank") <= n)
        .withColumn("label", label)
    )


def _by_metric(per_athlete: DataFrame) -> DataFrame:
    rows = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("val")) for m in TOTALS
    ]
    return per_athlete.select("athlete_id", F.inline(F.array(*rows)))


def week_per_athlete(activities: DataFrame, as_of: dt.date, week: int = 0) -> DataFrame:
    return (
        activities.where(in_weeks(F.col("date"), as_of, week, week))
        .groupBy("athlete_id")
        .agg(*totals())
    )


def top_bottom(per_athlete: DataFrame, athletes: DataFrame) -> DataFrame:
    """Best athlete per metric, and worst among those above zero (else the best again).

    Equal values go to the smaller id. Names are looked up for the winners only.
    """
    best = F.max(F.struct("val", (-F.col("athlete_id")).alias("id")))
    worst = F.min(F.when(F.col("val") > 0, F.struct("val", F.col("athlete_id").alias("id"))))
    found = (
        _by_metric(per_athlete)
        .groupBy("metric")
        .agg(best.alias("best"), worst.alias("worst"))
        .select(
            "metric",
            (-F.col("best.id")).alias("top_id"),
            F.col("best.val").alias("top_val"),
            F.coalesce(F.col("worst.id"), -F.col("best.id")).alias("bottom_id"),
            F.coalesce(F.col("worst.val"), F.col("best.val")).alias("bottom_val"),
        )
    )
    sides = F.array(
        *[
            F.struct(
                F.lit(side).alias("side"),
                F.col(f"{side}_id").alias("athlete_id"),
                F.col(f"{side}_val").alias("val"),
            )
            for side in ("top", "bottom")
        ]
    )
    named = add_names(found.select("metric", F.inline(sides)), athletes)
    return (
        named.groupBy("metric")
        .pivot("side", ["top", "bottom"])
        .agg(F.first("name").alias("name"), F.first("val").alias("val"))
    )


def top_bottom_ties(per_athlete: DataFrame, athletes: DataFrame) -> DataFrame:
    """All athletes tied for best, and all tied for worst above zero, per metric.

    The extremes are aggregated first and joined back, so no window holds all athletes.
    """
    long = _by_metric(per_athlete)
    extremes = long.groupBy("metric").agg(
        F.max("val").alias("top"), F.min(F.when(F.col("val") > 0, F.col("val"))).alias("bottom")
    )
    sides = F.array(
        F.when(F.col("val") == F.col("top"), F.lit("top")),
        F.when(F.col("val") == F.col("bottom"), F.lit("bottom")),
    )
    tied = long.join(F.broadcast(extremes), "metric").select(  # one row per metric: three
        "metric", F.explode(F.array_compact(sides)).alias("side"), "athlete_id", "val"
    )
    return add_names(tied, athletes)


def tied_rows(ties: DataFrame) -> DataFrame:
    """All tied names in order, each with how many share its side; nothing is gathered."""
    counts = ties.groupBy("metric", "side").agg(F.count(F.lit(1)).alias("n_tied"))
    sized = ties.join(F.broadcast(counts), ["metric", "side"])  # at most six rows
    return sized.orderBy("metric", "side", "name", "athlete_id")


def personal_bests(
    athletes: DataFrame, run_best: DataFrame, athlete_id: int | None = None
) -> DataFrame:
    """Best time per standard distance, with a row for every distance."""
    if athlete_id is not None:
        athletes = athletes.where(F.col("athlete_id") == athlete_id)
        run_best = run_best.where(F.col("athlete_id") == athlete_id)
    labels = F.array(
        *[
            F.struct(F.lit(i).alias("sort_order"), F.lit(name).alias("distance_label"))
            for i, (name, _) in enumerate(schema.DISTANCE_LABELS, 1)
        ]
    )
    every = athletes.select("athlete_id", F.inline(labels))
    best = pb_map(run_best).withColumnRenamed("name", "distance_label")
    return every.join(best, ["athlete_id", "distance_label"], "left").withColumn(
        "personal_best", format_time(F.col("pb_sec"))
    )


def pb_map(run_best: DataFrame) -> DataFrame:
    """Best time per athlete and standard distance that has one."""
    standard = [name for name, _ in schema.DISTANCE_LABELS]
    return (
        run_best.where(F.col("name").isin(standard))
        .groupBy("athlete_id", "name")
        .agg(F.min("elapsed_time").alias("pb_sec"))
    )


def preferred_pb(run_best: DataFrame) -> DataFrame:
    """Per athlete, the best time at the most preferred source distance they have."""
    metres = dict(schema.DISTANCE_LABELS)
    order = F.element_at(
        F.create_map(*[F.lit(x) for i, n in enumerate(schema.SOURCE_PRIORITY) for x in (n, i)]),
        F.col("name"),
    )
    length = F.element_at(
        F.create_map(*[F.lit(x) for n in schema.SOURCE_PRIORITY for x in (n, metres[n])]),
        F.col("name"),
    )
    best = pb_map(run_best.where(F.col("name").isin(schema.SOURCE_PRIORITY)))
    first = best.groupBy("athlete_id").agg(
        F.min(F.struct(order.alias("rank"), "name", "pb_sec", length.alias("m"))).alias("first")
    )
    return first.select(
        "athlete_id",
        F.col("first.name").alias("source_label"),
        F.col("first.m").alias("source_m"),
        F.col("first.pb_sec").cast("double").alias("source_sec"),
    )


def athletes_with_efforts(run_best: DataFrame, athletes: DataFrame) -> DataFrame:
    """Athletes that have any best effort, with the number of distances."""
    labels = run_best.groupBy("athlete_id").agg(F.countDistinct("name").alias("n_labels"))
    return add_names(labels, athletes)


def effort_labels(run_best: DataFrame, athlete_id: int | None = None) -> DataFrame:
    """The distinct distances each athlete has efforts at."""
    if athlete_id is not None:
        run_best = run_best.where(F.col("athlete_id") == athlete_id)
    return run_best.select("athlete_id", "name").distinct()
