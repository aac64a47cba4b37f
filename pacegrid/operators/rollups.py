"""Week, month and athlete totals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacegrid.functions.calendar import (
    day,
    in_month,
    in_weeks,
    monday,
    week_label,
    week_number_label,
    week_rel,
    week_start,
)
from pacegrid.functions.text import display_name, format_time, pace_label, round_half_even, signed_pct
from pacegrid.operators.calendar import with_week

TOTALS = ("total_km", "n_runs", "total_sec")


def totals() -> list[Column]:
    return [
        F.sum("distance_km").alias("total_km"),
        F.countDistinct("activity_id").alias("n_runs"),
        F.sum("duration_sec").alias("total_sec"),
    ]


def add_names(df: DataFrame, athletes: DataFrame) -> DataFrame:
    """Left join the display name. Call it on aggregated rows: one per athlete and group."""
    named = athletes.select("athlete_id", "firstname", "lastname")
    name = display_name(F.col("firstname"), F.col("lastname"), F.col("athlete_id"))
    joined = df.join(named, "athlete_id", "left").withColumn("name", name)
    return joined.drop("firstname", "lastname")


def _of_athlete(activities: DataFrame, athlete_id: int | None) -> DataFrame:
    return activities if athlete_id is None else activities.where(F.col("athlete_id") == athlete_id)


def week_totals(
    activities: DataFrame, as_of: dt.date, weeks: tuple[int, int] = (0, 1), by: tuple[str, ...] = ()
) -> DataFrame:
    """Distance, runs and time per week offset in the closed range ``weeks`` and per ``by``."""
    chosen = activities.where(in_weeks(F.col("date"), as_of, *weeks))
    return with_week(chosen, as_of).groupBy("week_rel", *by).agg(*totals())


def wow(week_rows: DataFrame) -> DataFrame:
    """This week against last week, one row per metric; no percentage on a zero base."""
    sides = week_rows.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("week_rel") == rel, F.col(m))), F.lit(0))
            .cast("double")
            .alias(f"{m}_{rel}")
            for m in TOTALS
            for rel in (0, 1)
        ]
    )
    pairs = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"{m}_0").alias("this_week"),
                F.col(f"{m}_1").alias("last_week"),
            )
            for m in TOTALS
        ]
    )
    change = F.col("this_week") - F.col("last_week")
    return (
        sides.select(F.inline(pairs))
        .withColumn("pct", F.try_divide(change, F.col("last_week")) * 100)
        .withColumn("pct_text", signed_pct(F.col("pct")))
    )


def wow_by_athlete(activities: DataFrame, as_of: dt.date) -> DataFrame:
    """Distance of this and last week per athlete, in one aggregate, with the change in %."""
    recent = activities.where(in_weeks(F.col("date"), as_of, 0, 1))
    this_week = in_weeks(F.col("date"), as_of, 0, 0)
    km = F.col("distance_km")
    both = recent.groupBy("athlete_id").agg(
        F.coalesce(F.sum(F.when(this_week, km)), F.lit(0.0)).alias("this_km"),
        F.coalesce(F.sum(F.when(~this_week, km)), F.lit(0.0)).alias("last_km"),
    )
    change = F.col("this_km") - F.col("last_km")
    return both.withColumn("pct", F.try_divide(change, F.col("last_km")) * 100)


def month_totals(activities: DataFrame, as_of: dt.date, up_to_as_of: bool = False) -> DataFrame:
    """One row for the calendar month of ``as_of``; sums are NULL for an empty month."""
    chosen = activities.where(in_month(F.col("date"), as_of, up_to_as_of))
    return chosen.agg(*totals())


def athletes_on_day(activities: DataFrame, athletes: DataFrame, on: dt.date) -> DataFrame:
    """Distinct athletes who ran on a day, next to the number of athletes."""
    ran = activities.where(F.col("date") == day(on)).agg(
        F.countDistinct("athlete_id").alias("n_athletes")
    )
    known = athletes.agg(F.countDistinct("athlete_id").alias("of_athletes"))
    return ran.select("n_athletes", known.scalar().alias("of_athletes"))


def day_runs(activities: DataFrame, athletes: DataFrame, on: dt.date) -> DataFrame:
    """The runs of a day with pace; runs without distance are left out."""
    km, sec = F.col("distance_km"), F.col("duration_sec")
    runs = activities.where((F.col("date") == day(on)) & (km > 0))
    return add_names(runs, athletes).select(
        "activity_id",
        "name",
        "distance_km",
        F.try_divide(sec, km).alias("pace_sec"),
        pace_label(sec, km).alias("pace_label"),
    )


def day_pace(activities: DataFrame, athletes: DataFrame, on: dt.date) -> DataFrame:
    """One row per athlete who ran on a day: total distance, and pace over all their runs."""
    per_athlete = (
        activities.where(F.col("date") == day(on))
        .groupBy("athlete_id")
        .agg(F.sum("distance_km").alias("km"), F.sum("duration_sec").alias("sec"))
    )
    pace = F.try_divide(F.col("sec"), F.col("km"))
    return add_names(per_athlete, athletes).withColumn("pace_sec", pace)


def squad_weeks(
    activities: DataFrame, athletes: DataFrame, as_of: dt.date, weeks: int = 4
) -> DataFrame:
    """Distance per athlete and week over the last ``weeks`` weeks."""
    chosen = with_week(activities.where(in_weeks(F.col("date"), as_of, 0, weeks - 1)), as_of)
    per_athlete = chosen.groupBy("week_rel", "week_start_date", "athlete_id").agg(
        F.sum("distance_km").alias("km")
    )
    return add_names(per_athlete, athletes).withColumn("week_label", week_label(F.col("week_rel")))


def volume_vs_time(
    activities: DataFrame, athletes: DataFrame, as_of: dt.date, week: int = 0
) -> DataFrame:
    per_athlete = (
        activities.where(in_weeks(F.col("date"), as_of, week, week))
        .groupBy("athlete_id")
        .agg(F.sum("distance_km").alias("km"), F.sum("duration_sec").alias("sec"))
    )
    return add_names(per_athlete, athletes)


def runner_stats(
    activities: DataFrame, athletes: DataFrame, as_of: dt.date, week: int = 0
) -> DataFrame:
    """Per athlete in one week. Names have no id fallback here.

    Run days are counted as bits of a seven-bit set, which leaves one distinct count and
    so no row expansion.
    """
    weekday_bit = F.expr("shiftleft(1, weekday(date))")
    per_athlete = (
        activities.where(in_weeks(F.col("date"), as_of, week, week))
        .groupBy("athlete_id")
        .agg(
            F.bit_count(F.bit_or(weekday_bit)).alias("run_days"),
            F.avg("cad_avg").alias("avg_cadence"),
            F.avg("hr_avg").alias("avg_hr"),
            F.sum("distance_km").alias("total_km"),
            F.countDistinct("activity_id").alias("run_count"),
            F.sum("duration_sec").alias("total_sec"),
        )
    )
    named = athletes.select("athlete_id", "firstname", "lastname")
    return (
        per_athlete.join(named, "athlete_id", "left")
        .withColumn("name", display_name(F.col("firstname"), F.col("lastname")))
        .withColumn("total_time", format_time(F.col("total_sec")))
        .withColumn("run_frequency", F.col("run_days") / 7)
        .drop("firstname", "lastname")
    )


def run_frequency(activities: DataFrame) -> DataFrame:
    """Distinct run days per athlete and week, as a share of seven."""
    weekday_bit = F.expr("shiftleft(1, weekday(date))")
    return (
        activities.groupBy("athlete_id", week_start(F.col("date")).alias("week_start_date"))
        .agg(F.bit_count(F.bit_or(weekday_bit)).alias("run_days"))
        .withColumn("run_frequency", F.col("run_days") / 7)
    )


def history(
    activities: DataFrame, grain: str, as_of: dt.date, athlete_id: int | None = None
) -> DataFrame:
    """Monthly totals of the last 12 months or weekly totals of the last 52 weeks.

    The lower bound excludes the day exactly 12 months or 52 weeks back.
    """
    date = F.col("date")
    if grain == "month":
        recent, period = date > F.add_months(day(as_of), -12), F.trunc(date, "MM")
    elif grain == "week":
        recent, period = date > day(as_of - dt.timedelta(weeks=52)), week_start(date)
    else:
        raise ValueError(f"grain must be 'month' or 'week', not {grain!r}")
    return (
        _of_athlete(activities, athlete_id)
        .where(recent)
        .groupBy("athlete_id", period.alias("period"))
        .agg(
            F.sum("distance_km").alias("distance_km"),
            F.sum("duration_sec").alias("duration_sec"),
            F.sum("elev_gain_m").alias("elev_gain_m"),
        )
        .withColumn("hours", round_half_even(F.col("duration_sec") / 3600, 2))
    )


def day_grid(
    calendar: DataFrame, activities: DataFrame, athletes: DataFrame, as_of: dt.date, weeks: int = 4
) -> DataFrame:
    """Every athlete and calendar day of the last ``weeks`` weeks, 0 km on days off."""
    first = monday(as_of) - dt.timedelta(weeks=weeks - 1)
    last = monday(as_of) + dt.timedelta(days=6)
    every_day = F.sequence(day(first), day(last), F.expr("interval 1 day"))
    grid = athletes.select("athlete_id", F.explode(every_day).alias("date"))
    days = calendar.where(F.col("date").between(day(first), day(last))).select(
        "date", "day_name", "day_of_week"
    )
    run = (
        activities.where(in_weeks(F.col("date"), as_of, 0, weeks - 1))
        .groupBy("athlete_id", "date")
        .agg(F.sum("distance_km").alias("ran"))
    )
    rel = week_rel(F.col("date"), as_of)
    return (
        grid.join(run, ["athlete_id", "date"], "left")
        .join(days, "date")
        .select(
            "athlete_id",
            rel.alias("week_rel"),
            week_label(rel).alias("week_label"),
            week_number_label(rel).alias("week_number"),
            "day_name",
            "day_of_week",
            "date",
            F.coalesce("ran", F.lit(0.0)).alias("km"),
        )
    )


def athlete_names(athletes: DataFrame) -> DataFrame:
    name = display_name(F.col("firstname"), F.col("lastname"), F.col("athlete_id"))
    return athletes.select("athlete_id", name.alias("name"))


def athlete_details(athletes: DataFrame, athlete_id: int | None = None) -> DataFrame:
    columns = ["athlete_id", "sex", "weight", "city", "country"]
    return _of_athlete(athletes, athlete_id).select(*columns)


def activity_card(activities: DataFrame, activity_id: int | None = None) -> DataFrame:
    """The overview figures of each activity, or of one."""
    if activity_id is not None:
        activities = activities.where(F.col("activity_id") == activity_id)
    return activities.select(
        "activity_id", "distance_km", format_time(F.col("duration_sec")).alias("total_time")
    )
