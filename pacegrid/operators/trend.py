"""Linear trends of best efforts over time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacegrid.functions.calendar import date_ordinal, day
from pacegrid.operators.joins import salted_join

MIN_EFFORTS = 3
FLOOR_SEC = 1.0


def _dated(run_best: DataFrame) -> DataFrame:
    known = ["athlete_id", "name", "start_date", "elapsed_time"]
    return run_best.dropna(subset=known).select(
        "athlete_id",
        F.col("name").alias("distance_label"),
        F.col("start_date").cast("date").alias("date"),
        F.col("elapsed_time").cast("double").alias("sec"),
    )


def pb_trend(run_best: DataFrame, as_of: dt.date) -> DataFrame:
    """Least-squares line of time on date per athlete and distance, read off at ``as_of``.

    Groups below three efforts are left out. Efforts that all share one date have no
    slope; the least-norm line through them is used, with r² = 0. r² is also 0 where all
    times are equal. Predictions stop at one second. Dates count from ``as_of``, so the
    prediction is the intercept.
    """
    x = F.datediff(F.col("date"), day(as_of)).cast("double")
    # A group's sums are several times as wide as an effort: efforts of a group come together,
    # where it is not too large, and are summed before sums are sent.
    fits = (
        _dated(run_best)
        .hint("rebalance", "athlete_id", "distance_label")
        .groupBy("athlete_id", "distance_label")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.regr_intercept("sec", x).alias("line"),
            F.regr_r2("sec", x).alias("fit"),
            F.avg("sec").alias("mean_sec"),
            F.min("date").alias("first"),
            F.max("date").alias("last"),
            (F.min("sec") == F.max("sec")).alias("constant"),
        )
        .where(F.col("n") >= MIN_EFFORTS)
    )
    one_date = F.col("first") == F.col("last")
    least_norm = F.col("mean_sec") / 2 * (as_of.toordinal() / date_ordinal(F.col("first")) + 1)
    predicted = F.when(one_date, least_norm).when(F.col("constant"), F.col("mean_sec")).otherwise(
        F.col("line")
    )
    return fits.select(
        "athlete_id",
        "distance_label",
        F.greatest(predicted, F.lit(FLOOR_SEC)).alias("predicted_best_sec"),
        day(as_of).alias("prediction_date"),
        F.when(one_date | F.col("constant"), 0.0).otherwise(F.col("fit")).alias("r_squared"),
    )


def trend_at(run_best: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """``pb_trend`` per ``(athlete_id, as_of_date)``, from efforts before that day only.

    Efforts become one row of running sums per day; the checkpoints are merged into that
    timeline, so each sees the sums of all earlier days without a pairwise join. The
    window holds at most one row per calendar day and checkpoint day.
    """
    origin = dt.date(2000, 1, 1)
    x = F.datediff(F.col("date"), day(origin)).cast("double")
    y = F.col("sec")
    sums = {
        "n": F.count(F.lit(1)).cast("double"),
        "sx": F.sum(x),
        "sy": F.sum(y),
        "sxx": F.sum(x * x),
        "sxy": F.sum(x * y),
        "syy": F.sum(y * y),
        "lo": F.min(y),
        "hi": F.max(y),
        "first": F.min(x),
        "last": F.max(x),
    }
    key = ["athlete_id", "distance_label"]
    athletes = checkpoints.select("athlete_id").distinct()
    daily = (
        salted_join(_dated(run_best), athletes, "athlete_id", "left_semi", ["date", "sec"])
        .groupBy(*key, "date")
        .agg(*[total.alias(name) for name, total in sums.items()])
    )
    asked = (
        checkpoints.select("athlete_id", F.col("as_of_date").alias("date"))
        .distinct()
        .join(daily.select(*key).distinct(), "athlete_id")
        .withColumn("asked", F.lit(True))
    )
    earlier = (
        Window.partitionBy(*key)
        .orderBy(F.unix_date("date"))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    reduce = {"lo": F.min, "hi": F.max, "first": F.min, "last": F.max}
    seen = daily.unionByName(asked, allowMissingColumns=True).select(
        *key,
        "date",
        "asked",
        *[reduce.get(name, F.sum)(name).over(earlier).alias(name) for name in sums],
    )
    n, sx, sy, sxx, sxy, syy = (F.col(c) for c in ("n", "sx", "sy", "sxx", "sxy", "syy"))
    one_date, constant = F.col("first") == F.col("last"), F.col("lo") == F.col("hi")
    vx, vy, cxy = sxx - sx * sx / n, syy - sy * sy / n, sxy - sx * sy / n
    slope: Column = F.try_divide(cxy, vx)
    line = sy / n + slope * (x - sx / n)
    ordinal = F.col("first") + origin.toordinal()
    least_norm = sy / n / 2 * (date_ordinal(F.col("date")) / ordinal + 1)
    predicted = F.when(one_date, least_norm).when(constant, sy / n).otherwise(line)
    fit = F.try_divide(cxy * cxy, vx * vy)
    return seen.where(F.col("asked") & (n >= MIN_EFFORTS)).select(
        *key,
        F.col("date").alias("as_of_date"),
        F.greatest(predicted, F.lit(FLOOR_SEC)).alias("predicted_best_sec"),
        F.when(one_date | constant, 0.0).otherwise(fit).alias("r_squared"),
    )


def pb_projection(run_best: DataFrame, trend: DataFrame) -> DataFrame:
    """Last effort per athlete and distance, with the trend's end point if it means anything."""
    last = (
        _dated(run_best)
        .groupBy("athlete_id", "distance_label")
        .agg(
            F.count(F.lit(1)).alias("n_efforts"),
            F.max(F.struct("date", (-F.col("sec")).alias("neg_sec"))).alias("last"),
        )
        .select(
            "athlete_id",
            "distance_label",
            "n_efforts",
            F.col("last.date").alias("last_date"),
            (-F.col("last.neg_sec")).alias("last_sec"),
        )
    )
    meant = trend.where(F.col("predicted_best_sec") > FLOOR_SEC)
    return last.join(meant, ["athlete_id", "distance_label"], "left")


def pb_history(run_best: DataFrame, athlete_id: int | None = None) -> DataFrame:
    """All dated efforts of one athlete or of all."""
    if athlete_id is not None:
        run_best = run_best.where(F.col("athlete_id") == athlete_id)
    return _dated(run_best).select("athlete_id", "distance_label", "date", "sec")
