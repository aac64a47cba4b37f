"""Race-time forecasts and their backtest."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacegrid import schema
from pacegrid.functions import race
from pacegrid.functions.text import format_time, round_half_even
from pacegrid.operators.joins import salted_join
from pacegrid.operators.rollups import add_names
from pacegrid.operators.trend import trend_at

# Weeks before a race at which it is forecast.
CHECKPOINT_WEEKS = (8, 4, 2, 1)
RECENT_DAYS = 90
# Accepted length of the whole activity, as a share of the effort's distance.
LENGTH_RANGE = (0.9, 1.2)
# A trend counts from this r² and above this many seconds.
BLEND_R2, BLEND_MIN_SEC = 0.5, 120


def length_of(label: Column, labels: Iterable[tuple[str, float]] = schema.DISTANCE_LABELS) -> Column:
    """Standard metres of a label as a literal lookup; NULL for an unknown label."""
    pairs = [F.lit(x) for pair in labels for x in pair]
    return F.element_at(F.create_map(*pairs), label)


def checkpoints(races: DataFrame, weeks: Iterable[int] = CHECKPOINT_WEEKS) -> DataFrame:
    """Races repeated once per forecast day before them."""
    days = F.array(*[F.date_sub("race_date", 7 * w) for w in weeks])
    return races.withColumn("as_of_date", F.explode(days))


def with_parent(efforts: DataFrame, activities: DataFrame) -> DataFrame:
    """Efforts with distance and climb per km of the activity they were part of."""
    km = F.col("distance_km")
    parent = activities.select(
        "activity_id",
        km.alias("activity_distance_km"),
        F.try_divide(F.col("elev_gain_m"), km).alias("elev_per_km"),
    )
    return efforts.join(parent, "activity_id", "left")


def source_effort(
    run_best: DataFrame,
    activities: DataFrame,
    points: DataFrame,
    priority: list[str] = schema.SOURCE_PRIORITY,
    window_days: int = RECENT_DAYS,
) -> DataFrame:
    """The effort each ``(athlete_id, as_of_date)`` of ``points`` is forecast from.

    Only efforts before the day count. The most preferred distance with any effort wins;
    within it recent efforts in an activity of fitting length come first, then older ones
    of fitting length, then recent ones, then any; then the fastest, then the lowest id.

    No effort meets a checkpoint in a join: efforts shrink to one best per day (fitting
    and any), checkpoints are merged into each athlete's timeline, and two frames over it
    look back over all days and over the recent ones. The window therefore holds at most
    one row per calendar day and checkpoint day, however many efforts an athlete has.
    """
    known = ["athlete_id", "start_date", "elapsed_time"]
    wanted = run_best.dropna(subset=known).where(F.col("name").isin(priority))
    asked_athletes = points.select("athlete_id").distinct()
    fastest = F.min(F.struct(F.col("elapsed_time").cast("double").alias("sec"), "id"))
    # One row per activity, label and day before the join, so that a busy activity is not hot.
    per_activity = (
        salted_join(wanted, asked_athletes, "athlete_id", "left_semi", ["activity_id", "id"])
        .groupBy(
            "athlete_id", "name", "activity_id", F.col("start_date").cast("date").alias("date")
        )
        .agg(fastest.alias("best"))
    )
    std_m, parent_m = length_of(F.col("name")), F.col("activity_distance_km") * 1000
    fits = std_m.isNull() | F.coalesce(
        parent_m.between(LENGTH_RANGE[0] * std_m, LENGTH_RANGE[1] * std_m), F.lit(False)
    )
    effort = F.struct("best.sec", "best.id", "elev_per_km")
    daily = (
        with_parent(per_activity, activities)
        .groupBy("athlete_id", "name", "date")
        .agg(F.min(F.when(fits, effort)).alias("fit"), F.min(effort).alias("any"))
    )
    asked = points.select(
        "athlete_id",
        F.col("as_of_date").alias("date"),
        F.explode(F.array(*[F.lit(p) for p in priority])).alias("name"),
        F.lit(True).alias("asked"),
    ).distinct()
    timeline = Window.partitionBy("athlete_id", "name").orderBy(F.unix_date("date"))
    ever = timeline.rangeBetween(Window.unboundedPreceding, -1)
    recent = timeline.rangeBetween(-window_days, -1)
    tiers = [("fit", recent), ("fit", ever), ("any", recent), ("any", ever)]
    merged = daily.unionByName(asked, allowMissingColumns=True).select(
        "athlete_id",
        "name",
        "date",
        "asked",
        *[F.min(pool).over(frame).alias(f"tier{i}") for i, (pool, frame) in enumerate(tiers, 1)],
    )
    tier_cols = [f"tier{i}" for i in range(1, 5)]
    tier = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(int(c[-1]))) for c in tier_cols])
    rank = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("name"))
    chosen = F.min(
        F.when(
            tier.isNotNull(),
            F.struct(
                rank.alias("rank"), "name", tier.alias("tier"), F.coalesce(*tier_cols).alias("e")
            ),
        )
    )
    return (
        merged.where("asked")
        .groupBy("athlete_id", F.col("date").alias("as_of_date"))
        .agg(chosen.alias("c"))
        .where(F.col("c").isNotNull())
        .select(
            "athlete_id",
            "as_of_date",
            F.col("c.name").alias("source_distance_label"),
            F.col("c.tier").alias("source_tier"),
            F.col("c.e.id").alias("source_id"),
            F.col("c.e.sec").alias("source_pb_sec"),
            F.col("c.e.elev_per_km").alias("source_elev_per_km"),
        )
    )


def forecast(
    pairs: DataFrame,
    methods: Iterable[str] = tuple(schema.METHODS),
    exponent: float = race.RIEGEL_EXPONENT,
) -> DataFrame:
    """One row per pair and method with ``predicted_sec``.

    Pairs carry ``source_sec, source_m, source_elev, target_m, target_elev``. A missing
    climb counts as flat. ``exponent`` applies to the plain Riegel method only. The VDOT
    method has no prediction (NULL) where the finish time is out of its range.
    """
    methods = list(methods)
    sec, from_m, to_m = F.col("source_sec"), F.col("source_m"), F.col("target_m")
    climbs = [F.coalesce(F.col(c), F.lit(0.0)) for c in ("source_elev", "target_elev")]
    predicted = {
        "riegel": race.riegel(sec, from_m, to_m, exponent),
        "vdot": F.col("_vdot_sec"),
        "elevation_adjusted": race.climb_adjusted(sec, from_m, climbs[0], to_m, climbs[1]),
    }
    keep = pairs.columns
    if "vdot" in methods:
        pairs = race.with_vdot(pairs, "source_m", "source_sec", "_vdot")
        pairs = race.with_vdot_time(pairs, "_vdot", "target_m", "_vdot_sec")
    rows = F.array(
        *[F.struct(F.lit(m).alias("method"), predicted[m].alias("predicted_sec")) for m in methods]
    )
    return pairs.select(*keep, F.inline(rows))


def race_backtest(
    races: DataFrame,
    run_best: DataFrame,
    activities: DataFrame,
    trend: DataFrame | None = None,
    leak_free: bool = False,
    weeks: Iterable[int] = CHECKPOINT_WEEKS,
) -> DataFrame:
    """Forecast known races from earlier efforts and compare with the actual times.

    With ``trend`` (all history, so it knows more than the checkpoint did) or with
    ``leak_free`` (fitted per checkpoint), each method is averaged with Riegel from the
    trend's source time, provided that the trend is good enough.
    """
    points = checkpoints(races, weeks)
    source = source_effort(run_best, activities, points.select("athlete_id", "as_of_date"))
    climb = F.try_divide(F.col("elev_gain_m"), F.col("distance_km"))
    pairs = points.join(source, ["athlete_id", "as_of_date"]).select(
        "athlete_id",
        F.col("activity_id").alias("race_activity_id"),
        "target_distance_label",
        "as_of_date",
        "source_distance_label",
        "source_pb_sec",
        F.col("actual_sec").cast("double").alias("actual_sec"),
        F.col("source_pb_sec").alias("source_sec"),
        length_of(F.col("source_distance_label")).alias("source_m"),
        F.col("source_elev_per_km").alias("source_elev"),
        length_of(F.col("target_distance_label")).alias("target_m"),
        climb.alias("target_elev"),
    )
    on = ["athlete_id", "source_distance_label"]
    if leak_free:
        trend = trend_at(run_best, points)
        on = [*on, "as_of_date"]
    if trend is None:
        pairs = pairs.withColumn("trend_sec", F.lit(None).cast("double"))
    else:
        good = (F.col("r_squared") >= BLEND_R2) & (F.col("predicted_best_sec") > BLEND_MIN_SEC)
        usable = trend.where(good).withColumnRenamed("distance_label", "source_distance_label")
        usable = usable.select(*on, F.col("predicted_best_sec").alias("trend_sec"))
        pairs = pairs.join(usable, on, "left")
    predicted = F.col("predicted_sec")
    from_trend = race.riegel(F.col("trend_sec"), F.col("source_m"), F.col("target_m"))
    error = F.col("predicted_sec") - F.col("actual_sec")
    return (
        forecast(pairs)
        .withColumn(
            "predicted_sec",
            F.when(F.col("trend_sec").isNull(), predicted).otherwise((predicted + from_trend) / 2),
        )
        .withColumn("error_sec", error)
        .withColumn("error_pct", F.try_divide(error, F.col("actual_sec")) * 100)
        .select(*schema.RACE_FORECAST.names)
    )


def final_forecast(rf: DataFrame) -> DataFrame:
    """The forecast closest to the race per athlete, target and method."""
    rest = [c for c in rf.columns if c not in ("athlete_id", "target_distance_label", "method")]
    first = ["as_of_date", "race_activity_id"]
    row = F.struct(*first, *[c for c in rest if c not in first])
    return (
        rf.groupBy("athlete_id", "target_distance_label", "method")
        .agg(F.max(row).alias("last"))
        .select("athlete_id", "target_distance_label", "method", *[f"last.{c}" for c in rest])
    )


def forecast_pivot(rf: DataFrame, athletes: DataFrame) -> DataFrame:
    """Signed error in % per athlete (rows) and method (columns), with the actual time."""
    wide = (
        final_forecast(rf)
        .groupBy("athlete_id", "target_distance_label")
        .pivot("method", schema.METHODS)
        .agg(
            round_half_even(F.first("error_pct"), 1).alias("error"),
            F.first("actual_sec").alias("actual"),
        )
    )
    actual = F.coalesce(*[F.col(f"{m}_actual") for m in schema.METHODS])
    return add_names(
        wide.select(
            "athlete_id",
            "target_distance_label",
            format_time(actual).alias("actual_time"),
            *[F.col(f"{m}_error").alias(m) for m in schema.METHODS],
        ),
        athletes,
    )


def method_error(rf: DataFrame) -> DataFrame:
    """Mean absolute error in % per method over the final forecasts."""
    return (
        final_forecast(rf)
        .groupBy("target_distance_label", "method")
        .agg(F.avg(F.abs("error_pct")).alias("mape"), F.count(F.lit(1)).alias("n_forecasts"))
    )


def forecast_named(rf: DataFrame, athletes: DataFrame) -> DataFrame:
    """Forecast rows with names and minutes, for tracing a forecast back over time."""
    return add_names(rf, athletes).withColumn("predicted_min", F.col("predicted_sec") / 60)


def sensitivity_grid(
    pbs: DataFrame,
    target_label: str = "Half-Marathon",
    n: int = 50,
    lo: float = 0.7,
    hi: float = 1.3,
    elev: float = 5.0,
    exponent: float = race.RIEGEL_EXPONENT,
) -> DataFrame:
    """Predictions for ``n`` source times spread evenly around each best.

    ``pbs`` carries ``source_m`` and ``source_sec``. The source counts as flat. Points
    without a VDOT prediction are left out.
    """
    share = lo + F.col("point") * ((hi - lo) / (n - 1))
    sweep = (
        pbs.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        .withColumn("source_sec", F.col("source_sec") * share)
        .withColumn("source_elev", F.lit(0.0))
        .withColumn("target", F.lit(target_label))
        .withColumn("target_m", F.lit(dict(schema.DISTANCE_LABELS)[target_label]))
        .withColumn("target_elev", F.lit(float(elev)))
    )
    return (
        forecast(sweep, exponent=exponent)
        .where(F.col("predicted_sec").isNotNull())
        .drop("source_elev", "target_m", "target_elev")
    )


def what_if(pbs: DataFrame, scenarios: list[dict]) -> DataFrame:
    """Predictions of each best under each scenario.

    A scenario is a dict of ``delta_sec``, ``target``, ``elev`` (m/km) and ``exponent``;
    the list is a set of parameters and becomes literals of the plan.
    """
    metres = dict(schema.DISTANCE_LABELS)
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("scenario"),
                F.lit(float(s["delta_sec"])).alias("delta_sec"),
                F.lit(s["target"]).alias("target"),
                F.lit(metres[s["target"]]).alias("target_m"),
                F.lit(float(s["elev"])).alias("target_elev"),
                F.lit(float(s["exponent"])).alias("exponent"),
            )
            for i, s in enumerate(scenarios)
        ]
    )
    pairs = (
        pbs.select("*", F.inline(rows))
        .withColumn("source_sec", F.col("source_sec") + F.col("delta_sec"))
        .withColumn("source_elev", F.lit(0.0))
    )
    km = F.col("target_m") / 1000
    return (
        forecast(pairs, exponent=F.col("exponent"))
        .withColumn("pace_sec_per_km", F.col("predicted_sec") / km)
        .withColumn("predicted_time", format_time(F.col("predicted_sec")))
        .withColumn("pace", F.concat(format_time(F.col("pace_sec_per_km")), F.lit("/km")))
        .drop("source_elev", "target_m")
    )
