"""The layered pipeline: raw files to silver, enrichment of new activities, the gold tables.

Each step is a load of the store below ``root``; ``run`` does all steps up to silver in one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacegrid import schema
from pacegrid.operators import calendar, forecast, quality, streams, trend
from pacegrid.operators.dedupe import dedupe_on
from pacegrid.operators.joins import salted_join
from pacegrid.sources import tables
from pacegrid.sources.clean import clean_profiles
from pacegrid.sources.files import conform
from pacegrid.sources.layers import load_layers
from pacegrid.sources.store import BUCKET, LOAD, Load, Store
from pacegrid.sources.tables import bucket_of
from pacegrid.streaming import ingest


#: Summaries as they wait for a stream, and activities whose points wait for a summary.
WAITING = schema.columns(
    "activity_id bigint, activity_type string, athlete_id bigint, athlete_name string, "
    "date date, start_time_utc timestamp, duration_sec int, distance_km double, "
    "elev_gain_m double, avg_pace_sec_km double, source string"
)
UNCLAIMED = schema.columns("activity_id bigint, load string, bucket int")


def silver(spark: SparkSession, root: str, table: str) -> DataFrame:
    return Store(spark, root).read(f"silver/{table}", schema.SILVER[table])


def refresh_athletes(profiles: DataFrame, root: str) -> None:
    """Load all athlete profiles anew; they may change at any time."""
    load = Store(profiles.sparkSession, root).load()
    load_layers(load, clean_profiles(profiles), "Athlete")
    load.commit()


def new_summaries(load: Load, summaries: DataFrame) -> DataFrame:
    """One row of each activity that silver does not have yet, written aside."""
    rows = conform(summaries, WAITING).where("activity_id IS NOT NULL")
    rows = load.staged(dedupe_on(rows, ["activity_id"]))
    if not load.holds("silver/Activities"):
        return rows
    # The keys of touched buckets alone are read.
    touched = [r.b for r in rows.select(bucket_of(["activity_id"], load.store.buckets).alias("b")).distinct().collect()]
    done = load.read("silver/Activities", schema.SILVER["Activities"], buckets=touched).select("activity_id")
    return load.staged(rows.join(done, "activity_id", "left_anti"))


def points_to_enrich(load: Load, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points of the candidates that came with loads since the last enrichment or wait from
    earlier ones, and what waits after this: activities with points but no summary.

    Earlier loads are read only where they hold points that waited for a candidate.
    """
    ids = candidates.select("activity_id").distinct()
    new = load.loads_of("silver/RunStream", load.state["marks"].get("enriched", 0))
    stream = schema.SILVER["RunStream"]
    points = load.read("silver/RunStream", stream, loads=new)
    places = load.read("silver/RunStream", stream, loads=new, marked=True)
    places = places.select("activity_id", F.col(LOAD).alias("load"), F.col(BUCKET).alias("bucket")).distinct()
    unclaimed = load.read("silver/Unclaimed", UNCLAIMED)
    claimed = unclaimed.join(ids, "activity_id", "left_semi").select("load", "bucket").distinct().collect()
    if claimed:
        earlier = load.read(
            "silver/RunStream",
            stream,
            loads=sorted({r.load for r in claimed}),
            buckets=sorted({r.bucket for r in claimed}),
        )
        points = points.unionByName(earlier)
    chosen = salted_join(points, ids, "activity_id", "left_semi", ["time_s"])
    return chosen, unclaimed.unionByName(places).join(ids, "activity_id", "left_anti")


def enrich(load: Load, summaries: DataFrame) -> None:
    """Metrics and splits of the activities that silver does not have yet, and of those it has
    whose stream has come since.

    A summary without a stream is loaded without metrics and waits; points without a summary
    wait too. So a run reads the points that came since the last one, and of earlier ones
    those that were waited for.
    """
    # Folders that a load has read stay as they are when it refreshes their table.
    waiting = load.read("silver/Waiting", WAITING)
    fresh = new_summaries(load, summaries)
    points, unclaimed = points_to_enrich(load, fresh.unionByName(waiting))
    points = load.staged(points)
    found = load.staged(points.select("activity_id").distinct())
    load_layers(load, streams.km_splits(points), "RunSplitKilometer")
    ready = fresh.unionByName(waiting.join(found, "activity_id", "left_semi"))
    load_layers(load, streams.enrich_activities(ready, streams.activity_metrics(points)), "Activities")
    left = fresh.unionByName(waiting).join(found, "activity_id", "left_anti")
    load.refresh("silver/Waiting", left, ["activity_id"])
    load.refresh("silver/Unclaimed", unclaimed, ["activity_id"])
    load.state["marks"]["enriched"] = load.state["loads"]


def enrich_new_activities(spark: SparkSession, root: str, summaries: DataFrame) -> None:
    """``enrich`` as a load of its own."""
    load = Store(spark, root).load()
    enrich(load, summaries)
    load.commit()


def run(spark: SparkSession, folder: str, root: str, summaries: DataFrame, profiles: DataFrame) -> None:
    """New raw files, summaries and profiles in one load: all six tables change together."""

    def then(load: Load) -> None:
        load_layers(load, clean_profiles(profiles), "Athlete")
        enrich(load, summaries)

    if not ingest.ingest_folder(spark, folder, root, then):
        load = Store(spark, root).load()
        then(load)
        load.commit()


def build_gold(spark: SparkSession, root: str, as_of: dt.date, races: DataFrame) -> DataFrame:
    """Rebuild the calendar, start points and labels; replace trend and forecast groups; all in
    one load.

    Gives ``test, n_failures, passed`` of the gold checks. Rows are checked in the passes that
    write them, keys over the written tables.
    """
    load = Store(spark, root).load()
    activities = silver(spark, root, "Activities")
    efforts = silver(spark, root, "RunBest")
    empty = {name: spark.createDataFrame([], shape) for name, shape in schema.GOLD.items()}
    checks = quality.gold_checks(*empty.values(), schema.METHODS)
    found: list[tuple[str, int]] = []

    def bring(name: str, df: DataFrame, groups: list[str] | None = None) -> None:
        table, shape = f"gold/{name}", schema.GOLD[name]

        def write(rows: DataFrame) -> DataFrame:
            if groups:
                load.replace(table, rows, groups)
            else:
                load.refresh(table, rows, shape.names[:1])
            return load.read(table, shape)

        found.extend(quality.checked(conform(df, shape), [c for c in checks if c.table == name], write))

    bring("dim_date", calendar.dim_date(activities, as_of))
    points = silver(spark, root, "RunStream")
    bring("activity_start_location", streams.first_gps_point(activities, points))
    bring("dim_distance_label", tables.seed_labels(spark))
    bring("PBPrediction", trend.pb_trend(efforts, as_of), ["athlete_id", "distance_label"])
    fits = load.read("gold/PBPrediction", schema.PB_PREDICTION).where(F.col("prediction_date") == F.lit(as_of))
    backtest = forecast.race_backtest(races, efforts, activities, trend=fits)
    bring("RaceForecast", backtest, ["athlete_id", "target_distance_label", "method"])
    load.commit()
    rows = [(test, n, n == 0) for test, n in found]
    return spark.createDataFrame(rows, "test string, n_failures bigint, passed boolean")
