"""The domain tables as views over the test tables (see FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacegrid import schema
from pacegrid.operators.dedupe import dedupe_on
from pacegrid.session import apply_settings

AS_OF = dt.date(2001, 7, 25)
RACE_KM = (19.0, 23.0)
RACE_DAYS = (dt.date(2001, 1, 1), dt.date(2001, 6, 30))
RACE_DATE = dt.date(2001, 6, 24)
# A day in a week in which activities with streams took place.
MAP_DAY = dt.date(2000, 7, 19)


# An odd divisor: no distance then falls half-way between two rounded values.
KM_PRICE = 11987


class Tables:
    """Domain tables read from one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.opened: dict[str, DataFrame] = {}
        apply_settings(spark)

    def read(self, name: str) -> DataFrame:
        """A table of the folder; its footer is read once, not once per use."""
        if name not in self.opened:
            self.opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.opened[name]

    def athletes(self) -> DataFrame:
        nation = self.read("nation").select("n_nationkey", F.col("n_name").alias("country"))
        key = F.col("c_custkey")
        named = key % 10 != 0
        return (
            self.read("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                key.alias("athlete_id"),
                F.col("c_mktsegment").alias("city"),
                "country",
                F.when(named, F.col("c_name")).alias("firstname"),
                F.when(named, F.col("c_mktsegment")).alias("lastname"),
                F.when(key % 2 == 0, "F").otherwise("M").alias("sex"),
                (key % 40 + 50).cast("int").alias("weight"),
            )
        )

    def activities(self) -> DataFrame:
        key, athlete = F.col("o_orderkey"), F.col("o_custkey")
        km = F.col("o_totalprice") / KM_PRICE
        return self.read("orders").select(
            key.alias("activity_id"),
            F.when(key % 7 == 0, "Ride").otherwise("Run").alias("activity_type"),
            athlete.alias("athlete_id"),
            F.concat(F.lit("Athlete "), athlete.cast("string")).alias("athlete_name"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_orderdate").cast("timestamp").alias("start_time_utc"),
            F.floor(km * (key % 180 + 240)).cast("int").alias("duration_sec"),
            km.alias("distance_km"),
            ((athlete % 37).cast("double") * 10).alias("elev_gain_m"),
            F.when(key % 11 != 0, (key % 60 + 120).cast("double")).alias("hr_avg"),
            (key % 25 + 70).cast("double").alias("cad_avg"),
        )

    def raw_stream(self) -> DataFrame:
        """GPS points, not yet unique on activity and second."""
        kind, event = F.col("event_type"), F.col("event_id")
        k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
        time_s = F.expr("timestampdiff(SECOND, TIMESTAMP '2024-01-01 00:00:00', ts)").cast("int")
        known = kind != "error"
        return self.read("events").select(
            F.col("user_id").alias("activity_id"),
            time_s.alias("time_s"),
            event.alias("event_id"),
            F.when(known, F.lit(10.7) + (event % 97) * F.lit(0.00001)).alias("lat"),
            F.when(known, F.lit(106.6) + (event % 89) * F.lit(0.00001)).alias("lon"),
            F.when(kind != "click", time_s * F.lit(2.5)).alias("dist_m"),
            F.when(kind != "signup", F.col("value")).alias("alt_m"),
            F.when(kind != "view", k + 60).cast("smallint").alias("hr_bpm"),
            F.when(kind != "purchase", k % 30 + 70).cast("smallint").alias("cadence"),
            F.when(kind == "click", k * 3).alias("watts"),
        )

    def stream(self) -> DataFrame:
        """GPS points, one per activity and second."""
        points = dedupe_on(self.raw_stream(), schema.PRIMARY_KEY["RunStream"], ["event_id"])
        return points.drop("event_id")

    def run_best(self) -> DataFrame:
        line = F.col("l_linenumber")
        label = F.element_at(F.array(*[F.lit(p) for p in schema.SOURCE_PRIORITY]), line)
        metres = dict(schema.DISTANCE_LABELS)
        length = F.element_at(F.array(*[F.lit(metres[p]) for p in schema.SOURCE_PRIORITY]), line)
        elapsed = F.floor(length / 1000 * (F.col("l_quantity") * 4 + 240)).cast("int")
        orders = self.read("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("athlete_id")
        )
        return (
            self.read("lineitem")
            .join(orders, "l_orderkey")
            .select(
                (F.col("l_orderkey") * 10 + line).alias("id"),
                label.alias("name"),
                elapsed.alias("elapsed_time"),
                elapsed.alias("moving_time"),
                F.col("l_shipdate").cast("timestamp").alias("start_date"),
                F.floor(length).cast("int").alias("distance"),
                F.col("l_orderkey").alias("activity_id"),
                "athlete_id",
            )
        )

    def races(self) -> DataFrame:
        first, last = (F.lit(d) for d in RACE_DAYS)
        return (
            self.activities()
            .where(F.col("distance_km").between(*RACE_KM) & F.col("date").between(first, last))
            .select(
                "athlete_id",
                "activity_id",
                F.lit("Half-Marathon").alias("target_distance_label"),
                F.col("date").alias("race_date"),
                F.col("duration_sec").alias("actual_sec"),
                "elev_gain_m",
                "distance_km",
            )
        )


def dict_text(key: Column, tail: str = "") -> Column:
    """A dict literal as text with the key as its id, as raw effort files carry it."""
    return F.concat(
        F.lit("{'resource_state': 1, 'map': {'id': 5, 'kind': None}, 'id': "),
        key.cast("string"),
        F.lit(tail + "}"),
    )
