"""Cleaning of raw effort and profile rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.functions.text import nested_id, repair_latin1, utc_timestamp

# Raw columns that cleaning leaves out.
BEST_DROP = ["resource_state", "start_date_local", "pr_rank", "achievements"]
SEGMENT_DROP = ["segment", "pr_rank", "achievements", "resource_state"]
PROFILE_DROP = [
    "badge_type_id", "bio", "created_at", "follower", "friend", "id", "premium", "profile",
    "profile_medium", "resource_state", "state", "summit", "updated_at", "username",
]


def _with_ids(df: DataFrame) -> DataFrame:
    """Replace the dict texts ``activity`` and ``athlete`` by their ids."""
    for entity in ("activity", "athlete"):
        if entity in df.columns:
            df = df.withColumn(f"{entity}_id", nested_id(F.col(entity))).drop(entity)
    return df


def _with_times(df: DataFrame, columns: list[str]) -> DataFrame:
    for column in columns:
        if dict(df.dtypes).get(column) == "string":
            df = df.withColumn(column, utc_timestamp(F.col(column)))
    return df


def clean_best(df: DataFrame) -> DataFrame:
    return _with_times(_with_ids(df.drop(*BEST_DROP)), ["start_date"])


def clean_segments(df: DataFrame) -> DataFrame:
    df = _with_times(_with_ids(df.drop(*SEGMENT_DROP)), ["start_date", "start_date_local"])
    return repair_text(df, "name") if "name" in df.columns else df


def clean_profiles(df: DataFrame) -> DataFrame:
    return df.drop(*PROFILE_DROP)


def repair_text(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, repair_latin1(F.col(column)))
