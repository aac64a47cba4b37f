"""Duplicate removal and before/after counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_on(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order``, further ties by the other columns.

    An aggregate rather than a ranked window: copies collapse before the shuffle, so a
    key that holds a third of all rows sends one row per input partition.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    first = list(dict.fromkeys([*(order or []), *others]))
    first = [c for c in first if c in others]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*first)).alias("kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"kept.{c}") for c in df.columns])


def dedupe_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows before, rows after and rows dropped by ``dedupe_on``, in one pass."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_dropped"),
    )
