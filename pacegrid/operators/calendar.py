"""The calendar dimension and dimension filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.functions.calendar import day, week_label, week_rel, week_start


def dim_date(activities: DataFrame, as_of: dt.date, pad: int = 7) -> DataFrame:
    """Every day from ``pad`` days before the first activity to ``pad`` after the last.

    ``iso_year`` is the calendar year, also in the days where the ISO week belongs to
    the other year.
    """
    bounds = activities.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    days = bounds.where(F.col("first").isNotNull()).select(
        F.explode(
            F.sequence(F.date_sub("first", pad), F.date_add("last", pad), F.expr("interval 1 day"))
        ).alias("date")
    )
    date = F.col("date")
    return days.select(
        "date",
        F.year(date).alias("iso_year"),
        F.weekofyear(date).alias("iso_week"),
        F.date_format(date, "EEEE").alias("day_name"),
        (F.weekday(date) + 1).alias("day_of_week"),
        week_start(date).alias("week_start_date"),
        week_rel(date, as_of).alias("week_relative_to_today"),
        F.datediff(day(as_of), date).alias("days_ago"),
    )


def with_week(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Add ``week_start_date`` and ``week_rel``; the calendar join reduced to arithmetic."""
    return df.withColumn("week_start_date", week_start(F.col("date"))).withColumn(
        "week_rel", week_rel(F.col("date"), as_of)
    )


def week_list(calendar: DataFrame, as_of: dt.date) -> DataFrame:
    """The weeks of the calendar up to that of ``as_of``, with their display labels."""
    rel = week_rel(F.col("week_start_date"), as_of)
    weeks = calendar.select("week_start_date", rel.alias("week_rel")).distinct()
    label = F.concat(
        week_label(F.col("week_rel")),
        F.lit(" ("),
        F.col("week_start_date").cast("string"),
        F.lit(")"),
    )
    return weeks.where("week_rel >= 0").withColumn("week_label", label)


def filter_by_dimension(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key is among the selected dimension rows (or, with the sides
    exchanged, the dimension rows that still have facts)."""
    return fact.join(dimension.select(key).distinct(), key, "left_semi")


def filter_both_ways(
    tables: dict[str, DataFrame], links: list[tuple[str, str, str, bool]]
) -> dict[str, DataFrame]:
    """Tables with the rows that the selections on all of them leave.

    A link ``one, other, key, both`` filters ``other`` by ``one``, and with ``both``, as between
    tables that match row by row, also ``one`` by ``other``. The links must form a tree, each
    after the link that leads to its first table: then a turn forth and one back leave nothing
    more to filter, whatever the selections are.
    """
    linked = {links[0][0]} if links else set()
    for one, other, _, _ in links:
        if one not in linked or other in linked:
            raise ValueError(f"the link from {one} to {other} is not a branch of a tree")
        linked.add(other)
    left = dict(tables)
    for one, other, key, both in reversed(links):
        if both:
            left[one] = filter_by_dimension(left[one], left[other], key)
    for one, other, key, _ in links:
        left[other] = filter_by_dimension(left[other], left[one], key)
    return left
