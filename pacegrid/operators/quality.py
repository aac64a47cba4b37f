"""Data-quality checks. A check passes when it returns no rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    return unique_combo(df.where(F.col(column).isNotNull()), [column])


def unique_combo(df: DataFrame, columns: list[str]) -> DataFrame:
    """Column combinations that occur more than once."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return df.where(~F.col(column).isin(list(values)))


@dataclass(frozen=True)
class TableChecks:
    """The checks of one table that can be answered from counts per ``key``."""

    table: str
    df: DataFrame
    key: list[str]
    not_null: list[str] = field(default_factory=list)
    accepted: dict[str, list] = field(default_factory=dict)
    unique: bool = False
    unique_combo: bool = False

    def row_counts(self) -> list[Column]:
        """The checks that rows answer one by one, as aggregates for a pass over them."""
        counts = [F.count_if(F.col(c).isNull()) for c in self.not_null]
        return counts + [F.count_if(~F.col(c).isin(values)) for c, values in self.accepted.items()]

    def row_names(self) -> list[str]:
        return [f"not_null_{c}" for c in self.not_null] + [f"accepted_values_{c}" for c in self.accepted]

    def of_keys(self, df: DataFrame) -> TableChecks:
        """The checks that need rows together, over another table."""
        return replace(self, df=df, not_null=[], accepted={})

    def failures(self) -> DataFrame:
        """``test, n_failures`` from one grouping of the table by ``key``."""
        n = F.col("n")
        counts = self.df.groupBy(*self.key).agg(F.count(F.lit(1)).alias("n"))
        tests = {f"not_null_{c}": F.sum(F.when(F.col(c).isNull(), n)) for c in self.not_null}
        for column, values in self.accepted.items():
            bad = ~F.col(column).isin(values)
            tests[f"accepted_values_{column}"] = F.sum(F.when(bad, n))
        if self.unique:
            (column,) = self.key
            tests[f"unique_{column}"] = F.count_if((n > 1) & F.col(column).isNotNull())
        if self.unique_combo:
            tests["unique_key"] = F.count_if(n > 1)
        rows = F.array(
            *[
                F.struct(
                    F.lit(f"{self.table}.{name}").alias("test"),
                    F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias("n_failures"),
                )
                for name in tests
            ]
        )
        one_row = counts.agg(*[value.alias(name) for name, value in tests.items()])
        return one_row.select(F.inline(rows))


def quality_suite(checks: Iterable[TableChecks]) -> DataFrame:
    """All checks as ``test, n_failures, passed``."""
    parts = [check.failures() for check in checks]
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("n_failures") == 0)


def checked(
    df: DataFrame, checks: list[TableChecks], write: Callable[[DataFrame], DataFrame]
) -> list[tuple[str, int]]:
    """Write a table and check it: ``test, n_failures`` of its checks.

    Rows are counted in the pass that writes them; only keys are counted over the written
    table, which ``write`` gives back. Nothing is computed twice.
    """
    seen = Observation()
    columns = [F.count(F.lit(1)).alias("n_rows")]
    for place, check in enumerate(checks):
        columns += [c.alias(f"{place}.{n}") for c, n in zip(check.row_counts(), check.row_names())]
    after = write(df.observe(seen, *columns))
    found = []
    for place, check in enumerate(checks):
        found += [(f"{check.table}.{n}", int(seen.get[f"{place}.{n}"] or 0)) for n in check.row_names()]
        if check.unique or check.unique_combo:
            # A row for each test.
            found += [(r.test, r.n_failures) for r in check.of_keys(after).failures().collect()]
    return found


def gold_checks(
    dim_date: DataFrame,
    start_location: DataFrame,
    labels: DataFrame,
    pb_prediction: DataFrame,
    race_forecast: DataFrame,
    methods: list[str],
) -> list[TableChecks]:
    """The seventeen checks of the gold layer."""
    return [
        TableChecks("dim_date", dim_date, ["date"], ["date"], unique=True),
        TableChecks(
            "activity_start_location", start_location, ["activity_id"], ["activity_id"], unique=True
        ),
        TableChecks(
            "dim_distance_label", labels, ["distance_label"], ["distance_label"], unique=True
        ),
        TableChecks("dim_distance_label", labels, ["sort_order"], ["sort_order"], unique=True),
        TableChecks(
            "PBPrediction",
            pb_prediction,
            ["athlete_id", "distance_label", "prediction_date"],
            ["athlete_id", "distance_label", "prediction_date"],
            unique_combo=True,
        ),
        TableChecks(
            "RaceForecast",
            race_forecast,
            ["athlete_id", "target_distance_label", "method", "as_of_date"],
            ["athlete_id", "target_distance_label", "as_of_date"],
            accepted={"method": methods},
            unique_combo=True,
        ),
    ]
