"""Joins of many rows a key, with and without heavy keys."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from pacegrid.operators import joins


def sides(spark):
    """A third of the rows have key 7, a hundredth each keys 8 and none."""
    n = F.col("n")
    key = F.when(n % 3 == 0, 7).when(n % 100 == 1, 8).when(n % 100 == 2, F.lit(None)).otherwise(n)
    big = spark.range(30_000).select(F.col("id").alias("n")).withColumn("k", key.cast("bigint"))
    small = spark.range(0, 30_000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    return big, small.unionByName(spark.createDataFrame([(7, 1), (7, 2)], "k bigint, v bigint"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(spark, how):
    big, small = sides(spark)
    found = joins.salted_join(big, small, "k", how, ["n"])
    expected = big.join(small, "k", how)
    assert sorted(found.columns) == sorted(expected.columns)
    found = found.select(expected.columns)
    assert found.count() == expected.count()
    assert found.exceptAll(expected).isEmpty()


def ran(df):
    """How a plan joins, and what kind of join it is, as it was when it had run."""
    done = df._jdf.queryExecution()
    done.toRdd().count()
    last = done.executedPlan().toString().partition("== Initial Plan ==")[0]
    found = (re.search(r"(\w+Join) .*(Inner|Left\w+)", line) for line in last.splitlines())
    return [m.groups() for m in found if m]


def test_many_keys_are_merged(spark):
    big, small = sides(spark)
    for keys, kind in ((joins.MOST_SENT, "BroadcastHashJoin"), (joins.MOST_SENT + 1, "SortMergeJoin")):
        found = joins.salted_join(big, small, "k", "left_semi", ["n"], keys)
        assert [how for how, of in ran(found) if of == "LeftSemi"] == [kind]
        assert found.exceptAll(big.join(small, "k", "left_semi").select(found.columns)).isEmpty()
        assert found.count() == big.join(small, "k", "left_semi").count()


def test_heavy_keys_are_spread_and_others_are_not_repeated(spark):
    big, _ = sides(spark)
    heavy = {r.k: r._salts for r in joins.heavy_keys(big, "k").collect()}
    assert set(heavy) == {7, 8} and 80 <= heavy[7] <= 90 and heavy[8] <= 3
    assert joins.heavy_keys(big.where("k > 8"), "k").count() == 0
    assert joins.heavy_keys(big.where("false"), "k").count() == 0
    # No task gets more than a few times the rows of the others.
    plan = big.repartition(6)
    salted = plan.join(joins.heavy_keys(big, "k"), "k", "left")
    salt = F.pmod(F.xxhash64("n") % 1024 + F.spark_partition_id(), F.coalesce("_salts", F.lit(1)))
    sizes = salted.select("k", salt.alias("s")).repartition(64, "k", "s").groupBy(F.spark_partition_id()).count()
    counts = sorted(r["count"] for r in sizes.collect())
    assert counts[-1] < 3 * counts[len(counts) // 2]
