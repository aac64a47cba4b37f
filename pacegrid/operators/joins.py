"""Join helpers for hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of the rows is heavy, so at most 256 keys are.
HEAVY_SHARE = 1 / 256
#: Keys that the sketch counts at a time; counts are off by two rows in so many at most.
TRACKED = 8192
#: Keys that a join may send to every task: about 10 MB of numbers once they are hashed.
MOST_SENT = 100_000


def merged_if_many(side: DataFrame, keys: int) -> DataFrame:
    """The right side of a join, sorted and merged rather than broadcast if it has many keys.

    Spark plans by the size of compressed files. An id among others in order takes a byte or two
    there, and 50 to 110 in the hash table that the driver would make, so their number decides.
    """
    return side.hint("merge") if keys > MOST_SENT else side


def heavy_keys(df: DataFrame, on: str) -> DataFrame:
    """``on, _salts`` of the heavy keys: how many tasks' shares of rows each has.

    One sketch aggregate over the key column, merged from what the tasks count.
    """
    most = int(1 / HEAVY_SHARE)
    top = df.select(F.col(on).alias("_key")).agg(
        F.expr(f"approx_top_k(_key, {most}, {TRACKED})").alias("_top"), F.count("_key").alias("_n")
    )
    each = top.select(F.inline("_top").alias("_item", "_times"), "_n")
    share = F.col("_times") / (F.col("_n") * HEAVY_SHARE)
    heavy = each.where((share > 1) & F.col("_item").isNotNull())
    return heavy.select(F.col("_item").alias(on), F.ceil(share).cast("int").alias("_salts"))


def salted_join(
    big: DataFrame, small: DataFrame, on: str, how: str, spread_by: list[str], keys: int = 0
) -> DataFrame:
    """Join on ``on`` with the rows of heavy keys of ``big`` spread over tasks.

    ``small`` holds few rows per key. Rows of a heavy key get one of as many salts as the key
    has shares of the rows, and ``small`` is repeated for those keys alone: at most 512 times a
    row's number per key in all, and not at all without heavy keys. The salt of a row comes
    from columns that vary within a key, ``spread_by``, and from its partition, which sets
    exact copies apart; it is the same when a lost task runs again. Works for inner, left,
    left_semi and left_anti. ``keys``: how many ``small`` has, if known; see ``merged_if_many``.
    """
    # Bounded by the definition of heavy: 256 rows.
    heavy = F.broadcast(heavy_keys(big, on))
    salts = F.coalesce("_salts", F.lit(1))
    place = F.xxhash64(*spread_by) % 1024 + F.spark_partition_id()
    salted = big.join(heavy, on, "left").withColumn("_salt", F.pmod(place, salts).cast("int")).drop("_salts")
    repeated = small.join(heavy, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    repeated = merged_if_many(repeated.drop("_salts"), keys)
    return salted.join(repeated, [on, "_salt"], how).drop("_salt")
