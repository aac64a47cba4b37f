"""Loads into plain Parquet folders: append, insert-only, upsert, group replacement, refresh.

A single folder is what these loads change; ``store`` has loads that are all or nothing, of
several tables at a time, and the pipeline uses those. Append-style tables are plain Parquet folders. Tables whose rows get replaced are laid out
in hash buckets of their key, so that a load rewrites only the buckets it touches; Spark
stages a dynamic partition overwrite and moves it into place when the job commits. A repeated
load reaches the same end state; a crash inside that commit can lose rows of touched buckets.
The number of buckets is a partition column of the table, and a load with another is refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacegrid import schema as declared
from pacegrid.operators.dedupe import dedupe_on
from pacegrid.operators.joins import salted_join
from pacegrid.session import work_folder
from pacegrid.sources.files import conform, read_keys, read_parquet_if_any

BUCKETS = 64


def stamped(df: DataFrame) -> DataFrame:
    """Add the time of the load."""
    return df.withColumn("ingested_at", F.current_timestamp())


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """Declare a table over ``path`` unless it exists already."""
    database = name.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{path}'")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table's declared columns; an empty table if nothing was loaded yet.

    A table below a store's folder is read as the store has it.
    """
    from pacegrid.sources.store import Store

    parts = path.rstrip("/").split("/")
    for depth in (1, 2):
        store = Store.at(spark, "/".join(parts[:-depth])) if len(parts) > depth else None
        if store is not None:
            return store.read("/".join(parts[-depth:]), schema)
    found = read_parquet_if_any(spark, path)
    if found is None:
        return spark.createDataFrame([], schema)
    return found.select(*schema.names)


def staged(batch: DataFrame) -> DataFrame:
    """The batch as a written table, so that every pass of a load sees the same rows."""
    spark = batch.sparkSession
    path = work_folder(spark, "batch")
    batch.write.parquet(path)
    return spark.read.schema(batch.schema).parquet(path)


def seed_labels(spark: SparkSession) -> DataFrame:
    rows = [(label, metres, i) for i, (label, metres) in enumerate(declared.DISTANCE_LABELS, 1)]
    return spark.createDataFrame(rows, declared.DISTANCE_LABEL)


def append_table(batch: DataFrame, path: str) -> None:
    """Append; an empty batch adds no rows."""
    batch.write.mode("append").parquet(path)


def refresh_table(df: DataFrame, path: str) -> None:
    """Replace the whole table. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)


def new_rows(batch: DataFrame, existing_keys: DataFrame, key: str) -> DataFrame:
    """Batch rows whose key is not among the existing ones; duplicates inside stay.

    Rows without a key match nothing and stay too. The existing keys meet only the
    distinct keys of the batch. The new ones among them pick the rows, with the rows of
    each key spread over salts, as one key may hold a large share of the batch.
    """
    keyed = F.col(key).isNotNull()
    fresh = batch.where(keyed).select(key).distinct().join(existing_keys, key, "left_anti")
    others = [c for c, t in batch.dtypes if c != key and not t.startswith("map")]
    chosen = salted_join(batch, fresh, key, "left_semi", others or [key])
    return chosen.select(*batch.columns).unionByName(batch.where(~keyed))


def count_new(batch: DataFrame, existing_keys: DataFrame, key: str) -> DataFrame:
    """Number of distinct keys of the batch that are not loaded yet."""
    keys = batch.where(F.col(key).isNotNull()).select(key).distinct()
    fresh = keys.join(existing_keys, key, "left_anti")
    return fresh.agg(F.count(F.lit(1)).alias("n_new"))


def insert_only(batch: DataFrame, path: str, key: str) -> None:
    """Append rows of unknown keys: the first load of a key wins."""
    key_type = dict(batch.dtypes)[key]
    existing = read_keys(batch.sparkSession, path, key, key_type)
    append_table(new_rows(batch, existing, key), path)


def bucket_of(keys: list[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def check_layout(table: DataFrame, path: str, buckets: int) -> None:
    """Refuse a table that was not laid out in ``buckets`` buckets."""
    if "buckets" not in table.columns:
        raise ValueError(f"{path} is not laid out in buckets")
    found = table.select("buckets").first()
    if found is not None and found.buckets != buckets:
        raise ValueError(f"{path} is laid out in {found.buckets} buckets, not {buckets}")


def replace_groups(
    batch: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS
) -> None:
    """Delete all rows that share a key tuple with the batch, then insert the batch.

    Raises ValueError for a table laid out in another number of buckets, as rows of a key
    would then lie in two places.
    """
    table = read_parquet_if_any(batch.sparkSession, path)
    if table is not None:
        check_layout(table, path, buckets)
    batch = staged(batch)
    layout = {"buckets": F.lit(buckets), "bucket": bucket_of(keys, buckets)}
    incoming = batch.withColumns(layout)
    if table is None:
        after = incoming
    else:
        # At most ``buckets`` numbers; as literals they prune the scan to touched folders.
        touched = [row.bucket for row in incoming.select("bucket").distinct().collect()]
        kept = table.where(F.col("bucket").isin(touched)).join(
            batch.select(*keys).distinct(), keys, "left_anti"
        )
        after = kept.select(*incoming.columns).unionByName(incoming)
    (
        after.hint("rebalance", "bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*layout)
        .parquet(path)
    )


def upsert(batch: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Replace every row of the batch's keys: the last load of a key wins."""
    replace_groups(batch, path, [key], buckets)


# Load rule and key per table, in load order: Activities last, as it marks what is done.
LOAD_RULES = {
    "RunBest": ("insert_only", "activity_id"),
    "RunStream": ("insert_only", "activity_id"),
    "RunSegment": ("insert_only", "activity_id"),
    "RunSplitKilometer": ("insert_only", "activity_id"),
    "Athlete": ("upsert", "athlete_id"),
    "Activities": ("upsert", "activity_id"),
}


def bronze_schema(table: str) -> T.StructType:
    extra = declared.BRONZE_EXTRA.get(table, T.StructType([]))
    return T.StructType(declared.SILVER[table].fields + extra.fields)


def load_layers(batch: DataFrame, root: str, table: str) -> None:
    """Load a batch into bronze, as it is and first version only, and into silver.

    Silver has the declared columns, one row per primary key, and the table's load rule;
    rows without a key stay in bronze.
    """
    rule, key = LOAD_RULES[table]
    batch = staged(batch)
    insert_only(stamped(conform(batch, bronze_schema(table))), f"{root}/bronze/{table}", key)
    pk = declared.PRIMARY_KEY[table]
    placed = conform(batch, declared.SILVER[table]).dropna(subset=[*pk, key])
    silver = dedupe_on(placed, pk)
    load = insert_only if rule == "insert_only" else upsert
    load(silver, f"{root}/silver/{table}", key)
