"""Incremental ingest of a folder of raw CSV files.

The stream's checkpoint remembers which files were read, so each run takes new files only.
A batch of raw files is one load of a store, which records the batch with the tables it
changes; if a run breaks before, nothing has changed and the batch is repeated; if it breaks
after, the repeated batch does nothing. ``ingest_table`` writes a plain folder instead: its
repeated batches leave out keys that are already there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pacegrid.schema import columns
from pacegrid.sources.clean import clean_best, clean_segments
from pacegrid.sources.files import (
    activity_id_of_file,
    as_pattern,
    conform_and_reject,
    file_kind,
    raw_lines,
    read_records,
)
from pacegrid.sources.layers import load_layers
from pacegrid.sources.store import Load, Store, read_text, replace_text
from pacegrid.sources.tables import insert_only

RAW_STREAM = columns(
    "time_s double, lat double, lon double, dist_m double, alt_m double, hr_bpm double, "
    "cadence double, watts double"
)
RAW_BEST = columns(
    "id bigint, resource_state int, name string, activity string, athlete string, "
    "elapsed_time int, moving_time int, start_date string, start_date_local string, "
    "distance int, pr_rank double, achievements string, start_index int, end_index int"
)
RAW_SEGMENT = columns(
    "id bigint, resource_state int, name string, activity string, athlete string, "
    "elapsed_time int, moving_time int, start_date string, start_date_local string, "
    "distance double, start_index int, end_index int, average_cadence double, "
    "device_watts boolean, average_watts double, average_heartrate double, "
    "max_heartrate double, segment string, pr_rank double, achievements string, "
    "visibility string, kom_rank double, hidden boolean"
)
# Names of consolidated exports, which are not raw files.
OWN_OUTPUTS = ["best_profiles.csv", "segments.csv", "runstream.csv"]


PATHS = "path string, modificationTime timestamp, length bigint, content binary"


def raw_files(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of the paths of raw files, which may be gzipped; sub-folders and other types
    are skipped.

    A run takes all new files as one batch: a load compares with what earlier runs have
    loaded, so files of one activity that arrive together stay together. The files' contents
    are not read here.
    """
    files = spark.readStream.format("binaryFile").schema(PATHS).option("pathGlobFilter", "*.{csv,csv.gz}").load(folder)
    named = files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))
    return named.where(~F.regexp_replace("file_name", r"\.gz$", "").isin(OWN_OUTPUTS))


def raw_texts(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The declared columns that the files have, as text, and ``file_name``; each file is read
    under its own header."""
    return read_records(spark, raw_lines(spark.read, [as_pattern(p) for p in paths]), schema, escape='"')


def stream_points(rows: DataFrame) -> DataFrame:
    return rows.withColumn("activity_id", activity_id_of_file(F.col("file_name")))


def ingest_stream(
    rows: DataFrame, write: Callable[[DataFrame], None], checkpoint: str
) -> StreamingQuery:
    """Process all rows that are available and new, then stop."""

    def each_batch(batch: DataFrame, _: int) -> None:
        write(batch)

    return (
        rows.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


RAW = {
    "best": (RAW_BEST, "RunBest", clean_best),
    "segments": (RAW_SEGMENT, "RunSegment", clean_segments),
    "stream": (RAW_STREAM, "RunStream", stream_points),
}


def load_files(load: Load, files: DataFrame) -> None:
    """Bring raw files, ``path, file_name``, into the bronze and silver tables of a load.

    Texts that a declared type cannot take become NULL there; they are kept by file and column
    in ``bronze/Rejected``. The pass that brings the files in counts them.
    """
    # The driver knows the paths already, as it has listed the folder.
    paths: dict[str, list[str]] = {kind: [] for kind in RAW}
    for row in files.select("path", file_kind(F.col("file_name")).alias("kind")).collect():
        paths[row.kind].append(row.path)
    for kind, (schema, table, tidy) in RAW.items():
        if not paths[kind]:
            continue
        whole = T.StructType([*schema.fields, T.StructField("file_name", T.StringType())])
        rows, seen = conform_and_reject(raw_texts(load.spark, paths[kind], schema), whole), Observation()
        rows = load.staged(tidy(rows).observe(seen, F.sum(F.array_size("rejected")).alias("n")))
        if seen.get["n"]:
            load.append("bronze/Rejected", rows.select("file_name", F.inline("rejected")), ["file_name"])
        load_layers(load, rows, table, written=True)


def ingest_id(spark: SparkSession, checkpoint: str) -> str:
    """A name for the stream of a checkpoint: its batches are counted anew with a new one."""
    path = f"{checkpoint}/ingest-id"
    found = read_text(spark, path)
    if found is None:
        found = uuid.uuid4().hex
        replace_text(spark, path, found)
    return found


def ingest_folder(
    spark: SparkSession, folder: str, root: str, then: Callable[[Load], None] | None = None
) -> bool:
    """Load all new raw files of a folder into the store below ``root``; tells if there were any.

    Each batch is one load: its tables, and what ``then`` does in it, change together, and a
    batch that is repeated after a failure leaves what one clean run would have left.
    """
    store, checkpoint = Store(spark, root), f"{root}/checkpoints/raw"
    stream = ingest_id(spark, checkpoint)
    ran = []

    def work(load: Load, files: DataFrame) -> None:
        load_files(load, files)
        if then is not None:
            then(load)

    def each_batch(files: DataFrame, batch: int) -> None:
        ran.append(store.once(stream, batch, lambda load: work(load, files)))

    query = (
        raw_files(spark, folder)
        .writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return any(ran)


def ingest_table(
    spark: SparkSession, folder: str, schema: T.StructType, path: str, key: str, checkpoint: str
) -> StreamingQuery:
    """Insert-only ingest of CSV files with one schema into one table; a file with another
    header is an error."""
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    rows = reader.csv(folder)
    return ingest_stream(rows, lambda batch: insert_only(batch, path, key), checkpoint)
