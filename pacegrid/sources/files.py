"""Readers and writers of flat files."""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE_NUMBERS = (T.LongType, T.IntegerType, T.ShortType)


def parse_text(text: Column, to: T.DataType) -> Column:
    """Text to a declared type; NULL for anything that does not parse.

    Whole numbers may be written with a fraction (``72.0``), as they are in a column that
    also has gaps.
    """
    if isinstance(to, T.StringType):
        return text
    if isinstance(to, _WHOLE_NUMBERS):
        exact = text.try_cast(to)
        return F.coalesce(exact, text.try_cast("decimal(38,6)").try_cast(to))
    if isinstance(to, T.DoubleType):
        number = text.try_cast(to)
        return F.when(~F.isnan(number), number)
    return text.try_cast(to)


def _conformed(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The columns of ``conform``."""
    present = dict(df.dtypes)
    columns = []
    for field in schema.fields:
        if field.name not in present:
            value = F.lit(None).cast(field.dataType)
        elif present[field.name] == "string":
            value = parse_text(F.col(field.name), field.dataType)
        else:
            # A value out of range is NULL; it must not stop the load.
            value = F.col(field.name).try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return columns


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order: missing ones NULL, unknown ones left out."""
    return df.select(*_conformed(df, schema))


def conform_and_reject(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``conform`` and ``rejected``: an array of ``column_name, value`` of the texts that their
    declared type cannot take and that became NULL, NULL if there is none. Blank texts are gaps."""
    present = dict(df.dtypes)
    texts = [
        f.name for f in schema.fields
        if present.get(f.name) == "string" and not isinstance(f.dataType, T.StringType)
    ]
    if not texts:
        nothing = F.lit(None).cast("array<struct<column_name: string, value: string>>")
        return conform(df, schema).withColumn("rejected", nothing)
    # Side by side, so that each text is parsed once.
    both = df.select(*_conformed(df, schema), *(F.col(n).alias(f"raw_{i}") for i, n in enumerate(texts)))
    each, bad = [], F.lit(False)
    for i, name in enumerate(texts):
        text = F.col(f"raw_{i}")
        lost = F.col(name).isNull() & text.isNotNull() & ~F.trim(text).isin("", "nan", "NaN")
        each.append(F.when(lost, F.struct(F.lit(name).alias("column_name"), text.alias("value"))))
        bad = bad | lost
    rejected = F.when(bad, F.array_compact(F.array(*each)))
    return both.select(*schema.names, rejected.alias("rejected"))


#: Different headers that one read may meet.
MAX_LAYOUTS = 1000
# A separator that no raw file holds: a line is read as one value, with its encoding.
_NO_SEPARATOR = "\u0001"


def raw_lines(reader, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """``line, path, start, file_name`` of every line; ``reader`` is ``spark.read`` or
    ``spark.readStream`` with its options."""
    lines = reader.schema("line string").option("sep", _NO_SEPARATOR).option("quote", "")
    return lines.option("encoding", encoding).csv(path).select(
        "line",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_name").alias("file_name"),
    )


def as_pattern(path: str) -> str:
    """A path whose characters mean themselves where patterns are read."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def headers_of(lines: DataFrame) -> DataFrame:
    """``path, header`` of every file with a line: its first one."""
    first = lines.where("start = 0").select("path", "line", F.monotonically_increasing_id().alias("at"))
    headers = first.groupBy("path").agg(F.min_by("line", "at").alias("header"))
    return headers.withColumn("header", F.regexp_replace("header", "^\ufeff", ""))


def read_records(
    spark: SparkSession, lines: DataFrame, schema: T.StructType, encoding: str = "UTF-8", escape: str = "\\"
) -> DataFrame:
    """Records of files with different headers: the columns of ``schema`` that a file's header
    names, as text and matched by name, and ``file_name``.

    Files are grouped by header, and those of one header are read as records, so that quoted
    values may hold line breaks. A record equal to its header is left out. Files whose header
    names no column of ``schema`` are left out too, so the driver sees layouts of declared
    columns, and refuses more than ``MAX_LAYOUTS``; and the paths of the files, as Spark's own
    listing does.
    """
    names = F.split(F.regexp_replace("header", '"', ""), ",")
    known = headers_of(lines).where(F.arrays_overlap(names, F.lit(schema.names)))
    # One pass over the lines. Without more headers than allowed, the driver gets the paths.
    layouts = known.groupBy("header").agg(F.collect_list("path").alias("paths")).limit(MAX_LAYOUTS + 1).collect()
    if len(layouts) > MAX_LAYOUTS:
        raise ValueError(f"more than {MAX_LAYOUTS} different headers")
    declared = [n for n in schema.names if n != "file_name"]
    if not layouts:
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in [*declared, "file_name"]]))
    paths: dict[str, list[str]] = {row.header: row.paths for row in layouts}
    frames = []
    for header in sorted(paths):
        names = next(csv.reader([header]))
        at = {n: i for i, n in reversed(list(enumerate(names))) if n in declared}
        shape = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        reader = spark.read.schema(shape).option("header", True).option("multiLine", True).option("encoding", encoding)
        # A path of a file listing is a URL; its blanks and signs are written out in it.
        rows = reader.option("escape", escape).csv([as_pattern(unquote(p)) for p in sorted(paths[header])])
        same = F.lit(True)
        for i, n in enumerate(names):
            same = same & F.col(f"c{i}").eqNullSafe(F.lit(n or None))
        rows = rows.withColumn("file_name", F.col("_metadata.file_name")).where(~same)
        frames.append(rows.select(*(F.col(f"c{i}").alias(n) for n, i in at.items()), "file_name"))
    return union_by_name(frames)


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8"
) -> DataFrame:
    """Full scan of CSV files with headers, columns matched by name to the declared schema
    file by file."""
    return conform(read_records(spark, raw_lines(spark.read, path, encoding), schema, encoding), schema)


def read_parquet_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, None if nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_keys(spark: SparkSession, path: str, column: str, dtype: str = "bigint") -> DataFrame:
    """Distinct non-null keys of a Parquet table; none if the table does not exist yet."""
    table = read_parquet_if_any(spark, path)
    if table is None:
        return spark.createDataFrame([], f"{column} {dtype}")
    return table.select(column).where(F.col(column).isNotNull()).distinct()


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows; columns a frame lacks are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_keys(first: DataFrame, second: DataFrame) -> DataFrame:
    """The keys of either side, each once."""
    return first.union(second).distinct()


def land(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rows as Parquet or as CSV with a header."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"format must be 'parquet' or 'csv', not {fmt!r}")
    writer = df.write.mode("append")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def file_kind(file_name: Column) -> Column:
    """``best``, ``segments`` or ``stream`` from the name of a raw file."""
    return (
        F.when(file_name.rlike(r"_best\.csv(\.gz)?$"), "best")
        .when(file_name.rlike(r"_segments\.csv(\.gz)?$"), "segments")
        .otherwise("stream")
    )


def activity_id_of_file(file_name: Column) -> Column:
    """The number a raw file's name ends with; NULL if there is none."""
    digits = F.regexp_extract(file_name, r"_(\d+)\.csv(?:\.gz)?$", 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")
