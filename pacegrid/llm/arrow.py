"""Arrow helpers of the operators that work in Python: bounded slices, ordered neighbours."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame

import pacegrid
from pacegrid.session import work_folder

#: Bytes of text that are worked on at once in a task.
SLICE_BYTES = 4_000_000


def slices(batches: Iterable[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``size`` bytes in ``column``; a longer value stands alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(lengths):
            if total + n > size and i > start:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(lengths):
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def qualified(spark, folder: str) -> str:
    """The folder with its scheme, as Spark's file systems resolve it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def ship(spark) -> None:
    """Send this package to the executors, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_pacegrid_shipped", False):
        return
    package = Path(pacegrid.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    folder = qualified(spark, work_folder(spark, "package"))
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/pacegrid.zip") as out:
        out.write(packed.getvalue())
    context.addPyFile(f"{folder}/pacegrid.zip")
    context._pacegrid_shipped = True


def map_arrow(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow`` on executors that know this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
