"""Small tables beside a large one, looked up by row number instead of joined.

A table whose rows are numbered and written in the order of their numbers is read in that order
again. What belongs to some of its rows is written in the same order, sorted over all tasks; a
task that reads rows opens the one or two files that hold their numbers. So the large table,
with its texts, is never shuffled, however large the one beside it grows; a task holds the
files for the rows it works on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.session import work_folder

#: Bits of a row number that count within what one task wrote.
PART_BITS = 33


@dataclass
class Beside:
    """Files in order, each with its least and greatest row number."""

    schema: pa.Schema
    files: list[tuple[int, int, str]]
    _held: dict[str, pa.Table] = field(default_factory=dict)

    def _open(self, name: str) -> pa.Table:
        if name not in self._held:
            while len(self._held) > 1:
                self._held.pop(next(iter(self._held)))
            system, path = fs.FileSystem.from_uri(name)
            self._held[name] = pq.read_table(path, filesystem=system, schema=self.schema)
        return self._held[name]

    def find(self, rows: pa.Array) -> pa.Table:
        """A row for each of the numbers, null where there is none."""
        asked = rows.to_numpy()
        parts = []
        edges = [0, *(np.flatnonzero(np.diff(asked >> PART_BITS)) + 1).tolist(), len(asked)]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            own = asked[a:b]
            names = [n for least, most, n in self.files if most >= own.min() and least <= own.max()]
            table = pa.concat_tables([self._open(n) for n in names] or [self.schema.empty_table()])
            known = table["_row"].to_numpy()
            place = np.searchsorted(known, own)
            hit = np.zeros(len(own), bool)
            inside = place < len(known)
            hit[inside] = known[place[inside]] == own[inside]
            parts.append(table.take(pa.array(np.where(hit, place, 0), mask=~hit)))
        return pa.concat_tables(parts) if parts else self.schema.empty_table()


def beside(df: DataFrame, purpose: str) -> Beside:
    """``df``, one row for each ``_row`` it has, written in order."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.repartitionByRange("_row").sortWithinPartitions("_row").write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    ends = back.groupBy(F.input_file_name().alias("file")).agg(F.min("_row").alias("a"), F.max("_row").alias("b"))
    # A line for each file, as many as the writing job had tasks.
    files = sorted((r.a, r.b, r.file) for r in ends.collect())
    return Beside(back.limit(0).toArrow().schema, files)
