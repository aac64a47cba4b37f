"""Tables that a load changes as a whole or not at all.

A store is a folder of tables. A load writes what it adds or replaces into folders of its own,
one for each table, laid out in hash buckets of the table's key::

    <root>/<table>/store_load=<load>/store_bucket=<bucket>/part-….parquet
    <root>/current.json

``current.json``, the pointer, names the folders and buckets that make up every table, and is
replaced by one rename when the load commits. Readers take the folders from the pointer, so a
load that breaks in between changes nothing, all tables of a load change together, and a reader
goes on with the files it began with. Two loads at a time do not mix: the one that commits
second finds a pointer other than the one it began from and fails.

A stream's load carries the stream's name and batch id; the pointer remembers the last one of
each stream, and a batch that is repeated after its commit does nothing.

* Insert-only tables add a folder a load. Beside each there is a table of its keys, in the same
  buckets; a load looks for known keys in the buckets of its own keys alone.
* Tables whose groups are replaced rewrite the buckets that a load touches; the pointer then
  has them in the new folder, and the others where they were.

The pointer has one number for each load of an insert-only table and at most one for each
bucket of the others; ``compact`` makes one folder of a table, ``sweep`` removes folders that
the pointer does not name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacegrid.operators.joins import merged_if_many, salted_join
from pacegrid.sources.tables import bucket_of

POINTER = "current.json"
SCRATCH = "scratch"
LOAD, BUCKET = "store_load", "store_bucket"
BUCKETS = 64
COMPRESSION = "zstd"
#: All buckets of a folder.
ALL = "*"


class Conflict(RuntimeError):
    """Another load has committed since this one began."""


def hadoop_path(spark: SparkSession, path: str):
    """A path as Hadoop's file systems take it."""
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    """The file system that a path lies in."""
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None if there is none."""
    files, at = file_system(spark, path), hadoop_path(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside and rename it over ``path``."""
    beside = f"{path}.{uuid.uuid4().hex}"
    files = file_system(spark, path)
    stream = files.create(hadoop_path(spark, beside), False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    names = spark._jvm.org.apache.hadoop.fs
    kind = getattr(names, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    whole = files.makeQualified(hadoop_path(spark, path))
    context = names.FileContext.getFileContext(whole.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(hadoop_path(spark, beside)), whole, over)


class Store:
    """The tables of a store as the pointer has them when they are read."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    @staticmethod
    def at(spark: SparkSession, root: str) -> Store | None:
        """The store in a folder, None if no load has committed there."""
        found = read_text(spark, f"{root.rstrip('/')}/{POINTER}")
        return None if found is None else Store(spark, root)

    def state(self) -> dict:
        text = read_text(self.spark, f"{self.root}/{POINTER}")
        return json.loads(text) if text else {"loads": 0, "tables": {}, "streams": {}, "marks": {}}

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The table's declared columns; empty if nothing was loaded yet and ``schema`` given."""
        return _read(self, self.state(), table, schema)

    def load(self) -> Load:
        return Load(self, self.state())

    def once(self, stream: str, batch: int, work: Callable[[Load], None]) -> bool:
        """Run and commit a stream's batch unless it has been committed; tells if it ran."""
        load = self.load()
        if load.state["streams"].get(stream, -1) >= batch:
            return False
        work(load)
        load.state["streams"][stream] = batch
        load.commit()
        return True

    def sweep(self) -> list[str]:
        """Remove folders of loads that no longer count or broke; no load or reader of older
        tables may be running."""
        files, state, gone = file_system(self.spark, self.root), self.state(), []
        files.delete(hadoop_path(self.spark, f"{self.root}/{SCRATCH}"), True)
        for table, entry in state["tables"].items():
            for found in files.listStatus(hadoop_path(self.spark, f"{self.root}/{table}")):
                name = found.getPath().getName()
                if name.startswith(f"{LOAD}=") and name.partition("=")[2] not in entry["parts"]:
                    files.delete(found.getPath(), True)
                    gone.append(f"{table}/{name}")
        return gone


def _read(
    store: Store,
    state: dict,
    table: str,
    schema: T.StructType | None = None,
    buckets: list[int] | None = None,
    loads: list[str] | None = None,
    marked: bool = False,
) -> DataFrame:
    """A table, or some buckets or loads of it; ``marked`` keeps the load and the bucket."""
    entry = state["tables"].get(table)
    if entry is None and schema is None:
        raise KeyError(f"{store.root} has no table {table}")
    own = T.StructType.fromJson(json.loads(entry["schema"])) if entry else schema
    layout = [T.StructField(LOAD, T.StringType()), T.StructField(BUCKET, T.IntegerType())]
    parts = entry["parts"] if entry else {}
    chosen = {name: live for name, live in parts.items() if loads is None or name in loads}
    if not chosen:
        found = store.spark.createDataFrame([], T.StructType([*own.fields, *layout]))
    else:
        base = f"{store.root}/{table}"
        reader = store.spark.read.schema(T.StructType([*own.fields, *layout])).option("basePath", base)
        found = reader.parquet(*(f"{base}/{LOAD}={name}" for name in chosen))
        some = [name for name, live in chosen.items() if live != ALL]
        if some:
            # Partition filters: replaced buckets are not read.
            whole = [name for name in chosen if name not in some]
            cases = [F.col(LOAD).isin(whole)] if whole else []
            cases += [(F.col(LOAD) == name) & F.col(BUCKET).isin(chosen[name]) for name in some]
            found = found.where(reduce(Column.__or__, cases))
        if buckets is not None:
            found = found.where(F.col(BUCKET).isin(buckets))
    names = (schema or own).names + ([LOAD, BUCKET] if marked else [])
    return found.select(*names)


class Load:
    """Changes of several tables, seen by this load alone until it commits."""

    def __init__(self, store: Store, state: dict):
        self.store, self.spark = store, store.spark
        self.before, self.state = json.dumps(state, sort_keys=True), state
        self.name = f"{state['loads'] + 1:06d}-{uuid.uuid4().hex[:8]}"
        self.state["loads"] += 1
        self.scratch = f"{store.root}/{SCRATCH}/{self.name}"

    def commit(self) -> None:
        now = json.dumps(self.store.state(), sort_keys=True)
        if now != self.before:
            raise Conflict(f"{self.store.root}: another load has committed since this one began")
        replace_text(self.spark, f"{self.store.root}/{POINTER}", json.dumps(self.state))
        file_system(self.spark, self.scratch).delete(hadoop_path(self.spark, self.scratch), True)

    def staged(self, df: DataFrame) -> DataFrame:
        """The rows written aside until the load commits, so that every pass sees the same."""
        path = f"{self.scratch}/{uuid.uuid4().hex}"
        df.write.option("compression", COMPRESSION).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def holds(self, table: str) -> bool:
        """Whether an earlier change has written rows of the table, or may have."""
        return bool(self.state["tables"].get(table, {}).get("parts"))

    def read(self, table: str, schema: T.StructType | None = None, **some) -> DataFrame:
        """The table with what this load has changed; see ``_read`` for parts of it."""
        return _read(self.store, self.state, table, schema, **some)

    def loads_of(self, table: str, since: int = 0) -> list[str]:
        """Names of the table's folders whose load came after load number ``since``."""
        parts = self.state["tables"].get(table, {"parts": {}})["parts"]
        return [name for name in parts if int(name.partition("-")[0]) > since]

    def _entry(self, table: str, schema: T.StructType, keys: list[str], kind: str) -> dict:
        fields = [T.StructField(f.name, f.dataType) for f in schema.fields]
        wanted = {"keys": keys, "kind": kind, "schema": T.StructType(fields).json()}
        entry = self.state["tables"].get(table)
        if entry is None:
            entry = self.state["tables"][table] = {**wanted, "buckets": self.store.buckets, "parts": {}}
        for part, value in wanted.items():
            if entry[part] != value:
                raise ValueError(f"{table} has {part} {entry[part]}, not {value}")
        return entry

    def _folder(self, table: str, entry: dict) -> str:
        """A new folder of the table; a table has one for each change in a load."""
        name, n = self.name, 1
        while name in entry["parts"]:
            n += 1
            name = f"{self.name}.{n}"
        return name

    def _write(self, table: str, entry: dict, df: DataFrame, keys: list[str]) -> str:
        name = self._folder(table, entry)
        placed = df.withColumn(BUCKET, bucket_of(keys, entry["buckets"]))
        # Large buckets are split, small ones joined, so that files are of even size.
        writer = placed.hint("rebalance", BUCKET).write.mode("overwrite").option("compression", COMPRESSION)
        writer.partitionBy(BUCKET).parquet(f"{self.store.root}/{table}/{LOAD}={name}")
        return name

    def _touched(self, df: DataFrame, entry: dict, keys: list[str]) -> list[int]:
        """At most as many numbers as there are buckets."""
        return sorted(self._counted(df, entry, keys))

    def _counted(self, df: DataFrame, entry: dict, keys: list[str]) -> dict[int, int]:
        """The touched buckets, and about how many keys each gets."""
        bucket = bucket_of(keys, entry["buckets"]).alias("b")
        n = F.approx_count_distinct(F.xxhash64(*keys)).alias("n")
        return {row.b: row.n for row in df.groupBy(bucket).agg(n).collect()}

    def append(self, table: str, batch: DataFrame, keys: list[str]) -> str:
        """Add all rows; gives the name of their folder."""
        entry = self._entry(table, batch.schema, keys, "append")
        name = self._write(table, entry, batch, keys)
        entry["parts"][name] = ALL
        return name

    def refresh(self, table: str, df: DataFrame, keys: list[str]) -> None:
        """Replace the whole table; ``df`` may read from it."""
        if table in self.state["tables"]:
            self.state["tables"][table].update(
                keys=keys, kind="refresh", schema=T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]).json()
            )
        entry = self._entry(table, df.schema, keys, "refresh")
        name = self._write(table, entry, df, keys)
        entry["parts"] = {name: ALL}

    def insert_only(self, table: str, batch: DataFrame, key: str, written: bool = False) -> None:
        """Add rows of unknown keys and rows without one: the first load of a key wins.

        Into an empty table the batch goes as it is, in one pass. Otherwise it is written aside
        first, unless it is ``written`` already. The keys are those of the rows that were added.
        """
        entry = self._entry(table, batch.schema, [key], "append")
        if self.holds(table):
            batch = batch if written else self.staged(batch)
            keys = batch.where(F.col(key).isNotNull()).select(key).distinct()
            counted = self._counted(keys, entry, [key])
            known = self.known_keys(table, key, batch.schema[key].dataType, sorted(counted))
            # The known keys are not counted, and grow with the table: never sent to every task.
            fresh = self.staged(keys.join(known.hint("merge"), key, "left_anti"))
            n = sum(counted.values())
            others = [c for c, t in batch.dtypes if c != key and not t.startswith("map")]
            chosen = salted_join(batch, fresh, key, "left_semi", others or [key], n).select(*batch.columns)
            self.append(table, chosen.unionByName(batch.where(F.col(key).isNull())), [key])
        else:
            added = self.append(table, batch, [key])
            keys = self.read(table, loads=[added]).select(key)
            fresh = keys.where(F.col(key).isNotNull()).distinct()
        self.append(f"{table}.keys", fresh, [key])

    def known_keys(self, table: str, key: str, kind: T.DataType, buckets: list[int]) -> DataFrame:
        """Keys that an insert-only table has in some buckets."""
        return self.read(f"{table}.keys", T.StructType([T.StructField(key, kind)]), buckets=buckets)

    def replace(self, table: str, batch: DataFrame, keys: list[str]) -> None:
        """Delete all rows that share a key tuple with the batch, then add the batch."""
        entry = self._entry(table, batch.schema, keys, "replace")
        batch = self.staged(batch)
        counted = self._counted(batch, entry, keys)
        touched = sorted(counted)
        if not touched:
            return
        old = self.read(table, batch.schema, buckets=touched)
        new = merged_if_many(batch.select(*keys).distinct(), sum(counted.values()))
        kept = old.join(new, keys, "left_anti").select(*batch.columns)
        name = self._write(table, entry, kept.unionByName(batch), keys)
        gone = set(touched)
        parts = {n: [b for b in live if b not in gone] for n, live in entry["parts"].items()}
        entry["parts"] = {**{n: live for n, live in parts.items() if live}, name: touched}

    def upsert(self, table: str, batch: DataFrame, key: str) -> None:
        """Replace every row of the batch's keys: the last load of a key wins.

        Into an empty table the batch goes as it is, in one pass.
        """
        if self.holds(table):
            self.replace(table, batch, [key])
            return
        entry = self._entry(table, batch.schema, [key], "replace")
        name = self._write(table, entry, batch, [key])
        entry["parts"] = {name: list(range(entry["buckets"]))}

    def compact(self, table: str) -> None:
        """One folder of all rows of a table."""
        entry = self.state["tables"][table]
        name = self._write(table, entry, self.read(table), entry["keys"])
        entry["parts"] = {name: list(range(entry["buckets"])) if entry["kind"] == "replace" else ALL}
