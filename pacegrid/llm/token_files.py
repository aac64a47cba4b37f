"""Token ids in binary files with a minimal perfect hash index for access by key.

Documents are ranged by key, one range to a shard. A shard is two files below the folder:

``shard-N.ids``
    raw little-endian ids of all its documents, 16 bits each if the vocabulary allows.
``shard-N.idx``
    header, then displacements, and by slot a fingerprint and the first row of the key; by
    row the key and the offset of its ids.

The hash is minimal and perfect: n keys take n slots. Keys fall into small buckets; a bucket
has a displacement under which its keys find free slots, single keys are sent to the slots
left over. A look-up computes one slot and compares one fingerprint; its cost does not depend
on the number of keys. A strange key is refused by its fingerprint or, in the end, by the key
that the row holds.

Shards are written under a temporary name and renamed, so a repeated task replaces its files
with equal ones. The folder has to be one that driver and executors share.

Defined results: null and empty texts have the end id alone; rows without a key come first
and cannot be looked up; rows of equal keys stand side by side, ordered by text, and a
look-up gives all of them.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacegrid.llm.arrow import map_arrow, qualified, slices, texts

MAGIC = b"PGTOKEN1"
HEADER = struct.Struct("<8sIIQQQ")  # magic, id bytes, buckets, keys, rows, rows without a key
KEYS_PER_BUCKET = 4
CACHED_CHUNKS = 600_000
#: Ids that are read at once.
READ_IDS = 500_000
#: Bytes of text that are cut into chunks at once: the more, the more of them repeat.
SLICE_BYTES = 4_000_000
#: White space other than a single blank or line feed between words, where tokens may begin
#: elsewhere than at the blank or the line feed; and the mark put before a stop.
WHITE = "\t\x0b\x0c\r\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
MARK = "\x01"
MORE_WHITE = rf"[{WHITE}{MARK}]|[ \n] (?:[ \n]|\z)|[ \n]\n|\n[ \n]"
#: A full stop or comma between a letter and a blank is a token of its own.
STOP, STOP_APART = r"([a-zA-ZÀ-ÖØ-öø-ÿ])([.,]) ", rf"\1 {MARK}\2 "


def mixed(keys: np.ndarray, seed: int | np.ndarray) -> np.ndarray:
    """A 64-bit hash of integer keys; equal for arrays and single numbers."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * (np.asarray(seed, np.uint64) + np.uint64(1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(keys, 0) % np.uint64(buckets)).astype(np.int64)


def slot_of(keys: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    """Slots; a negative displacement names the slot itself."""
    placed = (mixed(keys, np.maximum(displacement, 0) + 2) % np.uint64(n)).astype(np.int64)
    return np.where(displacement < 0, -displacement - 1, placed)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1) >> np.uint64(32)).astype(np.uint32)


def perfect_hash(keys: np.ndarray) -> np.ndarray:
    """Displacement of every bucket, for distinct keys."""
    n = len(keys)
    buckets = max(1, -(-n // KEYS_PER_BUCKET))
    own = bucket_of(keys, buckets)
    order = np.argsort(own, kind="stable")
    sizes = np.bincount(own, minlength=buckets)
    ends = np.cumsum(sizes)
    out = np.zeros(buckets, np.int32)
    taken = np.zeros(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        members = keys[order[ends[b] - sizes[b] : ends[b]]]
        if len(members) < 2:
            break  # sizes fall: what is left are single keys and empty buckets
        first, width = 0, 16
        while True:
            tries = np.arange(first, first + width)
            slots = (mixed(members[None, :], tries[:, None] + 2) % np.uint64(n)).astype(np.int64)
            free = ~taken[slots].any(1)
            in_order = np.sort(slots, 1)
            fits = np.flatnonzero(free & (in_order[:, 1:] != in_order[:, :-1]).all(1))
            if len(fits):
                out[b] = tries[fits[0]]
                taken[slots[fits[0]]] = True
                break
            first, width = first + width, min(4096, width * 2)
    single = np.flatnonzero(sizes == 1)
    out[single] = -np.flatnonzero(~taken) - 1
    return out


class ChunkEncoder:
    """Ids by the tokenizers library, kept for the chunks between blanks and line feeds.

    The pre-tokeniser begins a token at every blank or line feed that stands between other
    characters than white space. So texts are cut there; a chunk keeps its line feed, a
    missing one stands for a blank, and a line feed put before the text makes its first chunk
    like any other. A stop after a letter is a chunk by itself, marked as one without a blank.
    Chunks of a slice are told apart in Arrow; new ones are encoded as one text, whose ids are
    cut where a blank or a line feed begins. Texts with more white space go through whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        # The byte-level alphabet writes a blank as U+0120 and a line feed as U+010A.
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token[:1] in "\u0120\u010a"]] = True
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.ids = np.zeros(0, self.kind)
        self.ends = np.zeros(1, np.int64)

    def learn(self, chunks: list[str]) -> None:
        # Alone, white space would run on into the next chunk; a marked stop has no blank.
        bare = [c for c in chunks if c in ("", "\n") or c[0] == MARK]
        new = [c for c in chunks if c not in ("", "\n") and c[0] != MARK]
        parts, sizes = [], []
        for start in range(0, len(new), 20_000):
            part = new[start : start + 20_000]
            whole = "".join(c if c[0] == "\n" else " " + c for c in part)
            ids = np.array(self.tokenizer.encode(whole, add_special_tokens=False).ids, self.kind)
            heads = np.flatnonzero(self.begins[ids])
            if len(heads) != len(part):
                raise ValueError("the tokenizer does not begin a token at every blank")
            parts.append(ids)
            sizes.append(np.diff(np.append(heads, len(ids))))
        for c in bare:
            ids = self.tokenizer.encode(c.removeprefix(MARK) or " ", add_special_tokens=False).ids
            parts.append(np.array(ids, self.kind))
            sizes.append(np.array([len(ids)]))
        if parts:
            self.known = pa.concat_arrays([self.known, pa.array([*new, *bare], pa.large_string())])
            self.ids = np.concatenate([self.ids, *parts])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes))])

    def places(self, distinct: pa.Array) -> np.ndarray:
        """Where each chunk is among the known ones; new ones are learned."""
        if len(self.known) > CACHED_CHUNKS:
            self.forget()
        found = pc.index_in(distinct, value_set=self.known)
        new = distinct.filter(pc.is_null(found)).to_pylist()
        if new:
            self.learn(new)
            found = pc.index_in(distinct, value_set=self.known)
        return found.to_numpy()

    def encode(self, batch: list[str]) -> list[bytes]:
        every = pa.array(batch, pa.large_string())
        plain = pc.invert(pc.match_substring_regex(every, MORE_WHITE))
        marked = pc.replace_substring(every.filter(plain), "\n", " \n")
        marked = pc.binary_join_element_wise(pa.scalar("\n", pa.large_string()), marked, pa.scalar("", pa.large_string()))
        marked = pc.replace_substring_regex(marked, STOP, STOP_APART)
        lists = pc.split_pattern(marked, " ")
        chunks = lists.flatten().dictionary_encode()
        places = self.places(chunks.dictionary)[chunks.indices.to_numpy()]
        first, sizes = self.ends[places], np.diff(self.ends)[places]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(first - ends[:-1], sizes) + np.arange(ends[-1])]
        # By text, without the line feed put before it.
        edges = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        found = (ids[a + 1 : b].tobytes() for a, b in zip(edges, edges[1:]))
        return [next(found) if p else self.whole(t) for t, p in zip(batch, plain.to_pylist())]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()


@lru_cache(2)
def chunk_encoder(path: str) -> ChunkEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ChunkEncoder(path)


def file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def index_bytes(keys: list[int | None], ends: list[int], width: int) -> bytes:
    """The index file of rows in key order; ``ends`` are id offsets behind each row."""
    nulls = sum(k is None for k in keys)
    own = np.array(keys[nulls:], np.int64)
    distinct, first = np.unique(own, return_index=True)
    moves = perfect_hash(distinct) if len(distinct) else np.zeros(1, np.int32)
    slots = slot_of(distinct, moves[bucket_of(distinct, len(moves))], len(distinct)) if len(distinct) else first
    marks, rows = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    marks[slots], rows[slots] = fingerprint(distinct), first + nulls
    header = HEADER.pack(MAGIC, width, len(moves), len(distinct), len(keys), nulls)
    by_row = np.concatenate([np.zeros(nulls, np.int64), own]).astype("<i8")
    offsets = np.array([0, *ends], "<u8")
    return b"".join([header, moves.astype("<i4").tobytes(), marks.tobytes(), rows.tobytes(), by_row.tobytes(), offsets.tobytes()])


class Shard:
    """One shard, open for look-ups and for reading in order."""

    def __init__(self, folder: str, number: int):
        self.files, root = file_system(folder)
        self.number = number
        self.ids_path = f"{root}/shard-{number:05d}.ids"
        with self.files.open_input_file(f"{root}/shard-{number:05d}.idx") as f:
            raw = f.read()
        magic, self.width, buckets, n, rows, self.nulls = HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError(f"{root}: not a token index")
        at = HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        self.moves, self.marks, self.rows = take("<i4", buckets), take("<u4", n), take("<u4", n)
        self.keys, self.offsets = take("<i8", rows), take("<u8", rows + 1)

    def row_of(self, key: int) -> int | None:
        """First row of a key, or none; constant time."""
        if not len(self.marks):
            return None
        one = np.array([key], np.int64)
        slot = int(slot_of(one, self.moves[bucket_of(one, len(self.moves))], len(self.marks))[0])
        if self.marks[slot] != fingerprint(one)[0]:
            return None
        row = int(self.rows[slot])
        return row if self.keys[row] == key else None

    def rows_of(self, keys: np.ndarray) -> np.ndarray:
        """First row of each key by the hash and the fingerprint, -1 for a strange key."""
        if not len(self.marks):
            return np.full(len(keys), -1)
        slots = slot_of(keys, self.moves[bucket_of(keys, len(self.moves))], len(self.marks))
        rows = self.rows[slots].astype(np.int64)
        return np.where((self.marks[slots] == fingerprint(keys)) & (self.keys[rows] == keys), rows, -1)

    def ends_of(self, rows: np.ndarray) -> np.ndarray:
        """The row after the last one with the key of each of ``rows``, its first."""
        last = np.append(np.flatnonzero(self.keys[1:] != self.keys[:-1]) + 1, len(self.keys))
        return last[np.searchsorted(last, rows, "right")]

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids of rows ``start`` to ``stop``."""
        first, last = int(self.offsets[start]), int(self.offsets[stop])
        with self.files.open_input_file(self.ids_path) as f:
            raw = f.read_at((last - first) * self.width, first * self.width)
        return np.frombuffer(raw, f"<u{self.width}")

    def get(self, key: int) -> list[np.ndarray]:
        """Ids of every row with this key."""
        row = self.row_of(key)
        out = []
        while row is not None and row < len(self.keys) and self.keys[row] == key:
            out.append(self.read(row, row + 1))
            row += 1
        return out


def write_token_files(
    documents: DataFrame, folder: str, tokenizer: str, end_id: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write all shards; gives ``shard, n_docs, n_ids, least, most`` for each."""
    folder = qualified(documents.sparkSession, folder)
    rows = documents.select(
        documents[key].cast("long").alias("_key"), F.coalesce(documents[text], F.lit("")).alias("_text")
    )
    ordered = rows.repartitionByRange("_key").sortWithinPartitions("_key", "_text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(tokenizer)
        number = TaskContext.get().partitionId()
        files, root = file_system(folder)
        width = int(encoder.kind[2:])
        end = np.array([end_id], encoder.kind).tobytes()
        keys: list[int | None] = []
        sizes: list[int] = []
        name, mark, payload = f"{root}/shard-{number:05d}", uuid.uuid4().hex, None
        for batch in slices(batches, "_text", SLICE_BYTES):
            if payload is None:
                payload = files.open_output_stream(f"{name}.{mark}.ids")
            for key_, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts(batch, "_text"))):
                payload.write(ids)
                payload.write(end)
                keys.append(key_)
                sizes.append(len(ids) // width + 1)
        if payload is None:
            return
        payload.close()
        ends = list(accumulate(sizes))
        with files.open_output_stream(f"{name}.{mark}.idx") as index:
            index.write(index_bytes(keys, ends, width))
        for kind in ("ids", "idx"):
            files.move(f"{name}.{mark}.{kind}", f"{name}.{kind}")
        line = {"shard": number, "n_docs": len(keys), "n_ids": ends[-1], "least": keys[0], "most": keys[-1]}
        kinds = pa.schema([("shard", pa.int32()), *((c, pa.int64()) for c in ("n_docs", "n_ids", "least", "most"))])
        yield pa.RecordBatch.from_pylist([line], kinds)

    files, root = file_system(folder)
    files.create_dir(root, recursive=True)
    lines = map_arrow(ordered, run, "shard int, n_docs long, n_ids long, least long, most long")
    # One line for each shard: as many as the job has tasks.
    found = sorted(lines.collect(), key=lambda x: x["shard"])
    return documents.sparkSession.createDataFrame(found, lines.schema)


_FOUND = "doc_id long, start long, n_tokens long, ids binary"


def _rows(shard: Shard, place: np.ndarray, start: int) -> Iterator[pa.RecordBatch]:
    """The given rows of a shard, in bounded batches; neighbours are read at once. ``start``
    ids lie before the shard."""
    offsets = shard.offsets.astype(np.int64)
    breaks = np.append(np.flatnonzero(np.diff(place) != 1) + 1, len(place))
    at = 0
    while at < len(place):
        room = int(np.searchsorted(offsets, offsets[place[at]] + READ_IDS, "right")) - 1 - int(place[at])
        stop = min(int(breaks[np.searchsorted(breaks, at, "right")]), at + max(room, 1))
        first, last = int(place[at]), int(place[stop - 1]) + 1
        ids = shard.read(first, last).astype("<u4")
        cuts = (offsets[first : last + 1] - offsets[first]).tolist()
        names = [None if r < shard.nulls else int(shard.keys[r]) for r in range(first, last)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.int64()),
                pa.array(offsets[first:last] + start),
                pa.array(np.diff(offsets[first : last + 1])),
                pa.array([ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            ],
            ["doc_id", "start", "n_tokens", "ids"],
        )
        at = stop


def _lines(manifest: DataFrame) -> tuple[list, dict[int, int]]:
    """The manifest's lines, one for each task that wrote, and the ids before each shard."""
    lines = sorted(manifest.collect(), key=lambda x: x["shard"])
    return lines, dict(zip((x["shard"] for x in lines), [0, *accumulate(x["n_ids"] for x in lines)]))


def _of_shards(spark: SparkSession, folder: str, numbers: list[int], before: dict[int, int], keyless: bool) -> DataFrame:
    """All rows of some shards in order, or those without a key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                shard = Shard(folder, number)
                yield from _rows(shard, np.arange(shard.nulls if keyless else len(shard.keys)), before[number])

    shards = spark.createDataFrame([(n,) for n in numbers], "shard int").repartition(max(1, len(numbers)))
    return map_arrow(shards, run, _FOUND)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Every row of the shards in order: ``doc_id, start, n_tokens, ids`` where ``ids`` are
    little-endian unsigned 32-bit and ``start`` counts the ids before them."""
    spark = manifest.sparkSession
    lines, before = _lines(manifest)
    return _of_shards(spark, qualified(spark, folder), [x["shard"] for x in lines], before, keyless=False)


def read_by_key(keys: DataFrame, manifest: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """The rows of the asked keys from the shards, as ``read_token_files`` gives them.

    Each distinct key is looked up by the hash, which gives its row, and the row's offset the
    ids; a null asks for the rows without a key. A key that no shard holds is an error.
    """
    spark = manifest.sparkSession
    folder = qualified(spark, folder)
    lines, before = _lines(manifest)
    keyed = [x for x in lines if x["most"] is not None]
    # Rows without a key come before all others, so that shard's range has no lower end.
    least = np.array([np.iinfo(np.int64).min if x["least"] is None else x["least"] for x in keyed], np.int64)

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            asked = batch.column(0).to_numpy()
            own = np.searchsorted(least, asked, "right") - 1
            if len(own) and own.min() < 0:
                raise KeyError(f"no shard holds {asked[own.argmin()]}")
            for i in np.unique(own).tolist():
                if shard is None or shard.number != keyed[i]["shard"]:
                    shard = Shard(folder, keyed[i]["shard"])
                some = asked[own == i]
                first = shard.rows_of(some)
                if (first < 0).any():
                    raise KeyError(f"no shard holds {some[first.argmin()]}")
                first = np.sort(first)
                sizes = shard.ends_of(first) - first
                every = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                yield from _rows(shard, every, before[shard.number])

    own = keys.select(keys[key].cast("long").alias("doc_id"))
    asked = own.where("doc_id IS NOT NULL").distinct().repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    found = map_arrow(asked, look, _FOUND)
    empty = [x["shard"] for x in lines if x["least"] is None]
    if not empty or own.where("doc_id IS NULL").isEmpty():
        return found
    return found.unionByName(_of_shards(spark, folder, empty, before, keyless=True))


def crc32_of(ids: str = "ids"):
    """Unsigned CRC-32 of the ids' bytes."""
    return F.crc32(F.col(ids))


def look_up(spark: SparkSession, folder: str, manifest: DataFrame, key: int) -> list[np.ndarray]:
    """Ids of every row with a key; only shards whose range holds it are opened."""
    folder = qualified(spark, folder)
    hit = manifest.where((F.col("most") >= key) & (F.coalesce("least", F.lit(key)) <= key))
    return [ids for x in sorted(hit.collect(), key=lambda x: x["shard"]) for ids in Shard(folder, x["shard"]).get(key)]
