"""Line dedup: content-defined chunks of lines, and those that repeat anywhere removed.

A rolling hash over the hashes of neighbouring lines chooses chunk borders, so equal passages
are cut alike wherever they stand; a long line is a chunk by itself. Chunks are counted by
hash over all documents. The texts of repeated ones alone are compared byte by byte; of equal
chunks the first, by ``doc_id`` and place, stays.

``dedup_runs`` also removes every line of a repeated run of ``LONG_LINE_WORDS`` words or more,
however it is cut. Such a run is covered by its least windows of so many words, one from each
line on and one up to each line; equal runs have equal windows. Windows are compared by the
hashes of their lines, after a check that no two lines among them share one.

Defined results: a null text stays null, an empty one empty; a row without ``doc_id`` comes
after all others; of repeated rows the first keeps its chunks; a document may end up empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.llm.arrow import map_arrow, slices
from pacegrid.llm.common import written
from pacegrid.llm.url_filter import block_count, possible_hits

#: A border stands after one line of so many, by hash.
MEAN_LINES = 3
#: A line of so many words is a chunk by itself.
LONG_LINE_WORDS = 50
#: Chunks of several lines count from so many words.
MIN_WORDS = 10
ODD = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def cut(text: str) -> list[tuple[str, int, int]]:
    """Chunks of a text: their lines, number of lines, and number of words."""
    out: list[tuple[str, int, int]] = []
    held: list[str] = []
    words = before = 0

    def close() -> None:
        nonlocal words
        if held:
            out.append(("\n".join(held), len(held), words))
            held.clear()
            words = 0

    for line in text.split("\n"):
        n = len(line.split())
        own = xxhash.xxh3_64_intdigest(line.encode())
        rolled = (before * ODD + own) & MASK
        before = own
        if n >= LONG_LINE_WORDS:
            close()
            out.append((line, 1, n))
            continue
        held.append(line)
        words += n
        if (rolled >> 32) % MEAN_LINES == 0:
            close()
    close()
    return out


def counts(lines: int, words: int) -> bool:
    """Whether a chunk may be removed if it repeats."""
    return words >= LONG_LINE_WORDS or (lines >= 2 and words >= MIN_WORDS)


def windows(words: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """The least windows of lines with ``LONG_LINE_WORDS`` words, from each line on and up to
    each line: the first line and the one after the last. Lines without words begin none."""
    onward, upto = [], []
    end = total = 0
    for start, n in enumerate(words):
        while end < len(words) and total < LONG_LINE_WORDS:
            total += words[end]
            end += 1
        if total < LONG_LINE_WORDS:
            break
        if n:
            onward.append((start, end))
        total -= n
    start = total = 0
    for last, n in enumerate(words):
        total += n
        while total - words[start] >= LONG_LINE_WORDS:
            total -= words[start]
            start += 1
        if n and total >= LONG_LINE_WORDS:
            upto.append((start, last + 1))
    return onward, upto


def line_ids(lines: list[str], words: list[int], seed: int) -> tuple[list[int | None], dict[int, list[str]]]:
    """A hash for each line, and the texts behind the hashes; lines without words that follow
    one another have one hash at the first of them."""
    ids: list[int | None] = [None] * len(lines)
    behind: dict[int, list[str]] = {}
    at = 0
    while at < len(lines):
        end = at + 1
        while not words[at] and end < len(lines) and not words[end]:
            end += 1
        text = "\n".join(lines[at:end])
        ids[at] = own = xxhash.xxh3_64_intdigest(text.encode(), seed) - (1 << 63)
        if text not in behind.setdefault(own, []):
            behind[own].append(text)
        at = end
    return ids, behind


def starts(text: str) -> list[int]:
    """Hashes of the windows from each line on."""
    lines = text.split("\n")
    words = [len(line.split()) for line in lines]
    own = [xxhash.xxh3_64_digest(line.encode()) for line in lines]
    return [xxhash.xxh3_64_intdigest(b"".join(own[a:b])) - (1 << 63) for a, b in windows(words)[0]]


def chunked(documents: DataFrame, text: str, runs: bool = False) -> DataFrame:
    """``_row``, the chunks, their lines, and their hashes (null for those that stay); with
    ``runs`` also the hashes of the windows from each line on."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            chunks, lines, hashes, onward = [], [], [], []
            for t in batch.column("_text").to_pylist():
                found = [] if t is None else cut(t)
                chunks.append(None if t is None else [c for c, _, _ in found])
                lines.append([n for _, n, _ in found])
                onward.append([] if t is None or not runs else starts(t))
                hashes.append(
                    [
                        xxhash.xxh3_64_intdigest(c.encode()) - (1 << 63) if counts(n, w) else None
                        for c, n, w in found
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(batch.num_columns - 1)),
                    pa.array(chunks, pa.list_(pa.string())),
                    pa.array(lines, pa.list_(pa.int32())),
                    pa.array(hashes, pa.list_(pa.int64())),
                    pa.array(onward, pa.list_(pa.int64())),
                ],
                [*batch.schema.names[:-1], "_chunks", "_lines", "_hashes", "_starts"],
            )

    rest = [documents[c] for c in documents.columns if c != text]
    rows = documents.select(F.monotonically_increasing_id().alias("_row"), *rest, documents[text].alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_arrow(rows, run, f"{kinds}, _chunks array<string>, _lines array<int>, _hashes array<bigint>, _starts array<bigint>")


def removals(cuts: DataFrame, key: str) -> DataFrame:
    """``_row`` and ``_gone``: places of the chunks that an earlier equal chunk stands for."""
    places = cuts.select("_row", F.posexplode("_hashes").alias("_place", "_hash")).where("_hash IS NOT NULL")
    repeated = written(places.groupBy("_hash").count().where("count > 1").select("_hash"), "chunk-hashes")
    # A filter of bounded size keeps most texts of other chunks from moving; the join is exact.
    every = cuts.select(
        "_row",
        F.col(key).alias("_key"),
        F.posexplode(F.arrays_zip("_hashes", "_chunks")).alias("_place", "_chunk"),
    ).select(
        "_row", "_key", "_place", F.col("_chunk._hashes").alias("url_key"), F.col("_chunk._chunks").alias("_text")
    )
    listed = repeated.select(F.col("_hash").alias("url_key"))
    blocks = block_count(repeated.count())
    maybe = possible_hits(every.where("url_key IS NOT NULL"), listed, blocks).where("maybe").drop("maybe")
    candidates = maybe.join(listed, "url_key", "left_semi")
    # Grouped by the bytes themselves: this is the comparison.
    order = F.struct(F.col("_key").isNull().alias("no_key"), "_key", "_row", "_place")
    candidates = candidates.select("url_key", "_text", order.alias("_at"))
    candidates = written(candidates, "chunk-candidates")
    first = candidates.groupBy("url_key", "_text").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    later = (
        candidates.join(first.where("_n > 1"), ["url_key", "_text"])
        .where("_at != _first")
        .select("_at._row", "_at._place")
    )
    # At most as many places as the document has chunks.
    return later.groupBy("_row").agg(F.collect_set("_place").alias("_gone"))


def dedup_lines(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with later copies of repeated chunks removed from ``text``, and
    ``n_removed_lines``."""
    cuts = written(chunked(documents, text), "line-chunks")
    gone = removals(cuts, key)
    joined = cuts.join(gone, "_row", "left")

    def kept(values: str):
        return F.when(F.col("_gone").isNull(), F.col(values)).otherwise(
            F.filter(F.col(values), lambda _, i: ~F.array_contains(F.col("_gone"), i))
        )

    # An outer join, so every row is back; a null text has null chunks.
    whole = F.array_join(kept("_chunks"), "\n")
    removed = F.aggregate(F.col("_lines"), F.lit(0).cast("bigint"), lambda a, n: a + n) - F.aggregate(
        kept("_lines"), F.lit(0).cast("bigint"), lambda a, n: a + n
    )
    columns = [whole.alias(c) if c == text else joined[c] for c in documents.columns]
    return joined.select(*columns, removed.alias("n_removed_lines"))


def window_rows(cuts: DataFrame, key: str, seed: int) -> DataFrame:
    """A row for each window with the hashes of its lines; and for each text behind a hash,
    once a document, a row with that text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            for i, t in enumerate(batch.column("_text").to_pylist()):
                lines = t.split("\n")
                words = [len(line.split()) for line in lines]
                ids, behind = line_ids(lines, words, seed)
                onward, upto = windows(words)
                found = sorted({*onward, *upto})
                pairs = [(h, text) for h, texts in behind.items() for text in texts]
                n, m = len(found), len(pairs)
                own = batch.slice(i, 1)
                again = pa.array([0] * (n + m), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column("_row").take(again),
                        own.column("_key").take(again),
                        pa.array([a for a, _ in found] + [None] * m, pa.int32()),
                        pa.array([b - a for a, b in found] + [None] * m, pa.int32()),
                        pa.array(
                            [[h for h in ids[a:b] if h is not None] for a, b in found] + [[h] for h, _ in pairs],
                            pa.list_(pa.int64()),
                        ),
                        pa.array([None] * n + [text for _, text in pairs], pa.string()),
                    ],
                    ["_row", "_key", "_place", "_n", "_ids", "_line"],
                )

    kind = cuts.schema[key].dataType.simpleString()
    rows = cuts.select("_row", F.col(key).alias("_key"), F.array_join("_chunks", "\n").alias("_text"))
    sql = f"_row bigint, _key {kind}, _place int, _n int, _ids array<bigint>, _line string"
    return map_arrow(rows, run, sql)


def run_removals(cuts: DataFrame, key: str) -> DataFrame:
    """``_row`` and ``_gone_lines``: places of the lines in later copies of a run."""
    every = cuts.select("_row", F.explode("_starts").alias("url_key"))
    repeated = written(every.groupBy("url_key").count().where("count > 1").select("url_key"), "run-hashes")
    maybe = possible_hits(every, repeated, block_count(repeated.count())).where("maybe")
    # A document with a repeated run has a repeated window from the run's first line on.
    rows = maybe.join(repeated, "url_key", "left_semi").select("_row").distinct()
    held = cuts.join(rows, "_row", "left_semi")
    seed = 0
    while True:
        found = written(window_rows(held, key, seed), "run-windows")
        lines = found.where("_line IS NOT NULL").select("_ids", "_line").distinct()
        if lines.groupBy("_ids").count().where("count > 1").isEmpty():
            break
        seed += 1
    order = F.struct(F.col("_key").isNull().alias("no_key"), "_key", "_row", "_place")
    places = found.where("_line IS NULL").select("_ids", "_n", order.alias("_at"))
    first = places.groupBy("_ids").agg(F.min("_at").alias("_first"), F.count("*").alias("_times"))
    # A window that overlaps the first one in its document is no copy of it.
    apart = (F.col("_at._row") != F.col("_first._row")) | (F.col("_at._place") >= F.col("_first._place") + F.col("_n"))
    later = places.join(first.where("_times > 1"), "_ids").where(apart)
    each = later.select("_at._row", F.explode(F.sequence("_at._place", F.expr("_at._place + _n - 1"))).alias("_line"))
    # At most as many places as the document has lines.
    return each.groupBy("_row").agg(F.collect_set("_line").alias("_gone_lines"))


def dedup_runs(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with later copies of repeated chunks and of repeated runs of lines removed
    from ``text``, and ``n_removed_lines``."""
    cuts = written(chunked(documents, text, runs=True), "line-chunks")
    joined = cuts.join(removals(cuts, key), "_row", "left").join(run_removals(cuts, key), "_row", "left")
    rest = [c for c in documents.columns if c != text]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            out, removed = [], []
            columns = (batch.column(c).to_pylist() for c in ("_text", "_lines", "_gone", "_gone_lines"))
            for t, counted, chunks, gone in zip(*columns):
                drop = set(gone or ())
                at, chunks = 0, set(chunks or ())
                for place, n in enumerate(counted or ()):
                    if place in chunks:
                        drop.update(range(at, at + n))
                    at += n
                if drop:
                    t = "\n".join(line for i, line in enumerate(t.split("\n")) if i not in drop)
                out.append(t)
                removed.append(len(drop))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(rest))), pa.array(out, pa.string()), pa.array(removed, pa.int64())],
                [*rest, text, "n_removed_lines"],
            )

    whole = F.array_join("_chunks", "\n").alias("_text")
    rows = joined.select(*(cuts[c] for c in rest), "_lines", "_gone", "_gone_lines", whole)
    kinds = "".join(f"`{c}` {documents.schema[c].dataType.simpleString()}, " for c in rest)
    cleaned = map_arrow(rows, run, f"{kinds}`{text}` string, n_removed_lines bigint")
    return cleaned.select(*documents.columns, "n_removed_lines")
