"""Substring dedup by recompression: repeats of 50 words and more are removed but for the first.

Every document is a sequence of word names. A level renames its runs (equal neighbours become
one symbol) and then its pairs (names fall into two classes by a coin of the name and the level;
a left name followed by a right one becomes one symbol). Names are functions of what they stand
for alone, so equal substrings get equal symbols inside, in whichever document and task.

* First Spark round, ``LOW_LEVELS`` levels: symbols are counted over all documents. With every
  symbol goes the stretch of words that determines it, so a window that holds this stretch has
  the symbol wherever it stands. A window with a symbol of one document only is no repeat; the
  others stay alive. Every second symbol, by its name, does for that.
* Second Spark round, up to ``HIGH_LEVELS`` levels, for documents with living windows:
  symbols of 50 words or more, neighbours of them, and whole documents, are named by 128-bit
  hashes of their words. One that an earlier document has is removed as a whole, and its windows
  are known there: copies do not bring theirs along.
* What is left is verified: living windows outside such stretches are compared by 128-bit hashes
  of their words. A clash of the 64-bit names can only leave a window alive.

Equal hashes are brought together by sorting over all tasks, so rows of one hash, however many,
are spread like any others. Texts are not shuffled: what is found about a document is looked up
by its row number (``beside``).

Defined results: a null or empty text has no words; a row without key comes after all others;
rows with equal keys do not remove each other's words, as neither key is smaller; extra columns
are kept, whatever their names. A text is worked on in one task, with about 100 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacegrid.llm.arrow import map_arrow, slices
from pacegrid.llm.beside import Beside, beside
from pacegrid.llm.common import written

#: Consecutive words that make up a repeat.
WINDOW = 50
#: Levels of the first round: their symbols are determined by some twenty words.
LOW_LEVELS = 4
#: Levels of the second round whose symbols are named, of some 55 and 100 words.
HIGH_LEVELS = (14, 16)

ODD_A, ODD_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
ODD_C, RUN = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x165667B19E3779F9)
#: Places that no window holds, for what depends on a text's edge.
BEFORE, BEHIND = -(1 << 29), 1 << 29
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A name for the pair of ``a`` and ``b``."""
    x = a * ODD_A + b
    x ^= x >> np.uint64(32)
    x *= ODD_B
    x ^= x >> np.uint64(29)
    x *= ODD_C
    return x ^ (x >> np.uint64(32))


@lru_cache(2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, both modulo 2**64."""
    base = int(ODD_B)
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        row = np.full(n, b, np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def word_names(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A name for each word of some texts, and the place of each text's first word (the number
    of words at last)."""
    raw = [(t or "").encode() for t in texts]
    data = np.frombuffer(b" ".join([b"", *raw, b""]), np.uint8)
    white = WHITE[data]
    start = np.flatnonzero(white[:-1] & ~white[1:]) + 1
    stop = np.flatnonzero(~white[:-1] & white[1:]) + 1
    # A word's bytes as a polynomial: sums up to its ends, brought back to power 0.
    up, down = powers(1 << max(20, len(data).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    names = mixed((sums[stop] - sums[start]) * down[start], (stop - start).astype(np.uint64))
    begins = np.cumsum([1, *(len(r) + 1 for r in raw)])
    return names, np.searchsorted(start, begins).astype(np.int32)


@dataclass
class Parse:
    """The symbols of some texts at one level, one text after the other."""

    name: np.ndarray
    #: Place of the first word that a symbol stands for; the next symbol begins where it ends.
    start: np.ndarray
    #: Words that determine the symbol, to the one after the last. Both ascend.
    low: np.ndarray
    high: np.ndarray
    #: Place of each text's first word, and of the end of the last.
    edges: np.ndarray

    @staticmethod
    def of(names: np.ndarray, edges: np.ndarray) -> Parse:
        place = np.arange(len(names), dtype=np.int32)
        return Parse(names, place, place, place + 1, edges)

    def stops(self) -> np.ndarray:
        return np.append(self.start[1:], self.edges[-1])

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last symbol of each text that has any."""
        first = np.searchsorted(self.start, self.edges[:-1][np.diff(self.edges) > 0])
        return first, np.append(first[1:], len(self.start)) - 1

    def runs(self) -> Parse:
        """Equal neighbours as one symbol. That a run ends is up to both neighbours."""
        n = len(self.name)
        if not n:
            return self
        first, last = self.ends()
        head = np.ones(n, bool)
        np.not_equal(self.name[1:], self.name[:-1], out=head[1:])
        head[first] = True
        heads = np.flatnonzero(head)
        tails = np.append(heads[1:], n) - 1
        name = self.name[heads]
        many = np.flatnonzero(tails > heads)
        name[many] = mixed(name[many] ^ RUN, (tails - heads + 1)[many].astype(np.uint64))
        low, high = self.low[heads - 1], self.high[np.minimum(tails + 1, n - 1)]
        low[np.searchsorted(heads, first)] = BEFORE
        high[np.searchsorted(tails, last)] = BEHIND
        return Parse(name, self.start[heads], low, high, self.edges)

    def pairs(self, level: int) -> Parse:
        """Left names and the right ones after them as one symbol. That a symbol stays alone is
        up to the neighbour it could have been paired with."""
        n = len(self.name)
        if not n:
            return self
        first, last = self.ends()
        coin = np.full(1, level, np.uint64) * RUN
        left = (mixed(self.name, coin) >> np.uint64(63)) == 0
        second = np.zeros(n, bool)
        np.logical_and(left[:-1], ~left[1:], out=second[1:])
        second[first] = False
        keep = np.flatnonzero(~second)
        paired = np.append(second[1:], False)[keep]
        name = self.name[keep]
        name[paired] = mixed(name[paired], self.name[keep[paired] + 1])
        of_left = left[keep]
        right_after, left_before = keep[of_left] + 1, keep[~of_left] - 1
        low, high = self.low[keep], self.high[keep]
        high[of_left] = self.high[np.minimum(right_after, n - 1)]
        low[~of_left] = self.low[left_before]
        alone = first[~left[first]]
        low[np.searchsorted(keep, alone)] = BEFORE
        alone = last[left[last]]
        high[np.searchsorted(keep, alone)] = BEHIND
        return Parse(name, self.start[keep], low, high, self.edges)

    def levels(self, first: int, last: int) -> Parse:
        now = self
        for level in range(first, last):
            now = now.runs().pairs(level)
        return now

    def determined(self) -> np.ndarray:
        """Symbols of several words that words of one window can determine."""
        return (self.high - self.low <= WINDOW) & (self.stops() - self.start > 1)


def chosen(parse: Parse) -> np.ndarray:
    """The symbols that are counted: determined ones, every second by name."""
    return np.flatnonzero(parse.determined() & (parse.name & np.uint64(1) == 0))


def living(low: np.ndarray, high: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Whether the window from each word on can be a repeat, given the stretches that determine
    symbols of one document only. Texts have one place more than words."""
    n = int(edges[-1])
    # Windows that begin in the text before are too near to its end to be any.
    change = np.bincount(np.maximum(high - WINDOW, 0), minlength=n + 1)
    change -= np.bincount(low + 1, minlength=n + 1)
    alive = np.cumsum(change)[:n] == 0
    for stop in edges[1:].tolist():
        alive[max(stop - WINDOW, 0) : stop] = False
    return alive


def joined_words(text: str) -> tuple[bytes, list[int]]:
    """The words joined by one space, and where each begins, one beyond the end at last."""
    words = text.encode().split()
    return b" ".join(words), [0, *accumulate(len(w) + 1 for w in words)]


def stretches(marks: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true values: first place, and the one after the last."""
    change = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
    return list(zip(change[::2].tolist(), change[1::2].tolist()))


def covered(n: int, spans: Iterable[tuple[int, int]]) -> np.ndarray:
    """Which of ``n`` words lie in a span."""
    change = np.zeros(n + 1, np.int64)
    for start, stop in spans:
        change[start] += 1
        change[stop] -= 1
    return np.cumsum(change)[:n] > 0


SPANS = "array<struct<start:int,stop:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def pairs_of(spans: list[dict] | None) -> list[tuple[int, int]]:
    return [(s["start"], s["stop"]) for s in spans or ()]


def spans_of(pairs: Iterable[tuple[int, int]]) -> list[dict]:
    return [{"start": a, "stop": b} for a, b in pairs]


def named(rows: DataFrame) -> DataFrame:
    """By document: number of words, counted symbols of the first round, and the first word and
    size of the stretch that determines each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            words, edges = word_names(batch.column("_text").to_pylist())
            sizes = np.diff(edges)
            parse = Parse.of(words, edges).levels(0, LOW_LEVELS)
            at = chosen(parse)
            text = np.searchsorted(edges, parse.start[at], "right") - 1
            at = at[sizes[text] >= WINDOW]
            text = np.searchsorted(edges, parse.start[at], "right") - 1
            ends = pa.array(np.searchsorted(text, np.arange(len(edges))), pa.int32())
            columns = (parse.name[at].view(np.int64), parse.low[at] - edges[text], (parse.high - parse.low)[at].astype(np.int8))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    pa.array(sizes, pa.int32()),
                    *(pa.ListArray.from_arrays(ends, pa.array(c)) for c in columns),
                ],
                ["_row", "_n", "_names", "_lows", "_sizes"],
            ).filter(pa.array(sizes >= WINDOW))

    sql = "_row bigint, _n int, _names array<bigint>, _lows array<int>, _sizes array<tinyint>"
    return map_arrow(rows.select("_row", "_text"), run, sql)


def alive(names: DataFrame, known: Beside) -> DataFrame:
    """Documents with living windows, and these as stretches of first words, for rows of
    ``named`` and beside them the names that other documents have too, ``_shared``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = {c: batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("_names", "_lows", "_sizes")}
            # A text of nothing but repeated words has no names and may yet be a repeat.
            flat["_shared"] = known.find(batch.column("_row"))["_shared"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            edges = np.concatenate([[0], np.cumsum(batch.column("_n").to_numpy().astype(np.int64) + 1)])
            own = np.repeat(edges[:-1], pc.list_value_length(batch.column("_names")).to_numpy())
            alone = ~np.isin(flat["_names"], flat["_shared"])
            low = (flat["_lows"] + own)[alone]
            marks = living(low, low + flat["_sizes"][alone], edges)
            windows = [stretches(marks[a:b]) for a, b in zip(edges, edges[1:])]
            have = pa.array([bool(w) for w in windows])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row").filter(have), pa.array([spans_of(w) for w in windows if w], _SPANS)],
                ["_row", "_windows"],
            )

    return map_arrow(names, run, f"_row bigint, _windows {SPANS}")


HASHED = "_row bigint, start int, stop int, hash binary"


def of_rows(batches: Iterable[pa.RecordBatch], windows: Beside) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of the rows that have living windows, and these."""
    for batch in slices(batches, "_text"):
        found = windows.find(batch.column("_row"))["_windows"].combine_chunks()
        have = pc.is_valid(found)
        if pc.any(have).as_py():
            yield batch.filter(have), found.filter(have)


def revealed(rows: DataFrame, windows: Beside) -> DataFrame:
    """Long symbols, neighbours, and the whole of each document with living windows:
    ``_row, _key, start, stop, hash``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in of_rows(batches, windows):
            texts = batch.column("_text").to_pylist()
            words, edges = word_names(texts)
            now, level = Parse.of(words, edges), 0
            spans: list[set[tuple[int, int]]] = [{(0, b - a)} for a, b in zip(edges.tolist(), edges[1:].tolist())]
            for high in HIGH_LEVELS:
                now, level = now.levels(level, high), high
                stops, at = now.stops(), np.searchsorted(now.start, edges)
                for i, (a, b, edge) in enumerate(zip(at, at[1:], edges)):
                    start, stop = (now.start[a:b] - edge).tolist(), (stops[a:b] - edge).tolist()
                    spans[i].update(zip(start, stop))
                    spans[i].update(zip(start, stop[1:]))
            own, found = [], []
            for i, text in enumerate(texts):
                joined, offsets = joined_words(text)
                for a, b in sorted(spans[i]):
                    if b - a >= WINDOW:
                        own.append(i)
                        found.append((a, b, xxhash.xxh3_128_digest(joined[offsets[a] : offsets[b] - 1])))
            yield hashed(batch, own, found)

    return map_arrow(rows.select("_row", "_key", "_text"), run, T.StructType([rows.schema["_key"], *_hashed().fields]))


def _hashed() -> T.StructType:
    return T.StructType.fromDDL(HASHED)


def hashed(batch: pa.RecordBatch, own: list[int], found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    """Stretches ``start, stop, hash`` of the batch's rows ``own``."""
    at = pa.array(own, pa.int32())
    start, stop, digest = zip(*found) if found else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [
            *(batch.column(c).take(at) for c in ("_key", "_row")),
            pa.array(start, pa.int32()),
            pa.array(stop, pa.int32()),
            pa.array(digest, pa.binary()),
        ],
        ["_key", "_row", "start", "stop", "hash"],
    )


def verified(rows: DataFrame, windows: Beside, known: Beside) -> DataFrame:
    """The living windows outside settled stretches, as ``revealed`` gives stretches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, living_ in of_rows(batches, windows):
            texts = batch.column("_text").to_pylist()
            settled = known.find(batch.column("_row"))["_settled"].to_pylist()
            own, found = [], []
            for i, spans in enumerate(living_.to_pylist()):
                joined, offsets = joined_words(texts[i])
                marks = covered(len(offsets) - 1, pairs_of(spans))
                for start, stop in pairs_of(settled[i]):
                    marks[start : stop - WINDOW + 1] = False
                for a in np.flatnonzero(marks).tolist():
                    own.append(i)
                    found.append((a, a + WINDOW, xxhash.xxh3_128_digest(joined[offsets[a] : offsets[a + WINDOW] - 1])))
                if len(own) > 100_000:
                    yield hashed(batch, own, found)
                    own, found = [], []
            yield hashed(batch, own, found)

    return map_arrow(rows.select("_row", "_key", "_text"), run, T.StructType([rows.schema["_key"], *_hashed().fields]))


#: Kinds of rows of a sorted task: one that comes after another key, one of the task's first
#: hash, and the beginnings of the first and of the last hash.
LATER, OPEN, EDGE = 0, 1, 2


def of_earlier(found: DataFrame) -> DataFrame:
    """``_row, start, stop`` of the rows of a written table whose ``hash`` a row with a smaller
    key has too.

    In the order of hash and key, a row of a hash that comes after a change of key is one. A
    task does not know how its first hash began; tasks tell one another by two rows each.
    """
    names = found.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, head, changed, first = None, None, 0, True

        def kind(rows: pa.RecordBatch, which: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([which] * rows.num_rows, pa.int32())], [*names, "_kind"]
            )

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            hashes, keys = batch.column("hash"), batch.column("_key")
            if last is not None:
                hashes, keys = (pa.concat_arrays([a, b]) for a, b in zip(last, (hashes, keys)))
            new, other = differs(hashes), differs(keys)
            if last is None:
                new, other = np.append(True, new), np.append(False, other)
                yield kind(batch.slice(0, 1), EDGE)
            # By row: changes of key so far, and as many as there were where its hash began.
            seen = np.cumsum(other & ~new) + changed
            later = seen > np.maximum.accumulate(np.append(0, np.where(new, seen, 0)))[1:]
            changed = int(later[-1])
            heads = np.flatnonzero(new)
            unknown = np.zeros(n, bool)
            if first:
                beyond = heads[1:] if last is None else heads
                first = not len(beyond)
                unknown[: n if first else int(beyond[0])] = True
            if len(heads):
                head = batch.slice(int(heads[-1]), 1)
            last = (hashes.slice(len(hashes) - 1), keys.slice(len(keys) - 1))
            yield kind(batch.filter(pa.array(unknown)), OPEN)
            yield kind(batch.filter(pa.array(later & ~unknown)), LATER)
        if head is not None:
            yield kind(head, EDGE)

    place = ["hash", F.asc_nulls_last("_key"), "_row", "start"]
    dealt = found.repartitionByRange(*place).sortWithinPartitions(*place)
    made = T.StructType([*found.schema.fields, T.StructField("_kind", T.IntegerType())])
    rows = written(map_arrow(dealt, run, made), "recompression-late")
    # Two rows for each task at most.
    edges = rows.where(F.col("_kind") == EDGE).groupBy("hash").agg(F.min("_key").alias("_first")).toArrow()
    first = dict(zip(edges["hash"].to_pylist(), edges["_first"].to_pylist()))
    columns = ["_row", "start", "stop"]

    def known(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column("_kind").to_pylist()
            pairs = zip(kinds, batch.column("hash").to_pylist(), batch.column("_key").to_pylist())
            own = [k == LATER or (first[h] is not None and (key is None or first[h] < key)) for k, h, key in pairs]
            yield batch.select(columns).filter(pa.array(own, pa.bool_()))

    late = rows.where(F.col("_kind") != EDGE).select("_kind", "hash", "_key", *columns)
    return map_arrow(late, known, "_row bigint, start int, stop int")


def differs(values: pa.Array) -> np.ndarray:
    """Whether each value but the first is another than the one before; nulls are equal."""
    a, b = values.slice(1), values.slice(0, len(values) - 1)
    unequal = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    return unequal | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))


def united(spans: DataFrame) -> DataFrame:
    """``_row, _spans`` with overlapping spans as one, for rows ``_row, start, stop``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found in batch.column("_spans").to_pylist():
                ends = sorted(pairs_of(found))
                whole = [ends[0]]
                for a, b in ends[1:]:
                    if a <= whole[-1][1]:
                        whole[-1] = (whole[-1][0], max(b, whole[-1][1]))
                    else:
                        whole.append((a, b))
                out.append(spans_of(whole))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(out, _SPANS)], ["_row", "_spans"])

    # At most as many spans as the document has words.
    by_row = spans.groupBy("_row").agg(F.collect_list(F.struct("start", "stop")).alias("_spans"))
    return map_arrow(by_row, run, f"_row bigint, _spans {SPANS}")


def removed_spans(rows: DataFrame) -> Beside:
    """``_row, _spans`` of what goes, for a written table ``_row, _key, _text`` in the order of
    its numbers."""
    names = written(named(rows), "recompression-names")
    each = names.select("_row", F.explode(F.array_distinct("_names")).alias("name"))
    # Documents name a symbol once, so a count over 1 means two documents.
    shared = each.groupBy("name").count().where("count > 1").select("name")
    known = each.join(shared, "name").groupBy("_row").agg(F.collect_list("name").alias("_shared"))
    windows = beside(alive(names, beside(known, "recompression-shared")), "recompression-alive")
    symbols = written(revealed(rows, windows), "recompression-symbols")
    settled = written(of_earlier(symbols), "recompression-settled")
    by_row = settled.groupBy("_row").agg(F.collect_list(F.struct("start", "stop")).alias("_settled"))
    found = verified(rows, windows, beside(by_row, "recompression-settled-rows"))
    found = written(found, "recompression-windows")
    return beside(united(settled.unionByName(of_earlier(found))), "recompression-spans")


def dedup_substrings(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with ``text`` as the words that are kept, joined by one space, and
    ``n_words``, ``n_removed`` and ``removed``, the stretches of removed words. Columns of
    these names are replaced."""
    named_ = ["n_words", "n_removed", "removed"]
    rest = [c for c in documents.columns if c not in (text, *named_)]
    rows = written(
        documents.select(
            F.monotonically_increasing_id().alias("_row"),
            documents[key].alias("_key"),
            documents[text].alias("_text"),
            F.struct(*(documents[c] for c in rest)).alias("_rest"),
        ),
        "recompression-rows",
    )
    spans = removed_spans(rows.select("_row", "_key", "_text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            out, total, gone, places = [], [], [], []
            removed = spans.find(batch.column("_row"))["_spans"].to_pylist()
            for t, found in zip(batch.column("_text").to_pylist(), removed):
                words = (t or "").encode().split()
                drop = covered(len(words), pairs_of(found))
                out.append(None if t is None else b" ".join(w for w, d in zip(words, drop.tolist()) if not d).decode())
                total.append(len(words))
                gone.append(int(drop.sum()))
                places.append(spans_of(stretches(drop)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_rest"),
                    pa.array(out, pa.string()),
                    pa.array(total, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(places, _SPANS),
                ],
                ["_rest", "_text", *named_],
            )

    made = T.StructType.fromDDL(f"_text string, n_words bigint, n_removed bigint, removed {SPANS}")
    done = map_arrow(rows.select("_row", "_rest", "_text"), run, T.StructType([rows.schema["_rest"], *made.fields]))

    def column(name: str) -> Column:
        return F.col("_text").alias(text) if name == text else F.col("_rest")[name].alias(name)

    return done.select(*(column(c) for c in documents.columns if c not in named_), *named_)
