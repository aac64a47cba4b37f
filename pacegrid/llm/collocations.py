"""Phrase collocations by language: phrases of 2 to 4 words that stick together.

Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words.

* Tasks write their words as numbers of a list of their own; lists are counted together. Words
  below ``least`` occurrences cannot be in a candidate, the others get an id.
* Tasks count n-grams of such words in counting quotient filters (``quotient_filter``), sorted
  and cut into buckets of keys; filters of one bucket are merged, and counts below ``least`` go.
  The number of buckets grows with the number of words, so that one fits a task.
* Parts, longer phrases and ranks are joins and aggregates over what is left, with exact
  integers of up to 38 digits.

Defined results: a null text is empty, a null language is ``und``; other columns do not matter;
rows without key or with equal keys count like any other; no text, no rows. A text is worked on
in one task. More than 2**32 words of ``least`` occurrences are refused.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacegrid.llm import quotient_filter as qf
from pacegrid.llm.arrow import map_arrow, slices
from pacegrid.llm.common import written

#: Occurrences of a candidate.
LEAST = 30
#: Words of the longest phrase.
LONGEST = 4
#: Phrases returned of each language.
FIRST = 2000
#: A phrase inside a longer one goes if that has so many hundredths of its occurrences.
SHARE = 80
SCALE = 2_000_000

#: Words that a task counts before it gives out its filters.
HELD_WORDS = 3_000_000
#: Words for each bucket of keys.
BUCKET_WORDS = 1_000_000
SLICE_BYTES = 8_000_000

BREAK = b"\n"
_TABLE = bytearray(range(256))
for _c in range(ord("A"), ord("Z") + 1):
    _TABLE[_c] = _c + 32
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_c] = BREAK[0]
_TABLE[9] = 32
TABLE = bytes(_TABLE)


def encoded(texts: list[str | None]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Place in the list of words for every word, -1 between pieces; the list; and how often
    each of its words occurs."""
    whole = "\n".join(t or "" for t in texts).encode().translate(TABLE).replace(BREAK, b" \n ")
    words = pa.array(whole.split(b" "), pa.binary())
    words = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
    places, known = words.indices.to_numpy().astype(np.int32), words.dictionary
    breaks = pc.equal(known, pa.scalar(BREAK, pa.binary())).to_numpy(zero_copy_only=False)
    renamed = np.where(breaks, -1, np.cumsum(~breaks) - 1).astype(np.int32)
    known = known.filter(pa.array(~breaks)).cast(pa.string())
    places = renamed[places] if len(places) else places
    return places, known, np.bincount(places[places >= 0], minlength=len(known))


def listed(documents: DataFrame, lang: str, text: str) -> DataFrame:
    """``_slice, _lang, _places, _words, _counts``: a row for each language of a slice."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", SLICE_BYTES):
            by_lang: dict[str, list] = {}
            for own, t in zip(batch.column("_lang").to_pylist(), batch.column("_text").to_pylist()):
                by_lang.setdefault(own, []).append(t)
            for own, texts in by_lang.items():
                places, words, counts = encoded(texts)
                if len(words):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([own], pa.string()),
                            pa.array([places.tobytes()], pa.binary()),
                            pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                            pa.array([counts], pa.list_(pa.int64())),
                        ],
                        ["_lang", "_places", "_words", "_counts"],
                    )

    rows = documents.select(
        F.coalesce(documents[lang].cast("string"), F.lit("und")).alias("_lang"), documents[text].alias("_text")
    )
    sql = "_lang string, _places binary, _words array<string>, _counts array<bigint>"
    return map_arrow(rows, run, sql).select(F.monotonically_increasing_id().alias("_slice"), "*")


def numbered(words: DataFrame) -> tuple[DataFrame, int]:
    """``words`` with ``id``, numbers from 0 on without gaps, and how many there are."""
    rows = written(words.withColumn("_at", F.monotonically_increasing_id()), "phrase-words")
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    # As many numbers as the words were written by tasks.
    sizes = sorted(rows.groupBy(part.alias("part")).count().collect())
    total, starts = 0, {}
    for found, n in sizes:
        starts[found] = total
        total += n
    if total > 1 << 32:
        raise ValueError(f"{total} words are more than 2**32")
    if not starts:
        return rows.withColumn("id", F.lit(None).cast("bigint")).drop("_at"), 0
    offset = F.element_at(F.create_map(*(F.lit(v) for pair in starts.items() for v in pair)), part)
    return rows.withColumn("id", (offset + inside).cast("bigint")).drop("_at"), total


def grams(ids: np.ndarray, n: int) -> list[np.ndarray]:
    """An array for each place of the n-grams without a gap (-1)."""
    if len(ids) < n:
        return [ids[:0]] * n
    columns = [ids[i : len(ids) - n + 1 + i] for i in range(n)]
    whole = reduce(np.logical_and, (c >= 0 for c in columns))
    return [c[whole] for c in columns]


FILTER = "n int, bucket bigint, keys int, slot_bits int, slots binary, remainders binary, counts binary"
_FILTER = pa.schema(
    [("n", pa.int32()), ("bucket", pa.int64()), ("keys", pa.int32()), ("slot_bits", pa.int32())]
    + [(c, pa.binary()) for c in ("slots", "remainders", "counts")]
)


def filters(known: DataFrame, id_bits: int, bucket_bits: int) -> DataFrame:
    """Filters of each task's n-grams, for rows ``_places, _ids`` (id by place, null if rare)."""

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for n in range(2, LONGEST + 1):
            form = qf.shape(n, id_bits, bucket_bits)
            found = [grams(ids, n) for ids in held]
            columns = [np.concatenate([f[i] for f in found]) for i in range(n)]
            counted = qf.counted(*qf.permute(*qf.pack(columns, form), form), None, form)
            rows = [(n, *row) for row in qf.to_filters(counted, form)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), _FILTER)], schema=_FILTER
                )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for i in range(batch.num_rows):
                places = np.frombuffer(batch.column("_places")[i].as_py(), np.int32)
                own = batch.column("_known")[i].values
                id_of = np.full(int(places.max(initial=-1)) + 2, -1, np.int64)
                if own is not None and len(own):
                    id_of[own.field("place").to_numpy()] = own.field("id").to_numpy()
                # The last entry stands for -1, the gap between pieces.
                held.append(id_of[places])
                if sum(map(len, held)) >= HELD_WORDS:
                    yield from flush(held)
                    held = []
        if held:
            yield from flush(held)

    return map_arrow(known.select("_places", "_known"), run, FILTER)


def frequent(shards: DataFrame, id_bits: int, bucket_bits: int, least: int) -> DataFrame:
    """``ids, f``: n-grams of ``least`` occurrences in all filters together."""

    def give(key: tuple[int, int], parts: list[qf.Counted]) -> pa.RecordBatch:
        form = qf.shape(key[0], id_bits, bucket_bits)
        found = qf.merged(parts, form)
        many = found.times >= least
        ids = qf.unpack(*qf.restore(found.left[many], found.right[many], form), form)
        edges = pa.array(np.arange(len(ids) + 1) * key[0], pa.int32())
        lists = pa.ListArray.from_arrays(edges, pa.array(ids.ravel(), pa.int64()))
        return pa.RecordBatch.from_arrays([lists, pa.array(found.times[many], pa.int64())], ["ids", "f"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for row in batch.to_pylist():
                key = (row.pop("n"), row.pop("bucket"))
                if key != now and parts:
                    yield give(now, parts)
                    parts = []
                now = key
                form = qf.shape(key[0], id_bits, bucket_bits)
                parts.append(
                    qf.of_filter(
                        key[1], row["keys"], row["slot_bits"], row["slots"], row["remainders"], row["counts"], form
                    )
                )
                # Filters are merged as they come, so that a bucket is held about twice at most.
                if len(parts) > 8:
                    parts = [qf.merged(parts, form)]
        if parts:
            yield give(now, parts)

    dealt = shards.repartition("n", "bucket").sortWithinPartitions("n", "bucket")
    return map_arrow(dealt, run, "ids array<bigint>, f bigint")


def whole(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def scored(found: DataFrame, words: DataFrame) -> DataFrame:
    """``ids, a, l, r, score`` of each candidate by its lowest cut."""
    known = found.unionByName(words.select(F.array("id").alias("ids"), "f"))
    size = F.size("ids")
    cuts = found.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.expr("slice(ids, 1, k)"), "rest": F.expr("slice(ids, k + 1, size(ids))")})
    first = known.select(F.col("ids").alias("first"), F.col("f").alias("l"))
    rest = known.select(F.col("ids").alias("rest"), F.col("f").alias("r"))
    cut = cuts.join(first, "first").join(rest, "rest")
    exact = {"_a": whole(F.col("a")), "_parts": whole(F.col("l")) + whole(F.col("r"))}
    # Whole division of decimals: the product has up to 27 digits.
    score = F.expr(f"(cast({SCALE} as decimal(7,0)) * _a) div _parts")
    cut = cut.withColumns(exact).withColumn("score", score)
    lowest = cut.groupBy("ids").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("_cut"))
    return lowest.select("ids", *(f"_cut.{c}" for c in ("a", "l", "r", "score")))


def swallowed(found: DataFrame) -> DataFrame:
    """``ids, most``: the greatest count of a longer phrase around each phrase in one."""
    inside = found.where(F.size("ids") > 2).select(
        "f",
        F.expr(
            "explode(array_distinct(flatten(transform(sequence(2, size(ids) - 1), "
            "n -> transform(sequence(1, size(ids) - n + 1), i -> slice(ids, i, n))))))"
        ).alias("ids"),
    )
    return inside.groupBy("ids").agg(F.max("f").alias("most"))


def collocations(
    documents: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    first: int = FIRST,
    bucket_words: int = BUCKET_WORDS,
) -> DataFrame:
    """The best ``first`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    lists = written(listed(documents, lang, text), "phrase-lists")
    each = lists.select("_slice", "_lang", F.posexplode(F.arrays_zip("_words", "_counts")).alias("place", "_w"))
    each = each.select("_slice", "_lang", "place", F.col("_w._words").alias("word"), F.col("_w._counts").alias("c"))
    counts = each.groupBy("_lang", "word").agg(F.sum("c").alias("f"))
    counts = written(counts, "phrase-counts")
    totals = counts.groupBy("_lang").agg(F.sum("f").alias("n"))
    words, n_words = numbered(counts.where(F.col("f") >= least))
    id_bits = max(n_words - 1, 1).bit_length()
    every = counts.agg(F.sum("f")).first()[0] or 0
    bucket_bits = max(int(every // bucket_words), 1).bit_length() - 1
    # A word's place is once in a slice's list, so a hot word has a row for each slice.
    placed = each.join(words.select("_lang", "word", "id"), ["_lang", "word"])
    ids = placed.groupBy("_slice").agg(F.collect_list(F.struct("place", "id")).alias("_known"))
    known = lists.select("_slice", "_places").join(ids, "_slice")
    shards = filters(known, id_bits, bucket_bits)
    found = written(frequent(shards, id_bits, bucket_bits, least), "phrase-counters")
    kept = scored(found, words).join(swallowed(found), "ids", "left")
    kept = kept.where("most IS NULL OR cast(100 as decimal(3,0)) * most < cast(%d as decimal(3,0)) * a" % SHARE)
    spelled = kept.select("ids", F.posexplode("ids").alias("place", "id")).join(words, "id")
    spelled = spelled.groupBy("ids").agg(
        F.first("_lang").alias("lang"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda w: w["word"]), " ").alias(
            "phrase"
        ),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    # Spark keeps the first of each language by task before it brings them together.
    ranked = kept.join(spelled, "ids").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= first)
    totals = totals.select(F.col("_lang").alias("lang"), "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint"), "phrase", "a", "l", "r", "n", "score")
