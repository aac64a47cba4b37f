"""Document fingerprints: a Merkle tree over sections, paragraphs and their sentences.

Paragraphs are the lines of a text. A section ends after a paragraph whose hash says so, so
an inserted line moves no border but its own. Below a paragraph are its sentences, the long
ones in blocks. A node's hash covers its children's hashes: equal roots mean equal texts, and
from the root down only differing branches need to be looked at to locate edits.

The fingerprint is one string: the root, then a short hash and the length of every leaf,
separated by ``,`` within a paragraph, ``;`` within a section and ``/`` between sections.

Defined results: a null text is empty; the empty text has one empty leaf; repeated rows have
equal fingerprints, and follow one another in the order of their texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pacegrid.llm.arrow import map_arrow, slices, texts
from pacegrid.llm.common import written

SENTENCE_END = re.compile(r"(?<=[.!?]) ")
BLOCK_CHARS = 200
#: A section ends after one paragraph of so many, by hash.
SECTION_PARAGRAPHS = 8


def node(parts: Iterable[bytes]) -> bytes:
    """Hash of a node from its children's, each of 16 bytes."""
    return blake2b(b"".join(parts), digest_size=16, person=b"node").digest()


def leaves(paragraph: str) -> list[str]:
    out = []
    for sentence in SENTENCE_END.split(paragraph):
        if len(sentence) <= BLOCK_CHARS:
            out.append(sentence)
        else:
            out += [sentence[i : i + BLOCK_CHARS] for i in range(0, len(sentence), BLOCK_CHARS)]
    return out


def tree(text: str) -> tuple[bytes, list[tuple[bytes, list[tuple[bytes, list[tuple[bytes, int]]]]]]]:
    """Root, and below it sections, paragraphs and leaves, each with its hash."""
    sections, current = [], []
    for paragraph in text.split("\n"):
        below = [
            (blake2b(leaf.encode(), digest_size=16).digest(), len(leaf)) for leaf in leaves(paragraph)
        ]
        # Lengths tell a sentence border from a block border.
        own = node([*(h for h, _ in below), blake2b(repr([n for _, n in below]).encode(), digest_size=16).digest()])
        current.append((own, below))
        if own[0] % SECTION_PARAGRAPHS == 0:
            sections.append((node(h for h, _ in current), current))
            current = []
    if current:
        sections.append((node(h for h, _ in current), current))
    return node(h for h, _ in sections), sections


def fingerprint(text: str) -> str:
    root, sections = tree(text)
    body = "/".join(
        ";".join(",".join(f"{h[:4].hex()}{n:x}" for h, n in below) for _, below in paragraphs)
        for _, paragraphs in sections
    )
    return f"{root.hex()}|{body}"


def leaf_counts(print_: str) -> Counter[str]:
    return Counter(print_.partition("|")[2].replace("/", ",").replace(";", ",").split(","))


def likeness(a: str, b: str) -> float:
    """Share of the two texts' characters, in leaves that both have; 1 for equal roots."""
    if a[:32] == b[:32]:
        return 1.0
    left, right = leaf_counts(a), leaf_counts(b)
    total = sum(int(x[8:], 16) * n for c in (left, right) for x, n in c.items())
    shared = sum(int(x[8:], 16) * min(left[x], right[x]) for x in left.keys() & right.keys())
    return 2 * shared / total if total else 0.0


def differing(old: str, new: str) -> list[tuple[int, int]]:
    """Section and paragraph (both from 0) of every paragraph of ``new`` that ``old`` lacks;
    sections whose hash ``old`` has too are not entered."""
    root_a, sections_a = tree(old)
    root_b, sections_b = tree(new)
    if root_a == root_b:
        return []
    known = {h for h, _ in sections_a}
    paragraphs = {h for _, below in sections_a for h, _ in below}
    return [
        (i, j)
        for i, (h, below) in enumerate(sections_b)
        if h not in known
        for j, (p, _) in enumerate(below)
        if p not in paragraphs
    ]


def with_fingerprint(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``fingerprint`` of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            prints = [fingerprint(t) for t in texts(batch, "_text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], [key, "fingerprint"])

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(documents[key], documents[text].alias("_text"))
    return map_arrow(rows, run, f"`{key}` {kind}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COMPARED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
COMPARED_SQL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compared(key: int | None, text: str, own: str, following: str, of_following: str) -> dict:
    changed = edited(text, following)
    of_changed = fingerprint(changed)
    return {
        "doc_id": key,
        "n_chars": len(text),
        "edited_sha256": sha256(changed.encode()).hexdigest(),
        "fingerprint": own,
        "edited_fingerprint": of_changed,
        "near_edited": likeness(own, of_changed),
        "near_next": likeness(own, of_following),
    }


def compare_with_next(documents: DataFrame) -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's.

    Documents are ranged by id, so the next one is in the same task but for the last of a
    range; those few rows, one for each task, meet the first rows of the ranges in a join.
    """
    rows = documents.select(
        documents["doc_id"].cast("long").alias("_key"), F.coalesce(documents["text"], F.lit("")).alias("_text")
    )
    ordered = rows.repartitionByRange("_key").sortWithinPartitions("_key", "_text")
    kinds = pa.schema([*COMPARED, ("place", pa.int32()), ("first_text", pa.string()), ("last_text", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        held: tuple[int | None, str, str] | None = None
        first = None
        for batch in slices(batches, "_text"):
            out = []
            for key, text in zip(batch.column(0).to_pylist(), texts(batch, "_text")):
                own = fingerprint(text)
                if held is None:
                    first = text
                else:
                    out.append(compared(*held, text, own))
                held = (key, text, own)
            yield pa.RecordBatch.from_pylist(out, kinds)
        if held is not None:
            line = {"doc_id": held[0], "fingerprint": held[2], "last_text": held[1], "first_text": first, "place": place}
            yield pa.RecordBatch.from_pylist([line], kinds)

    sql = f"{COMPARED_SQL}, place int, first_text string, last_text string"
    found = written(map_arrow(ordered, run, sql), "merkle")
    columns = COMPARED.names
    edges = found.where("place IS NOT NULL").select("doc_id", "fingerprint", "place", "first_text", "last_text")
    # One number for each task of the job above.
    places = edges.select("place")
    following = places.select(
        "place",
        F.coalesce(F.lead("place").over(W.orderBy("place")), F.min("place").over(W.partitionBy())).alias("_next"),
    )
    heads = edges.select(F.col("place").alias("_next"), F.col("first_text").alias("_following"))
    pairs = edges.drop("first_text").join(following, "place").join(heads, "_next")

    def last(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                compared(r["doc_id"], r["last_text"], r["fingerprint"], r["_following"], fingerprint(r["_following"]))
                for r in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_pylist(out, COMPARED)

    wanted = pairs.select("doc_id", "fingerprint", "last_text", "_following")
    return found.where("place IS NULL").select(*columns).unionByName(map_arrow(wanted, last, COMPARED_SQL))
