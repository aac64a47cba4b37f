"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact verification.

Texts with equal sets of five-word shingles are one node. Nodes that agree in all values of
a MinHash band meet in a bucket; large buckets are split into blocks that meet pair by pair.
A pair's values are compared some at a time: given m of n equal, the similarity has a Beta
posterior, and the pair is dropped once its chance of reaching the threshold falls below the
tolerance. What is left joins nodes to families. Within a family all pairs are compared in
the same way, now followed by the exact similarity of the shingle sets; links are counted in
place, so no task emits pairs.

With 40 bands of 5 values, two texts at the threshold miss each other with a chance of
1e-7, more similar ones with less; pruning adds at most the tolerance.

Defined results: words are runs of letters and digits, lower-cased; a text of one to four
words is one shingle; texts without words, null ones too, link to nothing and are classes of
their own; repeated rows are copies; ``class_id`` is the least ``doc_id`` of a class, null if
there is none.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.llm.arrow import map_arrow, slices, texts
from pacegrid.llm.common import written
from pacegrid.llm.components import connected_components
from pacegrid.llm.url_filter import block_count, possible_hits

SHINGLE_WORDS = 5
#: The least similarity, as a fraction.
THRESHOLD = (4, 5)
BANDS, BAND_VALUES = 40, 5
VALUES = BANDS * BAND_VALUES
#: Values are kept in a byte each, so unequal ones agree by chance in one of 256 cases.
BYTE = 256
STEP = 20
TOLERANCE = 1e-6
BLOCK_NODES = 256
CACHED_WORDS = 400_000
WORD = re.compile(r"\w+")


@lru_cache(1)
def hash_numbers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Odd factors and summands of the MinHash functions, and factors of a shingle's words."""
    rng = np.random.default_rng(2024)
    numbers = rng.integers(1, 2**63, (2, VALUES + SHINGLE_WORDS), dtype=np.uint64)
    return numbers[0, :VALUES] | np.uint64(1), numbers[1, :VALUES], numbers[0, VALUES:] | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str, known: dict[str, int]) -> np.ndarray:
    """The sorted set of a text's shingle hashes."""
    words = WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > CACHED_WORDS:
        known.clear()
    for word in set(words).difference(known):
        known[word] = xxhash.xxh3_64_intdigest(word)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    factors = hash_numbers()[2]
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE_WORDS, len(words))):
        total += hashes[k : k + n] * factors[k]
    return np.unique(mixed(total + np.uint64(min(SHINGLE_WORDS, len(words)))))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One byte of each MinHash value of non-empty sets, a row for each."""
    factors, summands, _ = hash_numbers()
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), VALUES), np.uint8)
    for k in range(VALUES):
        least = np.minimum.reduceat(joined * factors[k] + summands[k], starts)
        out[:, k] = mixed(least) >> np.uint64(56)
    return out


@lru_cache(1)
def least_matches() -> list[int]:
    """For 20, 40, … compared values, the fewest equal ones with which a pair stays.

    With a uniform prior, the chance of agreement after m of n has the posterior
    Beta(m + 1, n - m + 1); its tail above t is a binomial sum.
    """
    similar = THRESHOLD[0] / THRESHOLD[1]
    t = similar + (1 - similar) / BYTE
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        terms = [comb(n + 1, j) * t**j * (1 - t) ** (n + 1 - j) for j in range(n + 2)]
        out.append(next(m for m in range(n + 1) if sum(terms[: m + 1]) >= TOLERANCE))
    return out


def survivors(sigs: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that are left after all values."""
    equal = np.zeros(len(i), np.int16)
    for k, least in enumerate(least_matches()):
        part = slice(k * STEP, (k + 1) * STEP)
        equal += (sigs[i, part] == sigs[j, part]).sum(1, dtype=np.int16)
        stay = equal >= least
        i, j, equal = i[stay], j[stay], equal[stay]
        if not len(i):
            break
    return i, j


def root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def unite(parent: list[int], i: int, j: int) -> None:
    a, b = root(parent, i), root(parent, j)
    if a != b:
        parent[max(a, b)] = min(a, b)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows in tables that end at group borders, with the number of each row's group."""
    rest: pa.Table | None = None

    def numbered(rows: pa.Table) -> np.ndarray:
        change = np.zeros(rows.num_rows, bool)
        for key in keys:
            values = rows[key].to_numpy()
            change[1:] |= values[1:] != values[:-1]
        return np.cumsum(change)

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        if not rows.num_rows:
            continue
        group = numbered(rows)
        border = int(np.searchsorted(group, group[-1]))
        if border:
            yield rows.slice(0, border), group[:border]
        rest = rows.slice(border)
    if rest is not None and rest.num_rows:
        yield rest, numbered(rest)


def pairs_of(group: np.ndarray, side: np.ndarray, within: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs of a group, one distance at a time; where two blocks meet
    (``within`` false), only pairs across them."""
    places = np.arange(len(group))
    for distance in range(1, int(np.bincount(group).max())):
        i = places[:-distance]
        i = i[group[i] == group[i + distance]]
        j = i + distance
        wanted = within[i] | (side[i] != side[j])
        yield i[wanted], j[wanted]


def signature_matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, VALUES)


def blocked(members: DataFrame, key: str) -> DataFrame:
    """Members of groups (``key``, ``node``, ``size``) once for each pair of blocks in which
    theirs takes part: ``key, low, high, side, node``. A block has about 256 nodes."""
    blocks = F.ceil(F.col("size") / BLOCK_NODES).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(7)), blocks).cast("int")
    placed = members.withColumn("side", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return placed.select(key, F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "node")


def dealt(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def nodes_of(documents: DataFrame) -> DataFrame:
    """``doc_id, text_hash, node, signature`` of every row; null without words."""
    rows = documents.select(
        documents["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(documents["text"]).alias("text_hash"),
        documents["text"].alias("_text"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in slices(batches, "_text", 1_000_000):
            sets = [shingles(t, known) for t in texts(batch, "_text")]
            filled = [s for s in sets if len(s)]
            sigs = iter(signatures(filled)) if filled else iter(())
            found = [next(sigs).tobytes() if len(s) else None for s in sets]
            own = [node_id(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(own, pa.int64()), pa.array(found, pa.binary())],
                ["doc_id", "text_hash", "node", "signature"],
            )

    return map_arrow(rows, run, "doc_id long, text_hash long, node long, signature binary")


def node_id(own: np.ndarray) -> int:
    """A number for a set of shingles."""
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def family_edges(nodes: DataFrame) -> DataFrame:
    """``u, v``: a forest over the nodes of each bucket that Bayesian pruning leaves joined."""
    band = F.posexplode(
        F.transform(
            F.sequence(F.lit(0), F.lit(BANDS - 1)),
            lambda b: F.xxhash64(b, F.substring("signature", b * BAND_VALUES + 1, F.lit(BAND_VALUES))),
        )
    )
    bands = nodes.select("node", band.alias("_band", "bucket")).select("node", "bucket")
    sizes = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = blocked(bands.join(sizes, "bucket"), "bucket")
    keys = ["bucket", "low", "high"]
    rows = dealt(members.join(nodes.select("node", "signature"), "node"), keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_, group in whole_groups(batches, keys):
            node, side = rows_["node"].to_numpy(), rows_["side"].to_numpy()
            within = rows_["low"].to_numpy() == rows_["high"].to_numpy()
            sigs = signature_matrix(rows_["signature"])
            parent = list(range(len(node)))
            label = np.arange(len(node))
            for i, j in pairs_of(group, side, within):
                apart = label[i] != label[j]
                i, j = survivors(sigs, i[apart], j[apart])
                if len(i):
                    for a, b in zip(i.tolist(), j.tolist()):
                        unite(parent, a, b)
                    label = np.array([root(parent, k) for k in range(len(node))])
            joined = np.flatnonzero(label != np.arange(len(node)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[joined]), pa.array(node[label[joined]])], ["u", "v"]
            )

    return map_arrow(rows.select(*keys, "side", "node", "signature"), run, "u long, v long")


def shingle_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, shingles`` of the texts whose hash is in ``wanted`` (``text_hash``)."""
    rows = documents.select(F.xxhash64(documents["text"]).alias("url_key"), documents["text"].alias("_text"))
    listed = wanted.select(F.col("text_hash").alias("url_key"))
    # A filter of bounded size keeps most texts from moving; the join is exact.
    maybe = possible_hits(rows, listed, block_count(listed.count())).where("maybe").select("url_key", "_text")
    exact = maybe.join(listed, "url_key", "left_semi").select("_text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in slices(batches, "_text", 1_000_000):
            sets = [s for t in texts(batch, "_text") if len(s := shingles(t, known))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_id(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["node", "shingles"],
            )

    found = map_arrow(exact, run, "node long, shingles binary")
    return found.groupBy("node").agg(F.any_value("shingles").alias("shingles"))


def verified(families: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, links, near``: documents linked to a node's, and a node it is joined to, for
    every pair of blocks in which it takes part."""
    sizes = families.groupBy("family").agg(F.count("*").alias("size"))
    members = blocked(families.join(sizes, "family"), "family")
    about = nodes.select("node", "copies", "signature").join(sets, "node")
    keys = ["family", "low", "high"]
    rows = dealt(members.join(about, "node"), keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, down = THRESHOLD
        for rows_, group in whole_groups(batches, keys):
            node, side = rows_["node"].to_numpy(), rows_["side"].to_numpy()
            copies = rows_["copies"].to_numpy()
            within = rows_["low"].to_numpy() == rows_["high"].to_numpy()
            sigs = signature_matrix(rows_["signature"])
            own = [np.frombuffer(s, np.uint64) for s in rows_["shingles"].to_pylist()]
            links = np.zeros(len(node), np.int64)
            parent = list(range(len(node)))
            for some_i, some_j in pairs_of(group, side, within):
                for i, j in zip(*(x.tolist() for x in survivors(sigs, some_i, some_j))):
                    a, b = own[i], own[j]
                    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
                    shared = int((a[at] == b).sum())
                    if shared * down >= up * (len(a) + len(b) - shared):
                        links[i] += copies[j]
                        links[j] += copies[i]
                        unite(parent, i, j)
            near = node[[root(parent, k) for k in range(len(node))]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(links), pa.array(near)], ["node", "links", "near"]
            )

    columns = [*keys, "side", "node", "copies", "signature", "shingles"]
    return map_arrow(rows.select(*columns), run, "node long, links long, near long")


def jaccard_join(documents: DataFrame) -> DataFrame:
    """``doc_id, text_hash, class_id, copy_id, n_links, stays`` of every row.

    Documents are linked if their shingle sets have a similarity of 0.8 or more; a class is a
    connected component of links. ``n_links`` counts the other documents linked to a
    document, copies among them; ``copy_id`` is the least id with an equal set; ``stays``
    marks the rows of each class with its least id (all of them, if they are repeated).
    """
    rows = written(nodes_of(documents), "shingle-nodes")
    nodes = written(
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.any_value("signature").alias("signature"),
            F.count("*").alias("copies"),
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"),
        ),
        "shingle-sets",
    )
    families = connected_components(written(family_edges(nodes), "family-edges")).select(
        "node", F.col("component").alias("family")
    )
    families = written(families, "families")
    wanted = nodes.join(families, "node", "left_semi").select(F.col("first.text_hash").alias("text_hash"))
    found = written(verified(families, nodes, shingle_sets(documents, wanted)), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = connected_components(found.select(F.col("node").alias("u"), F.col("near").alias("v")))
    about = (
        nodes.drop("signature")
        .join(links, "node", "left")
        .join(joined, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    about = written(about, "node-classes")
    firsts = about.groupBy("component").agg(F.min("first").alias("class_first"))
    by_node = about.join(firsts, "component").select(
        "node",
        F.col("class_first.doc_id").alias("class_id"),
        F.col("class_first.text_hash").alias("_class_hash"),
        F.col("first.doc_id").alias("copy_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    linked = rows.where("node IS NOT NULL").select("doc_id", "text_hash", "node").join(by_node, "node")
    linked = linked.withColumn(
        "stays", F.expr("doc_id <=> class_id AND text_hash = _class_hash")
    )
    alone = rows.where("node IS NULL").select(
        "doc_id",
        "text_hash",
        F.col("doc_id").alias("class_id"),
        F.col("doc_id").alias("copy_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(True).alias("stays"),
    )
    return linked.select(*alone.columns).unionByName(alone)


def one_of_each(documents: DataFrame) -> DataFrame:
    """The first document of every class, with all its columns; texts without words stay."""
    staying = jaccard_join(documents).where("stays").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")
    )
    own = documents.withColumn("_text_hash", F.xxhash64("text"))
    both = own.join(
        staying.distinct(), own["doc_id"].eqNullSafe(F.col("_id")) & (own["_text_hash"] == F.col("_hash")), "left_semi"
    )
    return both.dropDuplicates(["doc_id", "_text_hash"]).select(*documents.columns)
