"""Toxicity by non-negative learning from positive and unlabelled texts.

A linear classifier over hashed words and word beginnings is trained with numpy from
confirmed toxic texts and unlabelled ones. The risk of the negative class is estimated from
the unlabelled texts minus the class prior's share of the toxic ones, and is kept from
falling below zero. Features and scores are computed on the executors; the driver sees the
feature numbers of a bounded sample.

Defined results: null and empty texts have no features and the score of the bias; rows are
scored one by one; without toxic examples all scores are 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacegrid.llm.arrow import map_arrow, slices, texts

#: Texts that the classifier is trained on at most, chosen by a hash of the id.
TOXIC_TEXTS = 3_000
UNLABELLED_TEXTS = 10_000
FEATURES = 1 << 17
#: Letters of the word beginnings.
PREFIXES = (3, 4, 5)
#: A feature of toxic texts alone is 1 / prior times as frequent in them as in all texts; one
#: is used if it comes this near to that, and stands in so many toxic texts.
LEAST_LIFT = 0.6
LEAST_TEXTS = 5
STEPS = 150
RATE = 0.1
DECAY = 1e-4
SEED = 13
THRESHOLD = 0.7
CACHED_WORDS = 400_000
WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    """The word and its beginnings, hashed."""
    parts = {f"={word}", *(f"{n}{word[:n]}" for n in PREFIXES if len(word) >= n)}
    return [zlib.crc32(p.encode()) % FEATURES for p in parts]


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def features(text: str, known: dict[str, list[int]]) -> list[int]:
    out: set[int] = set()
    for word in words_of(text):
        if word not in known:
            if len(known) > CACHED_WORDS:
                known.clear()
            known[word] = word_features(word)
        out.update(known[word])
    return sorted(out)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    prior: float


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def joined(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all rows, one after the other, and the row of each."""
    return np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])


def marking(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> np.ndarray:
    """Which features are so much more frequent in toxic texts, also after a standard error
    less on both sides."""
    in_toxic = np.bincount(np.concatenate(toxic), minlength=FEATURES)
    in_all = np.bincount(np.concatenate(unlabelled), minlength=FEATURES)
    ratio = LEAST_LIFT / prior / len(unlabelled)
    likely = (in_toxic - np.sqrt(in_toxic)) / len(toxic) >= ratio * (in_all - np.sqrt(in_all))
    return likely & (in_toxic / len(toxic) >= ratio * in_all) & (in_toxic >= LEAST_TEXTS)


def train(toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Minimise prior × R⁺(toxic) + max(0, R⁻(unlabelled) − prior × R⁻(toxic)), logistic loss.

    Where the second part is negative, the step goes against it, as the non-negative
    estimator has it. Steps use all rows: small batches make that part negative by chance.
    """
    used = marking(toxic, unlabelled, prior)
    place, n = np.cumsum(used) - 1, int(used.sum())
    toxic, unlabelled = ([place[r[used[r]]] for r in rows] for rows in (toxic, unlabelled))
    (at_p, row_p), (at_u, row_u) = joined(toxic), joined(unlabelled)
    weights, bias = np.zeros(n), -2.0
    mean, square = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, STEPS + 1):
        z_p = bias + np.bincount(row_p, weights[at_p], len(toxic))
        z_u = bias + np.bincount(row_u, weights[at_u], len(unlabelled))
        negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        if negative >= 0:
            g_p = np.full(len(toxic), -prior / len(toxic))
            g_u = sigmoid(z_u) / len(unlabelled)
        else:
            g_p = prior * sigmoid(z_p) / len(toxic)
            g_u = -sigmoid(z_u) / len(unlabelled)
        gradient = np.append(
            np.bincount(at_p, g_p[row_p], n) + np.bincount(at_u, g_u[row_u], n) + DECAY * weights,
            g_p.sum() + g_u.sum(),
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-4)
        weights -= move[:-1]
        bias -= move[-1]
    whole = np.zeros(FEATURES)
    whole[used] = weights
    return Model(whole, float(bias), prior)


def sample_features(documents: DataFrame, toxic_ids: DataFrame, ids: DataFrame) -> DataFrame:
    """``toxic`` and ``features`` of the chosen documents."""
    chosen = toxic_ids.select("doc_id", F.lit(True).alias("toxic")).unionByName(
        ids.select("doc_id", F.lit(False).alias("toxic"))
    )
    # Bounded by the two sample sizes.
    rows = documents.select("doc_id", F.col("text").alias("_text")).join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for batch in slices(batches, "_text"):
            found = [features(t, known) for t in texts(batch, "_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], ["toxic", "features"]
            )

    return map_arrow(rows.select("toxic", "_text"), run, "toxic boolean, features array<int>")


def learn(
    documents: DataFrame,
    labels: DataFrame,
    toxic_texts: int = TOXIC_TEXTS,
    unlabelled_texts: int = UNLABELLED_TEXTS,
    prior: float | None = None,
) -> Model | None:
    """A model from bounded samples; the class prior is the labels' share of toxic rows
    unless given. ``labels`` has ``doc_id, toxic`` and no row that may not be learned from."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if prior is None:
        prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not prior:
        return None
    mix = F.xxhash64("doc_id", F.lit(SEED))
    toxic = known.where("toxic = 1").orderBy(mix, "doc_id").limit(toxic_texts)
    ids = documents.where("doc_id IS NOT NULL").select("doc_id").orderBy(mix, "doc_id").limit(unlabelled_texts)
    found = sample_features(documents, toxic, ids).toArrow()
    rows: dict[bool, list[np.ndarray]] = {True: [], False: []}
    for is_toxic, numbers in zip(found["toxic"].to_pylist(), found["features"].combine_chunks()):
        rows[is_toxic].append(numbers.values.to_numpy().astype(np.int64))
    if not any(map(len, rows[True])) or not any(map(len, rows[False])):
        return None
    for kind in rows.values():  # the order in which rows come must not matter
        kind.sort(key=lambda r: (len(r), r.tolist()))
    return train(rows[True], rows[False], float(prior))


def score(documents: DataFrame, model: Model | None, key: str = "doc_id") -> DataFrame:
    """``key`` and ``score`` of every row, by the whole text."""
    if model is None:
        return documents.select(key, F.lit(0.0).alias("score"))
    weights, bias = model.weights.astype(np.float32), model.bias

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in slices(batches, "_text"):
            z = []
            for text in texts(batch, "_text"):
                found = words_of(text)
                if len(known) > CACHED_WORDS:
                    known.clear()
                for word in found.difference(known):
                    known[word] = float(weights[word_features(word)].sum())
                z.append(bias + sum(map(known.__getitem__, sorted(found))))
            out = sigmoid(np.array(z))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], [key, "score"])

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(documents[key], documents["text"].alias("_text"))
    return map_arrow(rows, run, f"`{key}` {kind}, score double")


def held_out(key: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(3)) == 1, F.lit(False))


def judge(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    seen = labels.select("doc_id", "toxic").where(~held_out())
    model = learn(documents.where(~held_out()), seen)
    scored = score(documents, model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
